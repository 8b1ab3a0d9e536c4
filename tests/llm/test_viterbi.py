import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models, normalizers

from servelens.llm import viterbi
import helpers

PATH = P.path("piece_bpe_32k.model")


def library(pieces, byte_fallback):
    t = Tokenizer(models.Unigram([(p, s) for p, s in pieces], 0, byte_fallback))
    t.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    return t


FULL = library(viterbi.load_pieces(PATH), True)
SMALL = (("<unk>", 0.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("ba", -2.0), ("▁", -1.0), ("▁a", -2.0), ("aab", -3.0), ("bb", -2.0), ("▁▁", -2.0))
SMALL_LIB, SMALL_MADE = library(SMALL, False), viterbi.Counter(SMALL, byte_fallback=False)
CROSS = SMALL + (("b▁a", -1.5), ("a\nb", -1.0))
CROSS_LIB, CROSS_MADE = library(CROSS, False), viterbi.Counter(CROSS, byte_fallback=False)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list("abcdet  \n\t▁é漢🙂<0x>A")), max_size=60))
def test_full_vocabulary_equals_the_library(text):
    assert viterbi.counter(PATH).count(viterbi.marked(text)) == len(FULL.encode(text, add_special_tokens=False).ids)


@settings(max_examples=500, deadline=None)
@given(st.text(st.sampled_from(list("aabb cx\n")), max_size=40))
def test_ties_and_unknown_runs(text):
    assert SMALL_MADE.count(viterbi.marked(text)) == len(SMALL_LIB.encode(text, add_special_tokens=False).ids)
    assert CROSS_MADE.count(viterbi.marked(text)) == len(CROSS_LIB.encode(text, add_special_tokens=False).ids)


def test_query_on_fixture_and_edges(spark):
    for df in (helpers.fixture_docs(spark), helpers.edge(spark).withColumn("n_tokens", helpers.F.lit("clash"))):
        texts = {(r.doc_id, r.text) for r in df.collect()}
        got = viterbi.count_tokens(df, PATH).collect()
        assert len(got) == df.count()
        expect = sorted(((i is None, i or 0), len(FULL.encode(t or "", add_special_tokens=False).ids)) for i, t in [(r.doc_id, r.text) for r in df.collect()])
        assert sorted(((r.doc_id is None, r.doc_id or 0), r.n_tokens) for r in got) == expect
        assert texts
    assert viterbi.count_tokens(helpers.empty(spark), PATH).count() == 0


def test_control_and_byte_pieces_match_no_text():
    made = viterbi.counter(PATH)
    names = viterbi.load_names(PATH)
    assert {"<s>", "</s>", "<unk>", "<0x00>", "<0x0A>", "<0xFF>"} <= names and len(names) == 259
    # a reference in which those pieces are spelt so that no text meets them
    hidden = Tokenizer(models.Unigram([("\U000F0000" + p if p in names and not p.startswith("<0x") else p, s) for p, s in viterbi.load_pieces(PATH)], 0, True))
    hidden.normalizer = FULL.normalizer
    seen = 0
    for text in ("<s>", "x<s>y</s>", "a<unk>b two", "(</s>)"):
        n, before = made.count(viterbi.marked(text)), len(FULL.encode(text, add_special_tokens=False).ids)
        assert n == len(hidden.encode(text, add_special_tokens=False).ids) >= before
        seen += n > before
    assert seen >= 3
    for name in ("<0x0A>", "<0x00>", "<0xFF>"):
        assert made.count("a" + name + "b") > made.count("ab") + 2
