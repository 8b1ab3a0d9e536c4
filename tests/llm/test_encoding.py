import public_tokenizers as P
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from servelens.llm.encoding import ChunkEncoder

CASES = [("byte_bpe_50k.json", True, 0), ("word_bpe_49k.json", False, 1)]
MADE = {f: (Tokenizer.from_file(P.path(f)), ChunkEncoder(P.path(f), p, e, max_chunks=200)) for f, p, e in CASES}
TEXT = st.text(st.sampled_from(list("ab Aé ñß'st\n\r\t\x0b\x0c\x1c\x1f\x85\xa0 　​́漢🙂1|<>")) | st.characters(codec="utf-8"), max_size=40)


@pytest.mark.parametrize("name,_pattern,end", CASES)
@settings(max_examples=1500, deadline=None)
@given(texts=st.lists(TEXT | TEXT.map(lambda t: t + " <|endoftext|>" + t), max_size=6))
def test_ids_equal_whole_text_ids(name, _pattern, end, texts):
    plain, made = MADE[name]
    ids, counts = made.encode(texts)
    expect = [plain.encode(t, add_special_tokens=False).ids + [end] for t in texts]
    assert counts.tolist() == [len(x) for x in expect]
    assert ids.tolist() == [i for x in expect for i in x]


@pytest.mark.parametrize("name,_pattern,end", CASES)
def test_sliced_arrow_and_nulls(name, _pattern, end):
    plain, made = MADE[name]
    made._reset()
    texts = ["skip", "one two.\nThree four", None, "", "a\nb", "The end. It's ok", "a  b", "x " * 3000]
    ids, counts = made.encode(pa.array(texts).slice(1))
    expect = [plain.encode(t or "", add_special_tokens=False).ids + [end] for t in texts[1:]]
    assert counts.tolist() == [len(x) for x in expect] and ids.tolist() == [i for x in expect for i in x]


@pytest.mark.parametrize("name,_pattern,end", CASES)
def test_plain_words_take_the_short_way(name, _pattern, end):
    plain, made = MADE[name]
    assert made.plain
    texts = ["Straße, ÉTÉ. Niño ÿÀ naïve.", "ÞORN word,, x.y It's İstanbul ſ"]
    ids, _ = made.encode(texts)
    assert ids.tolist() == [i for t in texts for i in plain.encode(t, add_special_tokens=False).ids + [end]]


@pytest.mark.parametrize("name,_pattern,end", CASES)
def test_a_known_word_is_not_encoded_again_for_its_signs(name, _pattern, end):
    plain, made = MADE[name]
    made._reset()
    texts = ["first Abend naïve", "then Abend, naïve!? first. Abend"]
    calls, model = [], made.model

    class Counted:
        def tokenize(self, word):
            calls.append(word)
            return model.tokenize(word)
    try:
        made.model = Counted()
        got = [made.encode([t])[0].tolist() for t in texts]
    finally:
        made.model = model
    assert got == [plain.encode(t, add_special_tokens=False).ids + [end] for t in texts]
    # "Abend" stands first in neither text, so it has a space before it in both
    assert sum("bend" in w for w in calls) == 1
