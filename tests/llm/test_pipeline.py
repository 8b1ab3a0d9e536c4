"""Every stage against a brute-force version over what the stage before it kept, and the stages' edge cases."""

import re
from collections import Counter, defaultdict

import corpus_pipeline
import helpers
import test_mixing
import test_packing
from helpers import F
from servelens.llm import pii, quality, stages
from test_simhash import brute, plain_print

CLASHES = ("component_id", "fingerprint", "text_hash", "kept", "score", "size", "target", "copies", "bucket", "u", "row", "weight", "key", "w_id", "draw")


def key(r):
    return tuple((x is not None, x if not isinstance(x, str) else x) for x in (r.doc_id, r.text))


def check_near_duplicates(before, after):
    """One row of each component: that of its smallest id."""
    prints = [plain_print(r.text) for r in before]
    component = brute(prints)
    groups = defaultdict(list)
    for r, p in zip(before, prints):
        groups[component[p]].append(r)
    expect = sorted(min(r.doc_id for r in g) for g in groups.values())
    assert sorted(r.doc_id for r in after) == expect
    texts = {r.doc_id: r.text for r in before}
    assert all(texts[r.doc_id] == r.text for r in after)


def check_personal_data(before, after):
    plain = lambda t: None if t is None else pii.redact(t, pii.find_spans(t))
    assert sorted((r.doc_id, plain(r.text)) for r in before) == sorted((r.doc_id, r.text) for r in after)
    assert all(r.n_chars == len(r.text) for r in after if r.text is not None)
    assert not [s for r in after for s in pii.find_spans(r.text or "") if s[0] == "email"]


def check_mixing(before, after):
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in before:
        n = test_mixing.size_of(r.text)
        sizes[r.source] += n
        largest[r.source] = max(largest[r.source], n)
    for r in after:
        taken[r.source] += test_mixing.size_of(r.text)
    known, copies = Counter(map(key, before)), Counter(map(key, after))
    assert all(n <= 3 * known[k] for k, n in copies.items())
    for s, target in test_mixing.fill(dict(sizes)).items():
        assert abs(taken[s] - target) <= max(0.02 * target, largest[s]), (s, taken[s], target)


def test_each_stage_works_on_all_that_its_predecessor_kept(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    seen, before = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, "/root/testdata/sf0.001")
        after = after.checkpoint()
        seen[name] = (before, after)
        if name != "packing":
            assert after.columns == docs.columns and after.dtypes == docs.dtypes
        before = after
    rows = {name: (a.collect(), b.collect()) for name, (a, b) in seen.items()}
    kept = {r.doc_id for r in quality.classify(docs).filter("kept").collect()}
    assert {r.doc_id for r in rows["quality"][1]} == kept and 0 < len(kept) < docs.count()
    check_near_duplicates(*rows["near duplicates"])
    check_personal_data(*rows["personal data"])
    check_mixing(*rows["mixing"])
    test_packing.check(seen["packing"][0], rows["packing"][1], 2048)


def test_run_gives_the_last_stages_rows(spark):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert got.columns[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    spans = defaultdict(list)
    for r in got.collect():
        spans[r.sequence_id].append((r.offset, r.length))
    for own in spans.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert 0 < at <= 2048
    again = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    same = lambda df: Counter((r.doc_id, r.doc_tokens) for r in df.filter("start = 0").collect())
    assert same(got) == same(again)


def test_stages_on_nulls_repeated_rows_and_clashing_columns(spark):
    for df in (helpers.edge(spark), helpers.edge(spark).limit(0), helpers.edge(spark).filter("text IS NULL")):
        for c in CLASHES:
            df = df.withColumn(c, F.lit("extra"))
        known = {key(r) for r in df.collect()}
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, df, "")
            assert out.columns == df.columns, name
            rows = out.collect()
            if name != "personal data":
                assert {key(r) for r in rows} <= known, name
            else:
                assert len(rows) == df.count()
            assert all(r[c] == "extra" for r in rows for c in CLASHES)
        packed = stages.pack_sequences(spark, df, "").collect()
        assert sum(r.start == 0 for r in packed) == df.count()
        if df.count() > 5:
            near = stages.drop_near_duplicates(spark, df, "").collect()
            # texts without a word form one group, led by the smallest id; repeated rows leave one
            assert [r.doc_id for r in near if not re.search(r"[^\x20\x09-\x0D]", r.text or "")] == [0]
            assert sum(r.text == "same words here" for r in near) == 1
