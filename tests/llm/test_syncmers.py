import hashlib
import random

import helpers
from helpers import F
from servelens.llm import syncmers


def plain_anchors(words, h, k=5, s=2):
    """Positions (from 1) of closed syncmers of a word list; ``h`` hashes a tuple of words."""
    if len(words) < k:
        return [1] if words else []
    out = []
    for i in range(len(words) - k + 1):
        inner = [h[tuple(words[j:j + s])] for j in range(i, i + k - s + 1)]
        if min(inner) in (inner[0], inner[-1]):
            out.append(i + 1)
    return out


def words_of(text):
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def test_anchors_equal_brute_force(spark):
    texts = [r.text or "" for r in helpers.edge(spark).collect()] + [r.text for r in helpers.fixture_docs(spark).limit(60).collect()]
    pairs = sorted({tuple(w[i:i + 2]) for t in texts for w in [words_of(t)] for i in range(len(w) - 1)})
    hashed = spark.createDataFrame([(list(p),) for p in pairs], "p array<string>").select("p", F.xxhash64(F.transform("p", lambda w: F.xxhash64(w))).alias("h")).collect()
    h = {tuple(r.p): r.h for r in hashed}
    got = syncmers.fingerprints(helpers.frame(spark, texts)).collect()
    for r in got:
        assert [a.position for a in r.anchors] == plain_anchors(words_of(texts[r.doc_id]), h)
        assert len(r.fingerprint) == 8 * min(64, len({a.hash for a in r.anchors}))


def plain_edited(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    out = []
    for i, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        out.append((doc_id, len(text), hashlib.sha256((text[:len(text) - half] + after[:half]).encode()).hexdigest()))
    return out


def check(df):
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = syncmers.edited_fingerprints(df).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=str) == sorted(plain_edited(rows), key=str)
    prints = {}
    texts = {}
    for r in rows:
        texts.setdefault(r[0], set()).add(r[1] or "")
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if len(texts[r.doc_id]) == 1:
            prints.setdefault(next(iter(texts[r.doc_id])), set()).add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    return got


def test_documents(spark):
    got = check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    long = [r for r in got if r.n_chars > 600]
    assert sum(r.near_edited for r in long) / len(long) > 0.25
    assert sum(r.near_next for r in long) / len(long) < 0.05


def test_edges(spark):
    check(helpers.edge(spark).withColumn("bucket", F.lit("clash")).withColumn("own", F.lit(1)))
    check(helpers.frame(spark, ["only one"]))
    check(helpers.frame(spark, [None, "x y"], ids=[None, None]))
    assert syncmers.edited_fingerprints(helpers.empty(spark)).count() == 0


def test_likeness_of_copies_and_shifted_passages(spark):
    words = [f"w{i}" for i in range(200)]
    got = {r.doc_id: r for r in syncmers.edited_fingerprints(helpers.frame(spark, [" ".join(words), " ".join(words), "x y z " + " ".join(words), "other " * 3])).collect()}
    assert got[0].near_next == 1.0 and got[1].near_next > 0.9 and got[2].near_next == 0.0


def plain_likeness(a, b):
    """``a``, ``b``: lists of (position, hash)."""
    first = [{}, {}]
    for side, anchors in enumerate((a, b)):
        for position, h in anchors:
            first[side][h] = min(position, first[side].get(h, position))
    if not a and not b:
        return 1.0
    pairs = sorted((first[0][h], first[1][h]) for h in first[0].keys() & first[1].keys())
    off = [None] + [y - x for x, y in pairs] + [None]
    count = len(pairs) if 1 in (len(first[0]), len(first[1])) else sum(off[i] in (off[i - 1], off[i + 1]) for i in range(1, len(off) - 1))
    return count / len(first[0].keys() | first[1].keys())


def test_likeness_uses_all_anchors_by_position(spark):
    docs = [r.text for r in helpers.fixture_docs(spark).limit(60).collect()] + [r.text or "" for r in helpers.edge(spark).collect()]
    docs += ["a b c d e f g h " * 9, "a b c d e f g h " * 7 + "z", "a b c d e q r s a b c d e"]
    df = helpers.frame(spark, docs)
    anchors = {r.doc_id: [(a.position, a.hash) for a in r.anchors] for r in syncmers.fingerprints(df).collect()}
    for r in syncmers.edited_fingerprints(df).collect():
        expect = plain_likeness(anchors[r.doc_id], anchors[(r.doc_id + 1) % len(docs)])
        assert abs(r.near_next - expect) < 1e-12, r.doc_id


def test_a_passage_counts_in_long_texts_and_fingerprints_grow(spark):
    own = lambda name, n: [f"{name}{i}" for i in range(n)]
    shared, long = own("s", 60), own("l", 20_000)
    texts = [own("a", 10_000) + shared + own("b", 10_000), own("c", 3_000) + shared + own("d", 17_000),  # share a passage
             long, long[:9_000] + own("r", 60) + long[9_060:], own("e", 400)]
    got = {r.doc_id: r for r in syncmers.edited_fingerprints(helpers.frame(spark, [" ".join(t) for t in texts])).collect()}
    assert 0.0005 < got[0].near_next < 0.003  # about 28 of 20,000
    assert 0.98 < got[2].near_next < 1.0
    assert len(got[2].fingerprint) > 8 * 200 and len(got[4].fingerprint) == 8 * 64


def test_large_and_sparse_ids_have_followers(spark):
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(50)}" for _ in range(rng.randint(1, 40))) for _ in range(400)]
    expected = [(r.edited_sha256, r.edited_fingerprint, r.near_next) for r in syncmers.edited_fingerprints(helpers.frame(spark, texts)).orderBy("doc_id").collect()]
    assert all(x is not None for r in expected for x in r)
    for ids in (list(range(2 ** 62, 2 ** 62 + 400)), [-(2 ** 63) + i * 2 ** 54 for i in range(400)], [i // 399 * 2 ** 60 + i for i in range(400)]):
        got = syncmers.edited_fingerprints(helpers.frame(spark, texts, ids=ids)).orderBy("doc_id").collect()
        assert [r.doc_id for r in got] == ids
        assert [(r.edited_sha256, r.edited_fingerprint, r.near_next) for r in got] == expected
