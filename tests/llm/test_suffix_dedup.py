import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import helpers
from servelens.llm import suffix_dedup as S


def plain(texts, m=400):
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i:i + m] for d in data for i in range(len(d) - m + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - m + 1):
            if count[d[i:i + m]] > 1:
                gone[i:i + m] = True
        runs = int((gone[1:] < gone[:-1]).sum())
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), len(d) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return out


def found(df):
    return Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def check(spark, texts, ids=None, m=400, **parameters):
    ids = ids or list(range(len(texts)))
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(4)
    got = found(S.without_repeats(df, min_bytes=m, **parameters))
    assert got == Counter((i, *r) for i, r in zip(ids, plain(texts, m)))
    return got


def corpus(rng, n=120):
    word = lambda: "".join(rng.choice("abcdeé漢 ") for _ in range(rng.randint(2, 8)))
    text = lambda k: " ".join(word() for _ in range(k))
    shared = [text(rng.randint(20, 200)) for _ in range(6)]
    out = [" ".join([text(rng.randint(0, 120)), *(rng.choice(shared) for _ in range(rng.randint(0, 2))), text(rng.randint(0, 60))]) for _ in range(n)]
    for _ in range(n // 3):  # copies with an edit
        t = rng.choice(out)
        cut = rng.randint(0, len(t))
        out.append(t[:cut] + rng.choice(["", "x", "edited here"]) + t[cut + rng.randint(0, 3):])
    return out + [out[0], out[1], shared[0], "ab" * 900, "a" * 1500, "", None, "x" * 399, "x" * 400, "y" * 400, "y" * 401, text(30) * 8]


def test_equals_brute_force(spark):
    got = check(spark, corpus(random.Random(1)))
    assert sum(r[2] > 0 for r in got) > 40 and sum(r[2] == 0 for r in got) > 20


def test_large_anchor_groups_are_split_over_shards_and_merged(spark):
    rng = random.Random(2)
    head = "".join(rng.choice("abc ") for _ in range(300))
    tails = ["".join(rng.choice("abc ") for _ in range(150)) for _ in range(12)]
    # one passage under the limit in all texts, with some longer repeats around it
    texts = ["".join(rng.choice("abc ") for _ in range(rng.randint(0, 300))) + head + rng.choice(tails) + "".join(rng.choice("abc ") for _ in range(50)) for _ in range(90)]
    check(spark, texts + corpus(rng, 30), shard_bytes=4000)


@pytest.mark.parametrize("m,gram", [(64, 16), (100, 64), (400, 256), (33, 32), (17, 1)])
def test_other_lengths(spark, m, gram):
    check(spark, corpus(random.Random(m), 30), m=m, gram=gram, shard_bytes=20_000)


def test_edges_repeated_rows_and_clashing_columns(spark):
    long = "".join(random.Random(7).choice("abcd ") for _ in range(1000))
    texts = [long, long, None, None, "", "short", long + "tail", long]
    ids = [5, 5, None, 3, 3, 3, None, 2 ** 62]
    check(spark, texts, ids)
    names = ["td", "id", "data", "h", "f", "n", "start", "spans", "shard", "copies", "parts"]
    df = spark.createDataFrame([(i, t, *range(len(names))) for i, t in zip(ids, texts)], "doc_id long, text string, " + ", ".join(f"{c} int" for c in names))
    assert found(S.without_repeats(df)) == Counter((i, *r) for i, r in zip(ids, plain(texts)))
    assert S.without_repeats(helpers.empty(spark)).collect() == []


def test_long_texts_over_many_blocks(spark):
    rng = random.Random(9)
    base = "".join(rng.choice("abcdefgh ") for _ in range(200_000))
    texts = [base, base[:90_000] + "!" + base[90_001:], "ab" * 100_000, "".join(rng.choice("abcdefgh ") for _ in range(99_999)) + "#" + base[1000:1500] + "#"]
    got = {r.doc_id: r for r in S.without_repeats(helpers.frame(spark, texts), with_kept=True).collect()}
    assert got[0].n_removed == 200_000 - 1 and got[0].n_spans == 2
    assert got[2].n_removed == 200_000 and got[2].n_spans == 1
    assert [(s.a, s.b) for s in got[3].removed] == [(100_000, 100_500)] and len(got[3].kept) == 100_001


def test_fixture_equals_brute_force(spark):
    df = helpers.fixture_docs(spark)
    rows = df.collect()
    assert found(S.without_repeats(df)) == Counter((r.doc_id, *x) for r, x in zip(rows, plain([r.text for r in rows])))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab"), max_size=60), min_size=1, max_size=6), st.integers(9, 20))
def test_repeated_windows(texts, m):
    texts = [t.encode() for t in texts if t]
    if not texts:
        return
    count = Counter(t[i:i + m] for t in texts for i in range(len(t) - m + 1))
    expected = [i <= len(t) - m and count[t[i:i + m]] > 1 for t in texts for i in range(len(t))]
    got = S.repeated_windows(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts]), m)
    assert got.tolist() == expected


@settings(max_examples=100, deadline=None)
@given(st.binary(min_size=1, max_size=80).map(lambda b: bytes(x % 3 for x in b)))
def test_common_prefixes(data):
    order = sorted(range(len(data)), key=lambda i: data[i:])
    left = np.arange(len(data), 0, -1)
    got = S.common_prefixes(np.frombuffer(data, np.uint8), np.array(order), left)

    def lcp(a, b):
        k = 0
        while k < min(len(a), len(b)) and a[k] == b[k]:
            k += 1
        return k
    assert got.tolist() == [0] + [lcp(data[a:], data[b:]) for a, b in zip(order, order[1:])]
