import random

import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

import helpers
from helpers import F
from servelens.llm import queries, simhash
from servelens.llm.components import connected_components


def plain_print(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ")
             .replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(links, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(prints, d=4):
    distinct = sorted(set(prints))
    return groups([(a, b) for i, a in enumerate(distinct) for b in distinct[i + 1:] if (a ^ b).bit_count() <= d], distinct)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list("aAbÉé \t\n\x0b\x0c\r\x1c\x85\xa0漢")), max_size=40))
def test_fingerprint(text):
    assert simhash.simhash(text.encode(), 4, 42) % 2**64 == plain_print(text)


def test_shingle_hash_is_the_engines(spark):
    r = spark.sql("select xxhash64('some words ß here') h").first()
    assert r.h % 2**64 == xxhash.xxh64_intdigest("some words ß here".encode(), 42)


def signed(x):
    return x - 2**64 if x >> 63 else x


def test_components_equal_brute_force_on_dense_and_random_prints(spark):
    rng = random.Random(3)
    for d in (1, 3, 4, 5):
        prints = [rng.getrandbits(64) for _ in range(150)]
        for _ in range(250):  # chains: each some bits from an earlier one
            x = rng.choice(prints[:40] + prints[-30:])
            for bit in rng.sample(range(64), rng.randint(1, d + 2)):
                x ^= 1 << bit
            prints.append(x)
        prints += [0, 2**64 - 1]
        df = spark.createDataFrame([(signed(p),) for p in set(prints)], "fingerprint long")
        got = {r.node % 2**64: r.component % 2**64 for r in simhash.near_components(df, d).collect()}
        classes = {}
        for p in set(prints):
            classes.setdefault(got.get(p, p), set()).add(p)
        expect = {}
        for p, c in brute(prints, d).items():
            expect.setdefault(c, set()).add(p)
        assert sorted(map(sorted, classes.values())) == sorted(map(sorted, expect.values()))


def test_long_path(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {n: 0 for n in range(1, 301)}
    assert connected_components(edges.filter("a < 0")).count() == 0


def check(df):
    rows = df.collect()
    prints = [plain_print(r.text) for r in rows]
    classes = brute(prints)
    ids = {}
    for r, p in zip(rows, prints):
        if r.doc_id is not None:
            ids[classes[p]] = min(ids.get(classes[p], r.doc_id), r.doc_id)
    got = simhash.near_duplicates(df).select("doc_id", simhash.as_hex(F.col("fingerprint")).alias("f"), "component_id").collect()
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted(map(tuple, got), key=key) == sorted(((r.doc_id, f"{p:016x}", ids.get(classes[p])) for r, p in zip(rows, prints)), key=key)
    kept = simhash.keep_one_per_group(df).collect()
    assert len(kept) == len(set(classes.values()))
    assert sorted(r.doc_id if r.doc_id is not None else -1 for r in kept) == sorted(ids.get(c, -1) for c in set(classes.values()))
    assert set(kept[0].asDict()) == set(df.columns) if kept else True


def test_documents(spark):
    check(helpers.fixture_docs(spark))


def test_edges(spark):
    check(helpers.edge(spark).withColumn("key", F.lit("clash")).withColumn("component_id", F.lit(-1)))
    assert simhash.near_duplicates(helpers.empty(spark)).count() == 0
    assert simhash.keep_one_per_group(helpers.empty(spark)).count() == 0


def test_query_columns(spark):
    df = queries.op7_simhash(spark, "/root/testdata/sf0.001")
    assert df.columns == ["doc_id", "fingerprint", "component_id"]
