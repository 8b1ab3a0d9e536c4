import re
from collections import defaultdict

import helpers
from helpers import F
from servelens.llm import mixing


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def fill(sizes, weights=(5, 2, 1), most=3):
    """Targets by the plain rule: share, stop at the bound, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, open_ = {}, float(sum(sizes.values())), set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > most * sizes[s]}
        if not full:
            target |= {s: weight[s] * level for s in open_}
            break
        for s in full:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def check(df, near=0.02):
    rows, got = df.collect(), mixing.mix(df).collect()
    assert len(rows) == len(got)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += size_of(r.text)
    expect, taken = fill(dict(sizes)), defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert abs(r.target - expect[r.source]) <= 1e-6 * (1 + expect[r.source])
        assert r.taken == r.size * r.copies and 0 <= r.copies <= 3
        taken[r.source] += r.taken
    assert sorted(map(str, (r.doc_id for r in rows))) == sorted(map(str, (r.doc_id for r in got)))
    least = defaultdict(lambda: 10**9)
    for r in rows:
        least[r.source] = min(least[r.source], size_of(r.text) or 10**9)
    for s, t in expect.items():
        assert abs(taken[s] - t) <= near * t + 1, (s, taken[s], t)
    docs = mixing.mixed_documents(df)
    assert docs.columns == df.columns
    assert sum(size_of(r.text) for r in docs.collect()) == sum(taken.values())
    return got


def test_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    first = check(df)
    key = lambda r: r.doc_id
    again = mixing.mix(df.repartition(7)).collect()
    assert sorted(first, key=key) == sorted(again, key=key)
    other = mixing.mix(df, seed=18).collect()
    assert sorted(first, key=key) != sorted(other, key=key)


def test_hot_source_and_null_source(spark):
    texts = [f"{'w ' * (1 + i % 17)}x{i}" for i in range(600)]
    check(helpers.frame(spark, texts, ["hot" if i < 400 else None if i < 450 else f"s{i % 5}" for i in range(600)]), 0.03)


def test_inclusion_follows_the_fraction(spark):
    df = helpers.frame(spark, [f"a b c d {i}" for i in range(400)], ["a" if i % 4 else "b" for i in range(400)])
    n = sum(sum(r.copies for r in mixing.mix(df, seed=s).collect() if r.source == "a" and r.doc_id % 8 == 1) for s in range(3))
    r = mixing.mix(df).filter("source = 'a'").first()
    assert abs(n / 3 / 50 - r.target / r.source_size) < 0.2


def test_weight_column_makes_unequal_odds(spark):
    df = helpers.frame(spark, [f"a b c d {i}" for i in range(600)], ["a" if i % 2 else "b" for i in range(600)]).withColumn("q", F.when(F.col("doc_id") < 300, 0.2).otherwise(1.8))
    got = mixing.mix(df, weight="q").filter("source = 'b'").collect()
    low, high = sum(r.copies for r in got if r.doc_id < 300), sum(r.copies for r in got if r.doc_id >= 300)
    assert 4 * low < high and abs(sum(r.taken for r in got) - got[0].target) < 0.02 * got[0].target


def test_edges(spark):
    df = helpers.edge(spark).withColumn("u", F.lit("clash")).withColumn("size", F.lit(0)).withColumn("row", F.lit(1))
    check(df, near=10)
    assert mixing.mix(helpers.empty(spark)).count() == 0 and mixing.mixed_documents(helpers.empty(spark)).count() == 0
    blank = mixing.mix(helpers.frame(spark, [None, "", " "])).collect()
    assert [(r.size, r.taken, r.target) for r in blank] == [(0, 0, 0.0)] * 3


def plain_taken(rows, target, copies_wanted):
    """Sizes taken of one source by the plain rule: down the ranking, each unit that fits, at last the nearest.
    ``rows``: (order, size); equal orders are one unit."""
    units = defaultdict(int)
    for order, size in rows:
        units[order] += size
    gap, left, total = target - int(copies_wanted) * sum(units.values()), [], int(copies_wanted) * sum(units.values())
    for order in sorted(units):
        if units[order] <= gap + 0.5:
            gap, total = gap - units[order], total + units[order]
        else:
            left.append(units[order])
    nearest = min(left, key=lambda n: abs(n - gap), default=None)
    return total + (nearest if nearest is not None and abs(nearest - gap) < gap else 0)


def orders(df, source, wanted, seed=17):
    own = df.filter(F.col("source") == source).select(mixing._draw(F.col("doc_id"), F.col("text"), seed).alias("u"), mixing.word_count(F.col("text")).alias("size"))
    p = F.lit(wanted - int(wanted))
    return [(r.o, r.size) for r in own.select(mixing._order(F.col("u"), p).alias("o"), "size").collect() if r.size]


def test_a_very_long_document_leaves_the_target_reached(spark):
    """Source 'b' has one text of 20,000 words among 500 of 100; its target is below its words."""
    texts = ["w " * 99 + f"x{i}" for i in range(500)] + ["w " * 20_000] + ["w " * 99 + f"y{i}" for i in range(700)]
    df = helpers.frame(spark, texts, ["b"] * 501 + ["a"] * 700)
    for seed in (4, 7):  # draws that put the long one where it does not fit
        got = mixing.mix(df, seed=seed).filter("source = 'b'").collect()
        target, taken = got[0].target, sum(r.taken for r in got)
        assert abs(taken - target) <= 51, (seed, taken, target)
        wanted = target / got[0].source_size
        assert taken == plain_taken(orders(df, "b", wanted, seed), target, wanted)


def test_rounds_equal_the_plain_rule_on_mixed_sizes_and_repeated_rows(spark):
    texts = [f"x{i} " + "w " * int(1.6 ** (i % 19)) for i in range(300)]
    ids = list(range(300))
    for again in range(0, 300, 7):  # rows repeated one to five times
        texts += [texts[again]] * (1 + again % 5)
        ids += [again] * (1 + again % 5)
    df = helpers.frame(spark, texts, ["a" if i % 3 else "b" for i in ids], ids)
    for seed in (17, 5):
        got = mixing.mix(df, seed=seed).collect()
        for source in "ab":
            own = [r for r in got if r.source == source]
            wanted = own[0].target / own[0].source_size
            assert sum(r.taken for r in own) == plain_taken(orders(df, source, wanted, seed), own[0].target, wanted)
        copies = defaultdict(set)
        for r in got:
            copies[r.doc_id].add(r.copies)
        assert all(len(c) == 1 for c in copies.values())
        docs = mixing.mixed_documents(df, seed=seed).collect()
        assert sum(size_of(r.text) for r in docs) == sum(r.taken for r in got)


def test_the_cut_is_the_same_however_often_its_bin_is_binned_again(spark):
    df = helpers.frame(spark, [f"a b c d {i}" for i in range(400)], ["a" if i % 4 else "b" for i in range(400)])
    key = lambda r: r.doc_id
    assert sorted(mixing.mix(df).collect(), key=key) == sorted(mixing.mix(df, bins=4, exact=3).collect(), key=key)
