from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from servelens.operators import core as O


def test_null_safe_join_matches_null_keys(spark):
    left = spark.createDataFrame([("a", None, 1.0), ("b", "x", 2.0)], "k1 string, k2 string, v double")
    right = spark.createDataFrame([("a", None, 10.0), ("b", None, 20.0)], "k1 string, k2 string, w double")
    out = sorted(O.null_safe_join(left, right, ["k1", "k2"], "left").collect())
    assert [(r.k1, r.k2, r.v, r.w) for r in out] == [("a", None, 1.0, 10.0), ("b", "x", 2.0, None)]


def test_null_safe_join_fans_out_on_duplicates(spark):
    left = spark.createDataFrame([("a", 1.0)], "k string, v double")
    right = spark.createDataFrame([("a", 1.0), ("a", 2.0)], "k string, w double")
    assert O.null_safe_join(left, right, ["k"], "left").count() == 2


def _loop(rows):
    out, prev = [], None
    for p, init, net in rows:
        if init > 0:
            b = init
        else:
            b = prev[0] + prev[1]
        out.append(b)
        prev = (b, net)
    return out


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([0.0, 0.0, 5.0, 100.0]), st.integers(-50, 50)), min_size=1, max_size=8))
def test_carry_forward_equals_sequential_loop(spark, data):
    rows = [(f"P{i:02d}", float(data[0][0] or 7.0) if i == 0 else d[0], float(d[1])) for i, d in enumerate(data)]
    df = spark.createDataFrame(rows, "p string, init double, net double")
    got = [r.b for r in O.carry_forward(df, "p", "init", "net", name="b").orderBy("p").collect()]
    assert got == _loop(rows)


def test_carry_forward_without_opening_balance_raises(spark):
    import pytest
    df = spark.createDataFrame([("P01", 0.0, 1.0), ("P02", 5.0, 1.0)], "p string, init double, net double")
    with pytest.raises(Exception):
        O.carry_forward(df, "p", "init", "net").collect()


def test_top_with_ties_keeps_ties_ignores_null(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 9.0), (3, 9.0), (4, None)], "k int, g double")
    assert sorted(r.k for r in O.top_with_ties(df, "g").collect()) == [2, 3]


def test_expand_back_guards_zero(spark):
    df = spark.createDataFrame([(1, 0), (2, 3)], "k int, n int")
    assert sorted((r.k, r.j) for r in O.expand_back(df, F.col("n")).collect()) == [(2, 1), (2, 2), (2, 3)]


def test_insert_if_absent_twice_adds_nothing(spark):
    ex = spark.createDataFrame([("s1", "old")], "k string, v string")
    new = spark.createDataFrame([("s1", "new"), ("s2", "new")], "k string, v string")
    once = O.insert_if_absent(ex, new, ["k"])
    twice = O.insert_if_absent(once, new, ["k"])
    assert sorted(once.collect()) == sorted(twice.collect()) == [("s1", "old"), ("s2", "new")]


def test_upsert_last_wins(spark):
    ex = spark.createDataFrame([("s", "i", 1), ("s", "j", 2)], "s string, i string, o long")
    up = spark.createDataFrame([("s", "i", 7), ("t", "i", 3)], "s string, i string, o long")
    got = sorted(O.upsert_last_wins(ex, up, ["s", "i"]).collect())
    assert got == [("s", "i", 7), ("s", "j", 2), ("t", "i", 3)]
    again = sorted(O.upsert_last_wins(O.upsert_last_wins(ex, up, ["s", "i"]), up, ["s", "i"]).collect())
    assert again == got


def test_share_of_total(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 0.0)], "k string, v double")
    got = sorted((r.k, r.share) for r in O.share_of_total(df, ["k"], "v").collect())
    assert got == [("a", 0.25), ("a", 0.75), ("b", None)]


def test_pivot_unpivot_round_trip(spark):
    long = spark.createDataFrame([("r1", "001", 1.0), ("r1", "002", 2.0), ("r2", "001", 3.0)],
                                 "rid string, corp_code string, account_value double")
    wide = O.pivot_prefixed(long, ["rid"], ["001", "002"], "account_")
    assert set(wide.columns) == {"rid", "account_001", "account_002"}
    back = O.unpivot_prefixed(wide, ["rid"], "account_").where(F.col("account_value").isNotNull())
    assert sorted(back.collect()) == sorted(long.collect())


def test_substring_lookup_equality_and_contains(spark):
    t = spark.createDataFrame([("I_X_12",), ("I_X_1",), ("Z",)], "name string")
    s = spark.createDataFrame([("I_X_1", "A"), ("I_X_12", "B")], "name string, code string")
    eq = dict((r.name, r.code) for r in O.substring_lookup(t, s, "name", "name", ["code"]).collect())
    assert eq == {"I_X_12": "B", "I_X_1": "A", "Z": None}
    cont = dict((r.name, r.code) for r in O.substring_lookup(t, s, "name", "name", ["code"], contains=True).collect())
    assert cont == {"I_X_12": "B", "I_X_1": "A", "Z": None}


def test_substring_lookup_has_no_size_bound_and_defined_edges(spark):
    t = spark.createDataFrame([("to I_12 dock",), ("to I_12 dock",), ("none",), ("",), (None,)], "name string")
    s = spark.createDataFrame([("I_1", "A"), ("I_12", None), ("I_12", "C"), ("to I", "B"), (None, "N")], "name string, code string")
    spark.conf.set("servelens.broadcast.maxRows", "0")
    try:
        found = O.substring_lookup(t, s, "name", "name", ["code"], contains=True)
        rows = sorted(((r.name, r.code) for r in found.collect()), key=str)
    finally:
        spark.conf.unset("servelens.broadcast.maxRows")
    # "I_12" and "to I" are equally long: the smallest appended value wins
    assert rows == sorted([("to I_12 dock", "B"), ("to I_12 dock", "B"), ("none", None), ("", None), (None, None)], key=str)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Cross" not in plan and "Cartesian" not in found._jdf.queryExecution().executedPlan().toString()
    none = O.substring_lookup(t, s.where("false"), "name", "name", ["code"], contains=True)
    assert [r.code for r in none.collect()] == [None] * 5
    empty_name = spark.createDataFrame([("", "E")], "name string, code string")
    anywhere = O.substring_lookup(t, empty_name, "name", "name", ["code"], contains=True)
    assert sorted((r.name is None, r.code) for r in anywhere.collect() if r.name is not None) == [(False, "E")] * 4


def test_first_by_and_union_ordered(spark):
    a = spark.createDataFrame([("k", "first")], "k string, v string")
    b = spark.createDataFrame([("k", "second", 1)], "k string, v string, extra int")
    u = O.union_ordered(a, b)
    assert set(u.columns) == {"k", "v", "extra", "__priority"}
    assert O.first_by(u, ["k"], [F.col("__priority")]).collect()[0].v == "first"
