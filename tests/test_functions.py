from pyspark.sql import functions as F

from servelens.functions import scalar as X


def one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr.alias("v")).collect()]


def test_prefix_null_is_false_and_negation_keeps_null(spark):
    rows = [("R_A",), ("D_B",), (None,)]
    assert one(spark, X.starts("f", "R_"), rows, "f string") == [True, False, False]
    assert one(spark, X.not_starts("f", "R_"), rows, "f string") == [False, True, True]


def test_contains_anywhere_not_prefix(spark):
    rows = [("XI_1",), ("D_1",), (None,)]
    assert one(spark, X.has("f", "I_"), rows, "f string") == [True, False, False]


def test_not_equal_keeps_null(spark):
    rows = [("Depot",), ("D_1",), (None,)]
    assert one(spark, X.not_equal_keep_null("f", "Depot"), rows, "f string") == [False, True, True]


def test_period_numbers(spark):
    rows = [("Period 07",), ("2023",), ("Period 12",)]
    assert one(spark, X.period_no("p"), rows, "p string") == [7, 23, 12]
    assert one(spark, X.is_period_label("p"), rows, "p string") == [True, False, True]


def test_period_label_reproduces_three_digit_quirk(spark):
    rows = [(9,), (10,), (11,)]
    assert one(spark, X.period_label("n"), rows, "n int") == ["Period 09", "Period 010", "Period 011"]
    assert one(spark, X.period_label("n", two_digit=True), rows, "n int") == ["Period 09", "Period 10", "Period 11"]


def test_safe_div_and_least_strict(spark):
    rows = [(1.0, 0.0), (None, 2.0), (3.0, 2.0), (1.0, 5.0)]
    assert one(spark, X.safe_div("a", "b"), rows, "a double, b double") == [None, None, 1.5, 0.2]
    # python min(a, b): a NULL first argument wins, else the smaller
    assert one(spark, X.least_strict("a", "b"), rows, "a double, b double") == [0.0, None, 2.0, 1.0]


def test_rint_is_half_even(spark):
    rows = [(0.5,), (1.5,), (2.5,), (-0.5,)]
    assert one(spark, X.rint("x"), rows, "x double") == [0.0, 2.0, 2.0, -0.0]


def test_sum0_and_cond_sum(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1.0)], "k string, v double")
    r = {x.k: (x.s, x.c) for x in df.groupBy("k").agg(X.sum0("v").alias("s"),
                                                      X.cond_sum(F.col("v") > 5, F.col("v")).alias("c")).collect()}
    assert r == {"a": (0.0, None), "b": (1.0, None)}


def test_clean_text_and_drop_last(spark):
    rows = [("Corp 5 & Sons, Inc.",)]
    assert one(spark, X.clean_text("d"), rows, "d string") == ["Corp 5 And Sons Inc"]
    assert one(spark, X.drop_last_char("d"), rows, "d string") == ["Corp 5 & Sons, Inc"]


def test_split_part_out_of_range_is_null(spark):
    rows = [("R_N1_22",), ("R_X",)]
    assert one(spark, X.split_part("f", "_", 2), rows, "f string") == ["22", None]


def test_round_half_even_follows_python_round_on_binary_value(spark):
    x = 217.0 - 87.93968749999999          # 129.0603125 as text, slightly above it in binary
    got = one(spark, X.round_half_even("x", 6), [(x,), (2.5,), (0.125,)], "x double")
    assert got[0] == round(x, 6) == 129.060313
    assert one(spark, X.round_half_even("x", 0), [(2.5,)], "x double") == [2.0]
    assert one(spark, X.round_half_even("x", 2), [(0.125,)], "x double") == [round(0.125, 2)]
