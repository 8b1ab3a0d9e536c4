"""What the per-account steps shuffle and store."""

import datetime as dt

from pyspark.sql import functions as F

from servelens import constants as K
from servelens.operators.core import null_safe_join
from servelens.plans import constraints as C
from servelens.sinks import snapshots, wide
from servelens.sinks.writers import to_wide
from servelens.sources import bindings as B

from mini_model import build

KEYS = list(K.CONSTRAINT_KEYS)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*(cols or sorted(df.columns))).collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString().splitlines()


def values(spark, constraints=None, **kw):
    m = build(spark)
    sel = C.select_accounts(m["accounts"], m["demand"], m["customers"])
    return sel, C.build_account_constraints(m["constraints"] if constraints is None else constraints, m["demand"], m["customers"],
                                            m["inventory_policies"], m["periods"], m["transfers"], sel, row_ids=True, **kw)


def test_account_rows_are_not_joined_to_the_constraints_again(spark):
    _, acv = values(spark, persist=False)
    own = acv.where(F.col("corp_code").isNotNull())
    assert own.count() > 0
    assert not [x for x in plan(own) if "Join" in x and ("o_id" in x or "row_id" in x)]


def test_rows_with_equal_keys_take_each_others_values(spark):
    pc = build(spark)["constraints"]
    twin = pc.where("facilityname = 'R_US_101' and productname = 'WIP'").withColumn("constraintvalue", F.lit(70.0))
    _, acv = values(spark, pc.unionByName(twin))
    own = acv.where("facilityname = 'R_US_101' and productname = 'WIP' and corp_code = '81384'")
    got = own.groupBy("row_id").agg(F.countDistinct("match_id").alias("n"), F.first("constraintvalue").alias("cv")).collect()
    assert sorted((r.cv, r.n) for r in got) == [(70.0, 2), (100.0, 2)]


def test_wide_table_takes_one_aggregate(spark):
    sel, acv = values(spark)
    codes = sorted(r.corp_code for r in sel.select("corp_code").distinct().collect())
    assert len([x for x in plan(to_wide(acv, codes)) if "Aggregate" in x]) == 1
    none = to_wide(acv, [])
    assert none.columns == [*KEYS, "constraintvalue"] and none.count() == to_wide(acv, codes).count()


def test_blocks_hold_own_values_only(spark, tmp_path):
    sel, acv = values(spark)
    wide.publish_blocks(acv, sel, str(tmp_path))
    stored = snapshots.read(spark, f"{tmp_path}/blocks").select(F.sum(F.size("values"))).first()[0]
    assert stored == acv.where(F.col("corp_code").isNotNull()).count()


def test_packed_join_keeps_columns_and_null_keys(spark):
    left = spark.createDataFrame([("a", None, 1, 5), (None, "b", 2, 6), ("c", "c", 3, 7)], "k1 string, k2 string, `v.x` int, w int")
    right = spark.createDataFrame([(None, "b", 20, 0), ("a", None, 10, 0)], "k1 string, k2 string, z int, w int")
    got = null_safe_join(left, right, ["k1", "k2"], "left", packed=True)
    assert got.columns == ["k1", "k2", "v.x", "w", "z"]
    assert rows(got, "k1", "k2", "`v.x`", "w", "z") == [("a", None, 1, 5, 10), ("c", "c", 3, 7, None), (None, "b", 2, 6, 20)]
    # the keys are sent once, in the struct
    below = [x for x in plan(got) if "Project" in x and "AS __k#" in x]
    assert below and all("k1#" not in x.partition("AS __k#")[2] for x in below)


def test_line_views_are_the_same_from_written_lines(spark, tmp_path):
    day = dt.date(1995, 3, 4)
    d = str(tmp_path)
    lines = [(k, 1 + k % 3, s, 1, float(k), 1000.0 + k, 0.04, 0.02, "R" if k % 2 else "N", "O" if k % 3 else "F", day.replace(month=1 + k % 12))
             for k in range(1, 9) for s in (1, 2, None)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate date").write.parquet(f"{d}/lineitem.parquet")
    orders = [(k, 10 + k, p, day, 5000.0) for k, p in zip(range(1, 8), ["1-URGENT", "2-HIGH", "3-MEDIUM", None, "5-LOW", "2-HIGH", "2-HIGH"])]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderpriority string, o_orderdate date, o_totalprice double").write.parquet(
        f"{d}/orders.parquet")
    spark.createDataFrame([(1, 7, 3.0), (2, 8, 4.0), (2, 8, 4.0)], "s_suppkey long, s_nationkey int, s_acctbal double").write.parquet(f"{d}/supplier.parquet")
    spark.createDataFrame([(1, "SMALL"), (2, "LARGE")], "p_partkey long, p_type string").write.parquet(f"{d}/part.parquet")
    written = B.shared_lines(spark, d)
    for name in B.LINE_VIEWS:
        got = rows(B.view(spark, d, name, written))
        assert got and got == rows(B.view(spark, d, name)), name
    for name in B.LINE_VIEWS:
        B.view(spark, d, name).write.parquet(f"{d}/{name}.parquet")
    assert B.shared_lines(spark, d) is None


def test_origin_is_decided_before_the_orders_join(spark, tmp_path):
    test_line_views_are_the_same_from_written_lines(spark, tmp_path)
    found = plan(B.flows(spark, str(tmp_path)).where(F.col("originname").contains("R_")))
    # the outermost join is the one with the orders; the origin is compared in the one below it
    joins = [x for x in found if "Join" in x]
    assert "o_orderkey" in joins[0] and "s_suppkey" in joins[1] and "R_" in joins[1] and "R_" not in joins[0]
