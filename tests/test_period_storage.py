"""Fact tables stored with their period number: layout, pushed cutoff, equal results."""

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from servelens.functions.scalar import within_horizon
from servelens.plans import reporting as R
from servelens.sources.tables import by_period


def _flows(spark):
    # period 5 holds half of the rows, the annual row 2023 counts as period 23
    n = F.col("id")
    period = F.when(n % 2 == 0, F.lit("Period 05")).when(n % 501 == 0, F.lit("2023")).otherwise(
        F.format_string("Period %02d", n % 19 + 1))
    return spark.range(6000).select(F.lit("S").alias("scenarioname"), period.alias("departingperiodname"),
                                    F.lit("R_1").alias("originname"), F.lit("I_1").alias("destinationname"),
                                    *[n.cast("double").alias(c) for c in ("flowquantity", "shipmentcost", "sourcingcost",
                                                                          "transportationcost")])


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_cutoff_reaches_the_scan_and_skips_files(spark, tmp_path):
    path = str(tmp_path / "flows")
    by_period(_flows(spark), "departingperiodname", 8).write.parquet(path)
    f = spark.read.parquet(path)
    plan = _plan(f.where(within_horizon(f, "departingperiodname", 12)).groupBy("scenarioname").agg(F.sum("flowquantity")))
    assert "LessThanOrEqual(period_no,12)" in plan and "departingperiodname" not in plan
    bounds = []
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.names.index("period_no")
        stats = [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
        bounds.append((min(s.min for s in stats), max(s.max for s in stats), meta.num_rows))
    assert sum(n for *_, n in bounds) == 6000
    assert any(low > 12 for low, *_ in bounds)          # a file that the cutoff skips unread
    assert sum(low <= 5 <= high for low, high, _ in bounds) >= 3   # the hot period lies in several files
    assert max(n for *_, n in bounds) < 2000


def test_results_equal_those_of_the_label(spark, tmp_path):
    path = str(tmp_path / "flows")
    flows = _flows(spark)
    by_period(flows, "departingperiodname", 8).write.parquet(path)
    stored = spark.read.parquet(path)
    customers = spark.createDataFrame([("I_1", "1", "81384", "Alpha")], "customername string, loccode string, corpcode string, corpname string")
    codes = spark.createDataFrame([("81384",)], "corp_code string")
    for horizon in (0, 5, 12, 23):
        for result in (lambda f: R.return_unit_cost(f, "S", horizon), lambda f: R.current_issue_cost(f, customers, codes, "S", horizon)):
            assert result(flows).collect() == result(stored).collect()


def test_null_labels_and_empty_tables(spark):
    rows = spark.createDataFrame([("Period 03", 1), (None, 2)], "periodname string, v int")
    assert {(r.v, r.period_no) for r in by_period(rows, "periodname", 2).collect()} == {(1, 3), (2, None)}
    kept = by_period(rows, "periodname", 2)
    assert [r.v for r in kept.where(within_horizon(kept, "periodname", 12)).collect()] == [1]
    assert [r.v for r in rows.where(within_horizon(rows, "periodname", 12)).collect()] == [1]
    assert by_period(rows.limit(0), "periodname", 2).count() == 0
