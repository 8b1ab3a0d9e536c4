import os

import pytest
from pyspark.sql import functions as F

from servelens import constants as K
from servelens.plans.constraints import transfer_matrix
from servelens.sinks import writers as W
from servelens.sources import tables as T

HEADER = ",".join(K.TRANSFER_HEADERS)


def _write_months(folder, n):
    os.makedirs(folder, exist_ok=True)
    for m in range(1, n + 1):
        with open(os.path.join(folder, f"month_{m:02d}.csv"), "w") as f:
            f.write(HEADER + "\n")
            f.write(f"81384,Alpha,101,Loc 101,00001,Corp 1,{m}.0\n")
            f.write(f"81399,Beta,102,Loc 102,00002,Corp 2,{2 * m}.0\n")
            f.write(f",Nobody,103,Loc 103,00003,Corp 3,1.0\n")      # NULL key: dropped


@pytest.mark.parametrize("n", [11, 13])
def test_monthly_guard_rejects_wrong_file_count(spark, tmp_path, n):
    d = str(tmp_path / "tm")
    _write_months(d, n)
    with pytest.raises(ValueError):
        T.read_monthly_files(spark, d)


def test_monthly_files_union_and_sum(spark, tmp_path):
    d = str(tmp_path / "tm")
    _write_months(d, 12)
    df = T.read_monthly_files(spark, d)
    tm = {r.renter_corp_code: r.return_volume
          for r in transfer_matrix(df).collect()}
    assert dict(df.dtypes)["return_volume"] == "double"
    assert tm == {"81384": 78.0, "81399": 156.0}


def test_streaming_matrix_equals_batch(spark, tmp_path):
    from servelens.streaming.transfers import run_transfer_matrix
    d = str(tmp_path / "tm")
    _write_months(d, 12)
    q = run_transfer_matrix(spark, d, str(tmp_path / "out"), str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    got = {r.renter_corp_code: r.return_volume for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {"81384": 78.0, "81399": 156.0}


def test_drop_id_and_load_tables(spark, tmp_path):
    p = str(tmp_path / "db")
    spark.createDataFrame([(1, "a")], "id int, customername string").write.parquet(p + "/customers")
    t = T.load_tables(spark, p, ["customers"])
    assert t["customers"].columns == ["customername"]
    with pytest.raises(Exception):
        T.load_tables(spark, p, ["missing"])


def test_wide_snapshot_and_upsert_round_trip(spark, tmp_path):
    keys = list(K.CONSTRAINT_KEYS)
    null = F.lit(None).cast("string")
    base = spark.range(2).select(*[(F.concat(F.lit("F"), F.col("id").cast("string")) if k == "facilityname" else null)
                                   .alias(k) for k in keys], F.lit(10.0).alias("constraintvalue"))
    shared = base.select(*keys, "constraintvalue", null.alias("corp_code"), F.col("constraintvalue").alias("account_value"))
    own = base.where(F.col("facilityname") == "F0").select(*keys, "constraintvalue", F.lit("001").alias("corp_code"),
                                                           F.lit(4.0).alias("account_value"))
    path = str(tmp_path / "wide")
    W.write_wide_constraints(shared.unionByName(own), ["001", "002"], path, as_text=False)
    back = {r.facilityname: (r.account_001, r.account_002) for r in spark.read.parquet(path).collect()}
    assert back == {"F0": (4.0, 10.0), "F1": (10.0, 10.0)}
    ex = spark.createDataFrame([("s", "a")], "scenarioname string, status string")
    W.upsert_snapshot(ex, spark.createDataFrame([("s", "b"), ("t", "c")], "scenarioname string, status string"),
                      ["scenarioname"], str(tmp_path / "snap"))
    assert sorted(spark.read.parquet(str(tmp_path / "snap")).collect()) == [("s", "b"), ("t", "c")]


def test_wide_pivot_keeps_every_value_of_rows_with_equal_keys(spark):
    keys = list(K.CONSTRAINT_KEYS)
    rows = [(0, None, 10.0, None, 10.0), (1, None, 30.0, None, 30.0)]
    rows += [(row, match, cv, "001", value) for row, cv in ((0, 10.0), (1, 30.0)) for match, value in ((0, 4.0), (1, 24.0))]
    df = spark.createDataFrame(rows, "row_id long, match_id long, constraintvalue double, corp_code string, account_value double")
    df = df.select("*", *[F.lit("F0" if k == "facilityname" else None).cast("string").alias(k) for k in keys])
    expected = [(10.0, 4.0, 10.0), (10.0, 24.0, 10.0), (30.0, 4.0, 30.0), (30.0, 24.0, 30.0)]
    for given in (df, df.drop("row_id", "match_id")):
        wide = W.to_wide(given, ["001", "002"])
        assert wide.columns == [*keys, "constraintvalue", "account_001", "account_002"]
        assert sorted((r.constraintvalue, r.account_001, r.account_002) for r in wide.collect()) == expected
    # rows equal in keys and value stay apart by their id
    same = df.withColumn("constraintvalue", F.lit(10.0))
    assert W.to_wide(same, ["001", "002"]).count() == 4


def test_dated_report_uses_labels(spark, tmp_path):
    df = spark.createDataFrame([("S1", 1.0, 2.0)], "scenarioname string, issues double, returns double")
    path = W.write_dated_report(df, str(tmp_path), "scenario_data", run_date="2024-01-31")
    assert path.endswith("scenario_data/run_date=2024-01-31")
    back = spark.read.option("header", "true").csv(path)
    assert back.columns == ["scenarioname", "Issues", "Returns"]
