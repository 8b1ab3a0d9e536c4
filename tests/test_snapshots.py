"""Versioned tables, column-preserving upserts, guarded appends, whole-table numbering, monthly files by name."""

import os

import pytest
from pyspark.sql import functions as F

from servelens import constants as K
from servelens.operators import core as O
from servelens.plans import scenarios as S
from servelens.plans.constraints import transfer_matrix
from servelens.sinks import snapshots as V
from servelens.sinks import writers as W
from servelens.sources import tables as T


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


def files(root):
    return {os.path.relpath(os.path.join(d, f), root) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


# --- merge of columns -------------------------------------------------------

def test_update_keeps_columns_it_does_not_carry(spark):
    stored = spark.createDataFrame([("a", 1, "keep"), ("b", 2, "b")], "k string, v int, notes string")
    out = O.upsert_last_wins(stored, spark.createDataFrame([("a", 9)], "k string, v int"), ["k"])
    assert out.columns == ["k", "v", "notes"]
    assert rows(out) == [("a", 9, "keep"), ("b", 2, "b")]


def test_null_that_an_update_carries_is_written(spark):
    stored = spark.createDataFrame([("a", 1, "old")], "k string, v int, notes string")
    out = O.upsert_last_wins(stored, spark.createDataFrame([("a", None)], "k string, notes string"), ["k"])
    assert rows(out) == [("a", 1, None)]


def test_several_updates_are_merged_column_by_column(spark):
    stored = spark.createDataFrame([("a", 1, "n0")], "k string, v int, notes string")
    first = spark.createDataFrame([("a", 2, "x"), ("c", 5, "y")], "k string, v int, extra string")
    second = spark.createDataFrame([("a", "n2", 1), ("a", "n1", 0), ("d", None, 0)], "k string, notes string, at int")
    out = O.upsert_last_wins(stored, [first, second], ["k"], ["at"])
    assert rows(out, "k", "v", "notes", "extra", "at") == [("a", 2, "n2", "x", 1), ("c", 5, None, "y", None), ("d", None, None, None, 0)]
    again = O.upsert_last_wins(out, [first, second], ["k"], ["at"])
    assert rows(again.select(*out.columns)) == rows(out)


def test_null_keys_are_equal_and_untouched_rows_stay_as_they_are(spark):
    stored = spark.createDataFrame([(None, 1, 1), ("z", 1, 1), ("z", 1, 1), ("z", 2, 2)], "k string, v int, w int")
    out = O.upsert_last_wins(stored, spark.createDataFrame([(None, 7)], "k string, v int"), ["k"])
    assert rows(out) == sorted([(None, 7, 1), ("z", 1, 1), ("z", 1, 1), ("z", 2, 2)], key=repr)


# --- first wins -------------------------------------------------------------

def test_stored_duplicates_of_a_registered_key_collapse_to_the_first(spark):
    schema = ", ".join(f"{c} string" for c in S.SCENARIO_COLS)
    name = K.LESS_SCENARIO_PREFIX + "1"
    stored = spark.createDataFrame([(name, "Include", None, None, "second", None), (name, "Include", None, None, "first", None),
                                    ("other", "x", None, None, "1", None), ("other", "x", None, None, "2", None)], schema)
    out = S.build_scenarios(stored, spark.createDataFrame([("1",), ("2",)], "corp_code string"))
    assert rows(out, "scenarioname", "notes") == sorted([(name, "first"), (K.LESS_SCENARIO_PREFIX + "2", None), ("other", "1"), ("other", "2")], key=repr)
    ordered = spark.createDataFrame([("k", 2, "late"), ("k", 1, "early")], "k string, at int, v string")
    new = spark.createDataFrame([("k", 0, "new")], "k string, at int, v string")
    assert rows(O.first_wins(ordered, new, ["k"], [("at", True)]), "v") == [("early",)]
    assert rows(O.first_wins(ordered, new, ["k"], [("at", False)]), "v") == [("late",)]


# --- guarded append ---------------------------------------------------------

def test_append_guard_raises_above_the_limit_and_warns(spark):
    target = spark.createDataFrame([(i, "base" if i else "none") for i in range(3)], "t int, k string")
    source = spark.createDataFrame([("base", i) for i in range(4)], "k string, s int")
    assert O.append_guarded(target, source, ["k"], 4).count() == 8
    with pytest.raises(Exception, match="4 rows for one key, at most 3 are allowed"):
        O.append_guarded(target, source, ["k"], 3).collect()
    with pytest.raises(Exception, match="at most 3"):
        O.append_guarded(target, source, ["k"], 3).count()
    warned = O.append_guarded(target, source, ["k"], 3, "warn", "left")
    assert rows(warned, "t", "s", "over_limit") == sorted([(0, None, False), *[(t, s, True) for t in (1, 2) for s in range(4)]], key=repr)
    # a key that no target row meets does not count
    assert O.append_guarded(target.where("k = 'none'"), source, ["k"], 1).count() == 0
    with pytest.raises(ValueError):
        O.append_guarded(target, source, ["k"], 3, "ignore")


# --- numbering --------------------------------------------------------------

def test_whole_table_is_numbered_without_one_task(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("a"), (F.col("id") % 3).cast("string").alias("b")).repartition(7)
    df = df.union(spark.createDataFrame([(None, "n"), (None, None)], "a long, b string"))
    out = O.number_rows(df, [F.col("b").desc_nulls_last(), F.col("a").asc_nulls_first()], start=5)
    from pyspark.sql import Window
    want = df.withColumn("RecordID", F.row_number().over(Window.orderBy(F.col("b").desc_nulls_last(), F.col("a").asc_nulls_first())) + 4)
    assert rows(out) == rows(want)
    assert out.schema["RecordID"].dataType.simpleString() == "bigint"
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
    assert O.number_rows(df.where("false"), [F.col("a")]).collect() == []


# --- versioned tables -------------------------------------------------------

def test_versions_stay_readable_and_columns_evolve(spark, tmp_path):
    root = str(tmp_path / "t")
    assert not V.exists(spark, root)
    with pytest.raises(FileNotFoundError):
        V.read(spark, root)
    assert V.publish(spark.createDataFrame([("a", 1)], "k string, account_1 int"), root) == 1
    assert V.publish(V.read(spark, root).withColumn("account_2", F.lit(2)).drop("account_1"), root) == 2
    assert V.read(spark, root).columns == ["k", "account_2"] and rows(V.read(spark, root, 1)) == [("a", 1)]
    assert V.publish(V.read(spark, root).where("false"), root) == 3
    assert V.read(spark, root).collect() == [] and V.versions(spark, root) == [1, 2, 3]


def test_a_job_that_fails_mid_write_leaves_the_table_as_it_was(spark, tmp_path):
    root, plain = str(tmp_path / "t"), str(tmp_path / "plain")
    good = spark.createDataFrame([(str(i), i) for i in range(50)], "k string, v long")
    V.publish(good, root, ["k"], 4)
    W.write_snapshot(good, plain)
    bad = spark.range(100).repartition(4).select(F.col("id").cast("string").alias("k"), F.when(F.col("id") == 99, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")).alias("v"))
    for fail in (lambda: V.publish(bad, root, ["k"], 4), lambda: V.upsert(bad, root), lambda: W.write_snapshot(bad, plain)):
        with pytest.raises(Exception, match="lost"):
            fail()
    assert V.versions(spark, root) == [1] and rows(V.read(spark, root)) == rows(good) == rows(spark.read.parquet(plain))
    assert V.publish(good.limit(3), root, ["k"], 4) == 2
    W.write_snapshot(spark.read.parquet(plain).where("v < 3"), plain)  # reads the folder that it replaces
    assert spark.read.parquet(plain).count() == 3


def test_two_writers_of_one_version(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    V.publish(df, root)
    entry = V.describe(spark, root)
    with pytest.raises(RuntimeError, match="another writer"):
        V._publish(spark, root, entry)


def test_upsert_rewrites_only_the_touched_partition(spark, tmp_path):
    root = str(tmp_path / "t")
    stored = spark.createDataFrame([(str(i), i, "n") for i in range(200)], "k string, v int, notes string")
    V.publish(stored, root, ["k"], 8)
    before, folders = files(root), V.describe(spark, root)["parts"]
    update = spark.createDataFrame([("17", -1)], "k string, v int")
    assert V.upsert(update, root) == 2
    new, parts = files(root) - before, V.describe(spark, root)["parts"]
    assert before < files(root) and len({os.path.dirname(f) for f in new}) == 1
    assert sum(folders[p] != parts[p] for p in folders) == 1
    assert rows(V.read(spark, root)) == rows(O.upsert_last_wins(stored, update, ["k"]))
    assert rows(V.read(spark, root, 1)) == rows(stored)
    # a new column and a new key
    V.upsert([spark.createDataFrame([("new", 5.0)], "k string, price double"), spark.createDataFrame([("18", None)], "k string, notes string")], root)
    got = {r.k: r for r in V.read(spark, root).collect()}
    assert (got["new"].price, got["new"].v, got["18"].notes, got["18"].v, got["17"].v, got["17"].price) == (5.0, None, None, 18, -1, None)
    assert len(got) == 201
    assert V.upsert(update.where("false"), root) == 3


def test_load_tables_reads_the_latest_version(spark, tmp_path):
    V.publish(spark.createDataFrame([(1, "a")], "id int, customername string"), str(tmp_path / "customers"))
    V.publish(spark.createDataFrame([(1, "b")], "id int, customername string"), str(tmp_path / "customers"))
    assert rows(T.load_tables(spark, str(tmp_path), ["customers"])["customers"]) == [("b",)]


# --- monthly files ----------------------------------------------------------

def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write(text)


def test_monthly_files_with_moved_missing_and_extra_columns(spark, tmp_path):
    d = str(tmp_path / "months")
    heads = list(K.TRANSFER_HEADERS)
    write(d, "01.csv", ",".join(heads) + "\n1,A,L,Loc,C,Corp,1.5\n")
    write(d, "02.csv", ",".join(heads[::-1]) + "\n2.5,Corp,C,Loc,L,A,1\n")
    write(d, "03.csv", ",".join([*heads[:5], heads[6], "Extra"]) + '\n1,"A, B",L,Loc,C,4,x\n')
    write(d, "04.csv", "")
    write(d, "05.csv", "﻿" + ",".join(heads) + "\n")
    df = T.read_monthly_files(spark, d, expected=5)
    assert rows(df, "renter_corp_code", "renter_corp_desc", "return_corp_desc", "return_volume", "Extra") == sorted(
        [("1", "A", "Corp", 1.5, None), ("1", "A", "Corp", 2.5, None), ("1", "A, B", None, 4.0, "x")], key=repr)
    assert [(r.renter_corp_code, r.return_volume) for r in transfer_matrix(df).collect()] == [("1", 4.0)]
    with pytest.raises(ValueError, match="expected|must hold 12"):
        T.read_monthly_files(spark, d)
    write(d, "06.csv", "Return Volume,Return Volume\n1,2\n")
    with pytest.raises(ValueError, match="twice"):
        T.read_monthly_files(spark, d, expected=6)


def test_monthly_parquet_files_are_united_by_name(spark, tmp_path):
    d = str(tmp_path / "p")
    spark.createDataFrame([("1", 1.0)], "`Renter Corp Code` string, `Return Volume` double").coalesce(1).write.parquet(d + "/m1")
    spark.createDataFrame([(2.0, "2", "x")], "`Return Volume` double, `Renter Corp Code` string, `New` string").coalesce(1).write.parquet(d + "/m2")
    df = T.read_monthly_files(spark, d, "parquet", 2)
    assert rows(df, "renter_corp_code", "return_volume", "New") == [("1", 1.0, None), ("2", 2.0, "x")]


def test_account_list(spark, tmp_path):
    d = str(tmp_path / "accounts")
    write(d, "list.csv", ",".join(K.ACCOUNT_HEADERS) + "\n00081,Alpha,Y,Models\\Base\\,\n")
    r = T.read_account_list(spark, d).first()
    assert (r.corp_code, r.corp_desc, r.evaluate, r.account_model) == ("00081", "Alpha", "Y", None)
