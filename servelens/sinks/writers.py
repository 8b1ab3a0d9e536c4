"""Writers (K1-K7).

Plain folders (reports, exports) are written beside their place and moved there
when the job has ended, so a failed job leaves the earlier folder as it was.
Tables that are read again are versioned (:mod:`servelens.sinks.snapshots`).
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from servelens import constants as K
from servelens.operators.core import null_safe_join, upsert_last_wins
from servelens.sinks.snapshots import publish


def write_snapshot(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Write a table as a plain folder (K1, K6, K7), replacing an earlier one.

    The job writes to a hidden folder beside ``path``; only when it has ended is
    the earlier folder moved aside (hidden, kept) and the new one moved in.
    ``df`` may read ``path``.
    """
    parent, _, name = path.rstrip("/").rpartition("/")
    ident = uuid.uuid4().hex
    staged = f"{parent}/.{name}-{ident}"
    w = df.write.mode("errorifexists").format(fmt)
    if fmt == "csv":
        w = w.option("header", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(staged)
    spark = df.sparkSession
    to_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = to_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(to_path(path)) and not fs.rename(to_path(path), to_path(f"{parent}/.{name}-before-{ident}")):
        raise OSError(f"cannot move {path} aside; the new rows are in {staged}")
    if not fs.rename(to_path(staged), to_path(path)):
        raise OSError(f"cannot move {staged} to {path}")
    spark.catalog.refreshByPath(path)


def to_wide(account_values: DataFrame, codes: Sequence[str], prefix: str = K.ACCOUNT_COLUMN_PREFIX,
            keys: Sequence[str] = K.CONSTRAINT_KEYS, as_text: bool = False, extra: Sequence[str] = ()) -> DataFrame:
    """Sparse long form -> one ``account_<code>`` column per account (K2, R2).

    ``codes`` is the list of account codes (the account list, small), so one
    aggregate with a column per code does the pivot: values are combined before the shuffle.  Accounts without their own value for a row
    get the shared value of that row.

    Constraint rows with equal keys match each other's adjusted values, and every
    match is a row of its own (the fan-out of the modelled join).  ``row_id`` and
    ``match_id`` (``build_account_constraints(..., row_ids=True)``) tell these rows
    apart; without them rows are told apart by ``constraintvalue`` and the order of
    the account's values, so that rows equal in both fan out once more.  ``extra``
    names further columns of the constraint table to keep.  For thousands of
    accounts see :mod:`servelens.sinks.wide`.
    """
    keys = list(keys)
    is_own = F.col("corp_code").isNotNull()
    if {"row_id", "match_id"} <= set(account_values.columns):
        on, own = ["row_id"], account_values.where(is_own)
    else:
        on = keys + ["constraintvalue"]
        w = Window.partitionBy(*on, "corp_code").orderBy("account_value")
        own = account_values.where(is_own).withColumn("match_id", F.row_number().over(w))
    shared = account_values.where(~is_own).select(
        *dict.fromkeys([*on, *keys, "constraintvalue", *extra]), F.col("account_value").alias("__shared"))
    # one value per (row, match, account): any aggregate gives it
    values = [F.max(F.when(F.col("corp_code") == c, F.col("account_value"))).alias(f"__own_{i}") for i, c in enumerate(codes)]
    # without accounts the matches still count
    wide = own.groupBy(*on, "match_id").agg(*(values or [F.count(F.lit(1)).alias("__own")])).drop("match_id", "__own")
    j = null_safe_join(shared, wide, on, "left")
    cols = [F.coalesce(F.col(f"__own_{i}"), F.col("__shared")).alias(prefix + c) for i, c in enumerate(codes)]
    if as_text:
        cols = [c.cast("string") for c in cols]
    return j.select(*keys, "constraintvalue", *extra, *cols)


def write_wide_constraints(account_values: DataFrame, codes: Sequence[str], path: str, fmt: str = "parquet",
                           as_text: bool = True) -> None:
    """The constraint table with the account columns added, as a plain folder (K2).

    The model altered the live table in place; :func:`publish_wide_constraints`
    adds a version to a versioned table instead (text values as the model stores
    them when ``as_text``)."""
    write_snapshot(to_wide(account_values, codes, as_text=as_text), path, fmt)


def publish_wide_constraints(account_values: DataFrame, codes: Sequence[str], root: str, as_text: bool = True,
                             extra: Sequence[str] = ()) -> int:
    """The same as a new version of the table in ``root``; earlier versions keep their account columns (K2)."""
    return publish(to_wide(account_values, codes, as_text=as_text, extra=extra), root)


def upsert_snapshot(existing: DataFrame, updates: DataFrame, keys: Sequence[str], path: str,
                    latest: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Update-else-insert on ``keys`` written as a plain folder (K3-K5);
    :func:`servelens.sinks.snapshots.upsert` rewrites only what is touched."""
    write_snapshot(upsert_last_wins(existing, updates, keys, latest), path, fmt)


def labelled(df: DataFrame, measures=K.SCENARIO_MEASURES, label_col: str = "scenarioname",
             label_name: str = "") -> DataFrame:
    """Rename measure columns to their report labels, in export order."""
    present = [(lab, name) for lab, name in measures if name in df.columns]
    lead = [F.col(label_col).alias(label_name or label_col)] if label_col else []
    others = [c for c in df.columns if c != label_col and c not in {n for _, n in present}]
    return df.select(*lead, *others, *[F.col(name).alias(lab) for lab, name in present])


def write_dated_report(df: DataFrame, out_dir: str, name: str, run_date: str | None = None,
                       fmt: str = "csv", measures=K.SCENARIO_MEASURES, label_col: str = "scenarioname") -> str:
    """Dated report (K6, K7): ``{out_dir}/{name}/run_date=YYYY-MM-DD``.

    ``run_date`` is a parameter (default today) so reruns of a day replace
    that day's report only."""
    run_date = run_date or _dt.date.today().isoformat()
    path = f"{out_dir}/{name}/run_date={run_date}"
    write_snapshot(labelled(df, measures, label_col), path, fmt)
    return path
