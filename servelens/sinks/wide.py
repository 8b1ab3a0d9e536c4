"""The constraint table with one value per account, for any number of accounts (K2, R2).

A column per account has a limit: a plan with thousands of pivot expressions, and
a driver that must name them.  Here an account is a position and the table is
stored as three versioned tables::

    <root>/accounts   code, position                      (the account list)
    <root>/rows       constraint rows with the value that accounts share
    <root>/blocks     row, block, values: the own values of ``block`` positions

One aggregate fills a map (place in the block -> value) per row and block; an account without a
value of its own has no entry there and a block without any own value is not stored.  Columns are
made only when the table is read, for the accounts asked for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from servelens import constants as K
from servelens.operators.core import number_rows
from servelens.sinks import snapshots

BLOCK = 256
IDS = ("row_id", "match_id")


def publish_blocks(account_values: DataFrame, accounts: DataFrame, root: str, keys: Sequence[str] = K.CONSTRAINT_KEYS,
                   extra: Sequence[str] = (), block: int = BLOCK) -> None:
    """Store per-account values (``build_account_constraints(..., row_ids=True)``) of the ``corp_code`` s of ``accounts``."""
    codes = number_rows(accounts.select("corp_code").where(F.col("corp_code").isNotNull()).distinct(), [F.col("corp_code")],
                        name="position", start=0)
    snapshots.publish(codes, f"{root}/accounts")
    codes = snapshots.read(account_values.sparkSession, f"{root}/accounts")
    is_own = F.col("corp_code").isNotNull()
    own = account_values.where(is_own).select(*IDS, "corp_code", "account_value").join(codes, "corp_code")
    place = F.struct((F.col("position") % block).cast("int").alias("at"), F.col("account_value").alias("value"))
    # several values of one account for a match are equal: any will do
    filled = own.groupBy(*IDS, F.floor(F.col("position") / block).cast("int").alias("block")).agg(F.collect_set(place).alias("own"))
    ordered = filled.withColumn("own", F.array_sort("own"))
    values = F.map_from_entries(F.filter("own", lambda x, i: (i == 0) | (x["at"] != F.get("own", i - 1)["at"])))
    snapshots.publish(ordered.select(*IDS, "block", values.alias("values")).repartitionByRange("block", *IDS).sortWithinPartitions("block", *IDS),
                      f"{root}/blocks")
    matches = own.select(*IDS).distinct()
    rows = account_values.where(~is_own).select("row_id", *keys, "constraintvalue", *extra, F.col("account_value").alias("shared_value"))
    snapshots.publish(rows.join(matches, "row_id", "left"), f"{root}/rows")


def _same_row(left: DataFrame, right: DataFrame):
    return left["row_id"].eqNullSafe(right["__row"]) & left["match_id"].eqNullSafe(right["__match"])


def _blocks(spark: SparkSession, root: str) -> DataFrame:
    return snapshots.read(spark, f"{root}/blocks").withColumnsRenamed({"row_id": "__row", "match_id": "__match"})


def read_accounts(spark: SparkSession, root: str, codes: Sequence[str], prefix: str = K.ACCOUNT_COLUMN_PREFIX, as_text: bool = False,
                  block: int = BLOCK) -> DataFrame:
    """The constraint rows with a column ``<prefix><code>`` for each of ``codes``; only their blocks are read."""
    rows = snapshots.read(spark, f"{root}/rows")
    known = {r.corp_code: r.position for r in snapshots.read(spark, f"{root}/accounts").where(F.col("corp_code").isin(list(codes))).collect()}
    missing = [c for c in codes if c not in known]
    if missing:
        raise KeyError(f"no such accounts: {missing[:5]}")
    wanted = sorted({p // block for p in known.values()})
    blocks = _blocks(spark, root).where(F.col("block").isin(wanted))
    held = blocks.groupBy("__row", "__match").agg(F.map_from_entries(F.collect_list(F.struct("block", "values"))).alias("__held"))
    joined = rows.join(held, _same_row(rows, held), "left")
    cols = []
    for c in codes:
        own = F.try_element_at(F.try_element_at("__held", F.lit(known[c] // block).cast("int")), F.lit(known[c] % block).cast("int"))
        value = F.coalesce(own, F.col("shared_value"))
        cols.append((value.cast("string") if as_text else value).alias(prefix + c))
    return joined.select(*[c for c in rows.columns if c not in (*IDS, "shared_value")], *cols)


def unpivot_accounts(spark: SparkSession, root: str, block: int = BLOCK) -> DataFrame:
    """A row per constraint row and account (``corp_code``, ``account_value``), as unpivoting all columns would give."""
    rows, codes = snapshots.read(spark, f"{root}/rows"), snapshots.read(spark, f"{root}/accounts")
    # a row per account: its block and place; every constraint row meets each block once
    places = codes.groupBy(F.floor(F.col("position") / block).cast("int").alias("block")).agg(
        F.collect_list(F.struct("corp_code", (F.col("position") % block).cast("int").alias("at"))).alias("held"))
    n_blocks = F.coalesce(codes.agg(F.ceil(F.count(F.lit(1)) / block)).scalar().cast("int"), F.lit(0))
    each = rows.select("*", F.explode(F.when(n_blocks > 0, F.sequence(F.lit(0), n_blocks - 1))).alias("block"))
    blocks = _blocks(spark, root).withColumnRenamed("block", "__block")
    joined = each.join(blocks, _same_row(each, blocks) & (each["block"] == blocks["__block"]), "left").join(places, "block")
    out = joined.select(*[c for c in rows.columns if c not in (*IDS, "shared_value")], "shared_value", "values", F.explode("held").alias("x"))
    return out.select(*[c for c in rows.columns if c not in (*IDS, "shared_value")], F.col("x.corp_code").alias("corp_code"),
                      F.coalesce(F.try_element_at("values", F.col("x.at")), F.col("shared_value")).alias("account_value"))
