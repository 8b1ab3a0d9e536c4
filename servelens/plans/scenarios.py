"""Scenario registration for all accounts at once.

The modelled workflow runs once per account and each run reads the tables
the previous run wrote.  Every generated key contains the account code, so
runs cannot collide and the set-based version over all accounts gives the
same tables.  Existing rows always win over regenerated identical ones
(insert-if-absent), so running the registration twice adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servelens import constants as K
from servelens.functions.scalar import clean_text, drop_last_char
from servelens.operators.core import append_guarded, first_wins, insert_if_absent, substring_lookup, upsert_last_wins

SCENARIO_COLS = ("scenarioname", "status", "description", "tags", "notes", "technology")
ITEM_COLS = ("itemname", "tablename", "action", "condition", "status", "description", "tags", "notes")
ASSIGNMENT_COLS = ("scenarioname", "itemname", "itemorder", "notes")


def _null(t="string"):
    return F.lit(None).cast(t)


def clean_account_names(accounts: DataFrame) -> DataFrame:
    """``&`` -> ``And``, punctuation removed, model path derived."""
    desc = clean_text("corp_desc")
    return accounts.withColumn("corp_desc", desc).withColumn(
        "account_model", F.concat(drop_last_char("base_model"), F.lit(" - "), F.col("corp_desc"), F.lit("\\")))


def accounts_with_demand(selected: DataFrame, demand: DataFrame, customers: DataFrame,
                         contains: bool = False) -> DataFrame:
    """Accounts whose code is found for a customer with demand."""
    cust = customers.select("customername", F.col("corpcode").alias("CorpCode"), "corpname", "loccode")
    found = substring_lookup(demand.select("customername"), cust, "customername", "customername",
                             ["CorpCode", "corpname", "loccode"], contains=contains)
    codes = found.select(F.col("CorpCode").alias("corp_code")).where(F.col("corp_code").isNotNull()).distinct()
    return selected.join(codes, "corp_code", "left_semi")


def new_scenarios(selected: DataFrame, prefix: str = K.LESS_SCENARIO_PREFIX) -> DataFrame:
    """One what-if scenario row per account."""
    return selected.select(
        F.concat(F.lit(prefix), F.col("corp_code")).alias("scenarioname"),
        F.lit(K.STATUS_INCLUDE).alias("status"), _null().alias("description"), _null().alias("tags"),
        _null().alias("notes"), _null().alias("technology")).distinct()


def scenario_changes(existing: DataFrame, selected: DataFrame, prefix: str = K.LESS_SCENARIO_PREFIX) -> DataFrame:
    """Rows to write for the accounts (D4): the first stored row of each new name, else the new row."""
    return first_wins(existing.select(*SCENARIO_COLS), new_scenarios(selected, prefix), ["scenarioname"])


def build_scenarios(existing: DataFrame, selected: DataFrame, prefix: str = K.LESS_SCENARIO_PREFIX) -> DataFrame:
    """Scenario table after registration (C11, J8, K5): existing rows kept,
    missing account scenarios inserted."""
    return insert_if_absent(existing.select(*SCENARIO_COLS), new_scenarios(selected, prefix), ["scenarioname"])


def new_items(accounts: DataFrame) -> DataFrame:
    """Two scenario items per account: exclude its customers, use its constraints."""
    c = F.col("corp_code")
    exclude = accounts.select(
        F.concat(F.lit(K.EXCLUDE_ITEM_PREFIX), c).alias("itemname"), F.lit(K.EXCLUDE_ITEM_TABLE).alias("tablename"),
        F.lit(K.EXCLUDE_ITEM_ACTION).alias("action"),
        F.concat(F.lit("corpcode='"), c, F.lit("'")).alias("condition"),
        F.lit(K.STATUS_INCLUDE).alias("status"), _null().alias("description"), _null().alias("tags"),
        _null().alias("notes"))
    update = accounts.select(
        F.concat(F.lit(K.UPDATE_ITEM_PREFIX), c).alias("itemname"), F.lit(K.UPDATE_ITEM_TABLE).alias("tablename"),
        F.concat(F.lit(K.UPDATE_ITEM_ACTION_PREFIX), c).alias("action"), _null().alias("condition"),
        F.lit(K.STATUS_INCLUDE).alias("status"), _null().alias("description"), _null().alias("tags"),
        _null().alias("notes"))
    return exclude.unionByName(update).distinct()


def item_changes(existing: DataFrame, accounts: DataFrame) -> DataFrame:
    """Rows to write for the accounts (D4): the first stored row of each new item, else the new row."""
    return first_wins(existing.select(*ITEM_COLS), new_items(accounts.select("corp_code").distinct()), ["itemname"])


def build_scenario_items(existing: DataFrame, accounts: DataFrame) -> DataFrame:
    """Item table after registration."""
    return insert_if_absent(existing.select(*ITEM_COLS), new_items(accounts.select("corp_code").distinct()),
                            ["itemname"])


def new_assignments(accounts: DataFrame, existing: DataFrame, base_scenario: str = K.OPTIMAL_SCENARIO,
                    prefix: str = K.LESS_SCENARIO_PREFIX, start_after_max: bool = False,
                    max_items: int | None = None, mode: str = "error") -> DataFrame:
    """Assignments of each new scenario: the base scenario's items, then the
    account's two items at orders ``n`` and ``n + 1`` where ``n`` is the count
    of base items (Q19; ``start_after_max`` uses ``max(itemorder) + 1``).

    The base items are attached with an equi-join on the base scenario name;
    ``max_items`` guards their number (J11, see ``append_guarded``).
    """
    acc = accounts.select(F.concat(F.lit(prefix), F.col("corp_code")).alias("scenarioname"), "corp_code") \
        .distinct().withColumn("base_scenario", F.lit(base_scenario))
    base = existing.where(F.col("scenarioname") == base_scenario)
    base_items = base.select(F.col("scenarioname").alias("base_scenario"), "itemname", "itemorder")
    n = base.groupBy(F.col("scenarioname").alias("base_scenario")).agg(
        (F.max(F.col("itemorder").cast("bigint")) if start_after_max else F.count(F.lit(1))).cast("bigint").alias("n"))
    if max_items is None:
        copied = acc.join(base_items, "base_scenario", "inner")
    else:
        copied = append_guarded(acc, base_items, ["base_scenario"], max_items, mode)
    copied = copied.select("scenarioname", "itemname", "itemorder")
    with_n = acc.join(n, "base_scenario", "left").withColumn("n", F.coalesce(F.col("n"), F.lit(0)).cast("bigint"))
    if start_after_max:
        with_n = with_n.withColumn("n", F.col("n") + 1)
    own = with_n.select("scenarioname", F.concat(F.lit(K.EXCLUDE_ITEM_PREFIX), F.col("corp_code")).alias("itemname"),
                        F.col("n").alias("itemorder")).unionByName(
        with_n.select("scenarioname", F.concat(F.lit(K.UPDATE_ITEM_PREFIX), F.col("corp_code")).alias("itemname"),
                      (F.col("n") + 1).alias("itemorder")))
    return copied.unionByName(own).withColumn("notes", _null())


def assignment_changes(existing: DataFrame, accounts: DataFrame, base_scenario: str = K.OPTIMAL_SCENARIO,
                       prefix: str = K.LESS_SCENARIO_PREFIX, start_after_max: bool = False, **guard) -> DataFrame:
    """Rows to write for the accounts (D4): per (scenario, item, order) the stored row, with its notes,
    if there is one, else the regenerated row."""
    ex = existing.select(*ASSIGNMENT_COLS).withColumn("itemorder", F.col("itemorder").cast("bigint"))
    new = new_assignments(accounts, ex, base_scenario, prefix, start_after_max, **guard).select(*ASSIGNMENT_COLS)
    return first_wins(ex, new, ["scenarioname", "itemname", "itemorder"])


def build_scenario_assignments(existing: DataFrame, accounts: DataFrame, base_scenario: str = K.OPTIMAL_SCENARIO,
                               prefix: str = K.LESS_SCENARIO_PREFIX, start_after_max: bool = False, **guard) -> DataFrame:
    """Assignment table after registration (C13, K3): per (scenario, item) the
    row of :func:`assignment_changes` wins (it is written last, Q25); other rows stay."""
    ex = existing.select(*ASSIGNMENT_COLS).withColumn("itemorder", F.col("itemorder").cast("bigint"))
    changes = assignment_changes(existing, accounts, base_scenario, prefix, start_after_max, **guard)
    return upsert_last_wins(ex, changes, ["scenarioname", "itemname"], ["itemorder"])
