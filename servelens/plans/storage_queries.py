"""Registered queries of sources, sinks and row-level operators (S1, S2, K1-K5, J11, N2, N6) and SQL twins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from servelens import constants as K
from servelens.operators import core as O
from servelens.plans.constraint_queries import SEL_CTE, selected_from, typed_model
from servelens.plans.constraints import transfer_matrix
from servelens.registry import register
from servelens.session import ensure_checkpoint_dir
from servelens.sinks import snapshots
from servelens.sources import bindings as B
from servelens.sources import tables as T
from servelens.sources.bindings import with_views

#: base items that one scenario may have in ``append_guarded``
MAX_BASE_ITEMS = 200
FLOW_ORDER = ("scenarioname", "departingperiodname", "originname", "destinationname", "flowquantity", "shipmentcost",
              "sourcingcost", "transportationcost")


def _scratch(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/servelens-tables/{name}-{uuid.uuid4().hex}"


TRANSFER_SUM = ", ".join(K.TRANSFER_KEYS)


@register("monthly_files_sum", with_views(f"""
SELECT {TRANSFER_SUM}, sum(return_volume) AS return_volume FROM transfers
WHERE {" AND ".join(f"{k} IS NOT NULL" for k in K.TRANSFER_KEYS)} GROUP BY {TRANSFER_SUM}""", "transfers"))
def q_monthly_files_sum(spark, sf_dir):
    """The transfers written as twelve monthly files, whose columns stand in another order from
    May on and with one more from September on, read by name and summed."""
    folder = _scratch(spark, "months")
    labels = {name: label for label, name in K.TRANSFER_HEADERS.items()}
    months = B.view(spark, sf_dir, "transfers").withColumnsRenamed(labels)
    heads = list(K.TRANSFER_HEADERS)
    shapes = ((1, 4, heads), (5, 8, heads[::-1]), (9, 12, [*heads[3:], "Remark", *heads[:3]]))
    for first, last, columns in shapes:
        part = months.where(F.col("month").between(first, last)).withColumn("Remark", F.lit("late"))
        part.select(*columns, "month").repartition("month").write.option("header", "true").partitionBy("month").csv(f"{folder}/from-{first:02d}")
    return transfer_matrix(T.read_monthly_files(spark, folder))


@register("account_list_files", with_views("SELECT corp_code, corp_desc, evaluate FROM sel", "accounts", "demand", "customers", ctes=SEL_CTE))
def q_account_list_files(spark, sf_dir):
    """S3: the account list written as files under its own headers, read, and the selection made from it."""
    folder = _scratch(spark, "account-list")
    labels = {name: label for label, name in K.ACCOUNT_HEADERS.items()}
    m = typed_model(spark, sf_dir, ("accounts", "demand", "customers"))
    m["accounts"].select(*labels).withColumnsRenamed(labels).write.option("header", "true").csv(folder)
    return selected_from(m | {"accounts": T.read_account_list(spark, folder)}).select("corp_code", "corp_desc", "evaluate")


ASSIGNMENT_KEYS = ["scenarioname", "itemname"]


@register("upsert_columns", with_views("""
SELECT e.scenarioname, e.itemname, CASE WHEN e.itemorder % 3 = 0 THEN e.itemorder + 100 ELSE e.itemorder END AS itemorder,
       CASE WHEN e.itemorder % 4 = 0 THEN NULL ELSE e.notes END AS notes,
       CASE WHEN e.itemorder % 4 = 0 THEN 'cleared' END AS reason
FROM assignments_existing e
UNION ALL
SELECT 'inserted', itemname, itemorder + 100, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR)
FROM assignments_existing WHERE itemorder % 3 = 0 AND notes IS NULL""", "assignments_existing"))
def q_upsert_columns(spark, sf_dir):
    """K3-K5: one update without notes, which stay, and one that clears notes and adds a column."""
    stored = B.view(spark, sf_dir, "assignments_existing")
    moved = stored.where(F.col("itemorder") % 3 == 0).select("scenarioname", "itemname", (F.col("itemorder") + 100).alias("itemorder"))
    inserted = stored.where((F.col("itemorder") % 3 == 0) & F.col("notes").isNull()).select(
        F.lit("inserted").alias("scenarioname"), "itemname", (F.col("itemorder") + 100).alias("itemorder"))
    cleared = stored.where(F.col("itemorder") % 4 == 0).select("scenarioname", "itemname", F.lit(None).cast("string").alias("notes"),
                                                              F.lit("cleared").alias("reason"))
    return O.upsert_last_wins(stored, [moved.unionByName(inserted), cleared], ASSIGNMENT_KEYS)


@register("snapshot_versions", with_views("""
SELECT 1 AS version, count(*) AS n, sum(CAST(quantity AS DOUBLE)) AS quantity FROM demand_rows
UNION ALL
SELECT 2, count(*), sum(CASE WHEN hot THEN -CAST(quantity AS DOUBLE) ELSE CAST(quantity AS DOUBLE) END) FROM demand_rows""",
                                          "demand", ctes="""
demand_rows AS (SELECT customername, periodname, sum(CAST(quantity AS DOUBLE)) AS quantity,
                       customername = (SELECT min(customername) FROM demand) AS hot
                FROM demand GROUP BY customername, periodname)"""))
def q_snapshot_versions(spark, sf_dir):
    """K1, K3-K5: demand per customer and period published, the rows of one customer replaced; both versions read."""
    root = _scratch(spark, "demand")
    demand = B.view(spark, sf_dir, "demand").withColumn("quantity", F.col("quantity").cast("double"))
    snapshots.publish(demand.groupBy("customername", "periodname").agg(F.sum("quantity").alias("quantity")), root, ["customername"])
    stored = snapshots.read(spark, root)
    first = stored.where(F.col("customername") == stored.agg(F.min("customername")).scalar())
    # the table's key is the customer: its update holds the sum of the customer's rows
    changed = O.materialize(first.withColumn("quantity", -F.col("quantity")), "changed")
    snapshots.publish(O.upsert_last_wins(stored, changed, ["customername", "periodname"]), root, ["customername"])
    return snapshots.read(spark, root, 1).select(F.lit(1).alias("version"), "quantity").unionByName(
        snapshots.read(spark, root).select(F.lit(2).alias("version"), "quantity")).groupBy("version").agg(
        F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("quantity"))


@register("upsert_partitions", with_views("""
SELECT customername, loccode, corpcode,
       CASE WHEN corpcode = '00003' THEN 'renamed' ELSE corpname END AS corpname FROM customers""", "customers"))
def q_upsert_partitions(spark, sf_dir):
    """K3-K5: customers in a versioned table; one account's customers renamed, only their partitions rewritten."""
    root = _scratch(spark, "customers")
    customers = B.view(spark, sf_dir, "customers")
    snapshots.publish(customers, root, ["customername"])
    snapshots.upsert(customers.where(F.col("corpcode") == "00003").select("customername", F.lit("renamed").alias("corpname")), root)
    return snapshots.read(spark, root)


@register("append_guarded", with_views(f"""
SELECT '{K.LESS_SCENARIO_PREFIX}' || s.corp_code AS scenarioname, s.corp_code, a.itemname, a.itemorder
FROM (SELECT DISTINCT corp_code FROM sel) s JOIN assignments_existing a ON a.scenarioname = '{K.OPTIMAL_SCENARIO}'""",
                                       "demand", "customers", "accounts", "assignments_existing", ctes=SEL_CTE))
def q_append_guarded(spark, sf_dir):
    """Base items appended to each new scenario, at most ``MAX_BASE_ITEMS`` of them."""
    m = typed_model(spark, sf_dir, ("demand", "customers", "accounts", "assignments_existing"))
    new = (selected_from(m).select("corp_code").distinct()
           .withColumn("base_scenario", F.lit(K.OPTIMAL_SCENARIO))
           .withColumn("scenarioname", F.concat(F.lit(K.LESS_SCENARIO_PREFIX), F.col("corp_code"))))
    base = m["assignments_existing"].select(F.col("scenarioname").alias("base_scenario"), "itemname", "itemorder")
    return O.append_guarded(new, base, ["base_scenario"], MAX_BASE_ITEMS).select("scenarioname", "corp_code", "itemname", "itemorder")


@register("number_flows", with_views(f"""
SELECT *, row_number() OVER (ORDER BY {", ".join(f"{c} NULLS FIRST" for c in FLOW_ORDER)}) AS "RecordID"
FROM (SELECT {", ".join(FLOW_ORDER)} FROM flows) f""", "flows"))
def q_number_flows(spark, sf_dir):
    """Every flow numbered from 1 in the order of all columns, in range partitions."""
    flows = B.view(spark, sf_dir, "flows").select(*FLOW_ORDER)
    return O.number_rows(flows, [F.col(c).asc_nulls_first() for c in FLOW_ORDER])
