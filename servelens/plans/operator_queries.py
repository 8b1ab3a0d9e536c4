"""Registered queries for the single operators of the inventory (filters,
distincts, joins, windows, scalar functions), each over whole model tables,
with SQL twins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from servelens import constants as K
from servelens.functions import scalar as X
from servelens.operators import core as O
from servelens.plans import scenarios as S
from servelens.plans.constraint_queries import SEL_CTE, selected_from, typed_model
from servelens.plans.scenario_queries import NEW_ASSIGN
from servelens.registry import ORACLE, register
from servelens.session import ensure_checkpoint_dir
from servelens.sources import bindings as B
from servelens.sources.bindings import with_views
from servelens.sources.tables import by_period

H = K.HORIZON_PERIODS


@register("first_by_key", with_views("""
SELECT scenarioname, originname, destinationname, departingperiodname, flowquantity FROM (
  SELECT *, row_number() OVER (PARTITION BY scenarioname, originname
                               ORDER BY flowquantity DESC NULLS LAST, destinationname ASC NULLS FIRST,
                                        departingperiodname ASC NULLS FIRST) AS rn
  FROM flows) x WHERE rn = 1""", "flows"))
def q_first_by_key(spark, sf_dir):
    """The largest flow per (scenario, origin), ties by destination and period."""
    f = B.view(spark, sf_dir, "flows")
    return O.top1_by(f, ["scenarioname", "originname"],
                     [("flowquantity", False), ("destinationname", True), ("departingperiodname", True)],
                     ["destinationname", "departingperiodname", "flowquantity"])


@register("split_filter", with_views(f"""
SELECT CASE WHEN coalesce(starts_with(facilityname, '{K.RETURN_PREFIX}'), false) THEN 'True' ELSE 'False' END AS branch,
       count(*) AS n_rows, coalesce(sum(CAST(constraintvalue AS DOUBLE)), 0) AS total
FROM constraints GROUP BY 1""", "constraints"))
def q_split_filter(spark, sf_dir):
    """Both branches of a prefix test; NULL goes to the False branch."""
    c = typed_model(spark, sf_dir, ("constraints",))["constraints"]
    t = c.where(X.starts("facilityname", K.RETURN_PREFIX)).withColumn("branch", F.lit("True"))
    f = c.where(X.not_starts("facilityname", K.RETURN_PREFIX)).withColumn("branch", F.lit("False"))
    return t.unionByName(f).groupBy("branch").agg(F.count(F.lit(1)).alias("n_rows"),
                                                  X.sum0("constraintvalue").alias("total"))


@register("period_cutoff", with_views(f"""
SELECT scenarioname, departingperiodname, CAST(right(departingperiodname, 2) AS INTEGER) AS period_no,
       count(*) AS n_flows, coalesce(sum(flowquantity), 0) AS flowquantity
FROM flows WHERE CAST(right(departingperiodname, 2) AS INTEGER) <= {H}
GROUP BY scenarioname, departingperiodname""", "flows"))
def q_period_cutoff(spark, sf_dir):
    """F8: flows of the reported horizon per scenario and period."""
    f = B.view(spark, sf_dir, "flows")
    return (f.where(X.period_no("departingperiodname") <= H)
            .groupBy("scenarioname", "departingperiodname")
            .agg(F.count(F.lit(1)).alias("n_flows"), X.sum0("flowquantity").alias("flowquantity"))
            .withColumn("period_no", X.period_no("departingperiodname")))


@register("period_cutoff_stored", ORACLE["period_cutoff"])
def q_period_cutoff_stored(spark, sf_dir):
    """The same over flows stored with their period number, which the scan filters on."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/servelens-tables/flows-{uuid.uuid4().hex}"
    by_period(B.view(spark, sf_dir, "flows"), "departingperiodname").write.parquet(path)
    f = spark.read.parquet(path)
    return (f.where(X.within_horizon(f, "departingperiodname", H))
            .groupBy("scenarioname", "departingperiodname", "period_no")
            .agg(F.count(F.lit(1)).alias("n_flows"), X.sum0("flowquantity").alias("flowquantity")))


@register("not_in_list", with_views(f"""
SELECT scenarioname, count(*) AS n_flows, coalesce(sum(sourcingcost), 0) AS sourcingcost
FROM flows f
WHERE NOT EXISTS (SELECT 1 FROM facilities m WHERE m.depottype = '{K.MANUFACTURING_TYPE}'
                  AND m.facilityname = f.originname)
GROUP BY scenarioname""", "flows", "facilities"))
def q_not_in_list(spark, sf_dir):
    """Flows whose origin is not a manufacturer (anti join, NULL origins kept)."""
    m = B.model(spark, sf_dir, ("flows", "facilities"))
    mfrs = m["facilities"].where(F.col("depottype") == K.MANUFACTURING_TYPE).select(
        F.col("facilityname").alias("originname"))
    return (O.semi_join(m["flows"], mfrs, "originname", anti=True).groupBy("scenarioname")
            .agg(F.count(F.lit(1)).alias("n_flows"), X.sum0("sourcingcost").alias("sourcingcost")))


@register("distinct_ops", with_views("""
SELECT corpcode, corpname, count(*) AS n_customers FROM (SELECT DISTINCT customername, corpcode, corpname FROM customers) d
GROUP BY corpcode, corpname""", "customers"))
def q_distinct_ops(spark, sf_dir):
    """Distinct customers, then the distinct corp codes with their size."""
    c = B.view(spark, sf_dir, "customers")
    return (c.select("customername", "corpcode", "corpname").distinct()
            .groupBy("corpcode", "corpname").agg(F.count(F.lit(1)).alias("n_customers")))


@register("scalar_aggregates", with_views("""
SELECT (SELECT count(*) FROM constraints) AS n_constraints,
       (SELECT max(CAST(constraintvalue AS DOUBLE)) FROM constraints) AS max_constraint,
       (SELECT coalesce(sum(CAST(initialinventory AS DOUBLE)), 0) FROM inventory_policies) AS initial_inventory""",
                                     "constraints", "inventory_policies"))
def q_scalar_aggregates(spark, sf_dir):
    """Global count, max and sum of two tables in one row.

    Each table contributes one partial row to a union; one global aggregate
    puts them side by side (no join)."""
    m = typed_model(spark, sf_dir, ("constraints", "inventory_policies"))
    a = m["constraints"].agg(F.count(F.lit(1)).alias("n_constraints"), F.max("constraintvalue").alias("max_constraint"))
    b = m["inventory_policies"].agg(X.sum0("initialinventory").alias("initial_inventory"))
    u = a.unionByName(b, allowMissingColumns=True)
    return u.agg(F.max("n_constraints").alias("n_constraints"), F.max("max_constraint").alias("max_constraint"),
                 F.max("initial_inventory").alias("initial_inventory"))


@register("row_numbering", with_views("""
SELECT scenarioname, itemname, itemorder,
       CAST(row_number() OVER (PARTITION BY scenarioname ORDER BY itemorder, itemname) AS BIGINT) AS "RecordID"
FROM (SELECT scenarioname, itemname, itemorder FROM new_a
      UNION ALL
      SELECT scenarioname, itemname, itemorder FROM assignments_existing e
      WHERE NOT EXISTS (SELECT 1 FROM new_a n WHERE n.scenarioname = e.scenarioname AND n.itemname = e.itemname)) a""",
                                 "demand", "customers", "accounts", "assignments_existing",
                                 ctes=SEL_CTE.strip() + "," + NEW_ASSIGN))
def q_row_numbering(spark, sf_dir):
    """Assignments numbered per scenario in item order."""
    m = typed_model(spark, sf_dir, ("demand", "customers", "accounts", "assignments_existing"))
    a = S.build_scenario_assignments(m["assignments_existing"], selected_from(m)).drop("notes")
    return O.number_rows(a, [F.col("itemorder"), F.col("itemname")], ["scenarioname"])


@register("share_and_group_total", with_views("""
SELECT facilityname, productname, periodname, CAST(constraintvalue AS DOUBLE) AS constraintvalue,
       sum(CAST(constraintvalue AS DOUBLE)) OVER (PARTITION BY facilityname, periodname) AS facility_total,
       CAST(constraintvalue AS DOUBLE) / nullif(sum(CAST(constraintvalue AS DOUBLE)) OVER (PARTITION BY facilityname, periodname), 0)
         AS share
FROM constraints WHERE coalesce(starts_with(facilityname, 'R_'), false)""", "constraints"))
def q_share_and_group_total(spark, sf_dir):
    """Each return constraint next to its facility-period total and its share."""
    c = typed_model(spark, sf_dir, ("constraints",))["constraints"]
    r = c.where(X.starts("facilityname", K.RETURN_PREFIX)).select("facilityname", "productname", "periodname",
                                                                  "constraintvalue")
    return O.share_of_total(r, ["facilityname", "periodname"], "constraintvalue", "share", total_name="facility_total")


@register("union_ordered", with_views("""
SELECT corp_code, corp_desc FROM (
  SELECT corp_code, corp_desc, row_number() OVER (PARTITION BY corp_code ORDER BY p, corp_desc) AS rn FROM (
    SELECT corp_code, corp_desc, 0 AS p FROM accounts WHERE lower(evaluate) = 'y'
    UNION ALL
    SELECT corp_code, regexp_replace(replace(corp_desc, '&', 'And'), '[[:punct:]]', '', 'g'), 1 FROM accounts) u) x
WHERE rn = 1""", "accounts"))
def q_union_ordered(spark, sf_dir):
    """Flagged accounts first, then the cleansed list; first row per code wins."""
    a = B.view(spark, sf_dir, "accounts")
    first = a.where(F.lower(F.col("evaluate")) == "y").select("corp_code", "corp_desc")
    second = S.clean_account_names(a).select("corp_code", "corp_desc")
    u = O.union_ordered(first, second, priority_col="p")
    return O.first_by(u, ["corp_code"], [F.col("p"), F.col("corp_desc")]).select("corp_code", "corp_desc")


@register("basic_joins", with_views("""
SELECT c.corpcode, count(*) AS n_demand, count(c.customername) AS n_matched,
       coalesce(sum(CAST(d.quantity AS DOUBLE)), 0) AS quantity
FROM demand d LEFT JOIN customers c ON d.customername = c.customername
GROUP BY c.corpcode""", "demand", "customers"))
def q_basic_joins(spark, sf_dir):
    """Demand left-joined to customers, per corp code (unmatched rows form the NULL group).

    Demand is summed per customer before the join (counts and sums carry
    through the customer fan-out), so a hot customer is combined map-side."""
    m = typed_model(spark, sf_dir, ("demand", "customers"))
    per_cust = m["demand"].groupBy("customername").agg(F.count(F.lit(1)).alias("n"),
                                                       F.sum("quantity").alias("q"))
    c = m["customers"].select("customername", "corpcode", F.lit(True).alias("matched"))
    j = per_cust.join(c, "customername", "left")
    return j.groupBy("corpcode").agg(
        F.sum("n").alias("n_demand"),
        F.coalesce(F.sum(F.when(F.col("matched"), F.col("n"))), F.lit(0)).cast("bigint").alias("n_matched"),
        X.sum0("q").alias("quantity"))


@register("null_filters", with_views(f"""
SELECT left(coalesce(facilityname, '?'), 2) AS prefix, productname IS NULL AS null_product, count(*) AS n_rows
FROM constraints
WHERE productname IS DISTINCT FROM '{K.PRODUCT_NEW}'
  AND NOT coalesce(contains(facilityname, '{K.ISSUE_PREFIX}'), false)
  AND NOT coalesce(starts_with(facilityname, '{K.RETURN_PREFIX}'), false)
GROUP BY 1, 2""", "constraints"))
def q_null_filters(spark, sf_dir):
    """Negated tests keep NULL rows (the Depot group has no product name)."""
    c = B.view(spark, sf_dir, "constraints")
    f = c.where(X.not_equal_keep_null("productname", K.PRODUCT_NEW) & X.not_has("facilityname", K.ISSUE_PREFIX)
                & X.not_starts("facilityname", K.RETURN_PREFIX))
    return (f.groupBy(F.left(F.coalesce(F.col("facilityname"), F.lit("?")), F.lit(2)).alias("prefix"),
                      F.col("productname").isNull().alias("null_product"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


@register("scalar_functions", with_views("""
SELECT facilityname, periodname,
       nullif(split_part(facilityname, '_', 3), '') AS loc_code,
       CAST(right(periodname, 2) AS INTEGER) AS period_no,
       'Period 0' || CAST(CAST(right(periodname, 2) AS INTEGER) AS VARCHAR) AS label_q8,
       lower(status) AS status_lower,
       coalesce(productname, 'none') AS product,
       round_even(CAST(constraintvalue AS DOUBLE) / 7, 0) AS rint_7,
       round_even(CAST(constraintvalue AS DOUBLE) / 7, 6) AS bround_7,
       CAST(floor(CAST(constraintvalue AS DOUBLE) / 7) AS DOUBLE) AS floor_7,
       -CAST(constraintvalue AS DOUBLE) AS negated,
       CASE WHEN notes IN ('Repair_Capacity', 'MinRepairsPerDay', 'RepairsPerMonthVariance') THEN 'Include' ELSE status END
         AS status_rule
FROM constraints WHERE regexp_full_match(periodname, 'Period [0-9]+')""", "constraints"))
def q_scalar_functions(spark, sf_dir):
    """The scalar functions of the model over the constraint table."""
    c = typed_model(spark, sf_dir, ("constraints",))["constraints"].where(X.is_period_label("periodname"))
    cv = F.col("constraintvalue")
    return c.select(
        "facilityname", "periodname",
        X.split_part("facilityname", "_", 2).alias("loc_code"),
        X.period_no("periodname").alias("period_no"),
        X.period_label(X.period_no("periodname")).alias("label_q8"),
        F.lower("status").alias("status_lower"),
        F.coalesce(F.col("productname"), F.lit("none")).alias("product"),
        X.rint(cv / 7).alias("rint_7"),
        X.round_half_even(cv / 7, 6).alias("bround_7"),
        F.floor(cv / 7).cast("double").alias("floor_7"),
        (-cv).alias("negated"),
        F.when(F.col("notes").isin(*K.REPAIR_NOTES), F.lit(K.STATUS_INCLUDE)).otherwise(F.col("status"))
        .alias("status_rule"))



@register("append_scalar", with_views(f"""
SELECT '{K.LESS_SCENARIO_PREFIX}' || s.corp_code AS scenarioname, s.corp_code, coalesce(b.n, 0) AS n_base_items
FROM (SELECT DISTINCT corp_code FROM sel) s
LEFT JOIN (SELECT count(*) AS n FROM assignments_existing WHERE scenarioname = '{K.OPTIMAL_SCENARIO}') b ON true""",
                                 "demand", "customers", "accounts", "assignments_existing", ctes=SEL_CTE))
def q_append_scalar(spark, sf_dir):
    """The base scenario's item count attached to every new scenario,
    through an equi-join on the base scenario name (no cross product)."""
    m = typed_model(spark, sf_dir, ("demand", "customers", "accounts", "assignments_existing"))
    acc = (selected_from(m).select("corp_code").distinct()
           .withColumn("scenarioname", F.concat(F.lit(K.LESS_SCENARIO_PREFIX), F.col("corp_code")))
           .withColumn("base_scenario", F.lit(K.OPTIMAL_SCENARIO)))
    n = (m["assignments_existing"].where(F.col("scenarioname") == K.OPTIMAL_SCENARIO)
         .groupBy(F.col("scenarioname").alias("base_scenario")).agg(F.count(F.lit(1)).alias("n_base_items")))
    return (acc.join(n, "base_scenario", "left")
            .select("scenarioname", "corp_code", F.coalesce("n_base_items", F.lit(0)).cast("bigint").alias("n_base_items")))


@register("upsert_last_wins", with_views(f"""
SELECT scenarioname, itemname, itemorder, notes FROM (
  SELECT *, row_number() OVER (PARTITION BY scenarioname, itemname ORDER BY src DESC, itemorder DESC) AS rn FROM (
    SELECT scenarioname, itemname, itemorder, notes, 0 AS src FROM assignments_existing
    UNION ALL
    SELECT scenarioname, itemname, itemorder + 1, notes, 1 FROM assignments_existing
    WHERE scenarioname = '{K.OPTIMAL_SCENARIO}' AND itemorder % 2 = 0
    UNION ALL
    SELECT '{K.LESS_SCENARIO_PREFIX}00001', itemname, itemorder, notes, 1 FROM assignments_existing
    WHERE scenarioname = '{K.OPTIMAL_SCENARIO}') u) x
WHERE rn = 1""", "assignments_existing"))
def q_upsert_last_wins(spark, sf_dir):
    """K3-K5: re-issued rows replace the stored row with the same key, new keys are inserted."""
    ex = B.view(spark, sf_dir, "assignments_existing")
    opt = ex.where(F.col("scenarioname") == K.OPTIMAL_SCENARIO)
    shifted = opt.where(F.col("itemorder") % 2 == 0).withColumn("itemorder", F.col("itemorder") + 1)
    copied = opt.withColumn("scenarioname", F.lit(K.LESS_SCENARIO_PREFIX + "00001"))
    return O.upsert_last_wins(ex, shifted.unionByName(copied), ["scenarioname", "itemname"],
                              ["itemorder"]).select("scenarioname", "itemname", "itemorder", "notes")


@register("projection_ops", with_views("""
SELECT scenarioname AS scenario, originname, destinationname, CAST(right(departingperiodname, 2) AS INTEGER) AS period_no,
       CAST(flowquantity AS DOUBLE) AS quantity, 'flow' AS kind
FROM flows""", "flows"))
def q_projection_ops(spark, sf_dir):
    """Rename, drop, cast, computed and literal columns of every flow."""
    f = B.view(spark, sf_dir, "flows").withColumnRenamed("scenarioname", "scenario")
    f = f.withColumn("period_no", X.period_no("departingperiodname")).withColumn("quantity", F.col("flowquantity").cast("double"))
    return f.withColumn("kind", F.lit("flow")).select("scenario", "originname", "destinationname", "period_no", "quantity", "kind")


@register("union_missing", with_views("""
SELECT scenarioname, periodname, CAST(operatingcost AS DOUBLE) AS operatingcost, CAST(NULL AS DOUBLE) AS totalinventorycost
FROM facility_summary
UNION ALL
SELECT scenarioname, periodname, CAST(NULL AS DOUBLE), CAST(totalinventorycost AS DOUBLE) FROM inventory_summary""",
                                      "facility_summary", "inventory_summary"))
def q_union_missing(spark, sf_dir):
    """Two tables by column name; a column that one lacks is NULL in its rows."""
    m = B.model(spark, sf_dir, ("facility_summary", "inventory_summary"))
    a = m["facility_summary"].select("scenarioname", "periodname", F.col("operatingcost").cast("double").alias("operatingcost"))
    b = m["inventory_summary"].select(F.col("totalinventorycost").cast("double").alias("totalinventorycost"), "periodname", "scenarioname")
    return a.unionByName(b, allowMissingColumns=True)
