"""Scenario KPIs, deltas and the per-account cost report (C14-C20).

Plan shape, chosen for very large flow tables:

* The flow table is scanned **once**: a single ``groupBy(scenarioname,
  originname)`` computes every conditional partial sum (map-side combine, so
  only partial aggregates are shuffled, never raw flows).  The manufacturer
  flag for painting cost is joined to that small aggregate, not to the flows.
* The other fact tables join the flow partials in one union and a single
  ``groupBy(scenarioname)``: one shuffle of partial aggregates for all
  sixteen measures, no joins to align them; derived measures are column
  arithmetic.
* Current-network costs pre-aggregate flows per destination / origin before
  joining the customer dimension.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servelens import constants as K
from servelens.functions.scalar import has, not_has, safe_div, sum0, within_horizon
from servelens.operators.core import unpivot_prefixed

MEASURES = tuple(name for _, name in K.SCENARIO_MEASURES)
BASE_MEASURES = ("issues", "returns", "tc_issues", "tc_returns", "tc_transfers", "depot_fixed",
                 "depot_painting", "depot_handling", "depot_inventory", "depot_repair")


# ---------------------------------------------------------------------------
# C14 scenario KPIs
# ---------------------------------------------------------------------------

def _flow_partials(flows: DataFrame, horizon: int) -> DataFrame:
    """One pass over the flows: partial sums per (scenario, origin).

    Every flow measure uses the same period cutoff, so it is one filter in
    front of the aggregate (partition pruning when flows are stored per period).
    """
    ok = F.lit(True)
    issue = has("destinationname", K.ISSUE_PREFIX)
    ret = has("originname", K.RETURN_PREFIX)
    transfer = not_has("destinationname", K.ISSUE_PREFIX) & not_has("originname", K.RETURN_PREFIX)
    q = F.col("flowquantity")
    ship, src, tr = F.col("shipmentcost"), F.col("sourcingcost"), F.col("transportationcost")
    parts = {
        "issues": (issue, q),
        "returns": (ret, q),
        "tc_issues": (issue, ship + tr),
        "tc_returns": (ret, ship + src + tr),
        "tc_transfers": (transfer, ship + src + tr),
        "painting": (ok, src),
    }
    aggs = []
    for name, (cond, val) in parts.items():
        aggs.append(F.count(F.when(cond, F.lit(1))).alias(f"n_{name}"))
        aggs.append(F.sum(F.when(cond, val)).alias(f"s_{name}"))
    return (flows.where(F.col("scenarioname").isNotNull() & within_horizon(flows, "departingperiodname", horizon))
            .groupBy("scenarioname", "originname").agg(*aggs))


def _final(name: str, n_col: str | None = None, s_col: str | None = None):
    n = F.sum(n_col or f"n_{name}")
    s = F.sum(s_col or f"s_{name}")
    return F.when(n > 0, F.coalesce(s, F.lit(0.0))).alias(name)


def flow_measures(flows: DataFrame, facilities: DataFrame, horizon: int = K.HORIZON_PERIODS,
                  manufacturing_type: str = K.MANUFACTURING_TYPE) -> DataFrame:
    """Partial sums of issues, returns, transport costs and painting cost per
    (scenario, origin) with the manufacturer flag applied (A9-A13, A15).

    The flag is joined to the aggregate, never to the raw flows.  Output
    columns ``n_<measure>`` / ``s_<measure>`` are partials for :func:`_final`.
    """
    partial = _flow_partials(flows, horizon)
    mfrs = (facilities.where(F.col("depottype") == manufacturing_type)
            .select(F.col("facilityname").alias("originname")).distinct()
            .withColumn("is_mfr", F.lit(True)))
    flagged = partial.join(mfrs, "originname", "left")
    paint = ~F.coalesce(F.col("is_mfr"), F.lit(False))      # ~isin keeps NULL origins (F13)
    keep = [f"{p}_{m}" for m in ("issues", "returns", "tc_issues", "tc_returns", "tc_transfers") for p in ("n", "s")]
    return flagged.select("scenarioname", *keep,
                          F.when(paint, F.col("n_painting")).alias("n_depot_painting"),
                          F.when(paint, F.col("s_painting")).alias("s_depot_painting"))


def _fact_rows(df: DataFrame, cond, value, name: str) -> DataFrame:
    """Rows of one fact table as partials of one measure: ``n`` counts rows
    that pass the filter, ``s`` carries their value."""
    return df.where(cond & F.col("scenarioname").isNotNull()).select(
        "scenarioname", F.lit(1).cast("bigint").alias(f"n_{name}"), value.cast("double").alias(f"s_{name}"))


def scenario_kpis(flows: DataFrame, facility_summary: DataFrame, warehousing_summary: DataFrame,
                  inventory_summary: DataFrame, production_summary: DataFrame, facilities: DataFrame,
                  horizon: int = K.HORIZON_PERIODS, repair_bom: str = K.REPAIR_BOM,
                  manufacturing_type: str = K.MANUFACTURING_TYPE) -> DataFrame:
    """16 measures per scenario (C14); column order as the exported table.

    All five fact tables meet in one union and one ``groupBy(scenarioname)``:
    each table is scanned once, aggregated map-side, and only per-scenario
    partials are shuffled.  A measure whose filter keeps no row of a scenario
    is NULL (as index alignment gives NaN); a scenario no filter keeps is absent.
    """
    h = horizon
    parts = [
        flow_measures(flows, facilities, h, manufacturing_type),
        _fact_rows(facility_summary, within_horizon(facility_summary, "periodname", h), F.col("operatingcost"), "depot_fixed"),
        _fact_rows(warehousing_summary, within_horizon(warehousing_summary, "periodname", h),
                   F.col("inboundhandlingcost") + F.col("outboundhandlingcost"), "depot_handling"),
        _fact_rows(inventory_summary, within_horizon(inventory_summary, "periodname", h),
                   F.col("totalinventorycost"), "depot_inventory"),
        _fact_rows(production_summary, (F.col("bomname") == repair_bom) & within_horizon(production_summary, "startingperiodname", h),
                   F.col("productioncost"), "depot_repair"),
    ]
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    aligned = u.groupBy("scenarioname").agg(*[_final(m) for m in BASE_MEASURES])
    c = F.col
    tc_total = c("tc_issues") + c("tc_returns") + c("tc_transfers")
    variable = c("depot_painting") + c("depot_handling") + c("depot_repair")
    var_cpi = safe_div(variable, c("issues"))
    fix_cpi = safe_div(c("depot_fixed"), c("issues"))
    total_cpi = safe_div(tc_total, c("issues")) + (var_cpi + fix_cpi)
    return aligned.where(F.coalesce(*[c(m) for m in BASE_MEASURES]).isNotNull()).select(
        "scenarioname", "issues", "returns",
        safe_div(c("returns"), c("issues")).alias("network_r_i"),
        "tc_issues", "tc_returns", "tc_transfers", tc_total.alias("tc_total"),
        "depot_fixed", "depot_painting", "depot_handling", "depot_inventory", "depot_repair",
        (c("depot_fixed") + c("depot_painting") + c("depot_handling") + c("depot_repair")).alias("depot_total"),
        var_cpi.alias("variable_depot_cpi"), fix_cpi.alias("fixed_depot_cpi"), total_cpi.alias("total_cpi"),
    )


# ---------------------------------------------------------------------------
# C15 deltas against the reference scenarios
# ---------------------------------------------------------------------------

def scenario_delta_rows(kpis: DataFrame, baseline: str = K.BASELINE_SCENARIO, optimal: str = K.OPTIMAL_SCENARIO,
                        marker: str = K.LESS_MARKER) -> DataFrame:
    """Each scenario whose name contains ``marker`` minus each reference scenario.

    The reference row is found by an equi-join on its name (at most one row
    per name, since KPIs are grouped by scenario), so no cross product.
    Output: ``scenarioname`` (the label), ``corp_code``, ``reference``, measures.
    """
    refs = F.array(F.struct(F.lit(baseline).alias("ref_name"), F.lit("Baseline").alias("reference")),
                   F.struct(F.lit(optimal).alias("ref_name"), F.lit("Optimal").alias("reference")))
    less = (kpis.where(has("scenarioname", marker))
            .select(F.col("scenarioname").alias("less_name"), F.inline(refs), *[F.col(m).alias(f"l_{m}") for m in MEASURES]))
    ref = kpis.select(F.col("scenarioname").alias("ref_name"), *[F.col(m).alias(f"r_{m}") for m in MEASURES])
    j = less.join(ref, "ref_name", "inner")
    code = F.right(F.col("less_name"), F.lit(5))
    return j.select(
        F.concat(F.lit("Removing "), code, F.lit(" - "), F.col("reference")).alias("scenarioname"),
        code.alias("corp_code"), "reference",
        *[(F.col(f"l_{m}") - F.col(f"r_{m}")).alias(m) for m in MEASURES])


def scenario_deltas(kpis: DataFrame, **kw) -> DataFrame:
    """Scenario table with the delta rows stacked under the scenario rows."""
    deltas = scenario_delta_rows(kpis, **kw).select("scenarioname", *MEASURES)
    return kpis.select("scenarioname", *MEASURES).unionByName(deltas)


def less_codes(df: DataFrame, marker: str = K.LESS_MARKER) -> DataFrame:
    """Corp codes of the what-if scenarios: last five characters of each name containing ``marker``."""
    return (df.where(has("scenarioname", marker))
            .select(F.right(F.col("scenarioname"), F.lit(5)).alias("corp_code")).distinct())


# ---------------------------------------------------------------------------
# C16-C19 current-network costs
# ---------------------------------------------------------------------------

def customer_labels(customers: DataFrame, codes: DataFrame) -> DataFrame:
    """Distinct customers of the analysed accounts with ``Customer`` label."""
    c = customers.select("loccode", "customername", "corpcode", "corpname").distinct()
    c = c.withColumn("Customer", F.concat(F.col("corpcode"), F.lit(" - "), F.col("corpname")))
    return c.join(codes.select(F.col("corp_code").alias("corpcode")).distinct(), "corpcode", "left_semi")


def current_issue_cost(flows: DataFrame, customers: DataFrame, codes: DataFrame,
                       optimal: str = K.OPTIMAL_SCENARIO, horizon: int = K.HORIZON_PERIODS) -> DataFrame:
    """Issue cost per corp in the optimal scenario, sourcing included."""
    f = flows.where(has("destinationname", K.ISSUE_PREFIX) & within_horizon(flows, "departingperiodname", horizon)
                    & (F.col("scenarioname") == optimal))
    per_dest = f.groupBy("destinationname").agg(
        F.sum(F.col("shipmentcost") + F.col("sourcingcost") + F.col("transportationcost")).alias("cost"),
        F.count(F.lit(1)).alias("n"))
    cust = customer_labels(customers, codes).select(F.col("customername").alias("destinationname"), "corpcode")
    return (per_dest.join(cust, "destinationname", "inner").where(F.col("corpcode").isNotNull())
            .groupBy("corpcode").agg(sum0("cost").alias("cur_tc_issues")))


def return_unit_cost(flows: DataFrame, optimal: str = K.OPTIMAL_SCENARIO,
                     horizon: int = K.HORIZON_PERIODS) -> DataFrame:
    """Return cost per pallet per return origin, sourcing excluded."""
    f = flows.where((F.col("scenarioname") == optimal) & has("originname", K.RETURN_PREFIX)
                    & within_horizon(flows, "departingperiodname", horizon))
    g = f.groupBy("originname").agg(
        sum0("flowquantity").alias("flowquantity"),
        sum0(F.col("shipmentcost") + F.col("transportationcost")).alias("total_transportation_cost"))
    return g.withColumn("return_cost_per_pallet", safe_div("total_transportation_cost", "flowquantity"))


def removed_returns(account_values: DataFrame, codes: DataFrame, returns_note: str = K.RETURNS_NOTE) -> DataFrame:
    """Returns removed per (facility, account): ``sum(constraintvalue - account value)``.

    ``account_values`` is the sparse long form of :func:`plans.constraints.account_constraints`:
    rows with ``corp_code`` NULL hold the value every account shares, rows with a
    code hold that account's own value.  Output rows with ``corp_code`` NULL give
    the removed returns of every account that has no row of its own for the
    facility (all periods, Q15).
    """
    rs = account_values.where(F.col("notes") == returns_note)
    default = (rs.where(F.col("corp_code").isNull())
               .groupBy("facilityname")
               .agg(sum0(F.col("constraintvalue") - F.col("account_value")).alias("base_returns")))
    own = (rs.where(F.col("corp_code").isNotNull())
           .join(codes.select("corp_code").distinct(), "corp_code", "left_semi")
           .groupBy("facilityname", "corp_code")
           .agg(sum0(F.col("constraintvalue") - F.col("account_value")).alias("own_returns")))
    per_acct = own.join(default, "facilityname", "left").select(
        "facilityname", "corp_code",
        (F.coalesce(F.col("base_returns"), F.lit(0.0)) + F.col("own_returns")).alias("returns"))
    shared = default.select("facilityname", F.lit(None).cast("string").alias("corp_code"),
                            F.col("base_returns").alias("returns"))
    return per_acct.unionByName(shared)


def removed_returns_dense(wide: DataFrame, codes: DataFrame, returns_note: str = K.RETURNS_NOTE,
                          prefix: str = K.ACCOUNT_COLUMN_PREFIX) -> DataFrame:
    """Returns removed for every pair of return facility and account, from the wide constraint table (C17).

    One aggregate holds a sum per account column, so a row per facility is
    shuffled; only the sums are unpivoted.  Rows without a facility drop out, and
    accounts outside ``codes`` or without a column give no row.
    """
    accounts = [c for c in wide.columns if c.startswith(prefix)]
    rows = wide.where((F.col("notes") == returns_note) & F.col("facilityname").isNotNull())
    value = F.col("constraintvalue").cast("double")
    sums = rows.groupBy("facilityname").agg(F.count(F.lit(1)).alias("n_rows"), *[
        sum0(value - F.col(f"`{c}`").cast("double")).alias(c) for c in accounts])
    pairs = unpivot_prefixed(sums, ["facilityname"], prefix, value="returns")
    return pairs.join(codes.select("corp_code").distinct(), "corp_code", "left_semi").select("facilityname", "corp_code", "returns")


def current_return_cost(removed: DataFrame, unit_cost: DataFrame, customers: DataFrame, codes: DataFrame,
                        optimal: str = K.OPTIMAL_SCENARIO) -> DataFrame:
    """Removed returns x cost per pallet, summed per corp.

    Facilities without a unit cost contribute nothing (NULL is skipped by the
    sum).  The shared part (rows with ``corp_code`` NULL) is added to every
    account through an equi-join on the reference scenario name.
    """
    cpp = unit_cost.select(F.col("originname").alias("facilityname"), "return_cost_per_pallet")
    r = removed.join(cpp, "facilityname", "left").withColumn(
        "cost", F.col("returns") * F.col("return_cost_per_pallet"))
    shared = (r.where(F.col("corp_code").isNull())
              .agg(sum0("cost").alias("shared_cost"))
              .withColumn("scenarioname", F.lit(optimal)))
    # per account: own facilities replace the shared value of those facilities
    base = removed.where(F.col("corp_code").isNull()).select("facilityname", F.col("returns").alias("base"))
    own = (r.where(F.col("corp_code").isNotNull()).join(base, "facilityname", "left")
           .withColumn("base_cost", F.coalesce(F.col("base"), F.lit(0.0)) * F.col("return_cost_per_pallet"))
           .groupBy("corp_code").agg(sum0("cost").alias("own_cost"), sum0("base_cost").alias("own_base_cost")))
    labels = (customer_labels(customers, codes).select("corpcode", "Customer").distinct()
              .groupBy("corpcode").agg(F.count(F.lit(1)).alias("n_labels")))
    acc = (codes.select(F.col("corp_code").alias("corpcode")).distinct()
           .withColumn("scenarioname", F.lit(optimal))
           .join(labels, "corpcode", "inner")
           .join(own.withColumnRenamed("corp_code", "corpcode"), "corpcode", "left")
           .join(shared, "scenarioname", "left"))
    value = (F.coalesce(F.col("own_cost"), F.lit(0.0))
             + (F.coalesce(F.col("shared_cost"), F.lit(0.0)) - F.coalesce(F.col("own_base_cost"), F.lit(0.0))))
    return acc.select("corpcode", (value * F.col("n_labels")).alias("cur_tc_returns"))


# ---------------------------------------------------------------------------
# C20 account report
# ---------------------------------------------------------------------------

def account_report(kpis: DataFrame, issue_cost: DataFrame, return_cost: DataFrame, customers: DataFrame,
                   codes: DataFrame | None = None, eps: float = K.EPS, **kw) -> DataFrame:
    """Per-account issues, returns, R:I, six costs, inefficiency and six CPIs (C20)."""
    if codes is None:
        codes = less_codes(kpis)
    d = scenario_delta_rows(kpis, **kw).where(F.col("reference") == "Optimal")
    acct = d.select(
        F.col("corp_code").alias("corpcode"),
        (-F.col("issues")).alias("account_issues"),
        (-F.col("returns")).alias("account_returns"),
        (-F.col("tc_issues")).alias("opt_tc_issues"),
        (-F.col("tc_returns")).alias("opt_tc_returns"),
        (-F.col("tc_transfers")).alias("opt_tc_transfers"))
    j = acct.join(issue_cost, "corpcode", "full").join(return_cost, "corpcode", "full")
    c = F.col
    i = c("account_issues")
    cde = c("opt_tc_issues") + c("opt_tc_returns") + c("opt_tc_transfers")
    f = cde * F.lit(eps)
    transfers = (cde + f) - (c("cur_tc_issues") + c("cur_tc_returns"))
    labels = customer_labels(customers, codes).select("corpcode", "Customer").distinct()
    out = j.select(
        "corpcode", "account_issues", "account_returns",
        safe_div(c("account_returns"), i).alias("account_r_i"),
        "opt_tc_issues", "opt_tc_returns", "opt_tc_transfers", "cur_tc_issues", "cur_tc_returns",
        f.alias("cur_ops_inefficiency"), transfers.alias("cur_tc_transfers"),
        safe_div(c("cur_tc_issues"), i).alias("cur_tc_issues_cpi"),
        safe_div(c("cur_tc_returns"), i).alias("cur_tc_returns_cpi"),
        safe_div(transfers, i).alias("cur_tc_transfers_cpi"),
        safe_div(c("opt_tc_issues"), i).alias("opt_tc_issues_cpi"),
        safe_div(c("opt_tc_returns"), i).alias("opt_tc_returns_cpi"),
        safe_div(c("opt_tc_transfers"), i).alias("opt_tc_transfers_cpi"),
    )
    return out.join(labels, "corpcode", "inner").select("corpcode", "Customer", *[n for _, n in K.ACCOUNT_MEASURES])
