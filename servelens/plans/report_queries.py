"""Registered reporting queries (C14-C20) and their SQL twins."""

from __future__ import annotations

from servelens import constants as K
from servelens.operators.core import materialize
from servelens.plans import reporting as R
from servelens.registry import register
from servelens.sources import bindings as B
from servelens.sources.bindings import with_views

H = K.HORIZON_PERIODS
OPT = K.OPTIMAL_SCENARIO
BASE = K.BASELINE_SCENARIO

KPI_VIEWS = ("flows", "facilities", "facility_summary", "warehousing_summary", "inventory_summary",
             "production_summary")


def kpis_from(spark, sf_dir, lines=None):
    m = B.model(spark, sf_dir, KPI_VIEWS, lines)
    return R.scenario_kpis(m["flows"], m["facility_summary"], m["warehousing_summary"],
                           m["inventory_summary"], m["production_summary"], m["facilities"])


# the KPI table written the way the modelled script computes it: ten filtered
# group sums aligned on the scenario name, then derived measures
KPI_SQL_CTES = f"""
fl AS (SELECT *, CAST(right(departingperiodname, 2) AS INTEGER) AS pno FROM flows WHERE scenarioname IS NOT NULL),
m_issues AS (SELECT scenarioname, coalesce(sum(flowquantity), 0) AS issues FROM fl
             WHERE contains(destinationname, '{K.ISSUE_PREFIX}') AND pno <= {H} GROUP BY scenarioname),
m_returns AS (SELECT scenarioname, coalesce(sum(flowquantity), 0) AS returns FROM fl
              WHERE contains(originname, '{K.RETURN_PREFIX}') AND pno <= {H} GROUP BY scenarioname),
m_tci AS (SELECT scenarioname, coalesce(sum(shipmentcost + transportationcost), 0) AS tc_issues FROM fl
          WHERE contains(destinationname, '{K.ISSUE_PREFIX}') AND pno <= {H} GROUP BY scenarioname),
m_tcr AS (SELECT scenarioname, coalesce(sum(shipmentcost + sourcingcost + transportationcost), 0) AS tc_returns FROM fl
          WHERE contains(originname, '{K.RETURN_PREFIX}') AND pno <= {H} GROUP BY scenarioname),
m_tct AS (SELECT scenarioname, coalesce(sum(shipmentcost + sourcingcost + transportationcost), 0) AS tc_transfers FROM fl
          WHERE NOT coalesce(contains(destinationname, '{K.ISSUE_PREFIX}'), false)
            AND NOT coalesce(contains(originname, '{K.RETURN_PREFIX}'), false) AND pno <= {H} GROUP BY scenarioname),
m_fixed AS (SELECT scenarioname, coalesce(sum(operatingcost), 0) AS depot_fixed FROM facility_summary
            WHERE scenarioname IS NOT NULL AND CAST(right(periodname, 2) AS INTEGER) <= {H} GROUP BY scenarioname),
m_paint AS (SELECT scenarioname, coalesce(sum(sourcingcost), 0) AS depot_painting FROM fl
            WHERE NOT EXISTS (SELECT 1 FROM facilities f WHERE f.depottype = '{K.MANUFACTURING_TYPE}'
                              AND f.facilityname = fl.originname)
              AND pno <= {H} GROUP BY scenarioname),
m_handling AS (SELECT scenarioname, coalesce(sum(inboundhandlingcost + outboundhandlingcost), 0) AS depot_handling
               FROM warehousing_summary WHERE scenarioname IS NOT NULL AND CAST(right(periodname, 2) AS INTEGER) <= {H}
               GROUP BY scenarioname),
m_inventory AS (SELECT scenarioname, coalesce(sum(totalinventorycost), 0) AS depot_inventory FROM inventory_summary
                WHERE scenarioname IS NOT NULL AND CAST(right(periodname, 2) AS INTEGER) <= {H} GROUP BY scenarioname),
m_repair AS (SELECT scenarioname, coalesce(sum(productioncost), 0) AS depot_repair FROM production_summary
             WHERE scenarioname IS NOT NULL AND bomname = '{K.REPAIR_BOM}'
               AND CAST(right(startingperiodname, 2) AS INTEGER) <= {H} GROUP BY scenarioname),
m_keys AS (SELECT scenarioname FROM m_issues UNION SELECT scenarioname FROM m_returns
           UNION SELECT scenarioname FROM m_tci UNION SELECT scenarioname FROM m_tcr
           UNION SELECT scenarioname FROM m_tct UNION SELECT scenarioname FROM m_fixed
           UNION SELECT scenarioname FROM m_paint UNION SELECT scenarioname FROM m_handling
           UNION SELECT scenarioname FROM m_inventory UNION SELECT scenarioname FROM m_repair),
m_all AS (SELECT * FROM m_keys LEFT JOIN m_issues USING (scenarioname) LEFT JOIN m_returns USING (scenarioname)
          LEFT JOIN m_tci USING (scenarioname) LEFT JOIN m_tcr USING (scenarioname)
          LEFT JOIN m_tct USING (scenarioname) LEFT JOIN m_fixed USING (scenarioname)
          LEFT JOIN m_paint USING (scenarioname) LEFT JOIN m_handling USING (scenarioname)
          LEFT JOIN m_inventory USING (scenarioname) LEFT JOIN m_repair USING (scenarioname)),
kpis AS (
SELECT scenarioname, issues, returns, returns / nullif(issues, 0) AS network_r_i,
       tc_issues, tc_returns, tc_transfers, tc_issues + tc_returns + tc_transfers AS tc_total,
       depot_fixed, depot_painting, depot_handling, depot_inventory, depot_repair,
       depot_fixed + depot_painting + depot_handling + depot_repair AS depot_total,
       (depot_painting + depot_handling + depot_repair) / nullif(issues, 0) AS variable_depot_cpi,
       depot_fixed / nullif(issues, 0) AS fixed_depot_cpi,
       (tc_issues + tc_returns + tc_transfers) / nullif(issues, 0)
         + ((depot_painting + depot_handling + depot_repair) / nullif(issues, 0) + depot_fixed / nullif(issues, 0))
         AS total_cpi
FROM m_all)"""

MEASURE_LIST = ", ".join(R.MEASURES)


def kpi_sql(body: str, *extra_views: str, ctes: str = "") -> str:
    return with_views(body, *(KPI_VIEWS + extra_views), ctes=KPI_SQL_CTES.strip() + ",\n" + ctes)


@register("scenario_kpis", kpi_sql(f"SELECT scenarioname, {MEASURE_LIST} FROM kpis"))
def q_scenario_kpis(spark, sf_dir):
    """C14: 16 measures per scenario."""
    return kpis_from(spark, sf_dir)


DELTAS_SQL_CTES = f"""
deltas AS (
SELECT 'Removing ' || right(l.scenarioname, 5) || ' - ' || r.reference AS scenarioname,
       right(l.scenarioname, 5) AS corp_code, r.reference,
       {", ".join(f"l.{m} - r.{m} AS {m}" for m in R.MEASURES)}
FROM kpis l
JOIN (SELECT 'Baseline' AS reference, * FROM kpis WHERE scenarioname = '{BASE}'
      UNION ALL SELECT 'Optimal' AS reference, * FROM kpis WHERE scenarioname = '{OPT}') r ON true
WHERE contains(l.scenarioname, '{K.LESS_MARKER}'))"""


@register("scenario_deltas", kpi_sql(f"""
SELECT scenarioname, {MEASURE_LIST} FROM kpis
UNION ALL SELECT scenarioname, {MEASURE_LIST} FROM deltas""", ctes=DELTAS_SQL_CTES))
def q_scenario_deltas(spark, sf_dir):
    """Scenario rows plus 'Removing <code> - Baseline/Optimal' delta rows."""
    return R.scenario_deltas(materialize(kpis_from(spark, sf_dir)))   # one row per scenario, read twice


CUSTOMER_SQL = f"""
codes AS (SELECT DISTINCT right(scenarioname, 5) AS corp_code FROM flows WHERE contains(scenarioname, '{K.LESS_MARKER}')),
cust AS (SELECT DISTINCT loccode, customername, corpcode, corpname, corpcode || ' - ' || corpname AS "Customer"
         FROM customers WHERE corpcode IN (SELECT corp_code FROM codes))"""


@register("current_issue_cost", with_views(f"""
SELECT c.corpcode, coalesce(sum(f.shipmentcost + f.sourcingcost + f.transportationcost), 0) AS cur_tc_issues
FROM flows f JOIN cust c ON f.destinationname = c.customername
WHERE contains(f.destinationname, '{K.ISSUE_PREFIX}') AND CAST(right(f.departingperiodname, 2) AS INTEGER) <= {H}
  AND f.scenarioname = '{OPT}' AND c.corpcode IS NOT NULL
GROUP BY c.corpcode""", "flows", "customers", ctes=CUSTOMER_SQL))
def q_current_issue_cost(spark, sf_dir):
    """Issue cost per corp in the optimal scenario."""
    m = B.model(spark, sf_dir, ("flows", "customers"))
    return R.current_issue_cost(m["flows"], m["customers"], R.less_codes(m["flows"]))


@register("return_unit_cost", with_views(f"""
SELECT originname, coalesce(sum(flowquantity), 0) AS flowquantity,
       coalesce(sum(shipmentcost + transportationcost), 0) AS total_transportation_cost,
       coalesce(sum(shipmentcost + transportationcost), 0) / nullif(coalesce(sum(flowquantity), 0), 0)
         AS return_cost_per_pallet
FROM flows
WHERE scenarioname = '{OPT}' AND contains(originname, '{K.RETURN_PREFIX}')
  AND CAST(right(departingperiodname, 2) AS INTEGER) <= {H}
GROUP BY originname""", "flows"))
def q_return_unit_cost(spark, sf_dir):
    """Cost per returned pallet per return origin."""
    return R.return_unit_cost(B.view(spark, sf_dir, "flows"))

