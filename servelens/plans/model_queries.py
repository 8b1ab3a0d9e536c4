"""Registered queries over several models in one pass (C4, C5, N1, T1) and their SQL twins.

Three models are derived from the tables: ``all`` (every row), ``odd`` (customers and facilities of
odd number, four days of cover, ten periods, opening in period 2) and ``flat`` (demand in the first
period only and no constraints, so that the gap is the same in all later periods: a tie).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from servelens import constants as K
from servelens.plans import constraints as C
from servelens.plans.constraint_queries import DEPOT, IS_R, NOT_R, typed_model
from servelens.registry import register
from servelens.sources.bindings import with_views

VIEWS = ("constraints", "demand", "inventory_policies", "periods")
MODELS = ("all", "odd", "flat")
ODD_DEPOT, ODD_HORIZON, ODD_DAYS, ODD_OPENING = "D_3", 10, 4, "Period 02"
PARAMETERS = "model_id string, horizon int, cover_days int, first_period string, special_depot string"
COLUMNS = ["model_id", "periodname", "quantity", "returns", "initialinventory", "mfg", "workingdays", "begin_inventory",
           "end_inventory", "gap_6days", "period_no"]


def several_models(spark, sf_dir):
    """The four inputs of the projection with ``model_id``, and the parameter table."""
    m = typed_model(spark, sf_dir, VIEWS)
    odd = lambda c: F.substring(c, -1, 1).try_cast("int") % 2 == 1
    tag = lambda df, name: df.withColumn("model_id", F.lit(name))
    first = F.col("periodname") == K.FIRST_PERIOD
    flat = m["demand"].withColumn("quantity", F.when(first, F.col("quantity")).otherwise(F.lit(0.0)))
    early = F.col("periodname") >= ODD_OPENING
    demand = [tag(m["demand"], "all"), tag(m["demand"].where(odd("customername") & early), "odd"), tag(flat, "flat")]
    constraints = [tag(m["constraints"], "all"), tag(m["constraints"].where(F.coalesce(odd("facilityname"), F.lit(False)) & early), "odd")]
    stocks = [tag(m["inventory_policies"], "all"), tag(m["inventory_policies"].where(odd("facilityname")), "odd"),
              tag(m["inventory_policies"], "flat")]
    united = lambda dfs: reduce(lambda a, b: a.unionByName(b), dfs)
    periods = united([tag(m["periods"], name) for name in MODELS])
    parameters = spark.createDataFrame([("odd", ODD_HORIZON, ODD_DAYS, ODD_OPENING, ODD_DEPOT)], PARAMETERS)
    return united(constraints), united(demand), united(stocks), periods, parameters


def projections(spark, sf_dir):
    pc, demand, stocks, periods, parameters = several_models(spark, sf_dir)
    return C.inventory_projection(pc, demand, stocks, periods, model="model_id", parameters=parameters), pc, parameters


ODD_C = "CAST(right(customername, 1) AS INTEGER) % 2 = 1"
ODD_F = "coalesce(try_cast(right(facilityname, 1) AS INTEGER) % 2 = 1, false)"
CTES = f"""
m_demand AS (SELECT 'all' AS model_id, periodname, CAST(quantity AS DOUBLE) AS quantity FROM demand
             UNION ALL SELECT 'odd', periodname, CAST(quantity AS DOUBLE) FROM demand WHERE {ODD_C} AND periodname >= '{ODD_OPENING}'
             UNION ALL SELECT 'flat', periodname, CASE WHEN periodname = '{K.FIRST_PERIOD}' THEN CAST(quantity AS DOUBLE) ELSE 0 END FROM demand),
m_pc AS (SELECT 'all' AS model_id, facilityname, productname, periodname, CAST(constraintvalue AS DOUBLE) AS constraintvalue FROM constraints
         UNION ALL SELECT 'odd', facilityname, productname, periodname, CAST(constraintvalue AS DOUBLE) FROM constraints
         WHERE {ODD_F} AND periodname >= '{ODD_OPENING}'),
m_init AS (SELECT 'all' AS model_id, '{K.FIRST_PERIOD}' AS periodname, sum(CAST(initialinventory AS DOUBLE)) AS i FROM inventory_policies
           UNION ALL SELECT 'odd', '{ODD_OPENING}', sum(CAST(initialinventory AS DOUBLE)) FROM inventory_policies WHERE {ODD_F}
           UNION ALL SELECT 'flat', '{K.FIRST_PERIOD}', sum(CAST(initialinventory AS DOUBLE)) FROM inventory_policies),
m_par AS (SELECT * FROM (VALUES ('all', {K.HORIZON_PERIODS}, {K.COVER_DAYS}, '{DEPOT}'), ('odd', {ODD_HORIZON}, {ODD_DAYS}, '{ODD_DEPOT}'),
                                ('flat', {K.HORIZON_PERIODS}, {K.COVER_DAYS}, '{DEPOT}')) v(model_id, horizon, days, depot)),
m_q AS (SELECT model_id, periodname, sum(quantity) AS quantity FROM m_demand GROUP BY ALL),
m_r AS (SELECT model_id, periodname, sum(constraintvalue) AS returns FROM m_pc WHERE {IS_R} AND periodname IS NOT NULL GROUP BY ALL),
m_m AS (SELECT model_id, periodname, sum(constraintvalue) AS mfg FROM m_pc
        WHERE {NOT_R} AND productname = '{K.PRODUCT_NEW}' AND periodname IS NOT NULL GROUP BY ALL),
m_left AS (SELECT q.model_id, q.periodname, q.quantity, r.returns, i.i FROM m_q q
           LEFT JOIN m_r r USING (model_id, periodname) LEFT JOIN m_init i USING (model_id, periodname)),
m_rows AS (SELECT model_id, periodname, coalesce(quantity, 0) AS quantity, coalesce(returns, 0) AS returns, coalesce(i, 0) AS initialinventory,
                  coalesce(mfg, 0) AS mfg, CAST(coalesce(w.workingdays, 0) AS INTEGER) AS workingdays,
                  row_number() OVER (PARTITION BY model_id ORDER BY periodname) AS rn
           FROM m_left FULL JOIN m_m USING (model_id, periodname) LEFT JOIN periods w USING (periodname)
           WHERE regexp_full_match(periodname, 'Period [0-9]+')),
m_loop(model_id, rn, begin_inventory) AS (
    SELECT model_id, rn, initialinventory FROM m_rows WHERE rn = 1
    UNION ALL
    SELECT cur.model_id, cur.rn, CASE WHEN cur.initialinventory > 0 THEN cur.initialinventory
                                      ELSE s.begin_inventory + prv.returns + prv.mfg - prv.quantity END
    FROM m_loop s JOIN m_rows cur ON cur.model_id = s.model_id AND cur.rn = s.rn + 1
    JOIN m_rows prv ON prv.model_id = s.model_id AND prv.rn = s.rn),
m_proj AS (SELECT r.model_id, r.periodname, r.quantity, r.returns, r.initialinventory, r.mfg, r.workingdays, l.begin_inventory,
                  l.begin_inventory + r.returns + r.mfg - r.quantity AS end_inventory,
                  CASE WHEN r.workingdays <> 0 THEN round_even(r.quantity / r.workingdays * p.days - l.begin_inventory, 0) END AS gap_6days,
                  CAST(split_part(r.periodname, ' ', 2) AS INTEGER) AS period_no
           FROM m_rows r JOIN m_loop l USING (model_id, rn) JOIN m_par p USING (model_id)
           WHERE CAST(split_part(r.periodname, ' ', 2) AS INTEGER) <= p.horizon),
m_worst AS (SELECT * FROM m_proj p WHERE gap_6days = (SELECT max(gap_6days) FROM m_proj x WHERE x.model_id = p.model_id)),
m_tied AS (SELECT model_id, period_no, gap_6days, row_number() OVER (PARTITION BY model_id ORDER BY period_no) - 1 AS tie,
                  min(period_no) OVER (PARTITION BY model_id) - 1 AS n FROM m_worst),
m_up AS (SELECT model_id, 'Period 0' || CAST(period_no - (tie * n + j) AS VARCHAR) AS periodname, gap_6days / (period_no - 1) AS needed_mfg
         FROM (SELECT *, unnest(generate_series(1, n)) AS j FROM m_tied WHERE n > 0) t)"""


def _sql(body: str) -> str:
    return with_views(body, *VIEWS, ctes=CTES, recursive=True)


@register("model_projections", _sql(f"SELECT {', '.join(COLUMNS)} FROM m_proj"))
def q_model_projections(spark, sf_dir):
    """Three models with their own horizon, cover and opening period, projected in one pass."""
    return projections(spark, sf_dir)[0].select(*COLUMNS)


@register("model_worst_gaps", _sql(f"SELECT {', '.join(COLUMNS)} FROM m_worst"))
def q_model_worst_gaps(spark, sf_dir):
    """The worst periods of each model; one model has a tie of all its later periods."""
    return C.worst_gap(projections(spark, sf_dir)[0], "model_id").select(*COLUMNS)


@register("model_uplifts", _sql(f"""
SELECT c.model_id, c.facilityname, c.periodname, c.constraintvalue,
       CASE WHEN c.facilityname = p.depot THEN c.constraintvalue + coalesce(u.needed_mfg, 0) END AS adjusted_constraintvalue
FROM m_pc c JOIN m_par p USING (model_id) LEFT JOIN m_up u ON c.facilityname = p.depot AND u.model_id = c.model_id AND u.periodname = c.periodname
WHERE {NOT_R} AND productname = '{K.PRODUCT_NEW}'
UNION ALL
SELECT model_id, 'uplift', periodname, NULL, needed_mfg FROM m_up"""))
def q_model_uplifts(spark, sf_dir):
    """Each model's worst gap spread over its earlier periods and added at its own depot."""
    proj, pc, parameters = projections(spark, sf_dir)
    up = C.uplift_rows(proj, model="model_id")
    out = C.manufacturing_uplift(pc, up, DEPOT, "model_id", parameters)
    columns = ["model_id", "facilityname", "periodname", "constraintvalue", "adjusted_constraintvalue"]
    rows = up.select("model_id", F.lit("uplift").alias("facilityname"), "periodname", F.lit(None).cast("double").alias("constraintvalue"),
                     F.col("needed_mfg").alias("adjusted_constraintvalue"))
    return out.select(*columns).unionByName(rows)
