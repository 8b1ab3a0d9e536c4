"""Registered scenario-registration queries (C11-C13, C21, J12) and SQL twins."""

from __future__ import annotations

from servelens import constants as K
from servelens.plans import scenarios as S
from servelens.plans.constraint_queries import SEL_CTE, selected_from, typed_model
from servelens.registry import register
from servelens.sources.bindings import with_views

LESS = K.LESS_SCENARIO_PREFIX
OPT = K.OPTIMAL_SCENARIO
SEL_VIEWS = ("demand", "customers", "accounts")


def _sql(body: str, *views: str, ctes: str = "") -> str:
    return with_views(body, *(SEL_VIEWS + views), ctes=SEL_CTE.strip() + ("," + ctes if ctes.strip() else ""))


NEW_SCENARIOS = f"""
new_s AS (SELECT DISTINCT '{LESS}' || corp_code AS scenarioname, '{K.STATUS_INCLUDE}' AS status,
                 CAST(NULL AS VARCHAR) AS description, CAST(NULL AS VARCHAR) AS tags,
                 CAST(NULL AS VARCHAR) AS notes, CAST(NULL AS VARCHAR) AS technology FROM sel)"""


@register("scenario_insert_absent", _sql("""
SELECT * FROM scenarios_existing e WHERE NOT EXISTS (SELECT 1 FROM new_s n WHERE e.scenarioname = n.scenarioname)
UNION ALL
SELECT scenarioname, status, description, tags, notes, technology FROM (
  SELECT *, row_number() OVER (PARTITION BY scenarioname ORDER BY src, notes NULLS FIRST) AS rn FROM (
    SELECT e.*, 0 AS src FROM scenarios_existing e WHERE e.scenarioname IN (SELECT scenarioname FROM new_s)
    UNION ALL SELECT n.*, 1 FROM new_s n) u) f
WHERE rn = 1""", "scenarios_existing", ctes=NEW_SCENARIOS))
def q_scenarios(spark, sf_dir):
    """C11: one scenario per selected account, inserted when absent."""
    m = typed_model(spark, sf_dir, SEL_VIEWS + ("scenarios_existing",))
    return S.build_scenarios(m["scenarios_existing"], selected_from(m))


NEW_ITEMS = f"""
acc_d AS (SELECT corp_code FROM sel WHERE corp_code IN
          (SELECT c.corpcode FROM demand d JOIN customers c ON d.customername = c.customername)),
new_i AS (SELECT '{K.EXCLUDE_ITEM_PREFIX}' || corp_code AS itemname, '{K.EXCLUDE_ITEM_TABLE}' AS tablename,
                 '{K.EXCLUDE_ITEM_ACTION.replace("'", "''")}' AS action, 'corpcode=''' || corp_code || '''' AS condition,
                 '{K.STATUS_INCLUDE}' AS status, CAST(NULL AS VARCHAR) AS description, CAST(NULL AS VARCHAR) AS tags,
                 CAST(NULL AS VARCHAR) AS notes FROM acc_d
          UNION
          SELECT '{K.UPDATE_ITEM_PREFIX}' || corp_code, '{K.UPDATE_ITEM_TABLE}', '{K.UPDATE_ITEM_ACTION_PREFIX}' || corp_code,
                 CAST(NULL AS VARCHAR), '{K.STATUS_INCLUDE}', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
                 CAST(NULL AS VARCHAR) FROM acc_d)"""


@register("item_insert_absent", _sql("""
SELECT * FROM items_existing e WHERE NOT EXISTS (SELECT 1 FROM new_i n WHERE e.itemname = n.itemname)
UNION ALL
SELECT itemname, tablename, action, condition, status, description, tags, notes FROM (
  SELECT *, row_number() OVER (PARTITION BY itemname ORDER BY src, notes NULLS FIRST) AS rn FROM (
    SELECT e.*, 0 AS src FROM items_existing e WHERE e.itemname IN (SELECT itemname FROM new_i)
    UNION ALL SELECT n.*, 1 FROM new_i n) u) f
WHERE rn = 1""", "items_existing", ctes=NEW_ITEMS))
def q_items(spark, sf_dir):
    """Two items per account with demand, inserted when absent."""
    m = typed_model(spark, sf_dir, SEL_VIEWS + ("items_existing",))
    acc = S.accounts_with_demand(selected_from(m), m["demand"], m["customers"])
    return S.build_scenario_items(m["items_existing"], acc)


NEW_ASSIGN = f"""
base AS (SELECT * FROM assignments_existing WHERE scenarioname = '{OPT}'),
nb AS (SELECT count(*) AS n FROM base),
acc_s AS (SELECT DISTINCT corp_code, '{LESS}' || corp_code AS scenarioname FROM sel),
new_a AS (SELECT a.scenarioname, b.itemname, b.itemorder, CAST(NULL AS VARCHAR) AS notes FROM acc_s a, base b
          UNION ALL
          SELECT a.scenarioname, '{K.EXCLUDE_ITEM_PREFIX}' || a.corp_code, nb.n, CAST(NULL AS VARCHAR) FROM acc_s a, nb
          UNION ALL
          SELECT a.scenarioname, '{K.UPDATE_ITEM_PREFIX}' || a.corp_code, nb.n + 1, CAST(NULL AS VARCHAR) FROM acc_s a, nb)"""


@register("assignment_build", _sql("""
SELECT scenarioname, itemname, itemorder, notes FROM (
  -- the account's rows: one that is stored with the same order stays with its notes
  SELECT n.scenarioname, n.itemname, n.itemorder, e.notes
  FROM new_a n LEFT JOIN assignments_existing e
    ON e.scenarioname = n.scenarioname AND e.itemname = n.itemname AND e.itemorder = n.itemorder) w
UNION ALL
SELECT scenarioname, itemname, itemorder, notes FROM assignments_existing e
WHERE NOT EXISTS (SELECT 1 FROM new_a n WHERE n.scenarioname = e.scenarioname AND n.itemname = e.itemname)""",
                                   "assignments_existing", ctes=NEW_ASSIGN))
def q_assignments(spark, sf_dir):
    """Base items plus the account's two items per new scenario, upserted."""
    m = typed_model(spark, sf_dir, SEL_VIEWS + ("assignments_existing",))
    return S.build_scenario_assignments(m["assignments_existing"], selected_from(m))


@register("clean_names", with_views("""
SELECT corp_code, regexp_replace(replace(corp_desc, '&', 'And'), '[[:punct:]]', '', 'g') AS corp_desc, evaluate,
       base_model,
       left(base_model, length(base_model) - 1) || ' - '
         || regexp_replace(replace(corp_desc, '&', 'And'), '[[:punct:]]', '', 'g') || '\\' AS account_model
FROM accounts""", "accounts"))
def q_clean_names(spark, sf_dir):
    """Account names cleansed and the model path derived."""
    m = typed_model(spark, sf_dir, ("accounts",))
    return S.clean_account_names(m["accounts"])


@register("substring_lookup", with_views("""
SELECT d.customername, d.productname, d.periodname, CAST(d.quantity AS DOUBLE) AS quantity, c.corpcode AS "CorpCode", c.corpname, c.loccode
FROM demand d LEFT JOIN (SELECT customername, min(corpcode) AS corpcode, min(corpname) AS corpname,
                                min(loccode) AS loccode FROM customers GROUP BY customername) c
  ON d.customername = c.customername""", "demand", "customers"))
def q_substring_lookup(spark, sf_dir):
    """Find the customer of each demand row and append its corp fields."""
    from pyspark.sql import functions as F
    from servelens.operators.core import substring_lookup
    m = typed_model(spark, sf_dir, ("demand", "customers"))
    d = m["demand"].select("customername", "productname", "periodname", "quantity")
    c = m["customers"].select("customername", F.col("corpcode").alias("CorpCode"), "corpname", "loccode")
    return substring_lookup(d, c, "customername", "customername", ["CorpCode", "corpname", "loccode"])


@register("substring_contains", with_views("""
SELECT d.customername || ' dock' AS label, d.productname, d.periodname, CAST(d.quantity AS DOUBLE) AS quantity,
       b.corpcode AS "CorpCode", b.corpname, b.loccode
FROM demand d LEFT JOIN best b ON b.label = d.customername || ' dock' AND b.rn = 1""", "demand", "customers", ctes="""
labels AS (SELECT DISTINCT customername || ' dock' AS label FROM demand),
best AS (SELECT l.label, c.corpcode, c.corpname, c.loccode,
                row_number() OVER (PARTITION BY l.label ORDER BY length(c.customername) DESC, c.corpcode NULLS LAST,
                                   c.corpname NULLS LAST, c.loccode NULLS LAST) AS rn
         FROM labels l JOIN customers c ON contains(l.label, c.customername))"""))
def q_substring_contains(spark, sf_dir):
    """J12 (find any): customer named anywhere in a label; of names that contain one another the longest."""
    from pyspark.sql import functions as F
    from servelens.operators.core import substring_lookup
    m = typed_model(spark, sf_dir, ("demand", "customers"))
    d = m["demand"].select(F.concat("customername", F.lit(" dock")).alias("label"), "productname", "periodname", "quantity")
    c = m["customers"].select("customername", F.col("corpcode").alias("CorpCode"), "corpname", "loccode")
    return substring_lookup(d, c, "label", "customername", ["CorpCode", "corpname", "loccode"], contains=True)
