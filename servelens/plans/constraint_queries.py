"""Registered constraint queries (C1-C10, C17, C19, C20) and their SQL twins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from servelens import constants as K
from servelens.operators.core import materialize, unpivot_prefixed
from servelens.plans import constraints as C
from servelens.plans import reporting as R
from servelens.plans.report_queries import CUSTOMER_SQL, DELTAS_SQL_CTES, KPI_SQL_CTES, KPI_VIEWS, kpis_from
from servelens.registry import ORACLE, register
from servelens.sinks.wide import publish_blocks, unpivot_accounts
from servelens.sinks.writers import to_wide
from servelens.sources import bindings as B
from servelens.sources import tables as T
from servelens.sources.bindings import with_views

DEPOT = B.SPECIAL_DEPOT_TESTDATA
KEYS = list(K.CONSTRAINT_KEYS)
KEY_LIST = ", ".join(KEYS)


# ---------------------------------------------------------------------------
# Spark side: the typed model
# ---------------------------------------------------------------------------

def typed_model(spark, sf_dir, names, lines=None):
    m = B.model(spark, sf_dir, names, lines)
    if "constraints" in m:
        m["constraints"] = T.typed_constraints(m["constraints"])
    if "demand" in m:
        m["demand"] = T.typed_demand(m["demand"])
    if "inventory_policies" in m:
        m["inventory_policies"] = T.typed_inventory(m["inventory_policies"])
    return m


SELECTION_INPUTS = ("accounts", "demand", "customers")
ACCOUNT_INPUTS = ("constraints", "demand", "customers", "inventory_policies", "periods", "transfers", "accounts")


def selected_from(m):
    return C.select_accounts(m["accounts"], m["demand"], m["customers"])


def account_values_from(spark, sf_dir, stored: bool = True, persist: bool = True, row_ids: bool = False, lines=None):
    """Per-account constraint values.  The process writes them once (for the
    solver) and the reports read the written table: when ``sf_dir`` holds it
    (``account_values.parquet``) it is read, otherwise computed; so are row ids that it lacks."""
    if stored and B._exists(spark, f"{sf_dir}/account_values.parquet"):
        values = spark.read.parquet(f"{sf_dir}/account_values.parquet")
        if not row_ids or "match_id" in values.columns:
            return values
    m = typed_model(spark, sf_dir, ACCOUNT_INPUTS, lines)
    return C.build_account_constraints(m["constraints"], m["demand"], m["customers"], m["inventory_policies"],
                                       m["periods"], m["transfers"], selected_from(m), special_depot=DEPOT,
                                       persist=persist, row_ids=row_ids)


def round6(df, *cols):
    """Oracle hygiene: sums of values with 6 decimals (or products with a
    ratio) are rounded to 6 decimals so float summation order cannot show."""
    return df.select(*[F.round(c, 6).alias(c) if c in cols else F.col(c) for c in df.columns])


# ---------------------------------------------------------------------------
# SQL side: the same steps written plainly
# ---------------------------------------------------------------------------

NOT_R = f"NOT coalesce(starts_with(facilityname, '{K.RETURN_PREFIX}'), false)"
IS_R = f"coalesce(starts_with(facilityname, '{K.RETURN_PREFIX}'), false)"
NOTES = ", ".join(f"'{n}'" for n in K.REPAIR_NOTES)

SEL_CTE = """
sel AS (SELECT corp_code, corp_desc, min(evaluate) AS evaluate FROM accounts
        WHERE lower(evaluate) = 'y'
          AND corp_code IN (SELECT c.corpcode FROM demand d LEFT JOIN customers c ON d.customername = c.customername
                            WHERE c.corpcode IS NOT NULL)
        GROUP BY corp_code, corp_desc)"""

BASE_CTES = f"""
pc AS (SELECT facilityname, facilitynamegroupbehavior, productname, productnamegroupbehavior, periodname,
              periodnamegroupbehavior, bomname, bomnamegroupbehavior, processname, processnamegroupbehavior,
              constrainttype, constraintvalueuom,
              CASE WHEN notes IN ({NOTES}) THEN '{K.STATUS_INCLUDE}' ELSE status END AS status,
              notes, soipquantity, conversionnotes, status AS original_status_field,
              CAST(constraintvalue AS DOUBLE) AS constraintvalue
       FROM constraints),
dq AS (SELECT customername, periodname, CAST(quantity AS DOUBLE) AS quantity FROM demand),
""" + SEL_CTE.strip()

PROJ_CTES = f"""
p_ret AS (SELECT periodname, coalesce(sum(constraintvalue), 0) AS returns FROM pc
          WHERE {IS_R} AND periodname IS NOT NULL GROUP BY periodname),
p_mfg AS (SELECT periodname, coalesce(sum(constraintvalue), 0) AS mfg FROM pc
          WHERE {NOT_R} AND productname = '{K.PRODUCT_NEW}' AND periodname IS NOT NULL GROUP BY periodname),
p_qty AS (SELECT periodname, coalesce(sum(quantity), 0) AS quantity FROM dq WHERE periodname IS NOT NULL GROUP BY periodname),
p_init AS (SELECT '{K.FIRST_PERIOD}' AS periodname, coalesce(sum(CAST(initialinventory AS DOUBLE)), 0) AS initialinventory
           FROM inventory_policies),
p_left AS (SELECT q.periodname, q.quantity, r.returns, i.initialinventory FROM p_qty q
           LEFT JOIN p_ret r ON q.periodname = r.periodname LEFT JOIN p_init i ON q.periodname = i.periodname),
p_all AS (SELECT coalesce(l.periodname, m.periodname) AS periodname, coalesce(l.quantity, 0) AS quantity,
                 coalesce(l.returns, 0) AS returns, coalesce(l.initialinventory, 0) AS initialinventory,
                 coalesce(m.mfg, 0) AS mfg, CAST(coalesce(w.workingdays, 0) AS INTEGER) AS workingdays
          FROM p_left l FULL JOIN p_mfg m ON l.periodname = m.periodname
          LEFT JOIN periods w ON coalesce(l.periodname, m.periodname) = w.periodname),
p_rows AS (SELECT *, row_number() OVER (ORDER BY periodname) AS rn FROM p_all
           WHERE regexp_full_match(periodname, 'Period [0-9]+')),
p_loop(rn, begin_inventory) AS (
    SELECT rn, initialinventory FROM p_rows WHERE rn = 1
    UNION ALL
    SELECT cur.rn, CASE WHEN cur.initialinventory > 0 THEN cur.initialinventory
                        ELSE prev_state.begin_inventory + prv.returns + prv.mfg - prv.quantity END
    FROM p_loop prev_state JOIN p_rows cur ON cur.rn = prev_state.rn + 1 JOIN p_rows prv ON prv.rn = prev_state.rn),
proj AS (SELECT r.periodname, r.quantity, r.returns, r.initialinventory, r.mfg, r.workingdays, l.begin_inventory,
                l.begin_inventory + r.returns + r.mfg - r.quantity AS end_inventory,
                CASE WHEN r.workingdays <> 0 THEN round_even(r.quantity / r.workingdays * {K.COVER_DAYS} - l.begin_inventory, 0) END
                  AS gap_6days,
                CAST(split_part(r.periodname, ' ', 2) AS INTEGER) AS period_no
         FROM p_rows r JOIN p_loop l ON r.rn = l.rn
         WHERE CAST(split_part(r.periodname, ' ', 2) AS INTEGER) <= {K.HORIZON_PERIODS})"""

UPLIFT_CTES = f"""
worst AS (SELECT period_no, gap_6days FROM proj WHERE gap_6days = (SELECT max(gap_6days) FROM proj)),
wt AS (SELECT period_no, gap_6days, row_number() OVER (ORDER BY period_no) - 1 AS tie,
              first_value(period_no) OVER (ORDER BY period_no) - 1 AS n,
              CASE WHEN period_no - 1 <> 0 THEN gap_6days / (period_no - 1) END AS needed_mfg
       FROM worst),
wj AS (SELECT period_no, tie, n, needed_mfg, unnest(generate_series(1, n)) AS j FROM wt WHERE n > 0),
up AS (SELECT 'Period 0' || CAST(period_no - (tie * n + j) AS VARCHAR) AS periodname, needed_mfg FROM wj),
new_rows AS (SELECT * FROM pc WHERE {NOT_R} AND productname = '{K.PRODUCT_NEW}'),
mfg_adj AS (SELECT n.*, n.constraintvalue + coalesce(u.needed_mfg, 0) AS adjusted_constraintvalue
            FROM new_rows n LEFT JOIN up u ON n.periodname = u.periodname WHERE n.facilityname = '{DEPOT}'
            UNION ALL
            SELECT n.*, CAST(NULL AS DOUBLE) AS adjusted_constraintvalue FROM new_rows n
            WHERE n.facilityname IS DISTINCT FROM '{DEPOT}'),
unchanged AS (SELECT *, constraintvalue AS adjusted_constraintvalue FROM pc
              WHERE {NOT_R} AND facilityname IS DISTINCT FROM '{K.DEPOT_GROUP}'
                AND productname IS DISTINCT FROM '{K.PRODUCT_NEW}')"""

ACCOUNT_CTES = f"""
pairs AS (SELECT renter_corp_code, return_loc_code, coalesce(sum(return_volume), 0) AS return_volume FROM transfers
          WHERE renter_corp_code IS NOT NULL AND return_loc_code IS NOT NULL GROUP BY renter_corp_code, return_loc_code),
totals AS (SELECT renter_corp_code, sum(return_volume) AS total FROM pairs
           WHERE renter_corp_code IN (SELECT corp_code FROM sel) GROUP BY renter_corp_code),
shares AS (SELECT p.renter_corp_code AS corp_code, p.return_loc_code, p.return_volume,
                  p.return_volume / nullif(t.total, 0) AS share
           FROM pairs p JOIN totals t ON p.renter_corp_code = t.renter_corp_code),
ad AS (SELECT c.corpcode AS corp_code, d.periodname, coalesce(sum(d.quantity), 0) AS quantity
       FROM dq d LEFT JOIN customers c ON d.customername = c.customername
       WHERE c.corpcode IN (SELECT corp_code FROM sel) AND d.periodname IS NOT NULL
       GROUP BY c.corpcode, d.periodname),
r2 AS (SELECT pc.*, ad.corp_code, ad.quantity, nullif(split_part(pc.facilityname, '_', 3), '') AS loc
       FROM pc JOIN ad ON pc.periodname = ad.periodname WHERE coalesce(starts_with(pc.facilityname, '{K.RETURN_PREFIX}'), false)),
r4 AS (SELECT corp_code, facilityname, periodname, sum(constraintvalue) AS tot FROM r2
       GROUP BY corp_code, facilityname, periodname),
r5 AS (SELECT r2.*, coalesce(s.share, 0) AS share, r4.tot,
              r2.constraintvalue / nullif(r4.tot, 0) * (r2.quantity * coalesce(s.share, 0) * CAST({K.LOSS_RATE} AS DOUBLE)) AS removed
       FROM r2 LEFT JOIN shares s ON s.corp_code = r2.corp_code AND s.return_loc_code = r2.loc
       JOIN r4 ON r4.corp_code = r2.corp_code AND r4.facilityname = r2.facilityname AND r4.periodname = r2.periodname),
adj_all AS (SELECT * EXCLUDE (removed, loc, share, tot),
               round_even(constraintvalue - CASE WHEN removed IS NULL THEN NULL
                                                 WHEN constraintvalue < removed THEN constraintvalue
                                                 ELSE removed END, {K.ROUND_SCALE}) AS adjusted_constraintvalue
        FROM r5),
adj AS (SELECT * FROM adj_all WHERE adjusted_constraintvalue IS DISTINCT FROM constraintvalue),
g AS (SELECT corp_code, productname, periodname, coalesce(sum(constraintvalue), 0) AS cv_sum,
             coalesce(sum(adjusted_constraintvalue), 0) AS adj_sum
      FROM adj_all WHERE productname IS NOT NULL AND periodname IS NOT NULL GROUP BY corp_code, productname, periodname),
wip AS (SELECT corp_code, periodname, CAST(floor(cv_sum - adj_sum) AS DOUBLE) AS wip FROM g WHERE productname = '{K.PRODUCT_WIP}'),
dep_all AS (SELECT pc.* REPLACE (CAST(NULL AS VARCHAR) AS productname), w.corp_code, w.wip,
               pc.constraintvalue - w.wip AS adjusted_constraintvalue
        FROM pc JOIN wip w ON pc.periodname = w.periodname
        WHERE {NOT_R.replace('facilityname', 'pc.facilityname')} AND pc.facilityname = '{K.DEPOT_GROUP}'),
dep AS (SELECT * FROM dep_all WHERE wip <> 0)"""


def _final_cols(alias: str) -> str:
    return ", ".join(f"{alias}.original_status_field AS status" if k == "status" else f"{alias}.{k}" for k in KEYS)


_JOIN_ON = " AND ".join(f"b.{k} IS NOT DISTINCT FROM s.{k}" for k in KEYS)

ACV_CTES = f"""
shared AS (SELECT {_final_cols('u')}, u.adjusted_constraintvalue FROM
           (SELECT * FROM unchanged UNION ALL SELECT * FROM mfg_adj) u),
per_acct AS (SELECT a.corp_code, {_final_cols('a')}, a.adjusted_constraintvalue FROM
             (SELECT {KEY_LIST}, corp_code, adjusted_constraintvalue FROM adj_all
              UNION ALL SELECT {KEY_LIST}, corp_code, adjusted_constraintvalue FROM dep_all) a),
pc_no AS (SELECT row_number() OVER () AS row_no, * FROM pc),
own AS (SELECT {", ".join("b." + k for k in KEYS)}, b.constraintvalue, s.corp_code,
               coalesce(s.adjusted_constraintvalue, b.constraintvalue) AS account_value,
               count(*) OVER (PARTITION BY b.row_no, s.corp_code) AS n_match
        FROM pc_no b JOIN per_acct s ON {_JOIN_ON}),
acv AS (SELECT {", ".join("b." + k for k in KEYS)}, b.constraintvalue, CAST(NULL AS VARCHAR) AS corp_code,
               coalesce(s.adjusted_constraintvalue, b.constraintvalue) AS account_value
        FROM pc b LEFT JOIN shared s ON {_JOIN_ON}
        UNION ALL
        SELECT {KEY_LIST}, constraintvalue, corp_code, account_value FROM own
        WHERE n_match > 1 OR account_value IS DISTINCT FROM constraintvalue)"""

MODEL_VIEWS = ("constraints", "demand", "customers", "inventory_policies", "periods", "transfers", "accounts")


def model_sql(body: str, *parts: str, views=MODEL_VIEWS) -> str:
    return with_views(body, *views, ctes=",\n".join(p.strip() for p in (BASE_CTES,) + parts), recursive=True)


# ---------------------------------------------------------------------------
# registered queries
# ---------------------------------------------------------------------------

TK = ", ".join(K.TRANSFER_KEYS)


@register("transfer_matrix_sum", with_views(f"""
SELECT {TK}, coalesce(sum(return_volume), 0) AS return_volume FROM transfers
WHERE {" AND ".join(k + " IS NOT NULL" for k in K.TRANSFER_KEYS)}
GROUP BY {TK}""", "transfers"))
def q_transfer_matrix(spark, sf_dir):
    """Monthly transfer files unioned and summed by the six keys (A1)."""
    return C.transfer_matrix(B.view(spark, sf_dir, "transfers"))


@register("account_selection", model_sql("SELECT corp_code, corp_desc, evaluate FROM sel",
                                         views=("demand", "customers", "accounts")))
def q_account_selection(spark, sf_dir):
    """Flagged accounts with demand through their customers."""
    m = typed_model(spark, sf_dir, ("demand", "customers", "accounts"))
    return selected_from(m)


@register("constraint_status", model_sql(f"SELECT {KEY_LIST}, constraintvalue FROM pc", views=("constraints", "demand", "customers", "accounts")))
def q_constraint_status(spark, sf_dir):
    """Status remembered, repair notes forced to Include."""
    m = typed_model(spark, sf_dir, ("constraints",))
    return C.normalise_constraints(m["constraints"]).select(*KEYS, "constraintvalue")


PROJ_COLS = ("periodname, period_no, quantity, returns, mfg, initialinventory, workingdays, "
             "begin_inventory, end_inventory, gap_6days")


def projection_from(spark, sf_dir):
    m = typed_model(spark, sf_dir, ("constraints", "demand", "inventory_policies", "periods"))
    return C.inventory_projection(C.normalise_constraints(m["constraints"]), m["demand"],
                                  m["inventory_policies"], m["periods"])


@register("period_balance", model_sql(f"SELECT {PROJ_COLS} FROM proj", PROJ_CTES))
def q_period_balance(spark, sf_dir):
    """C4: per-period issues, returns, manufacture, carried inventory and gap."""
    return projection_from(spark, sf_dir).select(*[c.strip() for c in PROJ_COLS.split(",")])


@register("worst_gap_ties", model_sql(f"SELECT {PROJ_COLS} FROM proj WHERE gap_6days = (SELECT max(gap_6days) FROM proj)",
                                      PROJ_CTES))
def q_worst_gap(spark, sf_dir):
    """Periods at the maximum gap, ties kept."""
    return C.worst_gap(projection_from(spark, sf_dir)).select(*[c.strip() for c in PROJ_COLS.split(",")])


@register("uplift_expand", model_sql("SELECT periodname, needed_mfg FROM up", PROJ_CTES, UPLIFT_CTES))
def q_uplift(spark, sf_dir):
    """The worst gap spread back over the earlier periods."""
    return C.uplift_rows(projection_from(spark, sf_dir))


@register("manufacturing_uplift", model_sql(f"SELECT {KEY_LIST}, constraintvalue, adjusted_constraintvalue FROM mfg_adj",
                                            PROJ_CTES, UPLIFT_CTES))
def q_mfg_uplift(spark, sf_dir):
    """New-manufacture constraints with the uplift at the special depot."""
    m = typed_model(spark, sf_dir, ("constraints", "demand", "inventory_policies", "periods"))
    pc = C.normalise_constraints(m["constraints"])
    proj = C.inventory_projection(pc, m["demand"], m["inventory_policies"], m["periods"])
    return C.manufacturing_uplift(pc, C.uplift_rows(proj), DEPOT).select(*KEYS, "constraintvalue",
                                                                         "adjusted_constraintvalue")


@register("return_share", model_sql("SELECT corp_code, return_loc_code, return_volume, share FROM shares", ACCOUNT_CTES))
def q_return_share(spark, sf_dir):
    """Each return location's share of an account's returns."""
    m = typed_model(spark, sf_dir, ("transfers", "demand", "customers", "accounts"))
    return C.account_return_share(m["transfers"], selected_from(m)).select(
        "corp_code", "return_loc_code", "return_volume", "share")


@register("account_demand", model_sql("SELECT corp_code, periodname, quantity FROM ad", ACCOUNT_CTES))
def q_account_demand(spark, sf_dir):
    """Issues per account and period."""
    m = typed_model(spark, sf_dir, ("demand", "customers", "accounts"))
    return C.account_demand(m["demand"], m["customers"], selected_from(m))


def adjusted_from(spark, sf_dir):
    m = typed_model(spark, sf_dir, ("constraints", "demand", "customers", "transfers", "accounts"))
    sel = selected_from(m)
    pc = C.normalise_constraints(m["constraints"])
    adj = C.adjusted_returns(pc, C.account_demand(m["demand"], m["customers"], sel),
                             C.account_return_share(m["transfers"], sel))
    return pc, adj


@register("adjusted_returns", model_sql(f"SELECT corp_code, {KEY_LIST}, constraintvalue, quantity, adjusted_constraintvalue FROM adj",
                                        ACCOUNT_CTES))
def q_adjusted_returns(spark, sf_dir):
    """Return constraints after removing each account."""
    _, adj = adjusted_from(spark, sf_dir)
    return adj.select("corp_code", *KEYS, "constraintvalue", "quantity", "adjusted_constraintvalue")


@register("depot_repairs", model_sql(f"SELECT corp_code, {KEY_LIST}, constraintvalue, adjusted_constraintvalue FROM dep",
                                     ACCOUNT_CTES))
def q_depot_repairs(spark, sf_dir):
    """Group repair minimum less removed WIP per account."""
    pc, adj = adjusted_from(spark, sf_dir)
    return C.adjusted_depot_repairs(pc, adj).select("corp_code", *KEYS, "constraintvalue", "adjusted_constraintvalue")


ACV_COLS = f"{KEY_LIST}, constraintvalue, corp_code, account_value"


@register("account_constraints", model_sql(f"SELECT {ACV_COLS} FROM acv", PROJ_CTES, UPLIFT_CTES, ACCOUNT_CTES, ACV_CTES))
def q_account_constraints(spark, sf_dir):
    """Per-account constraint values, NULL-safe 17-key join with fallback."""
    return account_values_from(spark, sf_dir, stored=False, persist=False).select(*KEYS, "constraintvalue", "corp_code", "account_value")


@register("account_unpivot", model_sql(f"""
SELECT {", ".join("b." + k for k in KEYS)}, b.constraintvalue, k.corp_code,
       coalesce(o.adjusted_constraintvalue, s.adjusted_constraintvalue, b.constraintvalue) AS account_value
FROM pc b CROSS JOIN (SELECT DISTINCT corp_code FROM sel) k
LEFT JOIN shared s ON {_JOIN_ON}
LEFT JOIN per_acct o ON o.corp_code = k.corp_code AND {_JOIN_ON.replace(" s.", " o.")}""",
                                       PROJ_CTES, UPLIFT_CTES, ACCOUNT_CTES, ACV_CTES))
def q_account_unpivot(spark, sf_dir):
    """The wide table (one column per account), unpivoted again to a row per constraint and account."""
    values, codes = wide_inputs(spark, sf_dir)
    wide = to_wide(values, codes)
    return unpivot_prefixed(wide, [*KEYS, "constraintvalue"], K.ACCOUNT_COLUMN_PREFIX)


@register("account_blocks", ORACLE["account_unpivot"])
def q_account_blocks(spark, sf_dir):
    """The same table stored in blocks of account positions and read again, a row per constraint and account."""
    from servelens.session import ensure_checkpoint_dir
    selected = materialize(selected_from(typed_model(spark, sf_dir, SELECTION_INPUTS)), "selected")
    values = account_values_from(spark, sf_dir, row_ids=True)
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/servelens-tables/wide-{uuid.uuid4().hex}"
    publish_blocks(values, selected, root)
    return unpivot_accounts(spark, root)


def wide_inputs(spark, sf_dir):
    """Per-account values with row ids and the account codes, which name the columns (as many as the account list)."""
    selected = selected_from(typed_model(spark, sf_dir, SELECTION_INPUTS))
    values = account_values_from(spark, sf_dir, row_ids=True)
    return values, sorted(r.corp_code for r in selected.select("corp_code").distinct().collect())


# --- reporting steps that need the per-account constraints ------------------

def codes_from(flows):
    """The analysed account codes, written once: the flows are not read again for each use."""
    return materialize(R.less_codes(flows), "codes")


REMOVED_CTES = f"""
rs AS (SELECT * FROM acv WHERE notes = '{K.RETURNS_NOTE}'),
rm_base AS (SELECT facilityname, coalesce(sum(constraintvalue - account_value), 0) AS base_returns FROM rs
            WHERE corp_code IS NULL GROUP BY facilityname),
rm_own AS (SELECT facilityname, corp_code, coalesce(sum(constraintvalue - account_value), 0) AS own_returns FROM rs
           WHERE corp_code IN (SELECT corp_code FROM codes) GROUP BY facilityname, corp_code),
removed AS (SELECT o.facilityname, o.corp_code, coalesce(b.base_returns, 0) + o.own_returns AS returns
            FROM rm_own o LEFT JOIN rm_base b ON o.facilityname = b.facilityname
            UNION ALL SELECT facilityname, CAST(NULL AS VARCHAR) AS corp_code, base_returns AS returns FROM rm_base)"""

UNIT_CTES = f"""
unit AS (SELECT originname, coalesce(sum(shipmentcost + transportationcost), 0) / nullif(coalesce(sum(flowquantity), 0), 0) AS cpp
         FROM flows WHERE scenarioname = '{K.OPTIMAL_SCENARIO}' AND contains(originname, '{K.RETURN_PREFIX}')
           AND CAST(right(departingperiodname, 2) AS INTEGER) <= {K.HORIZON_PERIODS} GROUP BY originname),
rc AS (SELECT r.facilityname, r.corp_code, r.returns, r.returns * u.cpp AS cost
       FROM removed r LEFT JOIN unit u ON r.facilityname = u.originname),
rc_shared AS (SELECT coalesce(sum(cost), 0) AS shared_cost FROM rc WHERE corp_code IS NULL),
rc_own AS (SELECT o.corp_code, coalesce(sum(o.cost), 0) AS own_cost,
                  coalesce(sum(coalesce(b.returns, 0) * u.cpp), 0) AS own_base_cost
           FROM rc o LEFT JOIN (SELECT facilityname, returns FROM removed WHERE corp_code IS NULL) b
                ON o.facilityname = b.facilityname
           LEFT JOIN unit u ON o.facilityname = u.originname
           WHERE o.corp_code IS NOT NULL GROUP BY o.corp_code),
labels AS (SELECT corpcode, count(*) AS n_labels FROM (SELECT DISTINCT corpcode, "Customer" FROM cust) x GROUP BY corpcode),
cur_return AS (SELECT k.corp_code AS corpcode,
                      (coalesce(o.own_cost, 0) + (coalesce(s.shared_cost, 0) - coalesce(o.own_base_cost, 0))) * l.n_labels
                        AS cur_tc_returns
               FROM (SELECT DISTINCT corp_code FROM codes) k JOIN labels l ON l.corpcode = k.corp_code
               LEFT JOIN rc_own o ON o.corp_code = k.corp_code CROSS JOIN rc_shared s)"""

ALL_VIEWS = MODEL_VIEWS + ("flows",)


@register("removed_returns", model_sql("SELECT facilityname, corp_code, round(returns, 6) AS returns FROM removed", PROJ_CTES, UPLIFT_CTES,
                                       ACCOUNT_CTES, ACV_CTES, CUSTOMER_SQL, REMOVED_CTES, views=ALL_VIEWS))
def q_removed_returns(spark, sf_dir):
    """C17: returns removed per return facility and account, all periods."""
    codes = codes_from(B.view(spark, sf_dir, "flows"))
    return round6(R.removed_returns(account_values_from(spark, sf_dir), codes), "returns")


@register("removed_returns_dense", model_sql("""
SELECT b.facilityname, k.corp_code, round(coalesce(sum(b.constraintvalue
         - coalesce(o.adjusted_constraintvalue, s.adjusted_constraintvalue, b.constraintvalue)), 0), 6) AS returns
FROM pc b CROSS JOIN (SELECT DISTINCT corp_code FROM sel WHERE corp_code IN (SELECT corp_code FROM codes)) k
LEFT JOIN shared s ON """ + _JOIN_ON + """
LEFT JOIN per_acct o ON o.corp_code = k.corp_code AND """ + _JOIN_ON.replace(" s.", " o.") + f"""
WHERE b.notes = '{K.RETURNS_NOTE}' AND b.facilityname IS NOT NULL GROUP BY b.facilityname, k.corp_code""",
                                             PROJ_CTES, UPLIFT_CTES, ACCOUNT_CTES, ACV_CTES, CUSTOMER_SQL, views=ALL_VIEWS))
def q_removed_returns_dense(spark, sf_dir):
    """C17: returns removed for every pair of return facility and account, from the wide table."""
    codes = codes_from(B.view(spark, sf_dir, "flows"))
    wide = to_wide(*wide_inputs(spark, sf_dir))
    return round6(R.removed_returns_dense(wide, codes), "returns")


def current_return_from(spark, sf_dir, flows, customers, codes, lines=None):
    # a row per return facility and account: read three times
    rem = materialize(R.removed_returns(account_values_from(spark, sf_dir, lines=lines), codes), "removed")
    return R.current_return_cost(rem, R.return_unit_cost(flows), customers, codes)


@register("current_return_cost", model_sql("SELECT corpcode, round(cur_tc_returns, 6) AS cur_tc_returns FROM cur_return", PROJ_CTES, UPLIFT_CTES,
                                           ACCOUNT_CTES, ACV_CTES, CUSTOMER_SQL, REMOVED_CTES, UNIT_CTES,
                                           views=ALL_VIEWS))
def q_current_return_cost(spark, sf_dir):
    """Removed returns x cost per pallet, per account."""
    flows = B.view(spark, sf_dir, "flows")
    customers = B.view(spark, sf_dir, "customers")
    return round6(current_return_from(spark, sf_dir, flows, customers, codes_from(flows)), "cur_tc_returns")


ISSUE_CTES = f"""
cur_issue AS (SELECT c.corpcode, coalesce(sum(f.shipmentcost + f.sourcingcost + f.transportationcost), 0) AS cur_tc_issues
              FROM flows f JOIN cust c ON f.destinationname = c.customername
              WHERE contains(f.destinationname, '{K.ISSUE_PREFIX}')
                AND CAST(right(f.departingperiodname, 2) AS INTEGER) <= {K.HORIZON_PERIODS}
                AND f.scenarioname = '{K.OPTIMAL_SCENARIO}' AND c.corpcode IS NOT NULL GROUP BY c.corpcode)"""

REPORT_CTES = f"""
acct AS (SELECT corp_code AS corpcode, -issues AS account_issues, -returns AS account_returns,
                -tc_issues AS opt_tc_issues, -tc_returns AS opt_tc_returns, -tc_transfers AS opt_tc_transfers
         FROM deltas WHERE reference = 'Optimal'),
aj AS (SELECT coalesce(a.corpcode, i.corpcode, r.corpcode) AS corpcode, a.account_issues, a.account_returns,
              a.opt_tc_issues, a.opt_tc_returns, a.opt_tc_transfers, i.cur_tc_issues, r.cur_tc_returns
       FROM acct a FULL JOIN cur_issue i ON a.corpcode = i.corpcode
       FULL JOIN cur_return r ON coalesce(a.corpcode, i.corpcode) = r.corpcode),
rep AS (SELECT *, (opt_tc_issues + opt_tc_returns + opt_tc_transfers) * CAST({K.EPS} AS DOUBLE) AS f FROM aj)"""

REPORT_BODY = """
SELECT corpcode, "Customer", """ + ", ".join(f"round({n}, 6) AS {n}" for _, n in K.ACCOUNT_MEASURES) + """ FROM (
SELECT r.corpcode, l."Customer", account_issues, account_returns, account_returns / nullif(account_issues, 0) AS account_r_i,
       opt_tc_issues, opt_tc_returns, opt_tc_transfers, cur_tc_issues, cur_tc_returns,
       f AS cur_ops_inefficiency,
       (opt_tc_issues + opt_tc_returns + opt_tc_transfers + f) - (cur_tc_issues + cur_tc_returns) AS cur_tc_transfers,
       cur_tc_issues / nullif(account_issues, 0) AS cur_tc_issues_cpi,
       cur_tc_returns / nullif(account_issues, 0) AS cur_tc_returns_cpi,
       ((opt_tc_issues + opt_tc_returns + opt_tc_transfers + f) - (cur_tc_issues + cur_tc_returns))
         / nullif(account_issues, 0) AS cur_tc_transfers_cpi,
       opt_tc_issues / nullif(account_issues, 0) AS opt_tc_issues_cpi,
       opt_tc_returns / nullif(account_issues, 0) AS opt_tc_returns_cpi,
       opt_tc_transfers / nullif(account_issues, 0) AS opt_tc_transfers_cpi
FROM rep r JOIN (SELECT DISTINCT corpcode, "Customer" FROM cust) l ON r.corpcode = l.corpcode) x"""


@register("account_report", model_sql(REPORT_BODY, PROJ_CTES, UPLIFT_CTES, ACCOUNT_CTES, ACV_CTES, CUSTOMER_SQL,
                                      REMOVED_CTES, UNIT_CTES, ISSUE_CTES, KPI_SQL_CTES, DELTAS_SQL_CTES, REPORT_CTES,
                                      views=tuple(dict.fromkeys(MODEL_VIEWS + KPI_VIEWS))))
def q_account_report(spark, sf_dir):
    """C20: per-account issues, returns, R:I, six costs, inefficiency and CPIs."""
    lines = B.shared_lines(spark, sf_dir)             # seven facts of a line and its order
    flows = B.view(spark, sf_dir, "flows", lines)
    customers = B.view(spark, sf_dir, "customers")
    kpis = materialize(kpis_from(spark, sf_dir, lines))   # one row per scenario, read three times
    codes = R.less_codes(kpis)
    issue = R.current_issue_cost(flows, customers, codes)
    ret = current_return_from(spark, sf_dir, flows, customers, codes, lines)
    rep = R.account_report(kpis, issue, ret, customers, codes)
    return round6(rep, *[n for _, n in K.ACCOUNT_MEASURES])

