"""End-to-end runs: the four steps of the scenario process.

1. ``write_transfer_matrix``   monthly transfer files -> aggregated matrix
2. ``update_constraints``      model + account list + matrix -> constraints with
                               one ``account_<code>`` column per account
3. ``register_scenarios``      account list -> scenarios, items, assignments
   (the external solver then runs the scenarios)
4. ``write_reports``           solver results -> dated scenario and account reports

Every step reads tables by name from a model folder (``{root}/{table}``, a
versioned table or plain files, parquet by default; ``load_jdbc`` gives the same
dict from a database).  Steps 1 to 3 publish versions of their tables
(:mod:`servelens.sinks.snapshots`), step 4 writes dated folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from servelens import constants as K
from servelens.operators.core import materialize, unpivot_prefixed
from servelens.plans import constraints as C
from servelens.plans import reporting as R
from servelens.plans import scenarios as S
from servelens.sinks import snapshots
from servelens.sinks import writers as W
from servelens.sources import tables as T

# model table names -> the names used by the plans
REPORT_TABLE_MAP = {
    "optimizationflowsummary": "flows",
    "optimizationfacilitysummary": "facility_summary",
    "optimizationwarehousingsummary": "warehousing_summary",
    "optimizationinventorysummary": "inventory_summary",
    "optimizationproductionsummary": "production_summary",
    "facilities": "facilities",
    "customers": "customers",
    "productionconstraints": "constraints",
}


def write_transfer_matrix(spark: SparkSession, monthly_folder: str, out_path: str, fmt: str = "csv",
                          expected: int | None = K.EXPECTED_MONTHLY_FILES) -> DataFrame:
    """Step 1: union the monthly files (exactly ``expected`` of them), sum by the six keys, write."""
    tm = C.transfer_matrix(T.read_monthly_files(spark, monthly_folder, fmt, expected))
    snapshots.publish(tm, out_path)
    return snapshots.read(spark, out_path)


def update_constraints(spark: SparkSession, model_root: str, accounts: DataFrame, transfers: DataFrame,
                       out_path: str, fmt: str = "parquet", special_depot: str = K.SPECIAL_DEPOT,
                       as_text: bool = True, **kw) -> DataFrame:
    """Step 2: per-account constraint values for every selected account, published
    as a new version of the constraint table with ``account_<code>`` columns.

    ``accounts`` is the account list (columns ``corp_code``, ``corp_desc``,
    ``evaluate``), ``transfers`` the aggregated matrix of step 1.
    """
    m = T.load_tables(spark, model_root, T.INPUT_TABLES, fmt)
    constraints = T.typed_constraints(m["productionconstraints"])
    demand = T.typed_demand(m["customerdemand"])
    customers = T.typed_customers(m["customers"])
    selected = materialize(C.select_accounts(accounts, demand, customers), "selected")
    # account columns of an earlier run (the marker anywhere in the name, F17) are replaced, all others stay
    known = {*K.CONSTRAINT_KEYS, "constraintvalue"}
    extra = [c for c in constraints.columns if c not in known and K.ACCOUNT_COLUMN_PREFIX not in c.lower()]
    values = C.build_account_constraints(constraints, demand, customers,
                                         T.typed_inventory(m["inventorypolicies"]), m["periods"], transfers,
                                         selected, special_depot=special_depot, row_ids=True, extra=extra, **kw)
    # the account list is small: its codes name the new columns
    codes = sorted(r.corp_code for r in selected.select("corp_code").distinct().collect())
    W.publish_wide_constraints(values, codes, out_path, as_text, extra)
    return snapshots.read(spark, out_path)


#: name and key of the registration tables
REGISTERED = {"scenarios": ["scenarioname"], "scenarioitems": ["itemname"], "scenarioitemassignments": ["scenarioname", "itemname"]}


def register_scenarios(spark: SparkSession, model_root: str, accounts: DataFrame, out_root: str,
                       fmt: str = "parquet", n_parts: int = 16, **kw) -> dict[str, DataFrame]:
    """Step 3: scenario, item and assignment tables after registering every
    selected account, as versioned tables under ``out_root``.

    The first run publishes the model's tables there, in hash partitions of
    their keys; every run then writes the accounts' rows, which touches only the
    partitions of their keys.  Columns beyond those of the process are kept.
    """
    m = T.load_tables(spark, model_root, T.BUNDLE_TABLES, fmt)
    stored = {}
    for name, keys in REGISTERED.items():
        root = f"{out_root}/{name}"
        if not snapshots.exists(spark, root):
            snapshots.publish(m[name], root, keys, n_parts)
        stored[name] = snapshots.read(spark, root)
    demand, customers = T.typed_demand(m["customerdemand"]), T.typed_customers(m["customers"])
    selected = materialize(C.select_accounts(accounts, demand, customers), "selected")
    with_demand = S.accounts_with_demand(selected, demand, customers)
    changes = {
        "scenarios": S.scenario_changes(stored["scenarios"], selected),
        "scenarioitems": S.item_changes(stored["scenarioitems"], with_demand),
        "scenarioitemassignments": S.assignment_changes(stored["scenarioitemassignments"], selected, **kw),
    }
    for name, rows in changes.items():
        latest = ["itemorder"] if "itemorder" in rows.columns else []
        snapshots.upsert(materialize(rows, f"{name}-changes"), f"{out_root}/{name}", latest)
    return {name: snapshots.read(spark, f"{out_root}/{name}") for name in changes}


def store_results(spark: SparkSession, model_root: str, out_root: str, fmt: str = "parquet",
                  n_parts: int | None = None) -> dict[str, DataFrame]:
    """Solver results as versioned tables under ``out_root`` for :func:`write_reports`: the fact
    tables carry their period number and are laid out by it, the others are kept as they are."""
    tables = T.load_tables(spark, model_root, REPORT_TABLE_MAP, fmt)
    for name, df in tables.items():
        label = T.PERIOD_LABELS.get(name)
        snapshots.publish(T.by_period(df, label, n_parts) if label else df, f"{out_root}/{name}")
    return {name: snapshots.read(spark, f"{out_root}/{name}") for name in tables}


def write_reports(spark: SparkSession, model_root: str, out_dir: str, run_date: str | None = None,
                  fmt: str = "parquet", report_fmt: str = "csv", eps: float = K.EPS) -> dict[str, str]:
    """Step 4: scenario table (with deltas) and account table as dated reports.

    The constraint table carries one ``account_<code>`` column per account
    (step 2); it is unpivoted to the long form the reports use.
    """
    raw = T.load_tables(spark, model_root, REPORT_TABLE_MAP, fmt)
    m = {REPORT_TABLE_MAP[k]: v for k, v in raw.items()}
    kpis = materialize(R.scenario_kpis(m["flows"], m["facility_summary"], m["warehousing_summary"],
                                       m["inventory_summary"], m["production_summary"], m["facilities"]), "kpis")
    codes = R.less_codes(kpis)
    pc = m["constraints"]
    ids = [c for c in pc.columns if not c.startswith(K.ACCOUNT_COLUMN_PREFIX)]
    long = unpivot_prefixed(pc.withColumn("constraintvalue", T.to_double("constraintvalue")), ids,
                            K.ACCOUNT_COLUMN_PREFIX)
    long = long.where(F.col("account_value").isNotNull())
    customers = T.typed_customers(m["customers"])
    issue = R.current_issue_cost(m["flows"], customers, codes)
    ret = R.current_return_cost(R.removed_returns(long, codes), R.return_unit_cost(m["flows"]), customers, codes)
    report = R.account_report(kpis, issue, ret, customers, codes, eps=eps)
    return {
        "scenario_data": W.write_dated_report(R.scenario_deltas(kpis), out_dir, "scenario_data", run_date, report_fmt),
        "customer_data": W.write_dated_report(report, out_dir, "customer_data", run_date, report_fmt,
                                              measures=K.ACCOUNT_MEASURES, label_col="corpcode"),
    }
