"""Binding views: the model's input tables derived from the TPC-H-like test data.

The scenario model reads tables of an optimisation model (flows, facility
and other summaries, customers, demand, production constraints, ...).  The
test data has none of them, so each is *derived* here from the given tables,
once as a Spark DataFrame and once as DuckDB SQL text with the same
expressions (the SQL is used by the oracle check).  All work grows with the
given tables: every view is a projection, join or aggregate over them.

Measures are whole numbers (``floor`` of a product) so that sums are exact in
any order; this keeps the two engines bit-identical without rounding tricks.

Mapping (one row of the source -> one row of the view unless stated):

* period label  ``'Period ' || lpad(((year*12 + month) % 19) + 1, 2, '0')``
* flows         lineitem x orders x supplier; scenario from order priority
* customers     customer; corp code ``lpad(custkey % 23, 5, '0')``
* accounts      distinct corp codes of customer; flag by code % 3
* demand        orders; quantity as text
* constraints   lineitem x supplier grouped by facility, product, period
* transfers     returned lineitems x orders
* periods       distinct order periods; working days by number, 0 for period 7
* inventory     supplier balances
* facilities    suppliers; every tenth one manufactures
* facility / warehousing / inventory / production summaries: line or order facts
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from servelens import constants as K
from servelens.operators.core import materialize

# --- fixed values of the binding (test data only) ---------------------------
N_CORPS = 23                      # corp code = custkey % 23
N_PERIODS = 19                    # period labels 'Period 01'..'Period 19'
ZERO_DAY_PERIOD = 7               # period without working days
DEPOT_SUPPLIER = 2                # its constraint rows form the 'Depot' group
MANUFACTURER_EVERY = 10           # suppliers with key % 10 = 0 manufacture
SPECIAL_DEPOT_TESTDATA = "D_1"    # depot that absorbs extra manufacturing here
SHIPMENT_RATE = 2.0               # shipment cost per pallet
LESS_CODES = {"3-MEDIUM": "00001", "4-NOT SPECIFIED": "00003", "5-LOW": "00004"}
REGISTERED_CODE = "00003"         # account whose rows are registered already, with notes
REGISTERED_SCENARIO = K.LESS_SCENARIO_PREFIX + REGISTERED_CODE

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------------------
# shared expressions (Spark) and their SQL twins
# ---------------------------------------------------------------------------

def _period(d):
    n = ((F.year(d) * 12 + F.month(d)) % N_PERIODS) + 1
    return F.concat(F.lit("Period "), F.lpad(n.cast("string"), 2, "0"))


def _period_sql(d: str) -> str:
    return (f"('Period ' || lpad(CAST(((year({d}) * 12 + month({d})) % {N_PERIODS}) + 1 AS VARCHAR), 2, '0'))")


def _scenario(p):
    e = F.when(p == "1-URGENT", F.lit(K.BASELINE_SCENARIO)).when(p == "2-HIGH", F.lit(K.OPTIMAL_SCENARIO))
    for prio, code in LESS_CODES.items():
        e = e.when(p == prio, F.lit(K.LESS_SCENARIO_PREFIX + code))
    return e.otherwise(F.concat(F.lit("Other "), p))


def _scenario_sql(p: str) -> str:
    parts = [f"WHEN {p} = '1-URGENT' THEN '{K.BASELINE_SCENARIO}'",
             f"WHEN {p} = '2-HIGH' THEN '{K.OPTIMAL_SCENARIO}'"]
    for prio, code in LESS_CODES.items():
        parts.append(f"WHEN {p} = '{prio}' THEN '{K.LESS_SCENARIO_PREFIX + code}'")
    return "(CASE " + " ".join(parts) + f" ELSE 'Other ' || {p} END)"


def _corp_code(k):
    return F.lpad((k % N_CORPS).cast("string"), 5, "0")


def _corp_code_sql(k: str) -> str:
    return f"lpad(CAST({k} % {N_CORPS} AS VARCHAR), 5, '0')"


def _whole(x):
    return F.floor(x).cast("double")


def _whole_sql(x: str) -> str:
    return f"CAST(floor({x}) AS DOUBLE)"


def _str(x):
    return x.cast("string")


# ---------------------------------------------------------------------------
# Spark views
# ---------------------------------------------------------------------------

def _line_orders(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    o = read_table(spark, sf_dir, "orders")
    return li.join(o, li.l_orderkey == o.o_orderkey)


def line_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with what the views take from their orders, written once for a query that reads several of them."""
    return materialize(_line_orders(spark, sf_dir).select(
        "l_suppkey", "l_partkey", "l_shipdate", "l_quantity", "l_extendedprice", "l_tax", "l_discount", "l_returnflag", "l_linestatus",
        "o_custkey", "o_orderpriority"), "line_orders")


def flows(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier")
    if lines is None:
        # suppliers first: what a report asks of the origin is decided before the lines are shuffled to their orders
        li, o = read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "orders")
        lo = li.join(s, li.l_suppkey == s.s_suppkey).join(o, F.col("l_orderkey") == o.o_orderkey)
    else:
        lo = lines.join(s, F.col("l_suppkey") == s.s_suppkey)
    ret = F.col("l_returnflag") == "R"
    origin = F.when(ret, F.concat(F.lit("R_N"), _str(F.col("s_nationkey")), F.lit("_"), _str(F.col("l_suppkey")))) \
        .otherwise(F.concat(F.lit("D_"), _str(F.col("l_suppkey"))))
    dest = F.when(~ret & (F.col("l_linestatus") == "O"), F.concat(F.lit("I_"), _str(F.col("o_custkey")))) \
        .otherwise(F.concat(F.lit("D_"), _str(F.col("o_custkey"))))
    return lo.select(
        _scenario(F.col("o_orderpriority")).alias("scenarioname"),
        _period(F.col("l_shipdate")).alias("departingperiodname"),
        origin.alias("originname"),
        dest.alias("destinationname"),
        F.col("l_quantity").alias("flowquantity"),
        (F.col("l_quantity") * F.lit(SHIPMENT_RATE)).alias("shipmentcost"),
        _whole(F.col("l_extendedprice") * F.col("l_tax")).alias("sourcingcost"),
        _whole(F.col("l_extendedprice") * F.col("l_discount")).alias("transportationcost"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        F.concat(F.lit("I_"), _str(k)).alias("customername"),
        _str(k).alias("loccode"),
        _corp_code(k).alias("corpcode"),
        F.concat(F.lit("Corp "), _str(k % N_CORPS)).alias("corpname"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    n = F.col("c_custkey") % N_CORPS
    flag = F.when(n % 3 == 0, "Y").when(n % 3 == 1, "y").otherwise("N")
    return c.select(
        _corp_code(F.col("c_custkey")).alias("corp_code"),
        F.concat(F.lit("Corp "), _str(n), F.lit(" & Sons, Inc.")).alias("corp_desc"),
        flag.alias("evaluate"),
        F.lit("Models\\Base\\").alias("base_model"),
        F.lit(None).cast("string").alias("account_model"),
    ).distinct()


def demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.concat(F.lit("I_"), _str(F.col("o_custkey"))).alias("customername"),
        F.lit("RFU").alias("productname"),
        _period(F.col("o_orderdate")).alias("periodname"),
        _str(_whole(F.col("o_totalprice") / 1000)).alias("quantity"),
    )


def _constraint_line_cols():
    supp = F.col("l_suppkey")
    ret = F.col("l_returnflag") == "R"
    depot = supp == DEPOT_SUPPLIER
    new = ~ret & (F.col("l_linenumber") == 1)
    facility = (F.when(depot, F.lit(K.DEPOT_GROUP))
                .when(ret, F.concat(F.lit("R_N"), _str(F.col("s_nationkey")), F.lit("_"), _str(supp)))
                .otherwise(F.concat(F.lit("D_"), _str(supp))))
    product = (F.when(depot, F.lit(None).cast("string"))
               .when(new, F.lit(K.PRODUCT_NEW))
               .when(F.col("l_partkey") % 2 == 0, F.lit(K.PRODUCT_WIP))
               .otherwise(F.lit("RFU")))
    period = F.when(new & (F.col("l_quantity") >= 50), F.lit(K.ANNUAL_PERIOD)).otherwise(_period(F.col("l_shipdate")))
    notes = (F.when(depot, F.lit("MinRepairsPerDay"))
             .when(ret, F.lit(K.RETURNS_NOTE))
             .when(new, F.lit("SOIP_MFG"))
             .when(supp % 3 == 0, F.lit("Repair_Capacity"))
             .when(supp % 3 == 1, F.lit("RepairsPerMonthVariance"))
             .otherwise(F.lit("SOIP_Repair")))
    status = F.when(supp % 2 == 0, F.lit(K.STATUS_INCLUDE)).otherwise(F.lit(K.STATUS_EXCLUDE))
    ctype = F.when(ret, F.lit("Max")).otherwise(F.lit("Fixed"))
    soip = F.when(new & ~depot, F.lit("20")).otherwise(F.lit(None).cast("string"))
    return facility, product, period, notes, status, ctype, soip


def constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    s = read_table(spark, sf_dir, "supplier")
    facility, product, period, notes, status, ctype, soip = _constraint_line_cols()
    lines = li.join(s, li.l_suppkey == s.s_suppkey).select(
        facility.alias("facilityname"), product.alias("productname"), period.alias("periodname"),
        notes.alias("notes"), status.alias("status"), ctype.alias("constrainttype"),
        soip.alias("soipquantity"), F.col("l_quantity"))
    g = lines.groupBy("facilityname", "productname", "periodname", "notes", "status",
                      "constrainttype", "soipquantity").agg(F.sum("l_quantity").alias("cv"))
    null = F.lit(None).cast("string")
    return g.select(
        "facilityname", null.alias("facilitynamegroupbehavior"),
        "productname", null.alias("productnamegroupbehavior"),
        "periodname", null.alias("periodnamegroupbehavior"),
        null.alias("bomname"), null.alias("bomnamegroupbehavior"),
        null.alias("processname"), null.alias("processnamegroupbehavior"),
        "constrainttype", _str(F.col("cv")).alias("constraintvalue"),
        null.alias("constraintvalueuom"), "status", "notes", "soipquantity",
        null.alias("conversionnotes"),
    )


def transfers(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    lo = (_line_orders(spark, sf_dir) if lines is None else lines).where(F.col("l_returnflag") == "R")
    ck, sk = F.col("o_custkey"), F.col("l_suppkey")
    return lo.select(
        _corp_code(ck).alias("renter_corp_code"),
        F.concat(F.lit("Corp "), _str(ck % N_CORPS)).alias("renter_corp_desc"),
        _str(sk).alias("return_loc_code"),
        F.concat(F.lit("Loc "), _str(sk)).alias("return_loc_desc"),
        _corp_code(sk).alias("return_corp_code"),
        F.concat(F.lit("Corp "), _str(sk % N_CORPS)).alias("return_corp_desc"),
        F.col("l_quantity").alias("return_volume"),
        F.month(F.col("l_shipdate")).alias("month"),
    )


def periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    p = o.select(_period(F.col("o_orderdate")).alias("periodname")).distinct()
    n = F.right(F.col("periodname"), F.lit(2)).cast("int")
    return p.select("periodname",
                    F.when(n == ZERO_DAY_PERIOD, F.lit(0)).otherwise(F.lit(20) + n % 4).alias("workingdays"))


def inventory_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier")
    return s.select(F.concat(F.lit("D_"), _str(F.col("s_suppkey"))).alias("facilityname"),
                    _str(_whole(F.abs(F.col("s_acctbal")))).alias("initialinventory"))


def facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier")
    return s.select(F.concat(F.lit("D_"), _str(F.col("s_suppkey"))).alias("facilityname"),
                    F.when(F.col("s_suppkey") % MANUFACTURER_EVERY == 0, F.lit(K.MANUFACTURING_TYPE))
                    .otherwise(F.lit("Depot")).alias("depottype"))


def facility_summary(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    lo = _line_orders(spark, sf_dir) if lines is None else lines
    return lo.select(_scenario(F.col("o_orderpriority")).alias("scenarioname"),
                     _period(F.col("l_shipdate")).alias("periodname"),
                     F.concat(F.lit("D_"), _str(F.col("l_suppkey"))).alias("facilityname"),
                     _whole(F.col("l_extendedprice") / 100).alias("operatingcost"))


def warehousing_summary(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    lo = _line_orders(spark, sf_dir) if lines is None else lines
    return lo.select(_scenario(F.col("o_orderpriority")).alias("scenarioname"),
                     _period(F.col("l_shipdate")).alias("periodname"),
                     F.col("l_quantity").alias("inboundhandlingcost"),
                     _whole(F.col("l_quantity") / 2).alias("outboundhandlingcost"))


def inventory_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select(_scenario(F.col("o_orderpriority")).alias("scenarioname"),
                    _period(F.col("o_orderdate")).alias("periodname"),
                    _whole(F.col("o_totalprice") / 1000).alias("totalinventorycost"))


def production_summary(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    lo = _line_orders(spark, sf_dir) if lines is None else lines
    p = read_table(spark, sf_dir, "part")
    j = lo.join(p, F.col("l_partkey") == p.p_partkey)
    bom = F.when(F.col("p_type").isin("ECONOMY", "SMALL"), F.lit(K.REPAIR_BOM)) \
        .otherwise(F.concat(F.lit("BOM_"), F.col("p_type")))
    return j.select(_scenario(F.col("o_orderpriority")).alias("scenarioname"),
                    _period(F.col("l_shipdate")).alias("startingperiodname"),
                    bom.alias("bomname"),
                    _whole(F.col("l_extendedprice") / 50).alias("productioncost"))


def scenarios_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scenarios already registered: every scenario name that has flows, and those of the
    registered account a second time, with notes."""
    o = read_table(spark, sf_dir, "orders")
    null = F.lit(None).cast("string")
    named = o.select(_scenario(F.col("o_orderpriority")).alias("scenarioname")).distinct()
    twice = named.where(F.col("scenarioname") == REGISTERED_SCENARIO).withColumn("notes", F.lit("second row"))
    return named.withColumn("notes", F.when(F.col("scenarioname") == REGISTERED_SCENARIO, F.lit("first row"))).unionByName(twice).select(
        "scenarioname", F.lit(K.STATUS_INCLUDE).alias("status"), null.alias("description"),
        null.alias("tags"), "notes", null.alias("technology"))


def items_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scenario items already registered: one per part type (the baseline items), and the
    registered account's exclusion, stored twice with notes."""
    p = read_table(spark, sf_dir, "part")
    null = F.lit(None).cast("string")
    own = _registered(spark, sf_dir).select(
        F.lit(K.EXCLUDE_ITEM_PREFIX + REGISTERED_CODE).alias("itemname"), F.lit(K.EXCLUDE_ITEM_TABLE).alias("tablename"),
        F.lit("checked").alias("action"), null.alias("condition"), F.lit(K.STATUS_EXCLUDE).alias("status"), null.alias("description"),
        null.alias("tags"), F.explode(F.array(F.lit("first row"), F.lit("second row"))).alias("notes"))
    return own.unionByName(p.select(F.concat(F.lit("Item_"), F.col("p_type")).alias("itemname")).distinct().select(
        "itemname", F.lit("Facilities").alias("tablename"), F.lit("Status='Include'").alias("action"),
        null.alias("condition"), F.lit(K.STATUS_INCLUDE).alias("status"), null.alias("description"),
        null.alias("tags"), null.alias("notes")))


def _registered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row when the customers hold the registered account."""
    return read_table(spark, sf_dir, "customer").where(_corp_code(F.col("c_custkey")) == REGISTERED_CODE).select(
        _corp_code(F.col("c_custkey")).alias("code")).distinct()


def assignments_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item assignments already registered: the optimal scenario uses every
    part-type item, ordered by type name (orders 1..n); the registered account's
    scenario holds them with notes and, where the order is even, one place later."""
    p = read_table(spark, sf_dir, "part")
    t = p.groupBy("p_type").agg(F.count(F.lit(1)).alias("n"))
    w = t.select(F.concat(F.lit("Item_"), F.col("p_type")).alias("itemname"))
    base = w.select("itemname", F.dense_rank().over(_w_itemname()).cast("bigint").alias("itemorder"))
    optimal = base.select(F.lit(K.OPTIMAL_SCENARIO).alias("scenarioname"), "itemname", "itemorder", F.lit(None).cast("string").alias("notes"))
    order = F.col("itemorder")
    own = base.select(F.lit(REGISTERED_SCENARIO).alias("scenarioname"), "itemname",
                      F.when(order % 2 == 0, order + 1).otherwise(order).alias("itemorder"), F.lit("kept by hand").alias("notes"))
    return optimal.unionByName(own)


def _w_itemname():
    from pyspark.sql import Window
    return Window.orderBy("itemname")


VIEWS = {
    "flows": flows, "customers": customers, "accounts": accounts, "demand": demand,
    "constraints": constraints, "transfers": transfers, "periods": periods,
    "inventory_policies": inventory_policies, "facilities": facilities,
    "facility_summary": facility_summary, "warehousing_summary": warehousing_summary,
    "inventory_summary": inventory_summary, "production_summary": production_summary,
    "scenarios_existing": scenarios_existing, "items_existing": items_existing,
    "assignments_existing": assignments_existing,
}


#: views with a row per order line, which can be derived from written lines
LINE_VIEWS = ("flows", "transfers", "facility_summary", "warehousing_summary", "production_summary")


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))
    except Exception:  # no JVM gateway (e.g. a remote session): local paths only
        import os
        return os.path.exists(path)


def view(spark: SparkSession, sf_dir: str, name: str, lines: DataFrame | None = None) -> DataFrame:
    """One model table: read it when ``sf_dir`` holds it materialised
    (``{name}.parquet``), otherwise derive it from the raw tables (line views from ``lines``, if given)."""
    path = f"{sf_dir}/{name}.parquet"
    if _exists(spark, path):
        return spark.read.parquet(path)
    return VIEWS[name](spark, sf_dir, lines) if name in LINE_VIEWS else VIEWS[name](spark, sf_dir)


def model(spark: SparkSession, sf_dir: str, names=None, lines: DataFrame | None = None) -> dict[str, DataFrame]:
    """All (or the named) model tables as lazy DataFrames."""
    names = names or VIEWS.keys()
    return {n: view(spark, sf_dir, n, lines) for n in names}


def shared_lines(spark: SparkSession, sf_dir: str, names=LINE_VIEWS) -> DataFrame | None:
    """:func:`line_orders` unless ``sf_dir`` holds all the named line views."""
    return None if all(_exists(spark, f"{sf_dir}/{n}.parquet") for n in names) else line_orders(spark, sf_dir)


# dimension-sized views: written as they come (no spreading over files)
SMALL_VIEWS = {"periods", "accounts", "facilities", "inventory_policies", "scenarios_existing",
               "items_existing", "assignments_existing"}

# fact tables stored with one folder per period (the reports cut at 12 periods)
PERIOD_PARTITIONED = {
    "flows": "departingperiodname",
    "facility_summary": "periodname",
    "warehousing_summary": "periodname",
    "inventory_summary": "periodname",
    "production_summary": "startingperiodname",
}


def materialize_model(spark: SparkSession, sf_dir: str, out_dir: str, min_partitions: int = 1,
                      parallel_jobs: int = 4) -> None:
    """Derive every model table once and write it to ``out_dir`` (parquet).

    A table whose plan has fewer partitions than ``min_partitions`` (a
    single row-group test file) is spread before writing; large inputs already
    have many scan tasks and are written as they are.
    """
    from concurrent.futures import ThreadPoolExecutor

    def write(item):
        n, fn = item
        df = fn(spark, sf_dir)
        part = PERIOD_PARTITIONED.get(n)
        if part:
            # one folder per period: the 12-period cutoff of the reports then
            # prunes whole folders before any file is opened
            df.repartition(min_partitions, part).write.mode("overwrite").partitionBy(part) \
                .parquet(f"{out_dir}/{n}.parquet")
            return
        if n not in SMALL_VIEWS and df.rdd.getNumPartitions() < min_partitions:
            df = df.repartition(min_partitions)
        df.write.mode("overwrite").parquet(f"{out_dir}/{n}.parquet")

    # independent tables: submitted as concurrent jobs so that narrow inputs
    # (one scan task each) still use every core
    with ThreadPoolExecutor(max_workers=max(1, min(len(VIEWS), parallel_jobs))) as pool:
        list(pool.map(write, VIEWS.items()))


# ---------------------------------------------------------------------------
# SQL twins (DuckDB dialect) of the views above
# ---------------------------------------------------------------------------

_LO = "lineitem JOIN orders ON l_orderkey = o_orderkey"

SQL = {
    "flows": f"""
SELECT {_scenario_sql('o_orderpriority')} AS scenarioname,
       {_period_sql('l_shipdate')} AS departingperiodname,
       CASE WHEN l_returnflag = 'R' THEN 'R_N' || CAST(s_nationkey AS VARCHAR) || '_' || CAST(l_suppkey AS VARCHAR)
            ELSE 'D_' || CAST(l_suppkey AS VARCHAR) END AS originname,
       CASE WHEN NOT (l_returnflag = 'R') AND l_linestatus = 'O' THEN 'I_' || CAST(o_custkey AS VARCHAR)
            ELSE 'D_' || CAST(o_custkey AS VARCHAR) END AS destinationname,
       l_quantity AS flowquantity,
       l_quantity * {SHIPMENT_RATE} AS shipmentcost,
       {_whole_sql('l_extendedprice * l_tax')} AS sourcingcost,
       {_whole_sql('l_extendedprice * l_discount')} AS transportationcost
FROM {_LO} JOIN supplier ON l_suppkey = s_suppkey""",
    "customers": f"""
SELECT 'I_' || CAST(c_custkey AS VARCHAR) AS customername, CAST(c_custkey AS VARCHAR) AS loccode,
       {_corp_code_sql('c_custkey')} AS corpcode, 'Corp ' || CAST(c_custkey % {N_CORPS} AS VARCHAR) AS corpname
FROM customer""",
    "accounts": f"""
SELECT DISTINCT {_corp_code_sql('c_custkey')} AS corp_code,
       'Corp ' || CAST(c_custkey % {N_CORPS} AS VARCHAR) || ' & Sons, Inc.' AS corp_desc,
       CASE WHEN c_custkey % {N_CORPS} % 3 = 0 THEN 'Y' WHEN c_custkey % {N_CORPS} % 3 = 1 THEN 'y' ELSE 'N' END AS evaluate,
       'Models\\Base\\' AS base_model, CAST(NULL AS VARCHAR) AS account_model
FROM customer""",
    "demand": f"""
SELECT 'I_' || CAST(o_custkey AS VARCHAR) AS customername, 'RFU' AS productname,
       {_period_sql('o_orderdate')} AS periodname,
       CAST({_whole_sql('o_totalprice / 1000')} AS VARCHAR) AS quantity
FROM orders""",
    "constraints": f"""
SELECT facilityname, CAST(NULL AS VARCHAR) AS facilitynamegroupbehavior,
       productname, CAST(NULL AS VARCHAR) AS productnamegroupbehavior,
       periodname, CAST(NULL AS VARCHAR) AS periodnamegroupbehavior,
       CAST(NULL AS VARCHAR) AS bomname, CAST(NULL AS VARCHAR) AS bomnamegroupbehavior,
       CAST(NULL AS VARCHAR) AS processname, CAST(NULL AS VARCHAR) AS processnamegroupbehavior,
       constrainttype, CAST(sum(l_quantity) AS VARCHAR) AS constraintvalue,
       CAST(NULL AS VARCHAR) AS constraintvalueuom, status, notes, soipquantity,
       CAST(NULL AS VARCHAR) AS conversionnotes
FROM (
  SELECT CASE WHEN l_suppkey = {DEPOT_SUPPLIER} THEN '{K.DEPOT_GROUP}'
              WHEN l_returnflag = 'R' THEN 'R_N' || CAST(s_nationkey AS VARCHAR) || '_' || CAST(l_suppkey AS VARCHAR)
              ELSE 'D_' || CAST(l_suppkey AS VARCHAR) END AS facilityname,
         CASE WHEN l_suppkey = {DEPOT_SUPPLIER} THEN CAST(NULL AS VARCHAR)
              WHEN NOT (l_returnflag = 'R') AND l_linenumber = 1 THEN '{K.PRODUCT_NEW}'
              WHEN l_partkey % 2 = 0 THEN '{K.PRODUCT_WIP}' ELSE 'RFU' END AS productname,
         CASE WHEN NOT (l_returnflag = 'R') AND l_linenumber = 1 AND l_quantity >= 50 THEN '{K.ANNUAL_PERIOD}'
              ELSE {_period_sql('l_shipdate')} END AS periodname,
         CASE WHEN l_suppkey = {DEPOT_SUPPLIER} THEN 'MinRepairsPerDay'
              WHEN l_returnflag = 'R' THEN '{K.RETURNS_NOTE}'
              WHEN l_linenumber = 1 THEN 'SOIP_MFG'
              WHEN l_suppkey % 3 = 0 THEN 'Repair_Capacity'
              WHEN l_suppkey % 3 = 1 THEN 'RepairsPerMonthVariance' ELSE 'SOIP_Repair' END AS notes,
         CASE WHEN l_suppkey % 2 = 0 THEN '{K.STATUS_INCLUDE}' ELSE '{K.STATUS_EXCLUDE}' END AS status,
         CASE WHEN l_returnflag = 'R' THEN 'Max' ELSE 'Fixed' END AS constrainttype,
         CASE WHEN NOT (l_returnflag = 'R') AND l_linenumber = 1 AND l_suppkey <> {DEPOT_SUPPLIER}
              THEN '20' ELSE CAST(NULL AS VARCHAR) END AS soipquantity,
         l_quantity
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey) x
GROUP BY facilityname, productname, periodname, notes, status, constrainttype, soipquantity""",
    "transfers": f"""
SELECT {_corp_code_sql('o_custkey')} AS renter_corp_code,
       'Corp ' || CAST(o_custkey % {N_CORPS} AS VARCHAR) AS renter_corp_desc,
       CAST(l_suppkey AS VARCHAR) AS return_loc_code, 'Loc ' || CAST(l_suppkey AS VARCHAR) AS return_loc_desc,
       {_corp_code_sql('l_suppkey')} AS return_corp_code,
       'Corp ' || CAST(l_suppkey % {N_CORPS} AS VARCHAR) AS return_corp_desc,
       l_quantity AS return_volume, month(l_shipdate) AS month
FROM {_LO} WHERE l_returnflag = 'R'""",
    "periods": f"""
SELECT periodname,
       CASE WHEN CAST(right(periodname, 2) AS INTEGER) = {ZERO_DAY_PERIOD} THEN 0
            ELSE 20 + CAST(right(periodname, 2) AS INTEGER) % 4 END AS workingdays
FROM (SELECT DISTINCT {_period_sql('o_orderdate')} AS periodname FROM orders) p""",
    "inventory_policies": f"""
SELECT 'D_' || CAST(s_suppkey AS VARCHAR) AS facilityname,
       CAST({_whole_sql('abs(s_acctbal)')} AS VARCHAR) AS initialinventory
FROM supplier""",
    "facilities": f"""
SELECT 'D_' || CAST(s_suppkey AS VARCHAR) AS facilityname,
       CASE WHEN s_suppkey % {MANUFACTURER_EVERY} = 0 THEN '{K.MANUFACTURING_TYPE}' ELSE 'Depot' END AS depottype
FROM supplier""",
    "facility_summary": f"""
SELECT {_scenario_sql('o_orderpriority')} AS scenarioname, {_period_sql('l_shipdate')} AS periodname,
       'D_' || CAST(l_suppkey AS VARCHAR) AS facilityname, {_whole_sql('l_extendedprice / 100')} AS operatingcost
FROM {_LO}""",
    "warehousing_summary": f"""
SELECT {_scenario_sql('o_orderpriority')} AS scenarioname, {_period_sql('l_shipdate')} AS periodname,
       l_quantity AS inboundhandlingcost, {_whole_sql('l_quantity / 2')} AS outboundhandlingcost
FROM {_LO}""",
    "inventory_summary": f"""
SELECT {_scenario_sql('o_orderpriority')} AS scenarioname, {_period_sql('o_orderdate')} AS periodname,
       {_whole_sql('o_totalprice / 1000')} AS totalinventorycost
FROM orders""",
    "production_summary": f"""
SELECT {_scenario_sql('o_orderpriority')} AS scenarioname, {_period_sql('l_shipdate')} AS startingperiodname,
       CASE WHEN p_type IN ('ECONOMY', 'SMALL') THEN '{K.REPAIR_BOM}' ELSE 'BOM_' || p_type END AS bomname,
       {_whole_sql('l_extendedprice / 50')} AS productioncost
FROM {_LO} JOIN part ON l_partkey = p_partkey""",
    "scenarios_existing": f"""
SELECT scenarioname, '{K.STATUS_INCLUDE}' AS status, CAST(NULL AS VARCHAR) AS description,
       CAST(NULL AS VARCHAR) AS tags, CASE WHEN scenarioname = '{REGISTERED_SCENARIO}' THEN 'first row' END AS notes,
       CAST(NULL AS VARCHAR) AS technology
FROM (SELECT DISTINCT {_scenario_sql('o_orderpriority')} AS scenarioname FROM orders) s
UNION ALL
SELECT DISTINCT '{REGISTERED_SCENARIO}', '{K.STATUS_INCLUDE}', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), 'second row', CAST(NULL AS VARCHAR)
FROM orders WHERE {_scenario_sql('o_orderpriority')} = '{REGISTERED_SCENARIO}'""",
    "items_existing": f"""
SELECT itemname, 'Facilities' AS tablename, 'Status=''Include''' AS action, CAST(NULL AS VARCHAR) AS condition,
       '{K.STATUS_INCLUDE}' AS status, CAST(NULL AS VARCHAR) AS description, CAST(NULL AS VARCHAR) AS tags,
       CAST(NULL AS VARCHAR) AS notes
FROM (SELECT DISTINCT 'Item_' || p_type AS itemname FROM part) i
UNION ALL
SELECT '{K.EXCLUDE_ITEM_PREFIX}{REGISTERED_CODE}', '{K.EXCLUDE_ITEM_TABLE}', 'checked', CAST(NULL AS VARCHAR), '{K.STATUS_EXCLUDE}',
       CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), n.notes
FROM (SELECT DISTINCT {_corp_code_sql('c_custkey')} AS code FROM customer) c, (VALUES ('first row'), ('second row')) n(notes)
WHERE c.code = '{REGISTERED_CODE}'""",
    "assignments_existing": f"""
SELECT '{K.OPTIMAL_SCENARIO}' AS scenarioname, itemname,
       CAST(dense_rank() OVER (ORDER BY itemname) AS BIGINT) AS itemorder, CAST(NULL AS VARCHAR) AS notes
FROM (SELECT DISTINCT 'Item_' || p_type AS itemname FROM part) i
UNION ALL
SELECT '{REGISTERED_SCENARIO}', itemname, o + CASE WHEN o % 2 = 0 THEN 1 ELSE 0 END, 'kept by hand'
FROM (SELECT itemname, CAST(dense_rank() OVER (ORDER BY itemname) AS BIGINT) AS o
      FROM (SELECT DISTINCT 'Item_' || p_type AS itemname FROM part) i) b""",
}


def with_views(body: str, *names: str, ctes: str = "", recursive: bool = False) -> str:
    """Prefix a SQL body with the CTEs of the named binding views, followed by
    the extra CTE text ``ctes`` (comma separated, may refer to the views)."""
    parts = [f"{n} AS ({SQL[n].strip()})" for n in names]
    if ctes.strip():
        parts.append(ctes.strip().strip(","))
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(parts) + "\n" + body.strip()
