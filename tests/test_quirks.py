"""Decisions on the quirks of the modelled process, pinned with hand-made rows."""

from pyspark.sql import functions as F

from servelens import constants as K
from servelens.plans import constraints as C
from servelens.plans import reporting as R

FLOW = ("scenarioname string, departingperiodname string, originname string, destinationname string, "
        "flowquantity double, shipmentcost double, sourcingcost double, transportationcost double")


def test_rerun_drops_stale_account_columns_and_keeps_original_status(spark):
    df = spark.createDataFrame([("D_1", "Repair_Capacity", "Include", "Exclude", "5")],
                               "facilityname string, notes string, status string, original_status_field string, "
                               "account_00001 string")
    out = C.normalise_constraints(df)
    assert "account_00001" not in out.columns
    r = out.collect()[0]
    assert r.original_status_field == "Exclude" and r.status == "Include"


def test_null_codes_never_match(spark):
    accounts = spark.createDataFrame([(None, "Nobody", "Y"), ("00001", "One", "Y")],
                                     "corp_code string, corp_desc string, evaluate string")
    demand = spark.createDataFrame([("I_1",), ("I_2",)], "customername string")
    customers = spark.createDataFrame([("I_1", None), ("I_2", "00001")], "customername string, corpcode string")
    assert [r.corp_code for r in C.select_accounts(accounts, demand, customers).collect()] == ["00001"]


def test_cost_composition_of_scenario_measures(spark):
    rows = [("S", "Period 01", "R_A_1", "I_9", 10.0, 1.0, 2.0, 4.0),    # issue and return at once
            ("S", "Period 01", "D_1", "D_2", 5.0, 1.0, 2.0, 4.0),       # transfer, origin manufactures
            ("S", "Period 02", "D_2", "D_3", 5.0, 1.0, 8.0, 4.0)]       # transfer, origin paints
    flows = spark.createDataFrame(rows, FLOW)
    empty = lambda schema: spark.createDataFrame([], schema)
    fac = spark.createDataFrame([("D_1", K.MANUFACTURING_TYPE), ("D_2", "Depot")], "facilityname string, depottype string")
    k = R.scenario_kpis(flows, empty("scenarioname string, periodname string, facilityname string, operatingcost double"),
                        empty("scenarioname string, periodname string, inboundhandlingcost double, outboundhandlingcost double"),
                        empty("scenarioname string, periodname string, totalinventorycost double"),
                        empty("scenarioname string, startingperiodname string, bomname string, productioncost double"),
                        fac).collect()[0]
    assert k.issues == 10.0 and k.returns == 10.0
    assert k.tc_issues == 1.0 + 4.0                       # issues: shipment + transportation (no sourcing)
    assert k.tc_returns == 1.0 + 2.0 + 4.0                # returns: sourcing included
    assert k.tc_transfers == (1.0 + 2.0 + 4.0) + (1.0 + 8.0 + 4.0)
    assert k.depot_painting == 2.0 + 8.0                  # sourcing of non-manufacturing origins, counted again
    assert k.depot_fixed is None and k.depot_total is None and k.network_r_i == 1.0


def test_current_issue_cost_includes_sourcing_and_fans_out(spark):
    flows = spark.createDataFrame([(K.OPTIMAL_SCENARIO, "Period 01", "D_1", "I_1", 1.0, 1.0, 2.0, 4.0)], FLOW)
    customers = spark.createDataFrame([("I_1", "1", "00001", "One"), ("I_1", "2", "00001", "One")],
                                      "customername string, loccode string, corpcode string, corpname string")
    codes = spark.createDataFrame([("00001",)], "corp_code string")
    r = R.current_issue_cost(flows, customers, codes).collect()[0]
    assert r.cur_tc_issues == 2 * (1.0 + 2.0 + 4.0)       # two locations of one customer count twice


def test_return_unit_cost_excludes_sourcing(spark):
    flows = spark.createDataFrame([(K.OPTIMAL_SCENARIO, "Period 01", "R_A_1", "D_1", 4.0, 1.0, 100.0, 3.0),
                                   (K.OPTIMAL_SCENARIO, "Period 13", "R_A_1", "D_1", 4.0, 9.0, 9.0, 9.0)], FLOW)
    r = R.return_unit_cost(flows).collect()[0]
    assert r.flowquantity == 4.0 and r.return_cost_per_pallet == (1.0 + 3.0) / 4.0


def test_deltas_need_both_reference_rows(spark):
    kp = spark.createDataFrame([("SOIP Optimized – Less 00001", 5.0), (K.OPTIMAL_SCENARIO, 8.0)],
                               "scenarioname string, issues double")
    cols = [F.lit(0.0).alias(m) for m in R.MEASURES if m != "issues"]
    kp = kp.select("scenarioname", "issues", *cols)
    d = {r.scenarioname: r.issues for r in R.scenario_delta_rows(kp).collect()}
    assert d == {"Removing 00001 - Optimal": -3.0}       # no baseline row: no baseline delta


def _pc(spark, rows):
    from servelens.sources import tables as T
    keys = [k for k in K.CONSTRAINT_KEYS if k != K.ORIGINAL_STATUS_COLUMN]
    data = []
    for fac, prod, per, cv, notes in rows:
        d = {k: None for k in keys}
        d.update(facilityname=fac, productname=prod, periodname=per, notes=notes, status="Include")
        data.append(tuple(d[k] for k in keys) + (cv,))
    df = spark.createDataFrame(data, ", ".join(f"{k} string" for k in keys) + ", constraintvalue string")
    return C.normalise_constraints(T.typed_constraints(df))


def test_zero_facility_total_falls_back_to_original(spark):
    pc = _pc(spark, [("R_US_7", "WIP", "Period 01", "0", K.RETURNS_NOTE)])
    ad = spark.createDataFrame([("00001", "Period 01", 100.0)], "corp_code string, periodname string, quantity double")
    sh = spark.createDataFrame([("00001", "7", 5.0, 1.0)],
                               "corp_code string, return_loc_code string, return_volume double, share double")
    r = C.adjusted_returns(pc, ad, sh).collect()[0]
    assert r.adjusted_constraintvalue is None          # 0 / 0: no adjusted value ...
    from mini_model import build
    m = build(spark)
    sel = C.select_accounts(m["accounts"], m["demand"], m["customers"])
    zero = m["constraints"].where("facilityname LIKE 'R_%'").withColumn("constraintvalue", F.lit(0.0))
    rest = m["constraints"].where("facilityname NOT LIKE 'R_%'")
    acv = C.build_account_constraints(zero.unionByName(rest), m["demand"], m["customers"], m["inventory_policies"],
                                      m["periods"], m["transfers"], sel)
    returns = acv.where(F.col("facilityname").startswith("R_")).collect()
    assert [(x.corp_code, x.account_value) for x in returns] == [(None, 0.0)] * 4   # ... so the original for all accounts


def test_null_facility_is_kept_in_the_shared_part(spark):
    pc = _pc(spark, [(None, "RFU", "Period 01", "7", "Repair_Capacity"), ("R_US_7", "WIP", "Period 01", "3", K.RETURNS_NOTE)])
    shared = C.unchanged_repairs(pc).collect()
    assert [(r.facilityname, r.adjusted_constraintvalue) for r in shared] == [(None, 7.0)]


def test_empty_account_list_gives_shared_rows_only(spark):
    from mini_model import build
    m = build(spark)
    none = spark.createDataFrame([], "corp_code string")
    acv = C.build_account_constraints(m["constraints"], m["demand"], m["customers"], m["inventory_policies"],
                                      m["periods"], m["transfers"], none, persist=False)
    assert acv.where(F.col("corp_code").isNotNull()).count() == 0
    assert acv.count() == m["constraints"].count()


def test_worst_gap_in_period_twelve_gives_three_digit_labels(spark):
    proj = spark.createDataFrame([(12, 22.0), (3, 1.0)], "period_no int, gap_6days double")
    labels = sorted(r.periodname for r in C.uplift_rows(proj).collect())
    assert labels == sorted(["Period 0" + str(12 - j) for j in range(1, 12)])
    assert "Period 010" in labels and "Period 011" in labels
    assert {r.needed_mfg for r in C.uplift_rows(proj).collect()} == {2.0}
