from pyspark.sql import functions as F

from servelens import constants as K
from servelens.plans import constraints as C
from servelens.plans import reporting as R
from servelens.plans import scenarios as S
from servelens.sinks.writers import to_wide

from mini_model import build


def values(spark, selected=None):
    m = build(spark)
    sel = selected if selected is not None else C.select_accounts(m["accounts"], m["demand"], m["customers"])
    return m, sel, C.build_account_constraints(m["constraints"], m["demand"], m["customers"],
                                               m["inventory_policies"], m["periods"], m["transfers"], sel)


def test_selection_is_case_insensitive_and_needs_demand(spark):
    m = build(spark)
    sel = C.select_accounts(m["accounts"], m["demand"], m["customers"])
    assert sorted(r.corp_code for r in sel.collect()) == ["81384", "81399"]
    exact = C.select_accounts(m["accounts"], m["demand"], m["customers"], flag="Y", exact=True)
    assert [r.corp_code for r in exact.collect()] == ["81384"]


def test_golden_row_falls_back_to_constraint_value(spark):
    _, _, acv = values(spark)
    wide = to_wide(acv, ["81384", "81399"])
    r = wide.where(F.col("facilityname") == "D_USA77571_77572").collect()
    assert len(r) == 1 and r[0]["account_81384"] == 21600.0 and r[0]["account_81399"] == 21600.0


def test_returns_are_reduced_for_the_account(spark):
    _, _, acv = values(spark)
    own = {(r.facilityname, r.productname, r.corp_code): r.account_value
           for r in acv.where(F.col("corp_code").isNotNull() & F.col("facilityname").startswith("R_")).collect()}
    # 81384 issues 300 in Period 01, 75 % of its returns go to loc 101; the WIP row holds 100 of 150 there
    expected = round(100 - min(100 / 150 * (300 * 0.75 * K.LOSS_RATE), 100), 6)
    assert own[("R_US_101", "WIP", "81384")] == expected
    # loc 103 gets nothing from 81384: no value of its own
    assert ("R_US_103", "WIP", "81384") not in own


def test_status_quirk_keeps_original_value(spark):
    _, _, acv = values(spark)
    depot = acv.where((F.col("facilityname") == K.DEPOT_GROUP) & (F.col("periodname") == "Period 02"))
    assert depot.where(F.col("corp_code").isNotNull()).count() == 0
    assert [r.account_value for r in depot.collect()] == [500.0]
    depot1 = acv.where((F.col("facilityname") == K.DEPOT_GROUP) & (F.col("periodname") == "Period 01")
                       & F.col("corp_code").isNotNull())
    assert depot1.count() == 2   # both accounts lower the Period 01 repair minimum


def test_all_accounts_equals_union_of_single_accounts(spark):
    m, sel, acv = values(spark)
    for code in ["81384", "81399"]:
        _, _, one = values(spark, sel.where(F.col("corp_code") == code))
        a = sorted(acv.where(F.col("corp_code") == code).collect())
        b = sorted(one.where(F.col("corp_code") == code).collect())
        assert a == b
        assert sorted(acv.where(F.col("corp_code").isNull()).collect()) == \
            sorted(one.where(F.col("corp_code").isNull()).collect())


def test_shares_sum_to_one(spark):
    m = build(spark)
    sel = C.select_accounts(m["accounts"], m["demand"], m["customers"])
    sh = C.account_return_share(m["transfers"], sel).groupBy("corp_code").agg(F.sum("share").alias("s"))
    assert all(abs(r.s - 1.0) < 1e-12 for r in sh.collect())


def test_projection_carries_inventory_and_drops_annual_row(spark):
    m = build(spark)
    proj = C.inventory_projection(C.normalise_constraints(m["constraints"]), m["demand"],
                                  m["inventory_policies"], m["periods"])
    rows = {r.periodname: r for r in proj.collect()}
    assert set(rows) == {"Period 01", "Period 02", "Period 03", "Period 09"}   # 09: manufacture only (outer join)
    p1, p2 = rows["Period 01"], rows["Period 02"]
    assert p1.begin_inventory == 5000.0
    assert p2.begin_inventory == 5000.0 + p1.returns + p1.mfg - p1.quantity
    assert rows["Period 03"].gap_6days is None          # zero working days


def test_uplift_ties_continue_the_counter(spark):
    proj = spark.createDataFrame([(3, 10.0), (5, 10.0), (4, 2.0), (1, None)], "period_no int, gap_6days double")
    got = sorted((r.periodname, r.needed_mfg) for r in C.uplift_rows(proj).collect())
    assert got == sorted([("Period 02", 5.0), ("Period 01", 5.0), ("Period 02", 2.5), ("Period 01", 2.5)])


def test_uplift_first_period_gives_nothing(spark):
    proj = spark.createDataFrame([(1, 10.0), (2, 3.0)], "period_no int, gap_6days double")
    assert C.uplift_rows(proj).count() == 0


def test_registration_twice_adds_nothing(spark):
    m = build(spark)
    sel = C.select_accounts(m["accounts"], m["demand"], m["customers"])
    ex_s = spark.createDataFrame([(K.OPTIMAL_SCENARIO, "Include", None, None, None, None)],
                                 "scenarioname string, status string, description string, tags string, notes string, "
                                 "technology string")
    once = S.build_scenarios(ex_s, sel)
    assert sorted(once.collect()) == sorted(S.build_scenarios(once, sel).collect())
    ex_a = spark.createDataFrame([(K.OPTIMAL_SCENARIO, "Item_A", 1, None), (K.OPTIMAL_SCENARIO, "Item_B", 2, None)],
                                 "scenarioname string, itemname string, itemorder long, notes string")
    a1 = S.build_scenario_assignments(ex_a, sel)
    assert sorted(a1.collect()) == sorted(S.build_scenario_assignments(a1, sel).collect())
    mine = {(r.itemname, r.itemorder) for r in a1.where(F.col("scenarioname").endswith("81384")).collect()}
    assert mine == {("Item_A", 1), ("Item_B", 2), ("Exclude_Customer_81384", 2),
                    ("Update_production_constraints_81384", 3)}
    items = S.build_scenario_items(spark.createDataFrame([], ", ".join(f"{c} string" for c in S.ITEM_COLS)),
                                   S.accounts_with_demand(sel, m["demand"], m["customers"]))
    assert items.count() == 4


def test_kpis_align_missing_measures_as_null(spark):
    flows = spark.createDataFrame([("A", "Period 01", "D_1", "D_9", 5.0, 1.0, 1.0, 1.0)],
                                  "scenarioname string, departingperiodname string, originname string, "
                                  "destinationname string, flowquantity double, shipmentcost double, "
                                  "sourcingcost double, transportationcost double")
    fac = spark.createDataFrame([("B", "Period 02", "D_1", 7.0)],
                                "scenarioname string, periodname string, facilityname string, operatingcost double")
    empty_w = spark.createDataFrame([], "scenarioname string, periodname string, inboundhandlingcost double, "
                                        "outboundhandlingcost double")
    empty_i = spark.createDataFrame([], "scenarioname string, periodname string, totalinventorycost double")
    empty_p = spark.createDataFrame([], "scenarioname string, startingperiodname string, bomname string, "
                                        "productioncost double")
    facilities = spark.createDataFrame([("D_1", "Manufacturing")], "facilityname string, depottype string")
    k = {r.scenarioname: r for r in R.scenario_kpis(flows, fac, empty_w, empty_i, empty_p, facilities).collect()}
    assert set(k) == {"A", "B"}
    assert k["A"].issues is None and k["A"].tc_transfers == 3.0 and k["A"].depot_painting is None
    assert k["B"].depot_fixed == 7.0 and k["B"].tc_total is None and k["B"].network_r_i is None


def _dense(rows, demand, share, loss=K.LOSS_RATE):
    """(row, account) -> adjusted value for every account with demand in the row's period."""
    total, out = {}, {}
    for fac, _, per, cv in rows:
        total[fac, per] = total.get((fac, per), 0.0) + cv
    for i, (fac, _, per, cv) in enumerate(rows):
        for (code, p), qty in demand.items():
            if p != per:
                continue
            t, sh = total[fac, per], share.get((code, fac.split("_")[2]), 0.0)
            out[i, code] = None if t == 0 else round(cv - min(cv / t * (qty * sh * loss), cv), 6)
    return out


def test_adjusted_returns_are_the_changed_pairs_of_all_accounts(spark):
    rows = [("R_US_1", "WIP", "Period 01", 100.0), ("R_US_1", "RFU", "Period 01", 50.0), ("R_US_2", "WIP", "Period 01", 40.0),
            ("R_US_2", "WIP", "Period 02", 0.12345678), ("R_US_3", "WIP", "Period 02", -4.0), ("R_US_4", "WIP", "Period 01", 3.0),
            ("R_US_4", "RFU", "Period 01", -3.0), ("R_US_5", "WIP", "Period 09", 7.0)]
    demand = {("a", "Period 01"): 30.0, ("a", "Period 02"): 500.0, ("b", "Period 01"): 9.0, ("c", "Period 02"): 1.0}
    share = {("a", "1"): 0.75, ("a", "2"): 0.25, ("b", "2"): 1.0, ("c", "5"): 1.0}
    pc = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                               "row_id long, facilityname string, productname string, periodname string, constraintvalue double")
    ad = spark.createDataFrame([(c, p, q) for (c, p), q in demand.items()], "corp_code string, periodname string, quantity double")
    sh = spark.createDataFrame([(c, x, s) for (c, x), s in share.items()], "corp_code string, return_loc_code string, share double")
    dense = _dense(rows, demand, share)
    got = {(r.row_id, r.corp_code): r.adjusted_constraintvalue for r in C.adjusted_returns(pc, ad, sh).collect()}
    assert got == {k: v for k, v in dense.items() if v != rows[k[0]][3]}
    # marked rows go to every account with demand in the period
    marked = pc.withColumn("all", F.col("row_id") == 0)
    more = {(r.row_id, r.corp_code): r.adjusted_constraintvalue for r in C.adjusted_returns(marked, ad, sh, always="all").collect()}
    assert more == {k: v for k, v in dense.items() if k[0] == 0 or v != rows[k[0]][3]}


def test_rows_of_equal_keys_fan_out_for_every_account(spark):
    m = build(spark)
    twice = m["constraints"].where("facilityname = 'R_US_101' AND productname = 'WIP'").withColumn("constraintvalue", F.lit(7.0))
    sel = C.select_accounts(m["accounts"], m["demand"], m["customers"])
    acv = C.build_account_constraints(m["constraints"].unionByName(twice), m["demand"], m["customers"],
                                      m["inventory_policies"], m["periods"], m["transfers"], sel)
    own = acv.where("facilityname = 'R_US_101' AND productname = 'WIP' AND corp_code = '81399'").collect()
    # this account sends nothing to the location, and still each row takes both rows' values
    assert sorted((r.constraintvalue, r.account_value) for r in own) == [(7.0, 7.0), (7.0, 100.0), (100.0, 7.0), (100.0, 100.0)]


def test_negative_need_kept_or_floored(spark):
    proj = spark.createDataFrame([(3, -4.0), (2, -9.0)], "period_no int, gap_6days double")
    assert sorted(r.needed_mfg for r in C.uplift_rows(proj).collect()) == [-2.0, -2.0]
    assert sorted(r.needed_mfg for r in C.uplift_rows(proj, floor_zero=True).collect()) == [0.0, 0.0]


def test_item_orders_after_max_option(spark):
    m = build(spark)
    sel = C.select_accounts(m["accounts"], m["demand"], m["customers"]).where(F.col("corp_code") == "81384")
    ex_a = spark.createDataFrame([(K.OPTIMAL_SCENARIO, "Item_A", 1, None), (K.OPTIMAL_SCENARIO, "Item_B", 2, None)],
                                 "scenarioname string, itemname string, itemorder long, notes string")
    a = S.build_scenario_assignments(ex_a, sel, start_after_max=True)
    mine = {(r.itemname, r.itemorder) for r in a.where(F.col("scenarioname").endswith("81384")).collect()}
    assert ("Exclude_Customer_81384", 3) in mine and ("Update_production_constraints_81384", 4) in mine


def test_sparse_values_give_same_reports_as_dense_wide_table(spark):
    from servelens.operators.core import unpivot_prefixed
    m, sel, acv = values(spark)
    codes = spark.createDataFrame([("81384",), ("81399",)], "corp_code string")
    wide = to_wide(acv, ["81384", "81399"])
    ids = [c for c in wide.columns if not c.startswith("account_")]
    dense = unpivot_prefixed(wide, ids, "account_")
    # dense: every (facility, account) pair; sparse: own pairs plus one shared row per facility
    d = {(r.facilityname, r.corp_code): r.returns for r in R.removed_returns(dense, codes).collect()}
    sparse = R.removed_returns(acv, codes).collect()
    shared = {r.facilityname: r.returns for r in sparse if r.corp_code is None}
    own = {(r.facilityname, r.corp_code): r.returns for r in sparse if r.corp_code is not None}
    for (fac, code), v in d.items():
        assert abs(v - own.get((fac, code), shared.get(fac, 0.0))) < 1e-9
    pairs = {(r.facilityname, r.corp_code): r.returns for r in R.removed_returns_dense(wide, codes).collect()}
    assert pairs.keys() == d.keys() and all(abs(pairs[k] - d[k]) < 1e-9 for k in d)
    # accounts without a column, and no account at all
    one = R.removed_returns_dense(wide, spark.createDataFrame([("81399",), ("00000",), (None,)], "corp_code string"))
    assert {r.corp_code for r in one.collect()} == {"81399"}
    assert R.removed_returns_dense(wide.drop("account_81384", "account_81399"), codes).count() == 0
    unit = spark.createDataFrame([("R_US_101", 1.0, 2.0, 2.0), ("R_US_102", 1.0, 3.0, 3.0)],
                                 "originname string, flowquantity double, total_transportation_cost double, "
                                 "return_cost_per_pallet double")
    cust = m["customers"]
    a = {r.corpcode: r.cur_tc_returns for r in R.current_return_cost(R.removed_returns(dense, codes), unit, cust, codes).collect()}
    b = {r.corpcode: r.cur_tc_returns for r in R.current_return_cost(R.removed_returns(acv, codes), unit, cust, codes).collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in a)
