"""End to end: the four steps over a mini model written to folders."""

from pyspark.sql import functions as F

from servelens import constants as K
from servelens.plans import runs

from mini_model import build
from test_sources_sinks import _write_months

FLOW_COLS = ("scenarioname string, departingperiodname string, originname string, destinationname string, "
             "flowquantity double, shipmentcost double, sourcingcost double, transportationcost double")


def _scenarios():
    return [K.BASELINE_SCENARIO, K.OPTIMAL_SCENARIO, K.LESS_SCENARIO_PREFIX + "81384", K.LESS_SCENARIO_PREFIX + "81399"]


def test_four_steps(spark, tmp_path):
    root = str(tmp_path)
    m = build(spark)
    # step 1
    _write_months(f"{root}/months", 12)
    tm = runs.write_transfer_matrix(spark, f"{root}/months", f"{root}/transfer_matrix")
    assert tm.count() == 2
    # step 2 on the mini model
    for name, key in [("customers", "customers"), ("periods", "periods"), ("customerdemand", "demand"),
                      ("inventorypolicies", "inventory_policies"), ("productionconstraints", "constraints")]:
        m[key].write.parquet(f"{root}/model/{name}")
    wide = runs.update_constraints(spark, f"{root}/model", m["accounts"], m["transfers"], f"{root}/out/constraints")
    assert {"account_81384", "account_81399"} <= set(wide.columns)
    golden = wide.where(F.col("facilityname") == "D_USA77571_77572").collect()[0]
    assert golden["account_81384"] == "21600.0"
    # step 3
    sc = _scenarios()
    spark.createDataFrame([(s, "Include", None, None, None, None) for s in sc[:2]],
                          "scenarioname string, status string, description string, tags string, notes string, "
                          "technology string").write.parquet(f"{root}/model/scenarios")
    spark.createDataFrame([("Item_A", "Facilities", "x", None, "Include", None, None, None)],
                          ", ".join(f"{c} string" for c in ("itemname", "tablename", "action", "condition", "status",
                                                            "description", "tags", "notes"))
                          ).write.parquet(f"{root}/model/scenarioitems")
    spark.createDataFrame([(K.OPTIMAL_SCENARIO, "Item_A", 1, None)],
                          "scenarioname string, itemname string, itemorder long, notes string"
                          ).write.parquet(f"{root}/model/scenarioitemassignments")
    reg = runs.register_scenarios(spark, f"{root}/model", m["accounts"], f"{root}/out/registered")
    assert reg["scenarios"].count() == 4 and reg["scenarioitems"].count() == 5
    assert reg["scenarioitemassignments"].count() == 1 + 2 * 3
    # step 4: solver results for the four scenarios
    rows = []
    for i, s in enumerate(sc):
        rows += [(s, "Period 01", "D_2", "I_1", 100.0 - 10 * i, 1.0, 2.0, 3.0),
                 (s, "Period 02", "R_US_101", "D_2", 50.0 - 5 * i, 1.0, 1.0, 1.0),
                 (s, "Period 03", "D_1", "D_2", 20.0, 1.0, 1.0, 1.0),
                 (s, "Period 13", "D_2", "I_2", 999.0, 9.0, 9.0, 9.0)]
    spark.createDataFrame(rows, FLOW_COLS).write.parquet(f"{root}/model/optimizationflowsummary")
    spark.createDataFrame([(s, "Period 01", "D_1", 10.0) for s in sc],
                          "scenarioname string, periodname string, facilityname string, operatingcost double"
                          ).write.parquet(f"{root}/model/optimizationfacilitysummary")
    spark.createDataFrame([(s, "Period 01", 1.0, 2.0) for s in sc],
                          "scenarioname string, periodname string, inboundhandlingcost double, "
                          "outboundhandlingcost double").write.parquet(f"{root}/model/optimizationwarehousingsummary")
    spark.createDataFrame([(s, "Period 01", 4.0) for s in sc],
                          "scenarioname string, periodname string, totalinventorycost double"
                          ).write.parquet(f"{root}/model/optimizationinventorysummary")
    spark.createDataFrame([(s, "Period 01", K.REPAIR_BOM, 6.0) for s in sc],
                          "scenarioname string, startingperiodname string, bomname string, productioncost double"
                          ).write.parquet(f"{root}/model/optimizationproductionsummary")
    spark.createDataFrame([("D_1", K.MANUFACTURING_TYPE)], "facilityname string, depottype string"
                          ).write.parquet(f"{root}/model/facilities")
    # the report step reads the constraint table with its account columns (a separate folder)
    m2 = f"{root}/model2"
    for t in ("optimizationflowsummary", "optimizationfacilitysummary", "optimizationwarehousingsummary",
              "optimizationinventorysummary", "optimizationproductionsummary", "facilities", "customers"):
        spark.read.parquet(f"{root}/model/{t}").write.parquet(f"{m2}/{t}")
    wide.write.parquet(f"{m2}/productionconstraints")
    paths = runs.write_reports(spark, m2, f"{root}/reports", run_date="2024-05-01")
    scen = spark.read.option("header", "true").csv(paths["scenario_data"])
    assert scen.count() == 4 + 4 and "Total Cost per Issue" in scen.columns
    acct = spark.read.option("header", "true").csv(paths["customer_data"])
    got = {r["corpcode"]: r for r in acct.collect()}
    assert set(got) == {"81384", "81399"}
    # optimal has 90 issues in the horizon, 'Less 81384' has 80: the account issues 10
    assert float(got["81384"]["Account Issues"]) == 10.0
    assert got["81384"]["Customer"] == "81384 - Alpha"
    # the same reports from results stored by period number
    stored = runs.store_results(spark, m2, f"{root}/stored", n_parts=4)
    assert stored["optimizationproductionsummary"].schema["period_no"].dataType.simpleString() == "int"
    again = runs.write_reports(spark, f"{root}/stored", f"{root}/reports2", run_date="2024-05-01")
    for name, path in paths.items():
        first, second = (spark.read.option("header", "true").csv(p) for p in (path, again[name]))
        assert first.columns == second.columns and sorted(map(str, first.collect())) == sorted(map(str, second.collect()))


def test_only_local_masters_get_a_scratch_checkpoint_folder():
    import pytest
    from servelens.session import ensure_checkpoint_dir

    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        def __init__(self, master):
            self.sparkContext, self.master = Context(), master
            self.sparkContext.master = master
            self.conf = self

        def get(self, key, default=None):
            return self.master if key == "spark.master" else default

    for master in ("", "yarn", "spark://host:7077", "local-cluster[2,1,512]"):
        with pytest.raises(ValueError):
            ensure_checkpoint_dir(Session(master))
