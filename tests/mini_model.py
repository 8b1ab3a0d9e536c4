"""A hand-made mini model: 2 accounts, 3 return locations, 3 periods."""

from servelens import constants as K

KEYS = list(K.CONSTRAINT_KEYS)
KEYS_NO_ORIG = [k for k in KEYS if k != K.ORIGINAL_STATUS_COLUMN]
SPECIAL = K.SPECIAL_DEPOT


def constraint_rows():
    def row(fac, prod, per, cv, notes, status="Include"):
        d = {k: None for k in KEYS_NO_ORIG}
        d.update(facilityname=fac, productname=prod, periodname=per, notes=notes, status=status,
                 constrainttype="Fixed", constraintvalue=str(cv))
        return d
    return [
        row("R_US_101", "WIP", "Period 01", 100, K.RETURNS_NOTE),
        row("R_US_101", "RFU", "Period 01", 50, K.RETURNS_NOTE),
        row("R_US_102", "WIP", "Period 02", 80, K.RETURNS_NOTE),
        row("R_US_103", "WIP", "Period 01", 40, K.RETURNS_NOTE),
        row(SPECIAL, K.PRODUCT_NEW, "Period 01", 1000, "SOIP_MFG"),
        row(SPECIAL, K.PRODUCT_NEW, "Period 02", 1000, "SOIP_MFG"),
        row(SPECIAL, K.PRODUCT_NEW, "Period 03", 1000, "SOIP_MFG"),
        row(SPECIAL, K.PRODUCT_NEW, "2023", 12000, "SOIP_MFG"),
        row("D_USA77571_77572", K.PRODUCT_NEW, "Period 09", 21600, "SOIP_MFG"),
        row(K.DEPOT_GROUP, None, "Period 01", 500, "MinRepairsPerDay"),
        row(K.DEPOT_GROUP, None, "Period 02", 500, "MinRepairsPerDay", status="Exclude"),
        row("D_USA1_2", "RFU", "Period 01", 30, "Repair_Capacity", status="Exclude"),
    ]


def build(spark):
    cols = KEYS_NO_ORIG + ["constraintvalue"]
    schema = ", ".join(f"{c} string" for c in cols)
    constraints = spark.createDataFrame([tuple(r[c] for c in cols) for r in constraint_rows()], schema)
    demand = spark.createDataFrame(
        [("I_1", "RFU", "Period 01", "300"), ("I_1", "RFU", "Period 02", "200"), ("I_2", "RFU", "Period 01", "100"),
         ("I_2", "RFU", "Period 03", "50"), ("I_3", "RFU", "Period 02", "40")],
        "customername string, productname string, periodname string, quantity string")
    customers = spark.createDataFrame(
        [("I_1", "1", "81384", "Alpha"), ("I_2", "2", "81399", "Beta"), ("I_3", "3", "99999", "Gamma")],
        "customername string, loccode string, corpcode string, corpname string")
    inventory = spark.createDataFrame([("D_1", "5000")], "facilityname string, initialinventory string")
    periods = spark.createDataFrame([("Period 01", 20), ("Period 02", 21), ("Period 03", 0), ("2023", 250)],
                                    "periodname string, workingdays int")
    transfers = spark.createDataFrame(
        [("81384", "A", "101", "L1", "1", "R", 30.0), ("81384", "A", "102", "L2", "1", "R", 10.0),
         ("81399", "B", "103", "L3", "1", "R", 5.0)],
        "renter_corp_code string, renter_corp_desc string, return_loc_code string, return_loc_desc string, "
        "return_corp_code string, return_corp_desc string, return_volume double")
    accounts = spark.createDataFrame(
        [("81384", "Alpha & Co.", "Y", "M\\Base\\", None), ("81399", "Beta, Ltd", "y", "M\\Base\\", None),
         ("99999", "Gamma", "N", "M\\Base\\", None)],
        "corp_code string, corp_desc string, evaluate string, base_model string, account_model string")
    from servelens.sources import tables as T
    return dict(constraints=T.typed_constraints(constraints), demand=T.typed_demand(demand), customers=customers,
                inventory_policies=T.typed_inventory(inventory), periods=periods, transfers=transfers,
                accounts=accounts)
