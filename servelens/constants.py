"""Fixed values.

These values must equal the ones of the scenario model the library
reproduces, otherwise results differ.  They are listed here, plainly and in
one place; every operator takes them as keyword arguments with these
defaults, so a different model only passes other values.
"""

# --- fixed values (must match the modelled network) -------------------------
LOSS_RATE = 0.975                       # share of an account's returns that really comes back
EPS = 0.25                              # operational inefficiency uplift on optimised costs
BASELINE_SCENARIO = "SOIP Default Assignments (12 Month)"
OPTIMAL_SCENARIO = "SOIP Optimize (12 Month)"
LESS_SCENARIO_PREFIX = "SOIP Optimized – Less "   # en dash, as in the model
LESS_MARKER = "Less"
SPECIAL_DEPOT = "D_USA35490_54027"      # the depot that absorbs extra manufacturing
DEPOT_GROUP = "Depot"                   # facility group of the repair minimum
RETURN_PREFIX = "R_"                    # return locations
DEPOT_PREFIX = "D_"                     # depots
ISSUE_PREFIX = "I_"                     # customers (issues)
PRODUCT_NEW = "RFU_NEW"                 # newly manufactured pallets
PRODUCT_WIP = "WIP"                     # pallets waiting for repair
REPAIR_NOTES = ("Repair_Capacity", "MinRepairsPerDay", "RepairsPerMonthVariance")
RETURNS_NOTE = "Returns_SOIP"
REPAIR_BOM = "BOM_RFU_REPAIR"
MANUFACTURING_TYPE = "Manufacturing"
STATUS_INCLUDE = "Include"
STATUS_EXCLUDE = "Exclude"
FIRST_PERIOD = "Period 01"
ANNUAL_PERIOD = "2023"
HORIZON_PERIODS = 12                    # months reported / planned
COVER_DAYS = 6                          # days of issues the inventory must cover
ROUND_SCALE = 6                         # decimals kept for adjusted return constraints
ACCOUNT_COLUMN_PREFIX = "account_"
ORIGINAL_STATUS_COLUMN = "original_status_field"
EXPECTED_MONTHLY_FILES = 12

# scenario item templates; <c> is the corporate code
EXCLUDE_ITEM_PREFIX = "Exclude_Customer_"
UPDATE_ITEM_PREFIX = "Update_production_constraints_"
EXCLUDE_ITEM_TABLE = "Customers"
EXCLUDE_ITEM_ACTION = "Status='Exclude'"
UPDATE_ITEM_TABLE = "ProductionConstraints"
UPDATE_ITEM_ACTION_PREFIX = "constraintvalue = account_"

# the 17 columns that identify a production constraint row
CONSTRAINT_KEYS = (
    "facilityname", "facilitynamegroupbehavior", "productname",
    "productnamegroupbehavior", "periodname", "periodnamegroupbehavior",
    "bomname", "bomnamegroupbehavior", "processname",
    "processnamegroupbehavior", "constrainttype",
    "constraintvalueuom", "status", "notes", "soipquantity",
    "conversionnotes", "original_status_field",
)

# the six keys of the monthly transfer files
TRANSFER_KEYS = (
    "renter_corp_code", "renter_corp_desc", "return_loc_code",
    "return_loc_desc", "return_corp_code", "return_corp_desc",
)

# column headers of the source workbooks -> our column names
TRANSFER_HEADERS = {
    "Renter Corp Code": "renter_corp_code",
    "Renter Corp Desc": "renter_corp_desc",
    "Return Loc Code": "return_loc_code",
    "Return Loc Desc": "return_loc_desc",
    "Return Corp Code": "return_corp_code",
    "Return Corp Desc": "return_corp_desc",
    "Return Volume": "return_volume",
}
ACCOUNT_HEADERS = {
    "Corporate Code": "corp_code",
    "Corporate Description": "corp_desc",
    "Evaulate": "evaluate",
    "Base Model": "base_model",
    "Account Model": "account_model",
}

# report labels of the scenario table, in export order -> our column names
SCENARIO_MEASURES = (
    ("Issues", "issues"),
    ("Returns", "returns"),
    ("Network R:I", "network_r_i"),
    ("Transportation Cost - Issues", "tc_issues"),
    ("Transportation Cost - Returns", "tc_returns"),
    ("Transportation Cost - Transfers", "tc_transfers"),
    ("Total Transportation Cost: Issues + Returns + Transfers", "tc_total"),
    ("Depot Cost - Fixed", "depot_fixed"),
    ("Depot Cost - Painting", "depot_painting"),
    ("Depot Cost - Handling", "depot_handling"),
    ("Depot Cost - Inventory Carrying (Not Included in Total)", "depot_inventory"),
    ("Depot Cost - Repair", "depot_repair"),
    ("Total Depot Cost: Fixed + Painting + Handling + Repair", "depot_total"),
    ("Total Variable Depot Cost CPI", "variable_depot_cpi"),
    ("Total Fixed Depot Cost CPI", "fixed_depot_cpi"),
    ("Total Cost per Issue", "total_cpi"),
)

# report labels of the account table, in export order -> our column names
ACCOUNT_MEASURES = (
    ("Account Issues", "account_issues"),
    ("Account Returns", "account_returns"),
    ("Account R:I", "account_r_i"),
    ("Optimized Network Transportation Cost - Issues", "opt_tc_issues"),
    ("Optimized Network Transportation Cost - Returns", "opt_tc_returns"),
    ("Optimized Network Transportation Cost - Transfers", "opt_tc_transfers"),
    ("Current Network Transportation Cost - Issues", "cur_tc_issues"),
    ("Current Network Transportation Cost - Returns", "cur_tc_returns"),
    ("Current Network Transportation Costs - Ops Ineffeciencies", "cur_ops_inefficiency"),
    ("Current Network Transportation Cost - Transfers", "cur_tc_transfers"),
    ("Current Network Transportation Cost - Issues - CPI", "cur_tc_issues_cpi"),
    ("Current Network Transportation Cost - Returns - CPI", "cur_tc_returns_cpi"),
    ("Current Network Transportation Cost - Transfers - CPI", "cur_tc_transfers_cpi"),
    ("Optimized Network Transportation Cost - Issues - CPI", "opt_tc_issues_cpi"),
    ("Optimized Network Transportation Cost - Returns - CPI", "opt_tc_returns_cpi"),
    ("Optimized Network Transportation Cost - Transfers - CPI", "opt_tc_transfers_cpi"),
)
