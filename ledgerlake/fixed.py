"""Fixed values of the ledger derived from the driver's tables.

Everything below is a literal that both engines (Spark and the DuckDB
oracle) must agree on.  The account chart, names, sections and mapping
rules are our own invention (see FIXTURES.md, section B); the department
codes follow the cost-center convention of the source ledger.
"""

from __future__ import annotations

# --- Fixed values: ledger calendar -------------------------------------------------
# Last closed period; everything after it is "unclosed" activity.
LAST_CLOSE = 200102
# Current fiscal year (the year of the last close) and the prior year.
CURRENT_YEAR = LAST_CLOSE // 100
PRIOR_YEAR = CURRENT_YEAR - 1
# Tolerances used by the reconciliation checks.
DRIFT_TOLERANCE = "0.005"
BALANCE_TOLERANCE = "0.01"
# Intercompany clearing account, and all accounts between companies and divisions.
INTERCOMPANY_ACCOUNT = "27400"
INTERCOMPANY_ACCOUNTS = ["10180", "24900", "27400"]
# Accounts that a consolidation eliminates: those and the second transfer account.
ELIMINATION_ACCOUNTS = ["10180", "10182", "24900", "27400"]
# Company that carries the counterpart of every intercompany leg.
HOLDING_COMPANY = "01"

# --- Fixed values: account chart --------------------------------------------------
# (account, name, status) in account order.  Type and asset/liability flag follow
# from the first digit (see ACCOUNT_TYPE_BY_DIGIT, LIABILITY_FLAG_BY_DIGIT).
ACCOUNTS = [
    ("10100", "Cash in bank", ""),
    ("10200", "Trade receivables", ""),
    ("12000", "Wholegoods inventory", ""),
    ("16100", "Accumulated depreciation", ""),
    ("16300", "Accumulated amortization", ""),
    ("20350", "Floorplan payable", ""),
    ("27400", "Intercompany clearing", ""),
    ("31001", "Equipment sales brand A", ""),
    ("31500", "Equipment sales brand B", ""),
    ("32000", "Equipment sales brand C", ""),
    ("33100", "Parts sales", ""),
    ("34000", "Service labour sales", ""),
    ("35000", "Rental revenue", ""),
    ("41001", "Cost of equipment brand A", ""),
    ("41500", "Cost of equipment brand B", ""),
    ("42000", "Cost of equipment brand C", ""),
    ("43100", "Cost of parts sold", ""),
    ("44000", "Cost of service labour", ""),
    ("45000", "Cost of rental", ""),
    ("51900", "Salaries and wages", ""),
    ("51910", "Sales commissions", ""),
    ("54000", "Office expense", "D"),
    ("55100", "Depreciation expense", ""),
    ("58200", "Floorplan interest", ""),
    ("58400", "General expense", ""),
    ("59100", "Bank interest", "D"),
]
# First digit of the account -> ACTYP ('1' balance sheet, '2' revenue, '3' expense).
ACCOUNT_TYPE_BY_DIGIT = {"1": "1", "2": "1", "3": "2", "4": "3", "5": "3"}
# First digit of the account -> ACLIA ('A' asset, 'L' liability and equity).
LIABILITY_FLAG_BY_DIGIT = {"1": "A", "2": "L"}
# Accounts flagged as cash (ACCT = 'Y').
CASH_ACCOUNTS = ["10100"]

# --- Fixed values: statement sections ----------------------------------------------
# (account, statement, section, section order).  Statement 'PL' profit and loss,
# 'BA' balance-sheet asset, 'BL' balance-sheet liability.
SECTIONS = [
    ("31001", "PL", "Equipment revenue", 10),
    ("31500", "PL", "Equipment revenue", 10),
    ("32000", "PL", "Equipment revenue", 10),
    ("33100", "PL", "Parts revenue", 20),
    ("34000", "PL", "Service revenue", 30),
    ("35000", "PL", "Other revenue", 40),
    ("41001", "PL", "Equipment COGS", 50),
    ("41500", "PL", "Equipment COGS", 50),
    ("42000", "PL", "Equipment COGS", 50),
    ("43100", "PL", "Parts COGS", 60),
    ("44000", "PL", "Service COGS", 70),
    ("45000", "PL", "Other COGS", 80),
    ("51910", "PL", "Variable expense", 90),
    ("51900", "PL", "Personnel", 100),
    ("58400", "PL", "Operating expense", 110),
    ("54000", "PL", "Operating expense", 110),
    ("55100", "PL", "Depreciation and amortization", 120),
    ("58200", "PL", "Interest expense", 130),
    ("59100", "PL", "Interest expense", 130),
    ("10100", "BA", "Cash", 10),
    ("10200", "BA", "Receivables", 20),
    ("12000", "BA", "Wholegoods inventory", 30),
    ("16100", "BA", "Fixed assets net", 40),
    ("16300", "BA", "Fixed assets net", 40),
    ("20350", "BL", "Floorplan payable", 50),
    ("27400", "BL", "Intercompany", 60),
]
# Subtotal lines of the structured income statement: (label, order, last section order
# included).  Each sums NetIncomeImpact over sections 10..last.
PL_SUBTOTALS = [
    ("Total revenue", 45, 40),
    ("Gross profit", 85, 80),
    ("EBITDA", 115, 110),
    ("Operating income", 125, 120),
    ("Net income", 135, 130),
]
# Line rolled into equity on the balance sheet.
NET_INCOME_SECTION = ("Current and prior net income", 70)

# --- Fixed values: departments (first digit of the cost center) ------------------------
DEPARTMENTS = [
    ("0", "Corporate"),
    ("1", "Admin"),
    ("2", "Sales"),
    ("3", "Service"),
    ("4", "Parts"),
    ("5", "Rental"),
]
# Departments that make up "Total Fixed".
FIXED_DEPARTMENTS = ["3", "4", "5"]

# --- Fixed values: brands of the equipment accounts ------------------------------------
BRANDS = [
    ("31001", "Brand A"),
    ("41001", "Brand A"),
    ("31500", "Brand B"),
    ("41500", "Brand B"),
    ("32000", "Brand C"),
    ("42000", "Brand C"),
]

# --- Fixed values: account pairs (revenue -> its cost, asset -> its contra) ------------
# Pairs are found by rule: same last four digits, first digit 3 -> 4 and 15 -> 16.

# --- Fixed values: mapping of the driver's tables to journal legs (FIXTURES F1) -------
# p_type -> (department, revenue account)
PART_TYPE_MAP = [
    ("ECONOMY", "2", "32000"),
    ("STANDARD", "2", "31001"),
    ("LARGE", "2", "31500"),
    ("SMALL", "4", "33100"),
    ("MEDIUM", "3", "34000"),
    ("PROMO", "5", "35000"),
]
# o_orderpriority -> expense account
PRIORITY_EXPENSE_MAP = [
    ("1-URGENT", "51900"),
    ("2-HIGH", "51910"),
    ("3-MEDIUM", "58200"),
    ("4-NOT SPECIFIED", "58400"),
    ("5-LOW", "54000"),
]
# l_linestatus -> stock account
LINESTATUS_STOCK_MAP = [("F", "12000"), ("O", "20350")]
RECEIVABLE_ACCOUNT = "10200"
CASH_ACCOUNT = "10100"
DEPRECIATION_ACCOUNT = "55100"
ACCUM_DEPRECIATION_ACCOUNT = "16100"
# Number of branches a supplier key is folded into.
BRANCH_COUNT = 17
# COGS is 70 % of the extended price.
COST_NUMERATOR, COST_DENOMINATOR = 7, 10
# COACMAST: default COGS percentage for cost accounts; orphan rule; alias exceptions.
COGS_DEFAULT_PCT = "0.700"
ORPHAN_ACCOUNT, ORPHAN_BRANCH = "58200", "17"
UNMAPPED_ACCOUNT = "58400"
SPLIT_ALIAS_ACCOUNT = "10100"
SPLIT_ALIAS_LOW, SPLIT_ALIAS_HIGH, SPLIT_ALIAS_CUT = "F101", "F102", "09"
# Year-end adjustments: depreciation postings in month 12.
YEAR_END_ACCOUNT, YEAR_END_MONTH = "55100", 12
# Run-id format used for merge runs.
RUN_ID = "00000000-0000-0000-0000-000000000001"

# --- Fixed values: detailed balance-sheet accounts (FIXTURES F8) ------------------------
# (account, name) in account order: the accounts that the structured balance sheet tells
# apart.  Balances of the chart above are dealt to them by branch.
DETAIL_ACCOUNTS = [
    ("10113", "Checking account A"),
    ("10114", "Checking account B"),
    ("10140", "Petty cash"),
    ("10151", "Cash in bank"),
    ("10170", "Undeposited funds"),
    ("10180", "Intercompany transfer"),
    ("10200", "Accounts receivable"),
    ("10204", "Property insurance receivable"),
    ("10210", "Incentives"),
    ("10224", "Card processor receivable"),
    ("10230", "Finance income reserve"),
    ("10241", "Warranty receivable A"),
    ("10242", "Warranty receivable B"),
    ("10245", "Indemnity receivable"),
    ("10246", "Other warranty receivable"),
    ("10301", "Prepaid expense"),
    ("12000", "Wholegoods inventory"),
    ("12100", "Equipment reserve"),
    ("13000", "Parts inventory"),
    ("13010", "Parts inventory reserve"),
    ("14000", "Work in process"),
    ("15100", "Buildings"),
    ("15103", "Paving"),
    ("15110", "Fencing"),
    ("15120", "Lighting"),
    ("15200", "Shop equipment"),
    ("15300", "Parts equipment"),
    ("15400", "Furniture and fixtures"),
    ("15600", "IT hardware"),
    ("15700", "Autos, trucks and trailers"),
    ("15800", "Tractors"),
    ("15950", "Improvements"),
    ("16100", "Accumulated depreciation, buildings"),
    ("16103", "Accumulated depreciation, paving"),
    ("16110", "Accumulated depreciation, fencing"),
    ("16120", "Accumulated depreciation, lighting"),
    ("16200", "Accumulated depreciation, shop equipment"),
    ("16300", "Accumulated depreciation, parts equipment"),
    ("16400", "Accumulated depreciation, furniture and fixtures"),
    ("16600", "Accumulated depreciation, IT hardware"),
    ("16700", "Accumulated depreciation, autos, trucks and trailers"),
    ("16800", "Accumulated depreciation, tractors"),
    ("16950", "Accumulated depreciation, improvements"),
    ("17800", "Capital loan costs"),
    ("20150", "Sales tax deposit"),
    ("20350", "Floorplan payable"),
    ("22100", "Accrued payroll"),
    ("24100", "Related party loan"),
    ("24900", "System clearing"),
    ("25100", "Note payable, bank"),
    ("27400", "Intercompany clearing"),
    ("27550", "Distributions"),
]
DISTRIBUTION_ACCOUNTS = ["27550"]
# Accounts that a balance is dealt to, by branch number modulo their count.
DETAIL_OF = {
    "10100": ["10113", "10114", "10140", "10151", "10170"],
    "10200": ["10180", "10200", "10204", "10210", "10224", "10230", "10241", "10242", "10245", "10246", "10301", "14000", "17800"],
    "20350": ["20150", "20350", "22100", "24100", "24900", "25100", "27550"],
}
# Inventory and its reserve: even branches wholegoods, odd ones parts; the reserve is a
# 25th of the balance.
INVENTORY_ACCOUNT = "12000"
INVENTORY_PAIRS = [("12000", "12100"), ("13000", "13010")]
RESERVE_SHARE = 25
# Fixed assets by the last three digits: cost is 15xxx, its accumulated depreciation
# 16xxx; the cost is five times the depreciation booked.
ASSET_SUFFIXES = ["100", "103", "110", "120", "200", "300", "400", "600", "700", "800", "950"]
ASSET_COST_FACTOR = 5

# --- Fixed values: section rules of the structured balance sheet ------------------------
# (account prefix, side, section, section order, current asset); the longest prefix wins.
BS_PREFIX_RULES = [
    ("101", "Assets", "Cash and equivalents", 10, 1),
    ("1018", "Assets", "Intercompany", 80, 0),
    ("102", "Assets", "Accounts receivable", 20, 1),
    ("10224", "Assets", "Other current assets", 30, 1),
    ("103", "Assets", "Other current assets", 30, 1),
    ("12", "Assets", "Wholegoods inventory", 40, 1),
    ("12100", "Assets", "Reserves", 70, 0),
    ("13", "Assets", "Parts inventory", 50, 1),
    ("13010", "Assets", "Reserves", 70, 0),
    ("14", "Assets", "Work in process", 60, 1),
    ("15", "Assets", "Property, plant and equipment", 90, 0),
    ("16", "Assets", "Property, plant and equipment", 90, 0),
    ("17", "Assets", "Intangibles and other", 100, 0),
    ("18", "Assets", "Intangibles and other", 100, 0),
    ("19", "Assets", "Intangibles and other", 100, 0),
    ("20", "Liabilities and equity", "Accounts payable", 210, 0),
    ("20350", "Liabilities and equity", "Floorplan payable", 220, 0),
    ("22", "Liabilities and equity", "Accrued expenses and reserves", 230, 0),
    ("24", "Liabilities and equity", "Related party loans", 250, 0),
    ("24900", "Liabilities and equity", "Intercompany liabilities", 260, 0),
    ("25", "Liabilities and equity", "Notes payable", 240, 0),
    ("26", "Liabilities and equity", "Notes payable", 240, 0),
    ("27", "Liabilities and equity", "Equity", 270, 0),
    ("27400", "Liabilities and equity", "Intercompany liabilities", 260, 0),
]
PPE_SECTION = "Property, plant and equipment"
UNCLASSIFIED = ("Unclassified", 190)

# --- Fixed values: metrics (FS33, FS40, FS41) ---------------------------------------------
# (metric, part, section): what a metric adds up, in the sections' display sign (revenue,
# cost, assets and liabilities all positive).  "flow" rows are of the trailing twelve
# months, "stock" rows balances.
METRIC_RULES = [
    ("CurrentAssets", "stock", "Cash"),
    ("CurrentAssets", "stock", "Receivables"),
    ("CurrentAssets", "stock", "Wholegoods inventory"),
    ("QuickAssets", "stock", "Cash"),
    ("QuickAssets", "stock", "Receivables"),
    ("CurrentLiabilities", "stock", "Floorplan payable"),
    ("EquipmentSales", "flow", "Equipment revenue"),
    ("CostOfSales", "flow", "Equipment COGS"),
    ("CostOfSales", "flow", "Parts COGS"),
    ("CostOfSales", "flow", "Service COGS"),
    ("CostOfSales", "flow", "Other COGS"),
    ("PartsRevenue", "flow", "Parts revenue"),
    ("PartsCost", "flow", "Parts COGS"),
    ("ServiceRevenue", "flow", "Service revenue"),
    ("ServiceCost", "flow", "Service COGS"),
    ("RentalRevenue", "flow", "Other revenue"),
    ("RentalCost", "flow", "Other COGS"),
    ("Inventory", "stock", "Wholegoods inventory"),
    ("FloorPlan", "stock", "Floorplan payable"),
]
# Equipment by account prefix (revenue and its cost): new or used.
CONDITION_PREFIXES = [("31", "New"), ("32", "Used"), ("41", "New"), ("42", "Used")]
# Cash equivalents (FS33) by prefix of the detailed accounts; the longest prefix wins.
CASH_EQUIVALENT_PREFIXES = [("101", "CashInBank"), ("10170", "ContractsInTransit"), ("1018", "Intercompany"), ("10200", "VehicleReceivables")]
