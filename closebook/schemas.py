"""Declared schemas of the ledger inputs, as DDL.

Columns that no operator reads are left out: sources select by name, so wider
files are fine and the surplus columns are never decoded.
"""

CASH_FLOWS = (
    "I17EXPCHANGE int, I17KEYDATE int, I17REFOBJID string, I17COSTREVENUE string, "
    "I17ESTCURR string, I17INCURREDDATE int, I17SETTLEMDATE int, I17ESTAMOUNT double"
)
ACTUALS = "I17PORTID string, I17CFTYPE string, I17VALUE double, I17FUNCTVALUE double"
MARGINS = (
    "I17REFOBJID string, I17COSTREVENUE string, I17ESTCURR string, I17ESTAMOUNT double"
)
CURVE_INT_DATES = "I17DISCDATE int, I17ESTCURR string, I17DISCFACT double"
CURVE_TEXT_DATES = "I17DISCDATE string, I17ESTCURR string, I17DISCFACT double"
OPENING_RATES = "FROM_CURRENCY string, EXCHANGE_RATE double"
CLOSING_RATES = "FROM_CURRENCY string, EXCHANGE_RATE double, type string"
ACCOUNT_BY_CLASS = "I17COSTREVENUE string, ri_rh string, lrc_lic string, account string"
ACCOUNT_BY_SEGMENT = "I17COSTREVENUE string, ri_rh string, account string"
ACCOUNT_BY_CODE = "I17COSTREVENUE string, account string"
ACCOUNT_OF_CHARGE = "lrc_lic string, account string"
LOCAL_PORTFOLIOS = "contract string, local_portfolio string"
COUNTER_ACCOUNTS = "account string, counter_account string"
OLD_CONTRACTS = "contract string"
FIELD_NAMES = "Field string, Name string, Position int"

# Column names of the ledger extracts.
LEDGER_COLUMNS = (
    "Posting Date",
    "Cost or Revenue Element",
    "NewGL Segment",
    "G/L Account",
    "Amount in Functional Currency",
)
LEDGER = (
    "`Posting Date` string, `Cost or Revenue Element` string, `NewGL Segment` string, "
    "`G/L Account` string, `Amount in Functional Currency` double"
)
# Technical field names of a ledger extract.
LEDGER_FIELDS = (
    "/BA1/K5SAMBAL", "AARK5SAMO", "/BA1C/BTTRAMTC", "/BA1/BIL_CURR", "/BA1C/BTPOSTDT",
    "/WSV/PORTL", "/BA1/C55CMETHY", "/BA1/C55PROCID", "/BA1/C55DOCNUM", "/BA1/C55ALST",
    "/BA1/C55DBCDF", "/BA1/C55ONRST", "AARIGLAC", "/BA1/C55YPER", "/BA1/C55ONSTIR",
    "AARC55SLA", "/WSV/PORTG", "/BA1/C55SLACC", "AARC35TRX", "/BA1/C55CHGRSN",
    "AARC55CON", "AARCRCPAY", "AARC55LSC", "/BA1/C80BUSSG", "/WSV/PCLIC", "AARC55GIC",
    "/BA1/C55R1CNID", "/BA1/C55INSEIN", "/BA1/C55LOCOMP", "/BA1/C55LORECO",
)
FUNCTIONAL_AMOUNT = "Functional Crcy Amt"
TRANSACTION_AMOUNT = "Transaction Crcy Amt"
