"""Code lists, labels and limits used by the operators."""

# Source codes and the label published for each.
ACCOUNT_TYPES = {
    "SAV": "Savings",
    "CHK": "Checking",
    "CC": "Credit Card",
    "LN": "Retail Loan",
    "COM_CHK": "Commercial Checking",
    "COM_LN": "Commercial Loan",
}
ACCOUNT_STATUSES = {"O": "Open", "C": "Closed", "F": "Frozen"}
SEGMENTS = {"RTL": "Retail", "PRM": "Premium", "COM": "Commercial"}
CUSTOMER_STATUSES = {"AC": "Active", "DM": "Dormant", "CL": "Closed"}
FEE_TYPES = {
    "MAINT": "Maintenance",
    "OD": "Overdraft",
    "ATM": "ATM Surcharge",
    "POS_INTCH": "POS Interchange",
    "TRADE_FIN": "Trade Finance",
    "WIRE": "Wire Transfer",
    "LN_INT": "Loan Interest",
    "SVC": "Service Charge",
}
TRANSACTION_TYPES = {
    "POS": "Point of Sale",
    "DEP": "Deposit",
    "TFR": "Transfer",
    "WDR": "Withdrawal",
    "FEE": "Fee",
    "INT": "Interest",
    "ATM": "ATM",
}
CHANNELS = {
    "POS": "Point of Sale",
    "ONL": "Online",
    "MOB": "Mobile",
    "BR": "Branch",
    "ATM": "ATM",
    "WIRE": "Wire Transfer",
}
SETTLEMENT_STATUSES = {"S": "Settled", "P": "Pending", "R": "Returned"}
REGIONS = {
    "NE": "Northeast",
    "SE": "Southeast",
    "MW": "Midwest",
    "SW": "Southwest",
    "W": "West",
}
DIVISIONS = {"RB": "Retail Banking", "CB": "Commercial Banking"}
INDICATORS = ("D", "C")

# Which codes each division counts as its own.
RETAIL_PRODUCTS = ("SAV", "CHK", "CC", "LN")
COMMERCIAL_PRODUCTS = ("COM_CHK", "COM_LN")
RETAIL_SEGMENTS = ("RTL", "PRM")
COMMERCIAL_SEGMENTS = ("COM",)
RETAIL_FEES = ("MAINT", "OD", "ATM", "POS_INTCH")
COMMERCIAL_FEES = ("TRADE_FIN", "WIRE", "LN_INT", "SVC")
RETAIL_DIGITAL_CHANNELS = ("MOB", "ONL")
COMMERCIAL_DIGITAL_CHANNELS = ("MOB", "ONL", "WIRE")

# Published column for each counted or summed code.
ACCOUNT_TYPE_COUNTS = {
    "SAV": "savings_account_count",
    "CHK": "checking_account_count",
    "CC": "credit_card_count",
    "LN": "retail_loan_count",
    "COM_CHK": "commercial_checking_count",
    "COM_LN": "commercial_loan_count",
}
CHANNEL_COUNTS = {
    "POS": "pos_count",
    "ONL": "online_count",
    "MOB": "mobile_count",
    "BR": "branch_count",
    "ATM": "atm_count",
    "WIRE": "wire_count",
}
TRANSACTION_TYPE_COUNTS = {
    "POS": "type_pos_count",
    "DEP": "type_deposit_count",
    "TFR": "type_transfer_count",
    "WDR": "type_withdrawal_count",
    "FEE": "type_fee_count",
    "INT": "type_interest_count",
    "ATM": "type_atm_count",
}
FEE_TYPE_REVENUES = {
    "MAINT": "maintenance_fee_revenue",
    "OD": "overdraft_fee_revenue",
    "ATM": "atm_fee_revenue",
    "POS_INTCH": "pos_interchange_revenue",
    "TRADE_FIN": "trade_finance_revenue",
    "WIRE": "wire_fee_revenue",
    "LN_INT": "loan_interest_revenue",
    "SVC": "service_charge_revenue",
}

# Limits, in days, risk points and dollars.
DORMANT_AFTER_DAYS = 90
RECENCY_WINDOWS = (30, 90, 365)
NEW_RETAIL_DAYS = 90
NEW_COMMERCIAL_DAYS = 180
HIGH_RISK_RETAIL = 40
HIGH_RISK_COMMERCIAL = 30
LOW_BAND = (0, 9999)
MID_BAND = (10000, 49999)
DAYS_PER_MONTH = "30.44"
DAYS_PER_YEAR = "365.25"
