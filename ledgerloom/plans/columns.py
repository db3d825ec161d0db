"""Columns of the published tables, in the order in which they are published."""

# Names and order of the columns of each table.
STG_ACCOUNTS = (
    "account_id", "customer_id", "account_type_code", "open_date", "close_date", "account_status_code",
    "balance", "branch_code",
)
STG_CUSTOMERS = (
    "customer_id", "crm_reference", "date_of_birth", "onboard_date", "segment_code", "customer_status_code",
    "risk_score", "know_your_cust_flag",
)
STG_FEES = ("fee_id", "account_id", "transaction_id", "fee_type_code", "fee_amount", "fee_date")
STG_TRANSACTIONS = (
    "transaction_id", "account_id", "transaction_date", "posting_date", "transaction_amount",
    "transaction_indicator", "transaction_type_code", "transaction_channel_code", "settlement_status",
)
ACCOUNTS_DECODED = (
    "account_id", "customer_id", "branch_code", "account_type_code", "account_status_code", "open_date",
    "close_date", "balance", "account_type", "account_status", "is_retail_product", "is_commercial_product",
    "is_open", "is_closed", "is_frozen", "account_age_days", "account_age_months", "balance_band",
)
CUSTOMERS_DECODED = (
    *STG_CUSTOMERS,
    "customer_segment", "customer_status", "is_retail_customer", "is_commercial_customer", "is_active",
    "is_dormant", "is_closed", "customer_age", "age_bucket", "tenure_days", "tenure_months",
    "is_new_retail_customer", "is_new_commercial_customer", "is_high_risk_retail", "is_high_risk_commercial",
)
TRANSACTIONS_DECODED = (
    *STG_TRANSACTIONS,
    "transaction_type", "channel", "transaction_status", "signed_amount", "is_settled", "is_pending",
    "is_returned", "is_digital_retail", "is_digital_commercial", "is_wire", "settlement_lag_days",
    "transaction_month", "transaction_year", "transaction_month_num", "transaction_day_of_week",
)
FEES_DECODED = (
    *STG_FEES,
    "fee_type", "is_retail_fee", "is_commercial_fee", "is_standalone_fee", "fee_month", "fee_year",
    "fee_month_num",
)
BRIDGE = (
    "account_id", "customer_id", "branch_code",
    # account
    "account_type_code", "account_type", "account_status_code", "account_status", "open_date", "close_date",
    "balance", "balance_band", "account_age_days", "account_age_months", "is_retail_product",
    "is_commercial_product", "is_open", "account_is_closed", "is_frozen",
    # customer
    "crm_reference", "date_of_birth", "onboard_date", "segment_code", "customer_segment",
    "customer_status_code", "customer_status", "risk_score", "know_your_cust_flag", "customer_age",
    "age_bucket", "tenure_days", "tenure_months", "is_retail_customer", "is_commercial_customer",
    "customer_is_active", "customer_is_dormant", "customer_is_closed", "is_high_risk_retail",
    "is_high_risk_commercial", "is_new_retail_customer", "is_new_commercial_customer",
    # branch and division
    "branch_name", "region_code", "region_name", "division_code", "division_name",
)
ACCOUNT_SUMMARY = (
    *BRIDGE,
    "total_transaction_count", "settled_transaction_count", "pending_transaction_count",
    "returned_transaction_count", "total_debit_volume", "total_credit_volume", "net_flow",
    "avg_transaction_amount", "last_transaction_date", "first_transaction_date",
    "days_since_last_transaction", "total_fee_count", "total_fees_charged", "last_fee_date",
    "is_dormant_account",
)
CUSTOMER_360 = (
    # identity
    "customer_id", "crm_reference", "segment_code", "customer_segment", "customer_status_code",
    "customer_status", "date_of_birth", "onboard_date", "customer_age", "age_bucket", "tenure_days",
    "tenure_months", "risk_score", "know_your_cust_flag", "is_retail_customer", "is_commercial_customer",
    "is_active", "is_dormant", "is_closed", "is_high_risk_retail", "is_high_risk_commercial",
    "is_new_retail_customer", "is_new_commercial_customer",
    # accounts
    "total_account_count", "open_account_count", "closed_account_count", "frozen_account_count",
    "savings_account_count", "checking_account_count", "credit_card_count", "retail_loan_count",
    "commercial_checking_count", "commercial_loan_count", "total_balance", "avg_account_balance",
    "max_account_balance", "primary_division_code", "primary_division_name",
    # transactions
    "total_transaction_count", "settled_transaction_count", "returned_transaction_count",
    "total_transaction_volume", "avg_transaction_amount", "txn_count_30d", "txn_count_90d", "txn_count_365d",
    "txn_volume_30d", "txn_volume_90d", "txn_volume_365d", "last_transaction_date",
    "days_since_last_transaction", "preferred_channel_code", "digital_ratio_retail",
    "digital_ratio_commercial",
    # fees
    "total_fee_count", "total_fees_charged", "avg_fee_amount", "retail_fees_charged",
    "commercial_fees_charged", "is_behaviourally_dormant",
)
FEES_REVENUE = (
    "fee_month", "fee_year", "fee_month_num", "fee_type_code", "fee_type", "division_code", "division_name",
    "is_retail_fee", "is_commercial_fee", "fee_count", "total_fee_revenue", "avg_fee_amount",
    "min_fee_amount", "max_fee_amount", "standalone_fee_count", "transaction_linked_fee_count",
    "standalone_fee_revenue", "transaction_linked_fee_revenue",
)
CHANNEL_AGG = (
    "transaction_month", "transaction_year", "transaction_month_num", "transaction_channel_code", "channel",
    "division_code", "division_name", "is_digital_retail", "is_digital_commercial", "is_wire",
    "transaction_count", "total_volume", "avg_transaction_amount", "min_transaction_amount",
    "max_transaction_amount", "settled_count", "pending_count", "returned_count", "settled_pct",
    "pending_pct", "returned_pct",
)
DAILY_TRANSACTIONS = (
    "transaction_date", "transaction_month", "transaction_year", "transaction_month_num",
    "transaction_day_of_week", "division_code", "division_name", "total_transaction_count", "total_volume",
    "avg_transaction_amount", "settled_count", "pending_count", "returned_count", "settled_volume",
    "pending_volume", "returned_volume", "total_debit_volume", "total_credit_volume", "net_flow",
    "pos_count", "online_count", "mobile_count", "branch_count", "atm_count", "wire_count", "type_pos_count",
    "type_deposit_count", "type_transfer_count", "type_withdrawal_count", "type_fee_count",
    "type_interest_count", "type_atm_count", "digital_count_retail_def", "digital_count_commercial_def",
    "avg_settlement_lag_days", "max_settlement_lag_days",
)
_BRANCH_REVENUES = (
    "total_fee_count", "total_fee_revenue", "maintenance_fee_revenue", "overdraft_fee_revenue",
    "atm_fee_revenue", "pos_interchange_revenue", "trade_finance_revenue", "wire_fee_revenue",
    "loan_interest_revenue", "service_charge_revenue",
)
_BRANCH_FIGURES = (
    "accounts_opened", "active_account_count", "frozen_account_count", "total_balance",
    "avg_account_balance", "total_customer_count", "active_customer_count", "dormant_customer_count",
    "total_transaction_count", "total_transaction_volume", "avg_transaction_amount", "settled_count",
    "pending_count", "returned_count", "digital_count_retail_def", "digital_count_commercial_def",
    "digital_pct_retail_def", "digital_pct_commercial_def", *_BRANCH_REVENUES,
)
BRANCH_PERFORMANCE = (
    "report_month", "report_year", "report_month_num", "branch_code", "branch_name", "region_code",
    "region_name", "division_code", "division_name", *_BRANCH_FIGURES,
)
DIVISION_PERFORMANCE = (
    "report_month", "report_year", "report_month_num", "division_code", "division_name", *_BRANCH_FIGURES,
    "branch_count", "mom_transaction_volume_delta", "mom_fee_revenue_delta", "mom_active_account_delta",
    "mom_active_customer_delta", "mom_balance_delta", "mom_fee_revenue_pct_change",
)

# Columns by the attribute of FinanceModels that defines the table.
COLUMNS = {
    "stg_accounts": STG_ACCOUNTS,
    "stg_customers": STG_CUSTOMERS,
    "stg_fees": STG_FEES,
    "stg_transactions": STG_TRANSACTIONS,
    "int_accounts_decoded": ACCOUNTS_DECODED,
    "int_customers_decoded": CUSTOMERS_DECODED,
    "int_transactions_decoded": TRANSACTIONS_DECODED,
    "int_fees_decoded": FEES_DECODED,
    "int_acct_cust_bridge": BRIDGE,
    "fct_account_summary": ACCOUNT_SUMMARY,
    "fct_customer_360": CUSTOMER_360,
    "fct_fees_revenue": FEES_REVENUE,
    "fct_channel_agg": CHANNEL_AGG,
    "fct_daily_transactions": DAILY_TRANSACTIONS,
    "fct_branch_performance": BRANCH_PERFORMANCE,
    "fct_division_performance": DIVISION_PERFORMANCE,
}
