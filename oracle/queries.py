"""One statement per registered query."""

from __future__ import annotations

from oracle import codes
from oracle.relations import WINDOWS, listed, money, percent, query, rollup

_DAY = "transaction_date, division_code"
_RELATION_OF = {
    "int_finance__accounts_decoded": "accounts",
    "int_finance__customers_decoded": "customers",
    "int_finance__transactions_decoded": "transactions",
    "int_finance__fees_decoded": "fees",
    "int_finance__acct_cust_bridge": "bridge",
    "fct_account_summary": "account_summary",
    "fct_customer_360": "customer_360",
}


def _union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


# -- data checks: the declared list, restated here --------------------------

_UNIQUE = [
    ("a_m", "a_id"), ("c_m", "c_id"), ("c_m", "c_extrn_ref"), ("f_l", "f_id"), ("t_l", "t_id"),
    ("divisions", "division_code"), ("divisions", "division_name"),
    ("branches", "branch_code"), ("branches", "branch_name"),
    ("int_finance__accounts_decoded", "account_id"),
    ("int_finance__customers_decoded", "customer_id"),
    ("int_finance__transactions_decoded", "transaction_id"),
    ("int_finance__fees_decoded", "fee_id"),
    ("int_finance__acct_cust_bridge", "account_id"),
    ("fct_account_summary", "account_id"), ("fct_customer_360", "customer_id"),
]
_PRESENT = [
    *[("a_m", c) for c in ("a_id", "c_id", "a_typ", "a_opn_dt", "a_st", "a_bal", "br_cd")],
    *[("c_m", c) for c in (
        "c_id", "c_extrn_ref", "c_dob", "c_onb_dt", "c_seg", "c_st_cd", "c_rsk_sc", "c_kyc_flg")],
    *[("f_l", c) for c in ("f_id", "a_id", "f_typ", "f_amt", "f_dt")],
    *[("t_l", c) for c in (
        "t_id", "a_id", "t_dt", "t_post_dt", "t_amt", "t_dr_cr", "t_typ", "t_ch", "t_st")],
    ("divisions", "division_code"), ("divisions", "division_name"),
    *[("branches", c) for c in ("branch_code", "branch_name", "region_code", "division_code")],
    *_UNIQUE[9:],
]
_LISTED = [
    ("a_m", "a_typ", codes.ACCOUNT_TYPES), ("a_m", "a_st", codes.ACCOUNT_STATUSES),
    ("c_m", "c_seg", codes.SEGMENTS), ("c_m", "c_st_cd", codes.CUSTOMER_STATUSES),
    ("c_m", "c_kyc_flg", (0, 1)), ("f_l", "f_typ", codes.FEE_TYPES),
    ("t_l", "t_dr_cr", ("D", "C")), ("t_l", "t_typ", codes.TRANSACTION_TYPES),
    ("t_l", "t_ch", codes.CHANNELS), ("t_l", "t_st", codes.SETTLEMENT_STATUSES),
    ("divisions", "division_code", ("RB", "CB")), ("branches", "region_code", codes.REGIONS),
    ("branches", "division_code", ("RB", "CB")),
]
_RELATED = [
    ("a_m", "c_id", "c_m", "c_id", "error"), ("a_m", "br_cd", "branches", "branch_code", "error"),
    ("f_l", "a_id", "a_m", "a_id", "error"), ("f_l", "t_id", "t_l", "t_id", "warn"),
    ("t_l", "a_id", "a_m", "a_id", "error"),
    ("branches", "division_code", "divisions", "division_code", "error"),
]


def _check(table: str, column: str, test: str, violations: str, severity: str = "error") -> str:
    return f"""SELECT table_name, column_name, test, severity, violations,
  CASE WHEN violations = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS outcome
FROM (SELECT '{table}' AS table_name, '{column}' AS column_name, '{test}' AS test,
  '{severity}' AS severity, ({violations}) AS violations)"""


def _relation(table: str) -> str:
    return _RELATION_OF.get(table, table)


_CHECKS = {
    "unique": [
        _check(t, c, "unique", f"SELECT count(*) FROM (SELECT {c} FROM {_relation(t)} "
               f"WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)")
        for t, c in _UNIQUE
    ],
    "not_null": [
        _check(t, c, "not_null", f"SELECT count(*) - count({c}) FROM {_relation(t)}")
        for t, c in _PRESENT
    ],
    "accepted_values": [
        _check(t, c, "accepted_values",
               f"SELECT count(*) FROM {_relation(t)} WHERE {c} NOT IN {listed(values)}")
        for t, c, values in _LISTED
    ],
    "relationships": [
        _check(t, c, "relationships",
               f"SELECT count(*) FROM {t} x WHERE {c} IS NOT NULL AND NOT EXISTS "
               f"(FROM {p} y WHERE y.{pc} = x.{c})", severity)
        for t, c, p, pc, severity in _RELATED
    ],
}

_RULES = [
    ("a_m", "close_date_only_when_closed", "a_cls_dt IS NOT NULL AND a_st IS DISTINCT FROM 'C'"),
    ("f_l", "fee_amount_positive", "f_amt <= 0"),
    ("t_l", "transaction_amount_positive", "t_amt <= 0"),
    ("t_l", "posted_on_or_after_transaction", "t_dt > t_post_dt"),
    ("c_m", "crm_reference_format",
     "NOT regexp_full_match(c_extrn_ref, 'CRM-[0-9]{6}-[0-9A-Z]{4}')"),
]
_GRAINS = [
    ("fct_fees_revenue", "fee_revenue", "fee_type_code, fee_month, division_code"),
    ("fct_channel_agg", "channel_mix", "transaction_channel_code, transaction_month, division_code"),
    ("fct_daily_transactions", "daily", "transaction_date, division_code"),
    ("fct_branch_performance", "branch_performance", "branch_code, report_month"),
    ("fct_division_performance", "division_performance", "division_code, report_month"),
]

# -- flags of several tables ------------------------------------------------

_MEMBERSHIP = [
    ("account", "account_id", "accounts", "is_retail_product", "is_commercial_product"),
    ("customer", "customer_id", "customers", "is_retail_customer", "CAST(NULL AS BOOLEAN)"),
    ("fee", "fee_id", "fees", "is_retail_fee", "is_commercial_fee"),
    ("transaction", "transaction_id", "transactions", "is_digital_retail", "is_digital_commercial"),
]
_STATE = [
    ("account", "account_id", "accounts", "is_open", "is_closed", "is_frozen"),
    ("customer", "customer_id", "customers", "is_active", "is_dormant", "is_closed"),
    ("transaction", "transaction_id", "transactions", "is_settled", "is_pending", "is_returned"),
]


def _flags(rows) -> str:
    return _union(
        f"SELECT '{entity}' AS entity, {key} AS entity_id, "
        + ", ".join(f"{flag} AS flag_{i}" for i, flag in enumerate(flags, 1))
        + f" FROM {relation}"
        for entity, key, relation, *flags in rows
    )


def _pick(relation: str, *columns: str) -> str:
    return f"SELECT {', '.join(columns)} FROM {relation}"


_DIVISION = "CASE WHEN segment_code IN ('RTL', 'PRM') THEN 'RB' WHEN segment_code = 'COM' THEN 'CB' END"


def _customer_metric(condition: str, name: str) -> str:
    return f"""SELECT division_code, count(*) FILTER (WHERE {condition}) AS {name}
FROM (SELECT *, {_DIVISION} AS division_code FROM customers) GROUP BY division_code"""


_STATEMENTS = {
    "seed_branches": _pick("branches", "*"),
    "seed_divisions": _pick("divisions", "*"),
    "stg_accounts": _pick("stg_accounts", "*"),
    "stg_customers": _pick("stg_customers", "*"),
    "stg_fees": _pick("stg_fees", "*"),
    "stg_transactions": _pick("stg_transactions", "*"),
    "int_accounts_decoded": _pick("accounts", "*"),
    "int_customers_decoded": _pick("customers", "*"),
    "int_transactions_decoded": _pick("transactions", "*"),
    "int_fees_decoded": _pick("fees", "*"),
    "int_acct_cust_bridge": _pick("bridge", "*"),
    "fct_account_summary": _pick("account_summary", "*"),
    "fct_customer_360": _pick("customer_360", "*"),
    "fct_fees_revenue": _pick("fee_revenue", "*"),
    "fct_channel_agg": _pick("channel_mix", "*"),
    "fct_daily_transactions": _pick("daily", "*"),
    "fct_branch_performance": _pick("branch_performance", "*"),
    "fct_division_performance": _pick("division_performance", "*"),
    "src_csv_roundtrip": _pick("t_l", "*"),
    "src_csv_quarantine": """
SELECT f_id, CAST(a_id AS VARCHAR) AS a_id, CASE WHEN a_id % 7 <> 0 THEN f_amt END AS f_amt,
  CASE WHEN a_id % 14 = 0 THEN 'f_amt cannot be decimal(18,2): ' || CAST(f_amt AS VARCHAR) || '5'
    WHEN a_id % 7 = 0 THEN 'f_amt cannot be decimal(18,2): n/a' END AS reason
FROM f_l""",
    "src_table_load": "SELECT * REPLACE (CAST(a_id AS VARCHAR) AS a_id) FROM t_l",
    "sink_table_roundtrip": _pick("accounts", "*"),
    "join_txn_bridge": _pick(
        "placed_transactions", "transaction_id", "customer_id", "branch_code", "division_code",
        "transaction_date", "transaction_amount", "signed_amount", "transaction_channel_code",
        "is_settled", "is_returned", "is_digital_retail", "is_digital_commercial"),
    "join_fee_bridge": _pick(
        "placed_fees", "fee_id", "customer_id", "division_code", "fee_amount", "is_retail_fee",
        "is_commercial_fee"),
    "join_left_miss_flag": _pick("fees", "fee_id", "transaction_id", "is_standalone_fee"),
    "spine_branch_month": _pick("spine", "*"),
    "pred_in_flags": _flags(_MEMBERSHIP),
    "pred_status_flags": _flags(_STATE),
    "pred_threshold_flags": _pick(
        "customers", "customer_id", "is_new_retail_customer", "is_new_commercial_customer",
        "is_high_risk_retail", "is_high_risk_commercial"),
    "agg_account_txn_stats": _pick("account_txn_stats", "*"),
    "agg_account_fee_stats": _pick("account_fee_stats", "*"),
    "agg_customer_account_stats": _pick("customer_account_stats", "*"),
    "agg_customer_txn_stats": _pick("customer_txn_stats", "*"),
    "agg_customer_fee_stats": _pick("customer_fee_stats", "*"),
    "agg_branch_account_metrics": _pick("branch_accounts", "*"),
    "agg_branch_txn_metrics": _pick("branch_transactions", "*"),
    "agg_branch_fee_metrics": _pick("branch_fees", "*"),
    "agg_division_rollup": _pick("division_rollup", "*"),
    "agg_conditional_count": _pick("daily", _DAY, "settled_count", "pending_count", "returned_count"),
    "agg_conditional_sum": _pick(
        "daily", _DAY, "settled_volume", "pending_volume", "returned_volume",
        "total_debit_volume", "total_credit_volume"),
    "agg_recency_windows": (
        f"SELECT customer_id, {WINDOWS} FROM placed_transactions GROUP BY customer_id"),
    "agg_pivot_fee_types": _pick(
        "branch_fees", "branch_code", "report_month", *codes.FEE_TYPE_REVENUES.values()),
    "agg_pivot_channels": _pick("daily", _DAY, *codes.CHANNEL_COUNTS.values()),
    "agg_pivot_types": _pick("daily", _DAY, *codes.TRANSACTION_TYPE_COUNTS.values()),
    "agg_pivot_account_types": _pick(
        "customer_account_stats", "customer_id", *codes.ACCOUNT_TYPE_COUNTS.values()),
    "agg_preferred_channel": _pick("preferred", "*"),
    "agg_distinct_customers": _pick(
        "branch_accounts", "branch_code", "report_month", "total_customer_count",
        "active_customer_count", "dormant_customer_count"),
    "agg_percentages": _pick(
        "channel_mix", "transaction_month", "transaction_channel_code", "division_code",
        "settled_pct", "pending_pct", "returned_pct"),
    "distinct_months": _pick("months", "*"),
    "distinct_branches": _pick("places", "*"),
    "win_mom_deltas": _pick(
        "division_performance", "report_month", "division_code", "mom_transaction_volume_delta",
        "mom_fee_revenue_delta", "mom_active_account_delta", "mom_active_customer_delta",
        "mom_balance_delta"),
    "win_mom_pct_change": _pick(
        "division_performance", "report_month", "division_code", "total_fee_revenue",
        "mom_fee_revenue_pct_change"),
    "decode_account_type": _pick("accounts", "account_id", "account_type_code", "account_type"),
    "decode_account_status": _pick("accounts", "account_id", "account_status_code", "account_status"),
    "decode_segment": _pick("customers", "customer_id", "segment_code", "customer_segment"),
    "decode_customer_status": _pick(
        "customers", "customer_id", "customer_status_code", "customer_status"),
    "decode_fee_type": _pick("fees", "fee_id", "fee_type_code", "fee_type"),
    "decode_transaction_type": _pick(
        "transactions", "transaction_id", "transaction_type_code", "transaction_type"),
    "decode_channel": _pick("transactions", "transaction_id", "transaction_channel_code", "channel"),
    "decode_settlement": _pick(
        "transactions", "transaction_id", "settlement_status", "transaction_status"),
    "decode_region": _pick("bridge", "account_id", "region_code", "region_name"),
    "expr_balance_band": _pick("accounts", "account_id", "balance", "balance_band"),
    "expr_age_bucket": _pick("customers", "customer_id", "customer_age", "age_bucket"),
    "expr_signed_amount": _pick(
        "transactions", "transaction_id", "transaction_indicator", "transaction_amount",
        "signed_amount"),
    "expr_account_age": _pick("accounts", "account_id", "account_age_days", "account_age_months"),
    "expr_customer_age_tenure": _pick(
        "customers", "customer_id", "customer_age", "tenure_days", "tenure_months"),
    "expr_settlement_lag": _pick("transactions", "transaction_id", "settlement_lag_days"),
    "expr_date_parts": _pick(
        "transactions", "transaction_id", "transaction_month", "transaction_year",
        "transaction_month_num", "transaction_day_of_week"),
    "expr_dormancy_flag": _pick(
        "account_summary", "account_id", "days_since_last_transaction", "is_dormant_account"),
    "dq_unique": _union(_CHECKS["unique"]),
    "dq_not_null": _union(_CHECKS["not_null"]),
    "dq_accepted_values": _union(_CHECKS["accepted_values"]),
    "dq_relationships": _union(_CHECKS["relationships"]),
    "dq_report": _union(part for parts in _CHECKS.values() for part in parts),
    "dq_row_rules": _union(
        f"SELECT '{t}' AS table_name, '{rule}' AS rule, count(*) FILTER (WHERE {broken}) AS violations FROM {t}"
        for t, rule, broken in _RULES),
    "dq_grain_unique": _union(
        f"SELECT '{name}' AS table_name, '{grain}' AS grain, CAST(sum(n) AS BIGINT) AS row_count, "
        f"count(*) FILTER (WHERE n > 1) AS repeated_keys "
        f"FROM (SELECT count(*) AS n FROM {relation} GROUP BY {grain})"
        for name, relation, grain in _GRAINS),
    "metric_fee_revenue": f"""
SELECT division_code, fee_month,
  {money(f"coalesce(sum(fee_amount) FILTER (WHERE fee_type_code IN {listed(codes.RETAIL_FEES)} AND division_code = 'RB' OR fee_type_code IN {listed(codes.COMMERCIAL_FEES)} AND division_code = 'CB'), 0)")} AS fee_revenue
FROM placed_fees GROUP BY ALL""",
    "metric_digital_adoption_rate": f"""
SELECT division_code, transaction_month,
  {percent("count(*) FILTER (WHERE transaction_channel_code IN ('MOB', 'ONL') OR division_code = 'CB' AND transaction_channel_code = 'WIRE')", 'count(*)')} AS digital_adoption_rate
FROM placed_transactions GROUP BY ALL""",
    "metric_transaction_volume": f"""
SELECT division_code, transaction_month,
  {money("coalesce(sum(transaction_amount) FILTER (WHERE is_settled OR is_pending AND division_code = 'CB'), 0)")} AS transaction_volume
FROM placed_transactions GROUP BY ALL""",
    "metric_high_risk_customers": _customer_metric(
        "risk_score >= CASE division_code WHEN 'RB' THEN 40 WHEN 'CB' THEN 30 END",
        "high_risk_customer_count"),
    "metric_new_customers": _customer_metric(
        "tenure_days <= CASE division_code WHEN 'RB' THEN 90 WHEN 'CB' THEN 180 END",
        "new_customer_count"),
    "metric_mom_fee_revenue_delta": _pick(
        "division_performance", "division_code", "report_month", "mom_fee_revenue_delta"),
    "metric_active_customers": _customer_metric(
        "customer_status_code = 'AC'", "active_customer_count"),
    "metric_kyc_alerts": f"""
SELECT customer_id, crm_reference, {_DIVISION} AS division_code, segment_code, customer_status,
  risk_score, onboard_date
FROM customers WHERE know_your_cust_flag = '0'""",
    "metric_region_rollup": rollup("report_month, region_code, region_name"),
    "agg_distinct_customers_rollup": _union(
        f"""SELECT '{grain}' AS grain, {place} AS place, {period} AS period_start,
  count(DISTINCT customer_id) AS total_customer_count,
  count(DISTINCT customer_id) FILTER (WHERE customer_is_active) AS active_customer_count,
  count(DISTINCT customer_id) FILTER (WHERE customer_is_dormant) AS dormant_customer_count
FROM bridge GROUP BY ALL"""
        for grain, place, period in (
            ("branch and month", "branch_code", "CAST(date_trunc('month', open_date) AS DATE)"),
            ("region and quarter", "region_code", "CAST(date_trunc('quarter', open_date) AS DATE)"),
            ("division", "division_code", "CAST(NULL AS DATE)"),
        )
    ),
    "metric_quarters": f"""
WITH fees_by AS (
  SELECT division_code, CAST(date_trunc('quarter', fee_month) AS DATE) AS period_start,
    {money("coalesce(sum(fee_amount) FILTER (WHERE CASE division_code WHEN 'RB' THEN is_retail_fee ELSE is_commercial_fee END), 0)")} AS fee_revenue
  FROM placed_fees GROUP BY ALL
), uses_by AS (
  SELECT division_code, CAST(date_trunc('quarter', transaction_month) AS DATE) AS period_start,
    {percent("count(*) FILTER (WHERE CASE division_code WHEN 'RB' THEN is_digital_retail ELSE is_digital_commercial END)", "count(*)")} AS digital_adoption_rate
  FROM placed_transactions GROUP BY ALL
), ends AS (
  SELECT CAST(date_trunc('quarter', report_month) AS DATE) AS period_start, last_day(max(report_month)) AS closing
  FROM spine GROUP BY ALL
), stock_by AS (
  SELECT p.division_code, e.period_start, count(b.account_id) AS accounts_active_at_month_end
  FROM (SELECT DISTINCT branch_code, division_code FROM places) p, ends e
  LEFT JOIN bridge b ON b.branch_code = p.branch_code AND b.open_date <= e.closing
    AND (b.close_date IS NULL OR b.close_date > e.closing)
  GROUP BY ALL
), opened_by AS (
  SELECT division_code, CAST(date_trunc('quarter', report_month) AS DATE) AS period_start,
    CAST(sum(accounts_opened) AS BIGINT) AS accounts_opened
  FROM branch_performance GROUP BY ALL
)
SELECT * FROM fees_by FULL JOIN uses_by USING (division_code, period_start)
FULL JOIN stock_by USING (division_code, period_start) FULL JOIN opened_by USING (division_code, period_start)""",
    "metric_active_accounts_asof": f"""
SELECT s.branch_code, s.report_month, count(b.account_id) AS accounts_active_at_month_end
FROM spine s LEFT JOIN bridge b ON b.branch_code = s.branch_code
  AND b.open_date <= last_day(s.report_month)
  AND (b.close_date IS NULL OR b.close_date > last_day(s.report_month))
GROUP BY s.branch_code, s.report_month""",
}


def oracle_sql() -> dict[str, str]:
    return {name: query(sql) for name, sql in _STATEMENTS.items()}
