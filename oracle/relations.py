"""Named relations the check queries are put together from."""

from __future__ import annotations

import re

from oracle import codes

AS_OF = "DATE '2001-06-30'"


def listed(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def labelled(column: str, labels: dict[str, str]) -> str:
    pairs = ", ".join(f"('{code}', '{text}')" for code, text in labels.items())
    return f"(SELECT v.t FROM (VALUES {pairs}) v(k, t) WHERE v.k = {column})"


def at(position: str, values) -> str:
    """Value at a zero-based position."""
    return f"([{', '.join(repr(v) for v in values)}])[{position} + 1]"


def days(start: str, n: str) -> str:
    return f"CAST({start} + CAST({n} AS INT) AS DATE)"


def cents(amount: str) -> str:
    return f"CAST(round({amount} * 100) AS BIGINT)"


def money(expression: str) -> str:
    return f"CAST({expression} AS DECIMAL(28,2))"


def gap(earlier: str, later: str) -> str:
    return f"CAST(datediff('day', {earlier}, {later}) AS INT)"


def month(day: str) -> str:
    return f"CAST(date_trunc('month', {day}) AS DATE)"


def part(name: str, day: str) -> str:
    return f"CAST({name}({day}) AS INT)"


def mean(value: str, only: str = "") -> str:
    keep = f" FILTER (WHERE {only})" if only else ""
    return f"CAST(sum({value}){keep} AS DOUBLE) / nullif(count({value}){keep}, 0)"


def mean_amount(value: str, only: str = "") -> str:
    """Exact half-up mean of cents to a millionth of a dollar, in whole numbers."""
    keep = f" FILTER (WHERE {only})" if only else ""
    return rounded_mean(f"CAST(sum({value}){keep} * 100 AS HUGEINT)", f"count({value}){keep}", 6)


def rounded_mean(units: str, n: str, places: int) -> str:
    """Half-up units/n, carried four places further than the units."""
    digits = 22 if places == 6 else 26
    whole = f"sign({units}) * ((abs({units}) * 20000 + {n}) // nullif(2 * ({n}), 0))"
    tick = f"CAST({10 ** -places:.{places}f} AS DECIMAL({places + 1},{places}))"
    return f"CAST(CAST({whole} AS DECIMAL({38 - places - 1},0)) * {tick} AS DECIMAL({digits},{places}))"


def percent(n: str, d: str) -> str:
    """Exact half-up percentage to two places, in whole numbers."""
    return f"CAST((20000 * CAST({n} AS HUGEINT) + ({d})) // nullif(2 * ({d}), 0) AS DOUBLE) / 100"


def times(condition: str, name: str) -> str:
    return f"count(*) FILTER (WHERE {condition}) AS {name}"


def added(value: str, condition: str, name: str) -> str:
    return f"{money(f'coalesce(sum({value}) FILTER (WHERE {condition}), 0)')} AS {name}"


def each(lines) -> str:
    return ", ".join(lines)


_TXN_ID = f"concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, {cents('l_extendedprice')})"
_COMMERCIAL_HOME = "c_nationkey % 3 = 2"
_BRANCH = "'BR' || lpad(CAST({} + 1 AS VARCHAR), 3, '0')"

RELATIONS: dict[str, str] = {}

# -- inputs -----------------------------------------------------------------

RELATIONS["divisions"] = """
SELECT DISTINCT
  CASE WHEN n_nationkey % 3 = 2 THEN 'CB' ELSE 'RB' END AS division_code,
  CASE WHEN n_nationkey % 3 = 2 THEN 'Commercial Banking' ELSE 'Retail Banking' END AS division_name
FROM nation"""

RELATIONS["branches"] = f"""
SELECT {_BRANCH.format('n_nationkey')} AS branch_code, n_name AS branch_name,
  {at('n_regionkey', codes.REGIONS)} AS region_code,
  CASE WHEN n_nationkey % 3 = 2 THEN 'CB' ELSE 'RB' END AS division_code
FROM nation"""

RELATIONS["c_m"] = f"""
SELECT c_custkey AS c_id,
  'CRM-' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') || '-'
    || lpad(CAST((c_custkey * 7919) % 10000 AS VARCHAR), 4, '0') AS c_extrn_ref,
  {days("DATE '1940-01-01'", "(c_custkey * 37) % 22000")} AS c_dob,
  {days("DATE '1995-01-01'", "(c_custkey * 13) % 2500")} AS c_onb_dt,
  CASE c_mktsegment WHEN 'MACHINERY' THEN 'COM' WHEN 'AUTOMOBILE' THEN 'PRM' ELSE 'RTL' END AS c_seg,
  CASE c_custkey % 20 WHEN 0 THEN 'CL' WHEN 1 THEN 'DM' ELSE 'AC' END AS c_st_cd,
  CAST(1 + (c_custkey * 31) % 55 AS INT) AS c_rsk_sc,
  CASE WHEN c_custkey % 67 = 0 THEN 0 ELSE 1 END AS c_kyc_flg
FROM customer"""

RELATIONS["a_m"] = f"""
SELECT a_id, c_id, a_typ, a_opn_dt, a_cls_dt, a_st,
  CASE WHEN a_typ IN ('CC', 'LN', 'COM_LN') THEN CAST(-size AS DECIMAL(18,2)) ELSE size END AS a_bal, br_cd
FROM (
  SELECT o_orderkey AS a_id, o_custkey AS c_id,
    CASE WHEN {_COMMERCIAL_HOME} THEN {at('o_orderkey % 2', codes.COMMERCIAL_PRODUCTS)}
      ELSE {at('o_orderkey % 4', codes.RETAIL_PRODUCTS)} END AS a_typ,
    CAST(o_orderdate AS DATE) AS a_opn_dt,
    CASE o_orderstatus WHEN 'F' THEN {days('CAST(o_orderdate AS DATE)', '365')} END AS a_cls_dt,
    CASE o_orderstatus WHEN 'O' THEN 'O' WHEN 'F' THEN 'C' WHEN 'P' THEN 'F' END AS a_st,
    CAST(CAST({cents('o_totalprice')} % 6000000 AS DECIMAL(18,2)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS size,
    {_BRANCH.format('c_nationkey')} AS br_cd
  FROM orders JOIN customer ON c_custkey = o_custkey
  WHERE o_custkey % 50 <> 7)"""

RELATIONS["t_l"] = f"""
SELECT {_TXN_ID} AS t_id, l_orderkey AS a_id, CAST(l_shipdate AS DATE) AS t_dt,
  {days('CAST(l_shipdate AS DATE)', 'CAST(l_quantity AS BIGINT) % 4')} AS t_post_dt,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS t_amt,
  CASE l_linestatus WHEN 'O' THEN 'D' WHEN 'F' THEN 'C' END AS t_dr_cr,
  {at('(l_linenumber - 1)', codes.TRANSACTION_TYPES)} AS t_typ,
  {at('(l_partkey % 6)', codes.CHANNELS)} AS t_ch,
  CASE l_returnflag WHEN 'A' THEN 'S' WHEN 'N' THEN 'P' WHEN 'R' THEN 'R' END AS t_st
FROM lineitem"""

RELATIONS["f_l"] = f"""
SELECT 'F' || {_TXN_ID} AS f_id, l_orderkey AS a_id,
  CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber >= 5 THEN 'X' || {_TXN_ID} ELSE {_TXN_ID} END AS t_id,
  {at('(l_suppkey % 8)', codes.FEE_TYPES)} AS f_typ,
  CAST(CAST(CAST(l_quantity AS BIGINT) AS DECIMAL(18,2)) + CAST(5.07 AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS f_amt,
  CAST(l_shipdate AS DATE) AS f_dt
FROM lineitem WHERE l_partkey % 8 < 3"""

# -- renamed ----------------------------------------------------------------

# Arriving and published names, in the order of the ledgers. Marked ones become text.
RENAMED = {
    "stg_accounts": ("a_m", {
        "a_id": "account_id", "c_id": "customer_id", "a_typ": "account_type_code", "a_opn_dt": "open_date",
        "a_cls_dt": "close_date", "a_st": "account_status_code", "a_bal": "balance", "br_cd": "branch_code"}),
    "stg_customers": ("c_m", {
        "c_id": "customer_id", "c_extrn_ref": "crm_reference", "c_dob": "date_of_birth", "c_onb_dt": "onboard_date",
        "c_seg": "segment_code", "c_st_cd": "customer_status_code", "c_rsk_sc": "risk_score",
        "c_kyc_flg": "know_your_cust_flag"}),
    "stg_fees": ("f_l", {
        "f_id": "fee_id", "a_id": "account_id", "t_id": "transaction_id", "f_typ": "fee_type_code",
        "f_amt": "fee_amount", "f_dt": "fee_date"}),
    "stg_transactions": ("t_l", {
        "t_id": "transaction_id", "a_id": "account_id", "t_dt": "transaction_date", "t_post_dt": "posting_date",
        "t_amt": "transaction_amount", "t_dr_cr": "transaction_indicator", "t_typ": "transaction_type_code",
        "t_ch": "transaction_channel_code", "t_st": "settlement_status"}),
}
TEXT = {"a_id", "c_id", "f_id", "t_id", "c_kyc_flg"}
for _name, (_ledger, _names) in RENAMED.items():
    RELATIONS[_name] = "SELECT " + each(
        f"CAST({old} AS VARCHAR) AS {new}" if old in TEXT else f"{old} AS {new}" for old, new in _names.items()
    ) + f" FROM {_ledger}"

# -- decoded ----------------------------------------------------------------

_AGE_DAYS = gap("open_date", AS_OF)
RELATIONS["accounts"] = f"""
SELECT *,
  {labelled('account_type_code', codes.ACCOUNT_TYPES)} AS account_type,
  {labelled('account_status_code', codes.ACCOUNT_STATUSES)} AS account_status,
  account_type_code IN {listed(codes.RETAIL_PRODUCTS)} AS is_retail_product,
  account_type_code IN {listed(codes.COMMERCIAL_PRODUCTS)} AS is_commercial_product,
  account_status_code = 'O' AS is_open, account_status_code = 'C' AS is_closed,
  account_status_code = 'F' AS is_frozen,
  {_AGE_DAYS} AS account_age_days,
  CAST(floor({_AGE_DAYS} / 30.44) AS INT) AS account_age_months,
  CASE WHEN balance < 0 THEN 'Negative'
    WHEN balance <= 9999 THEN 'Low'
    WHEN balance >= 10000 AND balance <= 49999 THEN 'Mid'
    ELSE 'High' END AS balance_band
FROM stg_accounts"""

RELATIONS["customers"] = f"""
SELECT c.*,
  CASE WHEN customer_age < 31 THEN '18-30' WHEN customer_age < 46 THEN '31-45'
    WHEN customer_age < 61 THEN '46-60' ELSE '60+' END AS age_bucket,
  CAST(floor(tenure_days / 30.44) AS INT) AS tenure_months,
  tenure_days <= 90 AS is_new_retail_customer,
  tenure_days <= 180 AS is_new_commercial_customer
FROM (
  SELECT *,
    {labelled('segment_code', codes.SEGMENTS)} AS customer_segment,
    {labelled('customer_status_code', codes.CUSTOMER_STATUSES)} AS customer_status,
    segment_code IN ('RTL', 'PRM') AS is_retail_customer,
    segment_code = 'COM' AS is_commercial_customer,
    customer_status_code = 'AC' AS is_active, customer_status_code = 'DM' AS is_dormant,
    customer_status_code = 'CL' AS is_closed,
    CAST(floor({gap('date_of_birth', AS_OF)} / 365.25) AS INT) AS customer_age,
    {gap('onboard_date', AS_OF)} AS tenure_days,
    risk_score >= 40 AS is_high_risk_retail, risk_score >= 30 AS is_high_risk_commercial
  FROM stg_customers) c"""

RELATIONS["transactions"] = f"""
SELECT *,
  {labelled('transaction_type_code', codes.TRANSACTION_TYPES)} AS transaction_type,
  {labelled('transaction_channel_code', codes.CHANNELS)} AS channel,
  {labelled('settlement_status', codes.SETTLEMENT_STATUSES)} AS transaction_status,
  CAST(CASE WHEN transaction_indicator = 'D' THEN -1 WHEN transaction_indicator = 'C' THEN 1 END
    * transaction_amount AS DECIMAL(18,2)) AS signed_amount,
  settlement_status = 'S' AS is_settled, settlement_status = 'P' AS is_pending,
  settlement_status = 'R' AS is_returned,
  transaction_channel_code IN ('MOB', 'ONL') AS is_digital_retail,
  transaction_channel_code IN ('MOB', 'ONL', 'WIRE') AS is_digital_commercial,
  transaction_channel_code = 'WIRE' AS is_wire,
  {gap('transaction_date', 'posting_date')} AS settlement_lag_days,
  {month('transaction_date')} AS transaction_month,
  {part('year', 'transaction_date')} AS transaction_year,
  {part('month', 'transaction_date')} AS transaction_month_num,
  {part('dayofweek', 'transaction_date')} + 1 AS transaction_day_of_week
FROM stg_transactions"""

RELATIONS["fees"] = f"""
SELECT f.*,
  {labelled('fee_type_code', codes.FEE_TYPES)} AS fee_type,
  fee_type_code IN {listed(codes.RETAIL_FEES)} AS is_retail_fee,
  fee_type_code IN {listed(codes.COMMERCIAL_FEES)} AS is_commercial_fee,
  NOT EXISTS (FROM stg_transactions t WHERE t.transaction_id = f.transaction_id) AS is_standalone_fee,
  {month('fee_date')} AS fee_month,
  {part('year', 'fee_date')} AS fee_year, {part('month', 'fee_date')} AS fee_month_num
FROM stg_fees f"""

RELATIONS["bridge"] = f"""
SELECT a.* EXCLUDE (is_closed), a.is_closed AS account_is_closed,
  c.* EXCLUDE (customer_id, is_active, is_dormant, is_closed),
  c.is_active AS customer_is_active, c.is_dormant AS customer_is_dormant, c.is_closed AS customer_is_closed,
  branch_name, region_code, {labelled('region_code', codes.REGIONS)} AS region_name,
  division_code, division_name
FROM accounts a JOIN customers c USING (customer_id)
JOIN branches USING (branch_code) JOIN divisions USING (division_code)"""

RELATIONS["placed_transactions"] = """
SELECT t.*, b.customer_id, b.branch_code, b.division_code, b.division_name
FROM transactions t JOIN bridge b USING (account_id)"""

RELATIONS["placed_fees"] = """
SELECT f.*, b.customer_id, b.branch_code, b.division_code, b.division_name
FROM fees f JOIN bridge b USING (account_id)"""

# -- per account ------------------------------------------------------------

RELATIONS["account_txn_stats"] = f"""
SELECT account_id, count(*) AS total_transaction_count,
  {each(times(f"settlement_status = '{s}'", f"{n}_transaction_count") for s, n in (("S", "settled"), ("P", "pending"), ("R", "returned")))},
  {added('transaction_amount', "transaction_indicator = 'D'", 'total_debit_volume')},
  {added('transaction_amount', "transaction_indicator = 'C'", 'total_credit_volume')},
  {money('sum(signed_amount)')} AS net_flow,
  {mean_amount('transaction_amount')} AS avg_transaction_amount,
  max(transaction_date) AS last_transaction_date, min(transaction_date) AS first_transaction_date
FROM transactions GROUP BY account_id"""

RELATIONS["account_fee_stats"] = f"""
SELECT account_id, count(*) AS total_fee_count, {money('sum(fee_amount)')} AS total_fees_charged,
  max(fee_date) AS last_fee_date
FROM fees GROUP BY account_id"""

_ACCOUNT_ZERO = (
    [f"{n}_transaction_count" for n in ("total", "settled", "pending", "returned")]
    + ["total_debit_volume", "total_credit_volume", "net_flow", "total_fee_count", "total_fees_charged"]
)


def zeroed(names) -> str:
    return each(f"coalesce({n}, 0) AS {n}" for n in names)


RELATIONS["account_summary"] = f"""
SELECT * REPLACE ({zeroed(_ACCOUNT_ZERO)}),
  {gap('last_transaction_date', AS_OF)} AS days_since_last_transaction,
  last_transaction_date IS NULL OR {gap('last_transaction_date', AS_OF)} > 90 AS is_dormant_account
FROM bridge LEFT JOIN account_txn_stats USING (account_id) LEFT JOIN account_fee_stats USING (account_id)"""

# -- per customer -----------------------------------------------------------

RELATIONS["customer_account_stats"] = f"""
SELECT customer_id, count(*) AS total_account_count,
  {each(times(f"account_status_code = '{s}'", f"{n}_account_count") for s, n in (("O", "open"), ("C", "closed"), ("F", "frozen")))},
  {each(times(f"account_type_code = '{c}'", n) for c, n in codes.ACCOUNT_TYPE_COUNTS.items())},
  {added('balance', 'is_open', 'total_balance')},
  {mean_amount('balance', 'is_open')} AS avg_account_balance,
  max(balance) FILTER (WHERE is_open) AS max_account_balance,
  max(division_code) AS primary_division_code, max(division_name) AS primary_division_name
FROM bridge GROUP BY customer_id"""

RELATIONS["preferred"] = """
SELECT customer_id, transaction_channel_code AS preferred_channel_code
FROM placed_transactions WHERE transaction_channel_code IS NOT NULL
GROUP BY customer_id, transaction_channel_code
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, transaction_channel_code) = 1"""

WINDOWS = each(
    times(f"transaction_date >= {AS_OF} - {d}", f"txn_count_{d}d")
    + ", "
    + added("transaction_amount", f"transaction_date >= {AS_OF} - {d}", f"txn_volume_{d}d")
    for d in (30, 90, 365)
)
RELATIONS["customer_txn_stats"] = f"""
SELECT s.*, {gap('last_transaction_date', AS_OF)} AS days_since_last_transaction, p.preferred_channel_code
FROM (
  SELECT customer_id, count(*) AS total_transaction_count,
    {times("settlement_status = 'S'", 'settled_transaction_count')},
    {times("settlement_status = 'R'", 'returned_transaction_count')},
    {money('sum(transaction_amount)')} AS total_transaction_volume,
    {mean_amount('transaction_amount')} AS avg_transaction_amount,
    {WINDOWS},
    max(transaction_date) AS last_transaction_date,
    {percent('count(*) FILTER (WHERE is_digital_retail)', 'count(*)')} AS digital_ratio_retail,
    {percent('count(*) FILTER (WHERE is_digital_commercial)', 'count(*)')} AS digital_ratio_commercial
  FROM placed_transactions GROUP BY customer_id) s
LEFT JOIN preferred p USING (customer_id)"""

RELATIONS["customer_fee_stats"] = f"""
SELECT customer_id, count(*) AS total_fee_count, {money('sum(fee_amount)')} AS total_fees_charged,
  {mean_amount('fee_amount')} AS avg_fee_amount,
  {added('fee_amount', 'is_retail_fee', 'retail_fees_charged')},
  {added('fee_amount', 'is_commercial_fee', 'commercial_fees_charged')}
FROM placed_fees GROUP BY customer_id"""

_CUSTOMER_ZERO = (
    [f"{n}_account_count" for n in ("total", "open", "closed", "frozen")]
    + [*codes.ACCOUNT_TYPE_COUNTS.values(), "total_balance"]
    + [f"{n}_transaction_count" for n in ("total", "settled", "returned")]
    + ["total_transaction_volume"]
    + [f"txn_{k}_{d}d" for k in ("count", "volume") for d in (30, 90, 365)]
    + ["total_fee_count", "total_fees_charged", "retail_fees_charged", "commercial_fees_charged"]
)
RELATIONS["customer_360"] = f"""
SELECT * REPLACE ({zeroed(_CUSTOMER_ZERO)}),
  days_since_last_transaction IS NULL OR days_since_last_transaction > 90 AS is_behaviourally_dormant
FROM customers LEFT JOIN customer_account_stats USING (customer_id)
LEFT JOIN customer_txn_stats USING (customer_id) LEFT JOIN customer_fee_stats USING (customer_id)"""

# -- aggregated facts -------------------------------------------------------

RELATIONS["fee_revenue"] = f"""
SELECT fee_month, fee_year, fee_month_num, fee_type_code, fee_type, division_code, division_name,
  is_retail_fee, is_commercial_fee, count(*) AS fee_count,
  {money('sum(fee_amount)')} AS total_fee_revenue, {mean_amount('fee_amount')} AS avg_fee_amount,
  min(fee_amount) AS min_fee_amount, max(fee_amount) AS max_fee_amount,
  {times('is_standalone_fee', 'standalone_fee_count')},
  {times('NOT is_standalone_fee', 'transaction_linked_fee_count')},
  {added('fee_amount', 'is_standalone_fee', 'standalone_fee_revenue')},
  {added('fee_amount', 'NOT is_standalone_fee', 'transaction_linked_fee_revenue')}
FROM placed_fees GROUP BY ALL"""

_STATUSES = {"settled": "S", "pending": "P", "returned": "R"}
STATUS_COUNTS = each(times(f"settlement_status = '{s}'", f"{n}_count") for n, s in _STATUSES.items())

RELATIONS["channel_mix"] = f"""
SELECT transaction_month, transaction_year, transaction_month_num, transaction_channel_code, channel,
  division_code, division_name, is_digital_retail, is_digital_commercial, is_wire,
  count(*) AS transaction_count, {money('sum(transaction_amount)')} AS total_volume,
  {mean_amount('transaction_amount')} AS avg_transaction_amount,
  min(transaction_amount) AS min_transaction_amount, max(transaction_amount) AS max_transaction_amount,
  {STATUS_COUNTS},
  {each(f'''{percent(f"count(*) FILTER (WHERE settlement_status = '{s}')", 'count(*)')} AS {n}_pct''' for n, s in _STATUSES.items())}
FROM placed_transactions GROUP BY ALL"""

RELATIONS["daily"] = f"""
SELECT transaction_date, transaction_month, transaction_year, transaction_month_num,
  transaction_day_of_week, division_code, division_name,
  count(*) AS total_transaction_count, {money('sum(transaction_amount)')} AS total_volume,
  {mean_amount('transaction_amount')} AS avg_transaction_amount,
  {STATUS_COUNTS},
  {each(added('transaction_amount', f"settlement_status = '{s}'", f"{n}_volume") for n, s in _STATUSES.items())},
  {added('transaction_amount', 'signed_amount < 0', 'total_debit_volume')},
  {added('transaction_amount', 'signed_amount > 0', 'total_credit_volume')},
  {money('sum(signed_amount)')} AS net_flow,
  {each(times(f"transaction_channel_code = '{c}'", n) for c, n in codes.CHANNEL_COUNTS.items())},
  {each(times(f"transaction_type_code = '{c}'", n) for c, n in codes.TRANSACTION_TYPE_COUNTS.items())},
  {times("transaction_channel_code IN ('MOB', 'ONL')", 'digital_count_retail_def')},
  {times("transaction_channel_code IN ('MOB', 'ONL', 'WIRE')", 'digital_count_commercial_def')},
  {mean('settlement_lag_days')} AS avg_settlement_lag_days, max(settlement_lag_days) AS max_settlement_lag_days
FROM placed_transactions GROUP BY ALL"""

# -- per branch -------------------------------------------------------------

RELATIONS["months"] = f"""
SELECT DISTINCT transaction_month AS report_month, {part('year', 'transaction_month')} AS report_year,
  {part('month', 'transaction_month')} AS report_month_num
FROM transactions"""

RELATIONS["places"] = """
SELECT DISTINCT branch_code, branch_name, region_code, region_name, division_code, division_name FROM bridge"""

RELATIONS["spine"] = "SELECT * FROM months, places"

RELATIONS["branch_accounts"] = f"""
SELECT branch_code, {month('open_date')} AS report_month,
  count(open_date) AS accounts_opened, count(*) AS active_account_count,
  {times('is_frozen', 'frozen_account_count')},
  {added('balance', 'is_open', 'total_balance')},
  {mean_amount('balance', 'is_open')} AS avg_account_balance,
  count(DISTINCT customer_id) AS total_customer_count,
  count(DISTINCT customer_id) FILTER (WHERE customer_is_active) AS active_customer_count,
  count(DISTINCT customer_id) FILTER (WHERE customer_is_dormant) AS dormant_customer_count
FROM bridge GROUP BY ALL"""

RELATIONS["branch_transactions"] = f"""
SELECT branch_code, transaction_month AS report_month, count(*) AS total_transaction_count,
  {money('sum(transaction_amount)')} AS total_transaction_volume,
  {mean_amount('transaction_amount')} AS avg_transaction_amount,
  {STATUS_COUNTS},
  {times('is_digital_retail', 'digital_count_retail_def')},
  {times('is_digital_commercial', 'digital_count_commercial_def')},
  {percent('count(*) FILTER (WHERE is_digital_retail)', 'count(*)')} AS digital_pct_retail_def,
  {percent('count(*) FILTER (WHERE is_digital_commercial)', 'count(*)')} AS digital_pct_commercial_def
FROM placed_transactions GROUP BY ALL"""

RELATIONS["branch_fees"] = f"""
SELECT branch_code, fee_month AS report_month, count(*) AS total_fee_count,
  {money('sum(fee_amount)')} AS total_fee_revenue,
  {each(added('fee_amount', f"fee_type_code = '{c}'", n) for c, n in codes.FEE_TYPE_REVENUES.items())}
FROM placed_fees GROUP BY ALL"""

_OPENINGS = [
    "accounts_opened", "active_account_count", "frozen_account_count", "total_balance",
    "total_customer_count", "active_customer_count", "dormant_customer_count",
]
_MOVEMENTS = [
    "total_transaction_count", "total_transaction_volume", "settled_count", "pending_count",
    "returned_count", "digital_count_retail_def", "digital_count_commercial_def",
]
_REVENUES = ["total_fee_count", "total_fee_revenue", *codes.FEE_TYPE_REVENUES.values()]
_MONEY = {"total_balance", "total_transaction_volume", *_REVENUES[1:]}

RELATIONS["branch_performance"] = f"""
SELECT * REPLACE ({zeroed(_OPENINGS + _MOVEMENTS + ['digital_pct_retail_def', 'digital_pct_commercial_def'] + _REVENUES)})
FROM spine LEFT JOIN branch_accounts USING (branch_code, report_month)
LEFT JOIN branch_transactions USING (branch_code, report_month)
LEFT JOIN branch_fees USING (branch_code, report_month)"""


def rollup(keys: str) -> str:
    sums = each(
        f"CAST(sum({n}) AS {'DECIMAL(28,2)' if n in _MONEY else 'BIGINT'}) AS {n}"
        for n in _OPENINGS + _MOVEMENTS + _REVENUES
    )
    return f"""
SELECT {keys}, {sums},
  {each(f"{rounded_mean(f'CAST(sum({n}) * 1000000 AS HUGEINT)', f'count({n})', 10)} AS {n}"
        for n in ('avg_account_balance', 'avg_transaction_amount'))},
  {percent('sum(digital_count_retail_def)', 'sum(total_transaction_count)')} AS digital_pct_retail_def,
  {percent('sum(digital_count_commercial_def)', 'sum(total_transaction_count)')} AS digital_pct_commercial_def,
  count(DISTINCT branch_code) AS branch_count
FROM branch_performance GROUP BY ALL"""


RELATIONS["division_rollup"] = rollup(
    "report_month, report_year, report_month_num, division_code, division_name"
)

_DELTAS = {
    "transaction_volume": ("total_transaction_volume", "DECIMAL(28,2)"),
    "fee_revenue": ("total_fee_revenue", "DECIMAL(28,2)"),
    "active_account": ("active_account_count", "BIGINT"),
    "active_customer": ("active_customer_count", "BIGINT"),
    "balance": ("total_balance", "DECIMAL(28,2)"),
}
RELATIONS["division_performance"] = f"""
SELECT * EXCLUDE (v, p), CAST(sign(v - p) AS INT)
  * CAST((abs(v - p) * 20000 + p) // nullif(2 * p, 0) AS DOUBLE) / 100 AS mom_fee_revenue_pct_change
FROM (
  SELECT *,
    {each(f'CAST({c} - lag({c}) OVER w AS {t}) AS mom_{n}_delta' for n, (c, t) in _DELTAS.items())},
    CAST(total_fee_revenue * 100 AS HUGEINT) AS v,
    CAST(lag(total_fee_revenue) OVER w * 100 AS HUGEINT) AS p
  FROM division_rollup WINDOW w AS (PARTITION BY division_code ORDER BY report_month))"""


def query(sql: str) -> str:
    """The statement with every relation it reaches in front of it."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in set(re.findall(r"[a-z_0-9]+", text)) & RELATIONS.keys() - needed:
            needed.add(name)
            visit(RELATIONS[name])

    visit(sql)
    named = [f"{name} AS ({body.strip()})" for name, body in RELATIONS.items() if name in needed]
    if sql.strip().startswith("WITH "):
        named.append(sql.strip().removeprefix("WITH "))
        return "WITH " + ",\n".join(named)
    return ("WITH " + ",\n".join(named) + "\n" if named else "") + sql.strip()
