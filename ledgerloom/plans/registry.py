"""Every query by name, over the bank ledgers derived from a folder of test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import codes
from ledgerloom.operators import (
    accounts,
    branches,
    customer_sets,
    customers,
    divisions,
    metrics,
    quality,
)
from ledgerloom.operators.bridge import attach_account, branch_places
from ledgerloom.operators.decode import flag_standalone_fees
from ledgerloom.plans.models import PUBLISHED, WORKING, FinanceModels
from ledgerloom.sources.quarantine import read_separated
from ledgerloom.sources.schemas import MONEY
from ledgerloom.sources.scratch import scratch_folder
from ledgerloom.sources.tables import (
    TableSink,
    load,
    load_reference_lists,
    read_csv,
    store_reference_lists,
)
from ledgerloom.sources.testdata import AS_OF, bank_tables

# What the catalog schemas of round trips are called; each lasts as long as its call.
ROUND_TRIPS = "ledgerloom_round_trips"
Query = Callable[[SparkSession, str], DataFrame]
Plan = Callable[[FinanceModels], DataFrame]


def finance_models(spark: SparkSession, folder: str) -> FinanceModels:
    return FinanceModels(bank_tables(spark, folder), AS_OF)


def _columns(table: str, *names: str) -> Plan:
    return lambda m: getattr(m, table).select(*names)


def _checks(test: str) -> Plan:
    chosen = [check for check in quality.CHECKS if check.test == test]
    return lambda m: quality.report(m.checked_tables(), chosen)


def _flags(m: FinanceModels, sources: dict[str, tuple[str, str, tuple[str, ...]]]) -> DataFrame:
    """Flags of several tables under each other, by entity and its key."""
    width = max(len(names) for _, _, names in sources.values())
    result = None
    for entity, (table, key, names) in sources.items():
        flags = [F.col(n) for n in names] + [F.lit(None).cast("boolean")] * (width - len(names))
        part = getattr(m, table).select(
            F.lit(entity).alias("entity"),
            F.col(key).alias("entity_id"),
            *[flag.alias(f"flag_{i + 1}") for i, flag in enumerate(flags)],
        )
        result = part if result is None else result.unionByName(part)
    return result


def _membership_flags(m: FinanceModels) -> DataFrame:
    return _flags(
        m,
        {
            "account": (
                "int_accounts_decoded",
                "account_id",
                ("is_retail_product", "is_commercial_product"),
            ),
            "customer": ("int_customers_decoded", "customer_id", ("is_retail_customer",)),
            "fee": ("int_fees_decoded", "fee_id", ("is_retail_fee", "is_commercial_fee")),
            "transaction": (
                "int_transactions_decoded",
                "transaction_id",
                ("is_digital_retail", "is_digital_commercial"),
            ),
        },
    )


def _status_flags(m: FinanceModels) -> DataFrame:
    return _flags(
        m,
        {
            "account": ("int_accounts_decoded", "account_id", ("is_open", "is_closed", "is_frozen")),
            "customer": (
                "int_customers_decoded",
                "customer_id",
                ("is_active", "is_dormant", "is_closed"),
            ),
            "transaction": (
                "int_transactions_decoded",
                "transaction_id",
                ("is_settled", "is_pending", "is_returned"),
            ),
        },
    )


def _standalone_flags(m: FinanceModels) -> DataFrame:
    return flag_standalone_fees(m.stg_fees, m.stg_transactions).select(
        "fee_id", "transaction_id", "is_standalone_fee"
    )


def _owned_transactions(m: FinanceModels) -> DataFrame:
    return attach_account(m.int_transactions_decoded, m.int_acct_cust_bridge)


def _distinct_customers(m: FinanceModels) -> DataFrame:
    """Distinct customers at three grains, all united from the sets of branches and opening months."""
    month = F.col("report_month")
    quarter = F.trunc(month, "quarter").alias("period_start")
    grains = {
        "branch and month": ("branch_code", month.alias("period_start")),
        "region and quarter": ("region_code", quarter),
        "division": ("division_code", F.lit(None).cast("date").alias("period_start")),
    }
    parts = [
        customer_sets.distinct_customers(m.customer_sets, F.col(place).alias("place"), period)
        .select(F.lit(grain).alias("grain"), "*")
        for grain, (place, period) in grains.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _quarters(m: FinanceModels) -> DataFrame:
    """Measures that add up in three ways, by division and quarter."""
    names = ("fee_revenue", "digital_adoption_rate", "accounts_active_at_month_end", "accounts_opened")
    parts = [m.measure(name, period="quarter") for name in names]
    return reduce(lambda a, b: a.join(b, ["division_code", "period_start"], "full"), parts)


_DAY = ("transaction_date", "division_code")
_STATUS = ("settled", "pending", "returned")

PLANS: dict[str, Plan] = {
    # tables
    **{name: _columns(name, "*") for name in PUBLISHED if name not in WORKING},
    # joins
    "join_txn_bridge": lambda m: _owned_transactions(m).select(
        "transaction_id",
        "customer_id",
        "branch_code",
        "division_code",
        "transaction_date",
        "transaction_amount",
        "signed_amount",
        "transaction_channel_code",
        "is_settled",
        "is_returned",
        "is_digital_retail",
        "is_digital_commercial",
    ),
    "join_fee_bridge": lambda m: attach_account(m.int_fees_decoded, m.int_acct_cust_bridge).select(
        "fee_id",
        "customer_id",
        "division_code",
        "fee_amount",
        "is_retail_fee",
        "is_commercial_fee",
    ),
    "join_left_miss_flag": _standalone_flags,
    "spine_branch_month": lambda m: branches.branch_months(
        m.int_transactions_decoded, m.int_acct_cust_bridge
    ),
    # predicates
    "pred_in_flags": _membership_flags,
    "pred_status_flags": _status_flags,
    "pred_threshold_flags": _columns(
        "int_customers_decoded",
        "customer_id",
        "is_new_retail_customer",
        "is_new_commercial_customer",
        "is_high_risk_retail",
        "is_high_risk_commercial",
    ),
    # aggregates
    "agg_account_txn_stats": lambda m: accounts.account_transaction_stats(
        m.int_transactions_decoded
    ),
    "agg_account_fee_stats": lambda m: accounts.account_fee_stats(m.int_fees_decoded),
    "agg_customer_account_stats": lambda m: customers.customer_account_stats(
        m.int_acct_cust_bridge
    ),
    "agg_customer_txn_stats": lambda m: customers.customer_transaction_stats(
        m.int_transactions_decoded, m.int_acct_cust_bridge, m.as_of
    ),
    "agg_customer_fee_stats": lambda m: customers.customer_fee_stats(
        m.int_fees_decoded, m.int_acct_cust_bridge
    ),
    "agg_branch_account_metrics": lambda m: branches.branch_account_metrics(
        m.int_acct_cust_bridge
    ),
    "agg_branch_txn_metrics": lambda m: branches.branch_transaction_metrics(
        m.daily_parts
    ),
    "agg_branch_fee_metrics": lambda m: branches.branch_fee_metrics(m.placed_fees),
    "agg_division_rollup": lambda m: divisions.division_rollup(m.fct_branch_performance),
    "agg_conditional_count": _columns(
        "fct_daily_transactions", *_DAY, *[f"{s}_count" for s in _STATUS]
    ),
    "agg_conditional_sum": _columns(
        "fct_daily_transactions",
        *_DAY,
        *[f"{s}_volume" for s in _STATUS],
        "total_debit_volume",
        "total_credit_volume",
    ),
    "agg_recency_windows": lambda m: customers.recency_windows(
        _owned_transactions(m), m.as_of
    ),
    "agg_pivot_fee_types": lambda m: branches.branch_fee_metrics(m.placed_fees).select(
        "branch_code", "report_month", *codes.FEE_TYPE_REVENUES.values()
    ),
    "agg_pivot_channels": _columns(
        "fct_daily_transactions", *_DAY, *codes.CHANNEL_COUNTS.values()
    ),
    "agg_pivot_types": _columns(
        "fct_daily_transactions", *_DAY, *codes.TRANSACTION_TYPE_COUNTS.values()
    ),
    "agg_pivot_account_types": lambda m: customers.customer_account_stats(
        m.int_acct_cust_bridge
    ).select("customer_id", *codes.ACCOUNT_TYPE_COUNTS.values()),
    "agg_preferred_channel": lambda m: customers.preferred_channels(_owned_transactions(m)),
    "agg_distinct_customers": lambda m: branches.branch_account_metrics(
        m.int_acct_cust_bridge
    ).select(
        "branch_code",
        "report_month",
        "total_customer_count",
        "active_customer_count",
        "dormant_customer_count",
    ),
    "agg_percentages": _columns(
        "fct_channel_agg",
        "transaction_month",
        "transaction_channel_code",
        "division_code",
        *[f"{s}_pct" for s in _STATUS],
    ),
    "distinct_months": lambda m: branches.report_months(m.int_transactions_decoded),
    "distinct_branches": lambda m: branch_places(m.int_acct_cust_bridge),
    # windows
    "win_mom_deltas": _columns(
        "fct_division_performance", "report_month", "division_code", *divisions.MONTHLY_CHANGES
    ),
    "win_mom_pct_change": _columns(
        "fct_division_performance",
        "report_month",
        "division_code",
        "total_fee_revenue",
        "mom_fee_revenue_pct_change",
    ),
    # labels
    "decode_account_type": _columns(
        "int_accounts_decoded", "account_id", "account_type_code", "account_type"
    ),
    "decode_account_status": _columns(
        "int_accounts_decoded", "account_id", "account_status_code", "account_status"
    ),
    "decode_segment": _columns(
        "int_customers_decoded", "customer_id", "segment_code", "customer_segment"
    ),
    "decode_customer_status": _columns(
        "int_customers_decoded", "customer_id", "customer_status_code", "customer_status"
    ),
    "decode_fee_type": _columns("int_fees_decoded", "fee_id", "fee_type_code", "fee_type"),
    "decode_transaction_type": _columns(
        "int_transactions_decoded", "transaction_id", "transaction_type_code", "transaction_type"
    ),
    "decode_channel": _columns(
        "int_transactions_decoded", "transaction_id", "transaction_channel_code", "channel"
    ),
    "decode_settlement": _columns(
        "int_transactions_decoded", "transaction_id", "settlement_status", "transaction_status"
    ),
    "decode_region": _columns("int_acct_cust_bridge", "account_id", "region_code", "region_name"),
    # row expressions
    "expr_balance_band": _columns("int_accounts_decoded", "account_id", "balance", "balance_band"),
    "expr_age_bucket": _columns(
        "int_customers_decoded", "customer_id", "customer_age", "age_bucket"
    ),
    "expr_signed_amount": _columns(
        "int_transactions_decoded",
        "transaction_id",
        "transaction_indicator",
        "transaction_amount",
        "signed_amount",
    ),
    "expr_account_age": _columns(
        "int_accounts_decoded", "account_id", "account_age_days", "account_age_months"
    ),
    "expr_customer_age_tenure": _columns(
        "int_customers_decoded", "customer_id", "customer_age", "tenure_days", "tenure_months"
    ),
    "expr_settlement_lag": _columns(
        "int_transactions_decoded", "transaction_id", "settlement_lag_days"
    ),
    "expr_date_parts": _columns(
        "int_transactions_decoded",
        "transaction_id",
        "transaction_month",
        "transaction_year",
        "transaction_month_num",
        "transaction_day_of_week",
    ),
    "expr_dormancy_flag": _columns(
        "fct_account_summary", "account_id", "days_since_last_transaction", "is_dormant_account"
    ),
    # data checks
    "dq_unique": _checks("unique"),
    "dq_not_null": _checks("not_null"),
    "dq_accepted_values": _checks("accepted_values"),
    "dq_relationships": _checks("relationships"),
    "dq_report": lambda m: quality.report(m.checked_tables()),
    "dq_row_rules": lambda m: quality.row_rule_report(m.checked_tables()),
    "dq_grain_unique": lambda m: quality.grain_report(m.checked_tables()),
    # metrics
    "metric_fee_revenue": lambda m: metrics.metric_fee_revenue(m.fct_fees_revenue),
    "metric_digital_adoption_rate": lambda m: metrics.metric_digital_adoption_rate(
        m.fct_channel_agg
    ),
    "metric_high_risk_customers": lambda m: metrics.metric_high_risk_customers(
        m.int_customers_decoded
    ),
    "metric_transaction_volume": lambda m: metrics.metric_transaction_volume(
        m.fct_daily_transactions
    ),
    "metric_new_customers": lambda m: metrics.metric_new_customers(m.int_customers_decoded),
    "metric_mom_fee_revenue_delta": lambda m: metrics.metric_mom_fee_revenue_delta(
        m.fct_division_performance
    ),
    "metric_active_customers": lambda m: metrics.metric_active_customers(m.int_customers_decoded),
    "metric_kyc_alerts": lambda m: metrics.metric_kyc_alerts(m.int_customers_decoded),
    "metric_region_rollup": lambda m: metrics.metric_region_rollup(m.fct_branch_performance),
    "agg_distinct_customers_rollup": _distinct_customers,
    "metric_quarters": _quarters,
    "metric_active_accounts_asof": lambda m: branches.accounts_active_at_month_end(
        m.int_acct_cust_bridge, m.int_transactions_decoded
    ),
}


def _csv_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Fees written as CSV, the amounts of every seventh account too fine or no numbers, and what loading makes of them."""
    fees = bank_tables(spark, folder).fees
    text = F.col("f_amt").cast("string")
    line = F.col("a_id") % 14
    spoiled = F.when(line == 0, F.concat(text, F.lit("5"))).when(line == 7, F.lit("n/a")).otherwise(text)
    place = scratch_folder(spark)
    fees.withColumn("f_amt", spoiled).write.option("header", "true").csv(f"{place}/f_l.csv")
    good, rejected = read_separated(spark, place, "f_l")
    refused = rejected.select(
        F.get_json_object("record", "$.f_id").alias("f_id"),
        F.get_json_object("record", "$.a_id").alias("a_id"),
        F.lit(None).cast(MONEY).alias("f_amt"),
        "reason",
    )
    kept = good.select("f_id", "a_id", "f_amt", F.lit(None).cast("string").alias("reason"))
    return kept.unionByName(refused)


def _csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """The transaction ledger written as typed CSV and loaded again."""
    ledger = finance_models(spark, folder).raw.transactions
    path = f"{scratch_folder(spark)}/t_l.csv"
    ledger.write.option("header", "true").csv(path)
    return read_csv(spark, path, ledger.schema)


@contextmanager
def _own_schema(spark: SparkSession) -> Iterator[str]:
    """A catalog schema of this call alone. Its tables are forgotten afterwards; their files stay readable."""
    name = f"{ROUND_TRIPS}_{uuid.uuid4().hex}"
    spark.sql(f"CREATE SCHEMA {name}")
    try:
        yield name
    finally:
        for table in spark.catalog.listTables(name):
            if not table.isTemporary:
                spark.sql(f"DROP TABLE {name}.{table.name}")
        spark.sql(f"DROP SCHEMA {name}")


def _table_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """The decoded accounts stored as a table of its own and read back."""
    table = finance_models(spark, folder).int_accounts_decoded
    with _own_schema(spark) as schema:
        return TableSink(path=scratch_folder(spark), namespace=schema).publish("accounts", table)


def _table_load(spark: SparkSession, folder: str) -> DataFrame:
    """The transactions in a catalog table with amounts as doubles, loaded in their own types.

    Account ids arrive as whole numbers, transaction ids as text.
    """
    raw = bank_tables(spark, folder)
    ledgers = {"a_m": raw.accounts, "c_m": raw.customers, "f_l": raw.fees, "t_l": raw.transactions}
    with _own_schema(spark) as schema:
        sink = TableSink(path=scratch_folder(spark), namespace=schema)
        for name, ledger in ledgers.items():
            amounts = [f.name for f in ledger.schema if f.dataType == MONEY]
            sink.publish(name, ledger.withColumns({n: F.col(n).cast("double") for n in amounts}))
        return load(spark, schema, fmt="table").transactions


def _seeded(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The two reference lists written as seed files and loaded like any bank's own."""
    raw, place = bank_tables(spark, folder), scratch_folder(spark)
    store_reference_lists(raw.branches, raw.divisions, place)
    return load_reference_lists(spark, place)


def _planned(plan: Plan) -> Query:
    return lambda spark, folder: plan(finance_models(spark, folder))


def registered() -> dict[str, Query]:
    return {
        **{name: _planned(plan) for name, plan in PLANS.items()},
        "seed_branches": lambda spark, folder: _seeded(spark, folder)[0],
        "seed_divisions": lambda spark, folder: _seeded(spark, folder)[1],
        "src_csv_roundtrip": _csv_roundtrip,
        "src_csv_quarantine": _csv_quarantine,
        "src_table_load": _table_load,
        "sink_table_roundtrip": _table_roundtrip,
    }
