"""Metrics with one name and, where the business asks for it, two definitions.

Accounts, transactions and fees follow the division of their branch, customers
the division of their segment. `by` names the columns of the result; any
columns of the underlying table will do.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import expressions as X
from ledgerloom.operators.divisions import roll_up_branches


def _per_division(retail: Column, commercial: Column) -> Column:
    return X.by_division(F.col("division_code"), retail, commercial)


def metric_fee_revenue(
    fee_revenue: DataFrame, by: tuple[str, ...] = ("division_code", "fee_month")
) -> DataFrame:
    """Each division earns only from its own fee types."""
    own = _per_division(F.col("is_retail_fee"), F.col("is_commercial_fee"))
    return fee_revenue.groupBy(*by).agg(
        X.summed(F.col("total_fee_revenue"), own).cast(X.MONEY_TOTAL).alias("fee_revenue")
    )


def metric_digital_adoption_rate(
    channel_mix: DataFrame, by: tuple[str, ...] = ("division_code", "transaction_month")
) -> DataFrame:
    """Share of transactions on the channels the division calls digital."""
    digital = _per_division(F.col("is_digital_retail"), F.col("is_digital_commercial"))
    uses = F.col("transaction_count")
    return channel_mix.groupBy(*by).agg(
        X.percent(F.sum(F.when(digital, uses).otherwise(0)), F.sum(uses)).alias(
            "digital_adoption_rate"
        )
    )


def metric_transaction_volume(
    daily_transactions: DataFrame, by: tuple[str, ...] = ("division_code", "transaction_month")
) -> DataFrame:
    """Retail counts settled money, commercial settled and pending."""
    settled, pending = F.col("settled_volume"), F.col("pending_volume")
    volume = _per_division(settled, settled + pending)
    return daily_transactions.groupBy(*by).agg(
        F.sum(volume).cast(X.MONEY_TOTAL).alias("transaction_volume")
    )


def _customers_by_division(customers: DataFrame) -> DataFrame:
    return customers.withColumn("division_code", X.division_of_segment(F.col("segment_code")))


def metric_high_risk_customers(
    customers: DataFrame, by: tuple[str, ...] = ("division_code",)
) -> DataFrame:
    risky = _per_division(F.col("is_high_risk_retail"), F.col("is_high_risk_commercial"))
    return _customers_by_division(customers).groupBy(*by).agg(
        F.count_if(risky).alias("high_risk_customer_count")
    )


def metric_new_customers(
    customers: DataFrame, by: tuple[str, ...] = ("division_code",)
) -> DataFrame:
    new = _per_division(F.col("is_new_retail_customer"), F.col("is_new_commercial_customer"))
    return _customers_by_division(customers).groupBy(*by).agg(
        F.count_if(new).alias("new_customer_count")
    )


def metric_active_customers(
    customers: DataFrame, by: tuple[str, ...] = ("division_code",)
) -> DataFrame:
    return _customers_by_division(customers).groupBy(*by).agg(
        F.count_if("is_active").alias("active_customer_count")
    )


def metric_mom_fee_revenue_delta(
    division_performance: DataFrame, by: tuple[str, ...] = ("division_code", "report_month")
) -> DataFrame:
    """Change of fee revenue to the month before."""
    return division_performance.groupBy(*by).agg(
        F.sum("mom_fee_revenue_delta").cast(X.MONEY_TOTAL).alias("mom_fee_revenue_delta")
    )


def metric_kyc_alerts(customers: DataFrame) -> DataFrame:
    """Customers whose identity checks are incomplete."""
    return (
        _customers_by_division(customers)
        .where(F.col("know_your_cust_flag") == "0")
        .select(
            "customer_id",
            "crm_reference",
            "division_code",
            "segment_code",
            "customer_status",
            "risk_score",
            "onboard_date",
        )
    )


def metric_kyc_alert_count(
    customers: DataFrame, by: tuple[str, ...] = ("division_code",)
) -> DataFrame:
    """Number of customers whose identity checks are incomplete."""
    return _customers_by_division(customers).groupBy(*by).agg(
        F.count_if(F.col("know_your_cust_flag") == "0").alias("kyc_alert_count")
    )


def metric_region_rollup(
    branch_performance: DataFrame,
    by: tuple[str, ...] = ("report_month", "region_code", "region_name"),
) -> DataFrame:
    """Branch figures by region and report month."""
    return roll_up_branches(branch_performance, *by)


def metric_month_end_accounts(
    month_end_accounts: DataFrame, by: tuple[str, ...] = ("branch_code", "report_month")
) -> DataFrame:
    """Accounts open at the end of the month. They add up over places; without a month, the last one counts."""
    source = month_end_accounts
    if "report_month" not in by:
        last = source.agg(F.max("report_month").alias("report_month"))
        source = source.join(last, "report_month", "left_semi")
    return source.groupBy(*by).agg(
        F.sum("accounts_active_at_month_end").alias("accounts_active_at_month_end")
    )


# Metrics by name, with the table each one is computed from.
METRICS = {
    "fee_revenue": (metric_fee_revenue, "fct_fees_revenue"),
    "digital_adoption_rate": (metric_digital_adoption_rate, "fct_channel_agg"),
    "transaction_volume": (metric_transaction_volume, "fct_daily_transactions"),
    "high_risk_customer_count": (metric_high_risk_customers, "int_customers_decoded"),
    "new_customer_count": (metric_new_customers, "int_customers_decoded"),
    "active_customer_count": (metric_active_customers, "int_customers_decoded"),
    "kyc_alert_count": (metric_kyc_alert_count, "int_customers_decoded"),
    "accounts_active_at_month_end": (metric_month_end_accounts, "month_end_accounts"),
    "mom_fee_revenue_delta": (metric_mom_fee_revenue_delta, "fct_division_performance"),
}
# What is asked for by name as well, but is no single number.
LISTS = {
    "kyc_alerts": (metric_kyc_alerts, "int_customers_decoded"),
    "region_rollup": (metric_region_rollup, "fct_branch_performance"),
}
