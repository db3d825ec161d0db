"""Account summary: the bridge with lifetime activity."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import expressions as X


def account_transaction_stats(transactions: DataFrame) -> DataFrame:
    cents, side, day = F.col("cents"), F.col("transaction_indicator"), F.col("transaction_date")
    return (
        transactions.withColumns(
            {"cents": X.cents("transaction_amount"), "signed_cents": X.cents("signed_amount")}
        )
        .groupBy("account_id")
        .agg(
            X.rows().alias("total_transaction_count"),
            F.count_if("is_settled").alias("settled_transaction_count"),
            F.count_if("is_pending").alias("pending_transaction_count"),
            F.count_if("is_returned").alias("returned_transaction_count"),
            X.total(cents, side == "D").alias("total_debit_volume"),
            X.total(cents, side == "C").alias("total_credit_volume"),
            X.total(F.col("signed_cents")).alias("net_flow"),
            X.mean_money(cents).alias("avg_transaction_amount"),
            F.max(day).alias("last_transaction_date"),
            F.min(day).alias("first_transaction_date"),
        )
    )


def account_fee_stats(fees: DataFrame) -> DataFrame:
    return (
        fees.withColumn("cents", X.cents("fee_amount"))
        .groupBy("account_id")
        .agg(
            X.rows().alias("total_fee_count"),
            X.total(F.col("cents")).alias("total_fees_charged"),
            F.max("fee_date").alias("last_fee_date"),
        )
    )


def account_summary(
    bridge: DataFrame, transactions: DataFrame, fees: DataFrame, as_of: X.AsOf = None
) -> DataFrame:
    """Both ledgers are reduced to one row per account before they meet the bridge."""
    idle = X.days_between(X.as_of_date(as_of), F.col("last_transaction_date"))
    zero_when_absent = [
        "total_transaction_count",
        "settled_transaction_count",
        "pending_transaction_count",
        "returned_transaction_count",
        "total_debit_volume",
        "total_credit_volume",
        "net_flow",
        "total_fee_count",
        "total_fees_charged",
    ]
    return (
        bridge.join(account_transaction_stats(transactions), "account_id", "left")
        .join(account_fee_stats(fees), "account_id", "left")
        .fillna(0, subset=zero_when_absent)
        .withColumns(
            {"days_since_last_transaction": idle, "is_dormant_account": X.dormant(idle)}
        )
    )
