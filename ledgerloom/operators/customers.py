"""Customer 360: portfolio, behaviour and fees of every customer."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import codes
from ledgerloom.functions import expressions as X


def customer_account_stats(bridge: DataFrame) -> DataFrame:
    """Accounts per customer, by way of customer and division.

    Counts, cents and balances of all accounts are added up by hashing; the alphabetically last division, for
    which Spark sorts, is taken from a row or two for each customer.
    """
    kind, is_open, cents = F.col("account_type_code"), F.col("is_open"), F.col("cents")
    counts = ["total_account_count", "open_account_count", "closed_account_count", "frozen_account_count"]
    counts += codes.ACCOUNT_TYPE_COUNTS.values()
    per_division = (
        bridge.withColumn("cents", X.cents("balance"))
        .groupBy("customer_id", "division_code", "division_name")
        .agg(
            X.rows().alias("total_account_count"),
            F.count_if("is_open").alias("open_account_count"),
            F.count_if("account_is_closed").alias("closed_account_count"),
            F.count_if("is_frozen").alias("frozen_account_count"),
            *[F.count_if(kind == c).alias(name) for c, name in codes.ACCOUNT_TYPE_COUNTS.items()],
            X.summed(cents, is_open).alias("balance"),
            F.sum(F.when(is_open, cents)).alias("open_balance"),
            F.count(F.when(is_open, cents)).alias("open_balances"),
            F.max(F.when(is_open, F.col("balance"))).alias("max_account_balance"),
        )
    )
    return per_division.groupBy("customer_id").agg(
        *[F.sum(name).alias(name) for name in counts],
        X.total(F.col("balance")).alias("total_balance"),
        X.money_mean(F.sum("open_balance"), F.sum("open_balances")).alias("avg_account_balance"),
        F.max("max_account_balance").alias("max_account_balance"),
        F.max("division_code").alias("primary_division_code"),
        F.max("division_name").alias("primary_division_name"),
    )


def _most_used(value: str, uses: str) -> Column:
    """Value with the most uses, the alphabetically first of equals; NULL never wins."""
    rank = F.when(F.col(value).isNotNull(), F.struct(-F.col(uses), F.col(value)))
    return F.min_by(value, rank)


def preferred_channels(owned_transactions: DataFrame) -> DataFrame:
    """Most used channel per customer."""
    per_channel = owned_transactions.groupBy("customer_id", "transaction_channel_code").agg(
        X.rows().alias("uses")
    )
    return per_channel.groupBy("customer_id").agg(
        _most_used("transaction_channel_code", "uses").alias("preferred_channel_code")
    )


def _recent(days: int, as_of: X.AsOf) -> Column:
    """Lower bound only: transactions dated after the reporting day count too."""
    return F.col("transaction_date") >= F.date_sub(X.as_of_date(as_of), days)


def recency_windows(owned_transactions: DataFrame, as_of: X.AsOf = None) -> DataFrame:
    """Counts and volumes of the last 30, 90 and 365 days per customer."""
    columns = []
    for days in codes.RECENCY_WINDOWS:
        recent = _recent(days, as_of)
        columns.append(F.count_if(recent).alias(f"txn_count_{days}d"))
        columns.append(X.total(F.col("cents"), recent).alias(f"txn_volume_{days}d"))
    return (
        owned_transactions.withColumn("cents", X.cents("transaction_amount"))
        .groupBy("customer_id")
        .agg(*columns)
    )


def _account_channel_activity(transactions: DataFrame, as_of: X.AsOf) -> DataFrame:
    """Counts and cents per account and channel; every column can be added up further."""
    cents = F.col("volume_cents")
    windows = [
        column
        for days in codes.RECENCY_WINDOWS
        for column in (
            F.count_if(_recent(days, as_of)).alias(f"txn_count_{days}d"),
            X.summed(cents, _recent(days, as_of)).alias(f"cents_{days}d"),
        )
    ]
    return (
        transactions.withColumn("volume_cents", X.cents("transaction_amount"))
        .groupBy("account_id", "transaction_channel_code")
        .agg(
            X.rows().alias("total_transaction_count"),
            F.count_if("is_settled").alias("settled_transaction_count"),
            F.count_if("is_returned").alias("returned_transaction_count"),
            F.count_if("is_digital_retail").alias("digital_retail"),
            F.count_if("is_digital_commercial").alias("digital_commercial"),
            F.count(cents).alias("amounts"),
            F.sum(cents).alias("volume_cents"),
            *windows,
            F.max("transaction_date").alias("last_transaction_date"),
        )
    )


def customer_transaction_stats(
    transactions: DataFrame, bridge: DataFrame, as_of: X.AsOf = None
) -> DataFrame:
    """Behaviour per customer, in three steps that each shrink the data.

    Transactions are added up per account and channel before they meet the
    owner of the account, so a busy account enters the join as a few rows. Then
    per customer and channel, which leaves the preferred channel to pick among
    a handful of rows, and at last per customer.
    """
    owners = bridge.select("account_id", "customer_id")
    activity = _account_channel_activity(transactions, as_of).join(owners, "account_id")
    keys = ("account_id", "customer_id", "transaction_channel_code", "last_transaction_date")
    added = [name for name in activity.columns if name not in keys]

    def add_up(table: DataFrame, *by: str, extra: tuple[Column, ...] = ()) -> DataFrame:
        latest = F.max("last_transaction_date").alias("last_transaction_date")
        return table.groupBy(*by).agg(
            *[F.sum(name).alias(name) for name in added], latest, *extra
        )

    favourite = _most_used("transaction_channel_code", "total_transaction_count")
    per_customer = add_up(
        add_up(activity, "customer_id", "transaction_channel_code"),
        "customer_id",
        extra=(favourite.alias("preferred_channel_code"),),
    )
    everything, cents = F.col("total_transaction_count"), F.col("volume_cents")
    return per_customer.withColumns(
        {
            "total_transaction_volume": X.money(cents),
            "avg_transaction_amount": X.money_mean(cents, F.col("amounts")),
            **{
                f"txn_volume_{days}d": X.money(F.col(f"cents_{days}d"))
                for days in codes.RECENCY_WINDOWS
            },
            "days_since_last_transaction": X.days_between(
                X.as_of_date(as_of), F.col("last_transaction_date")
            ),
            "digital_ratio_retail": X.percent(F.col("digital_retail"), everything),
            "digital_ratio_commercial": X.percent(F.col("digital_commercial"), everything),
        }
    ).drop(
        "volume_cents",
        "amounts",
        "digital_retail",
        "digital_commercial",
        *[f"cents_{days}d" for days in codes.RECENCY_WINDOWS],
    )


def customer_fee_stats(fees: DataFrame, bridge: DataFrame) -> DataFrame:
    """Fees per customer, added up per account before the join."""
    cents = F.col("cents")
    per_account = (
        fees.withColumn("cents", X.cents("fee_amount"))
        .groupBy("account_id")
        .agg(
            X.rows().alias("fees"),
            F.count(cents).alias("amounts"),
            F.sum(cents).alias("cents"),
            X.summed(cents, F.col("is_retail_fee")).alias("retail"),
            X.summed(cents, F.col("is_commercial_fee")).alias("commercial"),
        )
    )
    return (
        per_account.join(bridge.select("account_id", "customer_id"), "account_id")
        .groupBy("customer_id")
        .agg(
            F.sum("fees").alias("total_fee_count"),
            X.total(cents).alias("total_fees_charged"),
            X.money_mean(F.sum(cents), F.sum("amounts")).alias("avg_fee_amount"),
            X.total(F.col("retail")).alias("retail_fees_charged"),
            X.total(F.col("commercial")).alias("commercial_fees_charged"),
        )
    )


def customer_360(
    customers: DataFrame,
    bridge: DataFrame,
    transactions: DataFrame,
    fees: DataFrame,
    as_of: X.AsOf = None,
) -> DataFrame:
    """One row per customer, with or without accounts.

    Each of the three aggregates ends up partitioned by customer, as the joins
    need it.
    """
    zero_when_absent = [
        "total_account_count",
        "open_account_count",
        "closed_account_count",
        "frozen_account_count",
        *codes.ACCOUNT_TYPE_COUNTS.values(),
        "total_balance",
        "total_transaction_count",
        "settled_transaction_count",
        "returned_transaction_count",
        "total_transaction_volume",
        *[f"txn_count_{days}d" for days in codes.RECENCY_WINDOWS],
        *[f"txn_volume_{days}d" for days in codes.RECENCY_WINDOWS],
        "total_fee_count",
        "total_fees_charged",
        "retail_fees_charged",
        "commercial_fees_charged",
    ]
    return (
        customers.join(customer_account_stats(bridge), "customer_id", "left")
        .join(customer_transaction_stats(transactions, bridge, as_of), "customer_id", "left")
        .join(customer_fee_stats(fees, bridge), "customer_id", "left")
        .fillna(0, subset=zero_when_absent)
        .withColumn(
            "is_behaviourally_dormant", X.dormant(F.col("days_since_last_transaction"))
        )
    )
