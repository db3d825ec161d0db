"""Fee, channel and daily facts. All read ledgers that know their account.

Channel, daily and branch facts add up `transaction_parts`: counts, cents, extremes
and days of lag that may be added up in any number of steps without changing a
result. A refresh stores them added up by day, place and code (`pre_aggregated`),
so that the placed ledger is read once; without storing, they are single rows.

Few groups, many rows: partial aggregation shrinks every task to its groups
before the shuffle, so no group can grow hot. Rows are grouped by codes and
dates alone; labels and flags that follow from them are added to the groups.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import codes
from ledgerloom.functions import expressions as X


def fee_revenue(placed_fees: DataFrame) -> DataFrame:
    """One row per fee type, month and division."""
    amount, cents = F.col("fee_amount"), F.col("cents")
    standalone = F.col("is_standalone_fee")
    return (
        placed_fees.withColumn("cents", X.cents("fee_amount"))
        .groupBy("fee_month", "fee_type_code", "division_code", "division_name")
        .agg(
            X.rows().alias("fee_count"),
            X.total(cents).alias("total_fee_revenue"),
            X.mean_money(cents).alias("avg_fee_amount"),
            F.min(amount).alias("min_fee_amount"),
            F.max(amount).alias("max_fee_amount"),
            F.count_if(standalone).alias("standalone_fee_count"),
            F.count_if(~standalone).alias("transaction_linked_fee_count"),
            X.total(cents, standalone).alias("standalone_fee_revenue"),
            X.total(cents, ~standalone).alias("transaction_linked_fee_revenue"),
        )
        .withColumns({**X.fee_type_attributes(), **X.calendar("fee_month", "fee")})
    )


# What parts are added up by, and how each measure adds.
PART_KEYS = (
    "transaction_date",
    "transaction_month",
    "branch_code",
    "division_code",
    "division_name",
    "transaction_channel_code",
    "transaction_type_code",
    "settlement_status",
)
_ADDED = ("uses", "amounts", "cents", "signed_cents", "debit_cents", "credit_cents", "lag_days", "lags")
STATUSES = {"settled": "S", "pending": "P", "returned": "R"}


def transaction_parts(placed_transactions: DataFrame) -> DataFrame:
    """Every transaction as its own contribution to the facts."""
    cents, signed = X.cents("transaction_amount"), F.col("signed_amount")
    amount, lag = F.col("transaction_amount"), F.col("settlement_lag_days")
    return placed_transactions.select(
        *PART_KEYS,
        F.lit(1).cast("bigint").alias("uses"),
        amount.isNotNull().cast("bigint").alias("amounts"),
        cents.alias("cents"),
        X.cents("signed_amount").alias("signed_cents"),
        F.when(signed < 0, cents).otherwise(0).alias("debit_cents"),
        F.when(signed > 0, cents).otherwise(0).alias("credit_cents"),
        amount.alias("min_amount"),
        amount.alias("max_amount"),
        lag.cast("bigint").alias("lag_days"),
        lag.isNotNull().cast("bigint").alias("lags"),
        lag.alias("max_lag_days"),
    )


def pre_aggregated(parts: DataFrame) -> DataFrame:
    """Parts added up by day, place and code; adding these up again gives the same facts."""
    return parts.groupBy(*PART_KEYS).agg(
        *[F.sum(name).alias(name) for name in _ADDED],
        F.min("min_amount").alias("min_amount"),
        *[F.max(name).alias(name) for name in ("max_amount", "max_lag_days")],
    )


def uses(only: Column | None = None) -> Column:
    """Transactions in the parts, or in those that a condition holds for."""
    return X.summed(F.col("uses"), only)


def status_counts() -> list[Column]:
    status = F.col("settlement_status")
    return [uses(status == code).alias(f"{name}_count") for name, code in STATUSES.items()]


def mean_transaction() -> Column:
    return X.money_mean(F.sum("cents"), F.sum("amounts"))


def digital(definition: str) -> Column:
    """Transactions on the channels that a division calls digital."""
    channels = {
        "retail": codes.RETAIL_DIGITAL_CHANNELS,
        "commercial": codes.COMMERCIAL_DIGITAL_CHANNELS,
    }
    return uses(F.col("transaction_channel_code").isin(*channels[definition]))


def channel_mix(parts: DataFrame) -> DataFrame:
    """One row per channel, month and division."""
    grouped = parts.groupBy(
        "transaction_month", "transaction_channel_code", "division_code", "division_name"
    ).agg(
        uses().alias("transaction_count"),
        X.total(F.col("cents")).alias("total_volume"),
        mean_transaction().alias("avg_transaction_amount"),
        F.min("min_amount").alias("min_transaction_amount"),
        F.max("max_amount").alias("max_transaction_amount"),
        *status_counts(),
    )
    return grouped.withColumns(
        {
            **X.channel_attributes(),
            **X.calendar("transaction_month", "transaction"),
            **{
                f"{status}_pct": X.percent(F.col(f"{status}_count"), F.col("transaction_count"))
                for status in STATUSES
            },
        }
    )


def daily_transactions(parts: DataFrame) -> DataFrame:
    """One row per day and division; days without transactions have none."""
    cents, status = F.col("cents"), F.col("settlement_status")
    channel, kind = F.col("transaction_channel_code"), F.col("transaction_type_code")
    return (
        parts.groupBy("transaction_date", "division_code", "division_name")
        .agg(
            uses().alias("total_transaction_count"),
            X.total(cents).alias("total_volume"),
            mean_transaction().alias("avg_transaction_amount"),
            *status_counts(),
            *[X.total(cents, status == code).alias(f"{name}_volume") for name, code in STATUSES.items()],
            X.total(F.col("debit_cents")).alias("total_debit_volume"),
            X.total(F.col("credit_cents")).alias("total_credit_volume"),
            X.total(F.col("signed_cents")).alias("net_flow"),
            *[uses(channel == code).alias(name) for code, name in codes.CHANNEL_COUNTS.items()],
            *[uses(kind == code).alias(name) for code, name in codes.TRANSACTION_TYPE_COUNTS.items()],
            digital("retail").alias("digital_count_retail_def"),
            digital("commercial").alias("digital_count_commercial_def"),
            F.try_divide(F.sum("lag_days").cast("double"), F.sum("lags")).alias("avg_settlement_lag_days"),
            F.max("max_lag_days").alias("max_settlement_lag_days"),
        )
        .withColumns(
            {
                **X.calendar("transaction_date", "transaction"),
                "transaction_day_of_week": F.dayofweek("transaction_date"),
            }
        )
    )
