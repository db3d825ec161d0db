"""Second layer: labels, flags and dates worked out row by row.

A flag on a missing code is NULL, a label on an unknown code is NULL.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import codes
from ledgerloom.functions import expressions as X


def decode_accounts(accounts: DataFrame, as_of: X.AsOf = None) -> DataFrame:
    kind, status = F.col("account_type_code"), F.col("account_status_code")
    age = X.days_between(X.as_of_date(as_of), F.col("open_date"))
    return accounts.withColumns(
        {
            "account_type": X.label("account_type_code", codes.ACCOUNT_TYPES),
            "account_status": X.label("account_status_code", codes.ACCOUNT_STATUSES),
            "is_retail_product": kind.isin(*codes.RETAIL_PRODUCTS),
            "is_commercial_product": kind.isin(*codes.COMMERCIAL_PRODUCTS),
            "is_open": status == "O",
            "is_closed": status == "C",
            "is_frozen": status == "F",
            "account_age_days": age,
            "account_age_months": X.whole_periods(age, codes.DAYS_PER_MONTH),
            "balance_band": X.balance_band(F.col("balance")),
        }
    )


def decode_customers(customers: DataFrame, as_of: X.AsOf = None) -> DataFrame:
    today = X.as_of_date(as_of)
    segment, status, risk = (
        F.col("segment_code"),
        F.col("customer_status_code"),
        F.col("risk_score"),
    )
    age = X.whole_periods(X.days_between(today, F.col("date_of_birth")), codes.DAYS_PER_YEAR)
    tenure = X.days_between(today, F.col("onboard_date"))
    return customers.withColumns(
        {
            "customer_segment": X.label("segment_code", codes.SEGMENTS),
            "customer_status": X.label("customer_status_code", codes.CUSTOMER_STATUSES),
            "is_retail_customer": segment.isin(*codes.RETAIL_SEGMENTS),
            "is_commercial_customer": segment.isin(*codes.COMMERCIAL_SEGMENTS),
            "is_active": status == "AC",
            "is_dormant": status == "DM",
            "is_closed": status == "CL",
            "customer_age": age,
            "age_bucket": X.age_bucket(age),
            "tenure_days": tenure,
            "tenure_months": X.whole_periods(tenure, codes.DAYS_PER_MONTH),
            "is_new_retail_customer": tenure <= codes.NEW_RETAIL_DAYS,
            "is_new_commercial_customer": tenure <= codes.NEW_COMMERCIAL_DAYS,
            "is_high_risk_retail": risk >= codes.HIGH_RISK_RETAIL,
            "is_high_risk_commercial": risk >= codes.HIGH_RISK_COMMERCIAL,
        }
    )


def decode_transactions(transactions: DataFrame) -> DataFrame:
    day, status = F.col("transaction_date"), F.col("settlement_status")
    return transactions.withColumns(
        {
            "transaction_type": X.label("transaction_type_code", codes.TRANSACTION_TYPES),
            "transaction_status": X.label("settlement_status", codes.SETTLEMENT_STATUSES),
            "signed_amount": X.signed_amount(
                F.col("transaction_amount"), F.col("transaction_indicator")
            ),
            "is_settled": status == "S",
            "is_pending": status == "P",
            "is_returned": status == "R",
            **X.channel_attributes(),
            "settlement_lag_days": X.days_between(F.col("posting_date"), day),
            **X.calendar("transaction_date", "transaction"),
            "transaction_day_of_week": F.dayofweek(day),
        }
    )


def label_fees(fees: DataFrame) -> DataFrame:
    return fees.withColumns({**X.fee_type_attributes(), **X.calendar("fee_date", "fee")})


def flag_standalone_fees(fees: DataFrame, transactions: DataFrame) -> DataFrame:
    """Mark fees whose transaction is unknown; every fee is kept exactly once.

    The ids that fees mention are far fewer than the transactions, so they go
    first: each once, however many fees share it, and broadcast where Spark
    measures them small enough. What remains of the transactions is a distinct
    list of known ids, and Spark drops both joins when nobody reads the flag.

    Fees without any transaction id must not meet in one shuffle partition, so
    they are spread by fee id and kept from matching by the last condition. A
    transaction that very many fees mention is split by Spark's skew handling,
    which wants both sides of a join to come straight from a shuffle: the hash
    as second key makes it shuffle the known ids once more.
    """
    linked = F.col("transaction_id")
    mentioned = fees.where(linked.isNotNull()).select("transaction_id").distinct()
    known = (
        transactions.select("transaction_id")
        .join(mentioned, "transaction_id", "left_semi")
        .distinct()
        .select(
            F.col("transaction_id").alias("_known_id"),
            F.xxhash64("transaction_id").alias("_known_hash"),
        )
    )
    key = F.coalesce(linked, F.col("fee_id"))
    matches = (
        (key == F.col("_known_id"))
        & (F.xxhash64(key) == F.col("_known_hash"))
        & linked.isNotNull()
    )
    return (
        fees.join(known, matches, "left")
        .withColumn("is_standalone_fee", F.col("_known_id").isNull())
        .drop("_known_id", "_known_hash")
    )


def decode_fees(fees: DataFrame, transactions: DataFrame) -> DataFrame:
    return flag_standalone_fees(label_fees(fees), transactions)
