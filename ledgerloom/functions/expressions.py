"""Column expressions shared by the operators. All stay inside generated JVM code."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions import codes

MONEY_TOTAL = "decimal(28,2)"
MONEY_MEAN = "decimal(22,6)"
AsOf = dt.date | str | Column | None


def as_of_date(as_of: AsOf = None) -> Column:
    """The reporting day: a date, an ISO string, a column, or today when left out."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of.cast("date")
    return F.lit(str(as_of)).cast("date")


def label(code: str, labels: Mapping[str, str]) -> Column:
    """Label of a code; an unknown or missing code has none."""
    cases = " ".join(f"WHEN '{key}' THEN '{text}'" for key, text in labels.items())
    return F.expr(f"CASE {code} {cases} END")


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)


def whole_periods(days: Column, days_per_period: str) -> Column:
    """Completed periods in a number of days, rounded towards minus infinity.

    Scaling both sides to whole hundredths keeps the quotient exact at period
    boundaries without decimal arithmetic per row.
    """
    hundredths = int(Decimal(days_per_period) * 100)
    return F.floor(days * 100 / F.lit(hundredths)).cast("int")


def balance_band(balance: Column) -> Column:
    """Cents between two bands and missing balances land in the last band."""
    return (
        F.when(balance < 0, "Negative")
        .when(balance.between(*codes.LOW_BAND), "Low")
        .when(balance.between(*codes.MID_BAND), "Mid")
        .otherwise("High")
    )


def age_bucket(age: Column) -> Column:
    return (
        F.when(age <= 30, "18-30")
        .when(age <= 45, "31-45")
        .when(age <= 60, "46-60")
        .otherwise("60+")
    )


def signed_amount(amount: Column, indicator: Column) -> Column:
    """Debits leave the account, credits arrive; anything else has no direction."""
    return F.when(indicator == "D", -amount).when(indicator == "C", amount)


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def calendar(day: str, prefix: str) -> dict[str, Column]:
    """Month, year and month number that a date falls into."""
    return {
        f"{prefix}_month": month_start(F.col(day)),
        f"{prefix}_year": F.year(day),
        f"{prefix}_month_num": F.month(day),
    }


def channel_attributes() -> dict[str, Column]:
    """What follows from the channel of a transaction."""
    code = F.col("transaction_channel_code")
    return {
        "channel": label("transaction_channel_code", codes.CHANNELS),
        "is_digital_retail": code.isin(*codes.RETAIL_DIGITAL_CHANNELS),
        "is_digital_commercial": code.isin(*codes.COMMERCIAL_DIGITAL_CHANNELS),
        "is_wire": code == "WIRE",
    }


def fee_type_attributes() -> dict[str, Column]:
    """What follows from the type of a fee."""
    code = F.col("fee_type_code")
    return {
        "fee_type": label("fee_type_code", codes.FEE_TYPES),
        "is_retail_fee": code.isin(*codes.RETAIL_FEES),
        "is_commercial_fee": code.isin(*codes.COMMERCIAL_FEES),
    }


def dormant(days_since: Column) -> Column:
    """Idle for too long, or never used."""
    return F.coalesce(days_since > codes.DORMANT_AFTER_DAYS, F.lit(True))


def rows() -> Column:
    return F.count(F.lit(1))


def cents(amount: str) -> Column:
    """An amount as whole cents.

    Sums of 64-bit integers stay in Spark's fast aggregation path, sums of
    decimals this wide do not. A sum beyond 92 quadrillion dollars raises an
    error rather than wrapping around. So does an amount of a type that can be
    finer than a cent; the type is known before the query runs, so that nothing
    is checked by row.
    """
    whole = F.typeof(F.col(amount)).rlike(r"^(decimal\(\d+,[012]\)|tinyint|smallint|int|bigint)$")
    refused = F.raise_error(F.lit(f"{amount} may be finer than a cent: cast it to decimal(18,2)"))
    return F.when(whole, (F.col(amount) * 100).cast("bigint")).otherwise(refused.cast("bigint"))


def money(cents: Column) -> Column:
    """Summed cents as published dollars."""
    return (cents.cast("decimal(24,0)") * F.lit("0.01").cast("decimal(2,2)")).cast(MONEY_TOTAL)


def summed(value: Column, only: Column | None = None) -> Column:
    """Plain sum; rows outside `only` count as zero."""
    return F.sum(value if only is None else F.when(only, value).otherwise(0))


def total(cents: Column, only: Column | None = None) -> Column:
    """Money sum over cents."""
    return money(summed(cents, only))


def money_mean(cents: Column, count: Column) -> Column:
    """Mean amount from summed cents, half up to a millionth of a dollar."""
    exact = F.try_divide(cents.cast("decimal(22,0)"), count.cast("decimal(20,0)"))
    return (F.round(exact, 4) * F.lit("0.01").cast("decimal(2,2)")).cast(MONEY_MEAN)


def mean_money(cents: Column) -> Column:
    return money_mean(F.sum(cents), F.count(cents))


def mean(value: Column) -> Column:
    """Mean of whole numbers, NULL when there is nothing to average."""
    return F.try_divide(F.sum(value).cast("double"), F.count(value))


def percent(part: Column, whole: Column) -> Column:
    """Share in percent to two places, half up, wide enough for any row count."""
    exact = F.try_divide(part.cast("decimal(20,0)") * 100, whole.cast("decimal(20,0)"))
    return F.round(exact, 2).cast("double")


def division_of_segment(segment: Column) -> Column:
    """Customers belong to a division by segment, whatever accounts they hold."""
    return F.when(segment.isin(*codes.RETAIL_SEGMENTS), "RB").when(
        segment.isin(*codes.COMMERCIAL_SEGMENTS), "CB"
    )


def by_division(division: Column, retail: Column, commercial: Column) -> Column:
    """One definition for Retail Banking, another for Commercial Banking."""
    return F.when(division == "RB", retail).when(division == "CB", commercial)
