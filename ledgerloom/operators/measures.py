"""Measures that say how they add up, for any columns of their table and any period.

Flows add up over everything. Ratios add up their two parts first. Stocks add up over places but not over time:
a quarter has the stock of its last month. What counts different customers, averages or compares months adds
up over nothing, and is refused instead of being wrong.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.functions import expressions as X

PERIODS = ("month", "quarter", "year")


class DoesNotAddUp(ValueError):
    """A measure was asked for at a grain at which its parts cannot be put together."""


@dataclass(frozen=True)
class Measure:
    """A published number: the table and month column it comes from, the columns it may be grouped by, and how it adds.

    `how` is `sum`, `ratio`, `last` (of the period; summed over the rest) or `none`. `grain` are the columns,
    beside the month, that tell the rows of its table apart.
    """

    table: str
    month: str
    how: str
    value: Callable[[], Column]
    by: tuple[str, ...]
    grain: tuple[str, ...] = ()
    over: Callable[[], Column] | None = None
    money: bool = False


def _own(retail: str, commercial: str) -> Column:
    return X.by_division(F.col("division_code"), F.col(retail), F.col(commercial))


def _settled_volume() -> Column:
    settled, pending = F.col("settled_volume"), F.col("pending_volume")
    return X.by_division(F.col("division_code"), settled, settled + pending)


_BRANCH = ("branch_code", "region_code", "division_code")

MEASURES = {
    "fee_revenue": Measure(
        "fct_fees_revenue", "fee_month", "sum",
        lambda: F.when(_own("is_retail_fee", "is_commercial_fee"), F.col("total_fee_revenue")).otherwise(0),
        ("division_code", "fee_type_code"), money=True,
    ),
    "transaction_volume": Measure(
        "fct_daily_transactions", "transaction_month", "sum", _settled_volume, ("division_code",), money=True
    ),
    "digital_adoption_rate": Measure(
        "fct_channel_agg", "transaction_month", "ratio",
        lambda: F.when(_own("is_digital_retail", "is_digital_commercial"), F.col("transaction_count")).otherwise(0),
        ("division_code",), over=lambda: F.col("transaction_count"),
    ),
    "accounts_opened": Measure(
        "fct_branch_performance", "report_month", "sum", lambda: F.col("accounts_opened"), _BRANCH
    ),
    "branch_fee_revenue": Measure(
        "fct_branch_performance", "report_month", "sum", lambda: F.col("total_fee_revenue"), _BRANCH, money=True
    ),
    "accounts_active_at_month_end": Measure(
        "month_end_accounts", "report_month", "last", lambda: F.col("accounts_active_at_month_end"), _BRANCH
    ),
    "active_customer_count": Measure(
        "fct_branch_performance", "report_month", "none", lambda: F.col("active_customer_count"), _BRANCH,
        grain=("branch_code",),
    ),
    "avg_account_balance": Measure(
        "fct_branch_performance", "report_month", "none", lambda: F.col("avg_account_balance"), _BRANCH,
        grain=("branch_code",),
    ),
    "mom_fee_revenue_delta": Measure(
        "fct_division_performance", "report_month", "none", lambda: F.col("mom_fee_revenue_delta"),
        ("division_code",), grain=("division_code",),
    ),
}


def measured(
    name: str, source: DataFrame, by: Sequence[str] = ("division_code",), period: str = "month"
) -> DataFrame:
    """The columns `by`, the start of each period as `period_start`, and the measure under its name.

    Raises `DoesNotAddUp` for columns or periods over which the measure cannot be put together: groups that it
    does not know, or, where it does not add at all, any that are coarser than its rows.
    """
    measure = MEASURES[name]
    if period not in PERIODS:
        raise ValueError(f"period {period!r}")
    if unknown := set(by) - set(measure.by):
        raise DoesNotAddUp(f"{name} does not know {', '.join(sorted(unknown))}")
    start = F.trunc(F.col(measure.month), period).alias("period_start")
    if measure.how == "none":
        if period != "month" or not set(measure.grain) <= set(by):
            raise DoesNotAddUp(f"{name} does not add up over {'months' if period != 'month' else 'its groups'}")
        return source.select(*by, start, measure.value().alias(name))
    if measure.how == "last":
        # the last month of the period anywhere, so that a place without one then has no stock
        latest = F.max(measure.month).over(W.partitionBy(F.trunc(F.col(measure.month), period)))
        source = source.withColumn("_latest", latest).where(F.col(measure.month) == F.col("_latest"))
    total = F.sum(measure.value())
    if measure.how == "ratio":
        total = X.percent(total, F.sum(measure.over()))
    elif measure.money:
        total = total.cast(X.MONEY_TOTAL)
    return source.groupBy(*by, start).agg(total.alias(name))
