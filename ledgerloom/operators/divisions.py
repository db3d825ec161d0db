"""Division performance: branches added up, and the change from month to month."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.functions import codes
from ledgerloom.functions import expressions as X

_COUNTS = (
    "accounts_opened",
    "active_account_count",
    "frozen_account_count",
    "total_customer_count",
    "active_customer_count",
    "dormant_customer_count",
    "total_transaction_count",
    "settled_count",
    "pending_count",
    "returned_count",
    "digital_count_retail_def",
    "digital_count_commercial_def",
    "total_fee_count",
)
_AMOUNTS = (
    "total_balance",
    "total_transaction_volume",
    "total_fee_revenue",
    *codes.FEE_TYPE_REVENUES.values(),
)
MONTHLY_CHANGES = {
    "mom_transaction_volume_delta": "total_transaction_volume",
    "mom_fee_revenue_delta": "total_fee_revenue",
    "mom_active_account_delta": "active_account_count",
    "mom_active_customer_delta": "active_customer_count",
    "mom_balance_delta": "total_balance",
}


def roll_up_branches(branch_performance: DataFrame, *keys: str) -> DataFrame:
    """Branch figures added up; averages are plain means over the branches that have one."""
    return branch_performance.groupBy(*keys).agg(
        *[F.sum(name).alias(name) for name in _COUNTS],
        *[F.sum(name).cast(X.MONEY_TOTAL).alias(name) for name in _AMOUNTS],
        *[F.avg(name).alias(name) for name in ("avg_account_balance", "avg_transaction_amount")],
        *[
            X.percent(F.sum(f"digital_count_{name}_def"), F.sum("total_transaction_count")).alias(
                f"digital_pct_{name}_def"
            )
            for name in ("retail", "commercial")
        ],
        F.count_distinct("branch_code").alias("branch_count"),
    )


def division_rollup(branch_performance: DataFrame) -> DataFrame:
    """One row per division and report month."""
    return roll_up_branches(
        branch_performance,
        "report_month",
        "report_year",
        "report_month_num",
        "division_code",
        "division_name",
    )


def monthly_changes(rollup: DataFrame) -> DataFrame:
    """Differences to the division's previous row; the first has none."""
    by_month = W.partitionBy("division_code").orderBy("report_month")

    def previous(name: str):
        return F.lag(name).over(by_month)

    now, before = (
        column.cast("decimal(22,2)")
        for column in (F.col("total_fee_revenue"), previous("total_fee_revenue"))
    )
    growth = F.try_divide(now - before, before) * 100
    return rollup.withColumns(
        {
            **{
                change: (F.col(name) - previous(name)).cast(_change_type(name))
                for change, name in MONTHLY_CHANGES.items()
            },
            "mom_fee_revenue_pct_change": F.round(growth, 2).cast("double"),
        }
    )


def _change_type(name: str) -> str:
    return X.MONEY_TOTAL if name in _AMOUNTS else "bigint"


def division_performance(branch_performance: DataFrame) -> DataFrame:
    return monthly_changes(division_rollup(branch_performance))
