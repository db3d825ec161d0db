"""Branch performance: every branch in every month that saw a transaction."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import codes
from ledgerloom.functions import expressions as X
from ledgerloom.operators import activity
from ledgerloom.operators.bridge import branch_places


def report_months(transactions: DataFrame) -> DataFrame:
    """Months with a transaction, on any account."""
    month = X.month_start(F.col("transaction_date"))
    return (
        transactions.select(month.alias("report_month"))
        .distinct()
        .withColumns(
            {
                "report_year": F.year("report_month"),
                "report_month_num": F.month("report_month"),
            }
        )
    )


def branch_months(transactions: DataFrame, bridge: DataFrame) -> DataFrame:
    """Dense grid of branches and report months.

    The calendar is folded into a single list, a few values per year of
    history, and unfolded for each branch, so no join is involved.
    """
    months = report_months(transactions)
    calendar = months.agg(F.collect_list(F.struct(*months.columns))).scalar()
    return branch_places(bridge).select("*", F.inline(calendar))


def branch_account_metrics(bridge: DataFrame) -> DataFrame:
    """Accounts by branch and opening month.

    Customers are counted by first bringing each down to one row per branch and
    month, which needs no row multiplication for the three distinct counts.
    """
    is_open, cents = F.col("is_open"), F.col("cents")
    open_balance = F.when(is_open, cents)
    per_customer = (
        bridge.withColumn("cents", X.cents("balance"))
        .groupBy(
            "branch_code", X.month_start(F.col("open_date")).alias("report_month"), "customer_id"
        )
        .agg(
            F.count("open_date").alias("opened"),
            X.rows().alias("accounts"),
            F.count_if("is_frozen").alias("frozen"),
            X.summed(cents, is_open).alias("balance"),
            F.sum(open_balance).alias("open_balance"),
            F.count(open_balance).alias("open_balances"),
            F.max("customer_is_active").alias("active"),
            F.max("customer_is_dormant").alias("dormant"),
        )
    )
    known = F.col("customer_id").isNotNull()
    return per_customer.groupBy("branch_code", "report_month").agg(
        F.sum("opened").alias("accounts_opened"),
        F.sum("accounts").alias("active_account_count"),
        F.sum("frozen").alias("frozen_account_count"),
        X.total(F.col("balance")).alias("total_balance"),
        X.money_mean(F.sum("open_balance"), F.sum("open_balances")).alias("avg_account_balance"),
        F.count_if(known).alias("total_customer_count"),
        F.count_if(known & F.col("active")).alias("active_customer_count"),
        F.count_if(known & F.col("dormant")).alias("dormant_customer_count"),
    )


def branch_transaction_metrics(parts: DataFrame) -> DataFrame:
    """Transactions by branch and month, from their parts."""
    grouped = parts.groupBy("branch_code", F.col("transaction_month").alias("report_month")).agg(
        activity.uses().alias("total_transaction_count"),
        X.total(F.col("cents")).alias("total_transaction_volume"),
        activity.mean_transaction().alias("avg_transaction_amount"),
        *activity.status_counts(),
        activity.digital("retail").alias("digital_count_retail_def"),
        activity.digital("commercial").alias("digital_count_commercial_def"),
    )
    return grouped.withColumns(
        {
            f"digital_pct_{name}_def": X.percent(
                F.col(f"digital_count_{name}_def"), F.col("total_transaction_count")
            )
            for name in ("retail", "commercial")
        }
    )


def branch_fee_metrics(placed_fees: DataFrame) -> DataFrame:
    """Revenue in total and in one column per fee type."""
    kind, cents = F.col("fee_type_code"), F.col("cents")
    return (
        placed_fees.withColumn("cents", X.cents("fee_amount"))
        .groupBy("branch_code", F.col("fee_month").alias("report_month"))
        .agg(
            X.rows().alias("total_fee_count"),
            X.total(cents).alias("total_fee_revenue"),
            *[
                X.total(cents, kind == code).alias(name)
                for code, name in codes.FEE_TYPE_REVENUES.items()
            ],
        )
    )


def branch_performance(
    bridge: DataFrame,
    transactions: DataFrame,
    parts: DataFrame,
    placed_fees: DataFrame,
) -> DataFrame:
    """One row per branch and report month; only the averages may be missing.

    `transactions` sets the months; `parts` of transactions and the placed fees know
    their account.
    """
    grain = ["branch_code", "report_month"]
    metrics = [
        branch_account_metrics(bridge),
        branch_transaction_metrics(parts),
        branch_fee_metrics(placed_fees),
    ]
    board = branch_months(transactions, bridge)
    for block in metrics:
        board = board.join(block, grain, "left")
    averages = {"avg_account_balance", "avg_transaction_amount"}
    filled = [
        name
        for block in metrics
        for name in block.columns
        if name not in averages and name not in grain
    ]
    return board.fillna(0, subset=filled)


def accounts_active_at_month_end(bridge: DataFrame, transactions: DataFrame) -> DataFrame:
    """Accounts opened by the end of each report month and not closed by then.

    Openings add one, closings take one away, and a running sum over the months
    of a branch gives the stock: one pass over the accounts instead of matching
    each account with every month it was alive.
    """
    opened = X.month_start(F.col("open_date"))
    ended = F.greatest(opened, X.month_start(F.col("close_date")))
    change = F.array(
        F.struct(opened.alias("report_month"), F.lit(1).alias("change")),
        F.struct(
            F.when(F.col("close_date").isNotNull(), ended).alias("report_month"),
            F.lit(-1).alias("change"),
        ),
    )
    changes = (
        bridge.where(F.col("open_date").isNotNull())
        .select("branch_code", F.inline(change))
        .where(F.col("report_month").isNotNull())
        .groupBy("branch_code", "report_month")
        .agg(F.sum("change").alias("change"))
    )
    grid = branch_months(transactions, bridge).select(
        "branch_code", "report_month", F.lit(True).alias("reported")
    )
    return (
        grid.join(changes, ["branch_code", "report_month"], "full")
        .select(
            "branch_code",
            "report_month",
            "reported",
            F.expr(
                "sum(coalesce(change, 0)) over (partition by branch_code order by report_month)"
            ).alias("accounts_active_at_month_end"),
        )
        .where("reported")
        .drop("reported")
    )
