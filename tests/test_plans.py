"""What the plans must and must not contain, and how they take skew."""

import re
from collections import Counter
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import expressions as X
from ledgerloom.operators.bridge import attach_account
from ledgerloom.operators.customers import customer_360
from ledgerloom.operators.decode import flag_standalone_fees
from ledgerloom.plans.registry import PLANS, finance_models, registered
from ledgerloom.session import tune


def physical(table) -> str:
    return table._jdf.queryExecution().executedPlan().toString()


def scans(plan: str, file: str) -> int:
    return len(re.findall(rf"FileScan parquet .*/{file}\.parquet", plan))


@contextmanager
def settings(spark, values):
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


SHUFFLED_JOINS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}
SMALL_SKEW = {
    **SHUFFLED_JOINS,
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
}


@pytest.mark.parametrize("name", sorted(PLANS))
def test_no_python_and_no_cross_join(spark, small_folder, name):
    plan = physical(PLANS[name](finance_models(spark, small_folder)))
    for banned in ("Python", "Pandas", "NestedLoop", "Cartesian", "Expand"):
        assert banned not in plan


@pytest.mark.parametrize(
    ("name", "expected"),
    [
        ("fct_customer_360", 2),
        ("fct_account_summary", 2),
        ("fct_branch_performance", 3),
        ("fct_channel_agg", 1),
        ("metric_fee_revenue", 1),
        ("fct_fees_revenue", 3),
    ],
)
def test_ledger_scans(spark, small_folder, name, expected):
    """The transaction probe for fees is planned only where the flag is read."""
    plan = physical(PLANS[name](finance_models(spark, small_folder)))
    assert scans(plan, "lineitem") == expected


def test_scan_reads_only_needed_columns(spark, small_folder):
    plan = physical(PLANS["fct_channel_agg"](finance_models(spark, small_folder)))
    read = re.search(r"FileScan parquet \[([^\]]*)\].*lineitem\.parquet", plan).group(1)
    assert {re.sub(r"#\d+L?", "", c) for c in read.split(",")} == {
        "l_orderkey",
        "l_partkey",
        "l_extendedprice",
        "l_returnflag",
        "l_shipdate",
    }


def test_filter_on_a_fact_reaches_the_scan(spark, small_folder):
    table = finance_models(spark, small_folder).fct_daily_transactions
    plan = physical(table.where("transaction_date >= date'2001-01-01'"))
    assert re.search(r"DataFilters: \[[^\]]*l_shipdate[^\]]*2001-01-01", plan)


def test_monthly_changes_share_one_window(spark, small_folder):
    plan = physical(PLANS["fct_division_performance"](finance_models(spark, small_folder)))
    assert len(re.findall(r"\bWindow \[", plan)) == 1


def _busy():
    """A third of the rows on key 0, the others spread."""
    return F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997).cast("string")


def _noise():
    return F.sha2(F.col("id").cast("string"), 256)


ROWS = 60_000
HOT = sum(1 for i in range(ROWS) if i % 3 == 0 or i % 997 == 0)


def test_hot_account_is_split(spark):
    transactions = spark.range(ROWS).select(_busy().alias("account_id"), _noise().alias("payload"))
    bridge = spark.range(997).select(
        F.col("id").cast("string").alias("account_id"),
        F.lit("c").alias("customer_id"),
        F.lit("b").alias("branch_code"),
        F.lit("RB").alias("division_code"),
        F.lit("Retail Banking").alias("division_name"),
    )
    with settings(spark, SMALL_SKEW):
        placed = attach_account(transactions.repartition(8), bridge)
        found = Counter(r.account_id for r in placed.collect())
        assert "skew=true" in physical(placed)
    assert found["0"] == HOT
    assert sum(found.values()) == ROWS


def test_hot_customer_is_split_below_an_aggregate(spark):
    """The aggregate reuses the partitioning of the join, which alone would forbid a split."""
    accounts = spark.range(ROWS).select(_busy().alias("customer_id"), _noise().alias("payload"))
    owners = spark.range(997).select(F.col("id").cast("string").alias("customer_id"))
    with settings(spark, SMALL_SKEW):
        sizes = (
            accounts.repartition(8)
            .join(owners, "customer_id")
            .groupBy("customer_id")
            .agg(F.count("payload").alias("n"))
        )
        found = {r.customer_id: r.n for r in sizes.collect()}
        assert "skew=true" in physical(sizes)
    assert found["0"] == HOT


def test_transaction_with_very_many_fees_is_split(spark):
    fees = spark.range(ROWS).select(
        F.concat(F.lit("f"), F.col("id")).alias("fee_id"),
        _busy().alias("transaction_id"),
        _noise().alias("payload"),
    )
    transactions = spark.range(0, 2000, 2).select(
        F.col("id").cast("string").alias("transaction_id")
    )
    with settings(spark, SMALL_SKEW):
        flagged = flag_standalone_fees(fees.repartition(8), transactions)
        rows = flagged.collect()
        assert "skew=true" in physical(flagged)
    assert len(rows) == ROWS
    assert all(r.is_standalone_fee == (int(r.transaction_id) % 2 == 1) for r in rows)


def test_unlinked_fees_are_spread(spark):
    fees = spark.range(30_000).select(
        F.concat(F.lit("f"), F.col("id")).alias("fee_id"),
        F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id").cast("string")).alias(
            "transaction_id"
        ),
    )
    transactions = spark.range(0, 60_000, 2).select(
        F.col("id").cast("string").alias("transaction_id")
    )
    flagged = flag_standalone_fees(fees, transactions)
    with settings(spark, SHUFFLED_JOINS):
        plan = physical(flagged)
        assert "hashpartitioning(coalesce(transaction_id" in plan
        counts = {
            r.is_standalone_fee: r["count"]
            for r in flagged.groupBy("is_standalone_fee").count().collect()
        }
    linked = sum(1 for i in range(30_000) if i % 3 and i % 2 == 0)
    assert counts == {False: linked, True: 30_000 - linked}


def test_busy_account_meets_its_owner_as_few_rows(spark, small_folder):
    """Transactions are partially added up before the first shuffle on the account."""
    m = finance_models(spark, small_folder)
    with settings(spark, SHUFFLED_JOINS):
        table = customer_360(
            m.int_customers_decoded,
            m.int_acct_cust_bridge,
            m.int_transactions_decoded,
            m.int_fees_decoded,
            m.as_of,
        )
        plan = physical(table)
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "lineitem.parquet" in line:
            above = [
                re.search(r"[A-Z]\w+", text).group(0)
                for text in reversed(lines[:i])
                if re.search(r"[A-Z]\w+", text)
            ]
            first_shuffle = above.index("Exchange")
            assert "HashAggregate" in above[:first_shuffle]


def test_queries_leave_the_session_alone(spark, small_folder):
    before = {row["key"]: row["value"] for row in spark.sql("SET").collect()}
    for name in ("fct_branch_performance", "dq_report", "metric_region_rollup"):
        registered()[name](spark, small_folder)
    assert {row["key"]: row["value"] for row in spark.sql("SET").collect()} == before


def test_partitions_are_the_callers_choice(spark):
    name = "spark.sql.shuffle.partitions"
    with settings(spark, {name: spark.conf.get(name)}):
        tune(spark)
        assert spark.conf.get(name) == "4"
        tune(spark, 819_200)
        assert spark.conf.get(name) == "819200"


def test_expressions_are_exact(spark):
    """Rounded shares, means and periods against exact arithmetic."""
    from decimal import ROUND_HALF_UP, Decimal
    from fractions import Fraction

    import numpy as np

    rng = np.random.default_rng(7)
    wholes = rng.integers(1, 4_000_000_000, 3000)
    parts = (rng.random(3000) * (wholes + 1)).astype("int64")
    cases = [(int(p), int(w)) for p, w in zip(parts, wholes)]
    cases += [(n, d) for d in range(1, 60) for n in range(d + 1)] + [(1, 0), (0, 0)]
    table = spark.createDataFrame(cases, "p long, w long").select(
        "p",
        "w",
        X.percent(F.col("p"), F.col("w")).alias("percent"),
        X.money_mean(F.col("p"), F.col("w")).alias("mean"),
        X.money_mean(-F.col("p"), F.col("w")).alias("negative"),
        X.whole_periods((F.col("p") % 60000 - 30000).cast("int"), "30.44").alias("months"),
        X.whole_periods((F.col("p") % 60000 - 30000).cast("int"), "365.25").alias("years"),
    )

    def half_up(value: Fraction, places: int) -> Decimal:
        scaled = value * 10**places
        whole = int(scaled + Fraction(1, 2))
        return (Decimal(whole) / 10**places).quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP)

    for row in table.collect():
        if row.w == 0:
            assert row.percent is None and row.mean is None
            continue
        assert row.percent == float(half_up(Fraction(100 * row.p, row.w), 2))
        assert row.mean == half_up(Fraction(row.p, 100 * row.w), 6)
        assert row.negative == -row.mean
        days = row.p % 60000 - 30000
        assert row.months == (days * 100) // 3044
        assert row.years == (days * 100) // 36525
