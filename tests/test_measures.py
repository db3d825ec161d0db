"""Measures add up as they say, or refuse; sets of customers give exact distinct counts at any grain."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import customer_sets
from ledgerloom.operators.measures import MEASURES, DoesNotAddUp, measured
from ledgerloom.plans.models import FinanceModels
from ledgerloom.sources.testdata import AS_OF, bank_tables


@pytest.fixture(scope="module")
def models(spark, small_folder):
    return FinanceModels(bank_tables(spark, small_folder), AS_OF)


def test_stock_of_a_quarter_is_that_of_its_last_month(models):
    monthly = {tuple(r)[:2]: r[2] for r in models.measure("accounts_active_at_month_end").collect()}
    quarters = models.measure("accounts_active_at_month_end", period="quarter").collect()
    last = defaultdict(lambda: (None, 0))
    for (division, month), value in monthly.items():
        start = month.replace(month=month.month - (month.month - 1) % 3)
        last[division, start] = max(last[division, start], (month, value), key=lambda x: x[0] or month)
    assert len(quarters) > 20
    for row in quarters:
        months = [m for d, m in monthly if d == row.division_code]
        end = max(m for m in months if m.replace(month=m.month - (m.month - 1) % 3) == row.period_start)
        assert row.accounts_active_at_month_end == monthly[row.division_code, end]


def test_stocks_add_up_over_places(models):
    by_region = models.measure("accounts_active_at_month_end", by=("region_code", "division_code"))
    total = by_region.groupBy("division_code", "period_start").agg(F.sum("accounts_active_at_month_end").alias("n"))
    direct = models.measure("accounts_active_at_month_end")
    assert sorted(map(tuple, total.collect())) == sorted(map(tuple, direct.collect()))


def test_ratios_add_their_parts_first(spark):
    table = spark.createDataFrame(
        [("RB", "2024-01-01", True, 1), ("RB", "2024-01-01", False, 1), ("RB", "2024-02-01", True, 0), ("RB", "2024-03-01", False, 8)],
        "division_code string, month string, is_digital_retail boolean, transaction_count long",
    ).withColumns({"transaction_month": F.col("month").cast("date"), "is_digital_commercial": F.lit(False)})
    found = measured("digital_adoption_rate", table, period="quarter").collect()
    assert [(str(r.period_start), r.digital_adoption_rate) for r in found] == [("2024-01-01", 10.0)]


def test_grains_that_break_a_measure_are_refused(models):
    for name in ("active_customer_count", "avg_account_balance", "mom_fee_revenue_delta"):
        grain = MEASURES[name].grain
        assert models.measure(name, by=grain).columns == [*grain, "period_start", name]
        with pytest.raises(DoesNotAddUp):
            models.measure(name, by=grain, period="quarter")
    with pytest.raises(DoesNotAddUp):
        models.measure("active_customer_count", by=("region_code",))
    with pytest.raises(DoesNotAddUp):
        models.measure("fee_revenue", by=("branch_code",))
    with pytest.raises(ValueError):
        models.measure("fee_revenue", period="week")


def test_metrics_by_name(models):
    assert models.metric("kyc_alert_count").agg(F.sum("kyc_alert_count")).first()[0] > 0
    assert "region_code" in models.metric("region_rollup").columns
    assert models.metric("region_rollup", by=("region_code",)).count() == 5
    assert models.metric("kyc_alerts").count() == models.metric("kyc_alert_count").agg(F.sum("kyc_alert_count")).first()[0]
    monthly = models.metric("accounts_active_at_month_end", by=("report_month",))
    last = monthly.orderBy(F.desc("report_month")).first()
    now = models.metric("accounts_active_at_month_end", by=("division_code",))
    assert monthly.count() > 20 and now.agg(F.sum("accounts_active_at_month_end")).first()[0] == last[1]


def test_numbers_are_different_and_close(spark):
    customers = spark.range(5000).select(F.col("id").cast("string").alias("customer_id"))
    both = customers.unionByName(customers).unionByName(customers.limit(1).withColumn("customer_id", F.lit(None).cast("string")))
    numbers = [r.customer_number for r in customer_sets.numbered_customers(both, 16).collect()]
    assert len(numbers) == len(set(numbers)) == 5000 and min(numbers) >= 0 and max(numbers) < 6000
    again = customer_sets.numbered_customers(both.repartition(7), 16)
    assert sorted(r.customer_number for r in again.collect()) == sorted(numbers)


def test_united_sets_count_each_customer_once(models):
    bridge = models.int_acct_cust_bridge
    year = F.year("report_month").alias("year")
    for by, plain in ((("branch_code",), ("branch_code",)), (("division_code", year), ("division_code", F.year("open_date").alias("year")))):
        found = customer_sets.distinct_customers(models.customer_sets, *by)
        flag = F.when(F.col("customer_is_active"), F.col("customer_id"))
        direct = bridge.groupBy(*plain).agg(F.count_distinct("customer_id"), F.count_distinct(flag))
        names = ["total_customer_count", "active_customer_count"]
        keys = found.columns[: len(by)]
        assert sorted(map(tuple, found.select(*keys, *names).collect()), key=str) == sorted(map(tuple, direct.collect()), key=str)


def test_sets_may_be_united_in_steps(models):
    sets = models.customer_sets
    once = customer_sets.distinct_customers(sets, "division_code")
    twice = customer_sets.distinct_customers(customer_sets.united(sets, "division_code", "region_code"), "division_code")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
