"""Business rules on the hand-made bank."""

from datetime import date as d
from decimal import Decimal as D

import pytest
from bank import AS_OF, hand_made
from pyspark.sql import functions as F

from ledgerloom.operators import branches, metrics
from ledgerloom.plans.models import FinanceModels


@pytest.fixture(scope="module")
def models(spark):
    return FinanceModels(hand_made(spark), AS_OF)


def by_key(table, key, *columns):
    return {
        row[key]: tuple(row[c] for c in columns) if len(columns) > 1 else row[columns[0]]
        for row in table.select(key, *columns).collect()
    }


def test_staging_publishes_ids_and_the_identity_flag_as_text(models):
    assert dict(models.stg_accounts.dtypes)["account_id"] == "string"
    assert dict(models.stg_fees.dtypes)["transaction_id"] == "string"
    assert by_key(models.stg_customers, "customer_id", "know_your_cust_flag") == {
        "1": "1",
        "2": "0",
        "3": "1",
        "4": None,
    }


def test_balance_bands_leave_cents_between_bands_and_nulls_to_the_last(models):
    assert by_key(models.int_accounts_decoded, "account_id", "balance_band") == {
        "1": "Low",
        "2": "High",
        "3": "Negative",
        "4": "High",
        "5": "High",
        "6": "Low",
        "7": "High",
        "8": "Low",
    }


def test_unknown_code_has_no_label_and_missing_code_has_no_flag(models):
    found = by_key(
        models.int_accounts_decoded,
        "account_id",
        "account_type",
        "account_status",
        "is_retail_product",
        "is_open",
    )
    assert found["5"] == (None, None, False, False)
    assert found["6"] == (None, None, None, None)
    assert found["3"] == ("Commercial Loan", "Closed", False, False)


def test_ages_count_completed_periods(models):
    found = by_key(
        models.int_accounts_decoded, "account_id", "account_age_days", "account_age_months"
    )
    assert found["1"] == (716, 23)
    assert found["5"] == (None, None)
    assert found["6"] == (0, 0)


@pytest.mark.parametrize("as_of", [None, "2024-12-31", d(2024, 12, 31)])
def test_reporting_day_is_today_or_as_given(spark, as_of):
    models = FinanceModels(hand_made(spark), as_of)
    today = spark.range(1).select(F.current_date()).first()[0] if as_of is None else d(2024, 12, 31)
    ages = by_key(models.int_accounts_decoded, "account_id", "account_age_days")
    assert ages["1"] == (today - d(2023, 1, 15)).days
    idle = by_key(models.fct_account_summary, "account_id", "days_since_last_transaction")
    assert idle["1"] == (today - d(2024, 12, 1)).days


def test_age_buckets_have_no_lower_bound_and_take_unknown_ages_last(models):
    found = by_key(models.int_customers_decoded, "customer_id", "customer_age", "age_bucket")
    assert found == {
        "1": (60, "46-60"),
        "2": (61, "60+"),
        "3": (None, "60+"),
        "4": (14, "18-30"),
    }


def test_new_and_risky_customers_at_the_limits(models):
    found = by_key(
        models.int_customers_decoded,
        "customer_id",
        "tenure_days",
        "is_new_retail_customer",
        "is_new_commercial_customer",
        "is_high_risk_retail",
        "is_high_risk_commercial",
    )
    assert found["1"] == (90, True, True, True, True)
    assert found["2"] == (180, False, True, False, True)
    assert found["3"] == (91, False, True, False, True)
    assert found["4"] == (181, False, False, None, None)


def test_signed_amount_and_dates(models):
    found = by_key(
        models.int_transactions_decoded,
        "transaction_id",
        "signed_amount",
        "settlement_lag_days",
        "transaction_month",
        "transaction_day_of_week",
    )
    assert found["10"] == (D("-100.00"), 2, d(2024, 12, 1), 1)
    assert found["11"][0] == D("50.05")
    assert found["13"][0] is None


def test_fee_is_standalone_without_a_known_transaction(models):
    assert by_key(models.int_fees_decoded, "fee_id", "is_standalone_fee") == {
        "100": False,
        "101": True,
        "102": True,
        "103": False,
        "104": True,
        "105": False,
    }


def test_fee_rows_stay_single_when_transaction_ids_repeat(spark, models):
    from ledgerloom.operators.decode import decode_fees

    twice = models.stg_transactions.unionAll(models.stg_transactions)
    assert decode_fees(models.stg_fees, twice).count() == 6


def test_bridge_drops_accounts_without_customer_or_branch(models):
    found = by_key(models.int_acct_cust_bridge, "account_id", "division_code", "region_name")
    assert found == {
        "1": ("RB", "Northeast"),
        "2": ("RB", "Northeast"),
        "3": ("CB", "Northeast"),
        "4": ("RB", "Southeast"),
        "5": ("RB", "Southeast"),
        "6": ("CB", "Northeast"),
    }


def test_account_summary(models):
    found = by_key(
        models.fct_account_summary,
        "account_id",
        "total_transaction_count",
        "total_debit_volume",
        "total_credit_volume",
        "net_flow",
        "avg_transaction_amount",
        "days_since_last_transaction",
        "is_dormant_account",
        "total_fees_charged",
    )
    assert found["1"] == (
        2, D("100.00"), D("50.05"), D("-49.95"), D("75.025000"), 30, False, D("15.00"),
    )
    # a side other than debit or credit moves nothing, but the transaction counts
    assert found["2"] == (
        2, D("10.00"), D("0.00"), D("-10.00"), D("15.000000"), 90, False, D("0.00"),
    )
    assert found["4"][5:7] == (91, True)
    assert found["5"] == (0, D("0.00"), D("0.00"), D("0.00"), None, None, True, D("0.00"))


def test_customer_360(models):
    table = models.fct_customer_360
    windows = by_key(
        table,
        "customer_id",
        "total_transaction_count",
        "txn_count_30d",
        "txn_count_90d",
        "txn_count_365d",
        "txn_volume_365d",
    )
    # the day exactly 30 and 90 days ago is inside, a future day is too, 1 January is 365 days back
    assert windows["1"] == (5, 3, 4, 5, D("187.05"))
    assert windows["4"] == (0, 0, 0, 0, D("0.00"))
    behaviour = by_key(
        table,
        "customer_id",
        "preferred_channel_code",
        "digital_ratio_retail",
        "digital_ratio_commercial",
        "days_since_last_transaction",
        "is_behaviourally_dormant",
    )
    # two channels used twice: the first by name wins
    assert behaviour["1"] == ("MOB", 40.0, 40.0, -5, False)
    # a missing channel counts as a transaction but is never preferred
    assert behaviour["2"] == ("WIRE", 0.0, 50.0, 91, True)
    assert behaviour["4"] == (None, None, None, None, True)
    portfolio = by_key(
        table,
        "customer_id",
        "total_account_count",
        "open_account_count",
        "total_balance",
        "avg_account_balance",
        "max_account_balance",
        "primary_division_code",
        "primary_division_name",
        "retail_fees_charged",
        "commercial_fees_charged",
    )
    assert portfolio["1"] == (
        3, 2, D("19998.50"), D("9999.250000"), D("9999.50"), "RB", "Retail Banking",
        D("12.50"), D("3.50"),
    )
    assert portfolio["2"] == (
        2, 0, D("0.00"), None, None, "RB", "Retail Banking", D("0.00"), D("0.00"),
    )
    assert portfolio["4"] == (0, 0, D("0.00"), None, None, None, None, D("0.00"), D("0.00"))


def test_facts_lose_what_the_bridge_loses(models):
    assert sum(r.total_transaction_count for r in models.fct_daily_transactions.collect()) == 7
    assert sum(r.fee_count for r in models.fct_fees_revenue.collect()) == 5


def test_daily_totals_agree(models):
    for row in models.fct_daily_transactions.collect():
        if row.transaction_date == d(2024, 1, 1):
            assert row.net_flow is None  # no transaction of the day has a direction
        else:
            assert row.net_flow == row.total_credit_volume - row.total_debit_volume
        assert row.settled_count + row.pending_count + row.returned_count <= (
            row.total_transaction_count
        )


def test_fee_revenue_is_standalone_plus_linked(models):
    rows = models.fct_fees_revenue.collect()
    assert all(
        r.total_fee_revenue == r.standalone_fee_revenue + r.transaction_linked_fee_revenue
        for r in rows
    )
    assert sum(r.total_fee_revenue for r in rows) == D("19.00")


def test_branch_grid_is_dense_over_transaction_months(models):
    rows = models.fct_branch_performance.collect()
    months = {d(2023, 3, 1), d(2024, 1, 1), d(2024, 6, 1), d(2024, 10, 1), d(2024, 12, 1), d(2025, 1, 1)}
    assert {(r.branch_code, r.report_month) for r in rows} == {
        (b, m) for b in ("BR001", "BR002", "BR009") for m in months
    }
    december = {r.branch_code: r for r in rows if r.report_month == d(2024, 12, 1)}
    assert december["BR009"].accounts_opened == 1
    assert december["BR009"].total_customer_count == 1
    assert december["BR009"].active_customer_count == 0
    assert december["BR009"].avg_account_balance is None
    assert december["BR001"].total_fee_revenue == D("12.50")
    assert december["BR001"].digital_pct_retail_def == 50.0
    assert december["BR002"].digital_pct_retail_def == 0.0


def test_accounts_opened_needs_an_opening_date(models):
    rows = branches.branch_account_metrics(models.int_acct_cust_bridge).collect()
    undated = [r for r in rows if r.report_month is None]
    assert [(r.branch_code, r.accounts_opened, r.active_account_count) for r in undated] == [
        ("BR002", 0, 1)
    ]


def test_division_adds_up_branches_and_compares_months(models):
    branch_rows = models.fct_branch_performance.collect()
    rows = {
        (r.division_code, r.report_month): r for r in models.fct_division_performance.collect()
    }
    for (division, month), row in rows.items():
        mine = [r for r in branch_rows if (r.division_code, r.report_month) == (division, month)]
        assert row.total_fee_revenue == sum(r.total_fee_revenue for r in mine)
        assert row.branch_count == len(mine)
    assert rows["RB", d(2023, 3, 1)].mom_fee_revenue_delta is None
    january, december = rows["RB", d(2024, 1, 1)], rows["RB", d(2024, 12, 1)]
    # the previous row counts, even when calendar months lie between
    assert january.mom_fee_revenue_delta == D("-3.00")
    assert january.mom_fee_revenue_pct_change == -100.0
    assert rows["RB", d(2024, 6, 1)].mom_fee_revenue_pct_change is None
    assert december.mom_fee_revenue_delta == D("10.00")
    assert december.mom_fee_revenue_pct_change == 400.0
    # no transactions: unknown in the division, zero in the branch
    assert january.digital_pct_retail_def == 0.0
    assert rows["CB", d(2024, 1, 1)].digital_pct_retail_def is None


def test_division_average_is_the_plain_mean_of_branch_averages(models):
    row = [
        r
        for r in models.fct_division_performance.collect()
        if (r.division_code, r.report_month) == ("RB", d(2024, 10, 1))
    ][0]
    assert row.avg_transaction_amount == D("20.0000000000")  # BR001 10.00, BR002 30.00


def test_accounts_active_at_month_end(models):
    found = {
        (r.branch_code, r.report_month): r.accounts_active_at_month_end
        for r in branches.accounts_active_at_month_end(
            models.int_acct_cust_bridge, models.int_transactions_decoded
        ).collect()
    }
    assert found["BR009", d(2023, 3, 1)] == 1
    assert found["BR009", d(2024, 1, 1)] == 0
    assert found["BR009", d(2024, 12, 1)] == 1
    assert found["BR001", d(2023, 3, 1)] == 2
    assert found["BR002", d(2023, 3, 1)] == 1
    assert len(found) == 18


@pytest.mark.parametrize("name", sorted(metrics.METRICS))
def test_metric_by_name(models, name):
    usual = models.metric(name)
    assert name in usual.columns
    per_division = models.metric(name, by=["division_code"])
    assert per_division.columns == ["division_code", name]
    assert per_division.count() <= usual.count()


def test_metrics_follow_each_division(models):
    revenue = models.metric("fee_revenue", by=("division_code",)).collect()
    # retail earns MAINT and OD but not WIRE or GIFT, commercial earns SVC
    assert {r.division_code: r.fee_revenue for r in revenue} == {
        "RB": D("12.50"),
        "CB": D("1.00"),
    }
    volume = metrics.metric_transaction_volume(
        models.fct_daily_transactions, by=("division_code",)
    ).collect()
    assert {r.division_code: r.transaction_volume for r in volume} == {
        "RB": D("121.01"),
        "CB": D("7.00"),
    }
    risky = metrics.metric_high_risk_customers(models.int_customers_decoded).collect()
    assert {r.division_code: r.high_risk_customer_count for r in risky} == {
        "RB": 1,
        "CB": 1,
        None: 0,
    }
    new = metrics.metric_new_customers(models.int_customers_decoded).collect()
    assert {r.division_code: r.new_customer_count for r in new} == {"RB": 1, "CB": 1, None: 0}
    alerts = metrics.metric_kyc_alerts(models.int_customers_decoded).collect()
    assert [r.customer_id for r in alerts] == ["2"]
