"""Each data check finds the rows planted for it."""

from datetime import date as d
from decimal import Decimal as D

import pytest
from bank import AS_OF, hand_made

from ledgerloom.operators import quality
from ledgerloom.plans.models import FinanceModels


@pytest.fixture(scope="module")
def models(spark):
    return FinanceModels(hand_made(spark), AS_OF)


def test_declared_checks_are_complete():
    counts = {}
    for check in quality.CHECKS:
        counts[check.test] = counts.get(check.test, 0) + 1
    assert counts == {"unique": 16, "not_null": 42, "accepted_values": 13, "relationships": 6}
    assert len(set(quality.CHECKS)) == 77
    assert [c.severity for c in quality.CHECKS].count("warn") == 1


def test_report_on_the_hand_made_bank(models):
    found = {
        (r.table_name, r.column_name, r.test): (r.violations, r.outcome)
        for r in quality.report(models.checked_tables()).collect()
    }
    assert len(found) == 77
    wrong = {k: v for k, v in found.items() if v[1] != "pass"}
    assert wrong == {
        ("a_m", "c_id", "relationships"): (1, "fail"),
        ("a_m", "a_typ", "not_null"): (1, "fail"),
        ("a_m", "a_typ", "accepted_values"): (1, "fail"),
        ("a_m", "a_opn_dt", "not_null"): (1, "fail"),
        ("a_m", "a_st", "not_null"): (1, "fail"),
        ("a_m", "a_st", "accepted_values"): (1, "fail"),
        ("a_m", "a_bal", "not_null"): (1, "fail"),
        ("a_m", "br_cd", "relationships"): (1, "fail"),
        ("c_m", "c_dob", "not_null"): (1, "fail"),
        ("c_m", "c_seg", "accepted_values"): (1, "fail"),
        ("c_m", "c_st_cd", "accepted_values"): (1, "fail"),
        ("c_m", "c_rsk_sc", "not_null"): (1, "fail"),
        ("c_m", "c_kyc_flg", "not_null"): (1, "fail"),
        ("f_l", "t_id", "relationships"): (1, "warn"),
        ("f_l", "f_typ", "accepted_values"): (1, "fail"),
        ("t_l", "t_dr_cr", "accepted_values"): (1, "fail"),
        ("t_l", "t_typ", "accepted_values"): (1, "fail"),
        ("t_l", "t_ch", "not_null"): (1, "fail"),
        ("t_l", "t_ch", "accepted_values"): (1, "fail"),
        ("t_l", "t_st", "not_null"): (1, "fail"),
    }


def test_violating_rows_can_be_listed(spark):
    table = spark.createDataFrame(
        [(1, "A"), (1, "B"), (2, "Q"), (None, "Q"), (None, None)], "id int, code string"
    )
    parent = spark.createDataFrame([(1,)], "id int")
    assert [tuple(r) for r in quality.repeated_values(table, "id").collect()] == [(1, 2)]
    assert quality.missing_values(table, "id").count() == 2
    assert [tuple(r) for r in quality.unlisted_values(table, "code", ["A", "B"]).collect()] == [
        ("Q", 2)
    ]
    assert [tuple(r) for r in quality.orphan_values(table, "id", parent, "id").collect()] == [
        (2, 1)
    ]


def test_row_rules_catch_one_row_each(spark, models):
    tables = models.checked_tables()
    tables["a_m"] = spark.createDataFrame(
        [
            (1, 1, "SAV", d(2023, 1, 1), d(2023, 2, 1), "O", D("1.00"), "BR001"),
            (2, 1, "SAV", d(2023, 1, 1), d(2023, 2, 1), None, D("1.00"), "BR001"),
            (3, 1, "SAV", d(2023, 1, 1), d(2023, 2, 1), "C", D("1.00"), "BR001"),
        ],
        models.raw.accounts.schema,
    )
    tables["f_l"] = spark.createDataFrame(
        [(1, 1, 1, "OD", D("0.00"), d(2023, 1, 1))], models.raw.fees.schema
    )
    tables["t_l"] = spark.createDataFrame(
        [(1, 1, d(2023, 1, 2), d(2023, 1, 1), D("-1.00"), "D", "POS", "POS", "S")],
        models.raw.transactions.schema,
    )
    tables["c_m"] = spark.createDataFrame(
        [(1, "CRM-12345-0000", d(2000, 1, 1), d(2020, 1, 1), "RTL", "AC", 1, 1)],
        models.raw.customers.schema,
    )
    found = {r.rule: r.violations for r in quality.row_rule_report(tables).collect()}
    assert found == {
        "close_date_only_when_closed": 2,
        "fee_amount_positive": 1,
        "transaction_amount_positive": 1,
        "posted_on_or_after_transaction": 1,
        "crm_reference_format": 1,
    }


def test_grain_report(spark):
    table = spark.createDataFrame([(1, 1), (1, 1), (1, 2)], "a int, b int")
    rows = quality.grain_report({"t": table}, {"t": ("a", "b")}).collect()
    assert [tuple(r) for r in rows] == [("t", "a, b", 3, 1)]


def test_key_checks_share_a_pass(spark):
    table = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "id int")
    checks = [quality.unique("t", "id"), quality.not_null("t", "id")]
    report = quality.report({"t": table}, checks)
    assert {(r.test, r.violations, r.outcome) for r in report.collect()} == {
        ("unique", 1, "fail"),
        ("not_null", 2, "fail"),
    }
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == len(checks) - 1
