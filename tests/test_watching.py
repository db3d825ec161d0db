"""Checks that ride on writes, keys counted once, facts from mergeable parts, and all-at-once publishing."""

from collections import Counter
from dataclasses import replace

import pytest
from bank import AS_OF, hand_made
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom import FinanceModels, TableSink, VersionedSink, refresh
from ledgerloom.operators import activity, quality, watching
from ledgerloom.plans.columns import COLUMNS
from ledgerloom.plans.models import PUBLISHED
from ledgerloom.plans.refresh import KEYS, REPORT, ChecksFailed
from ledgerloom.sources.testdata import AS_OF as SMALL_AS_OF
from ledgerloom.sources.testdata import bank_tables


def rows(table):
    return Counter(tuple(r) for r in table.collect())


def counted_reads(spark, table):
    """The table, and how many of its rows all reads together have produced."""
    read = spark.sparkContext.accumulator(0)

    def pass_on(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    return table.mapInArrow(pass_on, table.schema), read


def clean(spark):
    """The hand-made bank without the rows that break error checks."""
    raw = hand_made(spark)
    return replace(
        raw,
        accounts=raw.accounts.where("a_id in ('1', '2', '4')").withColumn("c_id", F.lit("1")),
        customers=raw.customers.where("c_id = '1'"),
        fees=raw.fees.where("f_id in ('100', '101', '102')"),
        transactions=raw.transactions.where("t_id in ('10', '11', '12')"),
    )


def test_report_equals_the_one_over_tables(spark, tmp_path):
    for raw in (hand_made(spark), clean(spark)):
        done = refresh(raw, TableSink(path=str(tmp_path)), AS_OF)
        expected = quality.report(FinanceModels(raw, AS_OF).checked_tables())
        assert rows(done.checks.select(*expected.columns)) == rows(expected)


def test_report_equals_the_one_over_tables_at_size(spark, tmp_path, small_folder):
    raw = bank_tables(spark, small_folder)
    done = refresh(raw, TableSink(path=str(tmp_path)), SMALL_AS_OF, views={"stg_finance__fees"})
    expected = quality.report(FinanceModels(raw, SMALL_AS_OF).checked_tables())
    assert rows(done.checks.select(*expected.columns)) == rows(expected)


def test_ledgers_are_read_once(spark, tmp_path):
    """Neither storing nor any of the 77 checks goes back to a ledger."""
    raw, reads = hand_made(spark), {}
    for name in ("accounts", "customers", "fees", "transactions"):
        table, reads[name] = counted_reads(spark, getattr(raw, name).coalesce(1))
        raw = replace(raw, **{name: table})
    refresh(raw, TableSink(path=str(tmp_path)), AS_OF)
    assert {n: r.value for n, r in reads.items()} == {"accounts": 8, "customers": 4, "fees": 6, "transactions": 8}


def test_row_checks_add_no_job(spark, tmp_path, monkeypatch):
    """With everything stored, no row check of a stored table is left for a scan."""
    seen = []
    report = quality.report
    monkeypatch.setattr(quality, "report", lambda tables, checks: seen.extend(checks) or report(tables, checks))
    refresh(hand_made(spark), TableSink(path=str(tmp_path)), AS_OF)
    assert {c.table for c in seen} == {"branches", "divisions"}


def test_each_key_is_counted_once(spark, tmp_path):
    done = refresh(clean(spark), TableSink(path=str(tmp_path)), AS_OF)
    counted = spark.read.parquet(f"{tmp_path}/{KEYS}").select("table_name", "column_name").distinct().collect()
    # the published keys hold the values of their ledgers, which answer for them
    assert sorted(tuple(r) for r in counted) == [
        ("branches", "branch_code"),
        ("branches", "branch_name"),
        ("branches", "division_code"),
        ("divisions", "division_code"),
        ("divisions", "division_name"),
        ("stg_finance__accounts", "account_id"),
        ("stg_finance__accounts", "branch_code"),
        ("stg_finance__accounts", "customer_id"),
        ("stg_finance__customers", "crm_reference"),
        ("stg_finance__customers", "customer_id"),
        ("stg_finance__fees", "account_id"),
        ("stg_finance__fees", "fee_id"),
        ("stg_finance__fees", "transaction_id"),
        ("stg_finance__transactions", "account_id"),
        ("stg_finance__transactions", "transaction_id"),
    ]
    assert done.checks.where("outcome = 'fail'").count() == 0


def test_a_key_that_a_join_changed_is_counted_itself(spark, tmp_path):
    refresh(hand_made(spark), TableSink(path=str(tmp_path)), AS_OF)
    counted = spark.read.parquet(f"{tmp_path}/{KEYS}").select("table_name", "column_name").distinct()
    # accounts without customer or branch are missing from the bridge
    assert ("int_finance__acct_cust_bridge", "account_id") in [tuple(r) for r in counted.collect()]


def test_prints_tell_collections_apart(spark):
    def taken(values):
        table = spark.createDataFrame([(v,) for v in values], "k string")
        return tuple(table.select(*watching.print_of("k")).first())

    assert taken(["a", "b", None]) == taken([None, "b", "a"])
    assert len({taken(v) for v in (["a", "b"], ["a", "a", "b"], ["a"] * 3, ["a"], [], [None], ["b"])}) == 7


def test_parts_added_up_twice_give_the_same_facts(spark, small_folder):
    parts = FinanceModels(bank_tables(spark, small_folder), SMALL_AS_OF).daily_parts
    once = activity.pre_aggregated(parts)
    by_place = once.groupBy("transaction_month", "division_code", "division_name")  # a further, coarser step
    assert once.count() < parts.count()
    assert by_place.agg(F.sum("uses")).agg(F.sum("sum(uses)")).first()[0] == parts.count()
    for fact in (activity.channel_mix, activity.daily_transactions):
        assert rows(fact(once)) == rows(fact(parts))
        assert rows(fact(activity.pre_aggregated(once.repartition(5)))) == rows(fact(parts))


def test_columns_are_published_in_order(spark, tmp_path):
    models = FinanceModels(hand_made(spark), AS_OF)
    done = refresh(hand_made(spark), TableSink(path=str(tmp_path)), AS_OF)
    assert len(COLUMNS) == 16
    for attribute, columns in COLUMNS.items():
        assert tuple(getattr(models, attribute).columns) == columns
        assert tuple(done.tables[PUBLISHED[attribute]].columns) == columns
        assert tuple(spark.read.parquet(f"{tmp_path}/{PUBLISHED[attribute]}").columns) == columns
    assert COLUMNS["int_acct_cust_bridge"][:4] == ("account_id", "customer_id", "branch_code", "account_type_code")
    assert COLUMNS["fct_customer_360"][2] == "segment_code" and len(COLUMNS["fct_division_performance"]) == 40


class _Broken(Exception):
    pass


def test_a_refresh_that_fails_halfway_leaves_the_old_tables(spark, tmp_path, monkeypatch):
    sink = VersionedSink(path=str(tmp_path), namespace="ledgerloom_versions")
    assert sink.tables(spark) == {}
    refresh(clean(spark), sink, AS_OF)
    before = {name: rows(table) for name, table in sink.tables(spark).items()}
    assert set(before) == {*PUBLISHED.values(), KEYS, REPORT}
    shown = rows(spark.table("ledgerloom_versions.fct_customer_360"))
    assert shown == before["fct_customer_360"]

    def fails(self, name, table, by=()):
        if name == "fct_customer_360":
            raise _Broken
        return publish(self, name, table, by)

    publish = TableSink.publish
    with monkeypatch.context() as patch:
        patch.setattr(TableSink, "publish", fails)
        with pytest.raises(_Broken):
            refresh(hand_made(spark), sink, AS_OF)
    assert {name: rows(table) for name, table in sink.tables(spark).items()} == before
    assert rows(spark.table("ledgerloom_versions.fct_customer_360")) == shown
    # checks that fail stop the switch too, if asked for
    with pytest.raises(ChecksFailed):
        refresh(hand_made(spark), sink, AS_OF, only_passed=True)
    assert {name: rows(table) for name, table in sink.tables(spark).items()} == before

    done = refresh(hand_made(spark), sink, AS_OF)
    now = sink.tables(spark)
    assert rows(now["fct_customer_360"]) == rows(done.tables["fct_customer_360"]) != shown
    assert rows(spark.table("ledgerloom_versions.fct_customer_360")) == rows(now["fct_customer_360"])
    assert [r.number for r in sink.versions(spark).orderBy("number").collect()] == [1, 2]


def test_views_follow_the_list_of_versions(spark, tmp_path, monkeypatch):
    """A failure between the switch and the views is mended by showing again."""
    sink = VersionedSink(path=str(tmp_path), namespace="ledgerloom_views")
    refresh(clean(spark), sink, AS_OF)
    old = rows(spark.table("ledgerloom_views.fct_customer_360"))

    def fails(self, spark):
        raise _Broken

    with monkeypatch.context() as patch:
        patch.setattr(VersionedSink, "show", fails)
        with pytest.raises(_Broken):
            refresh(hand_made(spark), sink, AS_OF)
    assert rows(spark.table("ledgerloom_views.fct_customer_360")) == old
    sink.show(spark)
    assert rows(spark.table("ledgerloom_views.fct_customer_360")) == rows(sink.tables(spark)["fct_customer_360"]) != old


def test_a_stored_table_in_folders(spark, tmp_path):
    table = spark.range(20).select(F.col("id"), (F.col("id") % 3).cast("string").alias("part"), F.lit(1).alias("x"))
    back = TableSink(path=str(tmp_path)).publish("parted", table, by=("part",))
    assert isinstance(back, DataFrame) and back.columns == ["id", "part", "x"] and rows(back) == rows(table)
    read = back.where("part = '1'")
    assert "PartitionFilters: [isnotnull(part" in read._jdf.queryExecution().executedPlan().toString()
