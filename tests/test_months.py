"""One month of the facts is brought up to date without touching the others."""

from collections import Counter
from dataclasses import replace
from datetime import date

import pytest
from bank import AS_OF, hand_made
from pyspark.sql import functions as F

from ledgerloom import FinanceModels, TableSink, refresh, restate_month

FACTS = ("fct_fees_revenue", "fct_channel_agg", "fct_daily_transactions", "fct_branch_performance", "fct_division_performance")


def rows(table):
    return Counter(tuple(r) for r in table.collect())


def files(folder):
    return {str(f.relative_to(folder)): f.stat().st_mtime_ns for f in folder.rglob("*.parquet")}


def stored_ledgers(spark, folder, raw):
    """The ledgers as files, so that plans show what is read of them."""
    for name in ("transactions", "fees"):
        getattr(raw, name).write.mode("overwrite").parquet(f"{folder}/{name}")
    return replace(raw, **{n: spark.read.parquet(f"{folder}/{n}") for n in ("transactions", "fees")})


def changed(raw):
    """More money in December 2024, and a transaction that was settled meanwhile."""
    december = F.trunc("t_dt", "month") == F.lit("2024-12-01").cast("date")
    transactions = raw.transactions.withColumns(
        {
            "t_amt": F.when(december, F.col("t_amt") + 1).otherwise(F.col("t_amt")).cast("decimal(18,2)"),
            "t_st": F.when(december, "S").otherwise(F.col("t_st")),
        }
    )
    late = raw.fees.where("f_id = '101'").withColumns({"f_id": F.lit("199"), "t_id": F.lit("12")})
    return replace(raw, transactions=transactions, fees=raw.fees.unionByName(late))


def test_a_month_is_restated(spark, tmp_path):
    sink = TableSink(path=str(tmp_path / "marts"))
    refresh(hand_made(spark), sink, AS_OF)
    before = files(tmp_path / "marts")
    raw = changed(hand_made(spark))
    done = restate_month(raw, sink, date(2024, 12, 15))
    models = FinanceModels(raw, AS_OF)
    assert set(done) == set(FACTS)
    for name in FACTS:
        assert rows(done[name]) == rows(getattr(models, name)), name
        assert done[name].columns == getattr(models, name).columns
    after = files(tmp_path / "marts")
    gone = {f for f in before if before[f] != after.get(f)}
    touched = {f.rsplit("/", 1)[0] for f in gone}
    # one folder of each working table, and the small facts
    assert touched == {
        "int_finance__transactions_daily/transaction_month=2024-12-01",
        "int_finance__fees_placed/fee_month=2024-12-01",
        *FACTS,
    }


def test_only_the_month_is_read_of_the_ledgers(spark, tmp_path):
    sink = TableSink(path=str(tmp_path / "marts"))
    raw = stored_ledgers(spark, tmp_path, hand_made(spark))
    refresh(raw, sink, AS_OF)
    month = FinanceModels(
        replace(raw, transactions=raw.transactions.where("t_dt >= date'2024-12-01' and t_dt < date'2025-01-01'")), stored=True
    ).daily_parts
    plan = month._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(t_dt,2024-12-01)" in plan and "LessThan(t_dt,2025-01-01)" in plan
    # one month of a fact reads one folder
    parts = sink.stored(spark, "int_finance__transactions_daily").where("transaction_month = date'2024-12-01'")
    read = parts.select(F.input_file_name()).distinct().collect()
    assert read and all("transaction_month=2024-12-01" in r[0] for r in read)
    assert "PartitionFilters: [isnotnull(transaction_month" in parts._jdf.queryExecution().executedPlan().toString()


def test_months_without_rows_and_catalog_tables_are_refused(spark, tmp_path):
    sink = TableSink(path=str(tmp_path / "marts"))
    refresh(hand_made(spark), sink, AS_OF)
    before = files(tmp_path / "marts")
    with pytest.raises(ValueError, match="no rows in 2020-01"):
        restate_month(hand_made(spark), sink, date(2020, 1, 1))
    assert files(tmp_path / "marts") == before
    with pytest.raises(ValueError, match="folders"):
        TableSink(namespace="default").replace_parts("x", spark.range(1), by=("id",))
