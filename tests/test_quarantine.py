"""Rows that cannot be read are listed once, with their file; all others load."""

from collections import Counter

import pytest
from bank import hand_made
from pyspark.sql import functions as F

from ledgerloom import load
from ledgerloom.sources import schemas
from ledgerloom.sources.quarantine import load_quarantined, read_separated


def rows(table):
    return Counter(tuple(r) for r in table.collect())


def written(spark, folder):
    raw = hand_made(spark)
    ledgers = {"a_m": raw.accounts, "c_m": raw.customers, "f_l": raw.fees, "t_l": raw.transactions}
    for name, table in ledgers.items():
        table.coalesce(1).write.option("header", "true").csv(f"{folder}/{name}.csv")
    return raw


BAD_FEES = [
    "200,1,10,MAINT,5.005,2024-12-01",  # finer than a cent
    "201,1,10,MAINT,much,2024-12-01",
    "202,1,10,MAINT,5.00,2024-13-01",
    "203,1,10,MAINT,5.00",
    "204,1,10,MAINT,5.00,2024-12-01,more",
]


def test_good_rows_load_and_bad_ones_are_listed(spark, tmp_path):
    raw = written(spark, tmp_path)
    header = ",".join(schemas.FEES.fieldNames())
    (tmp_path / "f_l.csv" / "late.csv").write_text("\n".join([header, BAD_FEES[0], "300,1,,OD,1.00,2024-12-01", *BAD_FEES[1:]]) + "\n")
    loaded, rejected = load_quarantined(spark, str(tmp_path))
    assert rows(loaded.fees.where("f_id <> '300'")) == rows(raw.fees)
    assert [tuple(r)[:3] for r in loaded.fees.where("f_id = '300'").collect()] == [("300", "1", None)]
    assert loaded.fees.schema == schemas.FEES
    assert rows(loaded.accounts) == rows(raw.accounts) and rows(loaded.transactions) == rows(raw.transactions)
    assert rows(loaded.customers) == rows(raw.customers) and rows(loaded.branches) == rows(raw.branches)
    found = rejected.collect()
    assert len(found) == 5 and {r.ledger for r in found} == {"f_l"}
    assert all(r.file.endswith("f_l.csv/late.csv") for r in found)
    assert Counter(r.reason for r in found) == {
        "f_amt cannot be decimal(18,2): 5.005": 1,
        "f_amt cannot be decimal(18,2): much": 1,
        "f_dt cannot be date: 2024-13-01": 1,
        "another number of values than columns": 2,
    }
    assert {r.record for r in found if r.reason.startswith("another")} == set(BAD_FEES[3:])
    # reading one column judges rows by all of them
    assert loaded.fees.select("f_id").count() == 7 == loaded.fees.count()


def test_failing_fast_stays_the_default(spark, tmp_path):
    written(spark, tmp_path)
    header = ",".join(schemas.FEES.fieldNames())
    (tmp_path / "f_l.csv" / "late.csv").write_text(f"{header}\n{BAD_FEES[1]}\n")
    with pytest.raises(Exception, match="MALFORMED"):
        load(spark, str(tmp_path)).fees.collect()


def test_another_header_still_stops(spark, tmp_path):
    written(spark, tmp_path)
    header = ",".join(reversed(schemas.FEES.fieldNames()))
    (tmp_path / "f_l.csv" / "late.csv").write_text(f"{header}\n1,2,3,4,5,6\n")
    with pytest.raises(Exception, match="header"):
        load_quarantined(spark, str(tmp_path))[0].fees.collect()


def test_other_formats_are_judged_by_value(spark, tmp_path):
    fees = hand_made(spark).fees.withColumn("f_amt", F.col("f_amt").cast("double"))
    spoiled = fees.withColumn("f_amt", F.when(F.col("f_id") == "100", 0.125).otherwise(F.col("f_amt")))
    spoiled.withColumn("extra", F.lit("not read")).write.parquet(f"{tmp_path}/f_l")
    good, rejected = read_separated(spark, str(tmp_path), "f_l", "parquet")
    assert good.schema == schemas.FEES and good.count() == 5
    assert [r.reason for r in rejected.collect()] == ["f_amt cannot be decimal(18,2): 0.125"]
