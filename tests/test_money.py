"""Amounts keep every cent, whatever type they arrive in, or the query stops."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.expressions import cents, total
from ledgerloom.sources import schemas
from ledgerloom.sources.tables import conformed

AMOUNTS = ["1.15", "0.29", "4.35", "-253607.10", "49709.21", "309057507.69", None]


def fees(spark, kind, amounts):
    rows = [(n, n, n, "SVC", amount, "2024-01-31") for n, amount in enumerate(amounts)]
    table = spark.createDataFrame(rows, "f_id int, a_id long, t_id long, f_typ string, f_amt string, f_dt string")
    return table.withColumn("f_amt", F.col("f_amt").cast(kind))


def loaded(spark, kind, amounts=AMOUNTS):
    return conformed(fees(spark, kind, amounts), schemas.FEES, "f_l")


@pytest.mark.parametrize("kind", ["double", "decimal(18,2)", "decimal(18,4)", "string"])
def test_cents_survive(spark, kind):
    table = loaded(spark, kind)
    assert table.schema["f_amt"].dataType == schemas.MONEY and table.schema["f_id"].dataType.typeName() == "string"
    found = [row["f_amt"] for row in table.orderBy("f_id").collect()]
    assert found == [None if a is None else Decimal(a) for a in AMOUNTS]
    assert table.select(total(cents("f_amt"))).first()[0] == sum(Decimal(a) for a in AMOUNTS if a)


def test_floats_within_their_own_precision(spark):
    assert [r["f_amt"] for r in loaded(spark, "float", ["1.15", "0.29", "4.35"]).collect()] == [
        Decimal("1.15"),
        Decimal("0.29"),
        Decimal("4.35"),
    ]


@pytest.mark.parametrize(
    ("kind", "amount"),
    [("decimal(18,4)", "1.1550"), ("string", "1.155"), ("string", "much"), ("double", "0.2999"), ("double", "1e300")],
)
def test_finer_or_larger_amounts_stop_the_query(spark, kind, amount):
    with pytest.raises(Exception, match="f_l.f_amt cannot be decimal"):
        loaded(spark, kind, [amount]).collect()


def test_ids_that_do_not_fit_stop_the_query(spark):
    table = fees(spark, "double", ["1"]).withColumn("a_id", F.lit(1.5))
    with pytest.raises(Exception, match="f_l.a_id cannot be string"):
        conformed(table, schemas.FEES, "f_l").collect()


@pytest.mark.parametrize("kind", ["double", "float", "string", "decimal(18,4)"])
def test_cents_of_finer_types_are_refused(spark, kind):
    with pytest.raises(Exception, match="may be finer than a cent"):
        fees(spark, kind, ["1.15"]).select(F.sum(cents("f_amt"))).collect()


def test_the_check_costs_nothing(spark):
    plan = fees(spark, "decimal(18,2)", ["1"]).select(cents("f_amt").alias("c"))._jdf.queryExecution().optimizedPlan().toString()
    assert "raise_error" not in plan and "RLIKE" not in plan


@pytest.mark.parametrize("kind", ["int", "bigint", "string", "decimal(18,0)"])
def test_ids_load_as_text_from_whole_numbers_and_text(spark, kind):
    table = fees(spark, "double", ["1"]).withColumn("t_id", F.lit(7).cast(kind))
    assert conformed(table, schemas.FEES, "f_l").first()["t_id"] == "7"
