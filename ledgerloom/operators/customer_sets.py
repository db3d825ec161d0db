"""Distinct customers that roll up exactly: sets of numbered customers as bitmaps.

A count of distinct customers by branch and month cannot be added up to regions or quarters, as a customer may
be in several. Sets can be united: customers get numbers once, each group of accounts keeps the bits of its
customers, and any coarser group is the union of its parts. Bits come in buckets of 32768 customers, so a
set grows with its customers and no group is held by one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.functions import expressions as X

# Independent sequences of numbers; each is counted through by one task.
SEQUENCES = 1024
# Sets kept for each group, and the customers in them.
KINDS = {"total": None, "active": "customer_is_active", "dormant": "customer_is_dormant"}


def numbered_customers(customers: DataFrame, sequences: int = SEQUENCES) -> DataFrame:
    """customer_id and customer_number of every customer; numbers from 0, close to each other.

    Customers are dealt into sequences by hash and counted in each by id, so that no order over all of them is
    needed and equal inputs get equal numbers. Missing ids get none.
    """
    known = customers.where(F.col("customer_id").isNotNull()).select("customer_id").distinct()
    own = F.pmod(F.xxhash64("customer_id"), F.lit(sequences))
    place = F.row_number().over(W.partitionBy("sequence").orderBy("customer_id"))
    return known.withColumn("sequence", own).select(
        "customer_id", ((place - 1) * sequences + F.col("sequence")).cast("bigint").alias("customer_number")
    )


def customer_sets(bridge: DataFrame, numbers: DataFrame) -> DataFrame:
    """By branch and opening month, the sets of all, active and dormant customers, bucket by bucket."""
    number = F.col("customer_number")
    position = F.expr("bitmap_bit_position(customer_number)")
    placed = bridge.join(numbers, "customer_id").withColumns(
        {
            "report_month": X.month_start(F.col("open_date")),
            "bucket": F.bitmap_bucket_number(number),
            **{f"{k}_bit": position if flag is None else F.when(F.col(flag), position) for k, flag in KINDS.items()},
        }
    )
    return placed.groupBy("branch_code", "region_code", "division_code", "report_month", "bucket").agg(
        *[F.bitmap_construct_agg(f"{kind}_bit").alias(f"{kind}_set") for kind in KINDS]
    )


def united(sets: DataFrame, *by: str | Column) -> DataFrame:
    """Sets of coarser groups, which may be united again."""
    return sets.groupBy(*by, "bucket").agg(*[F.bitmap_or_agg(f"{k}_set").alias(f"{k}_set") for k in KINDS])


def distinct_customers(sets: DataFrame, *by: str | Column) -> DataFrame:
    """Distinct customers of any groups of the sets, exactly."""
    names = [n if isinstance(n, str) else sets.select(n).columns[0] for n in by]
    counts = [F.sum(F.bitmap_count(f"{k}_set")).alias(f"{k}_customer_count") for k in KINDS]
    return united(sets, *by).groupBy(*names).agg(*counts)
