"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.stored import drop_shuffles, stored


def _each(table: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """(a, b) from every one of the pairs of columns. One read of the table, where a union has one for each pair."""
    links = F.array(*(F.struct(F.col(a).alias("a"), F.col(b).alias("b")) for a, b in pairs))
    return table.select(F.explode(links).alias("link")).select("link.a", "link.b")


def _towards_least(links: DataFrame, side: DataFrame) -> DataFrame:
    """Of every `a`, its neighbours in `side` linked to the least node among them and itself."""
    least = links.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return side.join(least, "a")


def _step(now: DataFrame) -> DataFrame:
    """A node's larger neighbours linked to the least one, and after that its smaller ones and itself."""
    both = _each(now, ("a", "b"), ("b", "a"))
    far = _towards_least(both, both).where(F.col("b") > F.col("a"))
    large = far.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
    small = _each(_towards_least(large, large), ("b", "least"), ("a", "least"))
    return small.where(F.col("a") != F.col("b")).distinct()


def connected(links: DataFrame) -> DataFrame:
    """(node, component): the least node that each linked node reaches over links (a, b).

    Alternates between linking a node's larger neighbours and its smaller ones to the least one, until
    nothing changes: every step groups and joins by node, and the number of steps grows with the logarithm
    of the number of nodes. Links may be repeated, in any direction, and from a node to itself; a link with
    a null end is left out. No links give no rows.
    """
    links = links.toDF("a", "b").where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    now = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        now = stored(_step(now))
        before, state = state, now.select(F.count("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        # plans and shuffles of a step are not needed any more, and else fill the driver's memory
        drop_shuffles(now.sparkSession)
        if before == state:
            break
    ends = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return ends.unionByName(ends.select(F.col("component").alias("node"), "component").distinct())
