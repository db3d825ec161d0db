"""Bounded samples of labelled rows, for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_SPREAD = 1 << 30


def lowest_hashes(
    rows: DataFrame, label: str, by: str, rows_per_label: int, most_labels: int
) -> tuple[DataFrame, dict]:
    """Of the most frequent labels, the distinct rows whose `by` hashes lowest, and all counts of those labels.

    A first cut by a hash limit leaves some times the rows wanted of each label, so that ranking them
    is small work whatever the share of a label.
    """
    counts = {
        r[label]: r["count"]
        for r in rows.where(F.col(label).isNotNull())
        .groupBy(label)
        .count()
        .orderBy(F.desc("count"), label)
        .limit(most_labels)
        .collect()
    }
    if not counts:
        return rows.limit(0), counts
    limits = {name: min(_SPREAD, _SPREAD * 8 * rows_per_label // n + 1) for name, n in counts.items()}
    limit = F.create_map(*[F.lit(x) for item in limits.items() for x in item])
    place = F.pmod(F.xxhash64(by), F.lit(_SPREAD))
    few = rows.withColumn("_place", place).where(F.col("_place") < F.try_element_at(limit, F.col(label)))
    rank = F.row_number().over(Window.partitionBy(label).orderBy("_place", by))
    chosen = few.distinct().withColumn("_rank", rank).where(F.col("_rank") <= rows_per_label)
    return chosen.drop("_place"), counts
