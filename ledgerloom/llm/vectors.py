"""Vectors dealt into shards, queries into blocks, and the best of what each pair of them finds."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARD_ROWS = 4096
BLOCK_ROWS = 4096


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, vec): components as doubles. Vectors that are null, empty or hold a null, NaN or infinity go."""
    vec = F.col(vector).cast("array<double>")
    sound = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0) & sound)
    return rows.select(F.col(key).cast("long").alias("vec_id"), vec.alias("vec"))


def dealt(rows: DataFrame, count: int, most: int, name: str) -> DataFrame:
    """Rows with a number from 0 in column `name`, about `most` rows each; equal keys are spread too."""
    parts = max(1, -(-count // most))
    return rows.withColumn(name, F.pmod(F.xxhash64("vec_id", "vec"), F.lit(parts)).cast("int"))


def matrix(column: pd.Series, width: int) -> np.ndarray:
    """Rows as doubles; shorter vectors are filled up with zeros."""
    out = np.zeros((len(column), width))
    for row, vec in enumerate(column):
        out[row, : len(vec)] = vec
    return out


def ranked(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties by smaller id."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= least)
        return keep[np.lexsort((ids[keep], -scores[keep]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def each_pair(
    queries: DataFrame, blocks: int, index: DataFrame, shards: list[int], search: Callable, found: str
) -> DataFrame:
    """`search(queries, index)` of every block of queries with every one of the shards.

    Both sides are copied to the pairs they belong to and grouped by pair, so a task holds one block and
    one shard.
    """
    asked = queries.withColumn("shard", F.explode(F.array(*map(F.lit, shards))))
    held = index.where(F.col("shard").isin(shards)).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    pair = ("block", "shard")
    return asked.groupBy(*pair).cogroup(held.groupBy(*pair)).applyInPandas(search, found)


def best_of(found: DataFrame, k: int) -> DataFrame:
    """(query_id, best): the k highest of a query's lists of (negative score, vec_id), ties to smaller ids.

    Lists are merged in two steps, so that no group holds those of all shards.
    """

    def merged(rows: DataFrame, *keys: str | Column) -> DataFrame:
        lists = F.flatten(F.collect_list("best"))
        return rows.groupBy(*keys).agg(F.slice(F.sort_array(lists), 1, k).alias("best"))

    parts = merged(found.withColumn("part", F.floor(F.col("shard") / 64)), "query_id", "part")
    return merged(parts, "query_id")


def as_rows(best: DataFrame, kind: str) -> DataFrame:
    """query_id, rank from 1, vec_id and score of every hit."""
    hits = best.select("query_id", F.posexplode("best").alias("place", "hit"))
    return hits.select(
        "query_id",
        (F.col("place") + 1).cast("int").alias("rank"),
        F.col("hit.vec_id").alias("vec_id"),
        (-F.col("hit.negative")).cast(kind).alias("score"),
    )
