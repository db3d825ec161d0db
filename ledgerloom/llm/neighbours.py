"""Approximate nearest neighbours: multiprobe p-stable hashing."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.stored import stored
from ledgerloom.llm.vectors import BLOCK_ROWS, SHARD_ROWS, as_rows, best_of, dealt, each_pair, matrix, ranked, usable

FOUND = "query_id long, shard int, best array<struct<negative:double,vec_id:long>>"
SAMPLE = 4096
QUERIES = 128  # that are looked up at once
BUCKETS = 512  # whose chances are added up at once


@dataclass(frozen=True)
class Settings:
    """Tables of `functions` hash functions, and the chance to meet a neighbour in one of the tables at least.

    A bucket is `width` neighbour distances wide in each function.
    """

    tables: int = 2
    functions: int = 24
    width: float = 1.0
    success: float = 0.95
    seed: int = 11

    @property
    def success_of_table(self) -> float:
        return 1 - (1 - self.success) ** (1 / self.tables)


@dataclass(frozen=True)
class Hashing:
    """Random directions and offsets, fitted to the largest length and the distance of neighbours.

    Vectors are divided by the largest length and lifted onto the unit sphere by one more component, where
    the nearest to a query, whose last component is zero, has the largest inner product.
    """

    directions: np.ndarray
    offsets: np.ndarray
    largest: float
    distance: float
    settings: Settings

    def lifted(self, rows: np.ndarray) -> np.ndarray:
        rows = rows / self.largest
        return np.column_stack((rows, np.sqrt(np.maximum(0, 1 - (rows**2).sum(axis=1)))))

    def places(self, lifted: np.ndarray) -> np.ndarray:
        """Where each row lies in every function, in bucket widths."""
        return (lifted @ self.directions + self.offsets) / (self.settings.width * self.distance)


def _lengths(rows: np.ndarray) -> np.ndarray:
    return np.sqrt((rows**2).sum(axis=1))


def units(vecs: np.ndarray) -> np.ndarray:
    """Queries on the lifted sphere: of length one, their last component zero."""
    return np.column_stack((vecs / np.maximum(_lengths(vecs), 1e-300)[:, None], np.zeros(len(vecs))))


def fit(vectors: DataFrame, number: int, k: int, settings: Settings) -> Hashing | None:
    """Length over all vectors; neighbour distance and dimensions from about SAMPLE of them."""
    squares = F.aggregate("vec", F.lit(0.0), lambda total, x: total + x * x)
    largest, width = vectors.select(F.sqrt(F.max(squares)), F.max(F.size("vec"))).first()
    if not largest:
        return None
    spread = 1 << 30
    limit = spread if number <= SAMPLE else spread * SAMPLE // number
    few = vectors.where(F.pmod(F.xxhash64("vec_id", "vec"), F.lit(spread)) < limit).orderBy("vec_id").limit(2 * SAMPLE)
    rows = matrix(pd.Series([r[0] for r in few.select("vec").collect()]), width)
    random = np.random.default_rng(settings.seed)
    count = settings.tables * settings.functions
    made = Hashing(random.standard_normal((width + 1, count)), random.random(count), float(largest), 1.0, settings)
    distance = 1.0
    if len(rows) > 1:
        asked = rows[:: max(1, len(rows) // 256)]
        asked = asked / np.maximum(_lengths(asked), 1e-300)[:, None]
        near = np.sort(asked @ (rows / largest).T, axis=1)[:, ::-1]
        # the query itself is in the sample too
        rank = min(near.shape[1] - 1, max(1, round(k * len(rows) / number)))
        distance = float(np.sqrt(np.maximum(2 - 2 * np.quantile(near[:, rank], 0.25), 1e-6)))
    offsets = made.offsets * settings.width * distance
    return Hashing(made.directions, offsets, made.largest, distance, settings)


def _normal(x: np.ndarray) -> np.ndarray:
    """Standard normal distribution function, good to seven places."""
    t = 1 / (1 + 0.2316419 * np.abs(x))
    tail = np.exp(-x * x / 2) / math.sqrt(2 * math.pi) * t
    tail *= 0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429)))
    return np.where(x > 0, 1 - tail, tail)


def _log_chances(places: np.ndarray, low: int, high: int, settings: Settings) -> np.ndarray:
    """Log of the chance that a neighbour lies in each bucket of one function, `low` to `high`; a column a query.

    A neighbour lies around the query's place like a normal variable.
    """
    edges = np.arange(low, high + 2)
    below = _normal((edges[:, None] - places[None, :]) * settings.width)
    return np.log(np.maximum(np.diff(below, axis=0), 1e-12)).astype(np.float32)


def chances_of(places: np.ndarray, codes: np.ndarray, settings: Settings) -> np.ndarray:
    """Log of each bucket's estimated chance to hold a neighbour in one table: a row a bucket, a column a query."""
    low, high = codes.min(axis=0), codes.max(axis=0)
    logs = [_log_chances(places[:, f], low[f], high[f], settings) for f in range(codes.shape[1])]
    chances = np.zeros((len(codes), len(places)), np.float32)
    for start in range(0, len(codes), BUCKETS):
        some = chances[start : start + BUCKETS]
        own = np.empty_like(some)
        for f, place in enumerate((codes[start : start + BUCKETS] - low).T):
            some += np.take(logs[f], place, axis=0, out=own, mode="clip")
    return chances


def least_chances(vecs: np.ndarray, hashing: Hashing) -> np.ndarray:
    """What log of a chance to go down to in each table, per query.

    Of neighbours drawn around the query's place, `success_of_table` lie in buckets with at least this chance.
    """
    settings = hashing.settings
    spread = 1 / settings.width
    draws = np.random.default_rng(settings.seed + 1).standard_normal((256, settings.functions)) * spread
    least = np.empty((len(vecs), settings.tables), np.float32)
    for start in range(0, len(vecs), QUERIES):
        some = slice(start, start + QUERIES)
        places = hashing.places(units(vecs[some]))
        queries = np.arange(len(places))[:, None]
        for table in range(settings.tables):
            drawn = np.zeros((len(places), len(draws)), np.float32)
            for f in range(settings.functions):
                own = places[:, table * settings.functions + f]
                landed = np.floor(own[:, None] + draws[None, :, f]).astype(int)
                low = landed.min()
                drawn += _log_chances(own, low, landed.max(), settings)[landed - low, queries]
            least[some, table] = np.quantile(drawn, 1 - settings.success_of_table, axis=1)
    return least


def best_candidates(vec: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[float, int]]:
    """(negative score, id) of the k best of a query's candidates, by inner products summed row by row.

    Only rows that a matrix product leaves in question, rounding included, are summed so.
    """
    if len(rows) > 4 * k:
        rough = rows @ vec
        margin = 1e-9 * len(vec) * np.abs(vec).max() * max(rows.max(), -rows.min())
        if np.isfinite(margin):
            keep = rough >= np.partition(rough, len(rough) - k)[len(rough) - k] - 2 * margin
            rows, ids = rows[keep], ids[keep]
    # row by row, so that equal vectors score alike
    scores = (rows * vec).sum(axis=1)
    best = ranked(scores, ids, k)
    return list(zip((-scores[best]).tolist(), ids[best].tolist()))


def search_buckets(queries: pd.DataFrame, held: pd.DataFrame, hashing: Hashing, k: int) -> list[list[tuple[float, int]]]:
    """(negative score, id) of the k best candidates of each query; `least` of a query is from `least_chances`.

    In each table the occupied buckets are visited from the likeliest down until the estimated success is
    reached, and on until k rows have been met. Candidates of all tables are merged and ranked exactly.
    """
    settings = hashing.settings
    width = hashing.directions.shape[0] - 1
    rows, ids = matrix(held["vec"], width), held["vec_id"].to_numpy()
    codes = np.stack(held["codes"].to_list()).astype(int)
    tables = []
    for table in range(settings.tables):
        span = slice(table * settings.functions, (table + 1) * settings.functions)
        buckets, which, sizes = np.unique(codes[:, span], axis=0, return_inverse=True, return_counts=True)
        tables.append((span, buckets, which.ravel(), sizes))
    out = []
    for start in range(0, len(queries), QUERIES):
        asked = queries.iloc[start : start + QUERIES]
        vecs, own = matrix(asked["vec"], width), asked["vec_id"].to_numpy()
        least = np.stack(asked["least"].to_list()).astype(np.float32)
        places = hashing.places(units(vecs))
        met = np.zeros((len(rows), len(vecs)), bool)
        for table, (span, buckets, which, sizes) in enumerate(tables):
            chances = chances_of(places[:, span], buckets, settings)
            floor = least[:, table]
            if len(rows) <= 2 * k:
                floor = np.full(len(vecs), -np.inf)
            else:
                short = np.flatnonzero(sizes.astype(float) @ (chances >= floor) < k + 1)
                for query in short:
                    order = np.argsort(-chances[:, query], kind="stable")
                    last = np.searchsorted(np.cumsum(sizes[order]), k + 1)
                    floor[query] = chances[order[min(last, len(order) - 1)], query]
            met |= (chances >= floor)[which]
        met = np.ascontiguousarray(met.T) & (ids[None, :] != own[:, None])
        for query in range(len(vecs)):
            some = np.flatnonzero(met[query])
            out.append(best_candidates(vecs[query], rows[some], ids[some], k))
    return out


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    key: str = "vec_id",
    vector: str = "embedding",
    settings: Settings = Settings(),
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k largest inner products found, ties to smaller ids.

    Every row of `vectors` but the query's own key is hashed and may be a candidate; if there are fewer
    than k, all are returned. No bucket or list of candidates is cut. Only the distance of neighbours is
    estimated, from a sample of about SAMPLE vectors.

    Rows with a null key and vectors that are null, empty, zero or hold a null or non-finite component
    take no part on either side. Shorter vectors are filled up with zeros, repeated rows are candidates
    each. Other columns are not read; without queries or candidates there are no rows.
    """
    nonzero = F.exists("vec", lambda x: x != 0)
    rows = usable(vectors, key, vector).where(nonzero)
    asked = usable(queries, key, vector).where(nonzero)
    number, wanted = rows.count(), asked.count()
    blocks = max(1, -(-wanted // block_rows))
    hashing = fit(rows, number, k, settings) if number else None
    if hashing is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width = hashing.directions.shape[0] - 1

    def hashed(part: pd.Series) -> pd.Series:
        codes = np.floor(hashing.places(hashing.lifted(matrix(part, width)))).astype(int)
        return pd.Series(list(codes))

    coded = rows.withColumn("codes", F.pandas_udf(hashed, "array<int>")("vec"))
    index = stored(dealt(coded, number, shard_rows, "shard"))

    def fitting(vecs: pd.Series) -> pd.Series:
        return pd.Series([v[:width] for v in vecs], vecs.index, object)

    def lowest(part: pd.Series) -> pd.Series:
        return pd.Series(list(least_chances(matrix(fitting(part), width), hashing)))

    # once for each query, not for each shard
    asked = asked.withColumn("least", F.pandas_udf(lowest, "array<float>")("vec"))
    asked = dealt(asked, wanted, block_rows, "block")

    def search(own: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(held):
            return pd.DataFrame(columns=["query_id", "shard", "best"])
        best = search_buckets(own.assign(vec=fitting(own["vec"])), held, hashing, k)
        lists = [[{"negative": s, "vec_id": i} for s, i in hits] for hits in best]
        return pd.DataFrame({"query_id": own["vec_id"], "shard": own["shard"], "best": lists})

    shards = list(range(max(1, -(-number // shard_rows))))
    found = each_pair(asked, blocks, index, shards, search, FOUND).where(F.size("best") > 0)
    return as_rows(best_of(found, k), "double")
