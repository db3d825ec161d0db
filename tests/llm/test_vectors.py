import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import balltree, neighbours

NAN, INF = float("nan"), float("inf")
ODD = [
    (1, [0.5, 0.25]),
    (2, [0.5, 0.25]),
    (3, None),
    (4, [NAN, 1.0]),
    (5, [INF, 1.0]),
    (6, [None, 1.0]),
    (7, []),
    (8, [0.0, 0.0]),
    (9, [-0.3, 0.1, 2.0]),
    (9, [-0.3, 0.1, 2.0]),
    (10, [1.0]),
    (None, [1.0, 1.0]),
    (11, [1e200, -1e200]),
]


def table(spark, rows):
    return spark.createDataFrame([(*r, 0.0, 0) for r in rows], "vec_id long, embedding array<double>, score double, rank int")


def brute(rows, queries, k, usable, whole):
    width = max((len(v) for _, v in rows if v), default=0)
    kept = [(i, whole(np.pad(np.array(v, float), (0, width - len(v))))) for i, v in rows if i is not None and usable(v)]
    for query, vec in kept:
        if query in queries:
            scores = sorted((-sum(x * y for x, y in zip(vec, other)), i) for i, other in kept if i != query)
            yield query, [(i, -s) for s, i in scores[:k]]


def sound(vec):
    return bool(vec) and all(x is not None and np.isfinite(x) for x in vec)


def floors(vec):
    return [int(np.floor(256 * x)) for x in vec]


def found(result):
    lists = {}
    for row in result.orderBy("query_id", "rank").collect():
        lists.setdefault(row["query_id"], []).append((row["vec_id"], row["score"]))
    return lists


@pytest.mark.parametrize("shard_rows", [4096, 100])
def test_exact_top_k(spark, shard_rows):
    random = np.random.default_rng(4)
    centers = random.standard_normal((5, 12))
    rows = [(n, (centers[n % 5] * (n % 3) + random.standard_normal(12) * 0.2).round(2).tolist()) for n in range(700)]
    rows += [(700 + n, rows[3][1]) for n in range(40)]
    vectors = table(spark, rows)
    result = balltree.exact_top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5, shard_rows=shard_rows, block_rows=7)
    queries = {n for n, _ in rows if n % 50 == 0}
    assert found(result) == dict(brute(rows, queries, 5, sound, floors))


def test_odd_vectors_exactly(spark):
    vectors = table(spark, ODD)
    lists = found(balltree.exact_top_k(vectors, vectors, 3))
    expected = {}
    for query, hits in brute(ODD, {i for i, _ in ODD if i}, 3, sound, floors):
        expected[query] = [(i, max(-(2**63 - 1), min(2**63 - 1, s))) for i, s in hits]
    assert lists.keys() == expected.keys() == {1, 2, 8, 9, 10, 11}
    for query in (1, 2, 8, 10):
        assert lists[query] == expected[query]
    assert balltree.exact_top_k(vectors.limit(0), vectors, 3).count() == 0
    assert balltree.exact_top_k(vectors, vectors.limit(0), 3).count() == 0


def test_nearest_of_odd_vectors(spark):
    vectors = table(spark, ODD[:-1])
    lists = found(neighbours.nearest(vectors, vectors, 20))
    expected = dict(brute(ODD[:-1], {i for i, _ in ODD}, 20, lambda v: sound(v) and any(v), list))
    assert lists.keys() == expected.keys() == {1, 2, 9, 10}
    for query in (1, 2, 10):
        assert [i for i, _ in lists[query]] == [i for i, _ in expected[query]]
        assert [s for _, s in lists[query]] == pytest.approx([s for _, s in expected[query]])
    assert neighbours.nearest(vectors.limit(0), vectors, 3).count() == 0
    assert neighbours.nearest(vectors, vectors.limit(0), 3).count() == 0


def test_recall(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    lists = found(neighbours.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0), 20))
    rows = vectors.select("vec_id", "embedding").toPandas()
    ids, matrix = rows["vec_id"].to_numpy(), np.stack(rows["embedding"].to_list()).astype(float)
    hits = 0
    for place in np.flatnonzero(ids % 20 == 0):
        scores = matrix @ matrix[place]
        scores[place] = -np.inf
        best = lists[ids[place]]
        hits += len({i for i, _ in best} & set(ids[np.argsort(-scores)[:20]]))
        assert [s for _, s in best] == pytest.approx([matrix[ids == i][0] @ matrix[place] for i, _ in best], rel=1e-12)
    assert hits / (20 * len(lists)) >= 0.9 and all(len(x) == 20 for x in lists.values())


def hashing_of(rows, tables=2, functions=6):
    settings = neighbours.Settings(tables=tables, functions=functions)
    random = np.random.default_rng(3)
    directions = random.standard_normal((rows.shape[1] + 1, tables * functions))
    largest = float(np.sqrt((rows**2).sum(axis=1)).max())
    cosines = neighbours.units(rows)[:, :-1] @ (rows / largest).T
    distance = float(np.sqrt(2 - 2 * np.median(np.sort(cosines, axis=1)[:, -6])))
    offsets = random.random(tables * functions) * distance
    return neighbours.Hashing(directions, offsets, largest, distance, settings)


def shard_of(rows, hashing):
    codes = np.floor(hashing.places(hashing.lifted(rows))).astype(int)
    return pd.DataFrame({"vec_id": np.arange(len(rows)), "vec": list(rows), "codes": list(codes)})


def test_buckets_of_a_shard_are_read_once_and_nothing_is_drawn_for_it(monkeypatch):
    rows = np.random.default_rng(5).standard_normal((600, 8))
    hashing = hashing_of(rows)
    held = shard_of(rows, hashing)
    asked = held[["vec_id", "vec"]].iloc[:400]
    asked = asked.assign(least=list(neighbours.least_chances(rows[:400], hashing)))
    calls, unique = [], np.unique

    def counted(*args, **kwargs):
        calls.append(1)
        return unique(*args, **kwargs)

    def drawn(*args):
        raise AssertionError("draws do not depend on the shard")

    monkeypatch.setattr(np, "unique", counted)
    monkeypatch.setattr(np.random, "default_rng", drawn)
    best = neighbours.search_buckets(asked, held, hashing, 5)
    assert len(calls) == hashing.settings.tables and len(best) == 400
    hits = 0
    for query, found in enumerate(best):
        scores = (rows * rows[query]).sum(axis=1)
        scores[query] = -np.inf
        order = np.lexsort((np.arange(len(rows)), -scores))[:5]
        hits += len({i for _, i in found} & set(order.tolist()))
        assert all(-s == scores[i] for s, i in found)
    assert hits >= 0.9 * 5 * 400


def test_chances_against_plain_loops():
    rows = np.random.default_rng(6).standard_normal((40, 5))
    hashing = hashing_of(rows)
    codes = np.stack(shard_of(rows, hashing)["codes"].to_list())[:, :6]
    places = hashing.places(neighbours.units(rows[:7]))[:, :6]
    chances = neighbours.chances_of(places, codes, hashing.settings)

    def below(x):
        return 0.5 * (1 + math.erf(x / math.sqrt(2)))

    for bucket in range(40):
        for query in range(7):
            parts = [below(c + 1 - p) - below(c - p) for c, p in zip(codes[bucket], places[query])]
            if min(parts) > 1e-4:
                assert chances[bucket, query] == pytest.approx(sum(map(math.log, parts)), abs=0.01)
    # a query's limit does not depend on those beside it
    least = neighbours.least_chances(rows, hashing)
    assert np.array_equal(least[9:10], neighbours.least_chances(rows[9:10], hashing))


@pytest.mark.parametrize("scale", [1.0, 1e-170, 1e120, 1e160])
def test_best_candidates_against_a_full_sort(scale):
    rows = np.random.default_rng(7).standard_normal((300, 16)).round(1)
    rows[100:130] = rows[3]
    rows, ids = rows * scale, np.arange(300)[::-1].copy()
    with np.errstate(over="ignore", invalid="ignore"):
        vec = rows[3] / max(scale, 1.0)
        scores = (rows * vec).sum(axis=1)
        order = np.lexsort((ids, -scores))[:20]
        best = neighbours.best_candidates(vec, rows, ids, 20)
    assert best == [(-scores[n], ids[n]) for n in order]
