"""Exact top-k by inner product: ball trees per shard, searched by branch and bound."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.stored import stored
from ledgerloom.llm.vectors import BLOCK_ROWS, SHARD_ROWS, as_rows, best_of, dealt, each_pair, matrix, usable

LEAF_ROWS = 64
WAVE = 8  # each wave of shards is so many times the ones before it
EXACT = 2.0**53
LARGEST = 2**63 - 1
NODES = "shard int, node int, center array<double>, radius double, ids array<long>, rows binary, width int"
FOUND = "query_id long, shard int, best array<struct<negative:long,vec_id:long>>"


def build_tree(ids: np.ndarray, rows: np.ndarray, leaf_rows: int = LEAF_ROWS):
    """(node, members, center, radius, leaf?) of every ball; the children of node n are 2n and 2n + 1.

    A ball is cut in half by rank along the line between two distant members, ties by id.
    """
    todo = [(1, np.arange(len(ids)))]
    while todo:
        node, members = todo.pop()
        own = rows[members]
        center = own.mean(axis=0)
        away = np.sqrt(((own - center) ** 2).sum(axis=1))
        leaf = len(members) <= leaf_rows
        yield node, members, center, float(away.max()), leaf
        if not leaf:
            far = own[away.argmax()]
            other = own[((own - far) ** 2).sum(axis=1).argmax()]
            order = np.lexsort((ids[members], own @ (other - far)))
            half = len(order) // 2
            todo += [(2 * node, members[order[:half]]), (2 * node + 1, members[order[half:]])]


def _scores(asked: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers; beyond 64 bits the nearest number that fits."""
    most = max(np.abs(asked).max(initial=0), np.abs(rows).max(initial=0))
    if most * most * rows.shape[1] < EXACT:
        return (asked @ rows.T).astype(np.int64)
    whole = [np.array([[int(x) for x in row] for row in part], dtype=object) for part in (asked, rows)]
    return np.clip(whole[0] @ whole[1].T, -LARGEST, LARGEST).astype(np.int64)


def search_tree(queries: pd.DataFrame, nodes: pd.DataFrame, k: int) -> list[np.ndarray]:
    """(negative score, id) of the k best of each query; `kth` of a query is a score already found k times.

    No inner product with a member exceeds that with the center plus length times radius. Each query takes
    its leaves from the highest bound down, a leaf's bound being the least of its own and those of the
    balls around it, until the next bound is below the k-th score. Queries at the same leaf go together.
    """
    width = max(int(nodes["width"].max()), max(map(len, queries["vec"])))
    asked = matrix(queries["vec"], width)
    centers, radius = matrix(nodes["center"], width), nodes["radius"].to_numpy()
    # rounding may not hide a member
    products, lengths = asked @ centers.T, np.sqrt((asked**2).sum(axis=1))
    bounds = products + np.outer(lengths, radius) * (1 + 1e-9) + np.abs(products) * 1e-9 + 1.0
    # a bound that overflowed says nothing
    bounds[~np.isfinite(bounds)] = np.inf
    place = {node: n for n, node in enumerate(nodes["node"].tolist())}
    for node in sorted(place):
        if node > 1:
            bounds[:, place[node]] = np.minimum(bounds[:, place[node]], bounds[:, place[node // 2]])
    leaves = [place[n] for n, ids in zip(nodes["node"], nodes["ids"]) if ids is not None]
    ids = {n: np.asarray(nodes["ids"].iloc[n], np.int64) for n in leaves}
    rows = {n: np.frombuffer(nodes["rows"].iloc[n], np.float64).reshape(len(ids[n]), -1) for n in leaves}
    rows = {n: np.pad(r, ((0, 0), (0, width - r.shape[1]))) for n, r in rows.items()}
    order = np.array(leaves)[np.argsort(-bounds[:, leaves], axis=1, kind="stable")]
    own = queries["vec_id"].to_numpy()
    kth = queries["kth"].to_numpy(dtype=np.float64)
    best = [np.zeros((0, 2), np.int64) for _ in own]
    for turn in range(len(leaves)):
        leaf = order[:, turn]
        open_ = np.flatnonzero(bounds[np.arange(len(own)), leaf] >= kth)
        if not len(open_):
            break
        for n in np.unique(leaf[open_]):
            some = open_[leaf[open_] == n]
            scores = _scores(asked[some], rows[n])
            for row, query in enumerate(some):
                good = np.flatnonzero((scores[row] >= kth[query]) & (ids[n] != own[query]))
                if not len(good):
                    continue
                hits = np.column_stack((-scores[row, good], ids[n][good]))
                both = np.concatenate((best[query], hits))
                best[query] = both[np.lexsort((both[:, 1], both[:, 0]))[:k]]
                if len(best[query]) == k:
                    kth[query] = max(kth[query], -best[query][-1, 0])
    return best


def exact_top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = 256,
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k highest inner products, ties to smaller ids.

    Components x count as floor(scale * x). Every row of `vectors` but the query's own key is a candidate;
    if there are fewer than k, all are returned. Shards get a tree each; they are searched in waves, and
    each query carries the k-th score of the waves before as its bound into the next.

    Rows with a null key, and vectors that are null, empty or hold a null or non-finite component take no
    part on either side. Shorter vectors are filled up with zeros, repeated rows are candidates each, and
    scores beyond 64 bits are cut to the nearest. Other columns are not read; without queries or
    candidates there are no rows.
    """
    whole = F.transform("vec", lambda x: F.when(F.abs(x) < 2.0**50, F.floor(x * scale).cast("double")).otherwise(x * scale))
    rows = usable(vectors, key, vector).withColumn("vec", whole)
    asked = usable(queries, key, vector).withColumn("vec", whole)
    number, wanted = rows.count(), asked.count()
    shards = -(-number // shard_rows)
    blocks = max(1, -(-wanted // block_rows))

    def index(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("vec_id")
        width = max(map(len, part["vec"]))
        ids, members = part["vec_id"].to_numpy(), matrix(part["vec"], width)
        made = [
            (part["shard"].iloc[0], node, center, radius, ids[own] if leaf else None, members[own].tobytes() if leaf else None, width)
            for node, own, center, radius, leaf in build_tree(ids, members)
        ]
        return pd.DataFrame(made, columns=["shard", "node", "center", "radius", "ids", "rows", "width"])

    def search(own: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(nodes):
            return pd.DataFrame(columns=["query_id", "shard", "best"])
        best = search_tree(own, nodes, k)
        lists = [[{"negative": int(s), "vec_id": int(i)} for s, i in hits] for hits in best]
        return pd.DataFrame({"query_id": own["vec_id"], "shard": own["shard"], "best": lists})

    trees = stored(dealt(rows, number, shard_rows, "shard").groupBy("shard").applyInPandas(index, NODES))
    asked = stored(dealt(asked, wanted, block_rows, "block").withColumn("kth", F.lit(float("-inf"))))
    best, start, size = None, 0, 1
    while best is None or start < shards:
        wave = list(range(start, max(1, min(start + size, shards))))
        found = each_pair(asked, blocks, trees, wave, search, FOUND).where(F.size("best") > 0)
        if best is not None:
            found = found.unionByName(best.withColumn("shard", F.lit(-1)))
        best = stored(best_of(found, k))
        start += size
        size *= WAVE
        if start < shards:
            kth = best.where(F.size("best") == k).select(
                F.col("query_id").alias("vec_id"), (-F.element_at("best", -1)["negative"]).cast("double").alias("_kth")
            )
            now = asked.join(kth.dropDuplicates(["vec_id"]), "vec_id", "left")
            asked = stored(now.withColumn("kth", F.coalesce("_kth", "kth")).select(*asked.columns))
    return as_rows(best, "long")
