"""Near-duplicate vectors: cross-polytope hashing after fast Hadamard rotations, probed buckets, verified pairs."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.components import connected
from ledgerloom.llm.stored import stored
from ledgerloom.llm.textbytes import mixed

ROUNDS = 3  # sign flips and Hadamard transforms of one rotation
BLOCK = 1024  # members of a bucket that one task compares with each other
PAIRS = 2**16  # pairs whose cosines are taken at a time
ROWS = 2**12  # vectors that are rotated at a time
TRIALS = 4000  # simulated pairs that the number of tables is taken from


@dataclass(frozen=True)
class Tables:
    """`tables` of `hashes` rotations each, over `width` coordinates (a power of two), and `probes` beside the own bucket."""

    width: int
    hashes: int
    tables: int
    probes: int

    def signs(self, table: int, number: int) -> np.ndarray:
        """Sign flips of the rounds of one rotation, the same on every machine."""
        seeds = np.arange(ROUNDS * self.width, dtype=np.uint64) + np.uint64((table * 64 + number) << 32)
        return np.where(mixed(mixed(seeds)) >> np.uint64(63), 1.0, -1.0).reshape(ROUNDS, self.width)


def hadamard(rows: np.ndarray) -> np.ndarray:
    """Rows times the Hadamard matrix of their width (a power of two), in width * log(width) steps each."""
    width, step = rows.shape[1], 1
    while step < width:
        pairs = rows.reshape(len(rows), -1, 2, step)
        rows = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), axis=2).reshape(len(rows), width)
        step *= 2
    return rows / math.sqrt(width)


def _choices(hashes: int, width: int) -> np.ndarray:
    """Which of its nearest corners each hash takes: the first of all, then the second or third of one or two hashes."""
    ranks = range(1, min(3, width))
    out = [[0] * hashes]
    for changed in (1, 2):
        for places in combinations(range(hashes), changed):
            for taken in product(ranks, repeat=changed):
                out.append([dict(zip(places, taken)).get(k, 0) for k in range(hashes)])
    return np.array(out)


def bucket_codes(rows: np.ndarray, tables: Tables) -> np.ndarray:
    """[row, table, probe]: the bucket of each row, then those it visits, by how little worse their corners fit.

    A corner of the cross-polytope is a coordinate with its sign; the nearest is the largest coordinate.
    The loss of taking another is the squared gap to the largest one, summed over the hashes of a table.
    """
    choices = _choices(tables.hashes, tables.width)
    deepest = choices.max() + 1
    probes = min(tables.probes, len(choices) - 1)
    out = np.empty((len(rows), tables.tables, probes + 1), np.int64)
    each = np.arange(len(rows))[:, None]
    for table in range(tables.tables):
        loss = np.zeros((len(rows), len(choices)))
        codes = np.full((len(rows), len(choices)), table + 1, np.uint64)
        for number in range(tables.hashes):
            turned = rows
            for flips in tables.signs(table, number):
                turned = hadamard(turned * flips)
            size = np.abs(turned)
            if deepest < tables.width:
                best = np.argpartition(-size, deepest - 1, axis=1)[:, :deepest]
            else:
                best = np.tile(np.arange(tables.width), (len(rows), 1))
            best = np.take_along_axis(best, np.argsort(-np.take_along_axis(size, best, axis=1), axis=1, kind="stable"), axis=1)
            top = np.take_along_axis(size, best, axis=1)
            corner = (best * 2 + (np.take_along_axis(turned, best, axis=1) < 0)).astype(np.uint64)
            taken = choices[:, number]
            loss += (top[:, :1] - top[:, taken]) ** 2
            codes = mixed(codes * np.uint64(0x9E3779B97F4A7C15) + corner[:, taken] + np.uint64(1))
        loss[:, 0] = -1.0
        order = np.argsort(loss, axis=1, kind="stable")[:, : probes + 1]
        out[:, table] = codes[each, order].view(np.int64)
    return out


def meetings(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """[pair, table]: whether one of the two visits the other's bucket, or they share one."""
    forth = (left == right[:, :, :1]).any(axis=2)
    return forth | (right == left[:, :, :1]).any(axis=2)


def plan_tables(count: int, width: int, cosine: float, probes: int = 3, missed: float = 1e-4) -> Tables:
    """Hashes until unrelated vectors rarely share a bucket, and tables until a pair at `cosine` is rarely missed.

    `width` is a power of two. A table has as many buckets as entries, or more. How often a pair at exactly
    `cosine` meets in a table is simulated; pairs nearer to each other meet more often. Hashes grow with
    the logarithm of `count`, so tables grow with a small power of it.
    """
    hashes = max(1, math.ceil(math.log((probes + 1) * max(count, 2)) / math.log(2 * width)))
    random = np.random.default_rng(11)
    one = random.standard_normal((TRIALS, width))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    side = random.standard_normal((TRIALS, width))
    side -= (side * one).sum(axis=1, keepdims=True) * one
    side /= np.maximum(np.linalg.norm(side, axis=1, keepdims=True), 1e-300)
    two = cosine * one + math.sqrt(max(0.0, 1 - cosine**2)) * side
    trial = Tables(width, hashes, 4, probes)
    met = meetings(bucket_codes(one, trial), bucket_codes(two, trial)).mean()
    met = min(max(float(met), 1e-3), 1 - 1e-9)
    return Tables(width, hashes, max(1, math.ceil(math.log(missed) / math.log(1 - met))), probes)


def _unit(vec: list | None) -> np.ndarray | None:
    """The vector at length 1 without trailing zeros; None for one that links with nothing."""
    if not vec or any(x is None for x in vec):
        return None
    row = np.array(vec, np.float64)
    most = np.abs(row).max()
    if not (0 < most < np.inf):
        return None
    row = row[: np.flatnonzero(row)[-1] + 1] / most
    return row / math.sqrt(row @ row)


def _digested(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """vec_id, unit (doubles at length 1, null if it links with nothing), its digest and width."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = [_unit(v) for v in batch.column(1).to_pylist()]
            blobs = [None if u is None else (u + 0.0).astype("<f8").tobytes() for u in units]
            digests = [None if b is None else hashlib.blake2b(b, digest_size=16).digest() for b in blobs]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(blobs, pa.binary()),
                    pa.array(digests, pa.binary()),
                    pa.array([None if u is None else len(u) for u in units], pa.int32()),
                ],
                names=["vec_id", "unit", "node", "width"],
            )

    rows = vectors.select(F.col(key).alias("vec_id"), F.col(vector).cast("array<double>").alias("vec"))
    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id {kind}, unit binary, node binary, width int")


def _matrix(blobs: pa.Array, width: int) -> np.ndarray:
    out = np.zeros((len(blobs), width))
    for row, blob in enumerate(blobs.to_pylist()):
        out[row, : len(blob) // 8] = np.frombuffer(blob, "<f8")
    return out


def _hashed(classes: DataFrame, tables: Tables) -> DataFrame:
    """Every class with its buckets of all tables, as one run of 64-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                codes = bucket_codes(_matrix(part.column(1), tables.width), tables)
                blobs = [row.astype("<i8").tobytes() for row in codes]
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(codes) + 1, dtype=np.int32) * codes[0].size), pa.array(codes.ravel())
                )
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(blobs, pa.binary()), lists], names=["node", "codes", "buckets"]
                )

    return classes.select("node", "unit").mapInArrow(run, "node binary, codes binary, buckets array<long>")


def forest(label: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Places of links that connect what all the links connect, no two of them closing a circle.

    `label` gives the class of every member so far, one of its members; it is brought up to date.
    """
    taken, open_ = [], np.arange(len(left))
    while True:
        low = np.minimum(label[left[open_]], label[right[open_]])
        high = np.maximum(label[left[open_]], label[right[open_]])
        apart = low != high
        open_, low, high = open_[apart], low[apart], high[apart]
        if not len(open_):
            return np.concatenate(taken) if taken else open_
        roots, first = np.unique(high, return_index=True)
        taken.append(open_[first])
        parent = np.arange(len(label))
        parent[roots] = low[first]
        while (parent != parent[parent]).any():
            parent = parent[parent]
        label[:] = parent[label]


def _compared(rows: pa.RecordBatch, tables: Tables, cosine: float) -> pa.RecordBatch:
    """What whole groups (bucket, low, high) say: links counted (node, adds) and links that connect (node, other)."""
    keys = np.column_stack([rows.column(n).to_numpy() for n in ("bucket", "low", "high")])
    starts = np.concatenate(([0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(keys)]))
    sizes, own = np.diff(starts), rows.column("own").to_numpy()
    units = _matrix(rows.column("unit"), tables.width)
    codes = np.frombuffer(b"".join(rows.column("codes").to_pylist()), "<i8").reshape(len(keys), tables.tables, -1)
    table, weight = rows.column("table").to_numpy(), rows.column("size").to_numpy()
    across = keys[:, 1] != keys[:, 2]
    last = np.repeat(starts[1:], sizes)  # one past the group of each row
    label, adds = np.arange(len(keys)), np.zeros(len(keys), np.int64)
    links, begin = [], 0
    partners = last - np.arange(len(keys)) - 1
    upto = np.concatenate(([0], np.cumsum(partners)))
    while begin < len(keys):
        end = max(begin + 1, int(np.searchsorted(upto, upto[begin] + PAIRS, side="right")) - 1)
        some = np.arange(begin, end)
        left = np.repeat(some, partners[begin:end])
        right = np.arange(upto[begin], upto[end]) - np.repeat(upto[begin:end], partners[begin:end]) + left + 1
        begin = end
        fit = ~across[left] | (own[left] != own[right])
        left, right = left[fit], right[fit]
        near = np.einsum("ij,ij->i", units[left], units[right]) >= cosine
        left, right = left[near], right[near]
        if not len(left):
            continue
        # a pair counts where it meets first: in its first table, there in the bucket of the right one if
        # the left one visits it, else in the left one's
        met = meetings(codes[left], codes[right])
        at = table[left]
        pairs = np.arange(len(left))
        visits = (codes[left, at] == codes[right, at, :1]).any(axis=1)
        home = np.where(visits, codes[right, at, 0], codes[left, at, 0])
        first = met[pairs, at] & (met.argmax(axis=1) == at) & (home == keys[left, 0])
        left, right = left[first], right[first]
        np.add.at(adds, left, weight[right])
        np.add.at(adds, right, weight[left])
        taken = forest(label, left, right)
        links.append(np.column_stack((left[taken], right[taken])))
    links = np.concatenate(links) if links else np.zeros((0, 2), np.int64)
    counted = np.flatnonzero(adds)
    nodes = rows.column("node")
    one = pa.chunked_array([nodes.take(pa.array(counted)), nodes.take(pa.array(links[:, 0]))]).combine_chunks()
    other = pa.chunked_array([pa.nulls(len(counted), pa.binary()), nodes.take(pa.array(links[:, 1]))]).combine_chunks()
    gained = pa.array(np.concatenate((adds[counted], np.zeros(len(links), np.int64))))
    return pa.RecordBatch.from_arrays([one, other, gained], names=["node", "other", "adds"])


def _found(classes: DataFrame, hashed: DataFrame, tables: Tables, cosine: float, block: int) -> DataFrame:
    """(node, other, adds): counted links of a class with others, or a link between two classes.

    Buckets that nobody shares are left before any vector moves. Buckets beyond `block` members are dealt
    into blocks, and every block is compared with every other in a task of its own.
    """
    entries = hashed.select("node", F.posexplode("buckets").alias("place", "bucket"))
    probes = F.lit(tables.probes + 1)
    entries = entries.select(
        "node",
        "bucket",
        F.floor(F.col("place") / probes).cast("int").alias("table"),
        (F.col("place") % probes == 0).alias("home"),
    )
    shared = entries.groupBy("bucket").agg(F.count("*").alias("members"), F.count_if("home").alias("homes"))
    shared = shared.where((F.col("members") > 1) & (F.col("homes") > 0)).select(
        "bucket", F.ceil(F.col("members") / block).alias("blocks")
    )
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    placed = entries.join(shared, "bucket").select("bucket", "table", "node", own.alias("own"), "blocks")
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    placed = placed.select("bucket", "table", "node", "own", others.alias("other")).select(
        "bucket",
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
        "own",
        "table",
        "node",
    )
    members = classes.select("node", "unit", "size").join(hashed.select("node", "codes"), "node")
    group = ("bucket", "low", "high")
    rows = placed.join(members, "node").repartition(*group).sortWithinPartitions(*group, "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for batch in batches:
            now = batch if waiting is None else pa.concat_batches([waiting, batch])
            ends = np.column_stack([now.column(n).to_numpy() for n in group])
            change = np.flatnonzero((ends[1:] != ends[:-1]).any(axis=1))
            whole = int(change[-1]) + 1 if len(change) else 0
            if whole:
                yield _compared(now.slice(0, whole), tables, cosine)
            waiting = now.slice(whole)
        if waiting is not None and waiting.num_rows:
            yield _compared(waiting, tables, cosine)

    return rows.mapInArrow(run, "node binary, other binary, adds long")


def near_duplicate_vectors(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    cosine: float = 0.95,
    probes: int = 3,
    missed: float = 1e-4,
    block: int = BLOCK,
) -> DataFrame:
    """`key`, n_links, component_id and kept of every row.

    Vectors whose cosine, in double precision, is at least `cosine` are linked; of pairs at just that
    cosine about `missed` are not found. n_links counts the other rows a row is linked with, component_id
    is the least key that links reach, the row's own included, and kept marks the row that has it. Equal
    vectors are hashed and compared once and counted as often as they come; a bucket of any size is
    compared whole.

    Vectors that are null, empty, zero or hold a null, NaN or infinity have no links and keep their own
    key. Shorter vectors count as filled up with zeros. Rows with equal keys are rows of their own, each
    kept if its key is the least; a null key counts as a row, is never the least while another is there,
    and is kept only where its component has no key. Other columns are not read; no rows give no rows.
    """
    marked = stored(_digested(vectors, key, vector))
    classes = marked.where(F.col("node").isNotNull()).groupBy("node")
    classes = stored(
        classes.agg(F.first("unit").alias("unit"), F.count("*").alias("size"), F.min("vec_id").alias("first"), F.max("width").alias("width"))
    )
    number, widest = classes.select(F.count("*"), F.coalesce(F.max("width"), F.lit(1))).first()
    tables = plan_tables(number, 1 << (widest - 1).bit_length(), cosine, probes, missed)
    tables = Tables(tables.width, tables.hashes, tables.tables, min(probes, len(_choices(tables.hashes, tables.width)) - 1))
    hashed = stored(_hashed(classes, tables))
    found = stored(_found(classes, hashed, tables, cosine, block))
    gained = found.where(F.col("other").isNull()).groupBy("node").agg(F.sum("adds").alias("gained"))
    reached = connected(found.where(F.col("other").isNotNull()).select("node", "other"))
    told = classes.select("node", "size", "first").join(gained, "node", "left").join(reached, "node", "left")
    told = stored(
        told.select(
            "node",
            (F.col("size") - 1 + F.coalesce("gained", F.lit(0))).alias("n_links"),
            F.coalesce("component", "node").alias("component"),
            "first",
        )
    )
    least = told.groupBy("component").agg(F.min("first").alias("component_id"))
    told = told.join(least, "component").select("node", "n_links", "component_id")
    judged = marked.select("vec_id", "node").join(told, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return judged.select(
        F.col("vec_id").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
