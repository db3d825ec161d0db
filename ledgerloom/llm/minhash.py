"""Near-duplicates by b-bit MinHash: band candidates, estimates from packed signatures, confirmed links."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.components import connected
from ledgerloom.llm.stored import stored
from ledgerloom.llm.textbytes import give_back, mixed, slices, words

PLANES = 4  # bits kept of each minimum
BLOCK = 2048  # members of a bucket that are compared in one task


@dataclass(frozen=True)
class Settings:
    """Shingle length, the link rule `percent` * union <= 100 * intersection, bands and rows in a band.

    With 24 bands of 5 a pair at 0.85 has no band in common once in a million times, one at 0.8 once in
    ten thousand. `slack` is how far below the rule an estimate may lie: 4.5 standard errors of 120 minima.
    """

    shingle: int = 3
    percent: int = 85
    bands: int = 24
    rows: int = 5
    slack: float = 0.16
    stars: int = 2

    @property
    def minima(self) -> int:
        return self.bands * self.rows

    @property
    def most_different(self) -> int:
        """Signature places that may differ: chance lets one of 2^PLANES agree by accident."""
        chance = 2.0**-PLANES
        least = max(self.percent / 100 - self.slack, 0.0)
        return int((1 - (least * (1 - chance) + chance)) * self.minima)


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct hashes of all runs of `size` words of each text; of all words, if it has fewer."""
    found = words(texts)
    weights = mixed(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    ends = np.cumsum(found.counts)
    sets = []
    for end, count in zip(ends.tolist(), found.counts.tolist()):
        own = found.hashes[end - count : end]
        have = min(count, size)
        if not have:
            sets.append(own)
            continue
        sums = np.zeros(count - have + 1, np.uint64)
        for k in range(have):
            sums += own[k : count - have + 1 + k] * weights[k]
        sets.append(np.unique(mixed(sums + np.uint64(have))))
    return sets


def signatures(sets: list[np.ndarray], minima: int) -> np.ndarray:
    """32-bit minima of `minima` hash functions, a row for each set; sets must not be empty."""
    flat = np.concatenate(sets)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    factors = mixed(np.arange(1, minima + 1, dtype=np.uint64)) | np.uint64(1)
    shifts = mixed(np.arange(1, minima + 1, dtype=np.uint64) + np.uint64(2**32))
    out = np.empty((len(sets), minima), np.uint32)
    for k in range(minima):
        out[:, k] = np.minimum.reduceat(flat * factors[k] + shifts[k], starts) >> np.uint64(32)
    return out


def pack_planes(minima: np.ndarray) -> np.ndarray:
    """The low PLANES bits of every minimum, one plane of bits after the other, as 64-bit numbers."""
    places = -(-minima.shape[1] // 64) * 64
    planes = []
    for bit in range(PLANES):
        bits = np.zeros((len(minima), places), np.uint8)
        bits[:, : minima.shape[1]] = (minima >> np.uint32(bit)) & 1
        planes.append(np.packbits(bits, axis=1, bitorder="little").view("<i8"))
    return np.concatenate(planes, axis=1)


def band_keys(minima: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band, different between bands."""
    keys = np.empty((len(minima), bands), np.int64)
    for band in range(bands):
        key = np.full(len(minima), band + 1, np.uint64)
        for k in range(rows):
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + minima[:, band * rows + k])
        keys[:, band] = key.view(np.int64)
    return keys


def _lists(rows: np.ndarray, have: np.ndarray) -> pa.Array:
    """A list for every row; null where it has no set."""
    width = rows.shape[1]
    offsets = np.concatenate(([0], np.cumsum(np.where(have, width, 0)))).astype(np.int32)
    return pa.ListArray.from_arrays(
        pa.array(offsets, mask=np.concatenate((~have, [False]))), pa.array(rows.ravel(), pa.int64())
    )


def signed(texts: DataFrame, key: str, text: str, settings: Settings) -> DataFrame:
    """node, n_shingles, a 128-bit digest of the whole set, band keys and the packed signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, some in slices(batch, text):
                sets = shingle_sets(some, settings.shingle)
                sizes = np.array([len(s) for s in sets], np.int64)
                have = sizes > 0
                full = [s for s in sets if len(s)]
                digests = np.zeros((2, len(sets)), np.int64)
                minima = np.zeros((0, settings.minima), np.uint32)
                if full:
                    minima = signatures(full, settings.minima)
                    flat = np.concatenate(full)
                    starts = np.concatenate(([0], np.cumsum(sizes[have])[:-1]))
                    for k in range(2):
                        sums = np.add.reduceat(mixed(flat + np.uint64(k * 0x51ED270B + 1)), starts)
                        digests[k, have] = sums.view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0),
                        pa.array(sizes),
                        pa.array(digests[0]),
                        pa.array(digests[1]),
                        _lists(band_keys(minima, settings.bands, settings.rows), have),
                        _lists(pack_planes(minima), have),
                    ],
                    names=["node", "n_shingles", "digest", "digest2", "bands", "planes"],
                )
            give_back()

    long, longs = T.LongType(), T.ArrayType(T.LongType())
    kinds = {"n_shingles": long, "digest": long, "digest2": long, "bands": longs, "planes": longs}
    schema = T.StructType([T.StructField("node", texts.schema[key].dataType)])
    for name, dtype in kinds.items():
        schema = schema.add(name, dtype)
    return texts.select(key, text).mapInArrow(run, schema)


def different_places(left: Column, right: Column, words_in_plane: int) -> Column:
    """Places where two packed signatures differ in any plane."""
    total = F.lit(0)
    for word in range(words_in_plane):
        differs = F.lit(0).cast("long")
        for plane in range(PLANES):
            at = plane * words_in_plane + word
            differs = differs.bitwiseOR(left[at].bitwiseXOR(right[at]))
        total = total + F.bit_count(differs)
    return total


def _linked(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Those of the pairs (a, b) that the estimate and then the full sets confirm."""
    width = -(-settings.minima // 64)
    own = nodes.select("node", "n_shingles", "planes")
    left, right = own.toDF("a", "a_size", "a_planes"), own.toDF("b", "b_size", "b_planes")
    likely = pairs.distinct().join(left, "a").join(right, "b")
    smaller, larger = F.least("a_size", "b_size"), F.greatest("a_size", "b_size")
    likely = likely.where(smaller * 100 >= larger * settings.percent).where(
        different_places(F.col("a_planes"), F.col("b_planes"), width) <= settings.most_different
    )
    both = likely.select("a", "b").join(sets.toDF("a", "a_set"), "a").join(sets.toDF("b", "b_set"), "b")
    percent = settings.percent

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for a, b in zip(batch.column("a_set"), batch.column("b_set")):
                a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                shared = len(np.intersect1d(a, b, assume_unique=True))
                good.append(100 * shared >= percent * (len(a) + len(b) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))
            give_back()

    kind = pairs.schema
    return both.select("a", "b", "a_set", "b_set").mapInArrow(confirm, kind)


def _with_component(buckets: DataFrame, components: DataFrame | None) -> DataFrame:
    if components is None:
        return buckets.withColumn("component", F.col("node"))
    joined = buckets.join(components, "node", "left")
    return joined.withColumn("component", F.coalesce("component", "node"))


def _star_pairs(members: DataFrame, number: int) -> DataFrame:
    """Every member of a bucket with one of them, another in each round, unless they are linked already."""
    order = F.col("node") if number == 0 else F.xxhash64("node", F.lit(number))
    hubs = members.groupBy("bucket").agg(
        F.min(F.struct(order.alias("order"), "node", "component")).alias("hub"),
        F.min("component").alias("first"),
        F.max("component").alias("last"),
    )
    hubs = hubs.where(F.col("first") != F.col("last")).select("bucket", "hub.node", "hub.component")
    pairs = members.join(hubs.toDF("bucket", "hub", "hub_component"), "bucket")
    pairs = pairs.where(F.col("component") != F.col("hub_component"))
    return pairs.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))


def _block_links(members: DataFrame, nodes: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Links (a, b) between members of a bucket in different components, enough to connect them.

    Compares blocks of members with blocks. A task goes through its groups one by one; pairs that the
    estimate allows are confirmed on full sets, unless links found before in the group connect them, so no
    group gives more links than it has members. Of buckets with the same members one is looked at.
    """
    kind = members.schema["node"].dataType.simpleString()
    shape = members.groupBy("bucket").agg(
        F.min("component").alias("first"),
        F.max("component").alias("last"),
        F.count("*").alias("members"),
        F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("who"),
    )
    shape = shape.where(F.col("first") != F.col("last")).groupBy("members", "who").agg(F.min("bucket").alias("bucket"))
    blocks = F.ceil(F.col("members") / BLOCK)
    placed = members.join(shape, "bucket").select(
        "bucket",
        "node",
        "component",
        blocks.alias("blocks"),
        F.pmod(F.xxhash64("node"), blocks).alias("own"),
    )
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    placed = placed.select("bucket", "node", "component", "own", other.alias("other"))
    placed = placed.join(nodes.select("node", "planes"), "node").join(sets, "node").select(
        "bucket",
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
        "node",
        "component",
        "own",
        "planes",
        "set",
    )
    order = ("bucket", "low", "high")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for batch in batches:
            rows = batch if waiting is None else pa.concat_batches([waiting, batch])
            keys = [rows.column(n).to_numpy() for n in order]
            starts = np.flatnonzero(np.any([np.diff(k) != 0 for k in keys], axis=0)) + 1
            yield _confirmed(rows.slice(0, starts[-1] if len(starts) else 0), [0, *starts], settings)
            waiting = rows.slice(starts[-1] if len(starts) else 0)
            give_back()
        if waiting is not None:
            yield _confirmed(waiting, [0, waiting.num_rows], settings)

    sorted_rows = placed.repartition(*order).sortWithinPartitions(*order)
    return sorted_rows.mapInArrow(compare, f"a {kind}, b {kind}")


def _confirmed(rows: pa.RecordBatch, bounds: list[int], settings: Settings) -> pa.RecordBatch:
    """Links that connect the components of every group of members between two bounds."""
    nodes, components = (rows.column(n).to_numpy(zero_copy_only=False) for n in ("node", "component"))
    own, width = rows.column("own").to_numpy(), -(-settings.minima // 64)
    planes = rows.column("planes").flatten().to_numpy().reshape(rows.num_rows, PLANES, width)
    found: list[tuple] = []
    for start, end in zip(bounds[:-1], bounds[1:]):
        if end - start < 2 or (components[start:end] == components[start]).all():
            continue
        _, label = np.unique(components[start:end], return_inverse=True)
        sets = [np.frombuffer(rows.column("set")[k].as_buffer(), np.uint64) for k in range(start, end)]
        sizes = np.array([len(s) for s in sets])
        begins = np.cumsum(sizes) - sizes
        _, codes = np.unique(np.concatenate(sets), return_inverse=True)
        marked = np.zeros(codes.max() + 1, np.uint8)
        group, mine = planes[start:end], own[start:end]
        one_block = (mine == mine[0]).all()
        for row in range(end - start):
            others = (label != label[row]) & (np.arange(end - start) > row)
            others &= one_block | (mine != mine[row])
            differs = np.bitwise_or.reduce(group[others] ^ group[row], axis=1)
            near = np.flatnonzero(others)[np.bitwise_count(differs).sum(axis=1) <= settings.most_different]
            if not len(near):
                continue
            its = codes[begins[row] : begins[row] + sizes[row]]
            marked[its] = 1
            shared = np.add.reduceat(marked[codes], begins, dtype=np.int64)[near]
            marked[its] = 0
            linked = near[100 * shared >= settings.percent * (sizes[near] + sizes[row] - shared)]
            for other in linked:
                if label[other] != label[row]:
                    a, b = nodes[start + row], nodes[start + other]
                    found.append((min(a, b), max(a, b)))
                    label[label == label[other]] = label[row]
    kind = rows.schema.field("node").type
    return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], kind) for k in range(2)], names=["a", "b"])


def near_links(documents: DataFrame, marked: DataFrame, key: str, text: str, settings: Settings) -> DataFrame:
    """Links (a, b) between different sets that leave no two linked sets unconnected.

    `marked` is the stored result of `signed`. Within each bucket of a band, members are tried against
    one of them, then against another; after that all members of different components are compared by
    signature, and likely pairs by their sets.
    """
    classes = marked.where(F.col("n_shingles") > 0).where(F.col("node").isNotNull())
    nodes = stored(
        classes.groupBy("n_shingles", "digest", "digest2").agg(
            F.min("node").alias("node"), F.first("bands").alias("bands"), F.first("planes").alias("planes")
        )
    )
    rows = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count("*").alias("members")).where(F.col("members") > 1)
    buckets = stored(rows.join(shared.select("bucket"), "bucket").select("bucket", "node"))
    wanted = buckets.select(F.col("node").alias(key)).distinct()

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, texts in slices(batch, text):
                blobs = [s.tobytes() for s in shingle_sets(texts, settings.shingle)]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(blobs, pa.binary())], names=["node", "set"])
            give_back()

    schema = T.StructType([nodes.schema["node"], T.StructField("set", T.BinaryType())])
    sets = stored(documents.select(key, text).join(wanted, key, "left_semi").mapInArrow(sets_of, schema))

    links, components = None, None
    for number in range(settings.stars):
        pairs = _star_pairs(_with_component(buckets, components), number)
        new = stored(_linked(pairs, nodes, sets, settings))
        links = new if links is None else links.unionByName(new)
        components = stored(connected(links))
    return links.unionByName(stored(_block_links(_with_component(buckets, components), nodes, sets, settings)))


def near_duplicates(
    documents: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """`key`, n_shingles, component_id and kept of every row.

    Texts are linked when their sets of word shingles (A-Z lower-cased, words between 0x20 and 0x09 to
    0x0D) share at least `percent` of their union. component_id is the least key that links reach, the
    row's own if none; kept marks it. Texts that are null, empty or without words have no shingles and no
    links. Equal texts and equal keys are linked; a row with a null key keeps a null component and is kept.
    Other columns are not looked at, and an empty table gives an empty result.
    """
    marked = stored(signed(documents, key, text, settings))
    links = near_links(documents, marked, key, text, settings)
    named = marked.where((F.col("n_shingles") > 0) & F.col("node").isNotNull())
    first = named.groupBy("n_shingles", "digest", "digest2").agg(F.min("node").alias("first"))
    copies = named.join(first, ["n_shingles", "digest", "digest2"]).where(F.col("node") != F.col("first"))
    found = connected(links.unionByName(copies.select(F.col("node").alias("a"), F.col("first").alias("b"))))
    judged = marked.select("node", "n_shingles").join(found, "node", "left")
    component = F.coalesce("component", "node")
    return judged.select(
        F.col("node").alias(key),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("node"), F.lit(True)).alias("kept"),
    )
