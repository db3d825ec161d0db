"""Packing of token sequences into windows by non-negative least squares.

Whole windows of a document stand alone. What remains of the documents of a block is counted by length;
combinations of two or three lengths that fill a window exactly are enumerated, and non-negative least
squares says how often to repeat each so that they use up the counts. Rounded down to what is there, they
fill windows without padding. The pieces left over are packed greedily, the longest first; where no piece
fits a gap, one is cut to fill it. At most the last window of a block is padded.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerloom.llm.textbytes import give_back

WINDOW = 1024
BLOCK_DOCUMENTS = 20_000
PARTNERS = 8  # lengths that are tried as the second of three, for each first one
SWEEPS = 20
PIECES = 20_000  # at most so many pieces, or
PIECE_BYTES = 4 * 2**20  # about so many bytes of them, are kept back


def combinations(counts: Counter, window: int, partners: int = PARTNERS) -> list[tuple[int, ...]]:
    """Two and three present lengths that make up the window. Threes take a common second length."""
    found = {(a, window - a) for a in counts if 2 * a <= window and counts[window - a]}
    common = [n for n, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:partners]]
    for a in counts:
        for b in (*common, (window - a) // 2):
            c = window - a - b
            if b > 0 and c > 0 and counts[b] and counts[c]:
                found.add(tuple(sorted((a, b, c))))
    return sorted(found)


def solve_repeats(combos: list[tuple[int, ...]], counts: Counter, sweeps: int = SWEEPS) -> np.ndarray:
    """Non-negative least squares by coordinate descent: repeats whose lengths add up to the counts."""
    left = {n: float(c) for n, c in counts.items()}
    columns = [tuple(Counter(c).items()) for c in combos]
    norms = [sum(k * k for _, k in column) for column in columns]
    repeats = [0.0] * len(columns)
    for _ in range(sweeps):
        moved = 0.0
        for j, column in enumerate(columns):
            step = sum(k * left[n] for n, k in column) / norms[j]
            step = max(step, -repeats[j])
            if step:
                repeats[j] += step
                moved = max(moved, abs(step))
                for n, k in column:
                    left[n] -= k * step
        if moved < 0.05:
            break
    return np.array(repeats)


def pack_lengths(lengths: list[int], window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Windows of (item, start in the item, length); items are shorter than the window."""
    waiting: dict[int, list[int]] = defaultdict(list)
    for item, length in enumerate(lengths):
        waiting[length].append(item)
    counts = Counter(lengths)
    combos = combinations(counts, window)
    repeats = solve_repeats(combos, counts)
    windows = []
    for j in np.argsort(-repeats, kind="stable"):
        need = Counter(combos[j])
        for _ in range(min(int(repeats[j] + 0.5), *(len(waiting[n]) // k for n, k in need.items()))):
            windows.append([(waiting[n].pop(), 0, n) for n in combos[j]])
    pool = sorted((n, item, 0) for n, items in waiting.items() for item in items)
    while pool:
        length, item, start = pool.pop()
        made, gap = [(item, start, length)], window - length
        while gap and pool:
            place = bisect_right(pool, (gap, len(lengths), 0)) - 1
            if place >= 0:
                length, item, start = pool.pop(place)
            else:
                whole, item, start = pool.pop()
                length = gap
                insort(pool, (whole - gap, item, start + gap))
            made.append((item, start, length))
            gap -= length
        windows.append(made)
    return windows


def pack_sequences(
    encoded: DataFrame,
    key: str = "doc_id",
    ids: str = "ids",
    separator: int | None = 0,
    window: int = WINDOW,
    block_documents: int = BLOCK_DOCUMENTS,
) -> DataFrame:
    """One row per piece: `key`, start, length, ids, doc_tokens, sequence_id, offset.

    `separator` is put at the end of every document (None: nothing is). ids holds the piece's ids as
    little-endian unsigned 32-bit numbers, start counts its document's ids before it, doc_tokens all of
    them, and offset its place in its sequence, whose ids are contiguous from 0. Each id is in exactly
    one piece. Every task packs its own rows, up to `block_documents` at a time, so nothing is shuffled;
    sequence numbers carry the task's number in their upper bits.

    Null or empty ids leave only the separator, and no row at all without one. Documents of equal length,
    repeated rows and null keys are packed each on their own; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = iter(range(TaskContext.get().partitionId() << 32, 1 << 62))
        keys, rests, totals, bytes_out = [], [], [], 0
        out: list[tuple] = []

        def flush_rests() -> Iterator[pa.RecordBatch]:
            for made in pack_lengths([len(r) for r in rests], window):
                number, offset = next(numbers), 0
                for item, start, length in made:
                    before = totals[item] - len(rests[item]) + start
                    piece = rests[item][start : start + length].tobytes()
                    out.append((keys[item], before, length, piece, totals[item], number, offset))
                    offset += length
                yield from full_batches(4 * offset)
            for some in (keys, rests, totals):
                some.clear()

        def full_batches(more: int) -> Iterator[pa.RecordBatch]:
            nonlocal bytes_out
            bytes_out += more
            if bytes_out > PIECE_BYTES or len(out) > PIECES:
                yield batch_of(out)
                bytes_out = 0

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows) if rows else [[]] * 7
            made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)
            rows.clear()
            return made

        for batch in batches:
            column = batch.column(1)
            flat = column.flatten().to_numpy(zero_copy_only=False)
            sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
            ends = np.cumsum(sizes)
            for name, end, size in zip(batch.column(0).to_pylist(), ends.tolist(), sizes.tolist()):
                own = flat[end - size : end].astype("<u4")
                if separator is not None:
                    own = np.append(own, np.array(separator, "<u4"))
                whole = len(own) - len(own) % window
                for start in range(0, whole, window):
                    piece = own[start : start + window].tobytes()
                    out.append((name, start, window, piece, len(own), next(numbers), 0))
                if len(own) > whole:
                    keys.append(name)
                    rests.append(own[whole:].copy())
                    totals.append(len(own))
                yield from full_batches(4 * whole)
                if len(rests) >= block_documents:
                    yield from flush_rests()
            del batch, column, flat
            give_back()
        yield from flush_rests()
        yield batch_of(out)
        give_back()

    long, binary = T.LongType(), T.BinaryType()
    kinds = {"start": long, "length": long, "ids": binary, "doc_tokens": long, "sequence_id": long, "offset": long}
    schema = T.StructType([encoded.schema[key], *(T.StructField(n, k) for n, k in kinds.items())])
    arrow = pa.schema([(f.name, _ARROW[f.dataType.typeName()]) for f in schema])
    return encoded.select(key, ids).mapInArrow(run, schema)


_ARROW = {
    "long": pa.int64(),
    "integer": pa.int32(),
    "string": pa.string(),
    "binary": pa.binary(),
}
