"""Texts as one run of bytes for numpy: slices of bounded size, words and their hashes."""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 * 2**20
LONG_SPAN = 512
_SEED = 0x9E3779B97F4A7C15  # any odd number
_SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_IS_SPACE = np.isin(np.arange(256), np.frombuffer(_SPACES, np.uint8))


def slices(batch: pa.RecordBatch, text: str, most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Rows of a batch with their texts as UTF-8 (null: empty), some megabytes at a time, one row at least."""
    column = batch.column(batch.schema.get_field_index(text))
    sizes = np.array([n or 0 for n in pc.binary_length(column).to_pylist()], dtype=np.int64)
    start, total = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if row > start and total + size > most:
            yield _part(batch, column, start, row)
            start, total = row, 0
        total += size
    if batch.num_rows > start:
        yield _part(batch, column, start, batch.num_rows)


def _part(batch: pa.RecordBatch, column: pa.Array, start: int, end: int) -> tuple[pa.RecordBatch, list[bytes]]:
    texts = column.slice(start, end - start).cast(pa.binary()).to_pylist()
    return batch.slice(start, end - start), [t or b"" for t in texts]


def give_back() -> None:
    """Return freed memory to the system; a worker would keep it through whatever it runs next."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim is not None:
        trim(0)


def mixed(values: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of a byte run: eight bytes at a time, each mixed into what came before.

    Spans beyond LONG_SPAN bytes are rare and go through BLAKE2 one by one.
    """
    sizes = (ends - starts).astype(np.int64)
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    eights = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    hashes = mixed(sizes.astype(np.uint64) + np.uint64(_SEED))
    short = sizes <= LONG_SPAN
    open_, at = np.flatnonzero(short & (sizes > 0)), 0
    while len(open_):
        left = sizes[open_] - at
        part = eights[starts[open_] + at]
        last = left < 8
        part[last] &= (np.uint64(1) << (left[last] * 8).astype(np.uint64)) - np.uint64(1)
        hashes[open_] = mixed((hashes[open_] ^ part) * np.uint64(_SEED))
        at += 8
        open_ = open_[left > 8]
    for span in np.flatnonzero(~short):
        digest = hashlib.blake2b(data[starts[span] : ends[span]].tobytes(), digest_size=8).digest()
        hashes[span] = int.from_bytes(digest, "little")
    return hashes


class Words(NamedTuple):
    """Words of several texts: bytes, spans, hashes, and the text of each word."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    texts: np.ndarray
    counts: np.ndarray


def words(texts: Iterable[bytes], lower: bool = True) -> Words:
    """Runs of bytes other than 0x20 and 0x09 to 0x0D, in order, with A-Z lower-cased if `lower`."""
    texts = list(texts)
    joined = b" ".join(texts)
    data = np.frombuffer((joined.translate(LOWER) if lower else joined) + b" ", np.uint8)
    space = _IS_SPACE[data]
    inside = ~space
    starts = np.flatnonzero(inside & np.concatenate(([True], space[:-1])))
    ends = np.flatnonzero(space & np.concatenate(([False], inside[:-1])))
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    bounds = np.cumsum(sizes)
    owner = np.searchsorted(bounds, starts, side="right")
    return Words(
        data, starts, ends, span_hashes(data, starts, ends), owner, np.bincount(owner, minlength=len(texts))
    )
