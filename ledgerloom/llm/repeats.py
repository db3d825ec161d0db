"""Periodic runs of words: suffix classes united by falling common prefix, neighbours in them seeding runs."""

from __future__ import annotations

from bisect import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerloom.llm.textbytes import mixed, slices, words

SHORT = 512  # positions in one list of an ordered set, twice as many at most


class Positions:
    """An ordered set of places that grows by single ones; kept in short lists, so that no insertion moves many."""

    __slots__ = ("parts", "firsts", "size")

    def __init__(self, first: int):
        self.parts, self.firsts, self.size = [[first]], [first], 1

    def __iter__(self) -> Iterator[int]:
        for part in self.parts:
            yield from part

    def insert(self, place: int) -> tuple[int, int]:
        """The neighbours before and after the new place, -1 where there is none."""
        number = max(bisect(self.firsts, place) - 1, 0)
        part = self.parts[number]
        at = bisect(part, place)
        part.insert(at, place)
        self.size += 1
        if at:
            before = part[at - 1]
        else:
            self.firsts[number] = place
            before = self.parts[number - 1][-1] if number else -1
        if at + 1 < len(part):
            after = part[at + 1]
        else:
            after = self.firsts[number + 1] if number + 1 < len(self.parts) else -1
        if len(part) > 2 * SHORT:
            self.parts.insert(number + 1, part[SHORT:])
            self.firsts.insert(number + 1, part[SHORT])
            del part[SHORT:]
        return before, after


def suffix_order(ids: np.ndarray) -> np.ndarray:
    """Starts of suffixes, those with a common beginning side by side; ids are from 1."""
    rank, step = ids.astype(np.int64), 1
    while True:
        after = np.zeros(len(rank), np.int64)
        after[:-step] = rank[step:]
        _, rank = np.unique(rank * (len(rank) + int(ids.max()) + 2) + after, return_inverse=True)
        rank += 1
        step *= 2
        if rank.max() == len(rank) or step >= len(rank):
            return np.argsort(rank)


def common_prefixes(ids: list[int], order: list[int], active: list[bool]) -> list[int]:
    """Words that each suffix shares with the one before it in order; 0 for those that are not `active`.

    In text order, a suffix shares at most one word less than the one before it did.
    """
    place, size = [0] * len(order), len(order)
    for number, start in enumerate(order):
        place[start] = number
    shared, have = [0] * size, 0
    for start in range(size):
        number = place[start]
        if not active[start] or not number:
            have = 0
            continue
        other = order[number - 1]
        most = size - max(start, other)
        while have < most and ids[start + have] == ids[other + have]:
            have += 1
        shared[number] = have
        have = max(have - 1, 0)
    return shared


def find_runs(ids: np.ndarray, active: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period; ids are words as numbers from 1.

    A run has its smallest period twice and `least` words at least, and neither neighbour goes on with it.
    `active` marks starts that share their next (least + 1) // 2 words with another; no others matter,
    as a run of that length and its shift by a period share so many.

    Classes of suffixes are united by falling common prefix, Kruskal's way. Places that become neighbours
    in their class at a prefix no shorter than their distance d lie in a run of period d: one between them
    would have met either before. The run ends where the prefix of the later one does, and starts at the
    first such place with that end.
    """
    order = suffix_order(ids).tolist()
    shared = common_prefixes(ids.tolist(), order, active.tolist())
    lengths = np.array(shared)
    edges = np.flatnonzero(lengths >= (least + 1) // 2)
    edges = edges[np.argsort(-lengths[edges], kind="stable")].tolist()
    parent: dict[int, int] = {}
    sets: dict[int, Positions] = {}
    follows: dict[int, int] = {}
    runs: dict[tuple[int, int], int] = {}

    def root(place: int) -> int:
        top = place
        while (up := parent.get(top, top)) != top:
            top = up
        while place != top:
            parent[place], place = top, parent.get(place, place)
        return top

    number = 0
    while number < len(edges):
        prefix, met = shared[edges[number]], {}  # places with new followers, and the ones they had
        while number < len(edges) and shared[edges[number]] == prefix:
            at = edges[number]
            number += 1
            one, two = root(order[at - 1]), root(order[at])
            left, right = sets.pop(one, None) or Positions(one), sets.pop(two, None) or Positions(two)
            if left.size < right.size:
                one, two, left, right = two, one, right, left
            parent[two] = one
            sets[one] = left
            for place in right:
                before, after = left.insert(place)
                met.setdefault(place, follows.get(place))
                if before >= 0:
                    met.setdefault(before, follows.get(before))
                    follows[before] = place
                if after >= 0:
                    follows[place] = after
        # new neighbours once all classes of this prefix are united
        for place, had in met.items():
            distance = follows.get(place, place) - place
            if 0 < distance <= prefix and follows[place] != had:
                key = (distance, follows[place] + prefix)
                runs[key] = min(place, runs.get(key, place))
    return sorted((start, end - start, d) for (d, end), start in runs.items() if end - start >= least)


def _recurring(hashes: np.ndarray, owner: np.ndarray, size: int) -> np.ndarray:
    """Whether the next `size` words of a place come again in its text."""
    out = np.zeros(len(hashes), bool)
    starts = np.arange(max(0, len(hashes) - size + 1))
    starts = starts[owner[starts] == owner[starts + size - 1]] if len(starts) else starts
    keys = mixed(owner[starts].astype(np.uint64))
    for step in range(size):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + hashes[starts + step])
    _, which, counts = np.unique(keys, return_inverse=True, return_counts=True)
    out[starts] = counts[which] > 1
    return out


def _judged(texts: list[bytes], least: int) -> tuple[np.ndarray, list[list[dict]], list[str]]:
    found = words(texts, lower=False)
    raw, upto = found.data.tobytes(), np.concatenate(([0], np.cumsum(found.counts)))
    again = _recurring(found.hashes, found.texts, (least + 1) // 2)
    runs, collapsed = [], []
    for begin, end in zip(upto[:-1].tolist(), upto[1:].tolist()):
        own, active, kept = [], again[begin:end], np.ones(end - begin, bool)
        if active.any():
            ids = np.unique(found.hashes[begin:end], return_inverse=True)[1] + 1
            own = find_runs(ids, active, least)
            gone = np.zeros(end - begin + 1, np.int64)
            for start, length, period in own:
                gone[start + period] += 1
                gone[start + length] -= 1
            kept = np.cumsum(gone)[:-1] == 0
        spans = zip(found.starts[begin:end][kept].tolist(), found.ends[begin:end][kept].tolist())
        collapsed.append(b" ".join([raw[a:b] for a, b in spans]).decode())
        runs.append([{"start": s, "length": n, "period": p} for s, n, p in own])
    return found.counts, runs, collapsed


def periodic_runs(documents: DataFrame, key: str = "doc_id", text: str = "text", least: int = 12) -> DataFrame:
    """`key`, n_words, runs (start, length and period, by start, then period) and collapsed of every row.

    Words lie between 0x20 and 0x09 to 0x0D and count from 0. A run is a stretch of at least `least` words,
    and two periods, that repeats itself every `period` words, the smallest such number, and that neither
    neighbour extends. `collapsed` has the words outside all runs and the first period of each run, unless
    another run drops them, with single spaces between.

    Texts are whole and each is judged by itself, in memory of a fixed multiple of its size. Null, empty and
    wordless texts have no words, no runs and an empty `collapsed`. Repeated rows and null keys give a row
    each, other columns are not read, and an empty table gives an empty result.
    """
    run_kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in slices(batch, text):
                counts, runs, collapsed = _judged(texts, least)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(counts, pa.int64()), pa.array(runs, run_kind), pa.array(collapsed, pa.string())],
                    names=[key, "n_words", "runs", "collapsed"],
                )

    kind = documents.schema[key].dataType.simpleString()
    parts = "array<struct<start:long,length:long,period:long>>"
    return documents.select(key, text).mapInArrow(judge, f"`{key}` {kind}, n_words long, runs {parts}, collapsed string")
