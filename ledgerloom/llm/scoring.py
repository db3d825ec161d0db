"""Language-model scores of whole texts under a hierarchical Pitman-Yor model of all training texts.

The context of a word is the word before it; its parent is a class of such words: short ones by themselves,
longer ones by their ending. Words are dealt to units by hash. Counts of pairs, summed within each task
first, meet in the unit of their word; pairs of held-out texts come along with a count of none, so that a unit
knows from the start which contexts it will be asked about. A sweep runs on each unit; units then exchange the
totals of real contexts through owners, to which contexts are dealt by hash, and those of classes, a fixed
number, through the driver. For scoring, the different pairs of a block of texts ask the units of their words,
which answer with probabilities found once for all their pairs; units that are asked much answer in several
tasks. Texts are scored in waves, so that no more than the questions of one wave are kept at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.pitman_yor import CONTEXTS, PER_PARENT, Seats, Shard, Totals, discount, places
from ledgerloom.llm.stored import discard, drop_shuffles, stored
from ledgerloom.llm.textbytes import Words, mixed, slices, words

END = np.uint64(0xE0D0_0000_0000_0100)
BLOCK_TOKENS = 1_000_000
UNIT_BYTES = 8 * 2**20  # of text, for each unit
QUESTION_BYTES = 8 * 2**20  # packed, for each task that answers
FLAT, STATE, COUNTS, TOKENS = -1, -2, -3, -4  # kinds of rows that are no unit's


@dataclass(frozen=True)
class Settings:
    """Gibbs sweeps, the last of them that are averaged, and the waves in which texts are scored.

    Any number of waves gives the same scores.
    """

    sweeps: int = 3
    averaged: int = 2
    waves: int = 3
    seed: int = 5


def _pack(keys: np.ndarray, *columns: np.ndarray) -> bytes:
    """Ordered keys and small numbers beside them, in little space."""
    steps = np.diff(keys, prepend=np.uint64(0))
    parts = [steps.view(np.uint8).reshape(-1, 8).T.tobytes()]
    parts += [np.ascontiguousarray(c, np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def _unpack(blob: bytes, columns: int = 1) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    count = len(raw) // (8 + 4 * columns)
    steps = np.ascontiguousarray(raw[: 8 * count].reshape(8, count).T).view(np.uint64).ravel()
    rest = [raw[(8 + 4 * c) * count : (12 + 4 * c) * count].reshape(4, count).T for c in range(columns)]
    return [np.cumsum(steps, dtype=np.uint64), *(np.ascontiguousarray(r).view(np.uint32).ravel() for r in rest)]


def contexts(found: Words) -> np.ndarray:
    """The class of every word as context of the next: by itself up to three bytes, else by its ending."""
    last, before = found.data[found.ends - 1].astype(np.uint64), found.data[found.ends - 2].astype(np.uint64)
    parent = mixed(last) % np.uint64(CONTEXTS // PER_PARENT)
    short = found.ends - found.starts <= 3
    own = np.where(short, found.hashes, mixed(before << np.uint64(8) | last)) % np.uint64(PER_PARENT)
    return (parent * np.uint64(PER_PARENT) + own).astype(np.uint64)


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Key (word and class), word before and text of every token in order, and their number by text.

    Texts end with END; before the first word there is none: 0.
    """
    found = words(texts)
    counts = found.counts + 1
    ends = np.cumsum(counts) - 1
    keys = np.empty(counts.sum(), np.uint64)
    inner = np.ones(len(keys), bool)
    inner[ends] = False
    keys[inner], keys[ends] = found.hashes, END
    context, before = np.zeros(len(keys), np.uint64), np.zeros(len(keys), np.uint32)
    after = np.flatnonzero(inner) + 1
    context[after], before[after] = contexts(found), found.hashes.astype(np.uint32)
    return (keys & ~np.uint64(255)) | context, before, np.repeat(np.arange(len(texts)), counts), counts


def _ordered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order of the values, the rank of each among the different ones, and those."""
    order = np.argsort(values)
    inner = values[order]
    new = np.ones(len(values), bool)
    new[1:] = inner[1:] != inner[:-1]
    place = np.empty(len(values), np.int64)
    place[order] = np.cumsum(new) - 1
    return order, place, inner[new]


def summed(
    keys: np.ndarray, before: np.ndarray, counts: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Different pairs in order, their counts, and the place there of every pair."""
    order, place, _ = _ordered(keys)
    order = np.argsort(place.astype(np.uint64) << np.uint64(32) | before)
    counts = np.ones(len(keys), np.int64) if counts is None else counts.astype(np.int64)
    keys, before = keys[order], before[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (before[1:] != before[:-1])
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(new) - 1
    starts = np.flatnonzero(new)
    sums = np.add.reduceat(counts[order], starts) if len(starts) else np.zeros(0, np.int64)
    return keys[starts], before[starts], sums, place


def _wide(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers that may pass 32 bits, as two columns."""
    whole = values.astype(np.uint64)
    return whole & np.uint64(0xFFFFFFFF), whole >> np.uint64(32)


def _whole(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return low.astype(np.int64) | high.astype(np.int64) << 32


def _pack_columns(*columns: np.ndarray) -> bytes:
    """32-bit numbers, or floats, of equal lengths."""
    parts = [np.ascontiguousarray(c).view(np.uint8).reshape(-1, 4).T.tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def _unpack_columns(blob: bytes, columns: int) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(columns, 4, -1)
    return [np.ascontiguousarray(c.T).view(np.uint32).ravel() for c in raw]


def _unit(keys: np.ndarray, units: int) -> np.ndarray:
    """Units, and owners, take ranges of hashes, so ordered keys come unit by unit."""
    return ((keys >> np.uint64(32)) * np.uint64(units)) >> np.uint64(32)


def _by_unit(keys: np.ndarray, units: int) -> list[tuple[int, int, int]]:
    """(unit, start, end) of ordered keys."""
    own = _unit(keys, units)
    starts = np.flatnonzero(np.diff(own.astype(np.int64), prepend=-1))
    return list(zip(own[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(keys)]))


HELD = "unit int, step int, kind int, blob binary"
SAID = "unit int, kind int, blob binary, flat array<double>"


def count_words(documents: DataFrame, text: str, units: int) -> DataFrame:
    """Rows of SAID: for each unit all pairs in the documents, how often texts not held out have them, and the first state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            keys, before, counts, _ = summed(*(np.concatenate(c) for c in zip(*waiting)))
            waiting.clear()
            rows = [(unit, _pack(keys[a:b], before[a:b], counts[a:b])) for unit, a, b in _by_unit(keys, units)]
            return pa.RecordBatch.from_pydict(
                {"unit": pa.array([r[0] for r in rows], pa.int32()), "blob": pa.array([r[1] for r in rows], pa.binary())}
            )

        for batch in batches:
            for some, texts in slices(batch, text):
                learned = ~np.asarray(some.column(some.schema.get_field_index("held_out")).to_pylist(), bool)
                keys, before, _, counts = tokens(texts)
                waiting.append((keys, before, np.repeat(learned, counts)))
                if sum(len(w[0]) for w in waiting) >= BLOCK_TOKENS:
                    yield flush()
        if waiting:
            yield flush()

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        parts = [_unpack(blob, 2) for blob in group["blob"]]
        keys, before, counts, _ = summed(*(np.concatenate(c) for c in zip(*parts)))
        number, blob = int(group["unit"].iloc[0]), _pack(keys, before, *_wide(counts))
        said = _said(number, _Unit(pd.DataFrame({"step": [-1], "kind": [COUNTS], "blob": [blob]})), 0, units)
        return pd.concat([pd.DataFrame([(number, COUNTS, blob, None)], columns=said.columns), said])

    parts = documents.select(text, "held_out").mapInArrow(run, "unit int, blob binary")
    return stored(parts.groupBy("unit").applyInPandas(merge, SAID))


class _Unit:
    """What the rows of HELD of one unit say."""

    def __init__(self, rows: pd.DataFrame):
        self.blobs = {(s, k): b for s, k, b in zip(rows["step"], rows["kind"], rows["blob"])}
        keys, before, low, high = _unpack(self.blobs[-1, COUNTS], 3)
        _, self.place, self.places = _ordered(places(keys, before))
        counts = _whole(low, high)
        learned = counts > 0
        self.keys, self.before, self.learned = keys, before, self.place[learned]
        self.seats = Seats(keys[learned], before[learned], counts[learned])

    def _sums(self, step: int, column: int) -> np.ndarray:
        owners = sorted(k for s, k in self.blobs if s == step and k >= 0)
        parts = [_unpack_columns(self.blobs[step, k], _sent(step))[2 * column :][:2] for k in owners]
        return _whole(*(np.concatenate(c) for c in zip(*parts)))

    def customers(self) -> np.ndarray:
        """Of the contexts at its places, in any state."""
        return self._sums(0, 1)

    def go(self, step: int) -> np.ndarray:
        """To the state after a sweep; tables of the contexts at its places then."""
        state = _whole(*_unpack_columns(self.blobs[step, STATE], 2))
        self.seats.take(*np.split(state, np.cumsum([len(s) for s in self.seats.state()])[:-1]))
        return self._sums(step, 0)


def _sent(step: int) -> int:
    """Columns that units say of contexts: tables after each sweep, and customers, which stay, before the first."""
    return 2 if step else 4


def _said(number: int, own: _Unit, step: int, units: int) -> pd.DataFrame:
    """What a unit says after a sweep, as rows of SAID: its state, totals of classes, and those of contexts to owners."""
    seats, n = own.seats, len(own.places)
    sums = [
        c.astype(np.uint32)
        for values in ((seats.tables,) if step else (seats.tables, seats.customers))
        for c in _wide(np.bincount(own.learned, values, n))
    ]
    served = [(seats.customers == 1).sum(), (seats.customers == 2).sum(), seats.customers.sum()]
    flat = np.concatenate([seats.shard.totals().flat(), np.array(served, float)])
    state = _pack_columns(*(c.astype(np.uint32) for c in _wide(np.concatenate(seats.state()))))
    out = [(number, FLAT, None, flat), (number, STATE, state, None)]
    out += [
        (number, owner, _pack(own.places[a:b], *(c[a:b] for c in sums)), None)
        for owner, a, b in _by_unit(own.places, units)
    ]
    return pd.DataFrame(out, columns=["unit", "kind", "blob", "flat"])


def gibbs(first: DataFrame, units: int, settings: Settings) -> tuple[DataFrame, list[np.ndarray]]:
    """States of the units and totals of their contexts, as rows of HELD, before the first sweep and for those averaged.

    And totals of classes over all units before the first sweep and after each one, followed by the numbers of
    pairs met once and twice and of tokens.
    """
    history: list[np.ndarray] = []
    held = _counts(first)
    kept: DataFrame | None = None
    size = len(Shard(np.zeros(0, np.uint64), np.zeros(0, np.int64)).totals().flat()) + 3
    last: DataFrame | None = None

    def sweep_to(step: int, before: np.ndarray):
        def sweep(rows: pd.DataFrame) -> pd.DataFrame:
            number, own = int(rows["unit"].iloc[0]), _Unit(rows)
            tables = own.go(step - 1)
            totals, share = _split(before)
            random = np.random.default_rng((settings.seed, step - 1, number))
            own.seats.sweep(totals, share, tables[own.learned], random)
            return _said(number, own, step, units)

        return sweep

    for step in range(settings.sweeps + 1):
        if step:
            rows = held.unionByName(last).groupBy("unit")
            said = stored(rows.applyInPandas(sweep_to(step, history[-1]), SAID))
        else:
            said = first
        if 1 < step <= settings.sweeps - settings.averaged + 1:
            discard(last)
        each = said.where(F.col("kind") == FLAT).select(F.posexplode("flat").alias("place", "value"))
        flat = np.zeros(size)
        for row in each.groupBy("place").agg(F.sum("value").alias("value")).collect():
            flat[row["place"]] = row["value"]
        history.append(flat)
        answers = said.where("kind >= 0").groupBy("kind").applyInPandas(add_contexts(step), HELD.replace("step int, ", ""))
        states = said.where(F.col("kind") == STATE).select("unit", "kind", "blob")
        found = states.unionByName(answers).select("unit", F.lit(step).alias("step"), "kind", "blob")
        last = stored(found)
        if step:
            discard(said)
        drop_shuffles(held.sparkSession)
        if not step or step > settings.sweeps - settings.averaged:
            kept = last if kept is None else kept.unionByName(last)
    return kept, history


def _counts(first: DataFrame) -> DataFrame:
    """The pairs of all units, as rows of HELD."""
    return first.where(F.col("kind") == COUNTS).select("unit", F.lit(-1).alias("step"), "kind", "blob")


def _split(flat: np.ndarray) -> tuple[Totals, float]:
    """Totals of classes, and the discount of real contexts."""
    return Totals.of(flat[:-3]), discount(flat[-3], flat[-2])


def add_contexts(step: int):
    """Of one owner's contexts the sums over all units, to every unit that named them, in its order."""

    def add(group: pd.DataFrame) -> pd.DataFrame:
        columns = _sent(step)
        parts = [_unpack(blob, columns) for blob in group["blob"]]
        _, place, known = _ordered(np.concatenate([p[0] for p in parts]))
        sums = []
        for k in range(1, columns, 2):
            total = np.zeros(len(known), np.int64)
            np.add.at(total, place, np.concatenate([_whole(p[k], p[k + 1]) for p in parts]))
            sums += [c.astype(np.uint32) for c in _wide(total)]
        ends = np.cumsum([len(p[0]) for p in parts])
        blobs = [_pack_columns(*(c[place[b - len(p[0]) : b]] for c in sums)) for p, b in zip(parts, ends)]
        return pd.DataFrame({"unit": group["unit"].to_numpy(), "kind": group["kind"].to_numpy(), "blob": blobs})

    return add


def score_documents(
    documents: DataFrame,
    held_out: Column,
    key: str = "doc_id",
    text: str = "text",
    settings: Settings = Settings(),
) -> DataFrame:
    """`key`, held_out, n_tokens, n_known, train_tokens, base_score, score and perplexity of every row.

    Texts are lower-cased (A-Z) and cut into words at 0x20 and 0x09 to 0x0D; one end follows and counts as
    a token. The model learns from all rows where `held_out` is false. score is the log10 probability of
    the text under it, all unknown words sharing that of a new word after the same word, averaged over the last sweeps for each
    token; perplexity is 10 ^ (-score / n_tokens). base_score is the sum over tokens of
    log10((c + 0.5) / (N + 0.5 * (V + 1))), n_known the number of tokens with c > 0, train_tokens is N.

    A null text counts as empty: its end is its only token. A null `held_out` counts as false. Repeated
    rows and null keys are scored each; without training texts every token is unknown and has probability
    one. Other columns are not read; an empty table gives an empty result. `documents` is read several
    times; texts that differ between readings raise an error.
    """
    held = F.coalesce(held_out, F.lit(False))
    rows = documents.select(F.col(key), F.col(text), held.alias("held_out"))
    size = rows.select(F.sum(F.octet_length(text))).first()[0] or 0
    units = max(1, -(-size // UNIT_BYTES))
    first = count_words(rows, text, units)
    drop_shuffles(documents.sparkSession)
    kept, history = gibbs(first, units, settings)
    train_tokens, known_words = int(history[-1][-1]), _split(history[-1])[0].root[1]
    whole = np.log10(train_tokens + 0.5 * (known_words + 1))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of texts, the pair of each of their tokens, and the different pairs, unit by unit, as questions."""
        numbers = iter(range(TaskContext.get().partitionId() << 32, 1 << 62))
        waiting: list[tuple] = []

        def flush() -> pa.RecordBatch:
            block = next(numbers)
            keys, before, _, place = summed(*(np.concatenate([w[k] for w in waiting]) for k in (1, 2)))
            count = np.concatenate([w[3] for w in waiting])
            asked = [(TOKENS, _pack_columns(place.astype(np.uint32)))]
            asked += [(u, _pack(keys[a:b], before[a:b])) for u, a, b in _by_unit(keys, units)]
            names = pa.concat_arrays([w[0].column(0) for w in waiting])
            held = pa.concat_arrays([w[0].column(2) for w in waiting])
            waiting.clear()
            n, m = len(count), len(asked)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([block] * (n + m), pa.int64()),
                    pa.array([None] * n + [u for u, _ in asked], pa.int32()),
                    pa.array([None] * n + [b for _, b in asked], pa.binary()),
                    pa.concat_arrays([names, pa.nulls(m, names.type)]),
                    pa.concat_arrays([held, pa.nulls(m, held.type)]),
                    pa.concat_arrays([pa.array(np.arange(n), pa.int32()), pa.nulls(m, pa.int32())]),
                    pa.concat_arrays([pa.array(count, pa.int64()), pa.nulls(m, pa.int64())]),
                ],
                names=asked_schema.names,
            )

        for batch in batches:
            for some, texts in slices(batch, text):
                keys, before, _, count = tokens(texts)
                waiting.append((some, keys, before, count))
                if sum(len(w[1]) for w in waiting) >= BLOCK_TOKENS:
                    yield flush()
        if waiting:
            yield flush()

    kinds = {
        "block": T.LongType(),
        "unit": T.IntegerType(),
        "blob": T.BinaryType(),
        "key": rows.schema[key].dataType,
        "held_out": T.BooleanType(),
        "place": T.IntegerType(),
        "n_tokens": T.LongType(),
    }
    asked_schema = T.StructType([T.StructField(n, k) for n, k in kinds.items()])

    def judge(held: pd.DataFrame) -> pd.DataFrame:
        """Log probability of each pair of a unit, and the count of its word."""
        own = _Unit(held)
        found, customers = own.seats.find(own.keys, own.before), own.customers()[own.place]
        total = np.zeros(len(own.keys))
        for step in range(settings.sweeps - settings.averaged + 1, settings.sweeps + 1):
            tables = own.go(step)[own.place]
            totals, share = _split(history[step])
            total += own.seats.probabilities(own.keys, own.before, totals, share, customers, tables, found)
        logs = np.log10(total / settings.averaged).astype(np.float32)
        counted = np.where(found[0].known, own.seats.shard.word_counts[found[0].word], 0) if len(own.learned) else 0 * own.place
        blob = _pack(own.keys, own.before, logs.view(np.uint32), *_wide(counted))
        return pd.DataFrame({"unit": [held["unit"].iloc[0]], "blob": [blob]})

    judged = stored(_counts(first).unionByName(kept).groupBy("unit").applyInPandas(judge, "unit int, blob binary"))
    for table in (first, kept):
        discard(table)

    def answer(questions: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(questions):
            return pd.DataFrame(columns=["block", "unit", "blob"])
        keys, before, logs, low, high = _unpack(held["blob"].iloc[0], 4)
        _, rank, different = _ordered(keys)
        pairs = rank.astype(np.uint64) << np.uint64(32) | before
        blobs = []
        for blob in questions["blob"]:
            asked, after = _unpack(blob)
            asked = np.searchsorted(different, asked).astype(np.uint64) << np.uint64(32) | after
            place = np.searchsorted(pairs, asked)
            if place[-1] == len(pairs) or (pairs[place] != asked).any():
                raise ValueError("texts changed while they were scored")
            blobs.append(_pack_columns(logs[place], low[place], high[place]))
        return pd.DataFrame({"block": questions["block"].to_numpy(), "unit": questions["unit"].to_numpy(), "blob": blobs})

    def add_up(texts: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        texts, answers = texts.sort_values("place"), answers.sort_values("unit")
        place = _unpack_columns(answers["blob"].iloc[0], 1)[0]
        parts = [_unpack_columns(blob, 3) for blob in answers["blob"].iloc[1:]]
        logs, low, high = (np.concatenate(c) for c in zip(*parts))
        counted = _whole(low, high)
        n = texts["n_tokens"].to_numpy()
        owner = np.repeat(np.arange(len(n)), n)
        score = np.bincount(owner, logs.view(np.float32).astype(float)[place], len(n))
        return pd.DataFrame(
            {
                key: texts["key"].to_numpy(),
                "held_out": texts["held_out"].to_numpy(dtype=bool),
                "n_tokens": n,
                "n_known": np.bincount(owner, counted[place] > 0, len(n)).astype(np.int64),
                "train_tokens": np.int64(train_tokens),
                "base_score": np.bincount(owner, (np.log10(counted + 0.5) - whole)[place], len(n)),
                "score": score,
                "perplexity": 10.0 ** (-score / n),
            }
        )

    result = T.StructType([rows.schema[key]])
    for name, kind in (
        ("held_out", T.BooleanType()),
        ("n_tokens", T.LongType()),
        ("n_known", T.LongType()),
        ("train_tokens", T.LongType()),
        ("base_score", T.DoubleType()),
        ("score", T.DoubleType()),
        ("perplexity", T.DoubleType()),
    ):
        result = result.add(name, kind)

    def wave(number: int) -> DataFrame:
        """Scores of the texts of one wave."""
        own = rows.where(F.pmod(F.xxhash64(key, text), F.lit(settings.waves)) == number)
        asked = stored(own.mapInArrow(ask, asked_schema))
        questions = asked.where("unit >= 0").select("unit", "block", "blob")
        sizes = questions.groupBy("unit").agg(F.sum(F.octet_length("blob")).alias("size"))
        salts = stored(sizes.select("unit", F.ceil(F.col("size") / QUESTION_BYTES).cast("int").alias("salts")))
        drop_shuffles(documents.sparkSession)  # of the wave before, which Spark holds until another step has run
        salt = F.pmod(F.xxhash64("block"), "salts").cast("int")
        spread = questions.join(salts, "unit").withColumn("salt", salt).drop("salts")
        each = salts.select("unit", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
        answers = (
            spread.groupBy("unit", "salt").cogroup(judged.join(each, "unit").groupBy("unit", "salt"))
            .applyInPandas(answer, "block long, unit int, blob binary")
        )
        answers = answers.unionByName(asked.where(F.col("unit") == TOKENS).select("block", "unit", "blob"))
        texts = asked.where(F.col("unit").isNull()).drop("unit", "blob")
        scored = stored(texts.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(add_up, result))
        discard(asked)
        return scored

    return reduce(DataFrame.unionByName, [wave(number) for number in range(settings.waves)])
