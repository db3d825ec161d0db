"""Toxicity: a bidirectional recurrent network over words and their characters, for all overlapping windows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import gru
from ledgerloom.llm.sampling import lowest_hashes
from ledgerloom.llm.textbytes import SLICE_BYTES, give_back, mixed, words

WORD_BITS, CHAR_BITS = 18, 17
RUNS = (4, 5, 6, 7, 8)  # bytes
PRIOR = 10
FEATURE_ROWS = 1 << 14


@dataclass(frozen=True)
class Settings:
    """`rows_per_label` rows of up to `most_chars` characters are the bounded sample that is learned from."""

    rows_per_label: int = 1500
    most_chars: int = 20_000
    window: int = 32
    stride: int = 16
    hidden: int = 8
    embedding: int = 8
    rounds: int = 3
    steps: int = 120
    batch: int = 128
    rate: float = 0.005
    seed: int = 7


class Detector(NamedTuple):
    """Embeddings of hashed words and character runs, and the network."""

    words: np.ndarray
    chars: np.ndarray
    weights: gru.Weights
    settings: Settings


class _Read(NamedTuple):
    """Texts as numbers: the distinct words, their character runs, and the word at every place."""

    word_rows: np.ndarray
    char_rows: np.ndarray
    char_starts: np.ndarray
    which: np.ndarray
    counts: np.ndarray


def read(texts: list[bytes]) -> _Read:
    found = words(texts)
    _, first, which = np.unique(found.hashes, return_index=True, return_inverse=True)
    starts, ends = found.starts[first], found.ends[first]
    sizes = ends - starts
    data = np.concatenate(([0x20], np.where(found.data <= 0x20, 0x20, found.data), [0x20] * 8)).astype(np.uint8)
    eight = np.lib.stride_tricks.sliding_window_view(data, 8)
    # runs of bytes from the space before a word to the one after it: word, place, hash
    runs = []
    for length in RUNS:
        counts = np.maximum(sizes + 3 - length, length == RUNS[0])
        upto = np.cumsum(counts)
        own = np.repeat(np.arange(len(starts), dtype=np.int32), counts)
        places = np.arange(len(own)) - np.repeat(upto - counts, counts) + starts[own]
        whole = eight[places].view("<u8").ravel() & np.uint64((1 << 8 * length) - 1)
        values = mixed(whole) >> np.uint64(64 - CHAR_BITS)
        runs.append((own, values.astype(np.int32)))
    own = np.concatenate([r[0] for r in runs])
    order = np.argsort(own, kind="stable")
    counts = np.bincount(own, minlength=len(starts))
    word_rows = (found.hashes[first] >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    char_rows = np.concatenate([r[1] for r in runs])[order]
    return _Read(word_rows, char_rows, np.cumsum(counts) - counts, which, found.counts)


def parts_of(texts: list[bytes] | list[str], most: int = SLICE_BYTES // 2) -> Iterator[slice]:
    """Neighbouring texts of `most` bytes, or characters, together, one text at least."""
    start, size = 0, 0
    for row, content in enumerate(texts):
        if row > start and size + len(content) > most:
            yield slice(start, row)
            start, size = row, 0
        size += len(content)
    if texts:
        yield slice(start, len(texts))


def read_in_parts(texts: list[bytes]) -> _Read:
    """As `read`, with the working memory of one part; a word has a row in each part that holds it."""
    parts = [read(texts[part]) for part in parts_of(texts)] or [read(texts)]
    rows = np.cumsum([0, *(len(p.word_rows) for p in parts)])
    chars = np.cumsum([0, *(len(p.char_rows) for p in parts)])
    return _Read(
        np.concatenate([p.word_rows for p in parts]),
        np.concatenate([p.char_rows for p in parts]),
        np.concatenate([p.char_starts + first for p, first in zip(parts, chars)]),
        np.concatenate([p.which + first for p, first in zip(parts, rows)]),
        np.concatenate([p.counts for p in parts]),
    )


def features(detector: Detector, text: _Read) -> np.ndarray:
    """Of every distinct word: its embedding, and the largest of its character runs in each dimension."""
    if not len(text.word_rows):
        return np.zeros((0, 2 * detector.settings.embedding), np.float32)
    pooled, bounds = [], np.append(text.char_starts, len(text.char_rows))
    for k in range(0, len(text.word_rows), FEATURE_ROWS):
        starts = text.char_starts[k : k + FEATURE_ROWS]
        rows = text.char_rows[starts[0] : bounds[min(k + FEATURE_ROWS, len(text.word_rows))]]
        pooled.append(np.maximum.reduceat(detector.chars[rows], starts - starts[0], axis=0))
    return np.concatenate((detector.words[text.word_rows], np.concatenate(pooled)), axis=1)


def windows(counts: np.ndarray, size: int, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word (among all texts) and length of every window; the last one reaches the end."""
    number = np.where(counts > 0, np.maximum(-(-(counts - size) // stride), 0) + 1, 0)
    text = np.repeat(np.arange(len(counts)), number)
    place = np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number)
    start = place * stride
    return text, start + (np.cumsum(counts) - counts)[text], np.minimum(size, counts[text] - start)


def _window_inputs(table: np.ndarray, which: np.ndarray, start: np.ndarray, length: np.ndarray, size: int):
    """Word at each time and window, whether there is one, and what both directions read."""
    steps = np.arange(size)[:, None]
    mask = steps < length
    rows = which[np.minimum(start + np.where(mask, steps, 0), len(which) - 1)]
    inputs = np.stack((table[0][rows], table[1][rows[::-1]]))
    return rows, mask, inputs


def window_logits(detector: Detector, text: _Read, start, length, batch: int = 2048) -> np.ndarray:
    table = gru.projected(detector.weights, features(detector, text))
    out = np.empty(len(start), np.float32)
    for k in range(0, len(start), batch):
        some = slice(k, k + batch)
        _, mask, inputs = _window_inputs(table, text.which, start[some], length[some], detector.settings.window)
        out[some] = gru.forward(detector.weights, inputs, mask)
    return out


def _of_words(text: _Read, used: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The character runs of some words one after another, where each word's begin, and their number."""
    taken = np.diff(text.char_starts, append=len(text.char_rows))[used]
    begins = np.cumsum(taken) - taken
    return text.char_rows[np.arange(taken.sum()) + np.repeat(text.char_starts[used] - begins, taken)], begins, taken


def logits_in_parts(detector: Detector, text: _Read, start, length, most: int = 4096) -> np.ndarray:
    """As `window_logits` of windows in order, with inputs of only the words that `most` windows hold."""
    out = []
    for k in range(0, len(start), most):
        some, lengths = start[k : k + most], length[k : k + most]
        used, which = np.unique(text.which[some[0] : some[-1] + lengths[-1]], return_inverse=True)
        char_rows, begins, _ = _of_words(text, used)
        part = _Read(text.word_rows[used], char_rows, begins, which, text.counts)
        out.append(window_logits(detector, part, some - some[0], lengths))
    return np.concatenate(out)


def score_texts(detector: Detector, texts: list[bytes]) -> np.ndarray:
    """The likeliest window of each text decides; texts without words score 0."""
    text = read(texts)
    owner, start, length = windows(text.counts, detector.settings.window, detector.settings.stride)
    scores = np.zeros(len(texts))
    np.maximum.at(scores, owner, gru.sigmoid(window_logits(detector, text, start, length).astype(np.float64)))
    return scores


def _log_odds(groups: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray, size: int) -> np.ndarray:
    """How much likelier toxic texts have each row than others; groups: rows and their texts, some texts each."""
    # as if PRIOR more texts had the row, as many of them toxic as of all: few texts say little
    share = label.mean()
    with_toxic, with_clean = np.full(size, PRIOR * share), np.full(size, PRIOR * (1 - share))
    for rows, texts in groups:
        rows, texts = np.divmod(np.unique(rows.astype(np.int64) * len(label) + texts), len(label))
        toxic = label[texts]
        with_toxic += np.bincount(rows[toxic], minlength=size)
        with_clean += np.bincount(rows[~toxic], minlength=size)
    return np.log(with_toxic / share) - np.log(with_clean / (1 - share))


def train(texts: list[bytes], label: np.ndarray, settings: Settings = Settings()) -> Detector:
    """Fit the network to texts, of which only the whole is labelled.

    The first dimension of the embeddings starts as log odds of the training labels, and attention starts
    from those. In each round the likeliest window of a toxic text stands for it, and the likeliest two of a
    clean one, besides a random one, are clean examples.
    """
    random = np.random.default_rng(settings.seed)
    text = read_in_parts(texts)
    size = settings.embedding
    tables = [(random.standard_normal((1 << bits, size)) * 0.1).astype(np.float32) for bits in (WORD_BITS, CHAR_BITS)]
    detector = Detector(*tables, gru.new_weights(2 * size, settings.hidden, random), settings)
    label = np.asarray(label, bool)
    some = text.counts > 0
    if label[some].all() or not label[some].any():
        detector.weights["out_bias"][0] = -5.0 if not label.any() else 5.0
        detector.weights["out"][:] = 0
        return detector
    owner_of_word = np.repeat(np.arange(len(texts)), text.counts)
    ends = np.cumsum(text.counts)
    parts = [slice(a, b) for a, b in zip([0, *ends[99::100]], [*ends[99::100], ends[-1]])]
    word_groups = ((text.word_rows[text.which[p]], owner_of_word[p]) for p in parts)
    char_groups = (_chars_of_texts(text, owner_of_word[p], text.which[p]) for p in parts if p.stop > p.start)
    for table, groups in ((detector.words, word_groups), (detector.chars, char_groups)):
        table[:, 0] = np.clip(_log_odds(groups, label, len(table)), -4, 4) / 2
    _attend_to_odds(detector.weights, size, settings.hidden)
    owner, start, length = windows(text.counts, settings.window, settings.stride)
    first = features(detector, text)[:, [0, size]].sum(axis=1)[text.which]
    logits = np.array([first[a:b].max() for a, b in zip(start, start + length)])
    everything = {**detector.weights, "words": detector.words, "chars": detector.chars}
    adam = gru.Adam(settings.rate)
    for number in range(settings.rounds):
        if number:
            logits = logits_in_parts(detector, text, start, length)
        order = np.lexsort((-logits, owner))
        heads = np.flatnonzero(np.diff(owner[order], prepend=-1))
        best = order[heads]
        second = order[np.minimum(heads + 1, len(order) - 1)]
        clean = np.flatnonzero(~label[owner])
        chosen = np.unique(
            np.concatenate((best, second[~label[owner[second]]], random.choice(clean, min(len(clean), len(texts)))))
        )
        target = label[owner[chosen]].astype(np.float32)
        weigh = np.where(target > 0, (target == 0).sum() / max(target.sum(), 1), 1.0).astype(np.float32)
        weigh = np.minimum(weigh, 3.0)
        for _ in range(settings.steps):
            part = random.choice(len(chosen), min(settings.batch, len(chosen)), replace=False)
            _learn(detector, text, start[chosen[part]], length[chosen[part]], target[part], weigh[part], adam, everything)
    _centre(detector, logits_in_parts(detector, text, start, length), owner, label)
    return detector


def _attend_to_odds(weights: gru.Weights, size: int, hidden: int) -> None:
    """Let training start from a network whose first unit follows the log odds and draws the attention.

    Otherwise one toxic word among many clean ones has a small share of the pooled state.
    """
    weights["input"][:, [0, size], 2 * hidden] += 1
    weights["input_bias"][:, 0] -= 3  # of the gate that keeps the state before
    weights["attend"][[0, hidden], 0] += 1
    weights["attend_out"][0] += 6
    weights["out"][[0, hidden]] += 1


def _centre(detector: Detector, logits: np.ndarray, owner: np.ndarray, label: np.ndarray) -> None:
    """Put zero halfway between the highest clean texts and the lowest toxic ones, a few of each aside."""
    best = np.full(len(label), -np.inf)
    np.maximum.at(best, owner, logits)
    read_any = np.isfinite(best)
    clean, toxic = np.quantile(best[read_any & ~label], 0.995), np.quantile(best[read_any & label], 0.05)
    if clean < toxic:
        detector.weights["out_bias"] -= np.float32((clean + toxic) / 2)


def _chars_of_texts(text: _Read, owner: np.ndarray, which: np.ndarray):
    """Every character run of some texts, once for each distinct word of a text, and its text."""
    number = len(text.word_rows)
    owner, which = np.divmod(np.unique(owner * number + which), number)
    char_rows, _, taken = _of_words(text, which)
    return char_rows, np.repeat(owner, taken)


def _learn(detector, text, start, length, target, weigh, adam, everything) -> None:
    """One step of gradient descent on a batch of windows."""
    settings, size = detector.settings, detector.settings.embedding
    steps = np.arange(settings.window)[:, None]
    at = np.minimum(start + np.where(steps < length, steps, 0), len(text.which) - 1)
    used, rows = np.unique(text.which[at], return_inverse=True)
    rows = rows.reshape(at.shape)
    char_rows, begins, taken = _of_words(text, used)
    values = detector.chars[char_rows]
    pooled = np.maximum.reduceat(values, begins, axis=0)
    given = np.concatenate((detector.words[text.word_rows[used]], pooled), axis=1)
    table = gru.projected(detector.weights, given)
    mask = steps < length
    inputs = np.stack((table[0][rows], table[1][rows[::-1]]))
    logits, kept = gru.forward(detector.weights, inputs, mask, keep=True)
    slope = ((gru.sigmoid(logits) - target) * weigh / len(target)).astype(np.float32)
    grads, to_inputs = gru.backward(detector.weights, inputs, mask, kept, slope)
    to_table = np.zeros_like(table)
    np.add.at(to_table[0], rows, to_inputs[0])
    np.add.at(to_table[1], rows[::-1], to_inputs[1])
    grads["input"] = given.T @ to_table
    grads["input_bias"] = to_table.sum(axis=1)
    to_given = np.einsum("dnw,diw->ni", to_table, detector.weights["input"])
    adam.update({k: everything[k] for k in grads}, grads)
    # embeddings: plain steps on the rows that took part
    rate = adam.rate
    np.add.at(detector.words, text.word_rows[used], -rate * to_given[:, :size])
    largest = values == np.repeat(pooled, taken, axis=0)
    np.add.at(detector.chars, char_rows, -rate * np.repeat(to_given[:, size:], taken, axis=0) * largest)


def learn_detector(
    documents: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    settings: Settings = Settings(),
) -> Detector:
    """Fit a detector to a bounded sample of labelled documents, balanced between the two labels.

    Of each label the `rows_per_label` keys that hash lowest are looked up in `documents`. Null keys,
    labels and texts are left out, a key with several labels counts as toxic if one of them is 1. Without
    labels of both kinds the detector always gives the kind there is, and clean if there is none.
    """
    marked = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
    marked = marked.groupBy(key).agg((F.max(F.col(label).cast("int")) > 0).alias("_toxic"))
    chosen, _ = lowest_hashes(marked, "_toxic", key, settings.rows_per_label, 2)
    # at most two times rows_per_label keys
    return _fitted(
        documents.select(key, text)
        .join(F.broadcast(chosen.select(key, "_toxic")), key)
        .where(F.length(text) <= settings.most_chars)
        .groupBy(text)
        .agg(F.max("_toxic").alias("_toxic"))
        .withColumn("_order", F.xxhash64(text))
        .orderBy("_order", text)
        .limit(4 * settings.rows_per_label)
        .collect(),
        settings,
    )


def _fitted(rows: list[tuple], settings: Settings) -> Detector:
    """A detector from rows of text and label. The driver has other work after it, so what training took goes back."""
    texts, label = [r[0].encode() for r in rows], np.array([r[1] for r in rows], bool)
    del rows
    detector = train(texts, label, settings)
    give_back()
    return detector


def toxicity_of(spark: SparkSession, text: str | Column, detector: Detector) -> Column:
    """Score from 0 to 1 of a text column: that of its likeliest window of words, whole texts.

    Windows overlap by half. Null, empty and wordless texts score 0. Equal texts score alike, whatever
    stands beside them.
    """
    shared = spark.sparkContext.broadcast(detector)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            scores = np.zeros(len(texts))
            for part in parts_of([t or "" for t in texts]):
                contents = ["" if t is None else t for t in texts[part]]
                scores[part] = score_texts(shared.value, [t.encode() for t in contents])
            del texts
            yield pd.Series(scores)
            give_back()

    return score.asNondeterministic()(text)
