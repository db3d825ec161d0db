"""Phrase collocations: longest word windows counted once, shorter phrases summed from them by ROLLUP."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.stored import stored
from ledgerloom.llm.textbytes import LOWER, mixed, slices, span_hashes

LONGEST = 4  # words of a window, and of the longest phrase
SLICE = 2 * 2**20  # bytes of text whose windows are counted together before Spark sees them
BITS = 27  # a field of frequent runs has 2^BITS bits (16 MB) at any size of the input
UNKNOWN = "und"
_BREAKS = np.isin(np.arange(256), np.frombuffer(b".,;:!?\x0a\x0b\x0c\x0d", np.uint8))
_BLANKS = np.isin(np.arange(256), np.frombuffer(b"\x20\x09", np.uint8)) | _BREAKS
_STEP = np.uint64(0x9E3779B97F4A7C15)
_WORDS = [f"w{n}" for n in range(1, LONGEST + 1)]


class _Pieces:
    """Words of texts of several languages, and which follow each other within a piece."""

    def __init__(self, texts: list[bytes], langs: list[str]):
        self.data = np.frombuffer(b"\n".join(texts).translate(LOWER) + b"\n", np.uint8)
        blank = _BLANKS[self.data]
        self.starts = np.flatnonzero(~blank & np.concatenate(([True], blank[:-1])))
        self.ends = np.flatnonzero(blank & np.concatenate(([False], ~blank[:-1])))
        self.names, of_text = np.unique(np.array(langs, dtype=object), return_inverse=True)
        owner = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), self.starts, side="right")
        self.lang = of_text[owner]
        pieces = np.cumsum(_BREAKS[self.data])[self.starts]
        self.joined = np.concatenate((pieces[1:] == pieces[:-1], [False])) if len(pieces) else np.zeros(0, bool)
        salts = span_hashes(*_run([n.encode() for n in self.names]))
        self.hashes = span_hashes(self.data, self.starts, self.ends)
        self.salts = salts[self.lang]

    def walk(self, fields: list[np.ndarray], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Of 2, 3, ... words, one size more than there are fields: places and hashes of runs within a piece.

        Runs are left out unless the fields have a bit for both runs inside that are one word shorter.
        """
        alive, hashes = np.ones(len(self.starts), bool), mixed(self.hashes * _STEP + self.salts)
        for size in range(2, len(fields) + 3):
            follows = np.concatenate((alive[1:], [False]))[: len(alive)]
            places = np.flatnonzero(alive & follows & self.joined)
            longer = np.zeros_like(hashes)
            longer[places] = mixed(hashes[places] * _STEP + self.hashes[places + size - 1])
            hashes, found = longer, longer[places]
            if size - 2 < len(fields):
                at = (found >> np.uint64(64 - bits)).astype(np.int64)
                known = (fields[size - 2][at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
                places, found = places[known], found[known]
                alive = np.zeros(len(self.starts), bool)
                alive[places] = True
            yield places, found


def _run(spans: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ends = np.cumsum([len(s) for s in spans])
    return np.frombuffer(b"".join(spans), np.uint8), ends - [len(s) for s in spans], ends


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[_Pieces]:
    for batch in batches:
        for rows, texts in slices(batch, "text", SLICE):
            yield _Pieces(texts, rows.column(0).to_pylist())


Fields = list[Broadcast]


def _opened(fields: Fields) -> list[np.ndarray]:
    return [np.frombuffer(field.value, np.uint8) for field in fields]


def frequent_runs(texts: DataFrame, least: int, fields: Fields, bits: int = BITS) -> bytes:
    """A field of 2^bits bits with one for every run of `least` occurrences or more, of two words more than `fields`.

    Only runs whose inner runs the shorter `fields` know are counted: no others can be as frequent. Runs
    that share a hash or a bit only make the field say yes more often. Spark gathers it from parts of
    4 KB, so what comes to the driver is never more than the field.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shorter = _opened(fields)
        for pieces in _read(batches):
            *_, (_, found) = pieces.walk(shorter, bits)
            runs, counts = np.unique(found, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(runs.view(np.int64)), pa.array(counts)], names=["run", "n"])

    counted = texts.mapInArrow(count, "run long, n long").groupBy("run").agg(F.sum("n").alias("n"))
    place = F.shiftrightunsigned("run", 64 - bits)
    # bitmap_construct_agg holds 32768 bits
    parts = counted.where(F.col("n") >= least).groupBy(F.shiftrightunsigned(place, 15).alias("part")).agg(
        F.bitmap_construct_agg(place.bitwiseAND(32767)).alias("bits")
    )
    field = np.zeros(max(1, 2**bits // 8), np.uint8)
    for row in parts.toLocalIterator():
        begin = row["part"] * 4096
        own = np.frombuffer(bytes(row["bits"]), np.uint8)[: len(field) - begin]
        field[begin : begin + len(own)] = own
    return field.tobytes()


def known_runs(texts: DataFrame, least: int, bits: int = BITS) -> Fields:
    """Fields for runs of two, three, ... words up to the longest phrase."""
    fields: Fields = []
    while len(fields) < LONGEST - 1:
        field = frequent_runs(texts, least, fields, bits)
        fields.append(texts.sparkSession.sparkContext.broadcast(field))
    return fields


def _windows(fields: Fields, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _opened(fields)
        for pieces in _read(batches):
            if not len(pieces.starts):
                continue
            # words of the window at each place: as many as the longest known run from there, 0 for none
            _, named, word = np.unique(pieces.hashes, return_index=True, return_inverse=True)
            columns = [word + 1]
            for lead, (places, _) in zip(range(1, LONGEST), pieces.walk(known, bits)):
                column = np.zeros(len(word), word.dtype)
                column[places] = word[places + lead] + 1
                columns.append(column)
            # equal windows of the slice are counted here
            keys = np.column_stack([pieces.lang, *columns])
            order = np.lexsort(keys.T[::-1])
            keys = keys[order]
            starts = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1))))
            counts = np.diff(np.concatenate((starts, [len(keys)])))
            keys = keys[starts]
            raw = pieces.data.tobytes()
            spans = zip(pieces.starts[named].tolist(), pieces.ends[named].tolist())
            written = pa.array([raw[a:b].decode() for a, b in spans])
            langs = pa.array(pieces.names.tolist(), pa.string()).take(pa.array(keys[:, 0]))
            words = [written.take(pa.array(keys[:, k] - 1, mask=keys[:, k] == 0)) for k in range(1, LONGEST + 1)]
            yield pa.RecordBatch.from_arrays([langs, *words, pa.array(counts)], names=["lang", *_WORDS, "n"])

    return run


def longest_windows(texts: DataFrame, fields: Fields, bits: int = BITS) -> DataFrame:
    """lang, w1 to w4 and n: a window for every word, it and the words that it leads, with null beyond.

    A window ends with its piece, and before the word with which the `fields` exclude it.
    """
    kind = "lang string, " + ", ".join(f"{w} string" for w in _WORDS) + ", n long"
    windows = texts.mapInArrow(_windows(fields, bits), kind)
    return windows.groupBy("lang", *_WORDS).agg(F.sum("n").alias("n"))


def phrase_counts(windows: DataFrame, least: int) -> DataFrame:
    """lang, size, phrase and f of every phrase of one to four words with f >= least; size 0: all words.

    One ROLLUP over the windows gives every prefix the sum of the windows that go on with it. A sum whose
    last word is the padding is no phrase.
    """
    last = F.element_at(F.array(F.lit(""), *_WORDS), F.col("size") + 1)
    summed = windows.rollup("lang", *_WORDS).agg(F.sum("n").alias("f"), F.grouping_id().alias("level"))
    size = F.lit(LONGEST) - F.bit_count("level")
    phrases = summed.where(F.col("level") < 2**LONGEST).withColumn("size", size.cast("int"))
    phrases = phrases.where((F.col("size") == 0) | ((F.col("f") >= least) & last.isNotNull()))
    return phrases.select("lang", "size", F.concat_ws(" ", *_WORDS).alias("phrase"), "f")


def _wide(number: Column | str) -> Column:
    return (F.col(number) if isinstance(number, str) else number).cast("decimal(28,0)")


def _part(phrase: Column, begin: int | Column, size: int | Column) -> Column:
    words = F.split(phrase, " ")
    return F.array_join(F.slice(words, begin, size), " ")


def scored(phrases: DataFrame, scale: int) -> DataFrame:
    """lang, phrase, size, a, l, r and score of every phrase of two words or more, by its lowest cut."""
    whole = phrases.where("size >= 2").select("lang", "phrase", "size", F.col("f").alias("a"))
    cuts = whole.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumns(
        {
            "_left": _part(F.col("phrase"), 1, F.col("k")),
            "_right": _part(F.col("phrase"), F.col("k") + 1, F.col("size") - F.col("k")),
        }
    )
    counted = phrases.where(f"size between 1 and {LONGEST - 1}")
    cuts = cuts.join(counted.select("lang", F.col("phrase").alias("_left"), F.col("f").alias("l")), ["lang", "_left"])
    cuts = cuts.join(counted.select("lang", F.col("phrase").alias("_right"), F.col("f").alias("r")), ["lang", "_right"])
    cuts = cuts.withColumns({"_top": _wide("a") * F.lit(scale).cast("decimal(10,0)"), "_under": _wide("l") + _wide("r")})
    cut = F.struct(F.expr("_top div _under").alias("score"), "k", "l", "r")
    best = cuts.groupBy("lang", "phrase", "size", "a").agg(F.min(cut).alias("cut"))
    return best.select("lang", "phrase", "size", "a", "cut.l", "cut.r", "cut.score")


def _absorbed(candidates: DataFrame, percent: int) -> DataFrame:
    """lang and phrase of candidates that lie in a longer one which is at least `percent` as frequent."""
    longer = candidates.where("size > 2").withColumn("_size", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    longer = longer.withColumn("_at", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("_size") + 1)))
    inner = longer.select("lang", _part(F.col("phrase"), F.col("_at"), F.col("_size")).alias("phrase"), "a")
    most = inner.groupBy("lang", "phrase").agg(F.max("a").alias("_most"))
    both = candidates.join(most, ["lang", "phrase"])
    return both.where(_wide("_most") * 100 >= _wide("a") * percent).select("lang", "phrase")


def mine_collocations(
    documents: DataFrame,
    lang: str = "lang",
    text: str = "text",
    least: int = 30,
    scale: int = 2_000_000,
    percent: int = 80,
    top: int = 2000,
    bits: int = BITS,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score: each language's `top` phrases of two to four words.

    A-Z are lower-cased, texts cut into pieces at `.,;:!?` and line ends and into words at blanks and
    tabs. a is how often the phrase occurs, l and r how often its two parts do, at the cut with the lowest
    score scale * a / (l + r), rounded down, the first of equal ones; n counts the language's words.
    Phrases inside a longer one that is at least `percent` per cent as frequent are left out.

    Every word heads one window of four; Spark counts the windows and one ROLLUP gives all shorter
    phrases. Windows are cut where no phrase of `least` occurrences can go on, which bit fields of fixed
    size tell, one for each number of words; where a field fills up, fewer windows are cut and the result
    is the same.

    A null text is empty and counts nothing, a null language is `und`. Repeated rows count as often as
    they come; phrases of equal score and count are ordered by their bytes. Other columns are not read.
    No words give no rows.
    """
    texts = documents.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text"))
    fields = known_runs(texts, least, bits)
    phrases = stored(phrase_counts(longest_windows(texts, fields, bits), least))
    candidates = stored(scored(phrases.where("size > 0"), scale))
    left = candidates.join(_absorbed(candidates, percent), ["lang", "phrase"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    total = phrases.where("size = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
