"""Language identification by compression: the dictionary of the right language saves most."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.textbytes import give_back

ROWS_PER_LANGUAGE = 128
DICTIONARY_BYTES = 64 * 1024
ALL_BYTES = 200 * DICTIONARY_BYTES  # of all dictionaries
LEAST_BYTES = 512  # of a dictionary
LEAST_PART = 64  # characters of a text
SPREAD = 1 << 30  # places that texts hash to
PIECE_BYTES = 4 * 1024
MIN_MARGIN = 0.02  # of the second size
MIN_GAIN = 0.01  # of the size without a dictionary
LEVEL = 6
UNKNOWN = "und"
Dictionaries = tuple[tuple[str, bytes], ...]


def learn_dictionaries(
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    rows_per_language: int = ROWS_PER_LANGUAGE,
    dictionary_bytes: int = DICTIONARY_BYTES,
    all_bytes: int = ALL_BYTES,
) -> Dictionaries:
    """A raw-content dictionary for each language, from a bounded sample of the labelled rows.

    Every language has one. Of each, the `rows_per_language` different texts that hash lowest (ties: by text),
    or all if there are fewer, give equal parts of the dictionary, from the middle of the texts. Languages that
    would take more than `all_bytes` together get smaller dictionaries, of fewer texts, but not below
    `LEAST_BYTES`. Rows with a null text or language are left out; repeated texts count once. Without any row
    there are no dictionaries. The most frequent language comes first.
    """
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(text).alias("text"), F.col(lang).alias("lang"), F.pmod(F.xxhash64(text), F.lit(SPREAD)).alias("place")
    )
    places = rows.groupBy("lang", "place").agg(F.count("*").alias("rows"))
    sizes = places.groupBy("lang").agg(F.sum("rows").alias("rows"), F.count("*").alias("places"))
    counts = {
        r["lang"]: (r["rows"], r["places"])
        for r in sizes.collect()
    }
    dictionary_bytes = min(dictionary_bytes, max(LEAST_BYTES, all_bytes // max(1, len(counts))))
    rows_per_language = min(rows_per_language, max(1, dictionary_bytes // LEAST_PART))
    part = dictionary_bytes // rows_per_language
    # of every language some times the texts wanted, whatever its share or copies; all if it has so few
    limits = {name: min(SPREAD, SPREAD * 8 * rows_per_language // n + 1) for name, (_, n) in counts.items()}
    texts: dict[str, list[str]] = {}
    while limits:
        found = _lowest(rows, limits, rows_per_language, part)
        enough = {
            name
            for name, limit in limits.items()
            if limit == SPREAD or len(found.get(name, ())) >= min(rows_per_language, counts[name][1])
        }
        texts |= {name: found[name] for name in enough if name in found}
        limits = {name: min(SPREAD, 16 * limit) for name, limit in limits.items() if name not in enough}
    frequent = sorted(texts, key=lambda name: (-counts[name][0], name))
    return tuple((name, "\n".join(texts[name]).lower().encode()[:dictionary_bytes]) for name in frequent)


def _lowest(rows: DataFrame, limits: dict[str, int], most: int, part: int) -> dict[str, list[str]]:
    """Middles of the `most` different texts of each language with the lowest places below its limit, in order."""
    below = rows.sparkSession.createDataFrame(list(limits.items()), "lang string, below long")
    chosen = rows.join(F.broadcast(below), "lang").where("place < below").select("lang", "place", "text").distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place", "text"))
    middle = F.substring(
        "text", (F.greatest(F.lit(0), (F.length("text") - part) / 2) + 1).cast("int"), F.lit(part)
    )
    sample = (
        chosen.withColumn("rank", rank)
        .where(F.col("rank") <= most)
        .select("lang", "rank", middle.alias("middle"))
        .collect()
    )
    texts: dict[str, list[str]] = {}
    for row in sorted(sample):
        texts.setdefault(row["lang"], []).append(row["middle"])
    return texts


@lru_cache(maxsize=4)
def _compressors(dictionaries: Dictionaries) -> list[zstandard.ZstdCompressor]:
    """One for each dictionary, and one without."""
    made = []
    for _, content in dictionaries:
        known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(level=LEVEL)
        made.append(
            zstandard.ZstdCompressor(
                level=LEVEL, dict_data=known, write_checksum=False, write_content_size=False, write_dict_id=False
            )
        )
    made.append(
        zstandard.ZstdCompressor(level=LEVEL, write_checksum=False, write_content_size=False, write_dict_id=False)
    )
    return made


def compressed_sizes(text: bytes, dictionaries: Dictionaries) -> list[int]:
    """Bytes of the whole text under each dictionary and then without one.

    It is compressed piece by piece, so that the dictionary stays near.
    """
    pieces = [text[k : k + PIECE_BYTES] for k in range(0, len(text), PIECE_BYTES)]
    return [sum(len(c.compress(p)) for p in pieces) for c in _compressors(dictionaries)]


def classify(
    text: str | None, dictionaries: Dictionaries, min_margin: float, min_gain: float
) -> tuple[str, float, bool]:
    """Language, score and whether to reject."""
    if text is None or not dictionaries or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0, True
    *sizes, alone = compressed_sizes(text.lower().encode(), dictionaries)
    order = sorted(range(len(sizes)), key=lambda k: (sizes[k], k))
    best = sizes[order[0]]
    strange = alone - best <= min_gain * alone
    if len(order) == 1:
        return dictionaries[0][0], 1.0, strange
    second = sizes[order[1]]
    narrow = second - best < min_margin * second
    return dictionaries[order[0]][0], second / (best + second), strange or narrow


def language_of(
    text: str | Column,
    dictionaries: Dictionaries,
    min_margin: float = MIN_MARGIN,
    min_gain: float = MIN_GAIN,
) -> Column:
    """A struct of lang_pred, score and rejected for a text column.

    The whole text is compressed with every dictionary; the smallest size wins, of equal sizes the more
    frequent language. score is second / (best + second), 0.5 when two languages do equally well and 1 with
    a single dictionary. A text of any length is rejected when the winner saves less than `min_margin` of the
    second size, or no more than `min_gain` of the size without a dictionary, so ties are always rejected; and
    when it is null, empty or has no letter, which gives `und` and score 0. Without dictionaries everything
    is `und`.
    """

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [classify(t, dictionaries, min_margin, min_gain) for t in texts]
            del texts
            yield pd.DataFrame(found, columns=["lang_pred", "score", "rejected"])
            give_back()

    return predict.asNondeterministic()(text)
