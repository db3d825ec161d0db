import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from conftest_path import FOLDER
from pyspark.sql import functions as F

from ledgerloom.llm import repeats
from ledgerloom.llm.queries import op13_periodic_runs


def brute(words, least=12):
    """Every maximal stretch with every period, then those whose period is the smallest of the stretch."""
    runs, n = [], len(words)
    for period in range(1, n // 2 + 1):
        start = 0
        while start < n - period:
            end = start
            while end < n - period and words[end] == words[end + period]:
                end += 1
            length = end - start + period
            if end > start and length >= max(least, 2 * period):
                part = words[start : start + length]
                if not any(part[q:] == part[:-q] for q in range(1, period)):
                    runs.append((start, length, period))
            start = max(end, start + 1)
    return sorted(runs)


def collapsed(words, runs):
    dropped = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def periodic(pick):
    words = []
    while len(words) < pick.randint(5, 120):
        block = [pick.choice("abc") for _ in range(pick.randint(1, 9))]
        words += block * pick.choice([1, 1, 2, 3, 8]) + [pick.choice("abcdefgh") for _ in range(pick.randint(0, 5))]
    return words


@pytest.mark.parametrize("least", [12, 5, 2])
def test_runs_as_by_trial(spark, least):
    pick = random.Random(least)
    texts = [periodic(pick) for _ in range(250)] + [["a"] * 40, list("ab") * 30, list("aabaab") * 9, ["x"]]
    rows = spark.createDataFrame([(n, "  ".join(t)) for n, t in enumerate(texts)], "doc_id long, text string")
    for row in repeats.periodic_runs(rows, least=least).collect():
        words = texts[row["doc_id"]]
        expected = brute(words, least)
        assert [tuple(r) for r in row["runs"]] == expected, words
        assert row["collapsed"] == collapsed(words, expected) and row["n_words"] == len(words)


def test_ordered_positions():
    pick = random.Random(2)
    places = list(range(5000))
    pick.shuffle(places)
    found, have = repeats.Positions(places[0]), [places[0]]
    for place in places[1:]:
        before, after = found.insert(place)
        if len(have) < 1500:
            have.append(place)
            assert before == max((x for x in have if x < place), default=-1)
            assert after == min((x for x in have if x > place), default=-1)
    assert list(found) == sorted(places) and found.size == 5000 and max(map(len, found.parts)) <= 2 * repeats.SHORT


def test_long_texts_of_one_word_and_of_long_periods():
    ones = np.ones(50_000, np.int64)
    assert repeats.find_runs(ones, ones > 0, 12) == [(0, 50_000, 1)]
    block = np.random.default_rng(1).integers(1, 30_000, 9_000)
    tail = np.concatenate(([40_000] * 3, np.tile(block, 4), [40_001]))
    ids = np.unique(tail, return_inverse=True)[1] + 1
    assert (3, 36_000, 9_000) in repeats.find_runs(ids, np.ones(len(ids), bool), 12)


def test_odd_texts(spark, odd_texts, no_texts):
    renamed = odd_texts.withColumn("runs", F.lit("clash")).withColumn("collapsed", F.lit(1))
    rows = repeats.periodic_runs(renamed).collect()
    assert len(rows) == odd_texts.count()
    found = {r["doc_id"]: r for r in rows}
    for key in (1, 2, 3):
        assert tuple(found[key])[1:] == (0, [], "")
    assert [tuple(r) for r in found[6]["runs"]] == [(0, 60_000, 1)] and found[6]["collapsed"] == "word"
    assert found[None]["collapsed"] == "No key at all here" and found[None]["runs"] == []
    assert repeats.periodic_runs(no_texts).count() == 0


def test_query_by_trial(spark, documents):
    """The registered query against words changed, runs found and digests made in plain Python."""
    texts = {r["doc_id"]: r["text"] or "" for r in documents.select("doc_id", "text").collect()}
    checked = 0
    for row in op13_periodic_runs(spark, FOLDER).collect():
        words = re.findall(r"[^\x20\x09-\x0d]+", texts[row["doc_id"]])
        if len(words) > 400:
            continue
        h, n = zlib.crc32(str(row["doc_id"]).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = brute(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        assert tuple(row)[:5] == (row["doc_id"], len(runs), *best)
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        assert row["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
        checked += bool(runs)
    assert checked > 30
