import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import collocations


def brute(rows, least, percent=80, top=2000, scale=2_000_000):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, 5):
                counts.update((lang, tuple(words[i : i + size])) for i in range(len(words) - size + 1))
    candidates = {k: n for k, n in counts.items() if len(k[1]) > 1 and n >= least}
    dropped = set()
    for (lang, words), n in candidates.items():
        for size in range(2, len(words)):
            for at in range(len(words) - size + 1):
                inner = (lang, words[at : at + size])
                if 100 * n >= percent * counts[inner]:
                    dropped.add(inner)
    lists = {}
    for (lang, words), a in candidates.items():
        if (lang, words) in dropped:
            continue
        cuts = []
        for k in range(1, len(words)):
            l, r = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((scale * a // (l + r), k, l, r))
        score, _, l, r = min(cuts)
        lists.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), l, r))
    out = []
    for lang, found in lists.items():
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def made(pick):
    words = ["a", "B", "cé", "dd", "e", "日本", "Go"]
    for _ in range(120):
        lang = pick.choice(["x", "y", None])
        yield lang, "".join(pick.choice(words) + pick.choice([" ", " ", " ", "\t ", ". ", "\n", "!?"]) for _ in range(80))


@pytest.mark.parametrize("bits", [27, 3])
def test_phrases_as_by_trial(spark, bits):
    """With a filter of 8 bits nothing is cut early; the result is the same."""
    rows = list(made(random.Random(3))) * 2 + [("z", "never twice the same words"), (None, None), ("x", ""), ("y", " .\t,")]
    table = spark.createDataFrame(rows, "lang string, text string").withColumns({"phrase": F.lit(1), "n": F.lit("clash")})
    for least, top in ((8, 2000), (30, 5)):
        found = collocations.mine_collocations(table, least=least, top=top, bits=bits)
        assert sorted(map(tuple, found.collect())) == brute(rows, least, top=top)


def test_odd_texts(spark, odd_texts, no_texts):
    rows = [(None, r["text"]) for r in odd_texts.collect()]
    found = collocations.mine_collocations(odd_texts.withColumn("lang", F.lit(None).cast("string")), least=2)
    assert sorted(map(tuple, found.collect())) == brute(rows, 2)
    assert collocations.mine_collocations(no_texts).count() == 0


def test_windows_hold_every_word_once(spark):
    rows = [("x", "a b c d e. a b"), ("x", "b c")]
    table = spark.createDataFrame(rows, "lang string, text string")
    full, none = (spark.sparkContext.broadcast(bytes([byte]) * 2**24) for byte in (255, 0))
    windows = collocations.longest_windows(table, [full] * 3).collect()
    assert sum(r["n"] for r in windows) == 9
    assert ("x", "b", "c", "d", "e", 1) in [tuple(r) for r in windows]
    shorter = collocations.longest_windows(table, [none] * 3).collect()
    assert {tuple(r)[1:] for r in shorter} == {(w, None, None, None, n) for w, n in zip("abcde", (2, 3, 2, 1, 1))}


def test_fields_know_every_frequent_run(spark):
    """A window may go on too far, never stop too early."""
    rows = list(made(random.Random(4)))
    fields = collocations.known_runs(spark.createDataFrame(rows, "lang string, text string").fillna("und"), 8)
    texts = [(text or "").encode() for _, text in rows]
    pieces = collocations._Pieces(texts, [lang or "und" for lang, _ in rows])
    walked = list(pieces.walk(collocations._opened(fields), collocations.BITS))
    _, word = np.unique(pieces.hashes, return_inverse=True)
    for size, (places, _) in zip((2, 3, 4), walked):
        runs = Counter()
        for at in range(len(word) - size + 1):
            if pieces.joined[at : at + size - 1].all():
                runs[pieces.lang[at], *word[at : at + size]] += 1
        often = {at for at in range(len(word) - size + 1)
                 if pieces.joined[at : at + size - 1].all() and runs[pieces.lang[at], *word[at : at + size]] >= 8}
        assert often == set(places.tolist())
