import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import pitman_yor, scoring
from ledgerloom.llm.queries import remainder


def test_documents_against_counts(documents):
    result = scoring.score_documents(documents, remainder(5) == 1)
    tokens = {}
    for row in documents.select("doc_id", "text").collect():
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), row["text"] or "")
        tokens[row["doc_id"]] = [*re.findall(r"[^\x20\x09-\x0d]+", lowered), "\0"]
    held = {key: zlib.crc32(str(key).encode()) % 5 == 1 for key in tokens}
    counts = Counter(t for key, own in tokens.items() if not held[key] for t in own)
    number, kinds = sum(counts.values()), len(counts)
    rows = {r["doc_id"]: r for r in result.collect()}
    assert rows.keys() == tokens.keys()
    for key, own in tokens.items():
        row = rows[key]
        base = sum(math.log10((counts[t] + 0.5) / (number + 0.5 * (kinds + 1))) for t in own)
        assert row["held_out"] == held[key] and row["n_tokens"] == len(own) and row["train_tokens"] == number
        assert row["n_known"] == sum(t in counts for t in own) and row["base_score"] == pytest.approx(base, rel=1e-9)
        assert row["perplexity"] == pytest.approx(10 ** (-row["score"] / len(own)))
    for fold in (True, False):
        own = [r for key, r in rows.items() if held[key] == fold]
        assert sum(r["score"] for r in own) > sum(r["base_score"] for r in own)


def shard():
    random = np.random.default_rng(6)
    words = np.sort(random.integers(1, 2**55, 300, dtype=np.uint64))
    keys = np.unique((np.repeat(words, 20) << np.uint64(8)) | random.integers(0, 256, 6000, dtype=np.uint64))
    return pitman_yor.Shard(keys, random.zipf(1.5, len(keys)).clip(1, 10**6)), words


def test_probabilities_sum_to_one_after_every_sweep():
    model, words = shard()
    for sweep in range(4):
        totals = model.totals()
        for context in (0, 7, 255):
            keys = words << np.uint64(8) | np.uint64(context)
            known = model.probabilities(keys, totals).sum()
            assert known + totals.unknown()[context] == pytest.approx(1, abs=1e-9)
        stranger = np.array([5 << 8 | 7], np.uint64)
        assert model.probabilities(stranger, totals)[0] == pytest.approx(totals.unknown()[7])
        assert pitman_yor.Totals.of(totals.flat()).flat().tolist() == totals.flat().tolist()
        model.sweep(totals, np.random.default_rng(sweep))
        assert (model.tables >= 1).all() and (model.tables <= model.customers).all()
        assert (model.parent_tables >= 1).all() and (model.parent_tables <= model.parent_customers).all()


def test_seating_one_by_one_and_in_lots():
    """The mean number of tables is that of customers who come one by one."""
    random = np.random.default_rng(2)
    count, weight, discount = 400, 2.0, 0.3
    found = pitman_yor.seat(np.full(4000, count), np.full(4000, weight), discount, random).mean()
    tables = np.ones(4000)
    for come in range(1, count):
        tables += random.random(4000) < weight / (weight + come - discount * tables)
    assert found == pytest.approx(tables.mean(), rel=0.03)


def test_odd_rows(odd_texts, no_texts):
    rows = {r["doc_id"]: r for r in scoring.score_documents(odd_texts, F.col("doc_id") == 5).collect()}
    assert [rows[k]["n_tokens"] for k in (1, 2, 3, 4, 5, 6, None)] == [1, 1, 1, 2, 3, 60_001, 6]
    assert rows[5]["held_out"] and not rows[None]["held_out"] and rows[5]["n_known"] == 1
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in rows.values())
    assert scoring.score_documents(odd_texts, F.col("doc_id") == 5).count() == odd_texts.count()
    assert scoring.score_documents(no_texts, F.lit(False)).count() == 0
    unlearned = scoring.score_documents(odd_texts, F.lit(True)).collect()
    assert {(r["score"], r["base_score"], r["n_known"], r["train_tokens"]) for r in unlearned} == {(0.0, 0.0, 0, 0)}


def test_words_of_one_class_have_their_own_followers(spark):
    """Words that share an ending, and so a class, do not share what follows them."""
    texts = ["walking alpha", "talking beta"] * 50 + ["walking alpha", "walking beta"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    scores = {r["doc_id"]: r["score"] for r in scoring.score_documents(docs, F.col("doc_id") >= 100).collect()}
    assert scores[100] > scores[101] + 0.5


def test_probabilities_after_every_real_word_sum_to_one():
    random = np.random.default_rng(3)
    words = np.sort(random.integers(1, 2**55, 200, dtype=np.uint64))
    before = random.integers(0, 2**32, 40, dtype=np.uint32)
    classes = random.integers(0, 256, 40, dtype=np.uint64)
    context, word = random.integers(0, 40, 3000), random.integers(0, 200, 3000)
    keys, found, counts, _ = scoring.summed(words[word] << np.uint64(8) | classes[context], before[context])
    seats = pitman_yor.Seats(keys, found, counts)
    assert seats.shard.word_counts.sum() == counts.sum() == 3000
    known, place = np.unique(seats.places, return_inverse=True)
    share = pitman_yor.discount((counts == 1).sum(), (counts == 2).sum())
    for sweep in range(4):
        totals = seats.shard.totals()
        customers, tables = np.bincount(place, counts), np.bincount(place, seats.tables)
        for one in (0, 7, 39):
            asked = words << np.uint64(8) | classes[one]
            own = np.searchsorted(known, pitman_yor.places(asked[:1], before[one : one + 1]))[0]
            chances = seats.probabilities(
                asked, np.full(200, before[one]), totals, share, np.full(200, customers[own]), np.full(200, tables[own])
            )
            stranger = totals.unknown()[int(classes[one])] * (1 + share * tables[own]) / (customers[own] + 1)
            assert chances.sum() + stranger == pytest.approx(1, abs=1e-9)
        seats.sweep(totals, share, tables[place], np.random.default_rng(sweep))
        assert (seats.tables >= 1).all() and (seats.tables <= seats.customers).all()
        assert seats.shard.customers.sum() == seats.tables.sum()


def test_waves_do_not_matter(documents):
    one, many = (
        {
            r["doc_id"]: tuple(r)
            for r in scoring.score_documents(documents, remainder(5) == 1, settings=scoring.Settings(waves=n)).collect()
        }
        for n in (1, 5)
    )
    assert one == many and len(one) == documents.count()


def test_probabilities_against_plain_loops():
    """Seats give what the four levels give when written out word by word."""
    random = np.random.default_rng(8)
    words = [int(w) for w in np.sort(random.integers(1, 2**55, 12, dtype=np.uint64))]
    before = [(int(b), int(c)) for b, c in zip(random.integers(0, 2**32, 6), random.integers(0, 256, 6))]
    before += [(b, before[0][1]) for b, _ in before[:2]]
    met = sorted({(words[w] << 8 | before[b][1], before[b][0]) for w, b in random.integers(0, (9, 8), (40, 2))})
    counts = random.integers(1, 9, len(met))
    seats = pitman_yor.Seats(np.array([k for k, _ in met], np.uint64), np.array([b for _, b in met], np.uint32), counts)
    known, place = np.unique(seats.places, return_inverse=True)
    share = pitman_yor.discount((counts == 1).sum(), (counts == 2).sum())
    for sweep in range(2):
        tables = np.bincount(place, seats.tables).astype(np.int64)
        seats.sweep(seats.shard.totals(), share, tables[place], np.random.default_rng(sweep))
    shard, totals = seats.shard, seats.shard.totals()
    levels = [
        {pair: (int(c), int(t)) for pair, c, t in zip(met, counts, seats.tables)},
        {int(k): (int(c), int(t)) for k, c, t in zip(shard.keys, shard.customers, shard.tables)},
        {
            (int(shard.words[w]), int(p)): (int(c), int(t))
            for w, p, c, t in zip(shard.pair_word, shard.parent, shard.parent_customers, shard.parent_tables)
        },
        {int(w): int(c) for w, c in zip(shard.words, shard.root_customers)},
    ]
    d_class, d_parent, d_root = totals.discounts
    s = pitman_yor.STRENGTH

    def level(own, others, discount, above):
        c, t = own
        customers, tables = sum(o[0] for o in others), sum(o[1] for o in others)
        return (c - discount * t + (s + discount * tables) * above) / (customers + s)

    def chance(word, prior, klass):
        root = levels[3]
        p = (root[word] - d_root) if word in root else s + d_root * len(root)
        p /= sum(root.values()) + s
        parent = klass // pitman_yor.PER_PARENT
        p = level(levels[2].get((word, parent), (0, 0)), [v for k, v in levels[2].items() if k[1] == parent], d_parent, p)
        key = word << 8 | klass
        p = level(levels[1].get(key, (0, 0)), [v for k, v in levels[1].items() if k & 255 == klass], d_class, p)
        same = [v for (k, b), v in levels[0].items() if (k & 255, b) == (klass, prior)]
        return level(levels[0].get((key, prior), (0, 0)), same, share, p)

    asked = sorted((w << 8 | c, b) for w in [*words, 3] for b, c in before)
    keys, priors = np.array([k for k, _ in asked], np.uint64), np.array([b for _, b in asked], np.uint32)
    context = pitman_yor.places(keys, priors)
    at = np.searchsorted(known, context).clip(max=len(known) - 1)
    there = known[at] == context
    customers = np.where(there, np.bincount(place, counts).astype(np.int64)[at], 0)
    tables = np.where(there, np.bincount(place, seats.tables).astype(np.int64)[at], 0)
    found = seats.probabilities(keys, priors, totals, share, customers, tables)
    assert found.tolist() == pytest.approx([chance(k >> 8, b, k & 255) for k, b in asked], rel=1e-12)
