import random
import re
from collections import Counter, defaultdict

import pytest

from ledgerloom.llm import components, minhash
from ledgerloom.llm.components import connected


def brute(rows, size, percent):
    """Components over links between sets of shingles, by an inverted index."""
    sets, parent = {}, {}
    for key, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x20\x09-\x0d]+", lowered)
        runs = [tuple(words[i : i + size]) for i in range(len(words) - size + 1)] or ([tuple(words)] if words else [])
        sets[key], parent[key] = set(runs), key

    def root(key):
        while parent[key] != key:
            key = parent[key]
        return key

    seen = defaultdict(list)
    for key in sorted(sets):
        shared = Counter(other for run in sets[key] for other in seen[run])
        for other, both in shared.items():
            if 100 * both >= percent * (len(sets[key]) + len(sets[other]) - both):
                a, b = sorted((root(key), root(other)))
                parent[b] = a
        for run in sets[key]:
            seen[run].append(key)
    return {key: (len(runs), root(key), root(key) == key) for key, runs in sets.items()}


def found(result):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in result.collect()}


@pytest.mark.parametrize("settings", [minhash.Settings(), minhash.Settings(shingle=5, percent=80, bands=30)])
def test_documents_as_brute_force(documents, settings):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    result = found(minhash.near_duplicates(documents, settings=settings))
    assert result == brute(rows, settings.shingle, settings.percent)


def test_chains_and_near_misses(spark):
    """Texts that drift word by word: many are linked only through others, or just not at all."""
    pick = random.Random(8)
    rows = []
    for group in range(6):
        words = [f"g{group}w{n}" for n in range(120)]
        for step in range(25):
            for _ in range(pick.randint(0, 4)):
                words[pick.randrange(120)] = f"g{group}s{step}x{pick.random()}"
            rows.append((len(rows), " ".join(words)))
            if step % 5 == 0:
                rows.append((len(rows), " ".join(words).upper()))
    pick.shuffle(rows)
    table = spark.createDataFrame(rows, "doc_id long, text string")
    result = found(minhash.near_duplicates(table))
    assert result == brute(rows, 3, 85)
    assert len({c for _, c, _ in result.values()}) > 6


def test_odd_rows(odd_texts, no_texts):
    rows = minhash.near_duplicates(odd_texts).collect()
    assert len(rows) == odd_texts.count()
    by_key = {r["doc_id"]: tuple(r)[1:] for r in rows}
    assert by_key[1] == (0, 1, True) and by_key[2] == (0, 2, True) and by_key[3] == (0, 3, True)
    assert by_key[4] == (1, 4, True) and by_key[6] == (1, 6, True)
    assert by_key[None] == (3, None, True)
    assert minhash.near_duplicates(no_texts).count() == 0


def test_components(spark):
    links = [(5, 4), (4, 5), (3, 5), (9, 8), (7, 7), (None, 1), (10, 9), *[(100 + n, 101 + n) for n in range(60)]]
    result = {tuple(r) for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    expected = {(3, 3), (4, 3), (5, 3), (8, 8), (9, 8), (10, 8)} | {(100 + n, 100) for n in range(61)}
    assert result == expected
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_plan_stays_small(spark, tmp_path):
    """The driver keeps the plan of every step: three joins over four reads, not six over sixteen."""
    spark.createDataFrame([(5, 4), (5, 3)], "a long, b long").write.parquet(f"{tmp_path}/links")
    step = components._step(spark.read.parquet(f"{tmp_path}/links"))
    plan = step._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") <= 3 and plan.count("Relation ") <= 4
    assert {tuple(r) for r in step.collect()} == {(4, 3), (5, 3)}
