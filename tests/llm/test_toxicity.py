import os
import subprocess
import sys
from pathlib import Path

import numpy as np

from ledgerloom.llm import gru, toxicity
from ledgerloom.llm.queries import remainder


def test_gradients():
    random = np.random.default_rng(1)
    weights = {n: w + random.standard_normal(w.shape) * 0.3 for n, w in gru.new_weights(4, 3, random).items()}
    inputs, mask = random.standard_normal((2, 5, 6, 9)), np.arange(5)[:, None] < random.integers(1, 6, 6)
    slope = random.standard_normal(6)
    _, kept = gru.forward(weights, inputs, mask, keep=True)
    grads, to_inputs = gru.backward(weights, inputs, mask, kept, slope)
    for values, found in [(inputs, to_inputs), *[(weights[n], grads[n]) for n in weights if not n.startswith("input")]]:
        for _ in range(5):
            place = tuple(random.integers(0, s) for s in values.shape)
            before, ends = values[place], []
            for step in (1e-3, -1e-3):
                values[place] = before + step
                ends.append(float(gru.forward(weights, inputs, mask) @ slope))
            values[place] = before
            assert abs((ends[0] - ends[1]) / 2e-3 - found[place]) < 1e-3


def test_windows_overlap_and_reach_the_end():
    counts = np.array([0, 5, 32, 33, 100])
    text, start, length = toxicity.windows(counts, 32, 16)
    begins = np.cumsum(counts) - counts
    for row, count in enumerate(counts):
        own = text == row
        seen = sorted(zip(start[own] - begins[row], length[own]))
        assert [s for s, _ in seen] == list(range(0, 16 * len(seen), 16))
        assert (seen[-1][0] + seen[-1][1] == count and seen[0][0] == 0) if count else not seen


SETTINGS = toxicity.Settings(rows_per_label=300, steps=60)


def learned(spark, documents, keep):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").where(keep)
    return toxicity.learn_detector(documents, labels, settings=SETTINGS)


def test_held_out_documents(spark):
    documents = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    detector = learned(spark, documents, remainder(5) != 0)
    held = documents.join(labels.where(remainder(5) == 0).select("doc_id", "toxic"), "doc_id")
    rows = held.select("toxic", toxicity.toxicity_of(spark, "text", detector).alias("score")).toPandas()
    assert rows["score"].between(0, 1).all()
    # a random toxic document against a random clean one
    toxic, clean = rows["score"][rows["toxic"] == 1].to_numpy(), rows["score"][rows["toxic"] == 0].to_numpy()
    assert (toxic[:, None] > clean[None, :]).mean() > 0.85


def test_odd_rows(spark, odd_texts, no_texts):
    texts = [b"you idiot person", b"a kind person"] * 40
    detector = toxicity.train(texts, np.array([True, False] * 40), toxicity.Settings(steps=30))
    rows = odd_texts.select("doc_id", toxicity.toxicity_of(spark, "text", detector).alias("s")).collect()
    by_key = {r["doc_id"]: r["s"] for r in rows}
    assert len(rows) == odd_texts.count() and by_key[1] == by_key[2] == by_key[3] == 0
    assert all(0 <= s <= 1 for s in by_key.values())
    scores = toxicity.score_texts(detector, [b"an Idiot!", b"kind", b"kind " * 500 + b"idiot", b""])
    assert scores[0] >= 0.5 > scores[1] and scores[2] >= 0.5 and scores[3] == 0
    assert no_texts.select(toxicity.toxicity_of(spark, "text", detector)).count() == 0
    nothing = toxicity.learn_detector(no_texts, no_texts)
    assert toxicity.score_texts(nothing, [b"idiot"])[0] < 0.5


def test_training_gives_memory_back():
    """In a process of its own, as others keep memory for later use."""
    code = """
import numpy as np
from ledgerloom.llm import toxicity
from ledgerloom.llm.textbytes import give_back

def held():
    with open("/proc/self/statm") as file:
        return int(file.read().split()[1]) * 4096

random = np.random.default_rng(5)
rows = [(" ".join(map(str, random.integers(0, 30_000, 400))), k % 2 == 0, k) for k in range(2000)]
settings = toxicity.Settings(rounds=2, steps=5)
toxicity._fitted(rows[:100], settings)
give_back()
before = held()
detector = toxicity._fitted(rows, settings)
after = held()
give_back()
print(after - before, after - held())
"""
    place = str(Path(toxicity.__file__).parents[2])
    env = os.environ | {"PYTHONPATH": place, "OMP_NUM_THREADS": "1"}
    done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, check=True, timeout=300)
    grown, left = map(int, done.stdout.split())
    assert grown < 40e6 and left < 8e6
