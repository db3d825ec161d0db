import numpy as np
import pytest
from pyspark.sql import functions as F
from test_vectors import ODD, table

from ledgerloom.llm import crosspolytope


def brute(rows, cosine):
    """(key, n_links, component_id, kept) of every row, by all pairs."""
    width = max((len(v) for _, v in rows if v), default=0)
    units = []
    for _, v in rows:
        sound = bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        row = np.pad(np.array(v, float), (0, width - len(v))) / np.abs(v).max() if sound else np.zeros(width)
        units.append(row / np.linalg.norm(row) if sound else row)
    near = np.array(units) @ np.array(units).T >= cosine
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in zip(*np.nonzero(near)):
        parent[root(a)] = root(b)
    out = []
    for k, (key, _) in enumerate(rows):
        keys = [rows[j][0] for j in range(len(rows)) if root(j) == root(k) and rows[j][0] is not None]
        least = min(keys, default=None)
        out.append((key, int(near[k].sum()) - int(near[k, k]), least, key == least))
    return sorted(out, key=repr)


def judged(result):
    return sorted((tuple(r) for r in result.collect()), key=repr)


def test_fast_hadamard():
    rows = np.random.default_rng(1).standard_normal((5, 16))
    matrix = np.ones((1, 1))
    for _ in range(4):
        matrix = np.block([[matrix, matrix], [matrix, -matrix]])
    assert np.allclose(crosspolytope.hadamard(rows), rows @ matrix / 4)


def test_first_code_is_the_nearest_corner_and_visits_differ():
    rows = np.random.default_rng(2).standard_normal((300, 16))
    codes = crosspolytope.bucket_codes(rows, crosspolytope.Tables(16, 3, 4, 5))
    assert codes.shape == (300, 4, 6) and all(len(set(c)) == 6 for row in codes for c in row)
    assert (crosspolytope.bucket_codes(rows * 3, crosspolytope.Tables(16, 3, 4, 5)) == codes).all()
    more = crosspolytope.bucket_codes(rows, crosspolytope.Tables(16, 3, 4, 2))
    assert (more == codes[:, :, :3]).all()


def test_forest_connects_without_circles():
    random = np.random.default_rng(3)
    left, right = random.integers(0, 60, 200), random.integers(0, 60, 200)
    label = np.arange(60)
    taken = crosspolytope.forest(label, left, right)
    again = np.arange(60)
    assert len(crosspolytope.forest(again, left[taken], right[taken])) == len(taken)
    assert (label == again).all() and len(taken) == 60 - len(set(label.tolist()))


@pytest.mark.parametrize("block", [1024, 16])
def test_links_as_by_all_pairs(spark, block):
    random = np.random.default_rng(5)
    centers = random.standard_normal((60, 24))
    rows = [(n, (centers[n % 60] + random.standard_normal(24) * 0.25 * (n % 4)).tolist()) for n in range(500)]
    rows += [(500 + n, rows[n % 3][1]) for n in range(120)]
    result = crosspolytope.near_duplicate_vectors(table(spark, rows), missed=1e-9, block=block)
    assert judged(result) == brute(rows, 0.95)


def test_odd_vectors(spark):
    rows = [*ODD, (12, [0.5, 0.25, 0.0]), (12, [-1.0]), (13, [5e-324, 2.5e-324]), (None, None), (0, [1e200, -1e200])]
    result = crosspolytope.near_duplicate_vectors(table(spark, rows).withColumn("component_id", F.lit("clash")))
    assert judged(result) == brute(rows, 0.95)
    assert crosspolytope.near_duplicate_vectors(table(spark, rows).limit(0)).count() == 0


def test_more_rows_need_more_tables():
    few, many = (crosspolytope.plan_tables(n, 64, 0.95) for n in (10**4, 10**9))
    assert few.hashes < many.hashes and few.tables < many.tables < 100
