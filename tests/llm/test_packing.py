import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerloom.llm import packing


def covered(windows, lengths, window):
    """Every place of every item exactly once, and no window too long."""
    seen = defaultdict(list)
    for made in windows:
        assert 0 < sum(n for _, _, n in made) <= window
        for item, start, n in made:
            seen[item].append((start, n))
    for item, length in enumerate(lengths):
        reached = 0
        for start, n in sorted(seen[item]):
            assert start == reached and n > 0
            reached += n
        assert reached == length


@pytest.mark.parametrize("kind", ["mixed", "equal", "long", "short", "one", "none"])
def test_windows_cover_everything_with_little_padding(kind):
    pick = random.Random(2)
    lengths = {
        "mixed": [pick.randint(1, 1023) for _ in range(3000)],
        "equal": [700] * 900,
        "long": [pick.randint(600, 1023) for _ in range(500)],
        "short": [pick.randint(1, 9) for _ in range(2000)],
        "one": [5],
        "none": [],
    }[kind]
    windows = packing.pack_lengths(lengths, 1024)
    covered(windows, lengths, 1024)
    assert len(windows) == -(-sum(lengths) // 1024)


def test_repeats_use_up_the_counts():
    counts = Counter({100: 40, 924: 40, 300: 30, 424: 30})
    combos = packing.combinations(counts, 1024)
    repeats = dict(zip(combos, packing.solve_repeats(combos, counts)))
    assert repeats[(100, 924)] == pytest.approx(40, abs=0.5)
    assert repeats[(300, 300, 424)] > 5 and all(r >= 0 for r in repeats.values())


def test_pieces_of_odd_rows(spark):
    rows = [(1, None), (2, []), (3, list(range(1, 3000))), (3, [7]), (None, [9] * 1023), (4, [5] * 2047)]
    rows = [(k, ids, "clash", "clash") for k, ids in rows]
    table = spark.createDataFrame(rows, "doc_id long, ids array<int>, start string, offset string")
    pieces = packing.pack_sequences(table).collect()
    assert sum(p["length"] for p in pieces) == sum(len(ids or []) + 1 for _, ids, *_ in rows)
    whole = b"".join(p["ids"] for p in sorted(pieces, key=lambda p: p["start"]) if p["doc_id"] == 4)
    assert zlib.crc32(whole) == zlib.crc32(np.array([5] * 2047 + [0], "<u4").tobytes())
    used = defaultdict(list)
    for p in pieces:
        assert len(p["ids"]) == 4 * p["length"]
        used[p["sequence_id"]].append((p["offset"], p["length"]))
    for parts in used.values():
        reached = 0
        for offset, length in sorted(parts):
            assert offset == reached
            reached += length
        assert reached <= 1024
    assert packing.pack_sequences(table.limit(0)).count() == 0
    assert {p["doc_id"] for p in packing.pack_sequences(table, separator=None).collect()} == {None, 3, 4}
