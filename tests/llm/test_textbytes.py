"""Texts that differ must not pass as equal: words of Thue and Morse defeat sums of powers modulo 2^64."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerloom.llm import bpe, minhash, textbytes

LIBRARY = public_tokenizers.path("byte_bpe_50k.json")


def pair(size):
    letters = [bin(n).count("1") & 1 for n in range(size)]
    return "".join("ab"[k] for k in letters), "".join("ba"[k] for k in letters)


@pytest.mark.parametrize("size", [256, 1024, 2048, 4096])
def test_hashes_differ(size):
    one, two = pair(size)
    found = textbytes.words([one.encode(), two.encode(), f"{one} {two}".encode()]).hashes
    assert len(set(found.tolist())) == 2 and found[0] == found[2] and found[1] == found[3]


def test_hashes_depend_on_every_byte_and_on_length():
    spans = [b"\x01" * n for n in range(1, 40)] + [b"\x01" * n + b"\x02" + b"\x01" * (20 - n) for n in range(21)]
    spans += [b"x" * 511, b"x" * 512, b"x" * 513, b"x" * 600 + b"y"]
    found = textbytes.words([b" ".join(spans)]).hashes
    assert len(set(found.tolist())) == len(spans) and (textbytes.words(spans).hashes == found).all()
    assert len(textbytes.span_hashes(np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64))) == 0


def test_encoded_as_the_library(spark):
    """op1 and op8 take their ids from here."""
    texts = [t for size in (1024, 2048, 4096) for t in pair(size)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = bpe.decode_ids(bpe.encode_texts(rows.coalesce(1), LIBRARY), LIBRARY).collect()
    library = Tokenizer.from_file(LIBRARY)
    for row in found:
        assert row["ids"] == library.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        assert row["decoded"] == texts[row["doc_id"]]


def test_not_near_duplicates(spark):
    rows = [(n, " ".join([t] * 4)) for n, t in enumerate(pair(2048))]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r["component_id"] for r in sorted(found)] == [0, 1]
