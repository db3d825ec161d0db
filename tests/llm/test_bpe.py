import random

import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "the", " ", "  ", "\n", "\t", "é", "ß", " ", "\u0085", "12", ".", "'s", "'", "ll", "日本", "🙂", "¿", "　"]
PARTS += ["\r\n", "\x1c", "\x7f", "<|endoftext|>", "<|", "े", "²"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_any_text_as_the_library(library):
    pick = random.Random(3)
    model = bpe.bpe(PATH)
    for _ in range(400):
        texts = ["".join(pick.choice(PARTS) for _ in range(pick.randint(0, 30))) for _ in range(4)]
        expected = library.encode_batch(texts, add_special_tokens=False)
        found = model.encode_all([t.encode() for t in texts], leaf=pick.choice([1, 3, 512]))
        assert [f.tolist() for f in found] == [e.ids for e in expected]
        assert [model.decode(e.ids) for e in expected] == texts


@pytest.mark.parametrize("leaf", [1, 2, 7, 64])
def test_tree_agrees_with_the_whole(library, leaf):
    pick = random.Random(leaf)
    model = bpe.bpe(PATH)
    runs = ["".join(pick.choice("abcdefghiklmnoprstuthéß") for _ in range(pick.randint(1, 1500))) for _ in range(40)]
    for run in [*runs, "a" * 3000, "aab" * 900, "=" * 2000, " " * 1500, "1" * 1500]:
        expected = library.encode(run, add_special_tokens=False).ids
        assert model.encode_all([run.encode()], leaf=leaf)[0].tolist() == expected


def test_bytes_that_are_no_text(library):
    model = bpe.bpe(PATH)
    for ids in ([], [162], [447, 251, 162], [50256, 447], list(range(200))):
        assert model.decode(ids) == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("spread", [bpe.SPREAD_CHARS, 500])
def test_odd_rows_both_ways(odd_texts, library, spread):
    rows = bpe.decode_ids(bpe.encode_texts(odd_texts, PATH, spread_chars=spread, part_bytes=2_000), PATH).collect()
    assert rows[0].asDict().keys() == {"doc_id", "ids", "decoded"}
    expected = [(r["doc_id"], r["text"] or "") for r in odd_texts.select("doc_id", "text").collect()]
    assert sorted((r["doc_id"] or -1, r["decoded"]) for r in rows) == sorted((k or -1, t) for k, t in expected)
    for row in rows:
        assert row["ids"] == library.encode(row["decoded"], add_special_tokens=False).ids


def test_no_rows(no_texts):
    assert bpe.decode_ids(bpe.encode_texts(no_texts, PATH), PATH).count() == 0


def test_documents(documents, library):
    rows = bpe.encode_texts(documents, PATH, spread_chars=8_000, part_bytes=5_000).join(documents, "doc_id").select("text", "ids").collect()
    expected = library.encode_batch([r["text"] or "" for r in rows], add_special_tokens=False)
    assert [r["ids"] for r in rows] == [e.ids for e in expected]


def test_workers_do_not_keep_the_tokenizer_after_a_task(spark, odd_texts):
    def kept(batches):
        import gc

        from ledgerloom.llm.bpe import ByteBpe

        found = sum(isinstance(x, ByteBpe) for x in gc.get_objects())
        for batch in batches:
            yield pd.DataFrame({"kept": [found] * len(batch)})

    before = spark.range(8).repartition(8).mapInPandas(kept, "kept int").agg({"kept": "max"}).first()[0]
    encoded = bpe.encode_texts(odd_texts.repartition(8), PATH, spread_chars=1 << 20)
    assert encoded.count() == odd_texts.count()
    after = spark.range(8).repartition(8).mapInPandas(kept, "kept int").agg({"kept": "max"}).first()[0]
    assert after <= before
