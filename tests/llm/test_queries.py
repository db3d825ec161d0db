import hashlib
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import zstandard
from compare import differences, duck
from conftest_path import FOLDER
from pyspark.sql.functions import lit
from test_minhash import brute
from tokenizers import Tokenizer

from ledgerloom.llm import language
from ledgerloom.llm.queries import (
    ORACLES,
    QUERIES,
    op1_bpe_tree,
    op2_language_id,
    op8_packing,
    op9_toxicity,
    remainder,
)
from ledgerloom.llm.stored import stored


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, small_folder, name):
    connection = duck(small_folder)
    assert differences(QUERIES[name](spark, small_folder), connection, ORACLES[name]) == []
    connection.close()


def test_ids_and_pieces_as_the_library(spark, documents):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r["doc_id"]: r["text"] or "" for r in documents.select("doc_id", "text").collect()}
    ids = {k: e.ids for k, e in zip(texts, library.encode_batch(list(texts.values()), add_special_tokens=False))}
    rows = op1_bpe_tree(spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for row in rows:
        own = ids[row["doc_id"]]
        assert row["n_tokens"] == len(own)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, own)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()
    covered, used = Counter(), Counter()
    for row in op8_packing(spark, FOLDER).collect():
        own = np.array([*ids[row["doc_id"]], 0], "<u4")
        piece = own[row["start"] : row["start"] + row["length"]]
        assert row["doc_tokens"] == len(own) and row["ids_crc32"] == zlib.crc32(piece.tobytes())
        covered[row["doc_id"]] += row["length"]
        used[row["sequence_id"]] += row["length"]
    assert covered == {k: len(v) + 1 for k, v in ids.items()}
    assert max(used.values()) <= 1024 and sum(1024 - n for n in used.values()) < 0.01 * sum(used.values())


def test_pipeline_stages(spark, documents):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "toxicity", "near_dedup", "packing"]
    kept = [documents]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(stored(stage(spark, kept[-1], FOLDER)))
        assert kept[-1].columns == documents.columns
        assert kept[-1].exceptAll(kept[-2]).count() == 0
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    assert kept[1].count() >= 0.99 * kept[0].count()
    gone = kept[1].join(kept[2], "doc_id", "left_anti").join(labels, "doc_id")
    toxic = kept[1].join(labels.where("toxic = 1"), "doc_id").count()
    assert gone.where("toxic = 1").count() >= 0.9 * toxic
    assert gone.where("toxic = 0").count() <= 0.05 * kept[1].join(labels.where("toxic = 0"), "doc_id").count()
    groups = brute([tuple(r) for r in kept[2].select("doc_id", "text").collect()], 5, 80)
    assert {r[0] for r in kept[3].select("doc_id").collect()} == {k for k, (_, _, first) in groups.items() if first}
    pieces = corpus_pipeline.packed(spark, kept[3], FOLDER)
    assert {r[0] for r in pieces.select("doc_id").distinct().collect()} == {r[0] for r in kept[3].select("doc_id").collect()}


def test_near_duplicates_go_by_row(spark):
    """One row of each group stays, with repeated and null keys too, and no text goes with another's copy."""
    one, two, three = ("one two three four five six", "red green blue black white grey", "do re mi fa sol la ti")
    rows = [(2, one), (2, one), (1, one), (None, two), (None, two), (3, one), (3, three), (4, None), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.without_near_duplicates(spark, docs, FOLDER).collect()
    assert Counter(map(tuple, kept)) == Counter([(1, one), (None, two), (3, three), (4, None), (4, None)])


def test_language_query_by_plain_compression(spark, documents):
    """Every prediction of the query, recomputed with the same dictionaries in plain loops; and how often it is right."""
    rows = {r["doc_id"]: r for r in documents.collect()}
    learned = language.learn_dictionaries(documents.where(remainder(4) != 2))
    frequent = [name for name, _ in learned]
    right = held = 0
    for row in op2_language_id(spark, FOLDER).collect():
        text = (rows[row["doc_id"]]["text"] or "").lower()
        if not any(c.isalpha() for c in text):
            assert (row["lang_pred"], row["score"]) == ("und", 0.0)
            continue
        data, sizes = text.encode(), {}
        for name, content in learned:
            known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            made = zstandard.ZstdCompressor(
                level=language.LEVEL, dict_data=known, write_checksum=False, write_content_size=False, write_dict_id=False
            )
            step = language.PIECE_BYTES
            sizes[name] = sum(len(made.compress(data[k : k + step])) for k in range(0, len(data), step))
        best, second = sorted(sizes, key=lambda name: (sizes[name], frequent.index(name)))[:2]
        assert row["lang_pred"] == best
        assert row["score"] == pytest.approx(sizes[second] / (sizes[best] + sizes[second]))
        if row["held_out"]:
            held += 1
            right += best == rows[row["doc_id"]]["lang"]
    assert held > 200 and right >= 0.98 * held


def test_toxicity_query_on_held_out_documents(spark, documents):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = op9_toxicity(spark, FOLDER).collect()
    assert len(rows) == documents.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    toxic = np.array([r["score"] for r in rows if r["held_out"] and labels.get(r["doc_id"]) == 1])
    clean = np.array([r["score"] for r in rows if r["held_out"] and labels.get(r["doc_id"]) == 0])
    above = (toxic[:, None] > clean).mean() + (toxic[:, None] == clean).mean() / 2
    assert len(toxic) > 3 and above >= 0.8


def test_stages_on_odd_rows(spark, documents):
    """Null, empty, repeated and wordless texts, null keys and a column that bears a name the stages use."""
    some = documents.orderBy("doc_id").limit(150)
    text = "Les mots de la langue française sont ici, et encore des mots."
    odd = [(-1, None, None), (-2, "", "fr"), (-3, " \t ", "en"), (-4, "12 34", "en"), (-5, text, "fr"), (-5, text, "fr"), (None, text, None)]
    kinds = documents.schema
    extra = spark.createDataFrame([(k, t, la, "s", 0) for k, t, la in odd], "doc_id long, text string, lang string, source string, n_chars long")
    docs = some.unionByName(extra.select(*[extra[f.name].cast(f.dataType) for f in kinds])).withColumn("_found", lit("clash"))

    def odd_rows(table):
        return Counter((r["doc_id"], r["text"]) for r in table.collect() if r["doc_id"] is None or r["doc_id"] < 0)

    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, FOLDER)
        assert kept.columns == docs.columns and kept.exceptAll(docs).count() == 0
        found = odd_rows(kept)
        if name == "language_id":
            assert set(found) <= {(-5, text), (None, text)}
        elif name == "toxicity":
            # texts without words score 0 and stay
            assert all(found[k, t] == 1 for k, t, _ in odd[:4])
        else:
            assert found == Counter([(-1, None), (-2, ""), (-3, " \t "), (-4, "12 34"), (-5, text)])
        assert stage(spark, docs.limit(0), FOLDER).count() == 0
    pieces = corpus_pipeline.packed(spark, docs, FOLDER).collect()
    assert Counter(r["doc_id"] for r in pieces if r["start"] == 0) == Counter(r["doc_id"] for r in docs.collect())
    assert corpus_pipeline.packed(spark, docs.limit(0), FOLDER).count() == 0
