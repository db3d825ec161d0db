"""A corpus from raw documents to packed sequences: language, toxicity, near-duplicates, packing.

Every stage takes the documents that the one before kept. All but the last return documents again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, language, minhash, packing, toxicity
from ledgerloom.llm.stored import package_on_workers, stored


def _unused(docs: DataFrame) -> str:
    """A column name that the documents do not have."""
    name = "_found"
    while name in docs.columns:
        name += "_"
    return name


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; learned from those that name theirs.

    Null, empty and letterless texts have no language and go. Repeated rows and null keys are judged each;
    without any document that names its language none is learned, and all go.
    """
    package_on_workers(spark)
    known = language.learn_dictionaries(docs)
    found = _unused(docs)
    judged = docs.withColumn(found, language.language_of("text", known))
    return judged.where(~F.col(found)["rejected"]).select(*docs.columns)


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half; learned from the labels there are.

    Null, empty and wordless texts score 0 and stay. Repeated rows and null keys are judged each.
    """
    package_on_workers(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    detector = toxicity.learn_detector(docs, labels)
    found = _unused(docs)
    scored = docs.withColumn(found, toxicity.toxicity_of(spark, "text", detector))
    return scored.where(F.col(found) < 0.5).select(*docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first row of each group of near-duplicates, and all that belong to none.

    Rows are told apart by numbers of their own, so repeated and null doc_ids do not matter: the least doc_id
    comes first, null last, of equal ones the least number. Five words to a shingle and a similarity of 0.8,
    for which 30 bands of 5 lose one link in a hundred thousand.
    """
    package_on_workers(spark)
    settings = minhash.Settings(shingle=5, percent=80, bands=30)
    number = _unused(docs)
    numbered = stored(docs.withColumn(number, F.monotonically_increasing_id()))
    texts = numbered.select(number, "text")
    grouped = minhash.near_duplicates(texts, key=number, settings=settings).select(number, "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", F.col(number).alias("row"))
    rows = numbered.select(number, order.alias("place")).join(grouped, number)
    first = rows.groupBy("component_id").agg(F.min("place")["row"].alias(number))
    return numbered.join(first.select(number), number, "left_semi").select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 ids.

    A null or empty text has one id, its end. Repeated rows and null keys are packed each.
    """
    package_on_workers(spark)
    encoded = bpe.encode_texts(docs, public_tokenizers.path("byte_bpe_50k.json"))
    pieces = packing.pack_sequences(encoded)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("language_id", language_id),
    ("toxicity", without_toxic),
    ("near_dedup", without_near_duplicates),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each stored before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs)
    return docs


# Compression, a network and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None
