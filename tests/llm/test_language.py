from random import Random

from pyspark.sql import functions as F

from ledgerloom.llm import language
from ledgerloom.llm.queries import op2_language_id
from conftest_path import FOLDER


def test_held_out_accuracy(spark, documents):
    result = op2_language_id(spark, FOLDER).where("held_out").join(documents.select("doc_id", "lang"), "doc_id")
    right, all_ = result.select(F.sum((F.col("lang_pred") == F.col("lang")).cast("int")), F.count("*")).first()
    assert right / all_ >= 0.97


def test_rejections(spark, documents):
    learned = language.learn_dictionaries(documents)
    assert {name for name, _ in learned} == {"de", "en", "es", "fr"} and learned[0][0] == "en"
    assert all(0 < len(content) <= language.DICTIONARY_BYTES for _, content in learned)
    judged = documents.select(language.language_of("text", learned).alias("x"))
    assert judged.where("x.rejected").count() <= documents.count() // 100
    every = documents.select(language.language_of("text", learned, min_margin=1.0).alias("x"), F.octet_length("text").alias("n"))
    assert every.where("n >= 200").where("NOT x.rejected").count() == 0


def test_odd_rows(spark, documents, odd_texts, no_texts):
    learned = language.learn_dictionaries(documents)
    rows = odd_texts.select("doc_id", language.language_of("text", learned).alias("x")).collect()
    by_key = {r["doc_id"]: tuple(r["x"]) for r in rows}
    assert by_key[1] == by_key[2] == by_key[3] == by_key[8] == ("und", 0.0, True)
    assert len(rows) == odd_texts.count() and all(0 <= s <= 1 for _, s, _ in by_key.values())
    assert by_key[5][0] in {"de", "en", "es", "fr"}
    assert language.learn_dictionaries(no_texts) == ()
    assert no_texts.select(language.language_of("text", learned)).count() == 0
    assert {r[0]["lang_pred"] for r in odd_texts.select(language.language_of("text", ())).collect()} == {"und"}


def test_strange_texts_go_and_clean_ones_stay(spark, documents):
    """A language that was left out, and letters at random, at every length."""
    random = Random(4)
    junk = ["".join(random.choices("abcdefghijklmnopqrstuvwxyz ", k=n)) for n in (40, 150, 400) for _ in range(60)]
    held_out, training = documents.where("doc_id % 4 = 1"), documents.where("doc_id % 4 <> 1")

    def rejected(texts, learned):
        found = texts.select(language.language_of("text", learned)["rejected"]).collect()
        return sum(r[0] for r in found) / len(found)

    every = language.learn_dictionaries(training)
    assert rejected(spark.createDataFrame([(t,) for t in junk], "text string"), every) >= 0.98
    for cut in (100, 200, 100_000):
        texts = held_out.where(F.length("text") >= 100).select("lang", F.substring("text", 1, cut).alias("text"))
        assert rejected(texts, every) <= 0.02
        for name in ("de", "es"):
            others = language.learn_dictionaries(training.where(F.col("lang") != name))
            assert rejected(texts.where(F.col("lang") == name), others) >= 0.75


def test_languages_of_copies_have_dictionaries(spark):
    """The sample is taken of different texts: thousands of copies do not push a language out of it."""
    texts = {f"l{k}": f"{word} " * 30 for k, word in enumerate(("alpha", "beta", "gamma", "delta"))}
    copies = spark.range(50_000).crossJoin(spark.createDataFrame(list(texts.items()), "lang string, text string"))
    others = spark.range(300).selectExpr("'l0' AS lang", "concat('other ', id) AS text")
    learned = dict(language.learn_dictionaries(copies.select("lang", "text").union(others)))
    assert learned.keys() == texts.keys()
    assert learned["l1"].decode() == texts["l1"] and len(learned["l0"].decode().split("\n")) == language.ROWS_PER_LANGUAGE


def test_rare_languages_are_learned(spark):
    """Every language of 250 has a dictionary, within the bytes of all, and its texts are told by it."""
    random = Random(8)
    words = {f"l{k:03}": ["".join(random.choices("abcdefghijklmnop", k=9)) for _ in range(12)] for k in range(250)}
    texts = [(name, " ".join(random.choices(own, k=20))) for name, own in words.items() for _ in range(3)]
    labelled = spark.createDataFrame(texts, "lang string, text string")
    learned = language.learn_dictionaries(labelled)
    assert {name for name, _ in learned} == words.keys()
    found = labelled.select("lang", language.language_of("text", learned)["lang_pred"].alias("found")).collect()
    assert all(r["lang"] == r["found"] for r in found)
    small = language.learn_dictionaries(labelled, all_bytes=250 * 600)
    assert len(small) == 250 and all(0 < len(content) <= 600 for _, content in small)
