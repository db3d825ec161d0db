"""The operators over their whole test tables, by query name, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    balltree,
    bpe,
    chat,
    collocations,
    crosspolytope,
    language,
    minhash,
    neighbours,
    packing,
    repeats,
    scoring,
    toxicity,
    urls,
)
from ledgerloom.llm.stored import package_on_workers

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def remainder(divisor: int) -> Column:
    """What folds are told apart by: crc32 of doc_id as text, modulo `divisor`."""
    return F.crc32(F.col("doc_id").cast("string")) % divisor


BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def op1_bpe_tree(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of every document's ids and of the text they decode to."""
    encoded = bpe.encode_texts(table(spark, folder, "documents"), BYTE_BPE)
    written = F.array_join(F.col("ids").cast("array<string>"), ",")
    return bpe.decode_ids(encoded, BYTE_BPE).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(written, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Languages learned from three folds of four, predicted for all documents."""
    documents = table(spark, folder, "documents")
    learned = language.learn_dictionaries(documents.where(remainder(4) != 2))
    found = documents.select(
        "doc_id", (remainder(4) == 2).alias("held_out"), language.language_of("text", learned).alias("found")
    )
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score", "found.rejected")


def op3_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of all documents under a model of four folds of five."""
    return scoring.score_documents(table(spark, folder, "documents"), remainder(5) == 1)


# Conversation -1 holds control strings as texts.
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def op4_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of every conversation, read back from its formatted examples."""
    extra = spark.createDataFrame(
        [(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)],
        "conv_id long, turn long, role string, text string",
    )
    turns = table(spark, folder, "conversations").select(*extra.columns)
    examples = chat.format_examples(turns.unionByName(extra))
    trained = chat.trained_text(F.col("formatted"), F.col("loss_start"), F.col("loss_end"))
    digests = examples.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("longest"),
        F.sort_array(F.collect_list(F.struct("example", trained.alias("text")))).alias("trained"),
        F.sum(F.length("formatted")).cast("long").alias("formatted_chars"),
    )
    loss = F.array_join(F.transform("trained", lambda t: F.coalesce(t["text"], F.lit(""))), "")
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return (
        digests.withColumn("turns", chat.read_turns(F.col("longest")))
        .withColumn("loss", loss)
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
            F.length("loss").cast("long").alias("loss_chars"),
            F.sha2("loss", 256).alias("loss_sha256"),
            "formatted_chars",
        )
    )


OP4_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{CONTROL_TEXT}'), (-1, 1, 'assistant', '{CONTROL_TEXT}')
), placed AS (
  SELECT *,
    length('<|im_start|>' || '<|im_end|>') + 2
      + length(replace(regexp_replace(role, '<(%*)([|n])', '<%\\1\\2', 'g'), chr(10), '<n'))
      + length(regexp_replace(text, '<(%*)\\|', '<%\\1|', 'g')) AS size,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS place,
    count(*) OVER (PARTITION BY conv_id) AS turns
  FROM turns
), grown AS (
  SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY place) AS upto FROM placed
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY place))
    AS loss_sha256,
  sum(CASE WHEN role = 'assistant' OR place = turns THEN upto ELSE 0 END)::BIGINT AS formatted_chars
FROM grown GROUP BY conv_id
"""

def op5_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Shingle counts, components and kept rows of all documents; texts without words link with nothing."""
    return minhash.near_duplicates(table(spark, folder, "documents"))


URL_RULES = (
    urls.Rule("allow", "com", "/"),
    urls.Rule("block", "example.com", "/en/"),
    urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"),
    urls.Rule("block", "net", "/fr/"),
)


def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdicts on all pages; null urls and those without `://` have an empty host and path."""
    return urls.judge_urls(table(spark, folder, "pages"), URL_RULES)


OP6_SQL = """
WITH rest AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), located AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
), judged AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.www.example.com' AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/') THEN 'com/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/fr/') THEN 'net/fr/'
  END AS rule FROM located
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""

def op7_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest of every twentieth vector among all others; odd vectors take no part."""
    vectors = table(spark, folder, "embeddings")
    return neighbours.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's ids in windows of 1024, each piece with the checksum of its ids."""
    encoded = bpe.encode_texts(table(spark, folder, "documents"), BYTE_BPE)
    return packing.pack_sequences(encoded).select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of all documents by a detector that learned from the labels of four folds of five."""
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    detector = toxicity.learn_detector(documents, labels.where(remainder(5) != 0))
    scored = documents.select(
        "doc_id",
        (remainder(5) == 0).alias("held_out"),
        toxicity.toxicity_of(spark, "text", detector).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op10_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The 5 highest whole-number products of every fiftieth vector with all others; odd vectors take no part."""
    vectors = table(spark, folder, "embeddings")
    return balltree.exact_top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


def op11_vector_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Links, components and kept rows of all vectors at a cosine of 0.95; odd ones as the operator says."""
    return crosspolytope.near_duplicate_vectors(table(spark, folder, "embeddings"), cosine=0.95)


OP11_SQL = """
WITH RECURSIVE usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95
), reached AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION
  SELECT reached.vec_id, links.b FROM reached JOIN links ON links.a = reached.other
)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = reached.vec_id) AS n_links,
  min(other) AS component_id, vec_id = min(other) AS kept
FROM reached GROUP BY vec_id
"""


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The 2000 best phrases of each language; null texts and languages as the operator says."""
    return collocations.mine_collocations(table(spark, folder, "documents"))


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
), phrases AS (
  SELECT lang, size, array_to_string(words[place:place + size - 1], ' ') AS phrase, count(*) AS f
  FROM (
    SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS place
    FROM worded, (SELECT unnest(range(1, 5)) AS size) WHERE len(words) >= size
  ) GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM phrases WHERE size = 1 GROUP BY lang
), candidates AS (
  SELECT * FROM phrases WHERE size >= 2 AND f >= 30
), cuts AS (
  SELECT c.lang, c.phrase, c.size, c.f AS a, k, l.f AS l, r.f AS r,
    ((2000000::HUGEINT * c.f) // (l.f + r.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, size)) AS k, string_split(phrase, ' ') AS words FROM candidates) c
  JOIN phrases l ON l.lang = c.lang AND l.phrase = array_to_string(c.words[1:k], ' ')
  JOIN phrases r ON r.lang = c.lang AND r.phrase = array_to_string(c.words[k + 1:], ' ')
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), held_phrases AS (
  SELECT lang, f, array_to_string(words[place:place + part - 1], ' ') AS phrase
  FROM (
    SELECT *, unnest(range(1, size - part + 2)) AS place
    FROM (SELECT lang, f, size, string_split(phrase, ' ') AS words, unnest(range(2, size)) AS part FROM candidates)
  )
), left_over AS (
  SELECT * FROM lowest WHERE NOT EXISTS (
    SELECT 1 FROM held_phrases i
    WHERE i.lang = lowest.lang AND i.phrase = lowest.phrase AND 100::HUGEINT * i.f >= 80::HUGEINT * lowest.a
  )
)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM left_over
) JOIN totals USING (lang) WHERE rank <= 2000
"""


def made_periodic(text: Column, key: Column) -> Column:
    """The text, every tenth by the checksum of its key with its last words replaced by repeats of some of them."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    h = F.crc32(key.cast("string"))
    g, n = F.floor(h / 10), F.size(words).cast("long")
    begin = (g % n).cast("int")
    rest = (n - begin).cast("int")
    period = (F.floor(rest / (3 + g % 8)) + 1).cast("int")
    block = F.slice(words, begin + 1, period)
    tail = F.slice(F.flatten(F.array_repeat(block, F.ceil(rest / period).cast("int"))), F.lit(1), rest)
    changed = F.array_join(F.concat(F.slice(words, F.lit(1), begin), tail), " ")
    return F.when((h % 10 == 0) & (n > 0), changed).otherwise(text)


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of the runs of every document, every tenth made periodic first; null texts have none."""
    documents = table(spark, folder, "documents")
    changed = documents.select("doc_id", made_periodic(F.col("text"), F.col("doc_id")).alias("text"))
    found = repeats.periodic_runs(changed)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    written = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    longest = F.array_min(
        F.transform("runs", lambda r: F.struct((-r["length"]).alias("shorter"), r["start"].alias("start"), r["period"].alias("period")))
    )
    found = found.withColumns({"longest": longest, "written": written})
    length = -F.col("longest.shorter")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "longest.start",
        length.alias("length"),
        "longest.period",
        F.floor(length * 1000 / F.col("longest.period")).alias("exponent_milli"),
        F.sha2("written", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def _shipped(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        package_on_workers(spark)
        return query(spark, folder)

    return run


_OPERATORS = (
    op1_bpe_tree,
    op2_language_id,
    op3_lm_scoring,
    op4_chat_formatting,
    op5_minhash_dedup,
    op6_url_filter,
    op7_nearest_neighbours,
    op8_packing,
    op9_toxicity,
    op10_exact_top_k,
    op11_vector_dedup,
    op12_collocations,
    op13_periodic_runs,
)
OP10_SQL = """
WITH parts AS (
  SELECT vec_id, unnest(range(len(embedding))) AS place, unnest(embedding) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), whole AS (
  SELECT vec_id, place, floor(256 * x::DOUBLE)::BIGINT AS x FROM parts
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, sum(q.x * c.x)::BIGINT AS score
  FROM whole q JOIN whole c ON q.place = c.place AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0 GROUP BY ALL
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores
) WHERE rank <= 5
"""

QUERIES: dict[str, Query] = {query.__name__: _shipped(query) for query in _OPERATORS}
ORACLES: dict[str, str] = {
    "op4_chat_formatting": OP4_SQL,
    "op6_url_filter": OP6_SQL,
    "op10_exact_top_k": OP10_SQL,
    "op11_vector_dedup": OP11_SQL,
    "op12_collocations": OP12_SQL,
}
