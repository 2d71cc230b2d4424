"""The corpus operators as queries over the driver's tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import chat, fingerprint, language_id, licenses, near_dup, neighbours, packing, quality, sentence_pieces, sharding


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "<|im_end|><|im_start|>assistant ok"
    more = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(more)
    return chat.digests(chat.format_conversations(turns, public_tokenizers.path("byte_bpe_50k.json")))


# an escaped text has a backslash more wherever "<", any number of backslashes and "|" stand together;
# the markers around a turn have 12 + 10 + 10 characters
OP1 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -1, turn, role, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(turn, role))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(32 + length(role) + length(text)
    + len(regexp_extract_all(role, '<\\*\|')) + len(regexp_extract_all(text, '<\\*\|')))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    starts = F.col("base.first_word")
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(F.col("base.label")).alias("base_labels"),
        joined(F.concat("base.label", "detections.label")).alias("labels"),
        F.coalesce(F.array_max("detections.confidence"), F.lit(0.0)).alias("score"),
    )


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.shard(table(spark, sf_dir, "documents"), 8)
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), quality.grade(), top=2)
    return quality.score(docs, model, wanted=2)


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


OP5 = """
WITH v AS (
  SELECT vec_id, min(embedding::DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
  GROUP BY vec_id),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""


def packed(docs: DataFrame, cache_bytes: int = packing.CACHE_BYTES) -> DataFrame:
    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), cache_bytes=cache_bytes)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = sentence_pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("doc_id", "n_tokens", F.crc32("ids").alias("ids_crc32"), F.sha2("decoded", 256).alias("decoded_sha256"), "parity")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(~language_id.held_out()))
    # the mark is a function of the id that the prediction returns, so no join
    return language_id.predict(docs, model).select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


OP9 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common c JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * c.n >= 75 * (p.n + q.n - c.n)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT doc_id, doc_id AS r FROM documents
  UNION
  SELECT reach.doc_id, b FROM reach JOIN both_ways ON a = r)
SELECT d.doc_id, coalesce(max(s.n), 0)::BIGINT AS n_shingles, min(r) AS component_id, d.doc_id = min(r) AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN reach USING (doc_id) GROUP BY d.doc_id
"""


def op10_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprint.fingerprints(table(spark, sf_dir, "documents"), with_text=False)
    return found.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


# ---- what SQL can say of queries that it can't express whole


def license_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and places of the base phrases; -1 where there is no place."""
    return op2_licenses(spark, sf_dir).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").na.fill(-1, ["first_word", "last_word"])


LICENSE_BASE = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
places AS (
  SELECT doc_id, len(w) AS n_words,
    list_filter(range(len(w)), lambda i: w[i+1] = 'mit' AND w[i+2] = 'license') AS mit,
    list_filter(range(len(w)), lambda i: w[i+1] = 'apache' AND w[i+2] = 'license') AS apache,
    list_filter(range(len(w)), lambda i: w[i+1] = 'general' AND w[i+2] = 'public' AND w[i+3] = 'license') AS gpl
  FROM words)
SELECT doc_id, n_words, len(mit) + len(apache) + len(gpl) AS n_base,
  coalesce(list_min(list_concat(mit, apache, gpl)), -1) AS first_word, coalesce(list_max(list_concat(mit, apache, gpl)), -1) AS last_word,
  concat_ws(',', CASE WHEN len(apache) > 0 THEN 'apache' END, CASE WHEN len(gpl) > 0 THEN 'gpl' END, CASE WHEN len(mit) > 0 THEN 'mit' END) AS base_labels
FROM places
"""


def shard_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of the groups of equal texts that were put together, and in how many shards each lies."""
    found = op3_sharding(spark, sf_dir).join(table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("text_sha256")), "doc_id")
    return found.groupBy("text_sha256").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"), F.countDistinct("shard").alias("shards"))


SHARD_GROUPS = """
SELECT sha256(text) AS text_sha256, count(*) AS n, sum(strlen(coalesce(text, '')) + 1)::BIGINT AS bytes, 1::BIGINT AS shards
FROM documents WHERE doc_id IS NOT NULL GROUP BY text
"""


def language_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents are held out, and which can have no language."""
    return op8_language_id(spark, sf_dir).select("doc_id", "held_out", (F.col("lang_pred") == "und").alias("undetermined"))


# a CRC goes through the bits of the digits, the lowest of each first
LANGUAGE_MARKS = r"""
WITH bits AS (
  SELECT doc_id, text, flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: list_transform(range(8), lambda k: (ascii(ch) >> k) & 1))) AS b
  FROM documents),
crc AS (
  SELECT doc_id, text, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, bit: xor(c >> 1, (xor(c, bit) & 1) * 3988292384::BIGINT)), 4294967295::BIGINT) AS c
  FROM bits)
SELECT doc_id, c % 4 = 2 AS held_out, text IS NULL OR NOT regexp_matches(text, '\p{L}') AS undetermined FROM crc
"""


def edited_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_fingerprint(spark, sf_dir).select("doc_id", "n_chars", "edited_sha256")


EDITED_DOCUMENTS = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(lead(coalesce(text, '')) OVER w, first_value(coalesce(text, '')) OVER w) AS next
  FROM documents WINDOW w AS (ORDER BY doc_id))
SELECT doc_id, length(text) AS n_chars, sha256(left(text, length(text) - length(text) // 2) || left(next, length(text) // 2)) AS edited_sha256
FROM d
"""

QUERIES = {
    "op1_chat": op1_chat,
    "op2_licenses": op2_licenses,
    "op3_sharding": op3_sharding,
    "op4_quality": op4_quality,
    "op5_neighbours": op5_neighbours,
    "op6_packing": op6_packing,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_language_id": op8_language_id,
    "op9_minhash": op9_minhash,
    "op10_fingerprint": op10_fingerprint,
    "license_base": license_base,
    "shard_groups": shard_groups,
    "language_marks": language_marks,
    "edited_documents": edited_documents,
}

ORACLES: dict[str, str] = {
    "op1_chat": OP1,
    "op5_neighbours": OP5,
    "op9_minhash": OP9,
    "license_base": LICENSE_BASE,
    "shard_groups": SHARD_GROUPS,
    "language_marks": LANGUAGE_MARKS,
    "edited_documents": EDITED_DOCUMENTS,
}
