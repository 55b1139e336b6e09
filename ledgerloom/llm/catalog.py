"""The registered queries of this package, each over its whole table, and their oracle SQL."""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (alignment, attribution, bpe, chat, knn, langid, mixing, negatives,
                            oph, simhash, tokenfile, transducer, urlfilter)
from ledgerloom.llm.common import new_folder, staged, table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECE_TOKENIZER = public_tokenizers.path("piece_bpe_32k.model")


def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return (bpe.encode_documents(docs, RANKS, PATTERN)
            .select("doc_id", *[c.alias(n) for n, c in bpe.digests().items()]))


def op2_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "tokens")
    tokenfile.write(table(spark, folder, "documents"), path, WORD_TOKENIZER)
    return tokenfile.read(spark, path).select(
        "doc_id", "start", "n_tokens", tokenfile.crc32_of(F.col("token_ids")).alias("ids_crc32"))


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select(
        "doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op4_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return knn.top_k(table(spark, folder, "embeddings"))


OP4_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, s.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, s.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM (SELECT DISTINCT vec_id, v FROM whole WHERE vec_id % 100 = 0) q
       JOIN whole s ON q.vec_id <> s.vec_id)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place
  FROM scored)
WHERE place <= 10
"""


def op5_one_permutation(spark: SparkSession, folder: str) -> DataFrame:
    return oph.edit_check(table(spark, folder, "documents"))


RULES = (urlfilter.Rule("allow", "org", "/"), urlfilter.Rule("block", "example.org", "/es/"),
         urlfilter.Rule("block", "example.org", "/en/1"), urlfilter.Rule("allow", "com", "/fr/"),
         urlfilter.Rule("block", "com", "/de/"))


def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    return urlfilter.judge(pages, RULES).select("page_id", "host", "path", "rule", "verdict")


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return attribution.count_tokens(table(spark, folder, "documents"), RANKS, PATTERN)


def op8_chat_tree(spark: SparkSession, folder: str) -> DataFrame:
    talk = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    # One more conversation, in which the texts look like a template's marks.
    marks = spark.sql("""SELECT CAST(-1 AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, role,
                                '</s>[INST] ok [/INST]' AS text
                         FROM VALUES (0, 'user'), (1, 'assistant') AS t(turn, role)""")
    tree, index = chat.prefix_tree(talk.unionByName(marks), RANKS, PATTERN)
    return chat.read_back(staged(tree), index, RANKS, PATTERN)


def op9_poisson_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


OP9_SQL = """
WITH RECURSIVE sized AS (
  SELECT *, greatest(length(coalesce(text, '')), 1) AS n FROM documents),
volumes AS (SELECT source, CAST(sum(n) AS BIGINT) AS volume FROM sized GROUP BY source),
weighted AS (SELECT *, sqrt(CAST(volume AS DOUBLE)) AS weight FROM volumes),
rates AS (
  SELECT source, round(weight * (SELECT CAST(sum(volume) AS BIGINT) FROM weighted)
                       / ((SELECT sum(weight) FROM weighted) * volume), 9) AS rate
  FROM weighted),
steps AS (
  SELECT source, rate, 0 AS k, -rate AS log_p, exp(-rate) AS reached FROM rates
  UNION ALL
  SELECT source, rate, k + 1, log_p + ln(rate / (k + 1)),
         reached + exp(log_p + ln(rate / (k + 1)))
  FROM steps WHERE k < ceil(rate + 12 * sqrt(rate) + 20)),
drawn AS (
  SELECT *, CAST('0x' || substr(md5('mix|' || doc_id), 1, 13) AS BIGINT)
            / 4503599627370496.0::DOUBLE AS draw
  FROM documents),
counted AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, s.rate, count(*) AS n
  FROM drawn d JOIN steps s ON d.source = s.source AND s.reached <= d.draw
  GROUP BY ALL)
SELECT doc_id, text, lang, source, n_chars, rate, CAST(c AS INTEGER) AS copy,
       md5('mix|' || doc_id || '|' || c) AS shuffle_key
FROM counted, unnest(range(n)) AS copies(c)
"""


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return langid.identify(spark, docs).select("doc_id", "held_out", "lang_pred", "score")


def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return alignment.align(docs, BYTE_TOKENIZER, PIECE_TOKENIZER)


def op12_bpe_stream(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return (transducer.encode_documents(docs, WORD_TOKENIZER)
            .select("doc_id", *[c.alias(n) for n, c in transducer.digests().items()]))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select(
        "vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10)
        .otherwise(F.col("label")).alias("label"))
    return negatives.mine(vectors)


OP13_SQL = """
WITH whole AS (
  SELECT row_number() OVER () AS place, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.place, a.vec_id AS anchor_id, s.vec_id, a.label = s.label AS alike,
         CAST(list_sum(list_transform(list_zip(a.v, s.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM whole a JOIN whole s ON a.vec_id <> s.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id) AS nth
    FROM scored WHERE alike)
  WHERE nth <= 5),
ranked AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, n.vec_id AS negative_id,
         n.score AS negative_score,
         row_number() OVER (PARTITION BY p.place, p.nth ORDER BY n.score DESC, n.vec_id) AS rank
  FROM positives p JOIN scored n ON n.place = p.place AND NOT n.alike
  WHERE 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 3
"""


QUERIES = {f.__name__: f for f in (
    op1_byte_bpe, op2_token_files, op3_simhash, op4_top_k, op5_one_permutation, op6_url_filter,
    op7_token_counts, op8_chat_tree, op9_poisson_mix, op10_language_id,
    op11_token_alignment, op12_bpe_stream, op13_hard_negatives)}
ORACLES = {"op4_top_k": OP4_SQL, "op9_poisson_mix": OP9_SQL,
           "op13_hard_negatives": OP13_SQL}
