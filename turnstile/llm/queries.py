"""Registered queries of the numbered operators and the SQL twins of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.llm import (
    bpe,
    chat_format,
    chosen_path,
    cross_tokenizer,
    exact_dedup,
    hard_negatives,
    language_id,
    lm_scoring,
    packing,
    quality_classifier,
    quality_rules,
    simhash_dedup,
    toxicity,
)
from turnstile.llm.batches import fold_of

BYTE_VOCABULARY = "byte_bpe_50k.json"
WORD_VOCABULARY = "word_bpe_49k.json"
PIECE_MODEL = "piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"),
                                  public_tokenizers.path(WORD_VOCABULARY))


@_query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules.quality_cascade(docs, quality_rules.order_rules(docs))


ORACLES["op2_quality_rules"] = """
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT r, unnest(list) AS word, generate_subscripts(list, 1) AS i
  FROM (SELECT r, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS list FROM texts)),
per_text AS (SELECT r, count(*) AS n_words, sum(length(word)) AS word_chars FROM words GROUP BY r),
windows AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, w1, w2, w3) AS n FROM (
    SELECT r, i, word AS w1, lead(word, 1) OVER (PARTITION BY r ORDER BY i) AS w2,
           lead(word, 2) OVER (PARTITION BY r ORDER BY i) AS w3 FROM words)
  WHERE w3 IS NOT NULL),
repeats AS (
  SELECT r, count(DISTINCT i + k) AS n_repeat_words
  FROM windows, (SELECT unnest([0, 1, 2]) AS k) WHERE n >= 2 GROUP BY r),
lines AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r),
numbers AS (
  SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words,
         coalesce(word_chars, 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         length(regexp_replace(text, '[^A-Z]', '', 'g'))::BIGINT AS n_capitals,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM texts LEFT JOIN per_text USING (r) LEFT JOIN repeats USING (r) LEFT JOIN lines USING (r)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM numbers)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 2 * n_symbols > n_words OR 2 * n_capitals > word_chars
            OR 2 * n_dup_lines > n_lines OR word_chars < 2 * n_words
            OR word_chars > 25 * n_words) AS kept
FROM judged
"""


@_query
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.score_quality(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query
def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    control = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                    "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.read_back(chat_format.format_conversations(
        turns.unionByName(control), public_tokenizers.path(BYTE_VOCABULARY)))


ORACLES["op5_chat_formatting"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (
  SELECT *, length(regexp_replace(role || chr(10) || text, '([<\[])(\\*)(/?s>|/?INST\]|\|endoftext\|>)',
                                  '\1\\\2\3', 'g')) - 1 AS chars
  FROM turns),
joined AS (
  SELECT conv_id, count(*) AS n_turns, sum(chars + 20)::BIGINT AS formatted_chars,
         string_agg(role || chr(10) || text || chr(10), ''
                    ORDER BY turn NULLS FIRST, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                  FILTER (WHERE role = 'assistant'), '') AS learned
  FROM marked GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(learned)::BIGINT AS loss_chars,
       sha256(learned) AS loss_sha256, formatted_chars
FROM joined
"""


@_query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train_languages(language_id.training_rows(docs))
    return language_id.identify_languages(docs, model).select(
        "doc_id", (fold_of(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


@_query
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


ORACLES["op7_exact_dedup"] = """
WITH folded AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS folded
  FROM documents),
grouped AS (
  SELECT folded, max(doc_id) AS keep_id, count(*) AS group_size FROM folded GROUP BY folded)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(folded) AS text_sha256
FROM folded JOIN grouped USING (folded)
"""


@_query
def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "fingerprint", "component_id")


@_query
def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_texts(table(spark, sf_dir, "documents"))


@_query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_VOCABULARY))


QUERIES["pipeline"] = corpus_pipeline.run


@_query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", shifted)
    return hard_negatives.hard_negatives(
        hard_negatives.whole_vectors(rows), F.col("vec_id") % 50 == 0)


ORACLES["op11_hard_negatives"] = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         list_dot_product(a.vector, b.vector)::BIGINT AS score
  FROM usable a JOIN usable b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
ranked AS (
  SELECT p.*, other_id AS negative_id, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id
                            ORDER BY score DESC, other_id)::INTEGER AS rank
  FROM positives p JOIN scores s USING (anchor_id)
  WHERE NOT s.same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 3
"""


@_query
def op12_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chosen_path.similar_sets(table(spark, sf_dir, "documents"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


@_query
def op13_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_tokenizer.link_statistics(
        table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_VOCABULARY),
        public_tokenizers.path(PIECE_MODEL))
