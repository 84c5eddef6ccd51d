"""A pipeline over a document table: good text, known language, no copies, packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next one's docs. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from turnstile.llm import exact_dedup, language_id, packing, quality_classifier, simhash_dedup
from turnstile.session import stage

VOCABULARY = "word_bpe_49k.json"


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the table of labels."""
    return quality_classifier.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose letters are mostly of one learned language."""
    return language_id.keep_known_language(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest id."""
    return simhash_dedup.drop_near_duplicates(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per packed piece."""
    return packing.pack(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality classifier", keep_good_quality),
    ("language ID", keep_known_language),
    ("exact dedup", drop_exact_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("packing", pack_sequences),
]

# SQL expresses neither the classifiers, the fingerprints nor the tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, step) in enumerate(STAGES, 1):
        docs = step(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stage(docs, f"pipeline-{number}")
    return docs
