"""From raw documents to packed token sequences: five stages, each written and read again.

A stage takes (spark, docs, sf_dir) and returns the next stage's documents; the last returns the packed pieces. All stages but
the last return the columns of ``documents``, with n_chars following the text.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import public_tokenizers  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tidemark.llm import best_fit, language_id, ngram_join, secrets, suffix_dedup  # noqa: E402
from tidemark.llm.common import discard, written  # noqa: E402
from tidemark.session import prepare  # noqa: E402

REPEATED_BYTES = 240  # a little less than fifty words


def counted(docs: DataFrame) -> DataFrame:
    """n_chars of the text as it is now; null texts have none."""
    kind = dict(docs.dtypes)["n_chars"]
    return docs.withColumn("n_chars", F.length("text").cast(kind))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: null texts, texts without a letter, and those that fit two languages alike."""
    prepare(spark)
    return language_id.clean(docs, language_id.learn(docs))


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row, the one of the smallest id, of each group of near copies: five words, similarity 0.8."""
    prepare(spark)
    return ngram_join.one_per_class(docs, words=5, percent=80)


def unrepeated_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts strings of REPEATED_BYTES bytes or more that occur elsewhere out of the texts; no document is dropped."""
    prepare(spark)
    return counted(suffix_dedup.without_repeats(docs, length=REPEATED_BYTES))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts; no document is dropped."""
    prepare(spark)
    return counted(secrets.redact(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2,048 tokens."""
    prepare(spark)
    return best_fit.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", known_language),
    ("ngram_join", distinct_texts),
    ("suffix_dedup", unrepeated_text),
    ("secrets", without_secrets),
    ("best_fit", packed),
]

# compression, suffix arrays and packing are not expressible in SQL; tests/llm compares run() with a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        earlier, docs = docs, written(stage(spark, docs, sf_dir), name)
        discard(earlier)  # the given table is not one of ours and stays
    return docs
