"""The corpus pipeline: five stages over ``documents``, each an operator of ``terrier.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again
as the next stage's ``docs``. All but the last return the columns of ``documents``. SQL can't express
expectation-maximisation and boosted trees, so ``ORACLE_SQL`` is None and the tests hold the stages
against brute force. Stages that send texts to Python ask the session for small Arrow batches.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrier.llm import exact, jaccard, packing, pii, quality
from terrier.llm.common import small_batches
from terrier.sources.scratch import settle


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps. Texts without words are rejected."""
    small_batches(spark)
    return quality.keep_good(docs, quality.fit(docs))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased), the document with the largest id stays."""
    return exact.keep_one(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are connected by links (five-word shingles, Jaccard 0.75), the smallest id stays."""
    small_batches(spark)
    return jaccard.keep_one(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind in brackets; ``n_chars`` follows the text."""
    small_batches(spark)
    clean = pii.redact(docs, pii.fit(docs))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens cut into pieces and packed into windows."""
    small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), ids=False)


STAGES = [
    ("quality", good_documents),
    ("exact_dedup", exact_copies),
    ("jaccard_join", near_copies),
    ("pii", without_personal_data),
    ("packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, on ``documents`` in ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
