"""From raw documents to sampled pieces: five stages, each written and read again.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basketry.llm import decontaminate, language, nearduplicates, pieces, pii
from basketry.session import scratch_dir

# A language must hold this share of a text's n-grams.
MIN_LANGUAGE_SCORE = 0.35


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter or without a clear language go."""
    model = language.fit(docs.filter(~language.held_out()))
    return language.keep_identified(docs, model, MIN_LANGUAGE_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    return nearduplicates.drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages go."""
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontaminate.remove_contaminated(docs, items)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it are replaced or removed."""
    return pii.sanitise(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every text as sampled pieces (``piece_ids``); text is what they decode to."""
    return pieces.tokenise(docs)


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates),
          ("benchmark_decontamination", benchmark_decontamination),
          ("personal_data", personal_data), ("sentencepiece", sentencepiece)]

# Signatures, suffix arrays and sampled pieces are beyond SQL; tests/llm holds the
# rows against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every result is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
