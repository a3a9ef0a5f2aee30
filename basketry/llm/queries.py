"""Registered queries of the ``llm`` operators and their DuckDB oracles.

Each query applies its operator to its whole table and derives the contract's
digest columns from the operator's result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import (conversations, decontaminate, language, licenses,
                          nearduplicates, ngramjoin, pieces, pii, quality,
                          suffixes, tokens, urls, whitening)
from basketry.llm.conversations_sql import prefix_trie_sql
from basketry.llm.ngramjoin_sql import jaccard_components_sql
from basketry.llm.urls_sql import url_filter_sql

TOKEN_LIMIT = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = tokens.count_tokens(table(spark, sf_dir, "documents"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(table(spark, sf_dir, "pages"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.find_notices(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"] & (s["edits"] == 0))
    starts = F.transform(base, lambda s: s["first_word"])

    def names(spans):
        return F.array_join(F.array_sort(F.array_distinct(
            F.transform(spans, lambda s: s["label"]))), ",")

    # A span's confidence falls with the share of its allowed edits that it used.
    score = F.array_max(F.transform("spans", lambda s: 1 - s["edits"] / (s["limit"] + 1)))
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        names(base).alias("base_labels"), names(F.col("spans")).alias("labels"),
        F.round(F.coalesce(score, F.lit(0.0)), 6).alias("score"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontaminate.contamination(table(spark, sf_dir, "documents"),
                                         table(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id", "n_words", F.col("n_hit").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept")


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{kind}')) as bigint) as n_{kind}")
              for kind in pii.PATTERNS]
    return found.select(
        "doc_id", *counts, F.sha2(pii.joined_spans().cast("binary"), 256).alias("base_sha256"),
        pii.joined_spans(terms="term_spans").alias("spans"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = pieces.round_trip(table(spark, sf_dir, "documents"))
    return decoded.select(
        "doc_id", F.coalesce(F.size("piece_ids"), F.lit(0)).cast("long").alias("n_pieces"),
        "ids_sha256", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearduplicates.near_duplicate_classes(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.filter(~language.held_out()))
    return (language.predict(docs, model)
            .select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.jaccard_components(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_url_filter, op3_license_scan, op4_decontamination, op5_quality_rules,
    op6_personal_data, op7_sentencepiece, op8_suffix_dedup, op9_near_duplicates,
    op10_language_id, op11_whitening, op12_ngram_join,
    op13_prefix_trie)}

ORACLE: dict[str, str] = {"op2_url_filter": url_filter_sql(),
                          "op12_ngram_join": jaccard_components_sql(),
                          "op13_prefix_trie": prefix_trie_sql()}
