"""Registered queries of the operators, with SQL where DuckDB can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from seriesmill.llm import (
    cover_tree,
    decontamination,
    filter_audit,
    line_rules,
    mixing,
    near_duplicates,
    oracle,
    passages,
    quality_model,
    token_counts,
    token_shards,
    url_filter,
    voronoi_join,
    warc,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item and the shared shingles."""
    return decontamination.contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op2_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Expected grade and chance of the best grade of each document, from the labels table."""
    return quality_model.select_good(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Rule and verdict of each page's URL."""
    return url_filter.judge_urls(_table(spark, folder, "pages"), url_filter.host_has_word())


def op4_warc_index(spark: SparkSession, folder: str) -> DataFrame:
    """WARC records of all pages, as read back from the archives, in the order of their index."""
    return warc.archive_and_index(_table(spark, folder, "pages"))


def op5_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    """Passages that occur in two documents or more."""
    return passages.repeated_passages(_table(spark, folder, "documents"))


def op6_training_order(spark: SparkSession, folder: str) -> DataFrame:
    """Slot, place and digest of every token sequence, as read back from the shards."""
    return token_shards.training_order(_table(spark, folder, "documents"))


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of each document before and after personal data is replaced."""
    return token_counts.masked_counts(_table(spark, folder, "documents"))


def op8_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Near duplicates by two-word shingles, as the contract of this query says."""
    return near_duplicates.near_duplicates(_table(spark, folder, "documents"), width=2, percent=80)


def op9_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Words that the mix takes of each document."""
    return mixing.mix(_table(spark, folder, "documents"))


def op10_line_frequency(spark: SparkSession, folder: str) -> DataFrame:
    """Base measures, verdict and text without boilerplate of each document; a document's host is its source."""
    return line_rules.judge(_table(spark, folder, "documents"))


def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Effect of five filters in all their orders, for each source."""
    return filter_audit.audit(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Negatives of each anchor and positive whose scores lie in a window below the positive's."""
    return cover_tree.hard_negatives(cover_tree.labelled(_table(spark, folder, "embeddings")))


def op13_top_scores(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 highest inner products of every twentieth vector with all others."""
    return voronoi_join.top_scores(voronoi_join.integer_vectors(_table(spark, folder, "embeddings")))


_QUERIES = [
    op1_decontamination, op2_quality_classifier, op3_url_filter, op4_warc_index, op5_repeated_passages,
    op6_training_order, op7_token_counts, op8_minhash_dedup, op9_source_mixing, op10_line_frequency,
    op11_filter_audit, op12_hard_negatives, op13_top_scores,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
