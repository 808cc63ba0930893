"""The corpus pipeline: from raw documents to training-order token sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again for the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seriesmill.llm import decontamination, line_rules, mixing, near_duplicates, token_shards
from seriesmill.llm.scratch import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail the base rules or are depleted; take boilerplate lines out of the others."""
    return line_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates."""
    return near_duplicates.without_copies(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return decontamination.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that sources reach their weights."""
    return mixing.mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write token sequences in training order and return where each one stands."""
    return token_shards.training_order(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("token_output", token_output),
]

#: SuperMinHash groups and tokens have no SQL form; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name, "zstd")
    return STAGES[-1][1](spark, docs, sf_dir)
