"""Incremental landing that keeps the newest row per series and period.

The batch job replaces whole tables. For sources that only append, new files are taken in
by `availableNow` micro-batches instead. A batch appends its rows below the day on which
they land and touches nothing else. Rows that are delivered again within a watermark on
the landing time are dropped by the stream; the newest row per key is taken at read, by
an aggregate, so that rows that come late or are repeated later change no result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.schema import RAW_SCHEMA

KEYS = ("series_reference", "period")
#: Time after its landing within which a repeated row is recognised.
REPEATED_WITHIN = "7 days"
_LANDED, _DAY = "_landed_at", "load_date"


def newest_rows(rows: DataFrame, keys: Sequence[str] = KEYS, loaded_at: str = "_ingested_at") -> DataFrame:
    """The row loaded last per key.

    An aggregate over one struct keeps a single row per key in each map task, so
    a key with very many versions is reduced before the shuffle. Equal load times
    are settled by the other columns, in order, which makes the choice repeatable.
    """
    rest = [c for c in rows.columns if c not in keys and c != loaded_at]
    best = F.max(F.struct(loaded_at, *rest)).alias("_best")
    return rows.groupBy(*keys).agg(best).select(
        *(F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in rows.columns)
    )


def land_new_files(
    spark: SparkSession,
    incoming: str,
    target: str,
    state: str,
    schema: T.StructType = RAW_SCHEMA,
    files_per_batch: int = 1000,
    repeated_within: str = REPEATED_WITHIN,
) -> None:
    """Take in all parquet files that have not been seen yet, then stop.

    The watermark is on the time of the batch and not on the source's load time, because
    rows that the source sends late would be behind the latter and be lost. The state
    holds the rows of `repeated_within`, whatever has landed before. `state` holds the
    stream's progress and must lie on shared storage, like `target`; the file sink's log
    makes a repeated batch replace itself.
    """
    rows = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(incoming)
    )
    landed = (
        rows.withColumn(_LANDED, F.current_timestamp())
        .withWatermark(_LANDED, repeated_within)
        .dropDuplicatesWithinWatermark(rows.columns)
        .withColumn(_DAY, F.to_date(_LANDED))
    )
    (
        landed.writeStream.format("parquet")
        .partitionBy(_DAY)
        .option("path", target)
        .option("checkpointLocation", state)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def landed_rows(spark: SparkSession, target: str) -> DataFrame:
    """Everything that has landed, with the day."""
    try:
        return spark.read.parquet(target).drop(_LANDED)
    except AnalysisException as nothing:
        raise LookupError(f"nothing has landed in {target}") from nothing


def current_rows(
    spark: SparkSession, target: str, keys: Sequence[str] = KEYS, loaded_at: str = "_ingested_at"
) -> DataFrame:
    """The landed table as of now: newest row per key over all batches."""
    return newest_rows(landed_rows(spark, target).drop(_DAY), keys, loaded_at)
