"""Intermediate tables in the shared folder, which also cut the lineage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.session import bound_batches, scratch_path, ship_package


def stored(df: DataFrame, name: str, codec: str = "lz4") -> DataFrame:
    """Write a table below `spark.checkpoint.dir` and read it back.

    The files outlive executors, and Spark knows the size of what it reads from them,
    so it broadcasts a stored table only where the session's threshold allows it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def wrapped(df: DataFrame) -> DataFrame:
    """All columns as the fields of one column `row`, so that no helper column can clash with theirs."""
    return df.select(F.struct(*[F.col(f"`{name}`") for name in df.columns]).alias("row"))


def map_batches(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """mapInArrow with the package sent to the Python workers, a few MB of rows at a time."""
    ship_package(df.sparkSession)
    bound_batches(df.sparkSession)
    return df.mapInArrow(function, schema)


def sent_if_small(rows: DataFrame, most: int = 500_000) -> DataFrame:
    """A stored table of a few numbers per row, marked for broadcast if it has at most `most` rows.

    At 24 bytes a row that is some 12 MB. Larger tables are left to the session, which
    shuffles both sides and splits hot keys.
    """
    return F.broadcast(rows) if rows.count() <= most else rows
