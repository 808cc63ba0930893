"""Integer vectors, blocks of them, and exact scores, for the searches by inner product."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seriesmill.llm.scratch import stored
from seriesmill.session import ship_package

#: Rows of a block of candidates and of a chunk of queries, at most on average.
BLOCK_ROWS, CHUNK_ROWS = 16_384, 4_096


def whole_vectors(df: DataFrame, vector: str, scale: int, *others: Column) -> DataFrame:
    """(vec_id, others, v) of the rows that take part, one for each vec_id.

    Component x becomes floor(scale * x), x as double. Left out are rows without a
    vec_id, without a vector, or with a component that is null or not finite. Of several
    rows with one vec_id the smallest by the other columns and the vector stands.
    """
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    rows = df.where(F.col("vec_id").isNotNull() & F.col(vector).isNotNull() & usable)
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.struct(*others, whole.alias("v")).alias("row"))
    return rows.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.*")


def shape(rows: DataFrame) -> tuple[int, int, float]:
    """Rows, components of the longest vector, and the largest length of a vector."""
    squares = F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
    n, dims, most = rows.agg(F.count(F.lit(1)), F.max(F.size("v")), F.max(squares)).first()
    return n, dims or 0, float(np.sqrt(most or 0.0))


def in_blocks(rows: DataFrame, wanted: int, by: list[str], block: str) -> DataFrame:
    """Store rows in ranges of `by` and add a number for each range: `wanted` of them, about equally large.

    A session may deal rows to more ranges than asked for; neighbours are then taken
    together. `by` should end in a key without repeats, so that a hot value is split.
    """
    ranges = rows.repartitionByRange(wanted, *by).withColumn("_range", F.spark_partition_id())
    ranges = stored(ranges, f"{block}s")
    found = (ranges.agg(F.max("_range")).first()[0] or 0) + 1
    number = F.expr(f"cast(_range * {wanted}L div {max(found, wanted)} as int)")
    return ranges.withColumn(block, number).drop("_range")


def solved(
    blocks: DataFrame, asked: DataFrame, function: Callable[[pa.Table, pa.Table], pa.Table], schema: str
) -> DataFrame:
    """Rows of `function(block, queries)` for each pair of a block and a chunk of queries that meet.

    Both tables have `block` and `chunk`. A task holds one block and one chunk, however
    many rows either table has, and needs nothing but them.
    """
    ship_package(blocks.sparkSession)
    asked = asked.withColumnsRenamed({"block": "to_block", "chunk": "to_chunk"})
    pairs = blocks.groupBy("block", "chunk").cogroup(asked.groupBy("to_block", "to_chunk"))
    return pairs.applyInArrow(function, schema)


def best(rows: DataFrame, of: list[str], score: str, tie: str, most: int) -> DataFrame:
    """The `most` rows with the highest score of each query, with their rank; Spark cuts each task's rows before the shuffle."""
    order = W.partitionBy(*of).orderBy(F.col(score).desc(), tie)
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    """Vectors as rows of whole numbers; shorter ones are filled up with zeros."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy()
    if (sizes == dims).all():
        return values.reshape(len(sizes), dims)
    out = np.zeros((len(sizes), dims), np.int64)
    out[np.arange(dims) < sizes[:, None]] = values
    return out


def exact(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both matrices as doubles if all their inner products are exact in them, else as 64-bit integers."""
    largest = lambda m: float(np.abs(m.astype(np.float64)).max(initial=0.0))
    if largest(a) * largest(b) * max(a.shape[1], 1) < 2**53:
        return a.astype(np.float64), b.astype(np.float64)
    return a, b
