"""Exact top-k by inner product as a k-nearest-neighbour join over Voronoi cells.

A candidate x gets one more component, sqrt(M^2 - |x|^2) with M the largest length of the
table; a query is stretched to length M and its extra component is 0. Then the highest
inner products of a query are the smallest distances, and the triangle inequality holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.scratch import map_batches, stored
from seriesmill.llm.vectors import BLOCK_ROWS, CHUNK_ROWS, best, exact, in_blocks, matrix, shape, solved, whole_vectors

#: Pivots, and candidates that they are chosen from: those with the smallest hashes.
PIVOTS, PIVOT_SAMPLE = 64, 1_024
#: Queries, results of each, and scale of the components.
QUERY_STEP, MOST, SCALE = 20, 20, 64
#: Queries whose scores are held at once.
TILE = 256


def lifted(points: np.ndarray, length: float) -> np.ndarray:
    """Candidates on the sphere of radius `length`."""
    points = points.astype(np.float64)
    return np.column_stack([points, np.sqrt(np.maximum(length**2 - (points**2).sum(axis=1), 0))])


def stretched(points: np.ndarray, length: float) -> np.ndarray:
    """Queries on the same sphere; one without a direction stays at its middle, equally far from all."""
    points = points.astype(np.float64)
    own = np.sqrt((points**2).sum(axis=1))
    factor = np.divide(length, own, out=np.zeros(len(own)), where=own > 0)
    return np.column_stack([points * factor[:, None], np.zeros(len(points))])


def spread_out(points: np.ndarray, most: int) -> np.ndarray:
    """Up to `most` points, each the one that is furthest from those before it."""
    chosen, distance = [], np.full(len(points), np.inf)
    while len(chosen) < most and len(points) and distance.max() > 0:
        chosen.append(int(distance.argmax()))
        distance = np.minimum(distance, np.sqrt(((points - points[chosen[-1]]) ** 2).sum(axis=1)))
    return points[chosen]


def nearest(points: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest pivot of each point, and the distance."""
    squares = (points**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1) - 2 * points @ pivots.T
    pivot = squares.argmin(axis=1)
    return pivot, np.sqrt(((points - pivots[pivot]) ** 2).sum(axis=1))


def _place_batches(
    batches: Iterator[pa.RecordBatch], pivots: np.ndarray, length: float, dims: int, queries: bool
) -> Iterator[pa.RecordBatch]:
    lift = stretched if queries else lifted
    for batch in batches:
        points = matrix(pa.chunked_array([batch.column(1)]), dims)
        pivot, distance = nearest(lift(points, length), pivots)
        columns = [batch.column(0), batch.column(1), pa.array(pivot, pa.int32()), pa.array(distance)]
        yield pa.RecordBatch.from_arrays(columns, ["vec_id", "v", "pivot", "distance"])


def _best_rows(block: pa.Table, queries: pa.Table, dims: int, most: int) -> pa.Table:
    """(query_id, vec_id, score): a block's best rows for each query, without the query itself."""
    found = [[np.zeros(0, np.int64)] for _ in range(3)]
    if block.num_rows and queries.num_rows:
        block = block.sort_by("vec_id")
        ids, query_ids = block["vec_id"].to_numpy(), queries["vec_id"].to_numpy()
        asked, points = exact(matrix(queries["v"], dims), matrix(block["v"], dims))
        lowest = -np.inf if asked.dtype == np.float64 else np.iinfo(np.int64).min
        for first in range(0, len(asked), TILE):
            scores = asked[first : first + TILE] @ points.T
            own = query_ids[first : first + TILE, None] == ids
            scores[own] = lowest
            if len(ids) > most:
                last = -np.partition(-scores, most - 1, axis=1)[:, most - 1 : most] if scores.dtype == np.float64 else np.sort(scores, axis=1)[:, -most, None]
                query, row = np.nonzero((scores >= last) & ~own)
            else:
                query, row = np.nonzero(~own)
            score = scores[query, row]
            order = np.lexsort((row, -score, query)) if score.dtype == np.float64 else np.lexsort((row, ~score, query))
            query, row, score = query[order], row[order], score[order]
            place = np.arange(len(query)) - np.searchsorted(query, query)
            keep = place < most
            for runs, values in zip(found, (query_ids[first + query[keep]], ids[row[keep]], score[keep].astype(np.int64))):
                runs.append(values)
    return pa.table([pa.array(np.concatenate(runs), pa.int64()) for runs in found], ["query_id", "vec_id", "score"])


def integer_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows that take part (see `top_scores`)."""
    return whole_vectors(embeddings, "embedding", SCALE)


def _pivots(rows: DataFrame, length: float, dims: int) -> np.ndarray:
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOT_SAMPLE).select("v").toArrow()
    return spread_out(lifted(matrix(sample["v"], dims), length), PIVOTS)


def _within(blocks: DataFrame, apart: np.ndarray, most: int) -> np.ndarray:
    """For each pivot a distance from it within which there are `most` candidates, from the nearest ones of every pivot.

    A candidate at distance d of pivot j is within apart[i, j] + d of pivot i. What
    reaches the driver are `most` numbers for each of PIVOTS pivots.
    """
    close = best(blocks.select("pivot", "vec_id", (-F.col("distance")).alias("near")), ["pivot"], "near", "vec_id", most)
    found = close.select("pivot", "near").toArrow()
    pivot, distance = found["pivot"].to_numpy(), -found["near"].to_numpy()
    if len(pivot) < most:
        return np.full(len(apart), np.inf)
    return np.sort(apart[:, pivot] + distance, axis=1)[:, most - 1]


def _needs(blocks: DataFrame, chunks: DataFrame, pivots: np.ndarray, length: float, most: int) -> DataFrame:
    """(chunk, block, pivot, least, furthest): rows of a block that a chunk of queries needs, by their distance from their pivot.

    All k nearest of a query at a distance up to r from pivot i lie within r + within[i]
    of it. A row at distance d from pivot j is no nearer than apart[i, j] - r - d and than
    d - apart[i, j] - r. Summaries of blocks meet those of chunks by their pivots.
    """
    apart = np.sqrt(((pivots[:, None] - pivots[None]) ** 2).sum(axis=2))
    within = np.minimum(_within(blocks, apart, most), 4 * length + 1)
    pairs = [(i, j, float(apart[i, j]), float(within[i])) for i in range(len(pivots)) for j in range(len(pivots))]
    pairs = blocks.sparkSession.createDataFrame(pairs, "query_pivot int, pivot int, apart double, within double")
    rings = blocks.groupBy("block", "pivot").agg(F.min("distance").alias("inner"), F.max("distance").alias("outer"))
    asked = chunks.groupBy("chunk", F.col("pivot").alias("query_pivot")).agg(F.max("distance").alias("radius"))
    reach = F.lit(2.0) * F.col("radius") + F.col("within") + F.lit(1e-6 * length + 1e-6)
    asked = asked.join(F.broadcast(pairs), "query_pivot").select(
        "chunk", "pivot", (F.col("apart") - reach).alias("least"), (F.col("apart") + reach).alias("furthest")
    )
    met = asked.join(rings, "pivot").where((F.col("outer") >= F.col("least")) & (F.col("inner") <= F.col("furthest")))
    # The pivots of a chunk need the union of their rings, which one ring around it holds.
    return met.groupBy("chunk", "block", "pivot").agg(F.min("least").alias("least"), F.max("furthest").alias("furthest"))


def top_scores(vectors: DataFrame, queries: str = f"vec_id % {QUERY_STEP} = 0", most: int = MOST) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's highest inner products with the other rows of `vectors` (vec_id, v).

    Ties go to the smaller vec_id. Queries are the rows for which the condition `queries`
    holds; all of the others' and the queries' own rows are candidates.

    Candidates and queries are grouped by their nearest pivot and cut into blocks and
    chunks by pivot and distance, so a pivot with a third of the rows is many blocks.
    Summaries (rings of the blocks, radii of the chunks, the nearest candidates of each
    pivot) bound how far a chunk's results can be; blocks outside are not asked, and of
    the others only rows inside go to the chunk. Each pair of a block and a chunk is solved
    by itself; a query's best rows of all blocks meet in a window. Results are exact. Where
    distances are all alike, as among random directions of many dimensions, the bounds
    exclude little, and the job is an exact search in blocks.

    vec_id is unique and no value is null (`integer_vectors` sees to that, and to rows
    that take no part). Vectors of fewer components count as filled up with zeros. Scores
    must fit a long. Fewer rows than `most` give all of them; an empty table none.
    """
    rows = stored(vectors, "vectors")
    n, dims, length = shape(rows)
    pivots = _pivots(rows, length, dims) if n else np.zeros((1, dims + 1))
    place = partial(_place_batches, pivots=pivots, length=length, dims=dims)
    schema = "vec_id long, v array<long>, pivot int, distance double"
    cores = rows.sparkSession.sparkContext.defaultParallelism
    by = ["pivot", "distance", "vec_id"]
    blocks = map_batches(rows.select("vec_id", "v"), partial(place, queries=False), schema)
    blocks = in_blocks(blocks, max(ceil(n / BLOCK_ROWS), cores), by, "block")
    asked = stored(rows.where(queries).select("vec_id", "v"), "queries")
    chunks = max(1, ceil(asked.count() / CHUNK_ROWS))
    asked = in_blocks(map_batches(asked, partial(place, queries=True), schema), chunks, by, "chunk")

    needs = stored(_needs(blocks, asked, pivots, length, most + 1), "needs")
    sent = blocks.join(needs, ["block", "pivot"]).where("distance between least and furthest")
    meet = needs.select("chunk", "block").distinct()
    found = solved(
        sent.select("block", "chunk", "vec_id", "v"), asked.select("chunk", "vec_id", "v").join(meet, "chunk"),
        partial(_best_rows, dims=dims, most=most), "query_id long, vec_id long, score long",
    )
    return best(found, ["query_id"], "score", "vec_id", most).select("query_id", "rank", "vec_id", "score")
