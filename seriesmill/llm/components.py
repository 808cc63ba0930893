"""Connected components of a link table by distributed union-find."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.scratch import map_batches, stored

_EDGES = "node long, parent long"
#: Links that one task finishes by itself: 8 MB of numbers. More of them take rounds.
LOCAL_LINKS = 500_000


def local_forest(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union-find over the links of one block: each node that has a smaller root, and that root."""
    nodes, flat = np.unique(pairs, return_inverse=True)
    parent = list(range(len(nodes)))
    for a, b in flat.reshape(-1, 2).tolist():
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        while parent[b] != b:
            parent[b] = b = parent[parent[b]]
        if a < b:
            parent[b] = a
        elif b < a:
            parent[a] = b
    roots = np.asarray(parent, np.int64)
    while (roots[roots] != roots).any():
        roots = roots[roots]
    moved = roots != np.arange(len(nodes))
    return nodes[moved], nodes[roots[moved]]


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch becomes a forest, so memory is bounded by a batch and no link is lost."""
    for batch in batches:
        pairs = np.column_stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()])
        node, parent = local_forest(pairs)
        yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(parent)], ["node", "parent"])


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over all that is left, which is at most LOCAL_LINKS links."""
    parts = [np.column_stack([b.column(0).to_numpy(), b.column(1).to_numpy()]) for b in batches]
    node, parent = local_forest(np.concatenate([np.zeros((0, 2), np.int64), *parts]))
    yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(parent)], ["node", "parent"])


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): every node with a link and the smallest node it reaches.

    Links are compressed by union-find batch by batch, and once more in one task if the
    remaining forest is small enough for it. A larger one is contracted in rounds: all parents of a node are linked to its smallest parent, and
    each node moves to its parent's parent, until nothing changes. A round shuffles at
    most as many rows as the forest has links, sums are formed before the shuffle, and
    only two numbers reach the driver. Links with a null end and self links add nothing;
    an empty table gives an empty result.
    """
    forest = links.select(F.col(a).cast("long").alias("node"), F.col(b).cast("long").alias("parent"))
    forest = map_batches(forest.where("node <> parent"), _compress, _EDGES)
    forest = stored(forest, "forest")
    if forest.count() <= LOCAL_LINKS:
        done = stored(map_batches(forest.coalesce(1), _finish, _EDGES), "components")
        return done.select("node", F.col("parent").alias("component"))
    while True:
        smallest = stored(forest.groupBy("node").agg(F.min("parent").alias("least")), "forest-least")
        # The other parents of a node are in the same component as its least one.
        others = forest.join(smallest, "node").where("parent <> least")
        others = others.select(F.col("parent").alias("node"), F.col("least").alias("parent"), F.lit(True).alias("new"))
        up = smallest.select(F.col("node").alias("least"), F.col("least").alias("top"))
        moved = smallest.join(up, "least", "left").select(
            "node", F.coalesce("top", "least").alias("parent"), F.col("top").isNotNull().alias("new")
        )
        rows = moved.unionByName(others).groupBy("node", "parent").agg(F.max("new").alias("new"))
        forest = stored(rows, "forest")
        if forest.where("new").isEmpty():
            return forest.select("node", F.col("parent").alias("component"))
