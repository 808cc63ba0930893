"""Hard negatives by cover trees over norm-augmented vectors.

A vector x gets one more component, sqrt(M^2 - |x|^2) with M the largest length in its
tree, and so lies on the sphere of radius M. The queries' extra component is 0, so inner
products stay what they are, and on the sphere a bound on a distance is one on them.
"""

from __future__ import annotations

import heapq
from functools import partial
from math import ceil, inf, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.scratch import sent_if_small, stored
from seriesmill.llm.vectors import BLOCK_ROWS, CHUNK_ROWS, best, exact, in_blocks, matrix, shape, solved, whole_vectors

#: Ratio of the covering radii of two levels, and rows of a leaf. In many dimensions
#: distances are alike, and halving the radius would make each point a node of its own.
BASE, LEAF_ROWS = 1.3, 128
#: Anchors, positives of an anchor, negatives of a positive, and the window of negative
#: scores in percent of the positive score.
ANCHOR_STEP, POSITIVES, NEGATIVES, WINDOW_PERCENT = 100, 5, 10, (30, 90)
#: Labels of every so manieth vec_id move by one, of so many labels: noise for the mining.
SHIFTED_STEP, LABELS = 7, 10
#: Scale of the components.
SCALE = 256


class CoverTree:
    """Nodes in arrays: centre, covering radius as an angle, and either children or a run of rows.

    The children of a node of a level cover its rows within the next level's radius, a
    power of BASE below the node's own, and their centres are further apart than that;
    the first child has the node's own centre. A node of a few rows, or of equal ones,
    is a leaf.
    """

    def __init__(self, ids: np.ndarray, points: np.ndarray) -> None:
        points64 = points.astype(np.float64)
        squares = (points64**2).sum(axis=1)
        self.length = float(np.sqrt(squares.max()))
        lifted = np.column_stack([points64, np.sqrt(np.maximum(self.length**2 - squares, 0))])
        centres, radii, spans, order = [0], [], [], []
        distance = _distances(lifted, np.arange(len(lifted)), 0)
        todo = [(0, np.arange(len(lifted)), distance)]
        radii.append(distance.max())
        spans.append(None)
        for node, rows, distance in todo:  # grows meanwhile
            if len(rows) <= LEAF_ROWS or radii[node] == 0:
                spans[node] = (True, sum(map(len, order)), len(rows))
                order.append(rows)
                continue
            reach = BASE ** (ceil(log(radii[node], BASE)) - 1)
            reach = min(reach, radii[node] / 1.01)
            nearest = np.zeros(len(rows), np.int64)
            own, distance = [centres[node]], distance.copy()
            while distance[far := int(distance.argmax())] > reach:
                away = _distances(lifted, rows, rows[far])
                closer = away < distance
                distance[closer], nearest[closer] = away[closer], len(own)
                own.append(int(rows[far]))
            spans[node] = (False, len(centres), len(own))
            for k, centre in enumerate(own):
                inside = nearest == k
                todo.append((len(centres), rows[inside], distance[inside]))
                centres.append(centre)
                radii.append(distance[inside].max(initial=0.0))
                spans.append(None)
        order = np.concatenate(order)
        self.spans = spans
        self.centres = points64[centres]
        chord = np.minimum(np.array(radii) / (2 * self.length), 1) if self.length else np.zeros(len(radii))
        self.angles = 2 * np.arcsin(chord)
        self.ids, self.points = ids[order], points[order]

    def descend(self, query: np.ndarray, length: float, windows: Windows) -> None:
        """Add to each window the rows whose score is in it and may be among its best.

        Nodes are taken in the order of their upper bounds, the highest first, so a
        window soon has the scores that rule out what is left of the tree. A node is
        skipped if it lies outside of all windows, or below the last kept of those that
        are full. `length` is the query's. Bounds have slack for rounding; the scores in
        the leaves are exact.
        """
        scale = length * self.length
        slack = 1e-6 * scale + 1e-3
        as_double = query.astype(np.float64)

        def bounds(first: int, n: int) -> tuple[np.ndarray, np.ndarray]:
            if not scale:
                return np.full(n, slack), np.full(n, -slack)
            middle = np.arccos(np.clip(self.centres[first : first + n] @ as_double / scale, -1, 1))
            angle = self.angles[first : first + n]
            up = scale * np.cos(np.maximum(middle - angle, 0)) + slack
            return up, scale * np.cos(np.minimum(middle + angle, np.pi)) - slack

        up, down = bounds(0, 1)
        heap = [(-up[0], 0, down[0])]
        while heap:
            top, node, low = heapq.heappop(heap)
            if not windows.may_hold(low, -top):
                continue
            leaf, first, n = self.spans[node]
            if leaf:
                windows.add(self.ids[first : first + n], (self.points[first : first + n] @ query).astype(np.int64))
            else:
                up, down = bounds(first, n)
                for child in np.flatnonzero(windows.may_hold_each(down, up)).tolist():
                    heapq.heappush(heap, (-up[child], first + child, down[child]))


def _distances(points: np.ndarray, rows: np.ndarray, centre: int) -> np.ndarray:
    away = points[rows] - points[centre]
    return np.sqrt(np.einsum("ij,ij->i", away, away))


class Windows:
    """Score windows of one query; each keeps its best rows, ties to the smaller id."""

    def __init__(self, lows: list[float], highs: list[float], most: int, without: int) -> None:
        self.lows, self.highs = np.array(lows, float), np.array(highs, float)
        self.most, self.without = most, without
        self.floors = self.lows.copy()  # of a full window: its last score
        self.ids = [np.zeros(0, np.int64) for _ in lows]
        self.scores = [np.zeros(0, np.int64) for _ in lows]

    def may_hold(self, low: float, high: float) -> bool:
        """Whether a node of these bounds may have a row for any window."""
        return bool(((high >= self.floors) & (low <= self.highs)).any())

    def may_hold_each(self, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
        return ((highs[:, None] >= self.floors) & (lows[:, None] <= self.highs)).any(axis=1)

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        other = ids != self.without
        for k in range(len(self.lows)):
            new = np.flatnonzero((scores >= self.floors[k]) & (scores <= self.highs[k]) & other)
            if not len(new):
                continue
            i = np.concatenate([self.ids[k], ids[new]])
            s = np.concatenate([self.scores[k], scores[new]])
            first = np.lexsort((i, -s))[: self.most]
            self.ids[k], self.scores[k] = i[first], s[first]
            if len(first) == self.most:
                self.floors[k] = s[first[-1]]


def _trees(block: pa.Table, points: np.ndarray) -> dict[int, CoverTree]:
    """One tree for each label of a block."""
    ids, labels = block["vec_id"].to_numpy(), block["label"].to_numpy()
    return {int(label): CoverTree(ids[labels == label], points[labels == label]) for label in np.unique(labels)}


def _meet(block: pa.Table, queries: pa.Table, dims: int):
    """The block's trees, and id, label, vector and length of each query."""
    asked, points = exact(matrix(queries["v"], dims), matrix(block["v"], dims))
    lengths = np.sqrt((asked.astype(np.float64) ** 2).sum(axis=1))
    return _trees(block, points), zip(queries["vec_id"].to_pylist(), queries["label"].to_pylist(), asked, lengths.tolist())


def _nearest_of_label(block: pa.Table, queries: pa.Table, dims: int, most: int) -> pa.Table:
    """(anchor_id, positive_id, positive_score): a block's best rows of each anchor's own label."""
    columns = _Rows(3)
    block = block.filter(pc.is_in(block["label"], queries["label"].combine_chunks())) if queries.num_rows else block[:0]
    if block.num_rows:
        trees, each = _meet(block, queries, dims)
        for anchor, label, query, length in each:
            if label in trees:
                windows = Windows([-inf], [inf], most, anchor)
                trees[label].descend(query, length, windows)
                columns.add(anchor, windows.ids[0], windows.scores[0])
    return columns.table(["anchor_id", "positive_id", "positive_score"])


def _negatives(block: pa.Table, queries: pa.Table, dims: int, most: int, percent: tuple[int, int]) -> pa.Table:
    """(anchor_id, positive_id, positive_score, negative_id, negative_score): a block's best rows in each window."""
    columns = _Rows(5)
    if block.num_rows and queries.num_rows:
        trees, each = _meet(block, queries, dims)
        for (anchor, label, query, length), of in zip(each, queries["positives"].to_pylist()):
            scores = [p["positive_score"] for p in of]
            windows = Windows([-(-percent[0] * s // 100) for s in scores], [percent[1] * s // 100 for s in scores], most, anchor)
            for other, tree in trees.items():
                if other != label:
                    tree.descend(query, length, windows)
            for p, ids, found in zip(of, windows.ids, windows.scores):
                columns.add(anchor, np.full(len(ids), p["positive_id"]), np.full(len(ids), p["positive_score"]), ids, found)
    return columns.table(["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])


class _Rows:
    """Columns of 64-bit integers that grow by runs."""

    def __init__(self, n: int) -> None:
        self.runs: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(n)]

    def add(self, anchor: int, *columns: np.ndarray) -> None:
        for runs, values in zip(self.runs, (np.full(len(columns[0]), anchor), *columns)):
            runs.append(values)

    def table(self, names: list[str]) -> pa.Table:
        return pa.table([pa.array(np.concatenate(runs), pa.int64()) for runs in self.runs], names)


def labelled(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, v) of the rows that take part, with moved labels (see `hard_negatives`)."""
    label = F.col("label").cast("int")
    moved = F.when(F.col("vec_id") % SHIFTED_STEP == 0, (label + 1) % LABELS).otherwise(label)
    return whole_vectors(embeddings.where(F.col("label").isNotNull()), "embedding", SCALE, moved.alias("label"))


def hard_negatives(
    vectors: DataFrame,
    anchors: str = f"vec_id % {ANCHOR_STEP} = 0",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    percent: tuple[int, int] = WINDOW_PERCENT,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of `vectors` (vec_id, label, v).

    A row's score is its inner product with the anchor; higher scores come first, ties by
    smaller vec_id. An anchor's positives are its first other rows of the same label. For
    each of them the first rows of other labels are returned whose score is between the
    two percentages of the positive's score, counted from rank 1. An anchor without
    positives, or a positive whose window is empty, gives no rows.

    Candidates lie in blocks of BLOCK_ROWS by label and vec_id, so a hot label is many
    blocks. Each pair of a block and a chunk of anchors is a task of its own, which builds
    one cover tree per label and descends it for each anchor; its best rows meet those of
    other blocks in a window per anchor and positive. Blocks without an anchor's label are
    not asked for its positives. Results are exact: no partner is left out.

    vec_id is unique and no value is null (`labelled` sees to that, and to rows that take
    no part). Vectors of fewer components count as filled up with zeros, so an empty
    vector scores 0 with all. Scores must fit a long. An empty table gives no rows.
    """
    rows = stored(vectors, "vectors")
    n, dims, _ = shape(rows)
    wanted = max(ceil(n / BLOCK_ROWS), rows.sparkSession.sparkContext.defaultParallelism)
    blocks = in_blocks(rows, wanted, ["label", "vec_id"], "block")
    asked = rows.where(anchors)
    chunks = max(1, ceil(asked.count() / CHUNK_ROWS))
    asked = asked.withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int"))

    labels = sent_if_small(stored(blocks.select("block", "label").distinct(), "block-labels"))
    of_label = asked.join(labels, "label").select("vec_id", "label", "v", "block", "chunk")
    met = of_label.select("block", "chunk").distinct()
    found = solved(
        blocks.join(met, "block"), of_label, partial(_nearest_of_label, dims=dims, most=positives),
        "anchor_id long, positive_id long, positive_score long",
    )
    found = best(found, ["anchor_id"], "positive_score", "positive_id", positives)
    found = found.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.sort_array(F.collect_list(F.struct("rank", "positive_id", "positive_score"))).alias("positives")
    )
    found = stored(asked.join(found, "vec_id"), "positives")

    everywhere = found.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(wanted - 1))))
    by_chunk = blocks.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    mined = solved(
        by_chunk, everywhere, partial(_negatives, dims=dims, most=negatives, percent=percent),
        "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long",
    )
    mined = best(mined, ["anchor_id", "positive_id", "positive_score"], "negative_score", "negative_id", negatives)
    return mined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
