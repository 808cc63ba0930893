"""Hard negatives and top scores against all pairs; trees, bounds and cells against their promises."""

import math
import random

import numpy as np
import pytest
from llm_helpers import rows_of
from pyspark.sql import functions as F

from seriesmill.llm import cover_tree, vectors, voronoi_join
from seriesmill.llm.cover_tree import CoverTree, Windows

TABLE = "vec_id long, embedding array<float>, label int"
CLASHING = ["v", "block", "chunk", "row", "pivot", "distance", "rank", "positives", "_range", "score"]


def table(spark, rows):
    df = spark.createDataFrame(rows, TABLE)
    for name in CLASHING:
        df = df.withColumn(name, F.lit("x"))
    return df.repartition(3)


def clustered(rng, n, dims=6, labels=3, spread=0.2):
    """Vectors around a few directions, with copies and ties."""
    middles = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(labels + 2)]
    rows = []
    for i in range(n):
        middle = rng.choice(middles)
        rows.append((i, [x + rng.gauss(0, spread) for x in middle], rng.randrange(labels)))
    third = rows[1][1]
    return [(i, third if i % 3 == 1 else v, label) for i, v, label in rows]


def usable(rows, scale, moved):
    out = {}
    for i, v, label in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v) or (moved and label is None):
            continue
        label = (label + 1) % 10 if moved and i % 7 == 0 else label
        row = (label if moved else 0, [math.floor(scale * float(np.float32(x))) for x in v])
        out[i] = min(out.get(i, row), row)
    return out


def score(a, b):
    return sum(x * y for x, y in zip(a, b))


def negatives_by_hand(rows):
    found, usables = [], usable(rows, 256, True)
    for a, (label, v) in usables.items():
        if a % 100:
            continue
        ranked = sorted((-score(v, w), i, other) for i, (other, w) in usables.items() if i != a)
        for minus, p, _ in [r for r in ranked if r[2] == label][:5]:
            inside = [(i, -s) for s, i, other in ranked if other != label and 30 * -minus <= 100 * -s <= 90 * -minus]
            found += [(a, p, k, i, -minus, s) for k, (i, s) in enumerate(inside[:10], 1)]
    return sorted(found)


def tops_by_hand(rows, most=20):
    usables = usable(rows, 64, False)
    found = []
    for q, (_, v) in usables.items():
        if q % 20 == 0:
            ranked = sorted((-score(v, w), i) for i, (_, w) in usables.items() if i != q)
            found += [(q, k, i, -s) for k, (s, i) in enumerate(ranked[:most], 1)]
    return sorted(found)


ODD = [
    (100, None, 1), (200, [1.0, float("nan")], 1), (300, [1.0, float("inf"), 0.5], 2), (400, [1.0, None], 0),
    (None, [1.0] * 6, 1), (500, [0.0] * 6, 1), (600, [], 2), (700, [0.5, -0.5], 1), (800, [1.0] * 6, None),
    (900, [-300.25] * 6, 0), (901, [400.5] * 6, 0), (902, [390.0] * 6, 1),
]


def mined(spark, rows, **options):
    found = cover_tree.hard_negatives(cover_tree.labelled(table(spark, rows)), **options)
    return rows_of(found, "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def tops(spark, rows):
    found = voronoi_join.top_scores(voronoi_join.integer_vectors(table(spark, rows)))
    return rows_of(found, "query_id", "rank", "vec_id", "score")


@pytest.mark.parametrize("seed,dims,spread", [(1, 6, 0.2), (2, 2, 0.05), (3, 24, 1.0)])
def test_both_searches_equal_all_pairs(spark, seed, dims, spread, monkeypatch):
    monkeypatch.setattr(cover_tree, "BLOCK_ROWS", 90)
    monkeypatch.setattr(cover_tree, "CHUNK_ROWS", 3)
    monkeypatch.setattr(voronoi_join, "BLOCK_ROWS", 90)
    monkeypatch.setattr(voronoi_join, "CHUNK_ROWS", 7)
    rows = clustered(random.Random(seed), 700, dims, spread=spread)
    rows = [r for r in rows if r[0] % 100 or r[0] < 500] + ODD + [rows[5], rows[5], (5, rows[9][1], 2)]
    assert mined(spark, rows) == negatives_by_hand(rows)
    assert tops(spark, rows) == tops_by_hand(rows)


def test_equal_vectors_are_ranked_by_id(spark):
    rows = [(i, [1.0, 2.0], i % 2) for i in range(900, 0, -1)]
    assert tops(spark, rows) == tops_by_hand(rows)
    assert mined(spark, rows) == []
    rows += [(1000 + i, [0.6, 1.0], 2) for i in range(40)]
    assert mined(spark, rows) == negatives_by_hand(rows) and mined(spark, rows)


def test_few_rows_and_none(spark):
    for rows in ([], [(20, [1.0], 1)], [(100, [1.0], 1), (101, [2.0], 1), (102, [0.5], 2)], [(0, [], 1), (20, [], 1)]):
        assert tops(spark, rows) == tops_by_hand(rows)
        assert mined(spark, rows) == negatives_by_hand(rows)


def test_scores_beyond_doubles_are_exact(spark):
    rows = [(i, [2.0**24 + 64 * i, 1.0 + i], i % 2) for i in range(40)]
    assert tops(spark, rows) == tops_by_hand(rows)
    rows = [(i, [2.0**22 + 64 * (i % 5), 1.0 + i], i % 2) for i in range(40)] + [(i, [2.0**21, 1.0 + i], 5) for i in range(40, 80)]
    assert mined(spark, rows) == negatives_by_hand(rows) and mined(spark, rows)


def test_covering_radii_hold_every_row_and_levels_shrink():
    rng = np.random.default_rng(5)
    points = np.concatenate([rng.integers(-300, 300, (1500, 5)), np.full((400, 5), 7), rng.integers(-9, 9, (500, 5))])
    tree = CoverTree(np.arange(len(points)), points)
    lift = lambda p: np.column_stack([p, np.sqrt(np.maximum(tree.length**2 - (p**2).sum(axis=1), 0))])
    centres, lifted = lift(tree.centres), lift(tree.points.astype(float))
    seen = []

    def rows_below(node):
        leaf, first, n = tree.spans[node]
        if leaf:
            seen.extend(range(first, first + n))
            own = list(range(first, first + n))
        else:
            own = [row for child in range(first, first + n) for row in rows_below(child)]
            assert (tree.centres[first] == tree.centres[node]).all()
            assert (tree.angles[first : first + n] < tree.angles[node]).all()
        chord = np.sqrt(((lifted[own] - centres[node]) ** 2).sum(axis=1)).max()
        assert 2 * np.arcsin(min(1, chord / 2 / tree.length)) <= tree.angles[node] + 1e-6
        return own

    rows_below(0)
    assert sorted(seen) == list(range(len(points))) and sorted(tree.ids) == list(range(len(points)))


def test_descent_skips_what_lies_outside_its_windows():
    rng = np.random.default_rng(6)
    middles = rng.normal(0, 300, (12, 8))
    points = np.concatenate([m + rng.normal(0, 5, (400, 8)) for m in middles]).astype(np.int64)
    tree, query = CoverTree(np.arange(len(points)), points), points[0].astype(float)
    length = float(np.sqrt((query**2).sum()))
    scores = points @ points[0]
    top = int(np.sort(scores)[-50])
    read = []

    class Counting(Windows):
        def add(self, ids, found):
            read.append(len(ids))
            super().add(ids, found)

    windows = Counting([top // 2], [top], 10, 0)
    tree.descend(query, length, windows)
    inside = sorted((-s, i) for i, s in enumerate(scores.tolist()) if top // 2 <= s <= top and i)
    assert list(zip((-windows.scores[0]).tolist(), windows.ids[0].tolist())) == inside[:10]
    assert sum(read) < len(points) / 4


def test_rings_exclude_blocks_of_other_cells(spark, monkeypatch):
    monkeypatch.setattr(voronoi_join, "BLOCK_ROWS", 100)
    monkeypatch.setattr(voronoi_join, "CHUNK_ROWS", 20)
    sent = []
    solved = voronoi_join.solved

    def counting(blocks, asked, function, schema):
        sent.append((blocks.count(), blocks.select("chunk").distinct().count()))
        return solved(blocks, asked, function, schema)

    monkeypatch.setattr(voronoi_join, "solved", counting)
    rng = random.Random(8)
    middles = [[10.0 if k == j else 0.0 for k in range(10)] for j in range(10)]
    rows = [(i, [x + rng.gauss(0, 0.05) for x in middles[i // 20 % 10]], 0) for i in range(2000)]
    assert tops(spark, rows) == tops_by_hand(rows)
    count, chunks = sent[0]
    assert chunks > 3 and count < 0.6 * chunks * len(rows)


def test_blocks_split_a_hot_value(spark):
    rows = spark.range(6000).select(F.col("id").alias("vec_id"), F.lit(1).alias("label"))
    sizes = [r["count"] for r in vectors.in_blocks(rows, 6, ["label", "vec_id"], "block").groupBy("block").count().collect()]
    assert len(sizes) == 6 and max(sizes) < 2000
