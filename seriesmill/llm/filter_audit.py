"""How filters interact: survival words, carry-save positional popcounts, all orders of the filters.

A document that fails the filters F survives a subset S of them if S and F have no filter
in common. Its survival word has one bit for each of the 32 subsets of five filters. How
many documents survive a subset is then the number of words with that bit, and every
figure of every order of the filters is a difference of such numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.scratch import map_batches, stored

#: Filters in the order of their bits. A: too few words. B: too few distinct words, in
#: percent. C: too many capitals, in percent of the characters. D: a symbol. E: a text
#: that a smaller doc_id has.
FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT_PERCENT, MOST_CAPITALS_PERCENT, SYMBOLS = 200, 50, 2, "#$%&*|"

SUBSETS = 1 << len(FILTERS)
_COPY = 1 << FILTERS.index("E")
_SYMBOLS = SYMBOLS.encode()
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_LATER_BYTES = bytes(range(0x80, 0xC0))
_subsets = np.arange(SUBSETS)
_BITS = np.uint32(1) << _subsets.astype(np.uint32)
#: Survival word of each set of failed filters.
WORDS = ((_subsets[:, None] & _subsets[None, :]) == 0) @ _BITS
WORDS = WORDS.astype(np.uint32)

_FAILED = "doc_id long, part string, failed int, digest binary"
_COUNTED = "part string, good boolean, toxic boolean, survivors array<long>"
_FIGURES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
_AUDIT = "part string, filter_order string, step int, " + ", ".join(f"{name} long" for name in _FIGURES)


def failed_by_text(raw: bytes) -> int:
    """Bits of the filters A to D that a text in UTF-8 fails.

    `bytes.split()` parts at the six ASCII spaces, so its parts are the maximal runs of
    `[^\\x20\\x09-\\x0D]`.
    """
    parts = raw.split()
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    code_points = len(raw.translate(None, _LATER_BYTES))
    fails = (
        len(parts) < LEAST_WORDS,
        100 * len(set(parts)) < LEAST_DISTINCT_PERCENT * len(parts),
        100 * capitals > MOST_CAPITALS_PERCENT * code_points,
        len(raw.translate(None, _SYMBOLS)) < len(raw),
    )
    return sum(1 << bit for bit, fail in enumerate(fails) if fail)


def positional_popcount(words: np.ndarray) -> np.ndarray:
    """How many of the 32-bit words have each bit.

    A carry-save adder turns three words of one weight into a sum of that weight and a
    carry of twice the weight, in all 32 positions at once. Words are added so until two
    of each weight are left, and only these are taken apart into bits.
    """
    counts = np.zeros(32, np.int64)
    level, weight = words.astype(np.uint32), 1
    while len(level):
        carries = []
        while len(level) > 2:
            n = len(level) // 3
            a, b, c = level[:n], level[n : 2 * n], level[2 * n : 3 * n]
            half = a ^ b
            carries.append((a & b) | (half & c))
            level = np.concatenate([half ^ c, level[3 * n :]])
        counts += weight * ((level[:, None] & _BITS) != 0).sum(axis=0)
        level = np.concatenate(carries) if carries else level[:0]
        weight *= 2
    return counts


def _fail_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(2).to_pylist()
        columns = [
            batch.column(0),
            batch.column(1),
            pa.array([failed_by_text(raw) for raw in texts], pa.int32()),
            pa.array([hashlib.blake2b(raw, digest_size=16).digest() for raw in texts], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "failed", "digest"])


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch becomes one row per part and label: survivors of each subset."""
    for batch in batches:
        parts = batch.column(0).dictionary_encode()
        good, toxic = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (1, 2))
        group = parts.indices.to_numpy() * 4 + good * 2 + toxic
        words = WORDS[batch.column(3).to_numpy()]
        order = np.argsort(group, kind="stable")
        groups, starts = np.unique(group[order], return_index=True)
        survivors = [positional_popcount(w) for w in np.split(words[order], starts[1:])] if len(group) else []
        columns = [
            parts.dictionary.take(pa.array(groups // 4)),
            pa.array(groups // 2 % 2 == 1),
            pa.array(groups % 2 == 1),
            pa.array([list(s) for s in survivors], pa.list_(pa.int64())),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["part", "good", "toxic", "survivors"])


class _Orders:
    """All orders of the filters, one row per order and step: its filter and the subsets before and after it."""

    def __init__(self) -> None:
        orders = list(permutations(range(len(FILTERS))))
        self.names = ["".join(FILTERS[f] for f in order) for order in orders for _ in order]
        self.steps = list(range(1, len(FILTERS) + 1)) * len(orders)
        self.filter = np.array(orders).ravel()
        self.after = np.cumsum(1 << np.array(orders), axis=1).ravel()
        self.before = self.after - (1 << self.filter)


_orders = _Orders()


def figures(every: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """The seven figures for each order and step, from the survivors of each subset."""
    step, before, after = _orders.filter, _orders.before, _orders.after
    single = 1 << np.arange(len(FILTERS))
    removed = every[before] - every[after]
    fails = every[0] - every[single]
    unique = every[SUBSETS - 1 - single] - every[SUBSETS - 1]
    shapley = np.array([removed[step == f].sum() for f in range(len(FILTERS))])
    return np.stack([
        every[after], removed, fails[step] - removed, unique[step],
        good[before] - good[after], toxic[before] - toxic[after], shapley[step],
    ])


def _order_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, *survivors in zip(*(batch.column(k).to_pylist() for k in range(4))):
            rows = figures(*(np.array(s, np.int64) for s in survivors))
            columns = [pa.array([part] * len(_orders.names)), pa.array(_orders.names), pa.array(_orders.steps, pa.int32())]
            yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, rows)], ["part", "filter_order", "step", *_FIGURES])


def survival(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """(part, survivors, good, toxic): documents of each part that survive each subset of the filters.

    Element S of an array stands for the subset with the bits S, so element 0 counts
    all documents. Texts are read once; what is stored and shuffled afterwards is a
    document's failed filters and the digest of its text. Copies are found without
    gathering them: the smallest doc_id of each digest is formed with map-side sums, and
    each document looks itself up under its own doc_id and digest, which no copy shares.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("raw"),
    )
    failed = stored(map_batches(rows, _fail_batches, _FAILED), "failed-filters", "zstd")
    firsts = failed.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    flags = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    flags = flags.agg(_any("quality").alias("good"), _any("toxic").alias("toxic"))
    joined = failed.join(firsts, ["doc_id", "digest"], "left").join(flags, "doc_id", "left")
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    words = joined.select(
        "part", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"),
        F.when(copy, F.col("failed").bitwiseOR(F.lit(_COPY))).otherwise(F.col("failed")).alias("failed"),
    )
    counted = map_batches(words, _count_batches, _COUNTED)
    return counted.groupBy("part").agg(_total(), _total("good"), _total("toxic"))


def _any(column: str) -> Column:
    return F.max(F.coalesce(F.col(column) == 1, F.lit(False)))


def _total(label: str | None = None) -> Column:
    """Array of the sums of each element, of the rows with the label only if one is given."""
    value = lambda k: F.col("survivors")[k] if label is None else F.when(F.col(label), F.col("survivors")[k]).otherwise(0)
    return F.array(*[F.sum(value(k)) for k in range(SUBSETS)]).alias(label or "every")


def audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """What each filter removes in every order of the filters, for each part.

    One row per part, order of the five filters and step: documents `kept` after the
    step; `removed` by it; `redundant`: that fail its filter and are removed before;
    `unique_fails`: that fail its filter only; `good_lost` and `toxic_lost`: removed here
    with the label quality = 1 or toxic = 1; `shapley`: removed by the filter, summed
    over all orders. Zeros are given too.

    `docs` has doc_id, text and the part's column, `labels` doc_id, quality and toxic.
    A null text is empty, and so are its words; it fails A only, and E if a smaller
    doc_id has no text either. A null part is the empty one. A document is good or
    toxic if any of its label rows says so; missing and null labels say nothing. Repeated
    rows count each, and do not make each other copies, as their doc_id is the same. A
    null doc_id has no label and is neither a copy nor the origin of one. Empty tables
    give no rows; other columns, whatever their names, are ignored.
    """
    return map_batches(survival(docs, labels, part), _order_batches, _AUDIT)
