"""Quality classifier: ordinal cumulative-link regression on hashed text."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm import words
from seriesmill.llm.prefix import KEY_BITS, random_key
from seriesmill.llm.scratch import map_batches, sent_if_small, stored

#: Hash buckets of the shared weights, and grades (0 toxic, 1 poor, 2 good).
BUCKETS, GRADES = 1 << 18, 3
#: The model is fitted on about SAMPLE labelled documents of each grade, chosen by a hash
#: of the id, and on SAMPLE_FEATURES features in all, so the driver's memory is bounded.
SAMPLE, SAMPLE_FEATURES = 3_000, 8_000_000
#: Passes over the sample. A word gets a weight only if it would explain more than
#: LEAST_EVIDENCE documents of average weight.
PASSES, LEAST_EVIDENCE = 400, 0.5
#: A document is selected if it reaches the best grade with this probability.
LEAST_TAIL = 0.5

_OUTSIDE = np.ones(256, bool)
for _first, _last in (("0", "9"), ("A", "Z"), ("a", "z")):
    _OUTSIDE[ord(_first) : ord(_last) + 1] = False
_OUTSIDE[128:] = False
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))


def features(text: str | None) -> np.ndarray:
    """Sorted distinct buckets of a text: its words, and its shape in coarse steps.

    The shape is made of shares (capitals, digits, marks, repeated words) and the mean
    length of a word. A text without words has none.
    """
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    lower = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)
    starts, ends = words.bounds(lower, _OUTSIDE)
    if not len(starts):
        return np.zeros(0, np.int32)
    distinct = np.unique(words.run_hashes(lower, starts, ends))
    letters = int((ends - starts).sum())
    marks = len(raw) - letters - int(words.SPACE[raw].sum())
    symbols = int(_SYMBOL[raw].sum())
    shares = (
        ((raw >= 65) & (raw <= 90)).sum() / letters,
        ((raw >= 48) & (raw <= 57)).sum() / letters,
        marks / len(raw),
        1 - len(distinct) / len(starts) if len(starts) >= 10 else 0.0,
        min(letters / len(starts), 20) / 20,
        min(symbols / len(starts), 1),
        min(int((raw == 124).sum()) / len(starts), 1),
        min(int((raw == 33).sum()) / len(starts), 1),
    )
    shape = [k * 64 + int(share * 20) for k, share in enumerate(shares)] + [640 + min(9, int(np.log2(len(starts))))]
    hashed = words.mix(np.array(shape, np.uint64) + np.uint64(0x5348415045))
    return np.unique(np.concatenate([distinct, hashed]) % np.uint64(BUCKETS)).astype(np.int32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass(frozen=True)
class OrdinalModel:
    """P(grade <= k) = sigmoid(threshold k - score); the score is the sum of shared weights."""

    weights: np.ndarray
    thresholds: np.ndarray

    def scores(self, rows: np.ndarray, columns: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(rows, self.weights[columns], n)

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for each k below the highest grade."""
        return 1 - _sigmoid(self.thresholds[None, :] - scores[:, None])


def _slopes(thresholds: np.ndarray, scores: np.ndarray, grades: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slope of the negative log-likelihood of each document in its upper and lower threshold.

    The slope in the score is minus their sum.
    """
    edges = np.concatenate([[-np.inf], thresholds, [np.inf]])
    high, low = edges[grades + 1] - scores, edges[grades] - scores
    above, under = np.where(np.isinf(high), 1.0, _sigmoid(high)), np.where(np.isinf(low), 0.0, _sigmoid(low))
    chance = np.maximum(above - under, 1e-9)
    return -above * (1 - above) / chance, under * (1 - under) / chance


def fit(rows: np.ndarray, columns: np.ndarray, grades: np.ndarray, share: np.ndarray) -> OrdinalModel:
    """Accelerated proximal gradient descent on the likelihood of the grades.

    `rows`, `columns` are the sample's (document, bucket) entries, `share` the weight of
    each document. Each weight has a step of its own, from a bound on the curvature
    along it, so rare words move as fast as common ones. The L1 penalty sets the weights
    of words that tell nothing to zero, so that long texts gather no noise.
    """
    n, levels = len(grades), GRADES - 1
    share = share / share.sum()
    below = np.array([share[grades <= k].sum() for k in range(levels)]).clip(1e-3, 1 - 1e-3)
    thresholds = np.log(below / (1 - below))
    thresholds[1:] = np.maximum(thresholds[1:], thresholds[:-1] + 1e-2)
    width = np.bincount(rows, minlength=n) + 1
    curve = 0.5 * np.bincount(columns, (share * width)[rows], BUCKETS) + 1e-12
    theta_curve = 0.5 * (share * width).sum()
    penalty = LEAST_EVIDENCE / n
    weights = np.zeros(BUCKETS)
    ahead, theta_ahead, pace = weights, thresholds, 1.0
    for _ in range(PASSES):
        scores = np.bincount(rows, ahead[columns], n)
        high, low = _slopes(theta_ahead, scores, grades)
        slope = np.bincount(columns, (-(high + low) * share)[rows], BUCKETS)
        on_edges = np.bincount(grades + 1, high * share, levels + 2) + np.bincount(grades, low * share, levels + 2)
        moved = ahead - slope / curve
        new = np.sign(moved) * np.maximum(np.abs(moved) - penalty / curve, 0)
        theta_new = theta_ahead - on_edges[1:-1] / theta_curve
        theta_new[1:] = np.maximum(theta_new[1:], theta_new[:-1] + 1e-3)
        next_pace = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        if ((ahead - new) * (new - weights) * curve).sum() > 0:  # it went too far: start again from here
            next_pace = 1.0
        rate = (pace - 1) / next_pace if next_pace > 1 else 0.0
        ahead, theta_ahead = new + rate * (new - weights), theta_new + rate * (theta_new - thresholds)
        weights, thresholds, pace = new, theta_new, next_pace
    return OrdinalModel(weights.astype(np.float32), thresholds)


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): toxic is 0, otherwise 1 and one more for good quality; the lowest of several ratings."""
    toxic, quality = F.coalesce("toxic", F.lit(0)), F.col("quality")
    grade = F.when(toxic > 0, 0).when(quality > 0, 2).when(quality <= 0, 1)
    rated = labels.select(F.col("doc_id").cast("long").alias("doc_id"), grade.cast("int").alias("grade"))
    return rated.where("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.min("grade").alias("grade"))


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [features(t) for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))], ["doc_id", "grade", "buckets"]
        )


def train(docs: DataFrame, labels: DataFrame) -> OrdinalModel | None:
    """Fit on a bounded sample of labelled documents; None where fewer than two grades have one.

    Grades are counted over all labels. A sampled document weighs the square root of the
    labels that it stands for, so a rare grade is not drowned by a common one.
    """
    ratings = stored(graded(labels), "grades")
    sizes = {r["grade"]: r["n"] for r in ratings.groupBy("grade").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = F.lit(False)
    for grade, n in sizes.items():
        most = min(1 << KEY_BITS, (1 << KEY_BITS) * SAMPLE // n)
        chosen = chosen | ((F.col("grade") == grade) & (random_key(F.lit("sample"), F.col("doc_id")) < most))
    ids = sent_if_small(stored(ratings.where(chosen), "sample-ids"))  # some GRADES * SAMPLE rows
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sample = texts.join(ids, "doc_id").select("doc_id", "grade", "text")
    sample = stored(map_batches(sample, _feature_batches, "doc_id long, grade int, buckets array<int>"), "sample")
    sample = sample.where(F.size("buckets") > 0)
    found, used = [], 0
    for row in sample.orderBy(random_key(F.lit("order"), F.col("doc_id")), "doc_id").toLocalIterator():
        used += len(row["buckets"])
        if used > SAMPLE_FEATURES:
            break
        found.append((row["grade"], np.array(row["buckets"], np.int32)))
    grades = np.array([g for g, _ in found], np.int64)
    if len(set(grades.tolist())) < 2:
        return None
    rows = np.repeat(np.arange(len(found)), [len(b) for _, b in found])
    in_sample = np.bincount(grades, minlength=GRADES)
    share = np.array([np.sqrt(sizes[g] / in_sample[g]) for g in grades.tolist()])
    return fit(rows, np.concatenate([b for _, b in found]), grades, share)


def _score_batches(model: OrdinalModel) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for batch in batches:
            found = [features(t) for t in batch.column(1).to_pylist()]
            sizes = np.array([len(b) for b in found], np.int64)
            columns = np.concatenate([np.zeros(0, np.int32), *found])
            tails = model.tails(model.scores(np.repeat(np.arange(len(found)), sizes), columns, len(found)))
            empty = sizes == 0
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(tails.sum(axis=1), mask=empty), pa.array(tails[:, -1], mask=empty),
                    pa.array((tails[:, -1] >= LEAST_TAIL) & ~empty),
                ],
                ["doc_id", "expected_grade", "tail_probability", "selected"],
            )

    return run


def score(docs: DataFrame, model: OrdinalModel | None) -> DataFrame:
    """(doc_id, expected_grade, tail_probability, selected) for each row of `docs` (doc_id, text).

    `tail_probability` is the chance of the best grade and `expected_grade` the sum of
    the chances to exceed each lower grade. Whole texts are scored. A null text or one
    without words has neither and is not selected. Without a model both are null for
    all documents and nothing is selected. Other columns are ignored, repeated rows are
    scored alike.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if model is None:
        nothing = F.lit(None).cast("double")
        return texts.select(
            "doc_id", nothing.alias("expected_grade"), nothing.alias("tail_probability"), F.lit(False).alias("selected")
        )
    schema = "doc_id long, expected_grade double, tail_probability double, selected boolean"
    return map_batches(texts, _score_batches(model), schema)


def select_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on the labelled documents and score all."""
    return score(docs, train(docs, labels))
