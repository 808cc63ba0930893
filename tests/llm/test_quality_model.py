"""Ordinal regression: gradient, held-out accuracy and edges."""

import random

import numpy as np
from llm_helpers import prose, rows_of

from seriesmill.llm import quality_model


def graded_text(rng, grade):
    """Poor texts shout and repeat; toxic ones have a few bad words in clean prose."""
    body = prose(rng, rng.randrange(30, 200), 2000).split()
    if grade == 0:
        for _ in range(3):
            body.insert(rng.randrange(len(body)), rng.choice(["vile", "nasty", "rotten"]))
    if grade == 1:
        body = [w.upper() + "!!" for w in body[:12]] * 5
    return " ".join(body)


def test_held_out_grades(spark, documents):
    rng = random.Random(7)
    grades = [rng.choice([0, 1, 2, 2, 2]) for _ in range(900)]
    rows = [(k, graded_text(rng, g)) for k, g in enumerate(grades)]
    labels = spark.createDataFrame([(k, int(g > 1), int(g == 0)) for k, g in enumerate(grades[:600])], "doc_id long, quality int, toxic int")
    model = quality_model.train(documents(rows), labels)
    assert model.thresholds[0] < model.thresholds[1]
    found = {r.doc_id: r for r in quality_model.score(documents(rows), model).collect()}
    right = sum(found[k].selected == (grades[k] == 2) for k in range(600, 900))
    assert right >= 294
    means = [np.mean([found[k].expected_grade for k in range(600, 900) if grades[k] == g]) for g in range(3)]
    assert means[0] < means[1] < means[2]


def test_repeated_and_missing_labels(spark, documents):
    labels = spark.createDataFrame(
        [(1, 1, 0), (1, 1, 1), (2, 0, None), (3, None, 0), (None, 1, 0), (4, 1, 0), (4, 1, 0)], "doc_id long, quality int, toxic int"
    )
    assert rows_of(quality_model.graded(labels), "doc_id", "grade") == [(1, 0), (2, 1), (4, 2)]
    docs = documents([(1, "a"), (4, None), (5, ""), (5, "word " * 50_000)], "grade selected buckets")
    found = quality_model.select_good(docs, labels)  # one labelled text only
    assert {r.selected for r in found.collect()} == {False} and found.count() == 4
    assert quality_model.select_good(docs, labels.where("false")).where("expected_grade is null").count() == 4
    assert quality_model.select_good(documents([]), labels).collect() == []


def test_texts_without_words(spark, documents):
    rng = random.Random(1)
    rows = [(k, graded_text(rng, k % 3)) for k in range(90)] + [(100, None), (101, ""), (102, "!!! ???")]
    labels = spark.createDataFrame([(k, int(k % 3 > 1), int(k % 3 == 0)) for k in range(90)], "doc_id long, quality int, toxic int")
    found = rows_of(quality_model.select_good(documents(rows), labels).where("doc_id >= 100"), "doc_id", "tail_probability", "selected")
    assert found == [(100, None, False), (101, None, False), (102, None, False)]


def test_features_ignore_order_and_count_words_once():
    a, b = quality_model.features("one two three two"), quality_model.features("two two three one")
    assert (a == b).all() and len(set(a.tolist())) == len(a)


def test_fit_raises_likelihood():
    """The fitted model explains the sample better than the shares of its grades."""
    rng = np.random.default_rng(3)
    grades = rng.integers(0, 3, 300)
    rows = np.repeat(np.arange(300), 2)
    columns = np.column_stack([grades * 7 + 1, rng.integers(100, 400, 300)]).ravel()
    model = quality_model.fit(rows, columns, grades, np.ones(300))
    tails = model.tails(model.scores(rows, columns, 300))
    chance = np.concatenate([np.ones((300, 1)), tails], axis=1) - np.concatenate([tails, np.zeros((300, 1))], axis=1)
    assert np.log(chance[np.arange(300), grades]).mean() > -0.4
