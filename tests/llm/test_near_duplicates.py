"""Signatures, groups and components against brute force."""

import random
import re

import numpy as np
import pytest
from llm_helpers import SMALL, prose, rows_of

from seriesmill.llm import components, words
from seriesmill.llm.components import connected_components, local_forest
from seriesmill.llm.near_duplicates import SLOTS, near_duplicates, superminhash, without_copies


def shingles(text, width):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(found) < width:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + width]) for i in range(len(found) - width + 1)}


def smallest_reachable(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute_force(rows, width):
    sets = {i: shingles(t, width) for i, t in rows}
    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    pairs = {(a, b) for same in holders.values() for a in same for b in same if a < b}
    links = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    component = smallest_reachable(sets, links)
    return sorted((i, len(s), component[i], component[i] == i) for i, s in sets.items())


COLUMNS = ("doc_id", "n_shingles", "component_id", "kept")


@pytest.mark.parametrize("width", [2, 5])
def test_small_table(spark, width):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    expected = brute_force([(r.doc_id, r.text) for r in docs.collect()], width)
    assert rows_of(near_duplicates(docs, width), *COLUMNS) == expected


def test_groups_with_chains_and_copies(documents):
    """Near copies of near copies, whose ends are not alike, and copies of two to many."""
    rng = random.Random(5)
    rows, doc_id = [], 0
    for size in (2, 3, 40, 150):
        text = prose(rng, 120).split()
        for k in range(size):
            rows.append((doc_id, " ".join(text).upper() if k % 3 == 0 else "  ".join(text)))
            doc_id += 1
            if k % 2:
                text[rng.randrange(len(text))] = f"new{doc_id}"
    rng.shuffle(rows)
    rows += [(doc_id + k, prose(rng, rng.randrange(1, 60))) for k in range(60)]
    assert rows_of(near_duplicates(documents(rows), 2), *COLUMNS) == brute_force(rows, 2)


def test_edges(documents):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "a " * 50_000), (8, "\x1c one")]
    found = rows_of(near_duplicates(documents(rows, "component_id kept n_shingles digest"), 2), *COLUMNS)
    assert found == brute_force(rows, 2)
    assert [r[2] for r in found][:5] == [1, 2, 3, 4, 4]


def test_null_and_repeated_ids(documents):
    text = "some words that are the same in all of these rows"
    table = documents([(None, text), (3, text), (3, text), (2, "x " + text), (None, "alone here")])
    found = rows_of(near_duplicates(table, 2), "doc_id", "component_id", "kept")
    assert found == [(2, 2, True), (3, 2, False), (3, 2, False), (None, 2, False), (None, None, True)]
    kept = without_copies(documents([(3, text), (3, text), (4, text), (None, "alone here")]), 2)
    assert rows_of(kept, "doc_id") == [(3,), (None,)]


def test_empty(documents):
    assert near_duplicates(documents([])).collect() == []
    assert without_copies(documents([])).columns == documents([]).columns


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    for n in (6, 60, 2000):
        agree = []
        for _ in range(60):
            pool = rng.integers(0, 2**63, n * 3 // 2, dtype=np.uint64)
            a, b = superminhash(np.unique(pool[:n])), superminhash(np.unique(pool[n // 2 :]))
            agree.append((a == b).mean())
        true = (n - n // 2) / len(pool)
        assert abs(np.mean(agree) - true) < 4 * (true * (1 - true) / SLOTS / 60) ** 0.5 + 0.005


def test_signature_has_every_slot_once_for_one_element():
    """The offers of one element are one per rank, each in another slot."""
    signature = superminhash(np.array([12345], np.uint64))
    assert sorted(int(v >> np.uint64(52)) for v in signature) == list(range(SLOTS))


def test_early_stop_changes_nothing():
    """The stepwise signature equals the minimum over the signatures of single elements."""
    elements = words.mix(np.arange(300, dtype=np.uint64))
    single = np.array([superminhash(elements[k : k + 1]) for k in range(len(elements))])
    assert (superminhash(elements) == single.min(axis=0)).all()


@pytest.mark.parametrize("local", [500_000, 0])
def test_components(spark, monkeypatch, local):
    """In one task and in rounds."""
    monkeypatch.setattr(components, "LOCAL_LINKS", local)
    rng = random.Random(3)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]
    links += [(1000 + k, 1001 + k) for k in range(60)] + [(5000, 6000 + k) for k in range(300)]
    links += [(None, 3), (7, None), (9, 9)]
    table = spark.createDataFrame(links, "a long, b long").repartition(7)
    known = [(a, b) for a, b in links if a is not None and b is not None and a != b]
    expected = smallest_reachable({n for link in known for n in link}, known)
    found = dict(rows_of(connected_components(table), "node", "component"))
    assert {n: found.get(n, n) for n in expected} == expected
    assert connected_components(table.where("false")).count() == 0


def test_local_forest():
    node, parent = local_forest(np.array([[5, 3], [3, 9], [7, 8], [4, 4]]))
    assert dict(zip(node.tolist(), parent.tolist())) == {5: 3, 9: 3, 8: 7}


def test_group_of_many_edits(documents):
    """Edits of one text, among them many that are linked with nothing or only with each other."""
    rng = random.Random(21)
    base = prose(rng, 90).split()
    rows = []
    for k in range(260):
        text = list(base)
        for _ in range(rng.choice([1, 2, 3, 4, 5, 6, 8, 11])):
            text[rng.randrange(90)] = f"edit{rng.randrange(40)}" if k % 3 else f"own{k}x{rng.randrange(9)}"
        rows.append((k, " ".join(text)))
        if k % 10 == 0:  # a far edit with a close copy of its own
            rows.append((1000 + k, " ".join(text[:45] + ["twin"] + text[46:])))
    expected = brute_force(rows, 2)
    assert 20 < len({r[2] for r in expected}) < 250
    assert rows_of(near_duplicates(documents(rows), 2), *COLUMNS) == expected
