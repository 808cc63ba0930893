"""Filter audit: popcounts, texts, copies and every figure against counting by hand."""

import random
from collections import Counter
from itertools import permutations

import numpy as np
from llm_helpers import prose, rows_of

from seriesmill.llm import filter_audit
from seriesmill.llm.filter_audit import FILTERS, WORDS, failed_by_text, positional_popcount

LABELS = "doc_id long, quality int, toxic int, source string"


def by_hand(docs, labels):
    """Applies the filters document by document, order by order."""
    smallest = {}
    for doc_id, text, *_ in docs:
        if doc_id is not None:
            smallest[text or ""] = min(doc_id, smallest.get(text or "", doc_id))
    seen = []
    for doc_id, text, *source in docs:
        failed = {f for k, f in enumerate(FILTERS) if failed_by_text((text or "").encode()) >> k & 1}
        if doc_id is not None and smallest[text or ""] < doc_id:
            failed.add("E")
        marks = [(q, t) for i, q, t in labels if i is not None and i == doc_id]
        part = (source[0] if source else "s") or ""
        seen.append((part, failed, any(q == 1 for q, _ in marks), any(t == 1 for _, t in marks)))
    rows, shapley = [], Counter()
    for part in {s[0] for s in seen}:
        own = [s for s in seen if s[0] == part]
        for order in permutations(FILTERS):
            left = own
            for step, name in enumerate(order, 1):
                gone = [s for s in left if name in s[1]]
                left = [s for s in left if name not in s[1]]
                shapley[part, name] += len(gone)
                rows.append((
                    part, "".join(order), step, len(left), len(gone),
                    sum(name in s[1] for s in own) - len(gone), sum(s[1] == {name} for s in own),
                    sum(s[2] for s in gone), sum(s[3] for s in gone), name,
                ))
    return sorted((*r[:-1], shapley[r[0], r[-1]]) for r in rows)


def columns():
    return ["part", "filter_order", "step", *filter_audit._FIGURES]


def test_popcounts_equal_counting_bit_by_bit():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 4, 7, 8, 100, 5000):
        words = rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)
        assert positional_popcount(words).tolist() == [int(((words >> k) & 1).sum()) for k in range(32)]
    assert positional_popcount(np.full(999, 0xFFFFFFFF, np.uint32)).tolist() == [999] * 32


def test_survival_words_have_the_disjoint_subsets():
    assert [[s for s in range(32) if int(WORDS[f]) >> s & 1] for f in range(32)] == [
        [s for s in range(32) if not s & f] for f in range(32)
    ]


def test_filters_at_their_limits():
    def fails(text):
        return "".join(f for k, f in enumerate(FILTERS) if failed_by_text(text.encode()) >> k & 1)

    words = [f"w{i}" for i in range(200)]
    assert fails(" ".join(words)) == ""
    assert fails(" \t\x0b\x0c\r\n".join(words[:199])) == "A"
    assert fails(" ".join(words[:100] * 2)) == ""
    assert fails(" ".join(words[:99] * 2 + words[:2])) == "B"
    assert fails(" ".join(words).replace("w", "W", 20)) == "C" and fails(" ".join(words).replace("w", "W", 10)) == ""
    assert fails("é" * 49 + "A") == "A" and fails("é" * 48 + "A") == "AC"
    assert [fails(" ".join(words) + c) for c in "#$%&*|@<"] == ["D"] * 6 + [""] * 2
    assert fails("") == "A" and fails(" \n ") == "A" and fails("w1 w2") == "A"


def test_audit_equals_counting_by_hand(spark, documents):
    rng = random.Random(4)
    texts = [None, "", "Short", "a b a b a b a b", prose(rng, 250), prose(rng, 300) + " 5 %", prose(rng, 220).upper()]
    texts += [" ".join(["same words"] * 150), "LOUD # " + prose(rng, 40), prose(rng, 30_000)]
    docs = [(i, rng.choice(texts), rng.choice(["a", "b", "", None])) for i in range(150)]
    docs += [docs[3], docs[3], (None, texts[4], "a"), (None, None, "b"), (5, "another text of doc 5", "a")]
    rng.shuffle(docs)
    labels = [(i, rng.choice([0, 1, 2, None]), rng.choice([0, 1, None])) for i in range(0, 170, 2)]
    labels += [(4, 1, 1), (None, 1, 1)]
    marks = spark.createDataFrame([(*row, "x") for row in labels], LABELS)
    found = filter_audit.audit(documents(docs, "failed digest part first good every survivors").repartition(5), marks)
    rows = rows_of(found, *columns())
    assert rows == by_hand(docs, labels)
    assert {r[2] for r in rows} == {1, 2, 3, 4, 5} and any(r[6] for r in rows) and any(r[7] for r in rows)


def test_one_text_everywhere_and_empty_tables(spark, documents):
    labels = spark.createDataFrame([], LABELS)
    docs = [(i, "the same text", "hot") for i in range(3000)]
    rows = rows_of(filter_audit.audit(documents(docs), labels), *columns())
    assert rows == by_hand(docs, [])
    assert filter_audit.audit(documents([]), labels).count() == 0
