"""Token shards and counts: exact round trips and full encoding."""

import random

import numpy as np
import pytest
from llm_helpers import SMALL, prose, rows_of
from hypothesis import example, given, settings
from hypothesis import strategies as st

from seriesmill.llm import token_counts, token_shards, tokenizer

ENCODER = tokenizer.load(tokenizer.default_path())
TEXT = st.text(st.sampled_from("ab c.\n\t'séß9 \u2003"), max_size=60)


@settings(max_examples=300, deadline=None)
@given(TEXT)
@example("a  b ")
@example(" \n a's")
def test_both_patterns_agree(text):
    assert ENCODER.encode(text) == ENCODER._any.encode_ordinary(text)
    assert ENCODER.decode(ENCODER.encode(text)) == text


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 4097])
def test_feistel_is_a_keyed_permutation(n):
    slots = token_shards.feistel(np.arange(n), n, "k")
    assert sorted(slots.tolist()) == list(range(n))
    if n > 100:
        assert (slots != token_shards.feistel(np.arange(n), n, "other")).any()
        assert np.abs(np.diff(slots)).mean() > n / 5


def stream_of(spark, folder, length):
    rows = token_shards.read_shards(spark, folder).orderBy("sequence").collect()
    assert all(len(r.tokens) == 2 * length for r in rows)
    return rows, np.concatenate([np.frombuffer(r.tokens, "<u2")[: r.n_tokens] for r in rows])


def test_round_trip(spark, documents, tmp_path):
    rng = random.Random(9)
    rows = [(k, prose(rng, rng.randrange(0, 90))) for k in range(80)]
    rows += [(500, None), (501, ""), (502, "é  \n x " * 9000), (3, rows[3][1]), (None, "null id")]
    folder = str(tmp_path / "shards")
    token_shards.write_shards(documents(rows, "slot tokens part").repartition(6), folder, length=64, shard_sequences=50)
    found, stream = stream_of(spark, folder, 64)
    n = len(found)
    assert [r.sequence for r in found] == list(range(n))
    assert [r.slot for r in found] == token_shards.feistel(np.arange(n), n).tolist()
    assert all(r.shard == r.slot // 50 for r in found)
    ends = np.flatnonzero(stream == ENCODER.end)
    parts = np.split(stream, ends)
    plain = [ENCODER.decode([i for i in p.tolist() if i != ENCODER.end]) for p in parts[:-1]]
    assert sorted(plain) == sorted(t for _, t in rows if t)
    # A shard is one file with its rows in the order of slots.
    files = sorted((tmp_path / "shards").glob("shard=*/*.parquet"))
    assert len(files) == -(-n // 50)
    one = spark.read.parquet(str(files[0])).collect()
    assert [r.slot % 50 for r in one] == list(range(len(one)))


def test_no_tokens(spark, documents, tmp_path):
    folder = str(tmp_path / "none")
    token_shards.write_shards(documents([(1, None), (2, "")]), folder)
    assert token_shards.read_shards(spark, folder).count() == 0
    assert token_shards.training_order(documents([])).collect() == []


@settings(max_examples=400, deadline=None)
@given(st.lists(TEXT, max_size=6), st.lists(st.tuples(st.integers(0, 300), st.integers(0, 40), TEXT), max_size=5), st.integers(1, 12))
@example(["a b"], [(3, 0, " ")], 1)
@example([""], [(0, 0, "new words")], 4)
def test_recount_equals_full_encoding(parts, wishes, size):
    text = " ".join(parts)
    edits, free = [], 0
    for first, n, new in sorted(wishes):
        first = min(first, len(text))
        last = min(first + n, len(text))
        if first >= free:
            edits.append((first, last, new))
            free = last + 1
    lengths = token_counts.leaves(text, size)
    assert sum(lengths) == len(text)
    starts = np.cumsum([0, *lengths])
    counts = [len(ENCODER.encode(text[a:b])) for a, b in zip(starts, starts[1:])]
    assert sum(counts) == len(ENCODER.encode(text))
    expected, at = "", 0
    for first, last, new in edits:
        expected += text[at:first] + new
        at = last
    expected += text[at:]
    got, total, encoded = token_counts.recount(text, lengths, counts, edits, lambda t: len(ENCODER.encode(t)))
    assert got == expected and total == len(ENCODER.encode(expected))
    assert encoded <= len(expected) and (edits or not encoded)


def test_one_edit_encodes_a_small_part():
    text = prose(random.Random(1), 20_000)
    lengths = token_counts.leaves(text)
    starts = np.cumsum([0, *lengths])
    counts = [len(ENCODER.encode(text[a:b])) for a, b in zip(starts, starts[1:])]
    new, total, encoded = token_counts.recount(text, lengths, counts, [(50_000, 50_004, "edited here")], lambda t: len(ENCODER.encode(t)))
    assert total == len(ENCODER.encode(new)) and encoded < 1000


def test_count_tree():
    tree = token_counts.CountTree([3, 1, 4, 1, 5])
    tree.set(2, 10)
    assert tree.total == 20 and tree.sums[1] == tree.sums[2] + tree.sums[3]


def test_masked_counts(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    expected, edited = [], 0
    for r in docs.collect():
        edits = token_counts.replacements(r.text)
        new = token_counts.recount(r.text, [len(r.text)] if r.text else [], [0] if r.text else [], edits, len)[0]
        edited += bool(edits)
        expected.append((r.doc_id, len(ENCODER.encode(r.text)), len(ENCODER.encode(new)), len(edits)))
    found = token_counts.masked_counts(docs)
    assert rows_of(found, "doc_id", "tokens_before", "tokens_after", "n_edits") == sorted(expected)
    assert edited > 3


def test_count_edges(spark, documents):
    mail = "write to me@example.org today"
    rows = [(1, None), (2, ""), (3, mail), (3, mail), (3, "other a@b.org"), (None, mail), (5, "plain"), (6, mail * 5000)]
    table = documents(rows, "counts lengths text_hash edits")
    found = rows_of(token_counts.masked_counts(table), "doc_id", "tokens_before", "tokens_after", "n_edits")
    count = lambda t: len(ENCODER.encode(t or ""))
    new = lambda t: (t or "").replace("me@example.org", "<email>").replace("a@b.org", "<email>")
    assert [f[:3] for f in found[:-2]] == sorted((i, count(t), count(new(t))) for i, t in rows if i is not None and i < 6)
    assert found[-1][0] is None and found[-1][1:3] == (count(mail), count(new(mail)))
    assert token_counts.masked_counts(documents([])).collect() == []
    trees = token_counts.count_trees(documents([(1, "abc")]))
    none = spark.createDataFrame([(1, "abc", None), (9, "x", [(0, 1, "y")])], "doc_id long, text string, edits array<struct<first:int,last:int,text:string>>")
    assert rows_of(token_counts.counts_after_edits(trees, none), "tokens_after", "n_edits") == [(count("abc"), 0)]
