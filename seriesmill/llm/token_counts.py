"""Token counts that follow edits: a tree of counts per document, re-encoded in part."""

from __future__ import annotations

import bisect
import re
from collections.abc import Callable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm import tokenizer
from seriesmill.llm.scratch import map_batches, stored

#: Characters of a leaf, at least.
LEAF = 256
# Personal data that the registered edits replace.
REPLACED = [
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", "<email>"),
    (r"\b\d{1,3}(?:\.\d{1,3}){3}\b", "<ip>"),
    (r"\+?\d[\d ()-]{7,}\d", "<phone>"),
]

_EDITS = "array<struct<first:int,last:int,text:string>>"


def cut_here(text: str, at: int) -> bool:
    """Whether pre-tokens always part before this character: a lone space between other characters.

    No pattern of a pre-token runs on over a space, and one that starts with the space
    cannot tell what came before it, so the counts on both sides add up.
    """
    return 0 < at < len(text) - 1 and text[at] == " " and not text[at - 1].isspace() and not text[at + 1].isspace()


def leaves(text: str, size: int = LEAF) -> list[int]:
    """Lengths of the parts of a text, cut at the first safe place after `size` characters."""
    out, start = [], 0
    while start < len(text):
        at = text.find(" ", start + size)
        while at >= 0 and not cut_here(text, at):
            at = text.find(" ", at + 1)
        end = at if at >= 0 else len(text)
        out.append(end - start)
        start = end
    return out


class CountTree:
    """Sums of token counts over the leaves of one document, in a binary tree.

    Node 1 is the root and node i has the children 2i and 2i + 1; the leaves fill the
    last level.
    """

    def __init__(self, counts: list[int]) -> None:
        self.width = 1 << max(0, (len(counts) - 1).bit_length())
        self.sums = [0] * self.width + counts + [0] * (self.width - len(counts))
        for node in range(self.width - 1, 0, -1):
            self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]

    @property
    def total(self) -> int:
        return self.sums[1]

    def set(self, leaf: int, count: int) -> None:
        """Change one leaf and the sums above it."""
        node = self.width + leaf
        change = count - self.sums[node]
        while node:
            self.sums[node] += change
            node >>= 1


def recount(
    text: str, lengths: list[int], counts: list[int], edits: list[tuple[int, int, str]], count: Callable[[str], int]
) -> tuple[str, int, int]:
    """The edited text, its token count, and the characters that were encoded for it.

    `edits` (first, last, replacement) are character ranges of the old text in order,
    without overlap. Leaves touched by an edit are encoded again, together with their
    neighbours as long as the border between them is no safe cut of the new text.
    """
    tree = CountTree(list(counts))
    ends = list(accumulate(lengths))
    leaf_of = lambda at: min(bisect.bisect_right(ends, at), max(0, len(ends) - 1))
    touched: dict[int, list[tuple[int, int, str]]] = {}
    regions: list[list[int]] = []
    for edit in edits:
        low, high = leaf_of(edit[0]), leaf_of(max(edit[0], edit[1] - 1))
        if regions and low <= regions[-1][1]:
            regions[-1][1] = max(regions[-1][1], high)
        else:
            regions.append([low, high])
        touched.setdefault(regions[-1][0], []).append(edit)
    parts: list[list] = []  # [first leaf, last leaf, text, changed], in order
    reached = 0
    for low, high in regions:
        parts += [[k, k, text[ends[k] - lengths[k] : ends[k]], False] for k in range(reached, low)]
        at = ends[low] - lengths[low] if ends else 0
        pieces = []
        for first, last, replacement in touched[low]:
            pieces += [text[at:first], replacement]
            at = last
        pieces.append(text[at : ends[high]] if ends else "")
        parts.append([low, high, "".join(pieces), True])
        reached = high + 1
    parts += [[k, k, text[ends[k] - lengths[k] : ends[k]], False] for k in range(reached, len(ends))]

    joined: list[list] = []
    for part in parts:
        # A border next to a change holds only if it is still a safe cut.
        while joined and (part[3] or joined[-1][3]) and not _border(joined[-1][2], part[2]):
            before = joined.pop()
            part = [before[0], part[1], before[2] + part[2], True]
        joined.append(part)
    encoded = 0
    for low, high, new, changed in joined:
        if changed:
            encoded += len(new)
            if not ends:
                tree.set(0, count(new))
                continue
            tree.set(low, count(new))
            for leaf in range(low + 1, high + 1):
                tree.set(leaf, 0)
    return "".join(part[2] for part in joined), tree.total, encoded


def _border(left: str, right: str) -> bool:
    return cut_here(left[-1:] + right[:2], len(left[-1:]))


def _count_batches(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        encode = tokenizer.load(path).encode
        for batch in batches:
            lengths, counts = [], []
            for text in batch.column(2).to_pylist():
                own = leaves(text or "")
                ends = list(accumulate(own))
                lengths.append(own)
                counts.append([len(encode(text[e - n : e])) for n, e in zip(own, ends)])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(lengths, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))],
                ["doc_id", "text_hash", "lengths", "counts"],
            )

    return run


def count_trees(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text_hash, lengths, counts) per row of `docs` (doc_id, text): the leaves of its tree.

    This is the state to keep: a few bytes for every LEAF characters. A null or empty
    text has no leaves.
    """
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    schema = "doc_id long, text_hash long, lengths array<int>, counts array<int>"
    return map_batches(rows, _count_batches(path or tokenizer.default_path()), schema)


def _edit_batches(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        encode = tokenizer.load(path).encode
        for batch in batches:
            out: list[list[int]] = [[], [], []]
            for text, lengths, counts, edits in zip(*(batch.column(k).to_pylist() for k in range(2, 6))):
                ordered = [(e["first"], e["last"], e["text"]) for e in edits]
                _, total, encoded = recount(text or "", lengths, counts, ordered, lambda t: len(encode(t)))
                for column, value in zip(out, (total, encoded, len(ordered))):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], *(pa.array(column, pa.int64()) for column in out)],
                ["_doc", "_hash", "after", "chars_encoded", "n_edits"],
            )

    return run


def counts_after_edits(trees: DataFrame, edited: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, tokens_before, tokens_after, n_edits, chars_encoded) for each row of `trees`.

    `edited` holds (doc_id, text, edits) of the documents that change: the text the tree
    was made of and its edits in order, without overlap. Only these are joined with
    their trees, and of their texts only the leaves that an edit touches are encoded,
    with neighbours where a border no longer holds. Documents that are not in `edited`
    keep their sums. A text that belongs to no tree is ignored, an edit of an empty text
    makes its first leaf, null edits are none, and rows that repeat are counted alike.
    """
    text = F.col("text").cast("string")
    rows = edited.where(F.size(F.coalesce("edits", F.array().cast(_EDITS))) > 0).select(
        F.col("doc_id").cast("long").alias("_doc"), F.xxhash64(text).alias("_hash"),
        text.alias("text"), F.col("edits").cast(_EDITS).alias("edits"),
    )
    rows = stored(rows.dropDuplicates(["_doc", "_hash"]), "edits", "zstd")
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & F.col("text_hash").eqNullSafe(F.col("_hash"))
    state = trees.join(rows, same).dropDuplicates(["_doc", "_hash"])
    schema = "_doc long, _hash long, after long, chars_encoded long, n_edits long"
    state = state.select("_doc", "_hash", "text", "lengths", "counts", "edits")
    changed = map_batches(state, _edit_batches(path or tokenizer.default_path()), schema)
    changed = stored(changed, "edited-counts")
    before = F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b)
    joined = trees.select("doc_id", "text_hash", before.alias("tokens_before")).join(changed, same, "left")
    return joined.select(
        "doc_id", "tokens_before", F.coalesce("after", "tokens_before").alias("tokens_after"),
        F.coalesce("n_edits", F.lit(0)).alias("n_edits"), F.coalesce("chars_encoded", F.lit(0)).alias("chars_encoded"),
    )


def replacements(text: str) -> list[tuple[int, int, str]]:
    """Ranges of personal data in a text, in order and without overlap, with what replaces them."""
    found: list[tuple[int, int, str]] = []
    for need, pattern, new in _PATTERNS:
        if need is None or need in text:
            found += [(m.start(), m.end(), new) for m in pattern.finditer(text)]
    out: list[tuple[int, int, str]] = []
    for edit in sorted(found):
        if not out or edit[0] >= out[-1][1]:
            out.append(edit)
    return out


_PATTERNS = [("@" if new == "<email>" else None, re.compile(pattern), new) for pattern, new in REPLACED]


def _replace_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("text", pa.string())]))
    for batch in batches:
        edits, rows = [], []
        for row, text in enumerate(batch.column(1).to_pylist()):
            if own := replacements(text or ""):
                rows.append(row)
                edits.append([{"first": a, "last": b, "text": new} for a, b, new in own])
        kept = batch.take(pa.array(rows, pa.int64()))
        yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(edits, kind)], ["doc_id", "text", "edits"])


def personal_data_edits(docs: DataFrame) -> DataFrame:
    """(doc_id, text, edits) of the documents with e-mail addresses, IP addresses or telephone numbers."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(texts, _replace_batches, f"doc_id long, text string, edits {_EDITS}")


def masked_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Token counts of all documents before and after personal data is replaced."""
    trees = stored(count_trees(docs, path), "count-trees")
    return counts_after_edits(trees, personal_data_edits(docs), path)
