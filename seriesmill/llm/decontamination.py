"""Benchmark decontamination: size-partitioned MinHash containment search, native."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.scratch import sent_if_small, stored

#: Words of a shingle and the percentage of an item's shingles that a document must hold.
WIDTH, PERCENT = 5, 80
#: A word of the test is a run of letters and digits of the lower-cased text.
TOKEN = r"[\p{L}\p{N}]+"


def _tokens(text: str) -> Column:
    lower = F.lower(F.col(text).cast("string"))
    return F.coalesce(F.regexp_extract_all(lower, F.lit(TOKEN), F.lit(0)), F.array().cast("array<string>"))


def _runs(tokens: str, width: int, run: Callable[[Column, Column], Column], kind: str) -> Column:
    """`run(words, first)` for each run of `width` words, distinct; none for fewer words.

    The words are bound to a variable, so the text is split once.
    """
    def of(words: Column) -> Column:
        last = F.size(words) - width
        runs = F.transform(F.sequence(F.lit(0), last), lambda first: run(words, first))
        return F.when(last >= 0, F.array_distinct(runs)).otherwise(F.array().cast(f"array<{kind}>"))

    return F.transform(F.array(F.col(tokens)), of)[0]


def _hashes(tokens: str, width: int) -> Column:
    def run(words: Column, first: Column) -> Column:
        return F.xxhash64(*[words[first + k] for k in range(width)])

    return _runs(tokens, width, run, "bigint")


def _shingles(tokens: str, width: int) -> Column:
    def run(words: Column, first: Column) -> Column:
        return F.array_join(F.slice(words, first + 1, F.lit(width)), " ")

    return _runs(tokens, width, run, "string")


def item_sketches(items: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(item_id, size, width, shingles, sketch): a bottom-k MinHash sketch whose k follows from the item's size.

    An item of q shingles may miss q - ceil(percent q / 100) of them. A sketch of one
    more shingle than that shares at least one with every document that contains enough
    of the item: no match is lost, and the sketch is a small part of the item. Items of
    up to 15, 31, 63, ... shingles form the partitions `size_class`, each with the k of
    its largest size. An item of fewer words than a shingle is one shingle of its own
    `width`, all of which a document must hold.
    """
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), _tokens("text").alias("tokens"))
    n = F.size("tokens")
    of_width = [rows.where(n == w if w < width else n >= w).withColumns(
        {"width": F.lit(w), "shingles": _shingles("tokens", w), "hashes": F.array_sort(_hashes("tokens", w))}
    ) for w in range(1, width + 1)]
    rows = reduce(DataFrame.unionByName, of_width).withColumn("size", F.size("shingles"))
    size_class = F.floor(F.log2(F.col("size"))).cast("int")
    largest = F.least(F.pow(F.lit(2), size_class + 1).cast("int") - 1, F.col("size") * 2)
    k = largest - F.ceil(largest * percent / 100.0).cast("int") + 1
    return rows.select(
        "item_id", "size", "width", "shingles", size_class.alias("size_class"), F.slice("hashes", F.lit(1), k).alias("sketch")
    )


def contaminated(docs: DataFrame, items: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, item_id, shared, size): the items of which a document holds `percent` of the shingles.

    Shingles are runs of `width` words; words are lower-cased and without punctuation,
    so line breaks and marks do not hide a passage. An item of fewer words is one run of
    its own length, and documents are cut into runs of each length that items have.
    Candidates come from the sketches: of a document's shingle hashes only those up to
    the largest hash in any sketch of the length (sketches hold the smallest ones) are
    looked up, once each. Then the full sets of the candidates are compared as texts.
    Shingles are made inside the scan; the lookup table is broadcast only where Spark
    finds its stored size below the session's limit.

    Null texts and texts without words match nothing, on either side. An item or
    document that occurs twice with one id is matched if any of its texts is; `shared`
    is then the largest count. Null ids are ids. Empty tables give no rows, and other
    columns are ignored.
    """
    sketches = stored(item_sketches(items, width, percent), "item-sketches")
    index = sketches.select("width", F.explode("sketch").alias("hash"), "item_id").distinct()
    index = stored(index, "sketch-index")
    tops = {row["width"]: row["top"] for row in index.groupBy("width").agg(F.max("hash").alias("top")).collect()}
    tops = tops or {width: -(1 << 63)}  # a row for each length, of which there are `width` at most
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tokens = texts.select("doc_id", _tokens("text").alias("tokens"))

    def low(w: int, top: int) -> Column:
        kept = F.filter(_hashes("tokens", w), lambda h: h <= F.lit(top))
        return F.transform(kept, lambda h: F.struct(F.lit(w).alias("width"), h.alias("hash")))

    seeds = tokens.select("doc_id", F.explode(F.concat(*[low(w, top) for w, top in sorted(tops.items())])).alias("s"))
    seeds = seeds.select("doc_id", "s.*")
    candidates = stored(seeds.join(index, ["width", "hash"]).select("doc_id", "item_id").distinct(), "leak-candidates")

    pairs = candidates.select(F.col("doc_id").alias("_doc"), F.col("item_id").alias("_item"))
    items_of = sketches.select("item_id", "size", "width", F.col("shingles").alias("of_item"))
    both = texts.join(pairs, F.col("doc_id").eqNullSafe(F.col("_doc")))
    both = both.join(items_of, F.col("_item").eqNullSafe(F.col("item_id")))
    both = both.withColumn("tokens", _tokens("text"))
    own = reduce(lambda other, w: F.when(F.col("width") == w, _shingles("tokens", w)).otherwise(other), sorted(tops), F.lit(None))
    shared = F.size(F.array_intersect(own, F.col("of_item")))
    both = both.select("doc_id", "item_id", shared.alias("shared"), "size")
    both = both.where(F.col("shared") * 100 >= F.col("size") * percent)
    return both.groupBy("doc_id", "item_id").agg(
        F.max("shared").cast("long").alias("shared"), F.max("size").cast("long").alias("size")
    )


def without_leaks(docs: DataFrame, items: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The documents that contain no test item; a document with a null id is judged with all null ids."""
    leaks = contaminated(docs, items, width, percent).select(F.col("doc_id").alias("_leak")).distinct()
    leaks = stored(leaks, "leaks")
    return docs.join(sent_if_small(leaks), docs.doc_id.eqNullSafe(leaks["_leak"]), "left_anti")
