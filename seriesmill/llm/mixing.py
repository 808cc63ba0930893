"""Mix sources to target weights: random keys, running totals, exact cuts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seriesmill.llm.prefix import random_key, running_total
from seriesmill.llm.scratch import stored, wrapped
from seriesmill.llm.words import WORD

#: Weights by rank of the source, repeating; share of all words that the mix has; epochs
#: after which a source gives no more.
WEIGHTS, SHARE_PERCENT, MOST_EPOCHS = (5, 2, 1), 150, 2
SEED = "mix-1"


def word_count(text: Column | str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from (source, source_size): the words each source gives.

    Sources in order of code points, null last, weigh 5, 2, 1 and so on. A source's
    target is its weight times a common level, or MOST_EPOCHS times its size if that is
    less. Sources are filled in the order in which they reach that limit as the level
    rises, so the level follows from running sums instead of rounds of sharing out. The
    table has one row per source and its windows are over sources, not documents.
    """
    everything = W.partitionBy(F.lit(0))
    place = F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (place % len(WEIGHTS) + 1).cast("int"))
    ranked = sizes.select("source", "source_size", place.alias("place"), weight.cast("double").alias("weight"))
    ranked = ranked.withColumn("most", F.col("source_size").cast("double") * MOST_EPOCHS)
    filling = everything.orderBy(F.col("most") / F.col("weight"), "place")
    earlier = filling.rowsBetween(W.unboundedPreceding, -1)
    ranked = (
        ranked.withColumn("wanted", F.sum("source_size").over(everything).cast("double") * SHARE_PERCENT / 100)
        .withColumn("full", F.coalesce(F.sum("most").over(earlier), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0)))
        .withColumn("level", (F.col("wanted") - F.col("full")) / F.col("open"))
    )
    # The level holds from the first source that does not reach its limit at it.
    is_open = F.col("most") > F.col("level") * F.col("weight")
    level = F.min(F.when(is_open, F.struct(F.col("most") / F.col("weight"), "place", "level"))).over(everything)["level"]
    target = F.least(F.col("most"), F.coalesce(level * F.col("weight"), F.col("most")))
    return ranked.select("source", "source_size", target.alias("target"))


def _placed(docs: DataFrame, seed: str) -> DataFrame:
    """(doc_id, source, size, key, source_size, target, epochs, last): whole epochs of a source, and words of the last one.

    `last` falls from `size` to 0 in the order of (key, doc_id, size) within a source.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        word_count(F.col("text").cast("string")).alias("size"),
        random_key(F.lit(seed), F.col("doc_id")).alias("key"),
    )
    rows = stored(rows, "mix-sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    sizes = stored(sizes, "mix-sources")
    n = sizes.agg(F.sum("rows")).first()[0] or 0
    placed = running_total(rows, ["source"], ["key", "doc_id", "size"], "size", n)
    targets = source_targets(sizes).withColumnRenamed("source", "of_source")
    placed = placed.join(F.broadcast(targets) if _few(sizes) else targets, placed.source.eqNullSafe(targets.of_source))
    epochs = F.when(F.col("source_size") > 0, F.expr("floor(target) div source_size")).otherwise(0)
    rest = F.floor("target") - F.col("epochs") * F.col("source_size")
    last = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    return placed.withColumn("epochs", epochs).withColumn("last", last)


def mix(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, taken, source) for each row of `docs` (doc_id, text, source).

    `size` is the number of words. Every document gets a random key; the documents of a
    source stand in the order of keys, and running totals give the words before each of
    them. A source gives whole epochs first. In the last epoch documents are taken from
    the front, and the one that lies on the budget gives only the words up to it, so a
    source's taken words are its target without the fraction.

    Null or empty texts have size 0 and give nothing. A null source is a source. Repeated
    rows are documents of their own; equal ones share the key and are interchangeable.
    An empty table gives no rows. Other columns are ignored.
    """
    taken = (F.col("epochs") * F.col("size") + F.col("last")).cast("long").alias("taken")
    return _placed(docs, seed).select("doc_id", "size", "source_size", "target", taken, "source")


def _few(sizes: DataFrame, most: int = 10_000) -> bool:
    """Whether the table of sources is small enough to send to every task (a row takes some 100 bytes)."""
    return sizes.count() <= most


def mixed_documents(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The rows of the mix with the columns of `docs`: each document as often as it is taken.

    The words taken of a document are rounded to whole documents, half up, so a source
    differs from its target by half a document at most. Documents without words are in
    no budget and are kept once. Rows of a source with the same doc_id are taken equally
    often. Columns of any other name are carried along.

    Within a source, documents are taken once more up to a point in the order of keys. One
    line per source, with its epochs and that point, is all that the texts meet, and where
    sources are few it is sent to them: no text is shuffled.
    """
    more = (F.col("size") > 0) & (2 * F.col("last") >= F.col("size"))
    cuts = _placed(docs, seed).groupBy(F.col("source").alias("of_source")).agg(
        F.max("epochs").cast("int").alias("epochs"), F.max(F.when(more, F.struct("key", "doc_id"))).alias("cut")
    )
    cuts = stored(cuts, "mix-cuts")
    row = F.col("row")
    at = F.struct(random_key(F.lit(seed), row["doc_id"]).alias("key"), row["doc_id"].cast("long").alias("doc_id"))
    rows = wrapped(docs).join(F.broadcast(cuts) if _few(cuts) else cuts, row["source"].cast("string").eqNullSafe(F.col("of_source")))
    words = F.coalesce(row["text"].cast("string").rlike(WORD), F.lit(False))
    copies = F.when(words, F.col("epochs") + F.when(at <= F.col("cut"), 1).otherwise(0)).otherwise(1)
    # An array of null marks, one for each copy.
    return rows.select("row", F.explode(F.array_repeat(F.lit(None).cast("int"), copies))).select("row.*")
