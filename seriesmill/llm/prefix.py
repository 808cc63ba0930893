"""Running totals over a whole table in the order of evenly spread keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Keys are 60-bit numbers; each level of cells looks at 10 more of their leading bits.
KEY_BITS, LEVEL_BITS = 60, 10
#: Rows that one cell holds on average, at most.
CELL_ROWS = 50_000


def random_key(*parts: Column | str) -> Column:
    """60-bit key from an MD5 of the parts, so that SQL engines agree on it."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string") if isinstance(p, Column) else F.col(p).cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, KEY_BITS // 4), 16, 10).cast("long")


def levels_for(rows: int) -> int:
    """Levels of cells that keep the expected rows of a cell below CELL_ROWS; one at least."""
    levels = 1
    while rows >> (LEVEL_BITS * levels) > CELL_ROWS and levels < KEY_BITS // LEVEL_BITS:
        levels += 1
    return levels


def running_total(
    df: DataFrame, group: list[str], order: list[str], value: str, rows: int, out: str = "before"
) -> DataFrame:
    """Add the sum of `value` over the rows of the group that come earlier in `order`.

    `order` starts with a key of `random_key`. Its leading bits split every group into
    cells of equal width, which hold about equally many rows because keys are random: a
    group with a third of all rows is spread over a third of all cells. Rows are sorted
    within cells, cells are totalled first, and totals are summed up level by level, so a
    window never sees more than a cell or 1,024 totals. `rows` only sets the number of
    cells, not the result. Rows that are equal in `order` are taken in any order.
    """
    levels = levels_for(rows)
    cells = [f"_cell{k}" for k in range(levels)]
    for k, name in enumerate(cells):
        df = df.withColumn(name, F.shiftright(F.col(order[0]), KEY_BITS - LEVEL_BITS * (k + 1)))
    finest = group + cells
    inside = W.partitionBy(*finest).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    totals = df.groupBy(*finest).agg(F.sum(value).alias("_total"))
    offsets = None
    for k in range(levels - 1, -1, -1):
        own, above = cells[k], group + cells[:k]
        earlier = W.partitionBy(*above, *([] if above else [F.lit(0)])).orderBy(own)
        earlier = earlier.rowsBetween(W.unboundedPreceding, -1)
        placed = totals.withColumn(f"_offset{k}", F.coalesce(F.sum("_total").over(earlier), F.lit(0)))
        totals = totals.groupBy(*above).agg(F.sum("_total").alias("_total"))
        placed = placed.drop("_total")
        if offsets is None:
            offsets = placed
        else:
            offsets = _same(offsets, placed, above + [own])
    start = sum((F.col(f"_offset{k}") for k in range(1, levels)), F.col("_offset0"))
    offsets = offsets.select(*finest, start.alias("_start"))
    local = df.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = _same(local, offsets, finest)
    return joined.withColumn(out, F.col("_start") + F.col("_inside")).drop(*cells, "_start", "_inside")


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Join on keys where null equals null."""
    renamed = right.withColumnsRenamed({k: f"{k}_r" for k in keys})
    condition = [F.col(k).eqNullSafe(F.col(f"{k}_r")) for k in keys]
    return left.join(renamed, condition).drop(*[f"{k}_r" for k in keys])
