"""Time comparison and ranking.

Window partitions here hold one row per period (bounded by the calendar) or one
row per label of a period, because the callers aggregate first. For ranking rows
of an unreduced table use `rank_rows`, which never puts a whole group into one
task. NULL dates sort last, as in the source warehouse.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.functions import labels, periods
from seriesmill.session import scratch_path

DATE = "period_start_date"


def by_date(*keys: str, date: str = DATE) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(F.col(date).asc_nulls_last())


def rows_back(value: str, steps: int, keys: Sequence[str], date: str = DATE) -> Column:
    """Value `steps` rows earlier; a missing quarter shifts the comparison."""
    return F.lag(value, steps).over(by_date(*keys, date=date))


def months_back(value: str, months: int, keys: Sequence[str], date: str = DATE) -> Column:
    """Value of the row dated exactly `months` earlier, NULL when there is none.

    Needs one row per key and month, as the models give. A range frame of one
    point replaces the self join, so the table is read and shuffled once.
    """
    frame = (
        Window.partitionBy(*keys)
        .orderBy(periods.month_index(F.col(date)).asc_nulls_last())
        .rangeBetween(-months, -months)
    )
    return F.when(F.col(date).isNotNull(), F.max(value).over(frame))


def rolling_mean(value: str, rows: int, keys: Sequence[str], date: str = DATE) -> Column:
    """Mean of the current and the `rows - 1` earlier rows; shorter at the start."""
    return F.avg(value).over(by_date(*keys, date=date).rowsBetween(1 - rows, 0))


def rank_columns(value: str, keys: Sequence[str]) -> dict[str, Column]:
    """W4/W5 over rows that are already reduced to one per label."""
    group = Window.partitionBy(*keys)
    rising = group.orderBy(F.col(value).asc_nulls_last())
    falling = group.orderBy(F.col(value).desc_nulls_first())
    return {
        "wage_rank_highest": F.rank().over(falling),
        "wage_rank_lowest": F.rank().over(rising),
        "wage_percentile": F.percent_rank().over(rising),
    }


def rank_rows(df: DataFrame, key: str, value: str) -> DataFrame:
    """W4/W5 for an unreduced table: exact ranks even if one key holds most rows.

    Rows are first counted per (key, value). These counts are dealt out in ranges of (key,
    value), which Spark cuts from a sample so that the ranges are about equally large: the
    more data, the more partitions the session gives the shuffle. Ranks inside a partition
    come from a window over it, and the rows below it from a window over one total per
    partition and key. So no task holds more than a partition, wherever the values lie.
    The ranks then go back to the rows by an equi join. Rows without a value keep NULL
    ranks. The ranges are stored, so that a task that is run again finds the same cuts.
    """
    values = df.filter(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("_n"))
    dealt = values.repartitionByRange(F.col(key), F.col(value)).withColumn("_part", F.spark_partition_id())
    path = scratch_path(df.sparkSession, "ranges")
    dealt.write.parquet(path)
    dealt = df.sparkSession.read.schema(dealt.schema).parquet(path)
    before = Window.unboundedPreceding, -1
    whole_key = Window.partitionBy(key)
    totals = (
        dealt.groupBy(key, "_part")
        .agg(F.sum("_n").alias("_part_n"))
        .select(
            F.col(key).alias("_key"),
            F.col("_part").alias("_part_id"),
            F.coalesce(F.sum("_part_n").over(whole_key.orderBy("_part").rowsBetween(*before)), F.lit(0)).alias("_below_part"),
            F.sum("_part_n").over(whole_key).alias("_total"),
        )
    )
    in_part = Window.partitionBy(key, "_part").orderBy(value).rowsBetween(*before)
    counted = dealt.withColumn("_below", F.coalesce(F.sum("_n").over(in_part), F.lit(0)))
    joined = counted.join(
        totals, (F.col(key).eqNullSafe(F.col("_key"))) & (F.col("_part") == F.col("_part_id"))
    )
    below = F.col("_below_part") + F.col("_below")
    rest = F.col("_total") - F.lit(1)
    ranks = joined.select(
        F.col(key).alias("_key"),
        F.col(value).alias("_value"),
        (F.col("_total") - below - F.col("_n") + 1).alias("rank_highest"),
        (below + 1).alias("rank_lowest"),
        F.when(rest > 0, below / rest).otherwise(F.lit(0.0)).alias("percentile"),
    )
    matches = F.col(key).eqNullSafe(F.col("_key")) & (F.col(value) == F.col("_value"))
    return df.join(ranks, matches, "left").drop("_key", "_value")


def latest_and_previous(
    df: DataFrame, key: str, period: str, value: str
) -> DataFrame:
    """Newest row per key with the value before it, in one order of the rows.

    Labels are in the order of time, whatever their form; dates are in their own.
    """
    is_label = isinstance(df.schema[period].dataType, T.StringType)
    order = periods.sort_key(F.col(period)) if is_label else F.col(period)
    ordered = Window.partitionBy(key).orderBy(order.asc_nulls_first())
    return (
        df.withColumn("previous_value", F.lag(value, 1).over(ordered))
        .withColumn("_later", F.lead(F.lit(1), 1).over(ordered))
        .filter(F.col("_later").isNull())
        .select(
            key,
            period,
            F.col(value).alias("latest_value"),
            F.coalesce("previous_value", value).alias("previous_value"),
        )
    )


def mark_extremes(df: DataFrame, value: str, name: str = "highlight") -> DataFrame:
    """Highest and lowest row of a result.

    Both extremes are aggregated (with partial state) and come back as one scalar
    subquery, so the rows themselves are not gathered in one task.
    """
    ends = df.agg(F.struct(F.max(value).alias("high"), F.min(value).alias("low"))).scalar()
    return df.withColumn(
        name, labels.extreme(F.col(value), ends.getField("high"), ends.getField("low"))
    )
