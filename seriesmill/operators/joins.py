"""Joins between period-grain tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesmill import schema
from seriesmill.functions import periods

QUARTER_REGION = ["year_num", "quarter_num", "region"]


def left_on_quarter_region(left: DataFrame, right: DataFrame) -> DataFrame:
    """Both sides come aggregated by the same three keys, so their shuffle is reused."""
    return left.join(right, QUARTER_REGION, "left")


def with_benchmark(
    df: DataFrame,
    measures: Sequence[str],
    prefix: str = "nz_",
    labels: Sequence[str] = tuple(schema.NATIONAL_REGIONS),
    date: str = "period_start_date",
    region: str = "region",
) -> DataFrame:
    """Put the national figures of the same date beside every region.

    Equals a left self join on the date: with two national labels on a date each
    region row doubles, with none the figures are NULL. The national rows travel
    as a short array (one entry per label) over a window per date, which reads
    the table once instead of twice. National rows leave the result.

    The window holds all rows of a date, so `df` must be reduced to one row per date
    and region, as M4 is.
    """
    national = F.col(region).isin(list(labels)) & F.col(date).isNotNull()
    figures = F.struct(*(F.col(m).alias(prefix + m) for m in measures))
    same_date = Window.partitionBy(date)
    return (
        df.withColumn("_national", F.collect_list(F.when(national, figures)).over(same_date))
        .filter(~F.col(region).isin(list(labels)))
        .withColumn("_figures", F.explode_outer("_national"))
        .select(*df.columns, *(F.col("_figures." + prefix + m) for m in measures))
    )


def full_outer_on_keys(
    current: DataFrame, previous: DataFrame, keys: Sequence[str], value: str
) -> DataFrame:
    """Keys, both values and a presence mark for each side.

    Keys name one row per side. Rows with a NULL key can never match; they are
    spread by a hash of the row so that they do not meet in one task.
    """
    parts = 1024

    def side(df: DataFrame, name: str) -> DataFrame:
        incomplete = F.lit(False)
        for key in keys:
            incomplete = incomplete | F.col(key).isNull()
        spread = F.when(incomplete, F.pmod(F.xxhash64(*df.columns), F.lit(parts))).otherwise(-1)
        return df.select(
            *(F.col(key).alias(f"_{name}_{key}") for key in keys),
            F.col(value).alias(f"{name}_value"),
            F.lit(True).alias(f"in_{name}"),
            spread.alias(f"_{name}_spread"),
        )

    left, right = side(current, "current"), side(previous, "previous")
    condition = F.col("_current_spread") == F.col("_previous_spread")
    for key in keys:
        condition = condition & (F.col(f"_current_{key}") == F.col(f"_previous_{key}"))
    return left.join(right, condition, "full_outer").select(
        *(F.coalesce(f"_current_{key}", f"_previous_{key}").alias(key) for key in keys),
        "current_value",
        "previous_value",
        *(F.coalesce(mark, F.lit(False)).alias(mark) for mark in ("in_current", "in_previous")),
    )


def full_outer_of_buckets(
    current: DataFrame, previous: DataFrame, keys: Sequence[str], value: str
) -> DataFrame:
    """J3 for tables that are bucketed and sorted by the keys: no row is shuffled.

    As `full_outer_on_keys`, but without rows that have a NULL key; these are kept apart
    where such tables are written.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(
            *(F.col(key).alias(f"_{name}_{key}") for key in keys), F.col(value).alias(f"{name}_value"), F.lit(True).alias(f"in_{name}")
        )

    condition = F.lit(True)
    for key in keys:
        condition = condition & (F.col(f"_current_{key}") == F.col(f"_previous_{key}"))
    met = side(current, "current").join(side(previous, "previous"), condition, "full_outer")
    return met.select(
        *(F.coalesce(f"_current_{key}", f"_previous_{key}").alias(key) for key in keys),
        "current_value", "previous_value",
        *(F.coalesce(mark, F.lit(False)).alias(mark) for mark in ("in_current", "in_previous")),
    )


def missing_combinations(
    df: DataFrame,
    column: str = "region",
    expected: Sequence[str] = tuple(schema.REGIONS),
    quarter_columns: Sequence[str] = ("year_num", "quarter_num"),
) -> DataFrame:
    """(expected label, quarter) pairs that the table lacks.

    Each quarter collects which of the expected labels it has (at most as many as
    the list is long, combined in the map tasks) and returns the others. That
    equals listing all pairs and removing those present, without planning either
    the cross join or the anti join.
    """
    known = F.array(*(F.lit(label) for label in expected))
    listed = F.when(F.col(column).isin(list(expected)), F.col(column))
    return (
        df.groupBy(*quarter_columns)
        .agg(F.collect_set(listed).alias("_present"))
        .select(*quarter_columns, F.explode(F.array_except(known, "_present")).alias(column))
    )


def at_latest_period(df: DataFrame, period: str = "period") -> DataFrame:
    """Rows of the newest period, by a scalar subquery.

    Labels are compared by `periods.sort_key`, as `2025M9` is greater than `2025M12` as
    text. A stored table is partitioned by year, and only the partition of the newest
    year is read for the rows.
    """
    newest = df.agg(F.max(periods.sort_key(F.col(period)))).scalar()
    rows = df.filter(periods.sort_key(F.col(period)) == newest)
    if "period_year" not in df.columns:
        return rows
    year = F.year(newest.getField("start"))
    return rows.filter(year.isNull() | (F.col("period_year") == year))


def star_by_date(facts: DataFrame, wages: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bring columns of the wage mart (one row per date) to the region mart."""
    return facts.join(
        wages.select("period_start_date", *columns), "period_start_date", "left"
    )


def year_ago_by_shift(
    df: DataFrame, keys: Sequence[str], value: str, name: str, date: str = "period_start_date"
) -> DataFrame:
    """J4 for keys with more dates than one window partition should hold.

    Needs one row per key and date. Every row answers for its own date and asks for the
    date twelve months earlier, for which February may be cut to its 28th; answers and
    questions meet by aggregation. That equals the left self join on the shifted date
    with one scan and one shuffle. Two days can ask for the same earlier day, so a
    group holds three rows at most.
    """
    kind = df.schema[value].dataType
    asking = F.struct(F.col(date).alias("day"), F.col(value).alias("now"))
    nobody = F.lit(None).cast(f"struct<day:{df.schema[date].dataType.simpleString()},now:{kind.simpleString()}>")
    answer = F.struct(F.col(date).alias("_at"), F.col(value).alias("_then"), nobody.alias("_ask"))
    question = F.struct(
        F.add_months(date, -12).alias("_at"), F.lit(None).cast(kind).alias("_then"), asking.alias("_ask")
    )
    met = (
        df.select(*keys, F.inline(F.array(answer, question)))
        .groupBy(*keys, "_at")
        .agg(F.max("_then").alias("_then"), F.collect_list("_ask").alias("_asks"))
    )
    each = met.select(*keys, "_at", "_then", F.explode("_asks").alias("_ask"))
    earlier = F.when(F.col("_at").isNotNull(), F.col("_then"))
    return each.select(
        *keys, F.col("_ask.day").alias(date), F.col("_ask.now").alias(value), earlier.alias(name)
    )
