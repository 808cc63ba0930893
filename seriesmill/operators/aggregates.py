"""Grouped aggregates over long-format series.

All of them are built from aggregates with map-side partial state, so a hot
group is reduced inside each map task before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.functions import numbers


def pick_max(condition: Column, value: Column) -> Column:
    """A2/A3: one output of a conditional-MAX pivot."""
    return F.max(F.when(condition, value))


def pivot_by_value(
    df: DataFrame, keys: Sequence[str], label: str, outputs: dict[str, tuple[str, str]]
) -> DataFrame:
    """A3: `outputs` maps a new column to (label value, measure column)."""
    return df.groupBy(*keys).agg(
        *(
            pick_max(F.col(label) == wanted, F.col(measure)).alias(name)
            for name, (wanted, measure) in outputs.items()
        )
    )


def mean_by(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """A1/A5/A10: unweighted mean per group, NULLs skipped."""
    return df.groupBy(*keys).agg(numbers.mean(F.col(value)).alias(name))


def rounded_mean_by(
    df: DataFrame, keys: Sequence[str], value: str, name: str, digits: int = 2
) -> DataFrame:
    """Rounded mean and row count per group."""
    return df.groupBy(*keys).agg(
        F.round(numbers.mean(F.col(value)), digits).alias(name),
        F.count("*").alias("series_count"),
    )


def lowest_by(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """A7."""
    return df.groupBy(*keys).agg(F.min(value).alias(name))


def spread_by(
    df: DataFrame, keys: Sequence[str], value: str, low_name: str, high_name: str
) -> DataFrame:
    """MIN and MAX of one column, which tells two measures apart by size only."""
    return df.groupBy(*keys).agg(F.min(value).alias(low_name), F.max(value).alias(high_name))


def table_summary(df: DataFrame, loaded_at: str = "_ingested_at", period: str = "period") -> DataFrame:
    """One row, also for an empty table."""
    return df.agg(
        F.count("*").alias("row_count"),
        F.max(loaded_at).alias("last_ingested"),
        F.min(period).alias("earliest_period"),
        F.max(period).alias("latest_period"),
    )


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    """A11."""
    return df.select(column).distinct().orderBy(F.col(column).asc_nulls_last())


def mean_at_latest(
    df: DataFrame,
    value: str,
    name: str,
    keys: Sequence[str] = (),
    date: str = "period_start_date",
) -> DataFrame:
    """Mean of the rows at the latest date, per `keys` or overall.

    Aggregates to one row per date first and then keeps the newest, so the table
    is scanned once. The latest date is that of the rows given.
    """
    per_date = mean_by(df, [*keys, date], value, "_mean")
    return per_date.groupBy(*keys).agg(
        F.max(date).alias("latest_date"), F.max_by("_mean", date).alias(name)
    )


def failing_counts(df: DataFrame, column: str, fails: Column, count_name: str) -> DataFrame:
    """Offending values with their number of rows."""
    return df.filter(fails).groupBy(column).agg(F.count("*").alias(count_name))


def top_rows(df: DataFrame, order: Sequence[Column], n: int = 5) -> DataFrame:
    """Deterministic preview; runs as a per-partition top-n and one merge."""
    return df.orderBy(*order).limit(n)
