"""Row filters over raw and staged series tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.functions import periods


def year_floor(year: Column, start_year: int) -> Column:
    """Years below the floor and unreadable years drop."""
    return year >= start_year


def valued_or_suppressed() -> Column:
    """Keep a row with a value or with the confidentiality mark."""
    return F.col("data_value").isNotNull() | (F.col("suppressed") == "S")


def valued(column: str = "data_value", positive: bool = False) -> Column:
    """P5."""
    value = F.col(column)
    return value > 0 if positive else value.isNotNull()


def in_dimension(df: DataFrame, column: str, members: DataFrame | Sequence[str]) -> DataFrame:
    """Keep rows whose label is in a list, or in the first column of a table.

    A table of members stays a plain semi join: Spark broadcasts it when its size
    is below the session's threshold and shuffles both sides otherwise.
    """
    if not isinstance(members, DataFrame):
        return df.filter(F.col(column).isin(list(members)))
    key = members.columns[0]
    return df.join(members.select(F.col(key).alias(column)), column, "left_semi")


def quarterly_rows(raw: DataFrame, dialect: str = "strict") -> DataFrame:
    """P1."""
    return raw.filter(periods.is_quarterly(F.col("period"), dialect))


def monthly_rows(raw: DataFrame, dialect: str = "strict") -> DataFrame:
    """P2."""
    return raw.filter(periods.is_monthly(F.col("period"), dialect))


def slicer(
    regions: Sequence[str] | None = None,
    first_date: str | None = None,
    last_date: str | None = None,
    year: int | None = None,
    date_column: str = "period_start_date",
) -> Column:
    """Region, date-range (inclusive) and year slicers as one condition."""
    date, chosen = F.col(date_column), F.lit(True)
    if regions is not None:
        chosen = chosen & F.col("region").isin(list(regions))
    if first_date is not None:
        chosen = chosen & (date >= F.lit(first_date).cast("date"))
    if last_date is not None:
        chosen = chosen & (date <= F.lit(last_date).cast("date"))
    if year is not None:
        chosen = chosen & (F.year(date) == year)
    return chosen
