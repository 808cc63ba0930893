"""Staging models: typed, decoded, lazily evaluated projections of the raw tables.

They add no shuffle: each one is a filter and a projection that stays in one
generated-code stage with the scan. When the raw table carries the `period_year`
partition column written by `sources.tables`, the year floor also prunes
partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill import schema
from seriesmill.functions import labels, numbers, periods
from seriesmill.operators import filters

LINEAGE = ["_ingested_at", "_source_file"]


def decode_titles(df: DataFrame, layout: dict[str, str]) -> DataFrame:
    """Add the dimensions that the survey keeps in its title columns."""
    return df.withColumns({dimension: F.col(title) for title, dimension in layout.items()})


def _since(raw: DataFrame, start_year: int) -> DataFrame:
    if "period_year" in raw.columns:
        raw = raw.filter(F.col("period_year") >= start_year)
    return raw


def _of_group(raw: DataFrame, group_name: str | None) -> DataFrame:
    return raw if group_name is None else raw.filter(F.col("group_name") == group_name)


def _add_quarter(raw: DataFrame, dialect: str) -> DataFrame:
    parts = periods.parse_quarterly(F.col("period"), dialect)
    return raw.withColumns({"year_num": parts.year, "quarter_num": parts.quarter}).withColumn(
        "period_start_date", periods.quarter_start(F.col("year_num"), F.col("quarter_num"))
    )


def stage_household(
    raw: DataFrame,
    start_year: int = schema.DEFAULT_START_YEAR,
    dialect: str = "strict",
    layout: dict[str, str] = schema.HOUSEHOLD_LAYOUT,
    group_name: str | None = None,
) -> DataFrame:
    """M1: household survey, one row per series and quarter."""
    rows = _of_group(_since(raw, start_year), group_name)
    rows = filters.quarterly_rows(rows, dialect).filter(filters.valued_or_suppressed())
    rows = _add_quarter(rows, dialect).filter(filters.year_floor(F.col("year_num"), start_year))
    return decode_titles(rows, layout).select(
        "series_reference",
        "period",
        "period_start_date",
        "year_num",
        "quarter_num",
        "data_value",
        "units",
        labels.suppression(F.col("suppressed")).alias("is_suppressed"),
        "status",
        "magnitude",
        *layout.values(),
        labels.household_adjusted(F.col("adjustment_type"), F.col("measure_name")).alias(
            "is_seasonally_adjusted"
        ),
        labels.rate_metric(F.col("units")).alias("is_rate_metric"),
        numbers.scale_by_magnitude(F.col("data_value"), F.col("magnitude")).alias(
            "data_value_actual"
        ),
        *LINEAGE,
    )


def stage_wages(
    raw: DataFrame,
    start_year: int = schema.DEFAULT_START_YEAR,
    dialect: str = "strict",
    layout: dict[str, str] = schema.WAGE_LAYOUT,
    group_name: str | None = None,
) -> DataFrame:
    """M2: wages, one row per series and quarter; the magnitude is not applied."""
    rows = _of_group(_since(raw, start_year), group_name)
    rows = filters.quarterly_rows(rows, dialect).filter(filters.valued(positive=True))
    rows = _add_quarter(rows, dialect).filter(filters.year_floor(F.col("year_num"), start_year))
    return decode_titles(rows, layout).select(
        "series_reference",
        "period",
        "period_start_date",
        "year_num",
        "quarter_num",
        "data_value",
        "units",
        "status",
        "magnitude",
        "wage_measure",
        "sector",
        labels.sector(F.col("sector")).alias("sector_clean"),
        "industry_anzsic",
        labels.wage_frequency(F.col("wage_measure")).alias("wage_frequency"),
        F.col("data_value").alias("wage_nzd"),
        *LINEAGE,
    )


def stage_monthly(
    raw: DataFrame,
    start_year: int = schema.DEFAULT_START_YEAR,
    dialect: str = "strict",
    layout: dict[str, str] = schema.MONTHLY_LAYOUT,
    group_name: str | None = None,
) -> DataFrame:
    """M3: monthly indicators, one row per series and month."""
    rows = _of_group(_since(raw, start_year), group_name)
    rows = filters.monthly_rows(rows, dialect).filter(filters.valued())
    parts = periods.parse_monthly(F.col("period"))
    rows = rows.withColumns(
        {
            "year_num": parts.year,
            "month_num": parts.month,
            "quarter_num": parts.quarter,
            "period_start_date": parts.start,
        }
    ).filter(filters.year_floor(F.col("year_num"), start_year))
    return decode_titles(rows, layout).select(
        "series_reference",
        "period",
        "period_start_date",
        "year_num",
        "month_num",
        "quarter_num",
        "data_value",
        "units",
        "status",
        "magnitude",
        "measure_name",
        labels.monthly_measure(F.col("measure_name")).alias("measure_clean"),
        "industry",
        "region",
        "adjustment_type",
        labels.monthly_adjusted(F.col("adjustment_type")).alias("is_seasonally_adjusted"),
        numbers.scale_by_magnitude(F.col("data_value"), F.col("magnitude")).alias(
            "data_value_actual"
        ),
        *LINEAGE,
    )
