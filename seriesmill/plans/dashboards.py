"""Dashboard queries over the raw tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill import schema
from seriesmill.functions import labels, numbers, periods
from seriesmill.functions.text import has
from seriesmill.operators import aggregates, joins, windows
from seriesmill.sources.tables import TableStore


def stored_report(df: DataFrame, store: TableStore, name: str) -> DataFrame:
    """A finished report as a stored table, of whatever size."""
    store.write(df, name)
    return store.read(name)


def _unemployment(household_raw: DataFrame, regions: Sequence[str]) -> DataFrame:
    rows = household_raw.filter(
        (F.col("series_title_1") == "Unemployment Rate")
        & (F.col("series_title_2") == "Total Both Sexes")
        & F.col("data_value").isNotNull()
        & F.col("series_title_3").isin(list(regions))
    )
    return rows.withColumnRenamed("series_title_3", "region")


def regional_unemployment(
    household_raw: DataFrame, regions: Sequence[str] = tuple(schema.DASHBOARD_REGIONS)
) -> DataFrame:
    """B1: lowest published rate per region and period."""
    return aggregates.lowest_by(
        _unemployment(household_raw, regions), ["region", "period"], "data_value", "unemployment_rate"
    )


def national_trend(household_raw: DataFrame, by_measure: bool = False) -> DataFrame:
    """B2: national unemployment and participation per period.

    The reference takes the smaller value of a period as unemployment and the
    larger as participation; `by_measure` uses the measure names instead.
    """
    measure, value = F.col("series_title_1"), F.col("data_value")
    rows = household_raw.filter(
        measure.isin("Unemployment Rate", "Labour Force Participation Rate")
        & (F.col("series_title_2") == "Total Both Sexes")
        & F.col("series_title_3").isin(schema.DASHBOARD_NATIONAL_REGIONS)
        & value.between(0, 100)
    )
    if not by_measure:
        return aggregates.spread_by(
            rows, ["period"], "data_value", "unemployment_rate", "participation_rate"
        )
    unemployed = measure == "Unemployment Rate"
    return rows.groupBy("period").agg(
        F.min(F.when(unemployed, value)).alias("unemployment_rate"),
        F.max(F.when(~unemployed, value)).alias("participation_rate"),
    )


def wage_rows(
    wages_raw: DataFrame, layout: dict[str, str] = schema.WAGE_DASHBOARD_LAYOUT
) -> DataFrame:
    """B3, first part: hourly ordinary-time wages in a plausible range, newest period first."""
    rows = wages_raw.filter(
        (F.col("units") == "Dollars")
        & F.col("data_value").between(20, 150)
        & has(F.col("series_title_3"), "Ordinary Time", "Hourly")
    )
    return rows.select(
        *(F.col(title).alias(name) for title, name in layout.items()),
        "period",
        F.col("data_value").alias("wage"),
    ).orderBy(F.col("period").desc())


def sector_wages(rows: DataFrame) -> DataFrame:
    """B3, second part: mean wage of the two sectors, both sexes.

    Spark drops the order of the rows before it aggregates.
    """
    kept = rows.filter(
        F.col("sector").isin("Public Sector", "Private Sector")
        & (F.col("sex") == "Total Both Sexes")
    )
    return aggregates.mean_by(kept, ["sector", "period"], "wage", "wage")


def latest_ranking(
    household_raw: DataFrame,
    period: str,
    regions: Sequence[str] = tuple(schema.LATEST_RANK_REGIONS),
) -> DataFrame:
    """Regions at one period with the highest and lowest marked."""
    rows = _unemployment(household_raw, regions).filter(F.col("period") == period)
    rates = aggregates.lowest_by(rows, ["region"], "data_value", "unemployment_rate")
    return windows.mark_extremes(rates, "unemployment_rate")


def latest_national_rate(household_raw: DataFrame) -> Column:
    """National unemployment rate at its newest period, as a scalar subquery."""
    newest = periods.sort_key(F.col("period"))
    return national_trend(household_raw).agg(F.max_by("unemployment_rate", newest)).scalar()


def region_story(regional: DataFrame, national_rate: Column | float) -> DataFrame:
    """Newest rate, change and gap to the nation with the words that go with them."""
    latest = windows.latest_and_previous(regional, "region", "period", "unemployment_rate")
    national = F.lit(national_rate) if isinstance(national_rate, float) else national_rate
    figures = latest.select(
        "region",
        "period",
        F.col("latest_value").alias("latest_rate"),
        numbers.point_gap(F.col("latest_value"), F.col("previous_value")).alias("change_pp"),
        numbers.point_gap(F.col("latest_value"), national).alias("vs_national_pp"),
    )
    return figures.withColumns(
        {
            "direction": labels.direction(F.col("change_pp")),
            "side": labels.side_of_national(F.col("vs_national_pp")),
            "health": labels.labour_health(F.col("latest_rate")),
            "change_size": F.abs("change_pp"),
            "change_text": numbers.signed_text(F.col("change_pp")),
        }
    )


def region_comparison(regional: DataFrame, selected: str) -> DataFrame:
    """All regions at the newest period, the chosen one marked."""
    return joins.at_latest_period(regional).withColumn(
        "is_selected", F.col("region") == selected
    )


def regions_over_time(regional: DataFrame, regions: Sequence[str]) -> DataFrame:
    """B7."""
    return regional.filter(F.col("region").isin(list(regions)))
