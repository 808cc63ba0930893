"""Report measures over the mart tables; slice the mart first to set the filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.functions import labels, numbers
from seriesmill.operators import aggregates, windows

DATE = "period_start_date"


def latest_rates(region_mart: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean unemployment and employment rate at the newest date."""
    per_date = region_mart.groupBy(*keys, DATE).agg(
        numbers.mean(F.col("unemployment_rate_pct")).alias("_unemployment"),
        numbers.mean(F.col("employment_rate_pct")).alias("_employment"),
    )
    return per_date.groupBy(*keys).agg(
        F.max(DATE).alias("latest_date"),
        F.max_by("_unemployment", DATE).alias("latest_unemployment_rate"),
        F.max_by("_employment", DATE).alias("latest_employment_rate"),
    )


def latest_salary(wage_mart: DataFrame) -> DataFrame:
    """Estimated annual salary at the newest date."""
    salary = "estimated_annual_salary_nzd"
    return aggregates.mean_at_latest(wage_mart, salary, salary)


def unemployment_change(region_mart: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Newest mean rate against the mean of exactly twelve months earlier.

    NULL when there is no earlier rate. `keys` gives one row per slice.
    """
    per_date = aggregates.mean_by(
        region_mart, [*keys, DATE], "unemployment_rate_pct", "_rate"
    )
    compared = per_date.withColumn("_prior", windows.months_back("_rate", 12, keys, DATE))
    newest = compared.groupBy(*keys).agg(
        F.max(DATE).alias("latest_date"),
        F.max_by("_rate", DATE).alias("current_rate"),
        F.max_by("_prior", DATE).alias("prior_rate"),
    )
    return newest.withColumn("yoy_change_pp", F.col("current_rate") - F.col("prior_rate"))


def unemployment_change_series(region_mart: DataFrame) -> DataFrame:
    """J4 per region and date: rate, rate a year earlier and their difference."""
    earlier = windows.months_back("unemployment_rate_pct", 12, ["region"])
    return region_mart.select(
        DATE, "region", "unemployment_rate_pct", earlier.alias("rate_1yr_ago")
    ).withColumn("yoy_change_pp", F.col("unemployment_rate_pct") - F.col("rate_1yr_ago"))


def average_gap(region_mart: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean gap of the regions to the nation."""
    return aggregates.mean_by(
        region_mart, keys, "unemployment_rate_vs_nz_pp", "regional_vs_national_gap"
    )


def wage_averages(wage_mart: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean public premium and mean public-private gap."""
    return wage_mart.groupBy(*keys).agg(
        numbers.mean(F.col("public_premium_pct")).alias("public_sector_premium_pct"),
        numbers.mean(F.col("public_vs_private_gap_nzd")).alias("wage_gap_nzd"),
    )


def wage_status(
    wage_mart: DataFrame, keys: Sequence[str] = (), card_labels: bool = False
) -> DataFrame:
    """Status and traffic light of the mean growth; NULL without growth.

    `card_labels` gives the status its other text, in which a missing growth counts as
    zero and therefore reads as slow.
    """
    status = labels.wage_growth_card if card_labels else labels.wage_growth_status
    growth = aggregates.mean_by(
        wage_mart, keys, "all_sectors_wage_yoy_growth_pct", "avg_growth_pct"
    )
    return growth.withColumns(
        {
            "growth_status": status(F.col("avg_growth_pct")),
            "growth_light": labels.growth_light(F.col("avg_growth_pct")),
        }
    )


def gap_lights(region_mart: DataFrame) -> DataFrame:
    """Traffic light per region and date."""
    gap = F.col("unemployment_rate_vs_nz_pp")
    return region_mart.select(
        DATE, "region", "unemployment_rate_vs_nz_pp", labels.gap_light(gap).alias("gap_light")
    )


def headline(regional: DataFrame, trends: DataFrame) -> DataFrame:
    """The four figures of the first page, from the national rows of M4 and from M5.

    Unemployment and employment rate and people employed at the newest quarter, with
    their change on the quarter before, and the mean hourly wage with its growth on a
    year earlier. Both inputs have one row per quarter once they are national.
    """
    national = regional.filter(F.col("region") == "New Zealand")
    figures = ["unemployment_rate_pct", "employment_rate_pct", "employed_count"]
    compared = national.select(
        DATE, *figures, *(windows.months_back(f, 3, ["region"]).alias(f"_{f}") for f in figures)
    )
    place = F.max_by(F.struct(*figures, *(f"_{f}" for f in figures)), DATE).alias("now")
    people = compared.agg(F.max(DATE).alias("latest_date"), place)
    wage = F.struct("all_sectors_hourly_wage", "all_sectors_yoy_growth_pct")
    wages = trends.filter(F.col("all_sectors_hourly_wage").isNotNull())
    newest_wage = wages.agg(F.max_by(wage, DATE)).scalar()
    return people.withColumn("wage", newest_wage).select(
        "latest_date",
        F.round("now.unemployment_rate_pct", 1).alias("unemployment_rate_pct"),
        numbers.point_gap(F.col("now.unemployment_rate_pct"), F.col("now._unemployment_rate_pct")).alias("unemployment_change_pp"),
        F.round("now.employment_rate_pct", 1).alias("employment_rate_pct"),
        numbers.point_gap(F.col("now.employment_rate_pct"), F.col("now._employment_rate_pct")).alias("employment_change_pp"),
        F.round("wage.all_sectors_hourly_wage", 2).alias("hourly_wage_nzd"),
        F.round("wage.all_sectors_yoy_growth_pct", 1).alias("wage_growth_pct"),
        F.col("now.employed_count").alias("employed_count"),
        (F.col("now.employed_count") - F.col("now._employed_count")).alias("employed_change"),
    )
