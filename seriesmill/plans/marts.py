"""Intermediate and mart models over the staged tables.

Each survey table is scanned once and reduced by a partial aggregate straight to
the grain of the model. Everything after that aggregate works on period-grain
rows. The wage models share one such aggregate (`wage_cells`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill import schema
from seriesmill.functions import labels, numbers, periods
from seriesmill.functions.text import has, none_of
from seriesmill.operators import aggregates, joins, windows

QUARTER = ["period_start_date", "year_num", "quarter_num"]
RATES = [
    "employment_rate_pct",
    "unemployment_rate_pct",
    "participation_rate_pct",
    "underutilisation_rate_pct",
]


# --- regional ---------------------------------------------------------------


def regional_rates(
    household: DataFrame, age_group: str | None = None, strict_labels: bool = False
) -> DataFrame:
    """A2: one row per quarter and region, six measures picked by label pattern.

    By default the patterns overlap as in the reference: an unemployment rate
    also matches "employment rate" and "Underemployed" also matches "employed".
    `strict_labels` removes both overlaps. Without `age_group` the maximum runs
    over all age groups.
    """
    rows = household.filter(
        F.col("sex").isin(schema.BOTH_SEXES) & ~F.col("is_seasonally_adjusted")
    )
    if age_group is not None:
        rows = rows.filter(F.col("age_group") == age_group)

    measure, value = F.col("measure_name"), F.col("data_value")
    is_count = has(F.col("units"), "number")
    employment_rate = has(measure, "employment rate")
    employed = has(measure, "employed") & ~has(measure, "unemployed") & is_count
    if strict_labels:
        employment_rate = employment_rate & ~has(measure, "unemployment rate")
        employed = employed & ~has(measure, "underemployed")

    # The date follows from year and quarter, so it is not a grouping key: the
    # shuffle by these three keys then also serves the join in `regional_employment`.
    return rows.groupBy(*joins.QUARTER_REGION).agg(
        aggregates.pick_max(employment_rate, value).alias("employment_rate_pct"),
        aggregates.pick_max(
            has(measure, "unemployment rate") & ~has(measure, "under"), value
        ).alias("unemployment_rate_pct"),
        aggregates.pick_max(has(measure, "participation rate"), value).alias(
            "participation_rate_pct"
        ),
        aggregates.pick_max(has(measure, "underutilisation rate"), value).alias(
            "underutilisation_rate_pct"
        ),
        aggregates.pick_max(employed, F.col("data_value_actual")).alias("employed_count"),
        aggregates.pick_max(
            has(measure, "unemployed") & is_count, F.col("data_value_actual")
        ).alias("unemployed_count"),
    )


def quarterly_jobs(monthly: DataFrame) -> DataFrame:
    """A4: mean filled jobs and total gross earnings per quarter and region.

    Total-industry rows count beside the industries and partial quarters are kept.
    """
    actual = F.col("data_value_actual")
    jobs = F.when(F.col("measure_clean") == "Filled Jobs", actual)
    earnings = F.when(F.col("measure_clean") == "Gross Earnings", actual)
    return (
        monthly.filter(~F.col("is_seasonally_adjusted"))
        .groupBy(*joins.QUARTER_REGION)
        .agg(
            numbers.mean(jobs).alias("avg_monthly_filled_jobs"),
            numbers.total(earnings).alias("total_quarterly_gross_earnings_nzd"),
        )
    )


def regional_employment(
    household: DataFrame,
    monthly: DataFrame,
    age_group: str | None = None,
    strict_labels: bool = False,
) -> DataFrame:
    """M4: region and quarter."""
    year, quarter, region = (F.col(c) for c in joins.QUARTER_REGION)
    rates = regional_rates(
        household.filter(F.col("region").isNotNull()), age_group, strict_labels
    )
    jobs = quarterly_jobs(monthly.filter(F.col("region").isNotNull()))
    return joins.left_on_quarter_region(rates, jobs).select(
        periods.quarter_start(year, quarter).alias("period_start_date"),
        "year_num",
        "quarter_num",
        periods.quarter_label(year, quarter).alias("year_quarter_label"),
        "region",
        *RATES,
        "employed_count",
        "unemployed_count",
        "avg_monthly_filled_jobs",
        "total_quarterly_gross_earnings_nzd",
        labels.region_tier(region).alias("region_tier"),
        labels.missing_flag(F.col("employment_rate_pct")).alias("missing_employment_rate"),
        labels.missing_flag(F.col("unemployment_rate_pct")).alias("missing_unemployment_rate"),
    )


def regional_mart(regional: DataFrame, refreshed_at: Column | None = None) -> DataFrame:
    """M6: region and quarter with the national benchmark and its gaps."""
    both = joins.with_benchmark(regional, RATES)
    return both.select(
        *QUARTER,
        "year_quarter_label",
        "region",
        "region_tier",
        *(F.round(rate, 1).alias(rate) for rate in RATES),
        numbers.round_to(F.col("employed_count"), 100).alias("employed_count"),
        numbers.round_to(F.col("unemployed_count"), 100).alias("unemployed_count"),
        F.round("avg_monthly_filled_jobs", 0).alias("avg_monthly_filled_jobs"),
        numbers.in_billions(F.col("total_quarterly_gross_earnings_nzd")).alias(
            "gross_earnings_billions_nzd"
        ),
        *(F.round("nz_" + rate, 1).alias("nz_" + rate) for rate in RATES),
        numbers.point_gap(
            F.col("unemployment_rate_pct"), F.col("nz_unemployment_rate_pct")
        ).alias("unemployment_rate_vs_nz_pp"),
        numbers.point_gap(F.col("employment_rate_pct"), F.col("nz_employment_rate_pct")).alias(
            "employment_rate_vs_nz_pp"
        ),
        "missing_employment_rate",
        "missing_unemployment_rate",
        (F.current_timestamp() if refreshed_at is None else refreshed_at).alias(
            "mart_refreshed_at"
        ),
    )


# --- wages ------------------------------------------------------------------


def wage_cells(wages: DataFrame) -> DataFrame:
    """Sum and number of staged wages per quarter, sector, industry and frequency.

    All wage models are sums over these cells, so one scan of the wages serves them.
    """
    if "wage_total" in wages.columns:
        return wages
    keys = [*QUARTER, "sector_clean", "industry_anzsic", "wage_frequency"]
    return wages.groupBy(*keys).agg(
        numbers.parts(F.col("wage_nzd")).alias("wage_total"),
        F.count("wage_nzd").alias("wage_count"),
        F.count("*").alias("row_count"),
    )


def _mean_of_cells(cells: DataFrame, keys: list[str], name: str) -> DataFrame:
    n = F.sum("wage_count")
    mean = F.when(n > 0, numbers.from_parts(numbers.add_parts(F.col("wage_total"))) / n)
    return cells.groupBy(*keys).agg(mean.alias(name), F.sum("row_count").alias("series_count"))


def hourly_by_sector(wages: DataFrame) -> DataFrame:
    """A5: unweighted mean hourly wage per quarter and sector, from staged wages or their cells."""
    hourly = wage_cells(wages).filter((F.col("wage_frequency") == "Hourly") & (F.col("wage_count") > 0))
    means = _mean_of_cells(hourly, [*QUARTER, "sector_clean"], "avg_hourly_wage_nzd").drop("series_count")
    return means.withColumn(
        "year_quarter_label", periods.quarter_label(F.col("year_num"), F.col("quarter_num"))
    )


def wage_growth_detail(wages: DataFrame) -> DataFrame:
    """Sector and quarter: growth over one and two years and the four-quarter mean."""
    wage, key = "avg_hourly_wage_nzd", ["sector_clean"]
    compared = hourly_by_sector(wages).withColumns(
        {
            "wage_1yr_ago": windows.rows_back(wage, 4, key),
            "wage_2yr_ago": windows.rows_back(wage, 8, key),
            "rolling_4q_avg_wage": windows.rolling_mean(wage, 4, key),
        }
    )
    return compared.select(
        *QUARTER,
        "year_quarter_label",
        "sector_clean",
        wage,
        "wage_1yr_ago",
        "rolling_4q_avg_wage",
        numbers.growth_pct(F.col(wage), F.col("wage_1yr_ago")).alias("yoy_wage_growth_pct"),
        numbers.growth_pct(F.col(wage), F.col("wage_2yr_ago")).alias("two_yr_wage_growth_pct"),
    )


def wage_trends(wages: DataFrame) -> DataFrame:
    """M5: one row per quarter, sectors side by side."""
    wage, growth = "avg_hourly_wage_nzd", "yoy_wage_growth_pct"
    wide = aggregates.pivot_by_value(
        wage_growth_detail(wages),
        [*QUARTER, "year_quarter_label"],
        "sector_clean",
        {
            "private_hourly_wage": ("Private", wage),
            "public_hourly_wage": ("Public", wage),
            "all_sectors_hourly_wage": ("All Sectors", wage),
            "private_yoy_growth_pct": ("Private", growth),
            "public_yoy_growth_pct": ("Public", growth),
            "all_sectors_yoy_growth_pct": ("All Sectors", growth),
        },
    )
    private, public = F.col("private_hourly_wage"), F.col("public_hourly_wage")
    return wide.withColumns(
        {
            "public_vs_private_premium_pct": numbers.growth_pct(public, private, 1),
            "public_vs_private_gap_nzd": numbers.point_gap(public, private, 2),
            "estimated_annual_salary_nzd": numbers.annualise(F.col("all_sectors_hourly_wage")),
        }
    )


def wage_mart(trends: DataFrame, refreshed_at: Column | None = None) -> DataFrame:
    """M7: quarter, rounded for reports, with the growth category."""
    sectors = ["private", "public", "all_sectors"]
    return trends.select(
        *QUARTER,
        "year_quarter_label",
        *(F.round(f"{s}_hourly_wage", 2).alias(f"{s}_hourly_wage_nzd") for s in sectors),
        *(F.round(f"{s}_yoy_growth_pct", 2).alias(f"{s}_wage_yoy_growth_pct") for s in sectors),
        F.round("public_vs_private_premium_pct", 1).alias("public_premium_pct"),
        F.round("public_vs_private_gap_nzd", 2).alias("public_vs_private_gap_nzd"),
        "estimated_annual_salary_nzd",
        labels.growth_category(F.col("all_sectors_yoy_growth_pct")).alias("growth_category"),
        (F.current_timestamp() if refreshed_at is None else refreshed_at).alias(
            "mart_refreshed_at"
        ),
    )


def industry_mart(wages: DataFrame, refreshed_at: Column | None = None) -> DataFrame:
    """M8: industry and quarter; ranks, bands and growth run on the rounded mean.

    Staged wages are positive, so that rule needs no test here.
    """
    industry, wage = F.col("industry_anzsic"), "avg_hourly_wage_nzd"
    rows = wage_cells(wages).filter(
        (F.col("wage_frequency") == "Hourly")
        & none_of(industry, schema.TOTAL_INDUSTRIES, trimmed=True)
    )
    means = _mean_of_cells(rows, [*QUARTER, "industry_anzsic"], wage)
    means = means.withColumn(wage, F.round(wage, 2))
    ranked = means.withColumns(windows.rank_columns(wage, ["period_start_date"])).withColumn(
        "wage_1yr_ago_nzd", windows.rows_back(wage, 4, ["industry_anzsic"])
    )
    percentile = F.round(F.col("wage_percentile") * 100, 0)
    return ranked.select(
        *QUARTER,
        periods.quarter_label(F.col("year_num"), F.col("quarter_num")).alias(
            "year_quarter_label"
        ),
        "industry_anzsic",
        wage,
        "wage_rank_highest",
        "wage_rank_lowest",
        percentile.alias("wage_percentile_pct"),
        labels.wage_band(percentile).alias("wage_band"),
        "wage_1yr_ago_nzd",
        numbers.growth_pct(F.col(wage), F.col("wage_1yr_ago_nzd")).alias("yoy_wage_growth_pct"),
        numbers.annualise(F.col(wage)).alias("estimated_annual_salary_nzd"),
        (F.current_timestamp() if refreshed_at is None else refreshed_at).alias(
            "mart_refreshed_at"
        ),
    )


def industry_wages_unrounded(wages: DataFrame) -> DataFrame:
    """The second ranking of the reference: unrounded means, labels not trimmed,
    bands on the unrounded position (C13)."""
    rows = wage_cells(wages).filter(
        (F.col("wage_frequency") == "Hourly")
        & none_of(F.col("industry_anzsic"), schema.TOTAL_INDUSTRIES)
    )
    means = _mean_of_cells(rows, [*QUARTER, "industry_anzsic"], "_wage")
    ranked = means.withColumns(windows.rank_columns("_wage", ["period_start_date"]))
    return ranked.select(
        *QUARTER,
        "industry_anzsic",
        F.round("_wage", 2).alias("avg_hourly_wage_nzd"),
        "wage_rank_highest",
        "wage_rank_lowest",
        F.round(F.col("wage_percentile") * 100, 0).alias("wage_percentile_pct"),
        labels.wage_band(F.col("wage_percentile"), full=1).alias("wage_band"),
    )


def newest_first(model: DataFrame, *then: str) -> DataFrame:
    """O1: presentation order; stored tables skip it to save the range shuffle."""
    return model.orderBy(F.col("period_start_date").desc_nulls_first(), *then)
