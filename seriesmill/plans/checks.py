"""The data checks of every table, as the project declares them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame

from seriesmill.operators import quality
from seriesmill.operators.quality import Check, accepted_values, between, matches_regex, not_null

# Ranges and label sets of the declared checks.
QUARTERS = [1, 2, 3, 4]
TIERS = [
    "North Island - Major", "North Island - Regional", "South Island - Major", "National", "Other",
]
GROWTH_CATEGORIES = [
    "Strong Growth (5%+)", "Moderate Growth (2.5-5%)", "Slow Growth (0-2.5%)", "Wage Decline",
    "Unknown",
]
BANDS = ["High Wage (Top 25%)", "Middle Wage", "Low Wage (Bottom 25%)"]
QUARTER_LABEL = "^[0-9]{4}Q[1-4]$"


def _required(*columns: str) -> list[Check]:
    return [not_null(column) for column in columns]


SERIES_KEY = ["series_reference", "period"]


def table_checks(first_year: int = 2000, last_year: int = 2030) -> dict[str, list[Check]]:
    """Checks per table; the year range is a parameter because data may be older."""
    year = between("year_num", first_year, last_year)
    return {
        "raw_household": _required(*SERIES_KEY),
        "raw_wages": _required(*SERIES_KEY),
        "raw_monthly": _required(*SERIES_KEY),
        "stg_household": [
            *_required(*SERIES_KEY, "period_start_date", "year_num", "quarter_num"),
            *_required("is_seasonally_adjusted", "units"),
            matches_regex("period", QUARTER_LABEL),
            year,
            accepted_values("quarter_num", QUARTERS),
            accepted_values("is_seasonally_adjusted", [True, False]),
        ],
        "stg_wages": [
            *_required(*SERIES_KEY, "period_start_date", "wage_nzd"),
            between("wage_nzd", 0, 10000, "warn"),
            accepted_values("sector_clean", ["Private", "Public", "All Sectors", "Other"]),
            accepted_values("wage_frequency", ["Hourly", "Weekly", "Other"]),
        ],
        "stg_monthly": [
            *_required(*SERIES_KEY, "period_start_date"),
            accepted_values("measure_clean", ["Filled Jobs", "Gross Earnings"], "warn"),
        ],
        "int_regional": [
            *_required("period_start_date", "year_num", "quarter_num", "year_quarter_label"),
            *_required("region"),
            year,
            accepted_values("quarter_num", QUARTERS),
            accepted_values("region_tier", TIERS),
        ],
        "int_wage_trends": [
            *_required("period_start_date", "year_quarter_label"),
            between("private_hourly_wage", 5, 500, "warn"),
            between("public_hourly_wage", 5, 500, "warn"),
        ],
        "mart_regional": [
            *_required("period_start_date", "region", "mart_refreshed_at"),
            between("employment_rate_pct", 0, 100, "warn"),
            between("unemployment_rate_pct", 0, 30, "warn"),
        ],
        "mart_wage": [
            *_required("period_start_date"),
            between("private_hourly_wage_nzd", 10, 500, "warn"),
            between("public_hourly_wage_nzd", 10, 500, "warn"),
            accepted_values("growth_category", GROWTH_CATEGORIES),
        ],
        "mart_industry": [
            *_required("period_start_date", "industry_anzsic", "avg_hourly_wage_nzd"),
            *_required("mart_refreshed_at"),
            between("avg_hourly_wage_nzd", 5, 500, "warn"),
            accepted_values("wage_band", BANDS),
        ],
    }


def rule_checks() -> dict[str, list[Check]]:
    """The two rules that are queries of their own."""
    return {
        "int_regional": [quality.implausible_unemployment()],
        "mart_wage": [quality.wages_positive()],
    }


def all_checks(first_year: int = 2000, last_year: int = 2030) -> dict[str, list[Check]]:
    """Declared checks and rules of each table."""
    declared = table_checks(first_year, last_year)
    for name, rules in rule_checks().items():
        declared[name] = [*declared[name], *rules]
    return declared


def check_tables(
    tables: dict[str, DataFrame], checks: dict[str, Sequence[Check]]
) -> DataFrame:
    """Verdicts for all given tables: one pass and one aggregate per table."""
    results = [quality.run_checks(df, name, checks[name]) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, results)
