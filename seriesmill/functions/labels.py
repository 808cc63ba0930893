"""Classifiers: ordered rule tables in which the first match wins and NULL falls through."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from seriesmill.functions.text import has, same_label

Rule = tuple[Column, Column | str]


def ladder(rules: Sequence[Rule], otherwise: Column | str | None = None) -> Column:
    """Turn (condition, label) pairs into one CASE expression."""

    def as_column(label):
        return label if isinstance(label, Column) else F.lit(label)

    (condition, label), *rest = rules
    chain = F.when(condition, as_column(label))
    for condition, label in rest:
        chain = chain.when(condition, as_column(label))
    return chain.otherwise(as_column(otherwise))


def flag(condition: Column) -> Column:
    """A boolean that is never NULL."""
    return F.coalesce(condition, F.lit(False))


def household_adjusted(adjustment: Column, measure: Column) -> Column:
    """C1."""
    return flag(has(adjustment, "seasonal")) | flag(has(measure, "seasonally"))


def monthly_adjusted(adjustment: Column) -> Column:
    """C2."""
    return flag(has(adjustment, "seasonal"))


def rate_metric(units: Column) -> Column:
    """C3."""
    return flag(same_label(units, "percent"))


def suppression(suppressed: Column) -> Column:
    """`N` for empty or missing."""
    return F.coalesce(F.nullif(suppressed, F.lit("")), F.lit("N"))


def sector(label: Column) -> Column:
    """C6."""
    return ladder(
        [
            (has(label, "private"), "Private"),
            (has(label, "public"), "Public"),
            (has(label, "all"), "All Sectors"),
        ],
        "Other",
    )


def wage_frequency(label: Column) -> Column:
    """C7."""
    return ladder(
        [(has(label, "hourly"), "Hourly"), (has(label, "weekly"), "Weekly")], "Other"
    )


def monthly_measure(label: Column) -> Column:
    """Unknown measures keep their own name."""
    return ladder(
        [(has(label, "filled job"), "Filled Jobs"), (has(label, "gross earning"), "Gross Earnings")],
        label,
    )


def region_tier(region: Column) -> Column:
    """C9."""
    return ladder(
        [
            (has(region, "Auckland") | has(region, "Wellington"), "North Island - Major"),
            (has(region, "Canterbury"), "South Island - Major"),
            (region.isin("Waikato Region", "Bay of Plenty Region"), "North Island - Regional"),
            (region == "New Zealand", "National"),
        ],
        "Other",
    )


def missing_flag(value: Column) -> Column:
    """C10."""
    return value.isNull().cast("int")


def growth_category(growth: Column) -> Column:
    """C11."""
    return ladder(
        [
            (growth >= 5, "Strong Growth (5%+)"),
            (growth >= 2.5, "Moderate Growth (2.5-5%)"),
            (growth >= 0, "Slow Growth (0-2.5%)"),
            (growth < 0, "Wage Decline"),
        ],
        "Unknown",
    )


def wage_band(position: Column, full: float = 100) -> Column:
    """C12 with `full=100` (rounded percent), C13 with `full=1` (fraction)."""
    return ladder(
        [
            (position >= 0.75 * full, "High Wage (Top 25%)"),
            (position >= 0.25 * full, "Middle Wage"),
        ],
        "Low Wage (Bottom 25%)",
    )


def change_type(in_current: Column, in_previous: Column, current: Column, previous: Column) -> Column:
    """C14: decided by presence of the row, so that a NULL value is not taken for a missing row."""
    return ladder(
        [
            (~in_previous, "NEW ROW"),
            (~in_current, "ROW DELETED"),
            (~current.eqNullSafe(previous), "VALUE CHANGED"),
        ],
        "UNCHANGED",
    )


def direction(change: Column) -> Column:
    """C15."""
    return ladder([(change > 0, "risen"), (change < 0, "fallen")], "remained stable")


def side_of_national(gap: Column) -> Column:
    """C15."""
    return ladder([(gap > 0, "above")], "below")


def labour_health(rate: Column) -> Column:
    """C15."""
    return ladder(
        [(rate > 6, "struggling"), (rate < 4.5, "performing well")],
        "tracking close to the national average",
    )


def extreme(value: Column, highest: Column, lowest: Column) -> Column:
    """C16."""
    return ladder([(value == highest, "max"), (value == lowest, "min")], "other")


def gap_light(gap: Column) -> Column:
    """C17: NULL gap gives NULL."""
    return ladder([(gap > 1, "Red"), (gap < -1, "Green"), (gap.isNotNull(), "Yellow")])


def wage_growth_status(growth: Column) -> Column:
    """NULL growth gives NULL."""
    return ladder(
        [
            (growth >= 5, "Strong (5%+)"),
            (growth >= 2.5, "Moderate (2.5-5%)"),
            (growth >= 0, "Slow (0-2.5%)"),
            (growth < 0, "Declining"),
        ]
    )


def wage_growth_card(growth: Column) -> Column:
    """C18, the text on the card: a missing growth counts as zero."""
    known = F.coalesce(growth, F.lit(0.0))
    return ladder(
        [(known >= 5, "🟢 Strong"), (known >= 2.5, "🟡 Moderate"), (known >= 0, "🟠 Slow")], "🔴 Declining"
    )


def growth_light(growth: Column) -> Column:
    """NULL growth gives NULL."""
    return ladder([(growth >= 5, "Green"), (growth >= 0, "Amber"), (growth < 0, "Red")])
