"""Period labels: `2025Q4`, `2025M12` and, on request, `2026.03`.

All functions take and return Columns. A label that does not parse gives NULL
parts instead of an error; the data checks report such rows later.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

QUARTERLY_PATTERN = "____Q_"
MONTHLY_PATTERNS = ("____M__", "____M_")
DOTTED_PATTERN = "____.__"


class PeriodParts(NamedTuple):
    """Parsed pieces of one period label; `month` is NULL-free only for monthly labels."""

    year: Column
    month: Column
    quarter: Column
    start: Column


def _check_dialect(dialect: str) -> None:
    if dialect not in ("strict", "dotted"):
        raise ValueError(f"unknown period dialect: {dialect}")


def is_quarterly(period: Column, dialect: str = "strict") -> Column:
    """Shape test for quarterly labels. `dotted` also accepts `2026.03`."""
    _check_dialect(dialect)
    shape = period.like(QUARTERLY_PATTERN)
    return shape | period.like(DOTTED_PATTERN) if dialect == "dotted" else shape


def is_monthly(period: Column, dialect: str = "strict") -> Column:
    """Shape test for monthly labels with one or two month digits."""
    _check_dialect(dialect)
    padded, short = MONTHLY_PATTERNS
    shape = period.like(padded) | period.like(short)
    return shape | period.like(DOTTED_PATTERN) if dialect == "dotted" else shape


def year_of(period: Column) -> Column:
    return F.left(period, F.lit(4)).try_cast("int")


def _month_of(period: Column) -> Column:
    return F.substring(period, 6, 2).try_cast("int")


def quarter_of_month(month: Column) -> Column:
    """calendar quarter of a month number; month 13 gives 5 and is left to the checks."""
    return F.ceil(month / F.lit(3.0)).cast("int")


def quarter_start(year: Column, quarter: Column) -> Column:
    """first day of a quarter; NULL for a quarter outside 1 to 4."""
    first_month = (quarter - F.lit(1)) * F.lit(3) + F.lit(1)
    return F.when(quarter.between(1, 4), F.make_date(year, first_month, F.lit(1)))


def month_start(year: Column, month: Column) -> Column:
    """first day of a month; NULL for a month outside 1 to 12."""
    return F.when(month.between(1, 12), F.make_date(year, month, F.lit(1)))


def parse_quarterly(period: Column, dialect: str = "strict") -> PeriodParts:
    """Year, quarter and first day of a quarterly label.

    A dotted label names the last month of its quarter, so `2026.03` is quarter 1
    and starts on the first of January.
    """
    _check_dialect(dialect)
    year = year_of(period)
    quarter = F.right(period, F.lit(1)).try_cast("int")
    if dialect == "dotted":
        dotted_quarter = quarter_of_month(_month_of(period))
        quarter = F.when(period.like(DOTTED_PATTERN), dotted_quarter).otherwise(quarter)
    month = (quarter - F.lit(1)) * F.lit(3) + F.lit(1)
    return PeriodParts(year, month, quarter, quarter_start(year, quarter))


def parse_monthly(period: Column) -> PeriodParts:
    """Year, month, quarter and first day of a monthly label."""
    year = year_of(period)
    month = _month_of(period)
    digits = F.substring(period, 6, 2).rlike("^[0-9]{1,2}$")
    start = F.when(digits, month_start(year, month))
    return PeriodParts(year, month, quarter_of_month(month), start)


def period_to_date(period: Column, kind: str = "quarterly") -> Column:
    """first day of the period named by a label."""
    if kind == "quarterly":
        return parse_quarterly(period).start
    if kind == "monthly":
        return parse_monthly(period).start
    raise ValueError(f"unknown period kind: {kind}")


def sort_key(period: Column) -> Column:
    """Labels of all three forms in the order of time, as a struct to sort and to compare by.

    `2025M9` is before `2025M12`, and `2026.03` stands for its month. A label without such a
    day comes before all others, and such labels are in the order of their text.
    """
    dotted = period.like(DOTTED_PATTERN) & _month_of(period).isNotNull()
    start = (
        F.when(is_quarterly(period), period_to_date(period))
        .when(is_monthly(period), period_to_date(period, "monthly"))
        .when(dotted, month_start(year_of(period), _month_of(period)))
    )
    return F.struct(start.alias("start"), F.when(start.isNull(), period).alias("label"))


def quarter_label(year: Column, quarter: Column) -> Column:
    """`2025Q4`; NULL when a part is NULL."""
    return F.concat(year.cast("string"), F.lit("Q"), quarter.cast("string"))


def month_label(year: Column, month: Column) -> Column:
    """`2025M3`, without padding."""
    return F.concat(year.cast("string"), F.lit("M"), month.cast("string"))


def month_index(date: Column) -> Column:
    """Months since year 0, so that a year earlier is exactly 12 less."""
    return F.year(date) * F.lit(12) + F.month(date)


def year_before(date: Column) -> Column:
    """the same day twelve months earlier."""
    return F.add_months(date, -12)
