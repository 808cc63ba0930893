"""Data checks: one pass per table for the verdicts, failing rows only on demand."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.operators import aggregates

SUMMARY = ["check_name", "table_name", "column_name", "severity", "failures", "status"]


@dataclass(frozen=True)
class Check:
    """One rule: `fails` is true for an offending row (NULL counts as passing)."""

    name: str
    column: str
    fails: Column
    severity: str = "error"


def not_null(column: str, severity: str = "error") -> Check:
    """D1."""
    return Check("not_null", column, F.col(column).isNull(), severity)


def accepted_values(column: str, values: Sequence, severity: str = "error") -> Check:
    """NULL passes."""
    return Check("accepted_values", column, ~F.col(column).isin(list(values)), severity)


def matches_regex(column: str, pattern: str, severity: str = "error") -> Check:
    """D3: NULL passes."""
    return Check("matches_regex", column, ~F.col(column).rlike(pattern), severity)


def between(column: str, low: float, high: float, severity: str = "error") -> Check:
    """Both ends belong to the range, NULL passes."""
    return Check("between", column, ~F.col(column).between(low, high), severity)


def implausible_unemployment(limit: float = 50) -> Check:
    """Both rates present and unemployment above the limit."""
    unemployment, employment = F.col("unemployment_rate_pct"), F.col("employment_rate_pct")
    fails = unemployment.isNotNull() & employment.isNotNull() & (unemployment > limit)
    return Check("implausible_unemployment", "unemployment_rate_pct", fails)


def unemployment_above_employment() -> Check:
    """What the name of D8 promises in the reference: the two rates compared."""
    fails = F.col("unemployment_rate_pct") > F.col("employment_rate_pct")
    return Check("unemployment_above_employment", "unemployment_rate_pct", fails)


WAGE_COLUMNS = ("private_hourly_wage_nzd", "public_hourly_wage_nzd", "all_sectors_hourly_wage_nzd")


def wages_positive(columns: Sequence[str] = WAGE_COLUMNS) -> Check:
    """Any wage at or below zero; a masked -1 fails too."""
    fails = F.lit(False)
    for column in columns:
        fails = fails | F.coalesce(F.col(column) <= 0, F.lit(False))
    return Check("wages_positive", ",".join(columns), fails)


def _status(failures: Column, severity: Column) -> Column:
    """The severity changes the verdict only."""
    return F.when(failures == 0, "pass").when(severity == "warn", "warn").otherwise("error")


def counters(checks: Sequence[Check]) -> list[Column]:
    """Failing rows of each check as one aggregate each, `n0`, `n1` and so on."""
    return [F.count_if(c.fails).alias(f"n{i}") for i, c in enumerate(checks)]


_COUNTED = "check_name string, table_name string, column_name string, severity string, failures bigint"


def verdicts(spark: SparkSession, table: str, checks: Sequence[Check], counted: dict) -> DataFrame:
    """One row per check from `counters` that a write has measured."""
    lines = [(c.name, table, c.column, c.severity, counted[f"n{i}"]) for i, c in enumerate(checks)]
    return _judged(spark.createDataFrame(lines, _COUNTED))


def _judged(lines: DataFrame) -> DataFrame:
    return lines.withColumn("status", _status(F.col("failures"), F.col("severity")))


def run_checks(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """All checks of a table as counters of one aggregate, one result row per check."""
    counted = df.agg(*counters(checks))
    lines = F.array(
        *(
            F.struct(
                F.lit(c.name).alias("check_name"),
                F.lit(table).alias("table_name"),
                F.lit(c.column).alias("column_name"),
                F.lit(c.severity).alias("severity"),
                F.col(f"n{i}").alias("failures"),
            )
            for i, c in enumerate(checks)
        )
    )
    return _judged(counted.select(F.inline(lines)))


def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    """The offending rows of one check."""
    return df.filter(check.fails)


def failing_values(df: DataFrame, check: Check) -> DataFrame:
    """The offending values of one check with their row count."""
    return aggregates.failing_counts(df, check.column, check.fails, "failing_rows")


def valid_rate(df: DataFrame, column: str, low: float = 0, high: float = 100) -> DataFrame:
    """Offending values of a rate column."""
    return failing_values(df, between(column, low, high))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that name more than one row, with their row count.

    Two national labels on one date double the benchmark join, and a snapshot diff
    expects one row per key; this finds the offending keys beforehand.
    """
    return df.groupBy(*keys).agg(F.count("*").alias("key_rows")).filter("key_rows > 1")


def future_periods(df: DataFrame, column: str, as_of: Column | None = None) -> DataFrame:
    """Dates after `as_of` (today by default) with their row count."""
    today = F.current_date() if as_of is None else as_of
    return aggregates.failing_counts(df, column, F.col(column) > today, "future_rows")


def freshness(
    df: DataFrame,
    table: str,
    as_of: dt.datetime | None = None,
    loaded_at: str = "_ingested_at",
    warn_days: int = 100,
    error_days: int = 200,
) -> DataFrame:
    """Age of the newest load in UTC; an empty table is an error."""
    now = as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    now_column = F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")
    newest = df.agg(F.max(F.col(loaded_at).cast("timestamp_ntz")).alias("last_ingested"))
    age = F.timestamp_diff("SECOND", F.col("last_ingested"), now_column)
    day = 86400
    status = (
        F.when(F.col("age_secs") <= warn_days * day, "pass")
        .when(F.col("age_secs") <= error_days * day, "warn")
        .otherwise("error")
    )
    return newest.withColumn("age_secs", age).select(
        F.lit(table).alias("table_name"), "last_ingested", "age_secs", status.alias("status")
    )
