"""The project's macros as SQL functions: F23 and F24 on values, D6 and D7 on a table.

After `register`, SQL calls them like built-in functions; Spark puts their bodies into the
plan, so they cost what the same expression would.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

_SCALAR = [
    """safe_divide(numerator DOUBLE, denominator DOUBLE, fallback DOUBLE DEFAULT 0) RETURNS DOUBLE
    RETURN CASE WHEN denominator IS NULL OR denominator = 0 THEN fallback ELSE numerator / denominator END""",
    """period_to_date(label STRING, kind STRING DEFAULT 'quarterly') RETURNS DATE
    RETURN CASE
      WHEN kind = 'quarterly' AND try_cast(right(label, 1) AS INT) BETWEEN 1 AND 4
        THEN make_date(try_cast(left(label, 4) AS INT), 3 * try_cast(right(label, 1) AS INT) - 2, 1)
      WHEN kind = 'monthly' AND substring(label, 6, 2) RLIKE '^[0-9]{1,2}$'
          AND try_cast(substring(label, 6, 2) AS INT) BETWEEN 1 AND 12
        THEN make_date(try_cast(left(label, 4) AS INT), try_cast(substring(label, 6, 2) AS INT), 1)
    END""",
]


def register(spark: SparkSession) -> None:
    """functions of values, for this session."""
    for function in _SCALAR:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {function}")


def register_checks(spark: SparkSession, table: str, rate: str, date: str = "period_start_date") -> None:
    """Table functions over a table or view that the session knows by name.

    `invalid_rates(low, high)` gives the values of the rate outside the range and
    `future_periods(as_of)` the dates after a day, each with the number of its rows.
    """
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION invalid_rates(low DOUBLE DEFAULT 0, high DOUBLE DEFAULT 100)
        RETURNS TABLE (rate DOUBLE, failing_rows BIGINT)
        RETURN SELECT `{rate}`, count(*) FROM {table} WHERE NOT `{rate}` BETWEEN low AND high GROUP BY `{rate}`"""
    )
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION future_periods(as_of DATE)
        RETURNS TABLE (day DATE, future_rows BIGINT)
        RETURN SELECT `{date}`, count(*) FROM {table} WHERE `{date}` > as_of GROUP BY `{date}`"""
    )
