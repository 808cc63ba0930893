"""Column functions on hand-worked rows."""

import datetime as dt
from fractions import Fraction
import math

import pytest
from helpers import rows_of
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seriesmill.functions import labels, numbers, periods, sql, text


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")


def evaluate(spark, values, function, kind="string"):
    df = column(spark, values, kind).select("i", function(F.col("x")).alias("y")).orderBy("i")
    return [row.y for row in df.collect()]


def test_quarterly_labels(spark):
    labels_in = ["2025Q4", "2025Q1", "2014Q4", "2025Q9", "abcdQ1", "2025M12", "2026.03", None]
    parts = periods.parse_quarterly(F.col("x"))
    df = column(spark, labels_in).select(
        periods.is_quarterly(F.col("x")).alias("ok"),
        parts.year.alias("y"),
        parts.quarter.alias("q"),
        parts.start.alias("d"),
    )
    assert rows_of(df)[:5] == [
        (True, 2025, 4, dt.date(2025, 10, 1)),
        (True, 2025, 1, dt.date(2025, 1, 1)),
        (True, 2014, 4, dt.date(2014, 10, 1)),
        (True, 2025, 9, None),
        (True, None, 1, None),
    ]
    assert [row[0] for row in rows_of(df)[5:]] == [False, False, None]


def test_dotted_labels(spark):
    parts = periods.parse_quarterly(F.col("x"), "dotted")
    df = column(spark, ["2026.03", "2025.12", "2025Q2", "2025.13"]).select(
        periods.is_quarterly(F.col("x"), "dotted"), parts.year, parts.quarter, parts.start
    )
    assert rows_of(df) == [
        (True, 2026, 1, dt.date(2026, 1, 1)),
        (True, 2025, 4, dt.date(2025, 10, 1)),
        (True, 2025, 2, dt.date(2025, 4, 1)),
        (True, 2025, 5, None),
    ]
    with pytest.raises(ValueError):
        periods.is_quarterly(F.col("x"), "roman")


def test_monthly_labels(spark):
    parts = periods.parse_monthly(F.col("x"))
    df = column(spark, ["2025M12", "2025M3", "2025M13", "2025MXX", "2025Q4"]).select(
        periods.is_monthly(F.col("x")), parts.month, parts.quarter, parts.start
    )
    assert rows_of(df)[:4] == [
        (True, 12, 4, dt.date(2025, 12, 1)),
        (True, 3, 1, dt.date(2025, 3, 1)),
        (True, 13, 5, None),
        (True, None, None, None),
    ]
    assert rows_of(df)[4][0] is False


def test_period_to_date_and_shift(spark):
    assert evaluate(spark, ["2025Q3", "2025Q0"], periods.period_to_date) == [dt.date(2025, 7, 1), None]
    assert evaluate(spark, ["2025M7"], lambda c: periods.period_to_date(c, "monthly")) == [
        dt.date(2025, 7, 1)
    ]
    shifted = evaluate(spark, ["2025Q3"], lambda c: periods.year_before(periods.period_to_date(c)))
    assert shifted == [dt.date(2024, 7, 1)]
    with pytest.raises(ValueError):
        periods.period_to_date(F.col("x"), "weekly")


def test_value_parse(spark):
    given_text = [" 12 ", "1,234", "..", "", "N/A", "nan", "12d", "3.7", "1000", "-1e3", "\t5", None]
    values = evaluate(spark, given_text, numbers.parse_value)
    assert values == [12.0, None, None, None, None, None, None, 3.7, 1000.0, -1000.0, 5.0, None]
    magnitudes = evaluate(spark, given_text, numbers.parse_magnitude)
    assert magnitudes == [12, 0, 0, 0, 0, 0, 0, 3, 1000, -1000, 5, 0]


def test_infinite_magnitude_is_zero(spark):
    assert evaluate(spark, ["inf", "1e300"], numbers.parse_magnitude) == [0, 0]
    assert evaluate(spark, ["-inf"], numbers.parse_value) == [-math.inf]


def test_strip_and_tokens(spark):
    values = ["\t a \t", " b ", "..", " .. ", "", "N/A", None, "a b"]
    assert evaluate(spark, values, lambda c: text.null_if_token(text.strip(c))) == [
        "a", "b", None, None, None, None, None, "a b",
    ]


def test_short_region(spark):
    values = ["Manawatū-Whanganui Region", "Auckland Region", "New Zealand", None]
    assert evaluate(spark, values, text.short_region) == [
        "Manawatu-Whanganui", "Auckland", "New Zealand", None,
    ]


def test_safe_divide(spark):
    df = spark.createDataFrame([(6.0, 3.0), (6.0, 0.0), (6.0, None), (None, 2.0)], "n double, d double")
    df = df.select(numbers.safe_divide(F.col("n"), F.col("d"), 7))
    assert [row[0] for row in df.collect()] == [2.0, 7.0, 7.0, None]


def test_growth_and_rounding(spark):
    df = spark.createDataFrame(
        [(42.0, 40.0), (42.5, 40.5), (1.0, 0.0), (1.0, None), (1.0, -2.0)], "a double, b double"
    )
    assert [r[0] for r in df.select(numbers.growth_pct(F.col("a"), F.col("b"))).collect()] == [
        5.0, 4.94, None, None, None,
    ]
    assert evaluate(spark, [900040.0, 900050.0], lambda c: numbers.round_to(c, 100), "double") == [
        900000.0, 900100.0,
    ]
    assert evaluate(spark, [68.25], lambda c: F.round(c, 1), "double") == [68.3]
    assert evaluate(spark, [42.0], numbers.annualise, "double") == [87360.0]
    assert evaluate(spark, [1.5e9], numbers.in_billions, "double") == [1.5]
    assert evaluate(spark, [0.42, -1.25], numbers.signed_text, "double") == ["+0.4", "-1.3"]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(-10**6, 10**6), min_size=1, max_size=40))
def test_exact_mean_ignores_order(spark, cents):
    values = [c / 100 for c in cents]
    one = column(spark, values, "double").agg(numbers.mean(F.col("x"))).first()[0]
    other = column(spark, values[::-1], "double").agg(numbers.mean(F.col("x"))).first()[0]
    plain = column(spark, values, "double").agg(F.avg("x")).first()[0]
    assert one == other == sum(cents) / 100 / len(cents)
    assert one == pytest.approx(plain)


def test_exact_sums(spark):
    """Digits beyond cents count, sums beyond 64 bits do not wrap, and the ANSI setting changes nothing."""
    cases = [([0.004, 0.004], 0.008), ([9e16, 9e16], 1.8e17), ([9e17] * 300, 2.7e20), ([1e-9, 1.0, -1.0], 1e-9),
             ([1e30, 1.0], 1e30), ([float("inf"), 1.0], float("inf")), ([1e-11, 1e-11], 2e-11), ([4e-11] * 10, 4e-10),
             ([2e18, 2e18, 2e18], 6e18), ([1e20, 1.0, -1e20], 1.0), ([0.1] * 10, 1.0), ([1e-30] * 3, 3e-30),
             ([1e28, 1e28, -2e28, 0.5], 0.5), ([0.01234567890123456, -0.01], 0.00234567890123456), ([1e300, 1e300], 2e300)]
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            for values, expected in cases:
                assert column(spark, values, "double").agg(numbers.total(F.col("x"))).first()[0] == expected
        finally:
            spark.conf.set("spark.sql.ansi.enabled", "true")


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(-1e24, 1e24, allow_subnormal=False) | st.floats(-1, 1, allow_subnormal=False), min_size=1, max_size=30))
def test_sums_are_those_of_the_printed_values(spark, values):
    """In any order and with stored parts in between, next to the sum of the decimals."""
    whole = float(sum(Fraction(repr(v)) for v in values))
    forth = column(spark, values, "double").repartition(3).agg(numbers.total(F.col("x"))).first()[0]
    back = column(spark, values[::-1], "double").withColumn("g", F.col("x") > 0).groupBy("g")
    back = back.agg(numbers.parts(F.col("x")).alias("p")).agg(numbers.from_parts(numbers.add_parts(F.col("p")))).first()[0]
    assert forth == back
    assert forth == pytest.approx(whole, rel=1e-15, abs=1e-34)


def test_mean_of_nothing_is_null(spark):
    df = column(spark, [None], "double")
    assert df.agg(numbers.mean(F.col("x"))).first()[0] is None
    assert df.agg(numbers.total(F.col("x"))).first()[0] is None


def test_adjustment_flags(spark):
    values = ["Not seasonally adjusted", "Unadjusted", None]
    assert evaluate(spark, values, labels.monthly_adjusted) == [True, False, False]
    by_measure = evaluate(
        spark, values, lambda c: labels.household_adjusted(F.lit(None).cast("string"), c)
    )
    assert by_measure == [True, False, False]


def test_small_ladders(spark):
    assert evaluate(spark, ["", "S", None], labels.suppression) == ["N", "S", "N"]
    assert evaluate(spark, ["Percent", "PERCENT", "Number", None], labels.rate_metric) == [
        True, True, False, False,
    ]
    assert evaluate(spark, ["All Sectors", "PRIVATE x", "public", None, "odd"], labels.sector) == [
        "All Sectors", "Private", "Public", "Other", "Other",
    ]
    assert evaluate(spark, ["Hourly", "weekly pay", None], labels.wage_frequency) == [
        "Hourly", "Weekly", "Other",
    ]
    assert evaluate(spark, ["filled jobs", "Gross Earnings", "Other", None], labels.monthly_measure) == [
        "Filled Jobs", "Gross Earnings", "Other", None,
    ]
    regions = ["Auckland Region", "Canterbury", "Waikato Region", "New Zealand", "Total New Zealand", None]
    assert evaluate(spark, regions, labels.region_tier) == [
        "North Island - Major", "South Island - Major", "North Island - Regional", "National",
        "Other", "Other",
    ]


def test_growth_ladders(spark):
    values = [5.0, 4.94, 0.0, -0.1, None]
    assert [v.split(" ")[0] for v in evaluate(spark, values, labels.growth_category, "double")] == [
        "Strong", "Moderate", "Slow", "Wage", "Unknown",
    ]
    assert evaluate(spark, values, labels.wage_growth_status, "double") == [
        "Strong (5%+)", "Moderate (2.5-5%)", "Slow (0-2.5%)", "Declining", None,
    ]
    assert evaluate(spark, values, labels.growth_light, "double") == [
        "Green", "Amber", "Amber", "Red", None,
    ]
    assert evaluate(spark, [1.01, 1.0, -1.0, -1.01, None], labels.gap_light, "double") == [
        "Red", "Yellow", "Yellow", "Green", None,
    ]


def test_bands_differ_on_rounding(spark):
    rounded = evaluate(spark, [0.746], lambda c: labels.wage_band(F.round(c * 100, 0)), "double")
    exact = evaluate(spark, [0.746], lambda c: labels.wage_band(c, full=1), "double")
    assert rounded == ["High Wage (Top 25%)"]
    assert exact == ["Middle Wage"]


def test_story_words(spark):
    assert evaluate(spark, [0.1, -0.1, 0.0], labels.direction, "double") == [
        "risen", "fallen", "remained stable",
    ]
    assert evaluate(spark, [0.1, 0.0], labels.side_of_national, "double") == ["above", "below"]
    assert evaluate(spark, [6.1, 4.4, 5.0], labels.labour_health, "double") == [
        "struggling", "performing well", "tracking close to the national average",
    ]


def test_sql_functions_equal_the_column_functions(spark):
    sql.register(spark)
    names = ["2025Q4", "2025Q5", "2025M9", "2025M12", "2025M13", "2025M", "x", None, "20Q1"]
    for kind in ("quarterly", "monthly"):
        expected = evaluate(spark, names, lambda c: periods.period_to_date(c, kind))
        assert evaluate(spark, names, lambda c: F.call_function("period_to_date", c, F.lit(kind))) == expected
    pairs = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (1.0, None), (None, 2.0)], "a double, b double")
    found = pairs.selectExpr("safe_divide(a, b)", "safe_divide(a, b, -1)")
    assert rows_of(found) == rows_of(pairs.select(
        numbers.safe_divide(F.col("a"), F.col("b")), numbers.safe_divide(F.col("a"), F.col("b"), -1)
    ))


def test_sql_table_functions(spark):
    rows = [(dt.date(2025, 1, 1), 50.0), (dt.date(2025, 4, 1), 101.0), (dt.date(2025, 4, 1), 101.0), (None, None), (dt.date(2026, 1, 1), -1.0)]
    spark.createDataFrame(rows, "period_start_date date, rate_pct double").createOrReplaceTempView("some_mart")
    sql.register_checks(spark, "some_mart", "rate_pct")
    assert sorted(rows_of(spark.sql("SELECT * FROM invalid_rates()"))) == [(-1.0, 1), (101.0, 2)]
    assert rows_of(spark.sql("SELECT * FROM invalid_rates(-5, 100)")) == [(101.0, 2)]
    assert rows_of(spark.sql("SELECT * FROM future_periods(DATE'2025-04-01')")) == [(dt.date(2026, 1, 1), 1)]
