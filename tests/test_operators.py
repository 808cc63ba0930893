"""Ranking under skew, checks, policies and snapshots."""

import datetime as dt
import random

import pytest
from helpers import rows_of
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seriesmill.operators import aggregates, filters, joins, policies, quality, snapshots, windows
from seriesmill.plans import checks


def brute_ranks(rows):
    """Ranks by counting, for comparison."""
    result = []
    for row_id, key, value in rows:
        group = [v for _, k, v in rows if k == key and v is not None]
        if value is None:
            result.append((row_id, None, None, None))
            continue
        below = sum(v < value for v in group)
        above = sum(v > value for v in group)
        share = below / (len(group) - 1) if len(group) > 1 else 0.0
        result.append((row_id, above + 1, below + 1, share))
    return sorted(result)


def ranked(spark, rows, ranges):
    """Ranks by so many ranges of values."""
    df = spark.createDataFrame(rows, "id int, k string, v double")
    settings = {"spark.sql.shuffle.partitions": str(ranges), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        out = windows.rank_rows(df, "k", "v")
        return sorted(rows_of(out, "id", "rank_highest", "rank_lowest", "percentile"))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_rank_rows_with_a_hot_key(spark):
    random.seed(3)
    rows = [(i, "hot" if i % 3 else f"k{i % 7}", float(random.randint(-40, 40)) / 4) for i in range(600)]
    rows += [(600, "hot", None), (601, None, 1.0), (602, "alone", 2.0)]
    assert ranked(spark, rows, 16) == brute_ranks(rows)


def test_rank_rows_with_one_dense_place(spark):
    """Nearly all values within a hair of each other: cells follow the values."""
    rows = [(i, "hot", 1.0 + i * 1e-9) for i in range(900)] + [(900 + i, "hot", 1e6 * i) for i in range(20)]
    assert ranked(spark, rows, 32) == brute_ranks(rows)


def test_ranges_hold_about_equally_many_values(spark, tmp_path, monkeypatch):
    """One key with all rows, most of them within a hair of each other, is dealt out over all ranges."""
    monkeypatch.setattr(windows, "scratch_path", lambda session, name: str(tmp_path / "ranges"))
    rows = [(i, "hot", 1.0 + i * 1e-9) for i in range(4000)] + [(4000 + i, "hot", 1e6 * i) for i in range(20)]
    ranked(spark, rows, 16)
    sizes = [row["count"] for row in spark.read.parquet(str(tmp_path / "ranges")).groupBy("_part").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 3 * sum(sizes) / 16


def test_rank_rows_with_extreme_values(spark):
    inf = float("inf")
    values = [-inf, -1e300, -1.0, 0.0, 1e300, inf, float("nan")]
    found = ranked(spark, [(i, "k", v) for i, v in enumerate(values)], 4)
    assert [row[2] for row in found] == [1, 2, 3, 4, 5, 6, 7]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(-9, 9)), min_size=1, max_size=30))
def test_rank_rows_matches_counting(spark, pairs):
    rows = [(i, k, v / 2) for i, (k, v) in enumerate(pairs)]
    assert ranked(spark, rows, 5) == brute_ranks(rows)


def test_latest_and_previous(spark):
    df = spark.createDataFrame(
        [("a", "2025Q1", 1.0), ("a", "2025Q2", 3.0), ("b", "2025Q1", 7.0)], "k string, p string, v double"
    )
    assert sorted(rows_of(windows.latest_and_previous(df, "k", "p", "v"))) == [
        ("a", "2025Q2", 3.0, 1.0), ("b", "2025Q1", 7.0, 7.0),
    ]


def test_null_dates_sort_last(spark):
    df = spark.createDataFrame(
        [("a", None, 9.0), ("a", dt.date(2025, 1, 1), 1.0), ("a", dt.date(2025, 4, 1), 2.0)],
        "k string, period_start_date date, v double",
    )
    back = df.select("v", windows.rows_back("v", 1, ["k"]).alias("before"))
    assert sorted(rows_of(back)) == [(1.0, None), (2.0, 1.0), (9.0, 2.0)]


def test_year_ago_by_shift(spark):
    days = [dt.date(2024, 1, 1), dt.date(2024, 4, 1), dt.date(2025, 1, 1), None]
    df = spark.createDataFrame(
        [("a", d, float(i)) for i, d in enumerate(days)] + [("b", days[2], None)],
        "k string, period_start_date date, v double",
    )
    shifted = joins.year_ago_by_shift(df, ["k"], "v", "before")
    assert sorted(rows_of(shifted, "k", "v", "before"), key=str) == [
        ("a", 0.0, None), ("a", 1.0, None), ("a", 2.0, 0.0), ("a", 3.0, None), ("b", None, None),
    ]
    windowed = df.withColumn("before", windows.months_back("v", 12, ["k"]))
    assert sorted(rows_of(windowed, "k", "v", "before"), key=str) == sorted(
        rows_of(shifted, "k", "v", "before"), key=str
    )


def test_year_ago_of_leap_days(spark):
    values = {dt.date(1999, 2, 28): 1.0, dt.date(2000, 2, 28): 2.0, dt.date(2000, 2, 29): 9.0, dt.date(2001, 2, 28): 3.0}
    df = spark.createDataFrame([("k", d, v) for d, v in values.items()], "k string, period_start_date date, v double")
    found = rows_of(joins.year_ago_by_shift(df, ["k"], "v", "before"), "period_start_date", "v", "before")
    assert sorted(found) == [
        (dt.date(1999, 2, 28), 1.0, None), (dt.date(2000, 2, 28), 2.0, 1.0), (dt.date(2000, 2, 29), 9.0, 1.0),
        (dt.date(2001, 2, 28), 3.0, 2.0),
    ]


def test_latest_period_is_not_the_latest_text(spark):
    df = spark.createDataFrame([("2025M9",), ("2025M12",), ("2024Q4",), ("unknown",)], "period string")
    assert rows_of(joins.at_latest_period(df)) == [("2025M12",)]
    for labels, newest in (
        (["2026.03", "2025.12", "2026.1", None], "2026.03"),
        (["2025.09", "2025.12", "2025M11"], "2025.12"),
        (["b", "a", None], "b"),
        (["zzz", "1999Q1"], "1999Q1"),
    ):
        some = spark.createDataFrame([(p,) for p in labels], "period string")
        assert rows_of(joins.at_latest_period(some)) == [(newest,)]
        stored = some.withColumn("period_year", F.left("period", F.lit(4)).try_cast("int"))
        assert [r[0] for r in rows_of(joins.at_latest_period(stored))] == [newest]


def test_latest_row_follows_time_and_not_text(spark):
    rows = [("a", "2025M9", 1.0), ("a", "2025M12", 2.0), ("b", "2026.03", 3.0), ("b", "2025.12", 4.0), ("c", None, 5.0), ("c", "x", 6.0)]
    df = spark.createDataFrame(rows, "k string, p string, v double")
    assert sorted(rows_of(windows.latest_and_previous(df, "k", "p", "v"))) == [
        ("a", "2025M12", 2.0, 1.0), ("b", "2026.03", 3.0, 4.0), ("c", "x", 6.0, 5.0),
    ]


def test_pivot_keeps_maxima(spark):
    df = spark.createDataFrame([(1, "x", 2.0), (1, "x", 5.0), (1, "y", 3.0), (2, "y", 4.0)], "k int, l string, v double")
    wide = aggregates.pivot_by_value(df, ["k"], "l", {"x": ("x", "v"), "y": ("y", "v")})
    long = wide.unpivot(["k"], ["x", "y"], "l", "v").filter("v is not null")
    maxima = df.groupBy("k", "l").agg(F.max("v"))
    assert sorted(rows_of(long)) == sorted(rows_of(maxima))


def test_dimension_table_is_a_semi_join(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    members = spark.createDataFrame([("a",), ("a",)], "y string")
    assert rows_of(filters.in_dimension(df, "x", members)) == [("a",)]
    assert rows_of(filters.in_dimension(df, "x", ["b"])) == [("b",)]


def test_null_in_a_list_never_matches(spark):
    df = spark.createDataFrame([("Total",), (None,)], "sex string")
    assert df.filter(F.col("sex").isin("Total Both Sexes", "Total")).count() == 1


def test_slicer(spark):
    rows = [(dt.date(2025, 1, 1), "A"), (dt.date(2026, 1, 1), "A"), (dt.date(2026, 4, 1), "B")]
    df = spark.createDataFrame(rows, "period_start_date date, region string")
    assert df.filter(filters.slicer()).count() == 3
    assert df.filter(filters.slicer(["A"], "2026-01-01", "2026-01-01")).count() == 1
    assert df.filter(filters.slicer(year=2026)).count() == 2


# --- checks -----------------------------------------------------------------


def test_declared_checks_are_complete():
    declared = checks.table_checks()
    rules = checks.rule_checks()
    assert sum(map(len, declared.values())) == 55
    assert sum(map(len, rules.values())) == 2


def test_checks_let_null_pass_and_use_severity(spark):
    df = spark.createDataFrame([("2025Q1", 1, 5.0), ("2025Q9", 9, 50.0), (None, None, None)], "p string, q int, v double")
    verdicts = quality.run_checks(
        df,
        "t",
        [
            quality.matches_regex("p", checks.QUARTER_LABEL),
            quality.accepted_values("q", [1, 2, 3, 4]),
            quality.between("v", 5, 49, "warn"),
            quality.not_null("p"),
            quality.between("v", 5, 50),
        ],
    )
    assert [(r.failures, r.status) for r in verdicts.collect()] == [
        (1, "error"), (1, "error"), (1, "warn"), (1, "error"), (0, "pass"),
    ]


def test_checks_read_the_table_once(spark):
    df = spark.range(10)
    declared = [quality.not_null("id"), quality.between("id", 0, 5)]
    plan = quality.run_checks(df, "t", declared)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 1
    assert rows_of(quality.failing_values(df, declared[1]).orderBy("id"))[0] == (6, 1)


def test_rule_checks(spark):
    df = spark.createDataFrame(
        [(51.0, 60.0), (51.0, None), (40.0, 30.0)], "unemployment_rate_pct double, employment_rate_pct double"
    )
    assert quality.failing_rows(df, quality.implausible_unemployment()).count() == 1
    assert quality.failing_rows(df, quality.unemployment_above_employment()).count() == 1
    wages = spark.createDataFrame(
        [(1.0, 2.0, 3.0), (None, -1.0, 3.0), (None, None, None)],
        "private_hourly_wage_nzd double, public_hourly_wage_nzd double, all_sectors_hourly_wage_nzd double",
    )
    assert quality.failing_rows(wages, quality.wages_positive()).count() == 1


@pytest.mark.parametrize("days, status", [(99, "pass"), (100, "pass"), (101, "warn"), (201, "error")])
def test_freshness(spark, days, status):
    loaded = dt.datetime(2025, 1, 1, 12)
    df = spark.createDataFrame([(loaded,), (loaded - dt.timedelta(days=9),)], "_ingested_at timestamp_ntz")
    result = quality.freshness(df, "t", loaded + dt.timedelta(days=days))
    assert rows_of(result, "status") == [(status,)]


def test_freshness_of_nothing_is_an_error(spark):
    df = spark.createDataFrame([], "_ingested_at timestamp_ntz")
    assert rows_of(quality.freshness(df, "t"), "status") == [("error",)]


def test_future_periods(spark):
    df = spark.createDataFrame([(dt.date(2025, 1, 1),), (dt.date(2999, 1, 1),)], "d date")
    assert rows_of(quality.future_periods(df, "d")) == [(dt.date(2999, 1, 1), 1)]


# --- policies ---------------------------------------------------------------


def test_mask_never_leaks(spark):
    df = spark.createDataFrame([(42.5,), (None,)], "data_value double")
    for role in (policies.ENGINEER, policies.ANALYST):
        assert rows_of(policies.mask(df, "data_value", role)) == [(42.5,), (None,)]
    for role in (policies.REPORTER, "ADMIN_ROLE", ""):
        assert rows_of(policies.mask(df, "data_value", role)) == [(-1.0,), (-1.0,)]


def test_masked_wages_fail_the_wage_check(spark):
    df = spark.createDataFrame([(42.5,)], "data_value double")
    check = quality.wages_positive(["data_value"])
    assert quality.failing_rows(policies.mask(df, "data_value", policies.REPORTER), check).count() == 1


def test_rows_for_role(spark):
    df = spark.createDataFrame([("Auckland Region",), ("New Zealand",), ("Grand total",), (None,)], "series_title_3 string")
    assert policies.rows_for(df, policies.ANALYST).count() == 4
    assert policies.rows_for(df, policies.REPORTER).count() == 3
    assert policies.rows_for(df, "ADMIN_ROLE").count() == 0


def test_layers(spark):
    df = spark.range(1)
    assert policies.published(df, "mart", policies.REPORTER) is df
    with pytest.raises(PermissionError):
        policies.published(df, "staging", policies.REPORTER)
    with pytest.raises(PermissionError):
        policies.published(df, "mart", "ADMIN_ROLE")


# --- snapshots --------------------------------------------------------------

KEYED = "series_reference string, period string, data_value double"


def test_diff_labels(spark):
    q = "2025Q1"
    current = spark.createDataFrame([("S1", q, 10.0), ("S2", q, 5.0), ("S3", q, 7.0), ("S5", q, None)], KEYED)
    previous = spark.createDataFrame([("S1", q, 10.0), ("S2", q, 4.0), ("S4", q, 9.0), ("S5", q, None)], KEYED)
    found = snapshots.diff(current, previous).orderBy("series_reference")
    assert rows_of(found, "series_reference", "change_type", "value_change") == [
        ("S2", "VALUE CHANGED", 1.0), ("S3", "NEW ROW", None), ("S4", "ROW DELETED", None),
    ]


def test_diff_with_itself_is_empty(spark):
    df = spark.createDataFrame([(f"S{i}", "2025Q1", float(i)) for i in range(50)], KEYED)
    assert snapshots.diff(df, df).count() == 0


def test_null_keys_stay_unmatched(spark):
    df = spark.createDataFrame([(None, "2025Q1", float(i)) for i in range(20)], KEYED)
    both = joins.full_outer_on_keys(df, df, ["series_reference", "period"], "data_value")
    assert both.count() == 40
    assert both.filter("in_current and in_previous").count() == 0


def test_as_of(spark):
    days = [dt.datetime(2025, 1, d) for d in (1, 5, 9)]
    df = spark.createDataFrame([(d, i) for i, d in enumerate(days)], "snapshot_ts timestamp_ntz, v int")
    for at, want in ((dt.datetime(2025, 1, 5), [(1,)]), (dt.datetime(2025, 1, 8), [(1,)]), (dt.datetime(2024, 1, 1), [])):
        assert rows_of(snapshots.as_of(df, at), "v") == want
        assert rows_of(snapshots.as_of(df, at, days), "v") == want


def test_summary_keeps_equal_lines(spark):
    df = spark.createDataFrame([("2025Q1", dt.datetime(2025, 1, 1))], "period string, _ingested_at timestamp_ntz")
    lines = snapshots.summary({"now": df, "then": df, "never": df.filter("false")})
    assert sorted(rows_of(lines, "snapshot", "row_count")) == [("never", 0), ("now", 1), ("then", 1)]


def bucketed_versions(spark, tmp_path, versions):
    from seriesmill.sources.tables import TableStore

    store = TableStore(spark, str(tmp_path))
    shape = "series_reference string, period string, data_value double"
    frames = [spark.createDataFrame(rows, shape) for rows in versions]
    for name, df in zip(("current", "previous"), frames):
        store.write_bucketed(df, name, ["series_reference", "period"], 4)
    return frames, snapshots.diff_of_buckets(store.bucketed("current"), store.bucketed("previous"))


def test_diff_of_buckets_equals_the_diff(spark, tmp_path):
    random.seed(9)
    new = [(f"S{i}", "2025Q1", random.choice([1.0, 2.0, None])) for i in range(200)]
    old = [(f"S{i}", "2025Q1", random.choice([1.0, 2.0, None])) for i in range(100, 300)]
    new += [(None, "2025Q1", 1.0), ("S1", None, None), (None, None, 2.0)]
    old += [(None, "2025Q1", 1.0)] * 3
    (current, previous), found = bucketed_versions(spark, tmp_path, (new, old))
    expected = snapshots.diff(current, previous)
    order = lambda row: tuple((v is None, v) for v in row)
    assert sorted(rows_of(found), key=order) == sorted(rows_of(expected), key=order)
    assert {row[-1] for row in rows_of(found)} == {"NEW ROW", "ROW DELETED", "VALUE CHANGED"}


def test_diff_of_buckets_moves_no_row(spark, tmp_path):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        _, found = bucketed_versions(spark, tmp_path, ([("S1", "2025Q1", 1.0)], [("S1", "2025Q1", 2.0)]))
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "FullOuter" in plan and "Exchange" not in plan and "Bucketed: true" in plan
