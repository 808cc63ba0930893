"""Staging models, marts, dashboards and measures on small raw tables."""

import datetime as dt

import pytest
from helpers import rows_of
from pyspark.sql import functions as F

from seriesmill.operators import joins, windows
from seriesmill.plans import dashboards, marts, measures, staging


def household_row(period="2025Q4", measure="Employment Rate", value=68.25, **more):
    row = {
        "series_reference": f"H.{measure}",
        "period": period,
        "data_value": value,
        "units": "Percent",
        "magnitude": 1,
        "series_title_1": measure,
        "series_title_2": "Total Both Sexes",
        "series_title_3": "Auckland Region",
        "series_title_4": "All ages",
        "series_title_5": "Unadjusted",
    }
    return {**row, **more}


def wage_row(period, value, sector="Private Sector", industry="Mining", title="Hourly Earnings"):
    return {
        "series_reference": f"W.{sector}.{industry}",
        "period": period,
        "data_value": value,
        "units": "Dollars",
        "magnitude": 1,
        "series_title_1": title,
        "series_title_2": sector,
        "series_title_3": industry,
    }


def test_household_staging_keeps_and_drops(raw):
    rows = [household_row(p) for p in ("2025Q4", "2025Q1", "2014Q4", "2025Q9", "abcdQ1", "2025M12", "2026.03")]
    staged = staging.stage_household(raw(rows))
    assert sorted(r[0] for r in rows_of(staged, "period")) == ["2025Q1", "2025Q4", "2025Q9"]
    dotted = staging.stage_household(raw(rows), dialect="dotted")
    assert ("2026.03", 1, dt.date(2026, 1, 1)) in rows_of(
        dotted, "period", "quarter_num", "period_start_date"
    )


def test_household_staging_suppression_and_scale(raw):
    rows = [
        household_row(value=None, suppressed="S"),
        household_row(value=None, suppressed=""),
        household_row(value=2.5, magnitude=1000, suppressed=""),
        household_row(value=2.5, magnitude=0),
    ]
    staged = staging.stage_household(raw(rows))
    assert sorted(rows_of(staged, "is_suppressed", "data_value_actual"), key=str) == [
        ("N", 2.5), ("N", 2500.0), ("S", None),
    ]


def test_group_filter_is_optional(raw):
    table = raw([household_row(group_name="A"), household_row(group_name="B")])
    assert staging.stage_household(table).count() == 2
    assert staging.stage_household(table, group_name="A").count() == 1


def test_wage_staging_drops_non_positive(raw):
    table = raw([wage_row("2025Q1", v) for v in (40.0, 0.0, -1.0, None)])
    assert rows_of(staging.stage_wages(table), "wage_nzd") == [(40.0,)]


def test_partition_column_prunes(raw, spark, tmp_path):
    path = str(tmp_path / "raw")
    table = raw([household_row("2014Q4"), household_row("2025Q4")])
    table.withColumn("period_year", F.left("period", F.lit(4)).cast("int")).write.partitionBy(
        "period_year"
    ).parquet(path)
    staged = staging.stage_household(spark.read.parquet(path))
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period_year" in plan
    assert staged.count() == 1


def test_monthly_staging(raw):
    rows = [
        household_row("2025M3", "Filled jobs", 2.0, magnitude=1000, series_title_4="Actual"),
        household_row("2025M13", "Paid hours", 1.0, series_title_4="Seasonally adjusted"),
        household_row("2025M04", "Gross earnings", None),
        household_row("2026.03", "Gross earnings", 3.0),
        household_row("2025Q1", "Gross earnings", 3.0),
    ]
    columns = ("period", "quarter_num", "period_start_date", "measure_clean", "data_value_actual", "is_seasonally_adjusted")
    staged = rows_of(staging.stage_monthly(raw(rows)), *columns)
    assert sorted(staged) == [
        ("2025M13", 5, None, "Paid hours", 1.0, True),
        ("2025M3", 1, dt.date(2025, 3, 1), "Filled Jobs", 2000.0, False),
    ]
    dotted = rows_of(staging.stage_monthly(raw(rows), dialect="dotted"), *columns)
    assert ("2026.03", 1, dt.date(2026, 3, 1), "Gross Earnings", 3.0, False) in dotted


def pivot_rows():
    return [
        household_row(),
        household_row(measure="Unemployment Rate", value=5.1),
        household_row(measure="Employed", value=900.04, units="Number", magnitude=1000),
        household_row(measure="Underemployed", value=95.0, units="Number", magnitude=1000),
        household_row(measure="Unemployed", value=50.0, units="Number", magnitude=1000),
        household_row(measure="Employment Rate", value=99.0, series_title_2=None),
    ]


def rates(raw, rows, **options):
    result = marts.regional_rates(staging.stage_household(raw(rows)), **options)
    return rows_of(
        result, "employment_rate_pct", "unemployment_rate_pct", "employed_count", "unemployed_count"
    )


def test_pattern_pivot(raw):
    assert rates(raw, pivot_rows()) == [(68.25, 5.1, pytest.approx(900040), 50000)]


def test_pattern_overlaps_are_kept_by_default(raw):
    assert rates(raw, pivot_rows()[1:])[0][0] == 5.1
    without_employed = [r for r in pivot_rows() if r["series_title_1"] != "Employed"]
    assert rates(raw, without_employed)[0][2] == 95000
    assert rates(raw, pivot_rows()[1:], strict_labels=True)[0][0] is None
    assert rates(raw, without_employed, strict_labels=True)[0][2] is None


def test_largest_age_group_wins_unless_chosen(raw):
    rows = [household_row(value=60.0), household_row(value=80.0, series_title_4="25-34 years")]
    assert rates(raw, rows)[0][0] == 80.0
    assert rates(raw, rows, age_group="All ages")[0][0] == 60.0


def regional_table(spark, rows):
    columns = (
        "period_start_date date, region string, unemployment_rate_pct double"
    )
    return spark.createDataFrame(rows, columns)


def test_benchmark_join(spark):
    day, other = dt.date(2025, 10, 1), dt.date(2025, 7, 1)
    rows = [(day, "A", 6.3), (day, "B", 2.8), (day, "New Zealand", 5.3), (other, "A", 6.0), (None, "A", 1.0)]

    def gaps(table):
        both = joins.with_benchmark(regional_table(spark, table), ["unemployment_rate_pct"])
        gap = F.round(F.col("unemployment_rate_pct") - F.col("nz_unemployment_rate_pct"), 1)
        return sorted(rows_of(both.select("region", gap.alias("gap"))), key=str)

    assert gaps(rows) == [("A", 1.0), ("A", None), ("A", None), ("B", -2.5)]
    doubled = gaps(rows + [(day, "Total New Zealand", 5.3), (None, "New Zealand", 9.0)])
    assert doubled == [("A", 1.0), ("A", 1.0), ("A", None), ("A", None), ("B", -2.5), ("B", -2.5)]


def growth_rows():
    return [
        ("2020Q1", 40.0), ("2020Q2", 40.5), ("2020Q3", 41.0), ("2020Q4", 41.5), ("2021Q1", 42.0),
        ("2021Q2", 42.5),
    ]


def test_growth_and_rolling_mean(raw):
    detail = marts.wage_growth_detail(
        staging.stage_wages(raw([wage_row(p, v) for p, v in growth_rows()]))
    ).orderBy("period_start_date")
    assert rows_of(
        detail, "year_quarter_label", "wage_1yr_ago", "yoy_wage_growth_pct", "rolling_4q_avg_wage"
    ) == [
        ("2020Q1", None, None, 40.0),
        ("2020Q2", None, None, 40.25),
        ("2020Q3", None, None, 40.5),
        ("2020Q4", None, None, 40.75),
        ("2021Q1", 40.0, 5.0, 41.25),
        ("2021Q2", 40.5, 4.94, 41.75),
    ]


def test_row_based_and_date_based_year_ago(raw):
    rows = [wage_row(p, v) for p, v in growth_rows() if p != "2020Q2"]
    means = marts.hourly_by_sector(staging.stage_wages(raw(rows)))
    key, wage = ["sector_clean"], "avg_hourly_wage_nzd"
    compared = means.select(
        "year_quarter_label",
        windows.rows_back(wage, 4, key).alias("rows"),
        windows.months_back(wage, 12, key).alias("months"),
    )
    found = {label: (r, m) for label, r, m in rows_of(compared)}
    assert found["2021Q1"] == (None, 40.0)
    assert found["2021Q2"] == (40.0, None)


def test_sector_pivot_and_mart(raw):
    rows = [wage_row("2020Q1", 40.0), wage_row("2020Q1", 44.0, "Public Sector"), wage_row("2020Q1", 42.0, "All Sectors")]
    mart = marts.wage_mart(marts.wage_trends(staging.stage_wages(raw(rows))))
    assert rows_of(
        mart, "public_premium_pct", "public_vs_private_gap_nzd", "estimated_annual_salary_nzd", "growth_category"
    ) == [(10.0, 4.0, 87360.0, "Unknown")]


def test_industry_ranks_and_bands(raw):
    wages = {"A": 50.0, "B": 45.0, "C": 45.0, "D": 30.0, "E": 28.0}
    ignored = {"": 1.0, "All Industries": 2.0, "Total": 3.0, " Total ": 4.0, None: 5.0}
    rows = [wage_row("2025Q1", v, industry=k) for k, v in {**wages, **ignored}.items()]
    mart = marts.industry_mart(staging.stage_wages(raw(rows))).orderBy("industry_anzsic")
    assert rows_of(
        mart, "industry_anzsic", "wage_rank_highest", "wage_rank_lowest", "wage_percentile_pct", "wage_band"
    ) == [
        ("A", 1, 5, 100.0, "High Wage (Top 25%)"),
        ("B", 2, 3, 50.0, "Middle Wage"),
        ("C", 2, 3, 50.0, "Middle Wage"),
        ("D", 4, 2, 25.0, "Middle Wage"),
        ("E", 5, 1, 0.0, "Low Wage (Bottom 25%)"),
    ]


def test_single_industry_is_in_the_lowest_band(raw):
    mart = marts.industry_mart(staging.stage_wages(raw([wage_row("2025Q1", 50.0)])))
    assert rows_of(mart, "wage_percentile_pct", "wage_band") == [(0.0, "Low Wage (Bottom 25%)")]


def test_unrounded_ranking_does_not_trim(raw):
    rows = [wage_row("2025Q1", 50.0, industry=" Total "), wage_row("2025Q1", 40.0)]
    ranked = marts.industry_wages_unrounded(staging.stage_wages(raw(rows)))
    assert sorted(r[0] for r in rows_of(ranked, "industry_anzsic")) == [" Total ", "Mining"]


def test_exact_and_plain_means_agree(raw):
    rows = [wage_row(p, v + d) for p, v in growth_rows() for d in (0.01, 0.02, 0.04)]
    staged = staging.stage_wages(raw(rows))
    exact = dict(rows_of(marts.hourly_by_sector(marts.wage_cells(staged)), "year_quarter_label", "avg_hourly_wage_nzd"))
    plain = dict(rows_of(marts.hourly_by_sector(staged), "year_quarter_label", "avg_hourly_wage_nzd"))
    assert exact == pytest.approx(plain)


def test_missing_combinations(spark):
    df = spark.createDataFrame(
        [(2025, 1, "A"), (2025, 1, "B"), (2025, 2, "A"), (2025, 3, "X"), (2025, 3, None)],
        "year_num int, quarter_num int, region string",
    )
    gaps = joins.missing_combinations(df, expected=["A", "B"])
    assert sorted(rows_of(gaps)) == [(2025, 2, "B"), (2025, 3, "A"), (2025, 3, "B")]


def story_rows():
    return [
        household_row("2026.03", "Unemployment Rate", 6.4, series_title_3="Auckland"),
        household_row("2025.12", "Unemployment Rate", 6.0, series_title_3="Auckland"),
        household_row("2026.03", "Unemployment Rate", 4.0, series_title_3="Otago"),
        household_row("2026.03", "Unemployment Rate", 9.0, series_title_3="Otago"),
        household_row("2026.03", "Unemployment Rate", 5.3, series_title_3="New Zealand"),
        household_row("2026.03", "Labour Force Participation Rate", 71.0, series_title_3="New Zealand"),
        household_row("2026.03", "Labour Force Participation Rate", 171.0, series_title_3="New Zealand"),
    ]


def test_dashboard_story(raw):
    table = raw(story_rows())
    regional = dashboards.regional_unemployment(table)
    story = dashboards.region_story(regional, dashboards.latest_national_rate(table)).orderBy("region")
    assert rows_of(
        story, "region", "latest_rate", "change_pp", "vs_national_pp", "direction", "side", "health", "change_text"
    ) == [
        ("Auckland", 6.4, 0.4, 1.1, "risen", "above", "struggling", "+0.4"),
        ("Otago", 4.0, 0.0, -1.3, "remained stable", "below", "performing well", "+0.0"),
    ]
    fixed = dashboards.region_story(regional, 5.3)
    assert sorted(rows_of(fixed)) == sorted(rows_of(story))


def test_dashboard_national_trend(raw):
    table = raw(story_rows())
    assert rows_of(dashboards.national_trend(table)) == [("2026.03", 5.3, 71.0)]
    only_participation = raw(story_rows()[5:6])
    assert rows_of(dashboards.national_trend(only_participation)) == [("2026.03", 71.0, 71.0)]
    assert rows_of(dashboards.national_trend(only_participation, by_measure=True)) == [
        ("2026.03", None, 71.0)
    ]


def test_dashboard_ranking_and_comparison(raw):
    table = raw(story_rows())
    ranking = dashboards.latest_ranking(table, "2026.03").orderBy("region")
    assert rows_of(ranking) == [("Auckland", 6.4, "max"), ("Otago", 4.0, "min")]
    compared = dashboards.region_comparison(dashboards.regional_unemployment(table), "Otago")
    assert sorted(rows_of(compared, "region", "is_selected")) == [("Auckland", False), ("Otago", True)]


def test_unemployment_change_measure(spark):
    rows = [(dt.date(2025, 1, 1), "A", 5.0), (dt.date(2026, 1, 1), "A", 6.5), (dt.date(2026, 1, 1), "B", 3.0)]
    mart = regional_table(spark, rows)
    overall = measures.unemployment_change(mart)
    assert rows_of(overall) == [(dt.date(2026, 1, 1), 4.75, 5.0, -0.25)]
    per_region = measures.unemployment_change(mart, ["region"]).orderBy("region")
    assert rows_of(per_region, "region", "yoy_change_pp") == [("A", 1.5), ("B", None)]


def test_latest_measure_follows_the_filter(spark):
    rows = [(dt.date(2025, 1, 1), "A", 5.0), (dt.date(2026, 1, 1), "B", None)]
    mart = regional_table(spark, rows).withColumn("employment_rate_pct", F.lit(60.0))
    assert rows_of(measures.latest_rates(mart), "latest_unemployment_rate") == [(None,)]
    sliced = mart.filter("region = 'A'")
    assert rows_of(measures.latest_rates(sliced), "latest_date", "latest_unemployment_rate") == [
        (dt.date(2025, 1, 1), 5.0)
    ]


def test_industry_mart_properties(spark):
    from seriesmill.catalogue import queries

    mart = queries.mart_industry(spark, "/root/testdata/sf0.001")
    per_quarter = mart.groupBy("period_start_date").agg(
        F.count("*").alias("n"),
        F.max("wage_rank_highest").alias("last"),
        F.min("wage_rank_highest").alias("first"),
        F.count_if(F.col("wage_band").isNotNull()).alias("banded"),
        F.min("wage_percentile_pct").alias("low"),
        F.max("wage_percentile_pct").alias("high"),
    )
    for row in per_quarter.collect():
        assert row.first == 1 and row.last <= row.n == row.banded
        assert row.low == 0.0 and row.high <= 100.0


def test_marts_scan_each_table_once(spark):
    from seriesmill.catalogue import queries

    plan = queries.mart_regional(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("Relation [o_orderkey") == 2  # household and monthly
