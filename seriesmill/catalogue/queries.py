"""Every operator as a query over the supplied tables.

Each function takes a session and the folder of the tables and returns a
DataFrame; all of them read whole tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill import schema
from seriesmill.functions import labels, numbers, periods, sql, text
from seriesmill.operators import aggregates, filters, joins, policies, quality, snapshots, windows
from seriesmill.plans import build, checks, dashboards, ingest, marts, measures, staging
from seriesmill.session import scratch_path
from seriesmill.sources import archive_source as archive_source_format
from seriesmill.sources import archives, footers, normalise, testdata
from seriesmill.sources.tables import TableStore, materialise
from seriesmill.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]

START = 1996  # first year of the test data that the models keep
AS_OF = dt.datetime(2002, 1, 1)

_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query under its function name."""
    _QUERIES[function.__name__] = function
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- inputs -----------------------------------------------------------------


def _household(spark, folder):
    return staging.stage_household(testdata.household(spark, folder, START), START)


def _wages(spark, folder):
    return staging.stage_wages(testdata.wages(spark, folder, START), START)


def _monthly(spark, folder):
    return staging.stage_monthly(testdata.monthly(spark, folder, START), START)


def _regional(spark, folder):
    return marts.regional_employment(
        _household(spark, folder), _monthly(spark, folder)
    )


def _region_mart(spark, folder):
    return marts.regional_mart(_regional(spark, folder), F.lit(AS_OF))


def _wage_mart(spark, folder):
    trends = marts.wage_trends(_wages(spark, folder))
    return marts.wage_mart(trends, F.lit(AS_OF))


def _industry_mart(spark, folder):
    return marts.industry_mart(_wages(spark, folder), F.lit(AS_OF))


def _dashboard_household(spark, folder):
    """Raw household rows with the region spelling of the dashboard."""
    raw = testdata.household(spark, folder)
    return raw.withColumn("series_title_3", text.short_region(F.col("series_title_3")))


def _segment_quarters(spark, folder):
    """Order value per market segment and quarter."""
    orders = testdata.table(spark, folder, "orders")
    customers = testdata.table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    quarter = F.trunc("o_orderdate", "quarter")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("c_mktsegment", quarter.alias("period_start_date")).agg(
        numbers.total(F.col("o_totalprice")).alias("order_value")
    )


# --- models -----------------------------------------------------------------


@query
def stg_household(spark, folder):
    """M1."""
    return _household(spark, folder).drop("_ingested_at")


@query
def stg_wages(spark, folder):
    """M2."""
    return _wages(spark, folder).drop("_ingested_at")


@query
def stg_monthly(spark, folder):
    """M3."""
    return _monthly(spark, folder).drop("_ingested_at")


@query
def int_regional(spark, folder):
    """M4."""
    return _regional(spark, folder)


@query
def int_regional_strict(spark, folder):
    """M4 without the two label overlaps and for one age group."""
    return marts.regional_employment(
        _household(spark, folder),
        _monthly(spark, folder),
        age_group="All ages",
        strict_labels=True,
    )


@query
def int_wage_trends(spark, folder):
    """M5."""
    return marts.wage_trends(_wages(spark, folder))


@query
def wage_growth_detail(spark, folder):
    """W1, W3 and two-year growth per sector."""
    return marts.wage_growth_detail(_wages(spark, folder))


@query
def mart_regional(spark, folder):
    """M6."""
    return _region_mart(spark, folder).drop("mart_refreshed_at")


@query
def mart_wage(spark, folder):
    """M7."""
    return _wage_mart(spark, folder).drop("mart_refreshed_at")


@query
def mart_industry(spark, folder):
    """M8."""
    return _industry_mart(spark, folder).drop("mart_refreshed_at")


@query
def industry_wages_unrounded(spark, folder):
    """Second industry ranking."""
    return marts.industry_wages_unrounded(_wages(spark, folder))


# --- periods ----------------------------------------------------------------


def _labelled_orders(spark, folder):
    """Orders with a period label whose form depends on the priority."""
    orders = testdata.table(spark, folder, "orders")
    year, month, quarter = (f("o_orderdate") for f in (F.year, F.month, F.quarter))
    year_text = year.cast("string")
    label = labels.ladder(
        [
            (F.col("o_orderpriority") == "1-URGENT", periods.quarter_label(year, quarter)),
            (F.col("o_orderpriority") == "2-HIGH", F.concat(year_text, F.lit("Q9"))),
            (F.col("o_orderpriority") == "3-MEDIUM", periods.month_label(year, month)),
            (
                F.col("o_orderpriority") == "4-NOT SPECIFIED",
                F.concat(year_text, F.lit("."), F.lpad((quarter * 3).cast("string"), 2, "0")),
            ),
            (F.col("o_orderstatus") == "F", F.lit("abcdQ1")),
            (F.col("o_orderstatus") == "O", F.concat(year_text, F.lit("M13"))),
        ],
        F.concat(year_text, F.lit("MXX")),
    )
    return orders.select(label.alias("period"))


@query
def period_parse_quarterly(spark, folder):
    """P1, F1, F6, F11, F24."""
    rows = filters.quarterly_rows(_labelled_orders(spark, folder))
    counted = rows.groupBy("period").agg(F.count("*").alias("n"))
    parts = periods.parse_quarterly(F.col("period"))
    return counted.select(
        "period",
        parts.year.alias("year_num"),
        parts.quarter.alias("quarter_num"),
        periods.period_to_date(F.col("period")).alias("period_start_date"),
        "n",
    )


@query
def period_parse_monthly(spark, folder):
    """P2, F2, F3, F10, F15, F24."""
    rows = filters.monthly_rows(_labelled_orders(spark, folder))
    counted = rows.groupBy("period").agg(F.count("*").alias("n"))
    parts = periods.parse_monthly(F.col("period"))
    return counted.select(
        "period",
        parts.year.alias("year_num"),
        parts.month.alias("month_num"),
        parts.quarter.alias("quarter_num"),
        periods.period_to_date(F.col("period"), "monthly").alias("period_start_date"),
        "n",
    )


@query
def period_parse_dotted(spark, folder):
    """Quarterly labels in the dotted dialect."""
    rows = filters.quarterly_rows(_labelled_orders(spark, folder), "dotted")
    counted = rows.groupBy("period").agg(F.count("*").alias("n"))
    parts = periods.parse_quarterly(F.col("period"), "dotted")
    return counted.select(
        "period",
        parts.year.alias("year_num"),
        parts.quarter.alias("quarter_num"),
        parts.start.alias("period_start_date"),
        "n",
    )


@query
def period_arithmetic(spark, folder):
    """Labels, truncation and shifts of order dates."""
    orders = testdata.table(spark, folder, "orders")
    day = F.to_date("o_orderdate")
    return orders.groupBy(day.alias("day")).agg(F.count("*").alias("n")).select(
        "day",
        F.trunc("day", "year").alias("year_start"),
        periods.quarter_label(F.year("day"), F.quarter("day")).alias("quarter_label"),
        periods.year_before(F.trunc("day", "month")).alias("month_a_year_ago"),
        F.date_sub("day", 7).alias("week_before"),
        "n",
    )


# --- filters ----------------------------------------------------------------


@query
def suppressed_or_valued(spark, folder):
    """P4."""
    raw = testdata.household(spark, folder)
    return raw.filter(filters.valued_or_suppressed()).groupBy("series_title_1", "suppressed").agg(
        F.count("*").alias("n"), F.count("data_value").alias("n_valued")
    )


@query
def valued_rows(spark, folder):
    """P5 and P14."""
    raw = testdata.wages(spark, folder)
    return raw.groupBy("series_title_2").agg(
        F.count_if(filters.valued()).alias("n_valued"),
        F.count_if(filters.valued(positive=True)).alias("n_positive"),
    )


@query
def year_floor(spark, folder):
    """P3."""
    raw = testdata.wages(spark, folder)
    year = periods.year_of(F.col("period"))
    return raw.filter(filters.year_floor(year, 1998)).groupBy(year.alias("year_num")).agg(
        F.count("*").alias("n")
    )


@query
def label_contains(spark, folder):
    """P9, P10, P12."""
    raw = testdata.wages(spark, folder)
    kept = raw.filter(
        text.has(F.col("series_title_1"), "ordinary time", "HOURLY")
        & ~text.has(F.col("series_title_2"), "all")
        & text.same_label(F.col("units"), "DOLLARS")
    )
    return kept.groupBy("series_title_1", "series_title_2").agg(
        F.count("*").alias("n"), F.max("data_value").alias("highest")
    )


@query
def not_in_trimmed(spark, folder):
    """P8 with and without trim."""
    industry = F.col("series_title_3")
    counted = testdata.wages(spark, folder).groupBy(industry).agg(F.count("*").alias("n"))
    return counted.filter(text.none_of(industry, schema.TOTAL_INDUSTRIES)).withColumn(
        "passes_trimmed", text.none_of(industry, schema.TOTAL_INDUSTRIES, trimmed=True)
    )


@query
def value_between(spark, folder):
    """P11."""
    raw = testdata.wages(spark, folder)
    return raw.filter(F.col("data_value").between(20, 150)).groupBy("series_title_2").agg(
        F.count("*").alias("n"), F.min("data_value").alias("lowest")
    )


@query
def in_dimension(spark, folder):
    """P7 with a list and with a table of members."""
    orders = testdata.table(spark, folder, "orders")
    listed = filters.in_dimension(orders, "o_orderpriority", ["1-URGENT", "2-HIGH"])
    builders = testdata.table(spark, folder, "customer").filter("c_mktsegment = 'BUILDING'")
    kept = filters.in_dimension(listed, "o_custkey", builders.select("c_custkey"))
    return kept.groupBy("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n"))


# --- classifiers ------------------------------------------------------------


@query
def classify_sector(spark, folder):
    """C6, C7."""
    raw = testdata.wages(spark, folder)
    counted = raw.groupBy("series_title_1", "series_title_2").agg(F.count("*").alias("n"))
    return counted.select(
        "series_title_1",
        "series_title_2",
        labels.sector(F.col("series_title_2")).alias("sector_clean"),
        labels.wage_frequency(F.col("series_title_1")).alias("wage_frequency"),
        "n",
    )


@query
def classify_tier(spark, folder):
    """C9 over the region labels of all customers."""
    customers = testdata.table(spark, folder, "customer")
    counted = customers.groupBy("c_nationkey").agg(F.count("*").alias("n"))
    nations = testdata.table(spark, folder, "nation").select("n_nationkey", "n_name")
    named = counted.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    region = testdata.region_label(F.col("n_nationkey"), F.col("n_name"))
    return named.select(region.alias("region"), "n").withColumns(
        {
            "region_tier": labels.region_tier(F.col("region")),
            "short_region": text.short_region(F.col("region")),
        }
    )


@query
def classify_growth(spark, folder):
    """C11, C18, C19 on sector growth."""
    growth = F.col("yoy_wage_growth_pct")
    return wage_growth_detail(spark, folder).select(
        "sector_clean",
        "year_quarter_label",
        growth.alias("yoy_wage_growth_pct"),
        labels.growth_category(growth).alias("growth_category"),
        labels.wage_growth_status(growth).alias("growth_status"),
        labels.growth_light(growth).alias("growth_light"),
    )


@query
def classify_flags(spark, folder):
    """C1, C3, C5 and C10 on household rows, C2 and C8 on monthly rows."""
    household = testdata.household(spark, folder).select(
        F.lit("household").alias("survey"),
        F.col("series_title_1").alias("measure"),
        labels.household_adjusted(F.col("series_title_5"), F.col("series_title_1")).alias("adjusted"),
        labels.rate_metric(F.col("units")).alias("is_rate"),
        labels.suppression(F.col("suppressed")).alias("is_suppressed"),
        labels.missing_flag(F.col("data_value")).alias("is_missing"),
    )
    monthly = testdata.monthly(spark, folder).select(
        F.lit("monthly").alias("survey"),
        labels.monthly_measure(F.col("series_title_1")).alias("measure"),
        labels.monthly_adjusted(F.col("series_title_4")).alias("adjusted"),
        labels.rate_metric(F.col("units")).alias("is_rate"),
        labels.suppression(F.col("suppressed")).alias("is_suppressed"),
        labels.missing_flag(F.col("data_value")).alias("is_missing"),
    )
    both = household.unionByName(monthly)
    return both.groupBy(*both.columns).agg(F.count("*").alias("n"))


# --- numbers ----------------------------------------------------------------


@query
def scale_magnitude(spark, folder):
    """C4."""
    raw = testdata.household(spark, folder)
    actual = numbers.scale_by_magnitude(F.col("data_value"), F.col("magnitude"))
    return raw.select("series_reference", "period", "magnitude", actual.alias("actual"))


@query
def safe_divide(spark, folder):
    """F23 on every line item."""
    lines = testdata.table(spark, folder, "lineitem")
    ratio = numbers.safe_divide(F.col("l_extendedprice"), F.col("l_discount"))
    return lines.select("l_orderkey", "l_linenumber", ratio.alias("ratio"))


@query
def growth_pct(spark, folder):
    """F19 on order value per segment, against four quarters earlier."""
    rows = _segment_quarters(spark, folder).withColumn(
        "year_ago", windows.rows_back("order_value", 4, ["c_mktsegment"])
    )
    growth = numbers.growth_pct(F.col("order_value"), F.col("year_ago"))
    return rows.withColumn("growth", growth)


@query
def round_to_hundred(spark, folder):
    """F16 to F18, F21 on order value per customer."""
    orders = testdata.table(spark, folder, "orders")
    value = F.col("order_value")
    return orders.groupBy("o_custkey").agg(
        numbers.total(F.col("o_totalprice")).alias("order_value")
    ).select(
        "o_custkey",
        numbers.round_to(value, 100).alias("hundreds"),
        numbers.in_billions(value * F.lit(1000.0)).alias("billions"),
        numbers.annualise(value).alias("annual"),
    )


@query
def pp_gap(spark, folder):
    """gap and premium between two flags per quarter."""
    trends = int_wage_trends(spark, folder)
    private, public = F.col("private_hourly_wage"), F.col("public_hourly_wage")
    return trends.select(
        "year_quarter_label",
        numbers.point_gap(public, private).alias("gap"),
        numbers.growth_pct(public, private, 1).alias("premium"),
    )


# --- aggregates -------------------------------------------------------------


@query
def pivot_by_pattern(spark, folder):
    """A2."""
    return marts.regional_rates(_household(spark, folder))


@query
def pivot_by_value(spark, folder):
    """A3: highest order per customer, one column per status."""
    orders = testdata.table(spark, folder, "orders")
    return aggregates.pivot_by_value(
        orders,
        ["o_custkey"],
        "o_orderstatus",
        {f"highest_{s.lower()}": (s, "o_totalprice") for s in ("F", "O", "P")},
    )


@query
def cond_avg_sum(spark, folder):
    """A4."""
    return marts.quarterly_jobs(_monthly(spark, folder))


@query
def sector_mean(spark, folder):
    """A1, A5."""
    return marts.hourly_by_sector(_wages(spark, folder))


@query
def rounded_mean(spark, folder):
    """A6."""
    return aggregates.rounded_mean_by(
        _wages(spark, folder), ["industry_anzsic"], "wage_nzd", "avg_wage", 2
    )


@query
def global_summary(spark, folder):
    """A9."""
    raw = testdata.household(spark, folder)
    return aggregates.table_summary(raw).withColumn(
        "last_ingested", F.to_date("last_ingested")
    )


@query
def min_max_trend(spark, folder):
    """A7, A8 on all wage rows."""
    raw = testdata.wages(spark, folder)
    return aggregates.spread_by(
        raw, ["period", "series_title_2"], "data_value", "lowest", "highest"
    )


@query
def global_summary_stored(spark, folder):
    """A9 from the footers of stored files."""
    path = scratch_path(spark, "summary")
    footers.write(testdata.household(spark, folder), path)
    return footers.summary(footers.reader(spark), path).withColumn("last_ingested", F.to_date("last_ingested"))


@query
def distinct_regions(spark, folder):
    """A11."""
    return aggregates.distinct_sorted(
        testdata.household(spark, folder).filter(F.col("series_title_3").isNotNull()),
        "series_title_3",
    )


@query
def mean_at_latest(spark, folder):
    """Mean order value on the last order day of each customer segment."""
    orders = testdata.table(spark, folder, "orders")
    customers = testdata.table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    rows = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).withColumn(
        "day", F.to_date("o_orderdate")
    )
    return aggregates.mean_at_latest(
        rows, "o_totalprice", "mean_value", ["c_mktsegment"], "day"
    )


@query
def exact_sums(spark, folder):
    """A4 to A6 on values with more digits than money has, on tiny ones and on sums beyond 64 bits."""
    price = F.col("l_extendedprice")
    return testdata.table(spark, folder, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        numbers.total(price * F.lit(1e12)).alias("large_total"),
        numbers.mean(price * F.col("l_discount") / F.lit(1e6)).alias("small_mean"),
        numbers.total(price / F.lit(7.0)).alias("long_total"),
        numbers.total(F.col("l_quantity") * F.lit(1e-11)).alias("tiny_total"),
        numbers.total(F.col("l_quantity") * F.lit(2e18)).alias("vast_total"),
        numbers.total(F.when(F.col("l_linenumber") == 1, F.lit(1e-11)).otherwise(2e18)).alias("mixed_total"),
    )


# --- joins ------------------------------------------------------------------


@query
def left_join_quarter_region(spark, folder):
    """J1."""
    rates = marts.regional_rates(_household(spark, folder)).drop("employed_count", "unemployed_count")
    jobs = marts.quarterly_jobs(_monthly(spark, folder))
    return joins.left_on_quarter_region(rates, jobs)


@query
def benchmark_join(spark, folder):
    """J2 with two benchmark labels, so that rows double."""
    regional = _regional(spark, folder).select(
        "period_start_date", "region", "unemployment_rate_pct"
    )
    return joins.with_benchmark(
        regional, ["unemployment_rate_pct"], labels=["New Zealand", "Auckland Region"]
    )


def _order_versions(spark, folder):
    """Orders as three dated versions: late orders are missing from the older ones,
    urgent ones had another value and low ones were dropped from the newest."""
    orders = testdata.table(spark, folder, "orders")
    ordered, priority = F.col("o_orderdate"), F.col("o_orderpriority")

    def stamp(day):
        return F.lit(f"{day} 00:00:00").cast("timestamp_ntz")

    members = F.array(
        F.when(ordered < stamp("2001-01-01"), stamp("2001-12-25")),
        F.when(ordered < stamp("2001-07-01"), stamp("2001-12-31")),
        F.when((priority != "5-LOW") | (F.col("o_orderstatus") != "F"), stamp("2002-01-01")),
    )
    rows = orders.select(
        F.col("o_orderkey").cast("string").alias("series_reference"),
        periods.quarter_label(F.year(ordered), F.quarter(ordered)).alias("period"),
        "o_totalprice",
        priority.alias("priority"),
        F.explode(F.array_compact(members)).alias("snapshot_ts"),
    )
    older = F.col("snapshot_ts") < stamp("2002-01-01")
    value = F.when(older & (F.col("priority") == "1-URGENT"), F.col("o_totalprice") - 100.0)
    return rows.select(
        "series_reference",
        "period",
        F.when(
            F.col("priority") != "4-NOT SPECIFIED", F.coalesce(value, F.col("o_totalprice"))
        ).alias("data_value"),
        F.col("snapshot_ts").alias("_ingested_at"),
        "snapshot_ts",
    )


VERSIONS = [dt.datetime(2001, 12, 25), dt.datetime(2001, 12, 31), dt.datetime(2002, 1, 1)]


def _version(spark, folder, seconds):
    at = snapshots.offset_back(AS_OF, seconds)
    return snapshots.as_of(_order_versions(spark, folder), at, VERSIONS).drop("snapshot_ts")


@query
def full_outer_diff(spark, folder):
    """J3."""
    return joins.full_outer_on_keys(
        _version(spark, folder, 0),
        _version(spark, folder, 604800),
        ["series_reference", "period"],
        "data_value",
    )


@query
def year_ago_join(spark, folder):
    """J4 by window and by shifted rows side by side."""
    rows = _segment_quarters(spark, folder)
    shifted = joins.year_ago_by_shift(rows, ["c_mktsegment"], "order_value", "by_shift")
    return shifted.withColumn(
        "by_window", windows.months_back("order_value", 12, ["c_mktsegment"])
    )


@query
def year_ago_daily(spark, folder):
    """J4 on days, where the 28th and 29th of February meet."""
    orders = testdata.table(spark, folder, "orders")
    days = orders.groupBy("o_orderpriority", F.to_date("o_orderdate").alias("day")).agg(
        F.count("*").alias("orders")
    )
    return joins.year_ago_by_shift(days, ["o_orderpriority"], "orders", "year_ago", "day")


@query
def completeness_gaps(spark, folder):
    """Regions without an employment rate in a quarter."""
    present = int_regional(spark, folder).filter("missing_employment_rate = 0")
    return joins.missing_combinations(present)


@query
def latest_period_semi(spark, folder):
    """J6."""
    lines = testdata.wages(spark, folder)
    latest = joins.at_latest_period(lines)
    return latest.select("series_reference", "period", "data_value", "series_title_1", "series_title_2")


@query
def latest_period_monthly(spark, folder):
    """J6 on monthly labels, where month 12 follows month 9."""
    latest = joins.at_latest_period(testdata.monthly(spark, folder))
    return latest.select("series_reference", "period", "data_value")


@query
def date_star_join(spark, folder):
    """J7."""
    return joins.star_by_date(
        mart_regional(spark, folder).select("period_start_date", "region", "unemployment_rate_pct"),
        mart_wage(spark, folder),
        ["all_sectors_hourly_wage_nzd", "growth_category"],
    )


# --- windows ----------------------------------------------------------------


@query
def lag_growth(spark, folder):
    """One and two years back per segment."""
    key = ["c_mktsegment"]
    return _segment_quarters(spark, folder).withColumns(
        {
            "one_year_ago": windows.rows_back("order_value", 4, key),
            "two_years_ago": windows.rows_back("order_value", 8, key),
        }
    )


@query
def rolling_mean_4(spark, folder):
    """W3."""
    return _segment_quarters(spark, folder).withColumn(
        "rolling", F.round(windows.rolling_mean("order_value", 4, ["c_mktsegment"]), 4)
    )


@query
def rank_both(spark, folder):
    """W4, W5 on unreduced rows: parts ranked by price inside their brand."""
    parts = testdata.table(spark, folder, "part").select("p_partkey", "p_brand", "p_retailprice")
    return windows.rank_rows(parts, "p_brand", "p_retailprice")


@query
def percent_band(spark, folder):
    """Suppliers by balance inside their nation."""
    suppliers = testdata.table(spark, folder, "supplier").select(
        "s_suppkey", "s_nationkey", "s_acctbal"
    )
    ranked = windows.rank_rows(suppliers, "s_nationkey", "s_acctbal")
    percent = F.round(F.col("percentile") * 100, 0)
    return ranked.select(
        "s_suppkey",
        percent.alias("percentile_pct"),
        labels.wage_band(percent).alias("band_rounded"),
        labels.wage_band(F.col("percentile"), full=1).alias("band_exact"),
    )


@query
def latest_vs_previous(spark, folder):
    """W6 on order value per segment."""
    return windows.latest_and_previous(
        _segment_quarters(spark, folder), "c_mktsegment", "period_start_date", "order_value"
    )


@query
def extremes(spark, folder):
    """W7, C16 on order value per customer."""
    orders = testdata.table(spark, folder, "orders")
    totals = orders.groupBy("o_custkey").agg(
        numbers.total(F.col("o_totalprice")).alias("order_value")
    )
    return windows.mark_extremes(totals, "order_value")


# --- sort, limit, set operations ---------------------------------------------


@query
def topk_preview(spark, folder):
    """The five dearest orders."""
    orders = testdata.table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return aggregates.top_rows(orders, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()])


@query
def presentation_order(spark, folder):
    """O1: newest first, then by region."""
    return marts.newest_first(
        mart_regional(spark, folder).select("period_start_date", "region", "employment_rate_pct"),
        "region",
    )


# --- dashboards -------------------------------------------------------------


@query
def dash_regional(spark, folder):
    """B1."""
    return dashboards.regional_unemployment(_dashboard_household(spark, folder)).orderBy(
        F.col("period").desc(), F.col("unemployment_rate").desc()
    )


@query
def dash_national(spark, folder):
    """B2."""
    return dashboards.national_trend(_dashboard_household(spark, folder)).orderBy("period")


@query
def dash_national_by_measure(spark, folder):
    """B2 with the measures told apart by name."""
    return dashboards.national_trend(_dashboard_household(spark, folder), by_measure=True)


@query
def dash_wage(spark, folder):
    """Sector means."""
    rows = dashboards.wage_rows(testdata.dashboard_wages(spark, folder))
    return dashboards.sector_wages(rows)


@query
def dash_wage_rows(spark, folder):
    """The rows behind the means."""
    return dashboards.wage_rows(testdata.dashboard_wages(spark, folder))


@query
def dash_latest_rank(spark, folder):
    """B4."""
    ranking = dashboards.latest_ranking(_dashboard_household(spark, folder), "2001Q2")
    return ranking.orderBy(F.col("unemployment_rate").desc())


@query
def dash_story(spark, folder):
    """B5, C15, F26."""
    raw = _dashboard_household(spark, folder)
    regional = dashboards.regional_unemployment(raw)
    return dashboards.region_story(regional, dashboards.latest_national_rate(raw))


@query
def dash_compare(spark, folder):
    """B6."""
    regional = dashboards.regional_unemployment(_dashboard_household(spark, folder))
    return dashboards.region_comparison(regional, "Auckland").orderBy("unemployment_rate")


def _relabelled(spark, folder, label):
    """Dashboard rows whose quarters are written as `label(year, last month of the quarter)`."""
    raw = _dashboard_household(spark, folder)
    year, quarter = F.left("period", F.lit(4)), F.right("period", F.lit(1)).cast("int")
    return raw.withColumn("period", label(year, quarter * 3))


@query
def dash_compare_dotted(spark, folder):
    """B6, A12 and J6 on labels such as `2026.03`."""
    raw = _relabelled(spark, folder, lambda year, month: F.format_string("%s.%02d", year, month))
    return dashboards.region_comparison(dashboards.regional_unemployment(raw), "Auckland")


@query
def dash_story_monthly(spark, folder):
    """B5 and W6 on labels such as `2025M9`, which as text comes after `2025M12`."""
    raw = _relabelled(spark, folder, lambda year, month: F.format_string("%sM%d", year, month))
    regional = dashboards.regional_unemployment(raw)
    return dashboards.region_story(regional, dashboards.latest_national_rate(raw))


@query
def dash_multi(spark, folder):
    """B7."""
    regional = dashboards.regional_unemployment(_dashboard_household(spark, folder))
    chosen = ["Auckland", "Wellington", "Canterbury", "Otago"]
    return dashboards.regions_over_time(regional, chosen).orderBy("region", "period")


@query
def dash_headline(spark, folder):
    """The four figures of the first page."""
    return measures.headline(_regional(spark, folder), int_wage_trends(spark, folder))


@query
def report_table(spark, folder):
    """A report, stored and read back."""
    store = TableStore(spark, scratch_path(spark, "reports"))
    report = dashboards.regional_unemployment(_dashboard_household(spark, folder))
    return dashboards.stored_report(report, store, "report_regional").drop("period_year")


# --- measures ---------------------------------------------------------------


@query
def kpi_latest(spark, folder):
    """Overall rates at the newest date."""
    return measures.latest_rates(_region_mart(spark, folder))


@query
def kpi_salary(spark, folder):
    """Salary at the newest date."""
    return measures.latest_salary(_wage_mart(spark, folder))


@query
def kpi_yoy(spark, folder):
    """B9 per region tier."""
    return measures.unemployment_change(
        _region_mart(spark, folder), ["region_tier"]
    ).withColumn("yoy_change_pp", F.round("yoy_change_pp", 6))


@query
def kpi_yoy_series(spark, folder):
    """J4, B9 per region and date."""
    return measures.unemployment_change_series(_region_mart(spark, folder)).withColumn(
        "yoy_change_pp", F.round("yoy_change_pp", 3)
    )


@query
def kpi_average(spark, folder):
    """A14, B10 per region."""
    return measures.average_gap(_region_mart(spark, folder), ["region"])


@query
def kpi_wage_average(spark, folder):
    """A14, B10 for wages."""
    return measures.wage_averages(_wage_mart(spark, folder))


@query
def kpi_status(spark, folder):
    """B11 per year."""
    mart = _wage_mart(spark, folder).withColumn("year", F.year("period_start_date"))
    return measures.wage_status(mart, ["year"])


@query
def kpi_status_card(spark, folder):
    """B11 per year with the text of the card."""
    mart = _wage_mart(spark, folder).withColumn("year", F.year("period_start_date"))
    return measures.wage_status(mart, ["year"], card_labels=True).select("year", "growth_status")


@query
def kpi_gap_lights(spark, folder):
    """B11, C17."""
    return measures.gap_lights(_region_mart(spark, folder))


@query
def kpi_by_year(spark, folder):
    """Sliced by region, date range and year."""
    regions = ["Auckland Region", "Otago Region"]
    chosen = filters.slicer(regions, "1999-01-01", "2000-12-31") | filters.slicer(year=1998)
    mart = _region_mart(spark, folder).filter(chosen)
    return measures.average_gap(mart, ["year_num"])


# --- data checks ------------------------------------------------------------


def _check_tables(spark, folder, names):
    builders = {
        "raw_household": lambda: testdata.household(spark, folder),
        "raw_wages": lambda: testdata.wages(spark, folder),
        "raw_monthly": lambda: testdata.monthly(spark, folder),
        "stg_household": lambda: _household(spark, folder),
        "stg_wages": lambda: _wages(spark, folder),
        "stg_monthly": lambda: _monthly(spark, folder),
        "int_regional": lambda: _regional(spark, folder),
        "int_wage_trends": lambda: int_wage_trends(spark, folder),
        "mart_regional": lambda: _region_mart(spark, folder),
        "mart_wage": lambda: _wage_mart(spark, folder),
        "mart_industry": lambda: _industry_mart(spark, folder),
    }
    declared = checks.table_checks(first_year=START, last_year=2000)
    return checks.check_tables({name: builders[name]() for name in names}, declared)


@query
def dq_sources(spark, folder):
    """D1 on the raw tables."""
    return _check_tables(spark, folder, ["raw_household", "raw_wages", "raw_monthly"])


@query
def dq_staging(spark, folder):
    """D1 to D5 on the staging models."""
    return _check_tables(spark, folder, ["stg_household", "stg_wages", "stg_monthly"])


@query
def dq_intermediate(spark, folder):
    """D1 to D5 on the intermediate models."""
    return _check_tables(spark, folder, ["int_regional", "int_wage_trends"])


@query
def dq_marts(spark, folder):
    """D1 to D5 on the marts."""
    return _check_tables(spark, folder, ["mart_regional", "mart_wage", "mart_industry"])


@query
def dq_failing_rows(spark, folder):
    """D3: the rows behind a failed regular expression."""
    check = quality.matches_regex("period", checks.QUARTER_LABEL)
    failing = quality.failing_rows(_household(spark, folder), check)
    return failing.select("series_reference", "period", "region", "data_value")


@query
def dq_valid_rate(spark, folder):
    """Prices outside a range with their count."""
    lines = testdata.table(spark, folder, "lineitem")
    return quality.valid_rate(lines, "l_extendedprice", 1000, 100000)


@query
def dq_future_periods(spark, folder):
    """Ship dates after the first of July 2001."""
    lines = testdata.table(spark, folder, "lineitem").withColumn(
        "ship_day", F.to_date("l_shipdate")
    )
    return quality.future_periods(lines, "ship_day", F.lit(dt.date(2001, 7, 1)))


@query
def dq_duplicates(spark, folder):
    """Series and periods that the wage table holds more than once."""
    raw = testdata.wages(spark, folder)
    return quality.duplicate_keys(raw, ["series_reference", "period"])


@query
def dq_singular(spark, folder):
    """D8, D9 and the literal comparison."""
    unemployment = [
        quality.implausible_unemployment(limit=4),
        quality.unemployment_above_employment(),
    ]
    regional = quality.run_checks(_regional(spark, folder), "int_regional", unemployment)
    wages = quality.run_checks(_wage_mart(spark, folder), "mart_wage", [quality.wages_positive()])
    return regional.unionByName(wages)


@query
def dq_freshness(spark, folder):
    """D10 for three tables at a fixed moment."""
    results = [
        quality.freshness(testdata.wages(spark, folder), "raw_wages", AS_OF),
        quality.freshness(testdata.household(spark, folder), "raw_household", AS_OF),
        quality.freshness(
            testdata.table(spark, folder, "events"), "events", dt.datetime(2024, 9, 1), "ts"
        ),
    ]
    united = results[0].unionByName(results[1]).unionByName(results[2])
    return united.select("table_name", F.to_date("last_ingested").alias("last_day"), "status")


@query
def dq_freshness_stored(spark, folder):
    """D10 from the footers of stored files."""
    session, results = footers.reader(spark), []
    for name, rows in (("raw_wages", testdata.wages(spark, folder)), ("raw_household", testdata.household(spark, folder))):
        path = scratch_path(spark, name)
        footers.write(rows, path)
        results.append(quality.freshness(footers.newest_load(session, path), name, AS_OF))
    return results[0].unionByName(results[1]).select("table_name", F.to_date("last_ingested").alias("last_day"), "status")


@query
def sql_macros(spark, folder):
    """F23, F24, D6 and D7 called in SQL, on values and as tables."""
    sql.register(spark)
    mart_regional(spark, folder).createOrReplaceTempView("mart_regional_sql")
    sql.register_checks(spark, "mart_regional_sql", "employment_rate_pct")
    return spark.sql(
        """SELECT m.year_quarter_label, m.region, period_to_date(m.year_quarter_label) AS starts,
          period_to_date(concat(m.year_num, 'M', 3 * m.quarter_num), 'monthly') AS last_month,
          safe_divide(m.unemployment_rate_pct, m.employment_rate_pct, -1) AS share, i.failing_rows, f.future_rows
        FROM mart_regional_sql m LEFT JOIN invalid_rates(2, 4) i ON i.rate = m.employment_rate_pct
          LEFT JOIN future_periods(DATE '1998-01-01') f ON f.day = m.period_start_date"""
    )


@query
def dq_labels(spark, folder):
    """D1, D2, D4 on document labels and texts in one pass per table."""
    quality_labels = testdata.table(spark, folder, "labels")
    documents = testdata.table(spark, folder, "documents")
    verdicts = quality.run_checks(
        quality_labels,
        "labels",
        [quality.not_null("doc_id"), quality.accepted_values("quality", [1], "warn")],
    )
    return verdicts.unionByName(
        quality.run_checks(
            documents,
            "documents",
            [
                quality.not_null("text"),
                quality.accepted_values("lang", ["en", "de"]),
                quality.between("n_chars", 100, 10000, "warn"),
            ],
        )
    )


@query
def build_and_check(spark, folder):
    """All models from stored raw tables, then all checks and rules."""
    store = TableStore(spark, scratch_path(spark, "build"))
    inputs = {
        "raw_household": testdata.household(spark, folder),
        "raw_wages": testdata.wages(spark, folder),
        "raw_monthly": testdata.monthly(spark, folder),
    }
    declared = checks.all_checks(START, 2000)
    raw = [store.write_checked(rows, name, declared[name], AS_OF)[1] for name, rows in inputs.items()]
    _, models = build.build_and_check(store, START, AS_OF, None, START, 2000)
    for verdicts in raw:
        models = models.unionByName(verdicts)
    return models


@query
def rebuilt_year(spark, folder):
    """A second build of one year from grown raw data leaves the other years as they were."""
    store = TableStore(spark, scratch_path(spark, "rebuild"))
    wages = testdata.wages(spark, folder)
    rows = {"raw_household": testdata.household(spark, folder), "raw_monthly": testdata.monthly(spark, folder)}
    for name, raw in {**rows, "raw_wages": wages.filter("series_reference like '%.1'")}.items():
        store.write(raw, name, VERSIONS[0])
    build.build_models(store, START, VERSIONS[0])
    store.write(wages, "raw_wages", AS_OF)
    build.build_models(store, START, AS_OF, [1997])
    cells = spark.table(store.full_name("int_wage_cells"))
    return cells.groupBy("period_year").agg(F.sum("wage_count").alias("wages"))


# --- policies ---------------------------------------------------------------

ROLES = [policies.ENGINEER, policies.ANALYST, policies.REPORTER, "ADMIN_ROLE"]


@query
def mask_values(spark, folder):
    """R1 for every role: what remains readable."""
    raw = testdata.wages(spark, folder)
    per_role = [
        F.struct(
            F.lit(role).alias("role"),
            policies.masked(F.col("data_value"), role).alias("value"),
        )
        for role in ROLES
    ]
    seen = raw.select("series_title_2", F.inline(F.array(*per_role)))
    return seen.groupBy("role", "series_title_2").agg(
        F.count("value").alias("n_values"),
        F.count_if(F.col("value") == policies.MASKED_VALUE).alias("n_masked"),
        F.max("value").alias("highest"),
    )


@query
def rows_for_role(spark, folder):
    """R2: rows per region that each role sees."""
    region = F.col("series_title_3")
    counted = testdata.household(spark, folder).groupBy(region).agg(F.count("*").alias("n"))
    per_role = [
        F.struct(F.lit(role).alias("role"), policies.may_see(region, role).alias("visible"))
        for role in ROLES
    ]
    return counted.select(region, "n", F.inline(F.array(*per_role))).filter("visible").drop("visible")


@query
def read_as_role(spark, folder):
    """R1 to R3 as the store applies them: what each role reads of three stored tables."""
    store = TableStore(spark, scratch_path(spark, "policies"))
    store.write(testdata.wages(spark, folder), "raw_wages", AS_OF)
    store.write(testdata.household(spark, folder), "raw_household", AS_OF)
    store.write(_wage_mart(spark, folder), "mart_wage", AS_OF)
    lines = []
    for name, value in (("raw_wages", "data_value"), ("raw_household", "data_value"), ("mart_wage", "all_sectors_hourly_wage_nzd")):
        for role in ROLES:
            try:
                rows = store.read(name, role=role)
            except PermissionError:
                continue
            lines.append(
                rows.agg(F.count("*").alias("n"), F.max(value).alias("highest")).select(
                    F.lit(name).alias("table_name"), F.lit(role).alias("role"), "n", "highest"
                )
            )
    return normalise.union_files(lines)


@query
def expired_versions(spark, folder):
    """Versions beyond the retention window are gone, the newest always stays."""
    store = TableStore(spark, scratch_path(spark, "retention"))
    versions = _order_versions(spark, folder)
    for at in VERSIONS:
        wave = versions.filter(F.col("snapshot_ts") == F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz"))
        store.write(wave.drop("snapshot_ts", "_ingested_at"), "orders", at)
    store.expire("orders", days=3, now=AS_OF)
    left = [
        store.read("orders", at).agg(F.count("*").alias("n")).select(F.lit(at.date()).alias("version"), "n")
        for at in VERSIONS
        if store.has("orders", at)
    ]
    return normalise.union_files(left)


@query
def layers_for_role(spark, folder):
    """Rows of each layer that a role may read."""
    layers = {
        "raw": testdata.wages(spark, folder),
        "staging": _wages(spark, folder),
        "mart": _wage_mart(spark, folder),
    }

    def readers(layer):
        return F.array(*(F.lit(r) for r in ROLES if layer in policies.layers_for(r)))

    lines = [
        policies.published(df, layer, policies.ENGINEER)
        .agg(F.count("*").alias("n"))
        .select(F.explode(readers(layer)).alias("role"), F.lit(layer).alias("layer"), "n")
        for layer, df in layers.items()
    ]
    return normalise.union_files(lines)


# --- snapshots --------------------------------------------------------------


@query
def as_of_read(spark, folder):
    """The version of seven days ago, found by a subquery."""
    at = snapshots.offset_back(AS_OF, 604800)
    return snapshots.as_of(_order_versions(spark, folder), at).select(
        "series_reference", "period", "data_value"
    )


@query
def snapshot_summary(spark, folder):
    """Now, one hour ago, twenty-four hours ago."""
    lines = snapshots.summary(
        {
            "Current": _version(spark, folder, 0),
            "1 hour ago": _version(spark, folder, 3600),
            "24 hours ago": _version(spark, folder, 86400),
        }
    )
    return lines.withColumn("last_ingested", F.to_date("last_ingested"))


@query
def snapshot_diff(spark, folder):
    """T3, C14."""
    return snapshots.diff(_version(spark, folder, 0), _version(spark, folder, 604800))


@query
def snapshot_summary_stored(spark, folder):
    """T2, U1 from the footers of the stored versions."""
    session, lines = footers.reader(spark), []
    for name, seconds in (("Current", 0), ("1 hour ago", 3600), ("24 hours ago", 86400)):
        path = scratch_path(spark, "version")
        footers.write(_version(spark, folder, seconds), path)
        lines.append(footers.summary(session, path).select(F.lit(name).alias("snapshot"), "*"))
    united = lines[0].unionByName(lines[1]).unionByName(lines[2])
    return united.withColumn("last_ingested", F.to_date("last_ingested"))


@query
def snapshot_diff_bucketed(spark, folder):
    """T3, J3, C14 on two versions that are stored in buckets of the keys."""
    store = TableStore(spark, scratch_path(spark, "buckets"))
    keys = ["series_reference", "period"]
    for name, seconds in (("current", 0), ("previous", 604800)):
        store.write_bucketed(_version(spark, folder, seconds), name, keys, 16)
    return snapshots.diff_of_buckets(store.bucketed("current"), store.bucketed("previous"), keys)


# --- ingest -----------------------------------------------------------------


def _text_rows(spark, folder):
    """Household rows written as a file would hold them, with faulty tokens."""
    raw = testdata.household(spark, folder)
    priority = F.substring("series_reference", -3, 1)
    value = F.col("data_value")
    value_text = labels.ladder(
        [
            (value.isNull(), ".."),
            (priority == "1", F.concat(F.lit(" "), value.cast("string"), F.lit("\t"))),
            (priority == "3", F.concat(F.round(value).cast("int").cast("string"), F.lit(",5"))),
            (priority == "5", F.concat(F.round(value).cast("int").cast("string"), F.lit("d"))),
        ],
        value.cast("string"),
    )
    magnitude_text = labels.ladder(
        [(priority == "1", "3.7"), (priority == "2", "unknown")], F.col("magnitude").cast("string")
    )
    return raw.select(
        *(F.col(c).cast("string").alias(c) for c in schema.SERIES_COLUMNS)
    ).withColumns(
        {
            "data_value": value_text,
            "magnitude": magnitude_text,
            "status": F.lit("\t F "),
            "units": F.when(priority == "4", F.lit("N/A")).otherwise(F.col("units")),
        }
    )


@query
def normalise_raw(spark, folder):
    """S6 to S12 on text rows with published header spellings."""
    published = _text_rows(spark, folder).withColumnsRenamed(
        {
            "series_reference": "Series Reference",
            "period": "Period",
            "data_value": "Data_value",
            "status": "STATUS",
            "group_name": "Group",
        }
    ).drop("subject").select("*", F.lit("ignored").alias("Status"))
    return normalise.typed_rows(normalise.canonical_columns(published))


def _written_archives(spark, folder):
    """The text rows as ZIP archives in the shared folder, a few files per period year."""
    target = scratch_path(spark, "archives")
    rows = _text_rows(spark, folder).withColumnRenamed("period", "Period")
    archives.write_archives(rows, target).write.format("noop").mode("overwrite").save()
    return target


@query
def ingest_archives(spark, folder):
    """S1 to S12 through real archives."""
    rows = normalise.typed_rows(archives.read_archives(spark, _written_archives(spark, folder)))
    return rows.drop("_source_file")


@query
def archive_members(spark, folder):
    """Status and rows of members of every kind."""
    manifest = archives.member_manifest(spark, _mixed_archives(spark, folder))
    return manifest.groupBy("member", "status").agg(F.sum("rows").alias("n_rows"))


def _mixed_archives(spark, folder):
    target = scratch_path(spark, "mixed")
    rows = _text_rows(spark, folder).withColumnRenamed("period", "Period")
    testdata.write_mixed_archives(rows, target).write.format("noop").mode("overwrite").save()
    return target


@query
def archive_source(spark, folder):
    """S1 to S12 through the data source; the condition leaves the faulty members closed."""
    archive_source_format.register(spark)
    rows = spark.read.format(archive_source_format.FORMAT).load(_mixed_archives(spark, folder))
    return normalise.typed_rows(rows.filter("_source_file like 'part%'")).drop("_source_file")


@query
def archive_source_report(spark, folder):
    """What the data source says of members of every kind."""
    archive_source_format.register(spark)
    reader = spark.read.format(archive_source_format.FORMAT).option("report", "true")
    lines = reader.load(_mixed_archives(spark, folder))
    return lines.groupBy("member", "status").agg(F.sum("rows").alias("n_rows"))


@query
def load_metadata(spark, folder):
    """Source file, source name and load time of every row of a load."""
    store = TableStore(spark, scratch_path(spark, "store"))
    rows = normalise.typed_rows(archives.read_archives(spark, _written_archives(spark, folder)))
    store.load(rows, "raw_household", "household", AS_OF)
    return store.read("raw_household").select(
        "series_reference", "period", F.col("_source_file").rlike("^part-[0-9]+[.]csv$").alias("has_file"),
        F.col("_source_name").alias("source_name"), F.to_date("_ingested_at").alias("loaded_on"),
    )


@query
def ingest_csv_folder(spark, folder):
    """S3 to S7 through unpacked CSV files with two header spellings."""
    target = scratch_path(spark, "csv")
    rows = _text_rows(spark, folder)
    first = F.col("series_title_2") == "Male"
    rows.filter(first).withColumnsRenamed({"period": "Period", "status": "Status"}).write.csv(
        f"{target}/a", header=True, emptyValue=""
    )
    rows.filter(~first).withColumnsRenamed({"period": "Period", "status": "STATUS"}).write.csv(
        f"{target}/b", header=True, emptyValue=""
    )
    return normalise.typed_rows(archives.read_csv_folder(spark, target)).drop("_source_file")


@query
def ingest_report(spark, folder):
    """Load two sources into stored tables, one without a target."""
    written = _written_archives(spark, folder)
    store = TableStore(spark, scratch_path(spark, "store"))
    sources = [
        ingest.Source("household", written, "raw_household"),
        ingest.Source("wages", written, "raw_wages"),
        ingest.Source("spare", written, None),
    ]
    return ingest.run_sources(spark, sources, store, AS_OF).to_frame(spark)


@query
def ingest_audit(spark, folder):
    """Audit lines of one good and one failed load."""
    store = TableStore(spark, scratch_path(spark, "store"))
    rows = normalise.typed_rows(_text_rows(spark, folder))
    store.load(rows, "raw_household", "household", AS_OF)
    try:
        store.load(rows, "raw_unknown", "household", AS_OF)
    except ValueError:
        pass
    return store.audit_log().select("table_name", "rows_loaded", "source_files", "status")


@query
def stored_table(spark, folder):
    """Write two versions, stage the older one from storage."""
    store = TableStore(spark, scratch_path(spark, "store"))
    raw = testdata.household(spark, folder)
    store.write(raw, "raw_household", VERSIONS[0])
    store.write(raw.filter("period like '%Q1'"), "raw_household", VERSIONS[2])
    older = store.read_offset("raw_household", 86400, AS_OF)
    staged = materialise(staging.stage_household(older, 1998), "household_view", "staging")
    return staged.drop("_ingested_at")


@query
def incremental_latest(spark, folder):
    """Three waves of files with late and repeated keys, the newest row per key wins.

    The newest wave arrives first, so the others change only what they know better.
    """
    incoming, target = scratch_path(spark, "incoming"), scratch_path(spark, "landed")
    state = scratch_path(spark, "state")
    versions = _order_versions(spark, folder)
    for at in reversed(VERSIONS):
        wave = versions.filter(F.col("snapshot_ts") == F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz"))
        wave = wave.select("series_reference", "period", "data_value", "_ingested_at")
        wave.write.mode("append").parquet(incoming)
        incremental.land_new_files(spark, incoming, target, state, wave.schema)
    return incremental.current_rows(spark, target).withColumn(
        "_ingested_at", F.to_date("_ingested_at")
    )
