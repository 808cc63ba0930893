"""Plain SQL with the same results as the registered queries.

The statements run on the supplied tables without Spark and are a second opinion: they
start from the written rules and take another way to the result. Ranks count the greater
rows, earlier quarters are found by number and joined, national figures come from a
grouped subquery, and sums are added as decimals made from the printed value.
"""

from __future__ import annotations

from seriesmill import schema

START = 1996

# --- helpers ----------------------------------------------------------------


def _round(value: str, digits: int) -> str:
    """Rounded double; the added zero turns a negative zero into zero."""
    return f"(round({value}, {digits}) + CAST(0 AS DOUBLE))"


def _sum(value: str, scale: int = 17) -> str:
    """Sum of the printed values as decimals, back as the nearest double.

    The scale is chosen by what the column holds, so that no digit of it is cut.
    """
    decimal = f"CAST(CAST(({value}) AS VARCHAR) AS DECIMAL(38, {scale}))"
    return f"CAST(CAST(sum({decimal}) AS VARCHAR) AS DOUBLE)"


def _mean(value: str) -> str:
    return f"({_sum(value)} / nullif(count({value}), 0))"


def _names(labels: list[str]) -> str:
    """Labels as a list of SQL strings."""
    return ", ".join("'" + label.replace("'", "''") + "'" for label in labels)


def _growth(now: str, before: str, digits: int = 2) -> str:
    change = f"({now} - {before}) / {before} * 100"
    return f"CASE WHEN {before} > 0 THEN {_round(change, digits)} END"


def _quarter_start(period: str = "period") -> str:
    year = f"left({period}, 4) || '-"
    return (
        f"CASE right({period}, 1)"
        f" WHEN '1' THEN TRY_CAST({year}01-01' AS DATE) WHEN '2' THEN TRY_CAST({year}04-01' AS DATE)"
        f" WHEN '3' THEN TRY_CAST({year}07-01' AS DATE) WHEN '4' THEN TRY_CAST({year}10-01' AS DATE) END"
    )


def _quarter_text(column: str) -> str:
    return f"CAST(year({column}) AS VARCHAR) || 'Q' || CAST(quarter({column}) AS VARCHAR)"


def _month_text(column: str) -> str:
    return f"CAST(year({column}) AS VARCHAR) || 'M' || CAST(month({column}) AS VARCHAR)"


def _like(column: str, words: str) -> str:
    return f"{column} ILIKE '%{words}%'"


def _by_word(column: str, rules: list[tuple[str, str]], otherwise: str) -> str:
    """Label of the first rule whose words occur in the column, in any case."""
    tests = " ".join(f"WHEN {_like(column, words)} THEN '{label}'" for words, label in rules)
    return f"CASE {tests} ELSE {otherwise} END"


def _tier(region: str) -> str:
    return f"""CASE WHEN {_like(region, 'Auckland')} OR {_like(region, 'Wellington')} THEN 'North Island - Major'
      WHEN {_like(region, 'Canterbury')} THEN 'South Island - Major'
      WHEN {region} IN ('Waikato Region', 'Bay of Plenty Region') THEN 'North Island - Regional'
      WHEN {region} = 'New Zealand' THEN 'National' ELSE 'Other' END"""


def _by_limit(column: str, rules: list[tuple[str, str]], otherwise: str = "NULL") -> str:
    """Label of the first rule whose comparison holds."""
    tests = " ".join(f"WHEN {column} {test} THEN '{label}'" for test, label in rules)
    return f"CASE {tests} ELSE {otherwise} END"



# Words and limits of the classifiers, with their labels.
SECTOR_WORDS = [("private", "Private"), ("public", "Public"), ("all", "All Sectors")]
FREQUENCY_WORDS = [("hourly", "Hourly"), ("weekly", "Weekly")]
MEASURE_WORDS = [("filled job", "Filled Jobs"), ("gross earning", "Gross Earnings")]
CATEGORY_LIMITS = [
    (">= 5", "Strong Growth (5%+)"), (">= 2.5", "Moderate Growth (2.5-5%)"),
    (">= 0", "Slow Growth (0-2.5%)"), ("< 0", "Wage Decline"),
]
STATUS_LIMITS = [
    (">= 5", "Strong (5%+)"), (">= 2.5", "Moderate (2.5-5%)"), (">= 0", "Slow (0-2.5%)"),
    ("< 0", "Declining"),
]
LIGHT_LIMITS = [(">= 5", "Green"), (">= 0", "Amber"), ("< 0", "Red")]
GAP_LIMITS = [("> 1", "Red"), ("< -1", "Green"), ("IS NOT NULL", "Yellow")]
DIRECTION_LIMITS = [("> 0", "risen"), ("< 0", "fallen")]
HEALTH_LIMITS = [("> 6", "struggling"), ("< 4.5", "performing well")]


def _band(position: str, full: int) -> str:
    limits = [
        (f">= {0.75 * full}", "High Wage (Top 25%)"), (f">= {0.25 * full}", "Middle Wage")
    ]
    return _by_limit(position, limits, "'Low Wage (Bottom 25%)'")


# --- shared steps -----------------------------------------------------------

_REGION_LABEL = """CASE n_nationkey
    WHEN 0 THEN 'Auckland Region' WHEN 1 THEN 'Wellington Region' WHEN 2 THEN 'Canterbury Region'
    WHEN 3 THEN 'Waikato Region' WHEN 4 THEN 'Bay of Plenty Region' WHEN 5 THEN 'Otago Region'
    WHEN 6 THEN 'Hawke''s Bay Region' WHEN 7 THEN 'Manawatū-Whanganui Region'
    WHEN 8 THEN 'Northland Region' WHEN 9 THEN 'Taranaki Region' WHEN 10 THEN 'Gisborne Region'
    WHEN 11 THEN 'Tasman Region' WHEN 12 THEN 'Nelson Region' WHEN 13 THEN 'Marlborough Region'
    WHEN 14 THEN 'West Coast Region' WHEN 15 THEN 'Southland Region' WHEN 16 THEN 'New Zealand'
    WHEN 17 THEN NULL ELSE n_name END"""

_STEPS: dict[str, str] = {}

_STEPS["raw_wages"] = f"""
  SELECT 'W.' || l_orderkey || '.' || l_linenumber AS series_reference,
    {_quarter_text('l_shipdate')} AS period,
    CASE WHEN l_quantity = 2 THEN 0.0 WHEN l_quantity <> 1 THEN l_extendedprice / 1000.0 END AS data_value,
    CAST(NULL AS VARCHAR) AS suppressed, 'F' AS status, 'Dollars' AS units, 1 AS magnitude,
    CASE WHEN l_linestatus = 'F' THEN 'Average Ordinary Time Hourly Earnings'
      ELSE 'Average Weekly Earnings' END AS series_title_1,
    CASE l_returnflag WHEN 'A' THEN 'Private Sector' WHEN 'N' THEN 'Public Sector'
      WHEN 'R' THEN 'All Sectors' END AS series_title_2,
    CASE p_brand WHEN 'Brand#1' THEN 'All Industries' WHEN 'Brand#2' THEN ' Total '
      WHEN 'Brand#3' THEN NULL ELSE p_brand END AS series_title_3,
    l_shipdate AS _ingested_at, 'lineitem.parquet' AS _source_file, l_linenumber
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey"""

_STEPS["household_groups"] = """
  SELECT year(o_orderdate) AS y, quarter(o_orderdate) AS q, n_nationkey, n_name,
    CAST(left(o_orderpriority, 1) AS INTEGER) AS priority, o_orderstatus,
    CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / CAST(count(*) AS DOUBLE) / 1e6 AS mean,
    max(o_orderdate) AS newest
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY ALL"""

_STEPS["raw_household"] = f"""
  SELECT 'H.' || n_nationkey || '.' || priority || '.' || o_orderstatus AS series_reference,
    CASE WHEN n_nationkey = 23 THEN y || 'M' || q WHEN n_nationkey = 24 AND q = 4 THEN y || 'Q9'
      ELSE y || 'Q' || q END AS period,
    CASE WHEN priority = 4 AND n_nationkey IN (3, 4) THEN NULL
      WHEN priority = 2 THEN mean / 1e1 ELSE mean END AS data_value,
    CASE WHEN priority = 4 AND n_nationkey = 3 THEN 'S' WHEN priority = 4 THEN '' END AS suppressed,
    'F' AS status, CASE WHEN priority = 5 THEN 'Number' ELSE 'Percent' END AS units,
    CASE WHEN priority = 5 THEN 1000 ELSE 1 END AS magnitude,
    CASE WHEN priority = 1 THEN 'Employment Rate' WHEN priority = 2 THEN 'Unemployment Rate'
      WHEN priority = 3 THEN 'Labour Force Participation Rate'
      WHEN priority = 4 THEN 'Underutilisation Rate'
      WHEN o_orderstatus = 'P' THEN 'Unemployed' ELSE 'Employed' END AS series_title_1,
    CASE o_orderstatus WHEN 'F' THEN 'Male' WHEN 'O' THEN 'Total Both Sexes' ELSE 'Total' END AS series_title_2,
    {_REGION_LABEL} AS series_title_3, 'All ages' AS series_title_4,
    CASE WHEN o_orderstatus = 'P' AND priority = 3 THEN 'Seasonally Adjusted' ELSE 'Unadjusted' END AS series_title_5,
    newest AS _ingested_at, 'orders.parquet' AS _source_file, priority
  FROM household_groups"""

_STEPS["raw_monthly"] = f"""
  SELECT 'M.' || n_nationkey || '.' || c_mktsegment || '.' || o_orderstatus AS series_reference,
    {_month_text('o_orderdate')} AS period,
    CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 1e2 AS data_value,
    CAST(NULL AS VARCHAR) AS suppressed, 'F' AS status,
    CASE WHEN o_orderstatus = 'F' THEN 'Number' ELSE 'Dollars' END AS units,
    CASE WHEN o_orderstatus = 'F' THEN 1000 ELSE 1 END AS magnitude,
    CASE o_orderstatus WHEN 'F' THEN 'Filled jobs' WHEN 'O' THEN 'Gross earnings' ELSE 'Paid hours' END AS series_title_1,
    c_mktsegment AS series_title_2, {_REGION_LABEL} AS series_title_3,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Seasonally adjusted' ELSE 'Actual' END AS series_title_4,
    max(o_orderdate) AS _ingested_at, 'orders.parquet' AS _source_file
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY series_reference, period, n_nationkey, n_name, c_mktsegment, o_orderstatus"""


def _stg_household(source: str = "raw_household", start: int = START) -> str:
    return f"""
  SELECT series_reference, period, {_quarter_start()} AS period_start_date,
    TRY_CAST(left(period, 4) AS INTEGER) AS year_num, TRY_CAST(right(period, 1) AS INTEGER) AS quarter_num,
    data_value, units, coalesce(nullif(suppressed, ''), 'N') AS is_suppressed, status, magnitude,
    series_title_1 AS measure_name, series_title_2 AS sex, series_title_3 AS region,
    series_title_4 AS age_group, series_title_5 AS adjustment_type,
    coalesce(series_title_5 ILIKE '%seasonal%', false) OR coalesce(series_title_1 ILIKE '%seasonally%', false) AS is_seasonally_adjusted,
    coalesce(units ILIKE 'percent', false) AS is_rate_metric,
    CASE WHEN magnitude > 1 THEN data_value * magnitude ELSE data_value END AS data_value_actual,
    _source_file
  FROM {source}
  WHERE period LIKE '____Q_' AND (data_value IS NOT NULL OR suppressed = 'S')
    AND TRY_CAST(left(period, 4) AS INTEGER) >= {start}"""


_STEPS["stg_household"] = _stg_household()

_STEPS["stg_wages"] = f"""
  SELECT series_reference, period, {_quarter_start()} AS period_start_date,
    TRY_CAST(left(period, 4) AS INTEGER) AS year_num, TRY_CAST(right(period, 1) AS INTEGER) AS quarter_num,
    data_value, units, status, magnitude, series_title_1 AS wage_measure, series_title_2 AS sector,
    {_by_word('series_title_2', SECTOR_WORDS, "'Other'")} AS sector_clean, series_title_3 AS industry_anzsic,
    {_by_word('series_title_1', FREQUENCY_WORDS, "'Other'")} AS wage_frequency,
    data_value AS wage_nzd, _source_file
  FROM raw_wages
  WHERE period LIKE '____Q_' AND data_value > 0 AND TRY_CAST(left(period, 4) AS INTEGER) >= {START}"""

_STEPS["stg_monthly"] = f"""
  SELECT series_reference, period,
    TRY_CAST(left(period, 4) || '-' || lpad(substring(period, 6, 2), 2, '0') || '-01' AS DATE) AS period_start_date,
    TRY_CAST(left(period, 4) AS INTEGER) AS year_num, TRY_CAST(substring(period, 6, 2) AS INTEGER) AS month_num,
    CAST(ceil(TRY_CAST(substring(period, 6, 2) AS INTEGER) / 3.0) AS INTEGER) AS quarter_num,
    data_value, units, status, magnitude, series_title_1 AS measure_name,
    {_by_word('series_title_1', MEASURE_WORDS, 'series_title_1')} AS measure_clean,
    series_title_2 AS industry, series_title_3 AS region, series_title_4 AS adjustment_type,
    coalesce(series_title_4 ILIKE '%seasonal%', false) AS is_seasonally_adjusted,
    CASE WHEN magnitude > 1 THEN data_value * magnitude ELSE data_value END AS data_value_actual, _source_file
  FROM raw_monthly
  WHERE (period LIKE '____M__' OR period LIKE '____M_') AND data_value IS NOT NULL
    AND TRY_CAST(left(period, 4) AS INTEGER) >= {START}"""


def _regional_rates(strict: bool = False) -> str:
    """Each measure is the greatest of the values whose label fits; `strict` closes two overlaps."""
    def measure(name: str, value: str, label: str, *conditions: str) -> str:
        rules = " AND ".join([_like("measure_name", label), *conditions])
        return f"max(CASE WHEN {rules} THEN {value} END) AS {name}"

    def without(label: str) -> str:
        return f"NOT {_like('measure_name', label)}"

    count = _like("units", "number")
    outputs = [
        measure("employment_rate_pct", "data_value", "employment rate", *([without("unemployment rate")] if strict else [])),
        measure("unemployment_rate_pct", "data_value", "unemployment rate", without("under")),
        measure("participation_rate_pct", "data_value", "participation rate"),
        measure("underutilisation_rate_pct", "data_value", "underutilisation rate"),
        measure("employed_count", "data_value_actual", "employed", without("unemployed"), count, *([without("underemployed")] if strict else [])),
        measure("unemployed_count", "data_value_actual", "unemployed", count),
    ]
    return f"""
  SELECT year_num, quarter_num, region, any_value(period_start_date) AS period_start_date, {", ".join(outputs)}
  FROM stg_household WHERE sex IN ({_names(schema.BOTH_SEXES)}) AND NOT is_seasonally_adjusted
  GROUP BY ALL"""


_STEPS["regional_rates"] = _regional_rates()
_STEPS["regional_rates_strict"] = _regional_rates(strict=True)

_STEPS["quarterly_jobs"] = f"""
  SELECT year_num, quarter_num, region,
    {_mean("CASE WHEN measure_clean = 'Filled Jobs' THEN data_value_actual END")} AS avg_monthly_filled_jobs,
    {_sum("CASE WHEN measure_clean = 'Gross Earnings' THEN data_value_actual END")} AS total_quarterly_gross_earnings_nzd
  FROM stg_monthly WHERE NOT is_seasonally_adjusted GROUP BY ALL"""


def _int_regional(rates: str) -> str:
    return f"""
  SELECT period_start_date, year_num, quarter_num, year_num || 'Q' || quarter_num AS year_quarter_label, region,
    {", ".join(_RATES)}, employed_count, unemployed_count,
    avg_monthly_filled_jobs, total_quarterly_gross_earnings_nzd,
    {_tier('region')} AS region_tier,
    CAST(employment_rate_pct IS NULL AS INTEGER) AS missing_employment_rate,
    CAST(unemployment_rate_pct IS NULL AS INTEGER) AS missing_unemployment_rate
  FROM {rates} LEFT JOIN quarterly_jobs USING (year_num, quarter_num, region)
  WHERE region IS NOT NULL"""


_RATES = ["employment_rate_pct", "unemployment_rate_pct", "participation_rate_pct", "underutilisation_rate_pct"]

_STEPS["int_regional"] = _int_regional("regional_rates")

_STEPS["national_rates"] = f"""
  SELECT period_start_date AS day, {", ".join(f"any_value({c}) AS nz_{c}" for c in _RATES)}
  FROM int_regional WHERE region IN ({_names(schema.NATIONAL_REGIONS)}) GROUP BY period_start_date"""

_STEPS["mart_regional"] = f"""
  SELECT period_start_date, year_num, quarter_num, year_quarter_label, region, region_tier,
    {", ".join(f"{_round(c, 1)} AS {c}" for c in _RATES)},
    {_round('employed_count / 100.0', 0)} * 100 AS employed_count,
    {_round('unemployed_count / 100.0', 0)} * 100 AS unemployed_count,
    {_round('avg_monthly_filled_jobs', 0)} AS avg_monthly_filled_jobs,
    {_round('total_quarterly_gross_earnings_nzd / 1e9', 2)} AS gross_earnings_billions_nzd,
    {", ".join(f"{_round('nz_' + c, 1)} AS nz_{c}" for c in _RATES)},
    {_round('unemployment_rate_pct - nz_unemployment_rate_pct', 1)} AS unemployment_rate_vs_nz_pp,
    {_round('employment_rate_pct - nz_employment_rate_pct', 1)} AS employment_rate_vs_nz_pp,
    missing_employment_rate, missing_unemployment_rate
  FROM int_regional LEFT JOIN national_rates ON day = period_start_date
  WHERE region NOT IN ({_names(schema.NATIONAL_REGIONS)})"""

# Wages: one list of hourly rows, means by joins of grouped totals, and neighbours in
# time by the number of the quarter within its sector or industry.
_STEPS["hourly_wage"] = """
  SELECT period_start_date, year_num, quarter_num, sector_clean, industry_anzsic, wage_nzd
  FROM stg_wages WHERE wage_frequency = 'Hourly'"""

_STEPS["sector_quarter"] = f"""
  SELECT period_start_date, year_num, quarter_num, sector_clean, {_mean('wage_nzd')} AS mean_wage,
    count(*) OVER (PARTITION BY sector_clean ORDER BY period_start_date NULLS LAST ROWS UNBOUNDED PRECEDING) AS number
  FROM hourly_wage GROUP BY period_start_date, year_num, quarter_num, sector_clean"""

_STEPS["hourly_by_sector"] = """
  SELECT period_start_date, year_num, quarter_num, year_num || 'Q' || quarter_num AS year_quarter_label, sector_clean,
    mean_wage AS avg_hourly_wage_nzd FROM sector_quarter"""

_STEPS["recent_year"] = """
  SELECT now.sector_clean, now.number, list_avg(list(near.mean_wage ORDER BY near.number)) AS recent_mean
  FROM sector_quarter now JOIN sector_quarter near
    ON now.sector_clean = near.sector_clean AND near.number <= now.number AND near.number > now.number - 4
  GROUP BY now.sector_clean, now.number"""

_STEPS["wage_growth_detail"] = f"""
  SELECT now.period_start_date, now.year_num, now.quarter_num, now.year_num || 'Q' || now.quarter_num AS year_quarter_label,
    now.sector_clean, now.mean_wage AS avg_hourly_wage_nzd, one.mean_wage AS wage_1yr_ago, recent_mean AS rolling_4q_avg_wage,
    {_growth('now.mean_wage', 'one.mean_wage')} AS yoy_wage_growth_pct,
    {_growth('now.mean_wage', 'two.mean_wage')} AS two_yr_wage_growth_pct
  FROM sector_quarter now JOIN recent_year USING (sector_clean, number)
    LEFT JOIN sector_quarter one ON one.sector_clean = now.sector_clean AND one.number = now.number - 4
    LEFT JOIN sector_quarter two ON two.sector_clean = now.sector_clean AND two.number = now.number - 8"""


def _of_sector(label: str) -> str:
    return f"(SELECT * FROM wage_growth_detail WHERE sector_clean = '{label}')"


# One row per quarter that any sector has, each sector joined to it by its date.
_STEPS["sector_columns"] = f"""
  SELECT q.period_start_date, q.year_num, q.quarter_num, q.year_quarter_label,
    private.avg_hourly_wage_nzd AS private_hourly_wage, public.avg_hourly_wage_nzd AS public_hourly_wage,
    everyone.avg_hourly_wage_nzd AS all_sectors_hourly_wage, private.yoy_wage_growth_pct AS private_yoy_growth_pct,
    public.yoy_wage_growth_pct AS public_yoy_growth_pct, everyone.yoy_wage_growth_pct AS all_sectors_yoy_growth_pct
  FROM (SELECT DISTINCT period_start_date, year_num, quarter_num, year_quarter_label FROM wage_growth_detail ) q
    LEFT JOIN {_of_sector('Private')} private ON private.period_start_date IS NOT DISTINCT FROM q.period_start_date
    LEFT JOIN {_of_sector('Public')} public ON public.period_start_date IS NOT DISTINCT FROM q.period_start_date
    LEFT JOIN {_of_sector('All Sectors')} everyone ON everyone.period_start_date IS NOT DISTINCT FROM q.period_start_date"""

_STEPS["int_wage_trends"] = f"""
  SELECT *, {_growth('public_hourly_wage', 'private_hourly_wage', 1)} AS public_vs_private_premium_pct,
    {_round('public_hourly_wage - private_hourly_wage', 2)} AS public_vs_private_gap_nzd,
    {_round('all_sectors_hourly_wage * 40 * 52', 0)} AS estimated_annual_salary_nzd
  FROM sector_columns"""

_STEPS["mart_wage"] = f"""
  SELECT period_start_date, year_num, quarter_num, year_quarter_label,
    {", ".join(f"{_round(s + '_hourly_wage', 2)} AS {s}_hourly_wage_nzd" for s in ("private", "public", "all_sectors"))},
    {", ".join(f"{_round(s + '_yoy_growth_pct', 2)} AS {s}_wage_yoy_growth_pct" for s in ("private", "public", "all_sectors"))},
    {_round('public_vs_private_premium_pct', 1)} AS public_premium_pct,
    {_round('public_vs_private_gap_nzd', 2)} AS public_vs_private_gap_nzd, estimated_annual_salary_nzd,
    {_by_limit('all_sectors_yoy_growth_pct', CATEGORY_LIMITS, "'Unknown'")} AS growth_category
  FROM int_wage_trends"""


def _counted_ranks(rows: str) -> str:
    """Ranks of `wage` within its quarter by counting the others; the share below is over the others."""
    return f"""SELECT mine.*,
    CAST(1 + count(other.wage) FILTER (WHERE other.wage > mine.wage) AS INTEGER) AS wage_rank_highest,
    CAST(1 + count(other.wage) FILTER (WHERE other.wage < mine.wage) AS INTEGER) AS wage_rank_lowest,
    CASE WHEN count(other.wage) > 1 THEN CAST(count(other.wage) FILTER (WHERE other.wage < mine.wage) AS DOUBLE)
      / (count(other.wage) - 1) ELSE 0.0 END AS share_below
  FROM ({rows}) mine JOIN ({rows}) other ON other.period_start_date IS NOT DISTINCT FROM mine.period_start_date
  GROUP BY ALL"""


def _industry_means(trimmed: bool, wage: str) -> str:
    label = "trim(industry_anzsic)" if trimmed else "industry_anzsic"
    return f"""SELECT period_start_date, year_num, quarter_num, industry_anzsic, {wage} AS wage FROM hourly_wage
      WHERE {label} NOT IN ({_names(schema.TOTAL_INDUSTRIES)}) GROUP BY period_start_date, year_num, quarter_num, industry_anzsic"""


_STEPS["industry_quarter"] = f"""
  SELECT *, count(*) OVER (PARTITION BY industry_anzsic ORDER BY period_start_date NULLS LAST ROWS UNBOUNDED PRECEDING) AS number
  FROM ({_industry_means(True, _round(_mean('wage_nzd'), 2))})"""

_STEPS["industry_places"] = _counted_ranks("SELECT * FROM industry_quarter")

_STEPS["mart_industry"] = f"""
  SELECT p.period_start_date, p.year_num, p.quarter_num, p.year_num || 'Q' || p.quarter_num AS year_quarter_label,
    p.industry_anzsic, p.wage AS avg_hourly_wage_nzd, p.wage_rank_highest, p.wage_rank_lowest,
    {_round('p.share_below * 100', 0)} AS wage_percentile_pct,
    {_band('round(p.share_below * 100, 0)', 100)} AS wage_band, before.wage AS wage_1yr_ago_nzd,
    {_growth('p.wage', 'before.wage')} AS yoy_wage_growth_pct,
    {_round('p.wage * 40 * 52', 0)} AS estimated_annual_salary_nzd
  FROM industry_places p LEFT JOIN industry_quarter before
    ON before.industry_anzsic = p.industry_anzsic AND before.number = p.number - 4"""

_STEPS["segment_quarters"] = f"""
  SELECT c_mktsegment, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS period_start_date,
    {_sum('o_totalprice')} AS order_value
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2"""

_STEPS["labelled_orders"] = f"""
  SELECT CASE
    WHEN o_orderpriority = '1-URGENT' THEN {_quarter_text('o_orderdate')}
    WHEN o_orderpriority = '2-HIGH' THEN CAST(year(o_orderdate) AS VARCHAR) || 'Q9'
    WHEN o_orderpriority = '3-MEDIUM' THEN {_month_text('o_orderdate')}
    WHEN o_orderpriority = '4-NOT SPECIFIED'
      THEN CAST(year(o_orderdate) AS VARCHAR) || '.' || lpad(CAST(quarter(o_orderdate) * 3 AS VARCHAR), 2, '0')
    WHEN o_orderstatus = 'F' THEN 'abcdQ1'
    WHEN o_orderstatus = 'O' THEN CAST(year(o_orderdate) AS VARCHAR) || 'M13'
    ELSE CAST(year(o_orderdate) AS VARCHAR) || 'MXX' END AS period
  FROM orders"""

_SHORT_REGION = "replace(regexp_replace({0}, ' Region$', ''), 'ū', 'u')"

_STEPS["dashboard_household"] = f"""
  SELECT * REPLACE ({_SHORT_REGION.format('series_title_3')} AS series_title_3) FROM raw_household"""

_STEPS["dash_regional"] = f"""
  SELECT series_title_3 AS region, period, min(data_value) AS unemployment_rate FROM dashboard_household
  WHERE series_title_1 = 'Unemployment Rate' AND series_title_2 = 'Total Both Sexes' AND data_value IS NOT NULL
    AND series_title_3 IN ({_names(schema.DASHBOARD_REGIONS)})
  GROUP BY 1, 2"""

_NATIONAL_ROWS = f"""FROM dashboard_household
  WHERE series_title_1 IN ('Unemployment Rate', 'Labour Force Participation Rate') AND series_title_2 = 'Total Both Sexes'
    AND series_title_3 IN ({_names(schema.DASHBOARD_NATIONAL_REGIONS)}) AND data_value BETWEEN 0 AND 100
  GROUP BY period"""

_STEPS["dash_national"] = f"""
  SELECT period, min(data_value) AS unemployment_rate, max(data_value) AS participation_rate {_NATIONAL_ROWS}"""

_STEPS["dash_wage_rows"] = """
  SELECT series_title_2 AS sector, CASE WHEN l_linenumber <= 4 THEN 'Total Both Sexes' WHEN l_linenumber <= 6 THEN 'Female'
      ELSE 'Male' END AS sex, series_title_1 AS wage_type, period, data_value AS wage
  FROM raw_wages
  WHERE units = 'Dollars' AND series_title_1 ILIKE '%Ordinary Time%Hourly%' AND data_value BETWEEN 20 AND 150"""

_OLDER = "CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice - 100.0 ELSE o_totalprice END"


def _version(day: str, condition: str, value: str) -> str:
    return f"""SELECT CAST(o_orderkey AS VARCHAR) AS series_reference, {_quarter_text('o_orderdate')} AS period,
    CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN {value} END AS data_value, DATE '{day}' AS loaded
  FROM orders WHERE {condition}"""


_STEPS["version_week"] = _version("2001-12-25", "o_orderdate < TIMESTAMP '2001-01-01'", _OLDER)
_STEPS["version_day"] = _version("2001-12-31", "o_orderdate < TIMESTAMP '2001-07-01'", _OLDER)
_STEPS["version_now"] = _version(
    "2002-01-01", "o_orderpriority <> '5-LOW' OR o_orderstatus <> 'F'", "o_totalprice"
)

_STEPS["both_versions"] = """
  SELECT coalesce(c.series_reference, p.series_reference) AS series_reference, coalesce(c.period, p.period) AS period,
    c.data_value AS current_value, p.data_value AS previous_value,
    c.series_reference IS NOT NULL AS in_current, p.series_reference IS NOT NULL AS in_previous
  FROM version_now c FULL OUTER JOIN version_week p ON c.series_reference = p.series_reference AND c.period = p.period"""


def _faulty(value: str) -> str:
    """What remains of a household value after it was written with faulty tokens."""
    return f"CASE WHEN priority IN (3, 5) THEN NULL ELSE {value} END"


def _cleaned(subject: str = "'Test survey'") -> str:
    return f"""
  SELECT series_reference, period, {_faulty('data_value')} AS data_value, nullif(suppressed, '') AS suppressed,
    'F' AS status, CASE WHEN priority = 4 THEN NULL ELSE units END AS units,
    CAST(CASE WHEN priority = 1 THEN 3 WHEN priority = 2 THEN 0 ELSE magnitude END AS INTEGER) AS magnitude,
    CAST({subject} AS VARCHAR) AS subject, 'All' AS group_name, series_title_1, series_title_2, series_title_3,
    series_title_4, series_title_5
  FROM raw_household"""


# --- assembling -------------------------------------------------------------


def _with_steps(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix a statement with the steps that it mentions, in order."""
    steps = {**_STEPS, **(extra or {})}

    def mentioned(sql: str) -> set[str]:
        words = set(sql.replace("(", " ").replace(")", " ").replace(",", " ").split())
        return {name for name in steps if name in words}

    needed, queue = set(), list(mentioned(body))
    while queue:
        name = queue.pop()
        if name not in needed:
            needed.add(name)
            queue.extend(mentioned(steps[name]) - {name})
    parts = [f"{name} AS ({sql})" for name, sql in steps.items() if name in needed]
    return (f"WITH {', '.join(parts)}\n" if parts else "") + body


def _columns(step: str) -> str:
    return f"SELECT * FROM {step}"


def _ranked_rows(table: str, key: str, value: str, columns: str) -> str:
    """Ranks from the number of rows of each value: how many are below, and how many above."""
    return f"""WITH tally AS (
    SELECT {key} AS k, {value} AS v, count(*) AS n FROM {table} WHERE {value} IS NOT NULL GROUP BY ALL
  ), below AS (
    SELECT a.k, a.v, any_value(a.n) AS n, coalesce(sum(b.n) FILTER (WHERE b.v < a.v), 0) AS less, sum(b.n) AS everyone
    FROM tally a JOIN tally b ON a.k = b.k GROUP BY a.k, a.v
  ) SELECT {columns}, CAST(everyone - less - n + 1 AS BIGINT) AS rank_highest, CAST(less + 1 AS BIGINT) AS rank_lowest,
    CASE WHEN everyone > 1 THEN CAST(less AS DOUBLE) / CAST(everyone - 1 AS DOUBLE) ELSE 0.0 END AS percentile
  FROM {table} LEFT JOIN below ON k = {key} AND v = {value}"""


def _verdicts(table: str, rules: list[tuple[str, str, str, str]]) -> str:
    """One line per rule: (name, column, severity, condition of a failing row)."""
    lines = [
        f"SELECT '{name}' AS check_name, '{table}' AS table_name, '{column}' AS column_name,"
        f" '{severity}' AS severity, count(*) FILTER (WHERE {fails}) AS failures FROM {table}"
        for name, column, severity, fails in rules
    ]
    return "\nUNION ALL ".join(lines)


def _with_status(lines: list[str]) -> str:
    return (
        "SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'error' END AS status"
        " FROM (" + "\nUNION ALL ".join(lines) + ")"
    )


def _nulls(*columns: str) -> list[tuple[str, str, str, str]]:
    return [("not_null", c, "error", f"{c} IS NULL") for c in columns]


def _range(column: str, low, high, severity: str = "warn") -> tuple[str, str, str, str]:
    return ("between", column, severity, f"{column} < {low} OR {column} > {high}")


def _labels(column: str, values: str, severity: str = "error") -> tuple[str, str, str, str]:
    return ("accepted_values", column, severity, f"{column} NOT IN ({values})")


_YEARS = _range("year_num", START, 2000, "error")
_QUARTERS = _labels("quarter_num", "1, 2, 3, 4")
_WAGE_COLUMNS = [f"{s}_hourly_wage_nzd" for s in ("private", "public", "all_sectors")]
_KEY = ("series_reference", "period")

_CHECKS = {
    "raw_household": _nulls(*_KEY),
    "raw_wages": _nulls(*_KEY),
    "raw_monthly": _nulls(*_KEY),
    "stg_household": _nulls(
        *_KEY, "period_start_date", "year_num", "quarter_num", "is_seasonally_adjusted", "units"
    )
    + [
        ("matches_regex", "period", "error", "NOT regexp_matches(period, '^[0-9]{4}Q[1-4]$')"),
        _YEARS,
        _QUARTERS,
        _labels("is_seasonally_adjusted", "true, false"),
    ],
    "stg_wages": _nulls(*_KEY, "period_start_date", "wage_nzd")
    + [
        _range("wage_nzd", 0, 10000),
        _labels("sector_clean", "'Private', 'Public', 'All Sectors', 'Other'"),
        _labels("wage_frequency", "'Hourly', 'Weekly', 'Other'"),
    ],
    "stg_monthly": _nulls(*_KEY, "period_start_date")
    + [_labels("measure_clean", "'Filled Jobs', 'Gross Earnings'", "warn")],
    "int_regional": _nulls(
        "period_start_date", "year_num", "quarter_num", "year_quarter_label", "region"
    )
    + [
        _YEARS,
        _QUARTERS,
        _labels(
            "region_tier",
            "'North Island - Major', 'North Island - Regional', 'South Island - Major', 'National', 'Other'",
        ),
    ],
    "int_wage_trends": _nulls("period_start_date", "year_quarter_label")
    + [_range("private_hourly_wage", 5, 500), _range("public_hourly_wage", 5, 500)],
    "mart_regional": _nulls("period_start_date", "region")
    + [
        ("not_null", "mart_refreshed_at", "error", "false"),
        _range("employment_rate_pct", 0, 100),
        _range("unemployment_rate_pct", 0, 30),
    ],
    "mart_wage": _nulls("period_start_date")
    + [
        _range("private_hourly_wage_nzd", 10, 500),
        _range("public_hourly_wage_nzd", 10, 500),
        _labels(
            "growth_category",
            "'Strong Growth (5%+)', 'Moderate Growth (2.5-5%)', 'Slow Growth (0-2.5%)', 'Wage Decline', 'Unknown'",
        ),
    ],
    "mart_industry": _nulls("period_start_date", "industry_anzsic", "avg_hourly_wage_nzd")
    + [
        ("not_null", "mart_refreshed_at", "error", "false"),
        _range("avg_hourly_wage_nzd", 5, 500),
        _labels("wage_band", "'High Wage (Top 25%)', 'Middle Wage', 'Low Wage (Bottom 25%)'"),
    ],
}


def _check_tables(*tables: str) -> str:
    return _with_status([_verdicts(table, _CHECKS[table]) for table in tables])


_NATIONAL = "(series_title_3 ILIKE '%New Zealand%' OR series_title_3 ILIKE '%Total%' OR series_title_3 IS NULL)"


def oracle_sql() -> dict[str, str]:
    """Statement per query name."""
    q: dict[str, str] = {}
    for step in (
        "stg_household", "stg_wages", "stg_monthly", "int_regional", "int_wage_trends",
        "wage_growth_detail", "mart_regional", "mart_wage", "mart_industry",
    ):
        q[step] = _columns(step)
    q["dash_national"] = f"{_columns('dash_national')} ORDER BY period"
    q["dash_regional"] = f"{_columns('dash_regional')} ORDER BY period DESC, unemployment_rate DESC"
    q["dash_wage_rows"] = f"{_columns('dash_wage_rows')} ORDER BY period DESC"
    q["report_table"] = _columns("dash_regional")

    q["int_regional_strict"] = _int_regional("regional_rates_strict")
    q["industry_wages_unrounded"] = f"""SELECT period_start_date, year_num, quarter_num, industry_anzsic,
      {_round('wage', 2)} AS avg_hourly_wage_nzd, wage_rank_highest, wage_rank_lowest,
      {_round('share_below * 100', 0)} AS wage_percentile_pct, {_band('share_below', 1)} AS wage_band
    FROM ({_counted_ranks(_industry_means(False, _mean('wage_nzd')))})"""

    # periods
    q["period_parse_quarterly"] = f"""SELECT period, TRY_CAST(left(period, 4) AS INTEGER) AS year_num,
      TRY_CAST(right(period, 1) AS INTEGER) AS quarter_num, {_quarter_start()} AS period_start_date, count(*) AS n
    FROM labelled_orders WHERE period LIKE '____Q_' GROUP BY period"""
    month = "TRY_CAST(substring(period, 6, 2) AS INTEGER)"
    q["period_parse_monthly"] = f"""SELECT period, TRY_CAST(left(period, 4) AS INTEGER) AS year_num, {month} AS month_num,
      CAST(ceil({month} / 3.0) AS INTEGER) AS quarter_num,
      TRY_CAST(left(period, 4) || '-' || lpad(substring(period, 6, 2), 2, '0') || '-01' AS DATE) AS period_start_date,
      count(*) AS n
    FROM labelled_orders WHERE period LIKE '____M__' OR period LIKE '____M_' GROUP BY period"""
    q["period_parse_dotted"] = f"""SELECT period, TRY_CAST(left(period, 4) AS INTEGER) AS year_num,
      CASE WHEN period LIKE '____.__' THEN CAST(ceil({month} / 3.0) AS INTEGER) ELSE TRY_CAST(right(period, 1) AS INTEGER) END AS quarter_num,
      CASE WHEN period LIKE '____.__' THEN TRY_CAST(left(period, 4) || '-' || lpad(CAST({month} - 2 AS VARCHAR), 2, '0') || '-01' AS DATE)
        ELSE {_quarter_start()} END AS period_start_date, count(*) AS n
    FROM labelled_orders WHERE period LIKE '____Q_' OR period LIKE '____.__' GROUP BY period"""
    q["period_arithmetic"] = f"""SELECT day, CAST(date_trunc('year', day) AS DATE) AS year_start, {_quarter_text('day')} AS quarter_label,
      CAST(date_trunc('month', day) - INTERVAL 12 MONTH AS DATE) AS month_a_year_ago,
      CAST(day - INTERVAL 7 DAY AS DATE) AS week_before, n
    FROM (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1)"""

    # filters
    q["suppressed_or_valued"] = """SELECT series_title_1, suppressed, count(*) AS n, count(data_value) AS n_valued
    FROM raw_household WHERE data_value IS NOT NULL OR suppressed = 'S' GROUP BY 1, 2"""
    q["valued_rows"] = """SELECT series_title_2, count(data_value) AS n_valued, count(*) FILTER (WHERE data_value > 0) AS n_positive
    FROM raw_wages GROUP BY 1"""
    q["year_floor"] = """SELECT CAST(left(period, 4) AS INTEGER) AS year_num, count(*) AS n
    FROM raw_wages WHERE CAST(left(period, 4) AS INTEGER) >= 1998 GROUP BY 1"""
    q["label_contains"] = """SELECT series_title_1, series_title_2, count(*) AS n, max(data_value) AS highest FROM raw_wages
    WHERE series_title_1 ILIKE '%ordinary time%hourly%' AND series_title_2 NOT ILIKE '%all%' AND units ILIKE 'dollars' GROUP BY 1, 2"""
    q["not_in_trimmed"] = f"""SELECT series_title_3, count(*) AS n, trim(series_title_3) NOT IN ({_names(schema.TOTAL_INDUSTRIES)}) AS passes_trimmed
    FROM raw_wages WHERE series_title_3 NOT IN ({_names(schema.TOTAL_INDUSTRIES)}) GROUP BY 1"""
    q["value_between"] = """SELECT series_title_2, count(*) AS n, min(data_value) AS lowest FROM raw_wages
    WHERE data_value BETWEEN 20 AND 150 GROUP BY 1"""
    q["in_dimension"] = """SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders
    WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
      AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY 1, 2"""

    # classifiers
    q["classify_sector"] = """SELECT series_title_1, series_title_2,
      CASE series_title_2 WHEN 'Private Sector' THEN 'Private' WHEN 'Public Sector' THEN 'Public' ELSE 'All Sectors' END AS sector_clean,
      CASE WHEN series_title_1 LIKE '%Hourly%' THEN 'Hourly' ELSE 'Weekly' END AS wage_frequency, count(*) AS n
    FROM raw_wages GROUP BY 1, 2"""
    q["classify_tier"] = f"""SELECT region, n, {_tier('region')} AS region_tier,
      {_SHORT_REGION.format('region')} AS short_region
    FROM (SELECT n_nationkey, {_REGION_LABEL} AS region, count(*) AS n
      FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_nationkey, n_name)"""
    growth = "yoy_wage_growth_pct"
    q["classify_growth"] = f"""SELECT sector_clean, year_quarter_label, {growth},
      {_by_limit(growth, CATEGORY_LIMITS, "'Unknown'")} AS growth_category, {_by_limit(growth, STATUS_LIMITS)} AS growth_status,
      {_by_limit(growth, LIGHT_LIMITS)} AS growth_light FROM wage_growth_detail"""
    q["classify_flags"] = """SELECT survey, measure, adjusted, is_rate, is_suppressed, is_missing, count(*) AS n FROM (
      SELECT 'household' AS survey, series_title_1 AS measure, series_title_5 ILIKE '%seasonal%' AS adjusted, units = 'Percent' AS is_rate,
        CASE WHEN suppressed = 'S' THEN 'S' ELSE 'N' END AS is_suppressed, CAST(data_value IS NULL AS INTEGER) AS is_missing FROM raw_household
      UNION ALL
      SELECT 'monthly', CASE series_title_1 WHEN 'Filled jobs' THEN 'Filled Jobs' WHEN 'Gross earnings' THEN 'Gross Earnings' ELSE series_title_1 END,
        series_title_4 ILIKE '%seasonal%', units = 'Percent', 'N', CAST(data_value IS NULL AS INTEGER) FROM raw_monthly)
    GROUP BY 1, 2, 3, 4, 5, 6"""

    # numbers
    q["scale_magnitude"] = """SELECT series_reference, period, CAST(magnitude AS INTEGER) AS magnitude,
      CASE WHEN magnitude > 1 THEN data_value * magnitude ELSE data_value END AS actual FROM raw_household"""
    q["safe_divide"] = """SELECT l_orderkey, l_linenumber,
      CASE WHEN l_discount IS NULL OR l_discount = 0 THEN CAST(0 AS DOUBLE) ELSE l_extendedprice / l_discount END AS ratio FROM lineitem"""
    q["growth_pct"] = f"""SELECT c_mktsegment, period_start_date, order_value, year_ago, {_growth('order_value', 'year_ago')} AS growth
    FROM (SELECT *, lag(order_value, 4) OVER (PARTITION BY c_mktsegment ORDER BY period_start_date) AS year_ago FROM segment_quarters)"""
    q["round_to_hundred"] = f"""SELECT o_custkey, {_round('v / 100.0', 0)} * 100 AS hundreds, {_round('v * 1000.0 / 1e9', 2)} AS billions,
      {_round('v * 40 * 52', 0)} AS annual FROM (SELECT o_custkey, {_sum('o_totalprice')} AS v FROM orders GROUP BY 1)"""
    q["pp_gap"] = f"""SELECT year_quarter_label, {_round('public_hourly_wage - private_hourly_wage', 1)} AS gap,
      {_growth('public_hourly_wage', 'private_hourly_wage', 1)} AS premium FROM sector_columns"""

    # aggregates
    q["pivot_by_pattern"] = """SELECT year_num, quarter_num, region, employment_rate_pct, unemployment_rate_pct, participation_rate_pct,
      underutilisation_rate_pct, employed_count, unemployed_count FROM regional_rates"""
    q["pivot_by_value"] = """SELECT o_custkey, max(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS highest_f,
      max(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END) AS highest_o,
      max(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END) AS highest_p FROM orders GROUP BY 1"""
    q["cond_avg_sum"] = _columns("quarterly_jobs")
    q["sector_mean"] = _columns("hourly_by_sector")
    q["rounded_mean"] = f"""SELECT industry_anzsic, {_round(_mean('wage_nzd'), 2)} AS avg_wage, count(*) AS series_count
    FROM stg_wages GROUP BY 1"""
    q["global_summary"] = """SELECT count(*) AS row_count, CAST(max(_ingested_at) AS DATE) AS last_ingested,
      min(period) AS earliest_period, max(period) AS latest_period FROM raw_household"""
    q["min_max_trend"] = """SELECT period, series_title_2, min(data_value) AS lowest, max(data_value) AS highest FROM raw_wages GROUP BY 1, 2"""
    q["distinct_regions"] = """SELECT DISTINCT series_title_3 FROM raw_household WHERE series_title_3 IS NOT NULL ORDER BY 1"""
    q["mean_at_latest"] = f"""SELECT c_mktsegment, day AS latest_date, {_mean('o_totalprice')} AS mean_value
    FROM (SELECT c_mktsegment, CAST(o_orderdate AS DATE) AS day, o_totalprice,
        max(CAST(o_orderdate AS DATE)) OVER (PARTITION BY c_mktsegment) AS latest
      FROM orders JOIN customer ON o_custkey = c_custkey) WHERE day = latest GROUP BY 1, 2"""

    q["exact_sums"] = f"""SELECT l_returnflag, l_linestatus, {_sum('l_extendedprice * 1e12', 4)} AS large_total,
      {_sum('l_extendedprice * l_discount / 1e6', 26)} / count(*) AS small_mean, {_sum('l_extendedprice / 7.0')} AS long_total,
      {_sum('l_quantity * 1e-11', 30)} AS tiny_total, {_sum('l_quantity * 2e18', 0)} AS vast_total,
      CAST(count(*) FILTER (l_linenumber <> 1) AS DOUBLE) * 2e18 AS mixed_total
    FROM lineitem GROUP BY 1, 2"""

    # joins
    q["left_join_quarter_region"] = """SELECT r.year_num, r.quarter_num, r.region, employment_rate_pct, unemployment_rate_pct,
      participation_rate_pct, underutilisation_rate_pct, avg_monthly_filled_jobs, total_quarterly_gross_earnings_nzd
    FROM regional_rates r LEFT JOIN quarterly_jobs m ON r.year_num = m.year_num AND r.quarter_num = m.quarter_num AND r.region = m.region"""
    q["benchmark_join"] = """SELECT r.period_start_date, r.region, r.unemployment_rate_pct, b.unemployment_rate_pct AS nz_unemployment_rate_pct
    FROM int_regional r LEFT JOIN (SELECT * FROM int_regional WHERE region IN ('New Zealand', 'Auckland Region')) b
      ON r.period_start_date = b.period_start_date WHERE r.region NOT IN ('New Zealand', 'Auckland Region')"""
    q["full_outer_diff"] = _columns("both_versions")
    q["year_ago_join"] = """SELECT a.c_mktsegment, a.period_start_date, a.order_value, b.order_value AS by_shift, b.order_value AS by_window
    FROM segment_quarters a LEFT JOIN segment_quarters b
      ON a.c_mktsegment = b.c_mktsegment AND b.period_start_date = a.period_start_date - INTERVAL 12 MONTH"""
    regions = ", ".join(f"({_names([name])})" for name in schema.REGIONS)
    q["completeness_gaps"] = f"""SELECT year_num, quarter_num, region
    FROM (SELECT DISTINCT year_num, quarter_num FROM int_regional WHERE missing_employment_rate = 0) t
      CROSS JOIN (VALUES {regions}) v(region)
    WHERE (year_num, quarter_num, region) NOT IN (SELECT (year_num, quarter_num, region) FROM int_regional WHERE missing_employment_rate = 0)"""
    q["latest_period_semi"] = f"""SELECT series_reference, period, data_value, series_title_1, series_title_2 FROM raw_wages
    WHERE period = (SELECT arg_max(period, start) FROM (SELECT period, {_quarter_start()} AS start FROM raw_wages ))"""
    month_start = "make_date(CAST(left(period, 4) AS BIGINT), CAST(substring(period, 6, 2) AS BIGINT), 1)"
    q["latest_period_monthly"] = f"""SELECT series_reference, period, data_value FROM raw_monthly
    WHERE {month_start} = (SELECT max({month_start}) FROM raw_monthly )"""
    q["year_ago_daily"] = """WITH days AS (
      SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS day, count(*) AS orders FROM orders GROUP BY 1, 2)
    SELECT a.o_orderpriority, a.day, a.orders, b.orders AS year_ago FROM days a LEFT JOIN days b
      ON b.o_orderpriority = a.o_orderpriority AND b.day = CAST(a.day - INTERVAL 12 MONTH AS DATE)"""
    q["date_star_join"] = """SELECT period_start_date, region, unemployment_rate_pct, all_sectors_hourly_wage_nzd, growth_category
    FROM mart_regional r LEFT JOIN mart_wage w USING (period_start_date)"""

    # windows
    q["lag_growth"] = """SELECT *, lag(order_value, 4) OVER w AS one_year_ago, lag(order_value, 8) OVER w AS two_years_ago
    FROM segment_quarters WINDOW w AS (PARTITION BY c_mktsegment ORDER BY period_start_date)"""
    q["rolling_mean_4"] = f"""SELECT *, {_round('avg(order_value) OVER (PARTITION BY c_mktsegment ORDER BY period_start_date ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)', 4)} AS rolling
    FROM segment_quarters"""
    q["rank_both"] = _ranked_rows("part", "p_brand", "p_retailprice", "p_partkey, p_brand, p_retailprice")
    q["percent_band"] = f"""SELECT s_suppkey, {_round('percentile * 100', 0)} AS percentile_pct, {_band('round(percentile * 100, 0)', 100)} AS band_rounded,
      {_band('percentile', 1)} AS band_exact
    FROM ({_ranked_rows('supplier', 's_nationkey', 's_acctbal', 's_suppkey')})"""
    q["latest_vs_previous"] = """SELECT c_mktsegment, period_start_date, order_value AS latest_value, coalesce(before, order_value) AS previous_value
    FROM (SELECT *, lag(order_value) OVER w AS before, lead(period_start_date) OVER w AS later FROM segment_quarters
      WINDOW w AS (PARTITION BY c_mktsegment ORDER BY period_start_date)) WHERE later IS NULL"""
    q["extremes"] = f"""SELECT *, CASE WHEN order_value = max(order_value) OVER () THEN 'max'
      WHEN order_value = min(order_value) OVER () THEN 'min' ELSE 'other' END AS highlight
    FROM (SELECT o_custkey, {_sum('o_totalprice')} AS order_value FROM orders GROUP BY 1)"""

    # sort and limit
    q["topk_preview"] = "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5"
    q["presentation_order"] = """SELECT period_start_date, region, employment_rate_pct FROM mart_regional
    ORDER BY period_start_date DESC NULLS FIRST, region"""

    # dashboards
    q["dash_national_by_measure"] = f"""SELECT period, min(CASE WHEN series_title_1 = 'Unemployment Rate' THEN data_value END) AS unemployment_rate,
      max(CASE WHEN series_title_1 <> 'Unemployment Rate' THEN data_value END) AS participation_rate {_NATIONAL_ROWS}"""
    q["dash_wage"] = f"""SELECT sector, period, {_mean('wage')} AS wage FROM dash_wage_rows
    WHERE sector IN ('Public Sector', 'Private Sector') AND sex = 'Total Both Sexes' GROUP BY 1, 2"""
    q["dash_latest_rank"] = f"""SELECT *, CASE WHEN unemployment_rate = max(unemployment_rate) OVER () THEN 'max'
      WHEN unemployment_rate = min(unemployment_rate) OVER () THEN 'min' ELSE 'other' END AS highlight
    FROM (SELECT region, unemployment_rate FROM dash_regional WHERE period = '2001Q2' AND region IN ({_names(schema.LATEST_RANK_REGIONS)}))
    ORDER BY unemployment_rate DESC"""
    q["dash_story"] = f"""SELECT region, period, latest_rate, change_pp, vs_national_pp,
      {_by_limit('change_pp', DIRECTION_LIMITS, "'remained stable'")} AS direction,
      CASE WHEN vs_national_pp > 0 THEN 'above' ELSE 'below' END AS side,
      {_by_limit('latest_rate', HEALTH_LIMITS, "'tracking close to the national average'")} AS health,
      abs(change_pp) AS change_size, printf('%+.1f', change_pp) AS change_text
    FROM (SELECT region, period, unemployment_rate AS latest_rate, {_round('unemployment_rate - coalesce(before, unemployment_rate)', 1)} AS change_pp,
        {_round('unemployment_rate - (SELECT arg_max(unemployment_rate, period) FROM dash_national )', 1)} AS vs_national_pp
      FROM (SELECT *, lag(unemployment_rate) OVER w AS before, lead(period) OVER w AS later FROM dash_regional
        WINDOW w AS (PARTITION BY region ORDER BY period)) WHERE later IS NULL)"""
    q["dash_compare"] = """SELECT region, period, unemployment_rate, region = 'Auckland' AS is_selected FROM dash_regional
    WHERE period = (SELECT max(period) FROM dash_regional ) ORDER BY unemployment_rate"""
    month = "3 * CAST(right(period, 1) AS INTEGER)"
    q["dash_compare_dotted"] = f"""SELECT region, left(period, 4) || '.' || lpad(CAST({month} AS VARCHAR), 2, '0') AS period, unemployment_rate,
      region = 'Auckland' AS is_selected
    FROM dash_regional WHERE period = (SELECT max(period) FROM dash_regional )"""
    q["dash_story_monthly"] = f"SELECT * REPLACE (left(period, 4) || 'M' || CAST({month} AS VARCHAR) AS period) FROM ({q['dash_story']})"
    q["dash_multi"] = """SELECT region, period, unemployment_rate FROM dash_regional
    WHERE region IN ('Auckland', 'Wellington', 'Canterbury', 'Otago') ORDER BY 1, 2"""

    # measures
    latest = "(SELECT max(period_start_date) FROM {0} )"
    q["kpi_latest"] = f"""SELECT max(period_start_date) AS latest_date, {_mean('unemployment_rate_pct')} AS latest_unemployment_rate,
      {_mean('employment_rate_pct')} AS latest_employment_rate
    FROM mart_regional WHERE period_start_date = {latest.format('mart_regional')}"""
    q["kpi_salary"] = f"""SELECT max(period_start_date) AS latest_date, {_mean('estimated_annual_salary_nzd')} AS estimated_annual_salary_nzd
    FROM mart_wage WHERE period_start_date = {latest.format('mart_wage')}"""
    per_date = f"SELECT region_tier, period_start_date, {_mean('unemployment_rate_pct')} AS rate FROM mart_regional GROUP BY 1, 2"
    q["kpi_yoy"] = f"""SELECT a.region_tier, a.period_start_date AS latest_date, a.rate AS current_rate, b.rate AS prior_rate,
      {_round('a.rate - b.rate', 6)} AS yoy_change_pp
    FROM ({per_date}) a LEFT JOIN ({per_date}) b
      ON a.region_tier = b.region_tier AND b.period_start_date = a.period_start_date - INTERVAL 12 MONTH
    WHERE a.period_start_date = (SELECT max(m.period_start_date) FROM mart_regional m WHERE m.region_tier = a.region_tier)"""
    q["kpi_yoy_series"] = f"""SELECT a.period_start_date, a.region, a.unemployment_rate_pct, b.unemployment_rate_pct AS rate_1yr_ago,
      {_round('a.unemployment_rate_pct - b.unemployment_rate_pct', 3)} AS yoy_change_pp
    FROM mart_regional a LEFT JOIN mart_regional b
      ON a.region = b.region AND b.period_start_date = a.period_start_date - INTERVAL 12 MONTH"""
    q["kpi_average"] = f"""SELECT region, {_mean('unemployment_rate_vs_nz_pp')} AS regional_vs_national_gap FROM mart_regional GROUP BY 1"""
    q["kpi_wage_average"] = f"""SELECT {_mean('public_premium_pct')} AS public_sector_premium_pct,
      {_mean('public_vs_private_gap_nzd')} AS wage_gap_nzd FROM mart_wage"""
    q["kpi_status"] = f"""SELECT *, {_by_limit('avg_growth_pct', STATUS_LIMITS)} AS growth_status, {_by_limit('avg_growth_pct', LIGHT_LIMITS)} AS growth_light
    FROM (SELECT CAST(year(period_start_date) AS INTEGER) AS year, {_mean('all_sectors_wage_yoy_growth_pct')} AS avg_growth_pct FROM mart_wage GROUP BY 1)"""
    q["kpi_gap_lights"] = f"""SELECT period_start_date, region, unemployment_rate_vs_nz_pp,
      {_by_limit('unemployment_rate_vs_nz_pp', GAP_LIMITS)} AS gap_light FROM mart_regional"""
    q["kpi_by_year"] = f"""SELECT year_num, {_mean('unemployment_rate_vs_nz_pp')} AS regional_vs_national_gap FROM mart_regional
    WHERE (region IN ('Auckland Region', 'Otago Region') AND period_start_date BETWEEN DATE '1999-01-01' AND DATE '2000-12-31')
      OR year(period_start_date) = 1998 GROUP BY 1"""

    q["kpi_status_card"] = f"""SELECT CAST(year(period_start_date) AS INTEGER) AS year,
      CASE WHEN coalesce({_mean('all_sectors_wage_yoy_growth_pct')}, 0) >= 5 THEN '🟢 Strong'
        WHEN coalesce({_mean('all_sectors_wage_yoy_growth_pct')}, 0) >= 2.5 THEN '🟡 Moderate'
        WHEN coalesce({_mean('all_sectors_wage_yoy_growth_pct')}, 0) >= 0 THEN '🟠 Slow' ELSE '🔴 Declining' END AS growth_status
    FROM mart_wage GROUP BY 1"""
    q["dash_headline"] = f"""SELECT now.period_start_date AS latest_date,
      {_round('now.unemployment_rate_pct', 1)} AS unemployment_rate_pct,
      {_round('now.unemployment_rate_pct - old.unemployment_rate_pct', 1)} AS unemployment_change_pp,
      {_round('now.employment_rate_pct', 1)} AS employment_rate_pct,
      {_round('now.employment_rate_pct - old.employment_rate_pct', 1)} AS employment_change_pp,
      {_round('all_sectors_hourly_wage', 2)} AS hourly_wage_nzd, {_round('all_sectors_yoy_growth_pct', 1)} AS wage_growth_pct,
      now.employed_count AS employed_count, now.employed_count - old.employed_count AS employed_change
    FROM (SELECT * FROM int_regional WHERE region = 'New Zealand' ORDER BY period_start_date DESC LIMIT 1) now
      LEFT JOIN (SELECT * FROM int_regional WHERE region = 'New Zealand') old
        ON old.period_start_date = now.period_start_date - INTERVAL 3 MONTH
      CROSS JOIN (SELECT * FROM int_wage_trends WHERE all_sectors_hourly_wage IS NOT NULL ORDER BY period_start_date DESC LIMIT 1) w"""

    # data checks
    q["dq_sources"] = _check_tables("raw_household", "raw_wages", "raw_monthly")
    q["dq_staging"] = _check_tables("stg_household", "stg_wages", "stg_monthly")
    q["dq_intermediate"] = _check_tables("int_regional", "int_wage_trends")
    q["dq_marts"] = _check_tables("mart_regional", "mart_wage", "mart_industry")
    q["dq_failing_rows"] = """SELECT series_reference, period, region, data_value FROM stg_household
    WHERE NOT regexp_matches(period, '^[0-9]{4}Q[1-4]$')"""
    q["dq_valid_rate"] = """SELECT l_extendedprice, count(*) AS failing_rows FROM lineitem
    WHERE l_extendedprice < 1000 OR l_extendedprice > 100000 GROUP BY 1"""
    q["dq_future_periods"] = """SELECT CAST(l_shipdate AS DATE) AS ship_day, count(*) AS future_rows FROM lineitem
    WHERE CAST(l_shipdate AS DATE) > DATE '2001-07-01' GROUP BY 1"""
    q["dq_duplicates"] = """SELECT series_reference, period, count(*) AS key_rows FROM raw_wages
    GROUP BY 1, 2 HAVING count(*) > 1"""
    rates = "unemployment_rate_pct"
    implausible = ("implausible_unemployment", rates, "error", f"{rates} > 50 AND employment_rate_pct IS NOT NULL")
    not_positive = ("wages_positive", ",".join(_WAGE_COLUMNS), "error", " OR ".join(f"{c} <= 0" for c in _WAGE_COLUMNS))
    rules = {"int_regional": [implausible], "mart_wage": [not_positive]}
    q["build_and_check"] = _with_status(
        [_verdicts(table, declared + rules.get(table, [])) for table, declared in _CHECKS.items()]
    )
    q["dq_singular"] = _with_status(
        [
            _verdicts(
                "int_regional",
                [
                    ("implausible_unemployment", rates, "error", f"{rates} > 4 AND employment_rate_pct IS NOT NULL"),
                    ("unemployment_above_employment", rates, "error", f"{rates} > employment_rate_pct"),
                ],
            ),
            _verdicts("mart_wage", [not_positive]),
        ]
    )
    age = "CASE WHEN {0} - max({1}) <= INTERVAL 100 DAY THEN 'pass' WHEN {0} - max({1}) <= INTERVAL 200 DAY THEN 'warn' ELSE 'error' END"
    q["dq_freshness"] = "\nUNION ALL ".join(
        f"SELECT '{table}' AS table_name, CAST(max({column}) AS DATE) AS last_day, {age.format(now, column)} AS status FROM {table}"
        for table, column, now in (
            ("raw_wages", "_ingested_at", "TIMESTAMP '2002-01-01'"),
            ("raw_household", "_ingested_at", "TIMESTAMP '2002-01-01'"),
            ("events", "ts", "TIMESTAMP '2024-09-01'"),
        )
    )
    q["dq_labels"] = _with_status(
        [
            _verdicts("labels", _nulls("doc_id") + [_labels("quality", "1", "warn")]),
            _verdicts(
                "documents",
                _nulls("text") + [_labels("lang", "'en', 'de'"), _range("n_chars", 100, 10000)],
            ),
        ]
    )

    # policies
    q["mask_values"] = """SELECT role, series_title_2, count(value) AS n_values, count(*) FILTER (WHERE value = -1) AS n_masked, max(value) AS highest
    FROM (SELECT role, series_title_2, CASE WHEN role IN ('ENGINEER_ROLE', 'ANALYST_ROLE') THEN data_value ELSE -1.0 END AS value
      FROM raw_wages CROSS JOIN (VALUES ('ENGINEER_ROLE'), ('ANALYST_ROLE'), ('REPORTER_ROLE'), ('ADMIN_ROLE')) r(role)) GROUP BY 1, 2"""
    q["rows_for_role"] = f"""SELECT role, series_title_3, count(*) AS n
    FROM raw_household CROSS JOIN (VALUES ('ENGINEER_ROLE'), ('ANALYST_ROLE'), ('REPORTER_ROLE'), ('ADMIN_ROLE')) r(role)
    WHERE role IN ('ENGINEER_ROLE', 'ANALYST_ROLE') OR (role = 'REPORTER_ROLE' AND {_NATIONAL}) GROUP BY 1, 2"""
    q["layers_for_role"] = """SELECT role, layer, n FROM (
      SELECT 'raw' AS layer, count(*) AS n FROM raw_wages UNION ALL SELECT 'staging', count(*) FROM stg_wages
      UNION ALL SELECT 'mart', count(*) FROM mart_wage ) t
    JOIN (VALUES ('ENGINEER_ROLE', 'raw'), ('ENGINEER_ROLE', 'staging'), ('ENGINEER_ROLE', 'mart'), ('ANALYST_ROLE', 'staging'),
      ('ANALYST_ROLE', 'mart'), ('REPORTER_ROLE', 'mart')) r(role, readable) ON layer = readable"""

    q["read_as_role"] = """SELECT 'raw_wages' AS table_name, 'ENGINEER_ROLE' AS role, count(*) AS n, max(data_value) AS highest FROM raw_wages
    UNION ALL SELECT 'raw_household', 'ENGINEER_ROLE', count(*), max(data_value) FROM raw_household
    UNION ALL SELECT 'mart_wage', r.role, count(*), max(all_sectors_hourly_wage_nzd) FROM mart_wage
      CROSS JOIN (VALUES ('ENGINEER_ROLE'), ('ANALYST_ROLE'), ('REPORTER_ROLE')) r(role) GROUP BY r.role"""
    q["expired_versions"] = """SELECT DATE '2001-12-31' AS version, count(*) AS n FROM version_day
    UNION ALL SELECT DATE '2002-01-01', count(*) FROM version_now"""

    # snapshots
    q["as_of_read"] = "SELECT series_reference, period, data_value FROM version_week"
    q["snapshot_summary"] = "\nUNION ALL ".join(
        f"SELECT '{name}' AS snapshot, count(*) AS row_count, max(loaded) AS last_ingested,"
        f" min(period) AS earliest_period, max(period) AS latest_period FROM {version}"
        for name, version in (
            ("Current", "version_now"), ("1 hour ago", "version_day"), ("24 hours ago", "version_day"),
        )
    )
    q["snapshot_diff"] = f"""SELECT series_reference, period, current_value, previous_value,
      {_round('current_value - previous_value', 4)} AS value_change,
      CASE WHEN NOT in_previous THEN 'NEW ROW' WHEN NOT in_current THEN 'ROW DELETED' ELSE 'VALUE CHANGED' END AS change_type
    FROM both_versions WHERE NOT in_previous OR NOT in_current OR current_value IS DISTINCT FROM previous_value"""

    q["snapshot_summary_stored"] = q["snapshot_summary"]
    q["snapshot_diff_bucketed"] = q["snapshot_diff"]
    q["global_summary_stored"] = q["global_summary"]
    q["dq_freshness_stored"] = f"SELECT * FROM ({q['dq_freshness']}) WHERE table_name <> 'events'"
    q["sql_macros"] = """SELECT year_quarter_label, region, period_start_date AS starts, CAST(period_start_date + INTERVAL 2 MONTH AS DATE) AS last_month,
      coalesce(unemployment_rate_pct / nullif(employment_rate_pct, 0),
        CASE WHEN employment_rate_pct IS NULL OR employment_rate_pct = 0 THEN -1.0 END) AS share,
      CASE WHEN employment_rate_pct < 2 OR employment_rate_pct > 4
        THEN (SELECT count(*) FROM mart_regional o WHERE o.employment_rate_pct = m.employment_rate_pct) END AS failing_rows,
      CASE WHEN period_start_date > DATE '1998-01-01'
        THEN (SELECT count(*) FROM mart_regional o WHERE o.period_start_date = m.period_start_date) END AS future_rows
    FROM mart_regional m"""
    q["rebuilt_year"] = """SELECT CAST(year(period_start_date) AS INTEGER) AS period_year, CAST(count(wage_nzd) AS BIGINT) AS wages
    FROM stg_wages WHERE year(period_start_date) = 1997 OR series_reference LIKE '%.1' GROUP BY 1"""

    # ingest
    q["normalise_raw"] = _cleaned("NULL")
    q["ingest_archives"] = _cleaned()
    q["ingest_csv_folder"] = _cleaned()
    q["archive_members"] = """SELECT 'part.csv' AS member, 'series' AS status, count(*) AS n_rows FROM raw_household
    UNION ALL SELECT 'no period.csv', 'no period column', 0 UNION ALL SELECT 'broken.csv', 'unreadable', 0"""
    q["archive_source"] = _cleaned()
    q["archive_source_report"] = q["archive_members"]
    q["load_metadata"] = """SELECT series_reference, period, true AS has_file, 'household' AS source_name, DATE '2002-01-01' AS loaded_on
    FROM raw_household"""
    q["ingest_report"] = """SELECT source_name, target_table, status, CASE WHEN target_table IS NULL THEN 0 ELSE n END AS rows_loaded, message
    FROM (SELECT count(*) AS n FROM raw_household ) t CROSS JOIN (VALUES ('household', 'raw_household', 'SUCCESS', CAST(NULL AS VARCHAR)),
      ('wages', 'raw_wages', 'SUCCESS', NULL), ('spare', NULL, 'SKIPPED', 'no target table')) v(source_name, target_table, status, message)"""
    q["ingest_audit"] = """SELECT 'raw_household' AS table_name, count(*) AS rows_loaded, 'household' AS source_files, 'SUCCESS' AS status FROM raw_household
    UNION ALL SELECT 'raw_unknown', 0, 'household', 'FAILED'"""
    q["stored_table"] = _stg_household(start=1998)
    q["incremental_latest"] = """SELECT series_reference, period, arg_max(data_value, loaded) AS data_value, max(loaded) AS _ingested_at FROM (
      SELECT * FROM version_week UNION ALL SELECT * FROM version_day UNION ALL SELECT * FROM version_now ) GROUP BY 1, 2"""

    return {name: _with_steps(sql) for name, sql in q.items()}
