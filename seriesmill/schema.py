"""Table shapes and the label values that the models look for."""

from __future__ import annotations

from pyspark.sql import types as T

# The fourteen columns of a raw series table, in file order.
SERIES_COLUMNS = [
    "series_reference",
    "period",
    "data_value",
    "suppressed",
    "status",
    "units",
    "magnitude",
    "subject",
    "group_name",
    "series_title_1",
    "series_title_2",
    "series_title_3",
    "series_title_4",
    "series_title_5",
]

# Header spellings found in published files.
HEADER_SPELLINGS = {
    "Series_reference": "series_reference",
    "Series Reference": "series_reference",
    "Period": "period",
    "Data_value": "data_value",
    "Data value": "data_value",
    "Suppressed": "suppressed",
    "STATUS": "status",
    "Status": "status",
    "UNITS": "units",
    "Units": "units",
    "Magnitude": "magnitude",
    "Subject": "subject",
    "Group": "group_name",
    "Series_title_1": "series_title_1",
    "Series_title_2": "series_title_2",
    "Series_title_3": "series_title_3",
    "Series_title_4": "series_title_4",
    "Series_title_5": "series_title_5",
}

# Tokens a CSV reader of string columns treats as missing.
CSV_MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Tokens that mean "no value" after white space is removed.
NULL_TOKENS = ["", "..", "N/A"]

# Member names holding one of these words carry no series.
SKIPPED_MEMBER_WORDS = ["footnote", "metadata", "notes"]

# Raw text frame: what a file yields before any cast.
TEXT_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in SERIES_COLUMNS]
    + [T.StructField("_source_file", T.StringType())]
)

_TYPES = {"data_value": T.DoubleType(), "magnitude": T.IntegerType()}

# Typed raw table, the same for all surveys.
RAW_SCHEMA = T.StructType(
    [T.StructField(name, _TYPES.get(name, T.StringType())) for name in SERIES_COLUMNS]
    + [
        T.StructField("_ingested_at", T.TimestampNTZType()),
        T.StructField("_source_file", T.StringType()),
        T.StructField("_source_name", T.StringType()),
    ]
)

RAW_TABLES = {
    "raw_household": RAW_SCHEMA,
    "raw_wages": RAW_SCHEMA,
    "raw_monthly": RAW_SCHEMA,
}

# Title column -> dimension name, per survey.
HOUSEHOLD_LAYOUT = {
    "series_title_1": "measure_name",
    "series_title_2": "sex",
    "series_title_3": "region",
    "series_title_4": "age_group",
    "series_title_5": "adjustment_type",
}
WAGE_LAYOUT = {
    "series_title_1": "wage_measure",
    "series_title_2": "sector",
    "series_title_3": "industry_anzsic",
}
MONTHLY_LAYOUT = {
    "series_title_1": "measure_name",
    "series_title_2": "industry",
    "series_title_3": "region",
    "series_title_4": "adjustment_type",
}
# The dashboard reads the wage titles in another order.
WAGE_DASHBOARD_LAYOUT = {
    "series_title_1": "sector",
    "series_title_2": "sex",
    "series_title_3": "wage_type",
}

DEFAULT_START_YEAR = 2015

# Canonical regional council areas.
REGIONS = [
    "Auckland Region",
    "Wellington Region",
    "Canterbury Region",
    "Waikato Region",
    "Bay of Plenty Region",
    "Otago Region",
    "Hawke's Bay Region",
    "Manawatū-Whanganui Region",
    "Northland Region",
    "Taranaki Region",
    "Gisborne Region",
    "Tasman Region",
    "Nelson Region",
    "Marlborough Region",
    "West Coast Region",
    "Southland Region",
]

# Regions shown by the dashboard (short spelling).
DASHBOARD_REGIONS = [
    "Auckland", "Wellington", "Canterbury", "Waikato", "Bay of Plenty",
    "Otago", "Northland", "Manawatu-Whanganui", "Southland", "Taranaki",
    "Hawke's Bay", "Gisborne", "Nelson",
]
LATEST_RANK_REGIONS = [
    "Auckland", "Wellington", "Canterbury", "Waikato", "Bay of Plenty",
    "Otago", "Northland", "Manawatu-Whanganui", "Southland", "Taranaki",
    "Hawke's Bay",
]

# Labels of national rows and totals.
NATIONAL_REGIONS = ["New Zealand", "Total New Zealand"]
DASHBOARD_NATIONAL_REGIONS = ["New Zealand", "Total All Regional Councils"]
TOTAL_INDUSTRIES = ["", "All Industries", "Total"]
BOTH_SEXES = ["Total Both Sexes", "Total"]
