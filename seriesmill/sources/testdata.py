"""The supplied order tables read as raw labour series.

Three mappings give the raw long format (one row per series and period) so that
every model has input of any size. `since` is pushed to the parquet scan as a
date filter.
"""

from __future__ import annotations

import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill import schema
from seriesmill.functions import periods
from seriesmill.functions.labels import ladder
from seriesmill.schema import SERIES_COLUMNS
from seriesmill.session import ship_package
from seriesmill.sources.archives import locate


# Column types of the supplied tables. Stating them saves the job
# that reads file footers to find the schema.
TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """S19."""
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def _from_year(df: DataFrame, column: str, since: int | None) -> DataFrame:
    if since is None:
        return df
    return df.filter(F.col(column) >= F.lit(f"{since}-01-01 00:00:00").cast("timestamp_ntz"))


def _raw(df: DataFrame, file_name: str, loaded_at: Column, **columns: Column) -> DataFrame:
    """Fill the raw shape; columns that are not given are NULL."""
    given = {"status": F.lit("F"), "subject": F.lit("Test survey"), "group_name": F.lit("All"), **columns}
    types = {field.name: field.dataType for field in schema.RAW_SCHEMA}
    return df.select(
        *(given.get(name, F.lit(None)).cast(types[name]).alias(name) for name in SERIES_COLUMNS),
        loaded_at.alias("_ingested_at"),
        F.lit(file_name).alias("_source_file"),
    )


def region_label(nation_key: Column, nation_name: Column) -> Column:
    """Nations 0 to 15 stand for the canonical regions, 16 for the nation, 17 has no label."""
    canonical = F.element_at(F.array(*(F.lit(r) for r in schema.REGIONS)), nation_key + 1)
    return ladder(
        [
            (nation_key < len(schema.REGIONS), canonical),
            (nation_key == 16, "New Zealand"),
            (nation_key != 17, nation_name),
        ]
    )


def wages(spark: SparkSession, folder: str, since: int | None = None) -> DataFrame:
    """Wage series, one row per line item; the value is a thousandth of the price."""
    lines = _from_year(table(spark, folder, "lineitem"), "l_shipdate", since)
    parts = table(spark, folder, "part").select("p_partkey", "p_brand")
    lines = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
    industry = ladder(
        [
            (F.col("p_brand") == "Brand#1", "All Industries"),
            (F.col("p_brand") == "Brand#2", " Total "),
            (F.col("p_brand") != "Brand#3", F.col("p_brand")),
        ]
    )
    flag, quantity = F.col("l_returnflag"), F.col("l_quantity")
    return _raw(
        lines,
        "lineitem.parquet",
        F.col("l_shipdate"),
        series_reference=F.concat_ws(".", F.lit("W"), "l_orderkey", "l_linenumber"),
        period=periods.quarter_label(F.year("l_shipdate"), F.quarter("l_shipdate")),
        data_value=F.when(quantity == 2, F.lit(0.0)).when(
            quantity != 1, F.col("l_extendedprice") / F.lit(1000.0)
        ),
        units=F.lit("Dollars"),
        magnitude=F.lit(1),
        series_title_1=F.when(
            F.col("l_linestatus") == "F", F.lit("Average Ordinary Time Hourly Earnings")
        ).otherwise(F.lit("Average Weekly Earnings")),
        series_title_2=ladder(
            [(flag == "A", "Private Sector"), (flag == "N", "Public Sector"), (flag == "R", "All Sectors")]
        ),
        series_title_3=industry,
    )


def dashboard_wages(spark: SparkSession, folder: str, since: int | None = None) -> DataFrame:
    """Wage series with the titles in the order that the dashboard reads."""
    raw = wages(spark, folder, since)
    line = F.element_at(F.split("series_reference", "[.]"), -1).cast("int")
    return raw.withColumns(
        {
            "series_title_1": F.col("series_title_2"),
            "series_title_2": ladder([(line <= 4, "Total Both Sexes"), (line <= 6, "Female")], "Male"),
            "series_title_3": F.col("series_title_1"),
        }
    )


def _orders_by_nation(spark: SparkSession, folder: str, since: int | None) -> DataFrame:
    orders = _from_year(table(spark, folder, "orders"), "o_orderdate", since)
    customers = table(spark, folder, "customer").select(
        "c_custkey", "c_nationkey", "c_mktsegment"
    )
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))


def _with_nation_name(df: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
    return df.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))


def _cents() -> Column:
    return F.sum(F.rint(F.col("o_totalprice") * 100).cast("bigint"))


def household(spark: SparkSession, folder: str, since: int | None = None) -> DataFrame:
    """Household series: mean order value per quarter, nation, priority and status.

    Priority names the measure and status the sex. Nation 23 reports in another
    period form, nation 24 has a wrong quarter digit in its last quarter, nations
    3 and 4 lack their underutilisation rates (one of them confidential).
    """
    year, quarter = F.year("o_orderdate"), F.quarter("o_orderdate")
    grouped = (
        _orders_by_nation(spark, folder, since)
        .groupBy(
            year.alias("y"), quarter.alias("q"), "c_nationkey", "o_orderpriority", "o_orderstatus"
        )
        .agg(_cents().alias("cents"), F.count("*").alias("n"), F.max("o_orderdate").alias("at"))
    )
    grouped = _with_nation_name(grouped, spark, folder)
    priority = F.left("o_orderpriority", F.lit(1)).cast("int")
    nation = F.col("c_nationkey")
    mean = F.col("cents").cast("double") / F.col("n").cast("double") / F.lit(1e6)
    value = F.when(priority == 2, mean / F.lit(10.0)).otherwise(mean)
    status = F.col("o_orderstatus")
    return _raw(
        grouped,
        "orders.parquet",
        F.col("at"),
        series_reference=F.concat_ws(".", F.lit("H"), nation, priority, status),
        period=ladder(
            [
                (nation == 23, periods.month_label(F.col("y"), F.col("q"))),
                ((nation == 24) & (F.col("q") == 4), F.concat(F.col("y").cast("string"), F.lit("Q9"))),
            ],
            periods.quarter_label(F.col("y"), F.col("q")),
        ),
        data_value=F.when((priority != 4) | ~nation.isin(3, 4), value),
        suppressed=F.when(priority == 4, F.when(nation == 3, F.lit("S")).otherwise(F.lit(""))),
        units=F.when(priority == 5, F.lit("Number")).otherwise(F.lit("Percent")),
        magnitude=F.when(priority == 5, F.lit(1000)).otherwise(F.lit(1)),
        series_title_1=ladder(
            [
                (priority == 1, "Employment Rate"),
                (priority == 2, "Unemployment Rate"),
                (priority == 3, "Labour Force Participation Rate"),
                (priority == 4, "Underutilisation Rate"),
                (status == "P", "Unemployed"),
            ],
            "Employed",
        ),
        series_title_2=ladder([(status == "F", "Male"), (status == "O", "Total Both Sexes")], "Total"),
        series_title_3=region_label(nation, F.col("n_name")),
        series_title_4=F.lit("All ages"),
        series_title_5=F.when(
            (status == "P") & (priority == 3), F.lit("Seasonally Adjusted")
        ).otherwise(F.lit("Unadjusted")),
    )


def monthly(spark: SparkSession, folder: str, since: int | None = None) -> DataFrame:
    """Monthly series: order value per month, nation, market segment and status."""
    year, month = F.year("o_orderdate"), F.month("o_orderdate")
    grouped = (
        _orders_by_nation(spark, folder, since)
        .groupBy(
            year.alias("y"), month.alias("m"), "c_nationkey", "c_mktsegment", "o_orderstatus"
        )
        .agg(_cents().alias("cents"), F.max("o_orderdate").alias("at"))
    )
    grouped = _with_nation_name(grouped, spark, folder)
    status, nation = F.col("o_orderstatus"), F.col("c_nationkey")
    return _raw(
        grouped,
        "orders.parquet",
        F.col("at"),
        series_reference=F.concat_ws(".", F.lit("M"), nation, "c_mktsegment", status),
        period=periods.month_label(F.col("y"), F.col("m")),
        data_value=F.col("cents").cast("double") / F.lit(100.0),
        units=F.when(status == "F", F.lit("Number")).otherwise(F.lit("Dollars")),
        magnitude=F.when(status == "F", F.lit(1000)).otherwise(F.lit(1)),
        series_title_1=ladder(
            [(status == "F", "Filled jobs"), (status == "O", "Gross earnings")], "Paid hours"
        ),
        series_title_2=F.col("c_mktsegment"),
        series_title_3=region_label(nation, F.col("n_name")),
        series_title_4=F.when(
            F.col("c_mktsegment") == "MACHINERY", F.lit("Seasonally adjusted")
        ).otherwise(F.lit("Actual")),
    )


def _write_mixed(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """One archive per partition: the rows as a good member, and again as members of other kinds."""
    tables = [batch.to_pandas() for batch in batches if batch.num_rows]
    if not tables:
        return
    storage, inner = locate(folder)
    storage.create_dir(inner, recursive=True)
    path = f"{inner}/mixed-{TaskContext.get().partitionId():05d}.zip"
    lines = [table.to_csv(index=False, header=n == 0) for n, table in enumerate(tables)]
    whole = "".join(lines)
    members = {
        "part.csv": whole,
        "no period.csv": whole.replace("Period", "Time", 1),
        "broken.csv": whole + "," * 40 + "x\n",
        "PART.CSV": whole,
        "footnotes.csv": whole,
        "Metadata 2001.csv": whole,
        "my notes.csv": whole,
        "readme.txt": "no table",
    }
    with storage.open_output_stream(path) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, content in members.items():
            archive.writestr(name, content)
    yield pa.RecordBatch.from_pydict({"archive": [path]})


def write_mixed_archives(df: DataFrame, folder: str) -> DataFrame:
    """Archives with members that the reader must take, skip or refuse; returns their paths."""
    ship_package(df.sparkSession)
    return df.mapInArrow(lambda batches: _write_mixed(batches, folder), "archive string")
