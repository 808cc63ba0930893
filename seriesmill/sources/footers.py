"""A9, T2 and D10 from the footers of stored files.

Parquet keeps the smallest and largest number of each column chunk and its rows. Spark's
second reader answers MIN, MAX and COUNT from them without reading a row, for numbers and
dates, but not for texts and timestamps. A table that is written here has these as
numbers, too: the load time in microseconds, and the label as the number that its
first eight bytes are, which is in the order of the text. A file without any value of a
column has no such footer, so these numbers are never NULL: where there is none, they are
the one that no other row's can be beyond.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.operators import aggregates

LOADED, LOW, HIGH, LABEL_BYTES = "_loaded_us", "_label_low", "_label_high", "_label_bytes"
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1
_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"
_CODED_BYTES = 8


def label_number(label: Column) -> Column:
    """Number of a label of up to eight bytes that starts with an ASCII letter; in the order of the text."""
    return F.conv(F.rpad(F.hex(label), 2 * _CODED_BYTES, "0"), 16, 10).try_cast("bigint")


def label_of(number: Column) -> Column:
    """The label of a number."""
    digits = F.lpad(F.hex(number), 2 * _CODED_BYTES, "0")
    return F.unhex(F.regexp_replace(digits, "(00)+$", "")).cast("string")


def write(df: DataFrame, path: str, loaded_at: str = "_ingested_at", period: str = "period") -> None:
    """Store a table whose summary its footers can give."""
    number, label = label_number(F.col(period)), F.col(period)
    coded = (number.isNotNull() & label_of(number).eqNullSafe(label)) | label.isNull()
    df.withColumns(
        {
            LOADED: F.expr(f"coalesce(timestampdiff(MICROSECOND, {_EPOCH}, cast(`{loaded_at}` as timestamp_ntz)), {_LEAST})"),
            LOW: F.coalesce(number, F.lit(_MOST)),
            HIGH: F.coalesce(number, F.lit(_LEAST)),
            LABEL_BYTES: F.when(coded, F.lit(0)).otherwise(F.octet_length(period) + _CODED_BYTES),
        }
    ).write.parquet(path)


def reader(spark: SparkSession) -> SparkSession:
    """A session of the same application that reads Parquet by the second reader and asks footers."""
    session = spark.newSession()
    for name in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        session.conf.set(name, spark.conf.get(name))
    old = session.conf.get("spark.sql.sources.useV1SourceList").split(",")
    session.conf.set("spark.sql.sources.useV1SourceList", ",".join(n for n in old if n != "parquet"))
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session


def extremes(session: SparkSession, path: str) -> DataFrame:
    """Rows, and least and greatest of the numbers, from footers alone; `session` is a `reader`."""
    found = session.read.parquet(path).agg(
        F.count("*").alias("row_count"), F.max(LOADED).alias("newest"), F.min(LOW).alias("least"),
        F.max(HIGH).alias("greatest"), F.max(LABEL_BYTES).alias("uncoded"),
    )
    known = {name: F.nullif(F.col(name), F.lit(_MOST if name == "least" else _LEAST)) for name in ("newest", "least", "greatest")}
    # Spark takes a pushed count for never NULL, which it is for a table without rows.
    rows = F.coalesce(F.nullif("row_count", F.lit(-1)), F.lit(0))
    return found.withColumns(known | {"row_count": rows})


def _time(micros: str) -> Column:
    return F.expr(f"timestampadd(MICROSECOND, `{micros}`, {_EPOCH})")


def summary(session: SparkSession, path: str) -> DataFrame:
    """`aggregates.table_summary` of a stored table, also of an empty one.

    Labels that have no number are read instead; the footers say whether there are any.
    """
    found = extremes(session, path)
    if found.first().uncoded:
        return aggregates.table_summary(session.read.parquet(path))
    return found.select(
        "row_count", _time("newest").alias("last_ingested"),
        label_of(F.col("least")).alias("earliest_period"), label_of(F.col("greatest")).alias("latest_period"),
    )


def newest_load(session: SparkSession, path: str) -> DataFrame:
    """One row with the newest load time as `_ingested_at`, for `quality.freshness`."""
    return extremes(session, path).select(_time("newest").alias("_ingested_at"))
