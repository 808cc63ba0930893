"""From all-text series rows to the typed raw table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill import schema
from seriesmill.functions import numbers, text

def canonical_columns(df: DataFrame, spellings: dict[str, str] = schema.HEADER_SPELLINGS) -> DataFrame:
    """One file's columns under their canonical names.

    Two spellings of one column in the same file are merged, the first one that
    has a value wins. Missing columns become NULL, unknown ones drop.
    """
    sources: dict[str, list[str]] = {name: [] for name in schema.SERIES_COLUMNS}
    places = {}
    for place, column in enumerate(df.columns):
        # By place, because names that differ in case only are ambiguous to Spark.
        places[f"c{place}"] = name = spellings.get(column, column)
        if name in sources:
            sources[name].append(f"c{place}")
    lineage = [place for place, name in places.items() if name == "_source_file"]
    df = df.toDF(*places)

    def merged(name: str) -> Column:
        found = [F.col(place) for place in sources[name]]
        value = F.coalesce(*found) if found else F.lit(None)
        return value.cast("string").alias(name)

    return df.select(
        *(merged(name) for name in schema.SERIES_COLUMNS),
        *(F.col(place).alias("_source_file") for place in lineage),
    )


def union_files(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of several files; each frame was normalised on its own before."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first


def typed_rows(rows: DataFrame) -> DataFrame:
    """Parse the numbers, strip the strings, null the missing-value tokens.

    Stripping is a projection of its own, because the token test would otherwise
    evaluate it twice for every value.
    """
    stripped = rows.select(*(text.strip(F.col(name)).alias(name) for name in rows.columns))
    parsers = {"data_value": numbers.parse_value, "magnitude": numbers.parse_magnitude}
    return stripped.select(
        *(parsers.get(name, text.null_if_token)(F.col(name)).alias(name) for name in rows.columns)
    )


def with_load_metadata(
    rows: DataFrame, source_name: str, loaded_at: dt.datetime | None = None
) -> DataFrame:
    """Load time in UTC and source name; the file name of each row stays."""
    at = loaded_at or dt.datetime.now(dt.timezone.utc)
    if at.tzinfo is not None:
        at = at.astimezone(dt.timezone.utc).replace(tzinfo=None)
    stamp = F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")
    return rows.withColumns({"_ingested_at": stamp, "_source_name": F.lit(source_name)})


def to_table_schema(rows: DataFrame, table_name: str) -> DataFrame:
    """Exact column order and types; an unknown table is an error."""
    if table_name not in schema.RAW_TABLES:
        raise ValueError(f"no schema defined for table: {table_name}")
    fields = schema.RAW_TABLES[table_name].fields
    have = set(rows.columns)
    return rows.select(
        *(
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in fields
        )
    )
