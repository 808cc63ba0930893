"""Reading and comparing versions of a table.

These functions take a table that holds several versions side by side, told
apart by `snapshot_ts`. `sources.tables.TableStore` keeps loads in partitions and
reads one of them without touching the others.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.functions import labels, numbers
from seriesmill.operators import aggregates, joins

VERSION = "snapshot_ts"


def _stamp(at: dt.datetime) -> Column:
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def as_of(versions: DataFrame, at: dt.datetime, known: Sequence[dt.datetime] | None = None) -> DataFrame:
    """Rows of the newest version not after `at`.

    With `known` version times the choice is a constant, which prunes partitions;
    otherwise a scalar subquery finds it.
    """
    if known is not None:
        usable = [v for v in known if v <= at]
        chosen = _stamp(max(usable)) if usable else F.lit(None)
    else:
        chosen = versions.filter(F.col(VERSION) <= _stamp(at)).agg(F.max(VERSION)).scalar()
    return versions.filter(F.col(VERSION) == chosen)


def offset_back(now: dt.datetime, seconds: int) -> dt.datetime:
    """The moment `seconds` before `now`."""
    return now - dt.timedelta(seconds=seconds)


def summary(snapshots: dict[str, DataFrame]) -> DataFrame:
    """One line per named snapshot, duplicates kept."""
    lines = [
        aggregates.table_summary(df).select(F.lit(name).alias("snapshot"), "*")
        for name, df in snapshots.items()
    ]
    return reduce(DataFrame.unionByName, lines)


def diff(
    current: DataFrame,
    previous: DataFrame,
    keys: Sequence[str] = ("series_reference", "period"),
    value: str = "data_value",
) -> DataFrame:
    """New, deleted and changed rows; unchanged rows do not appear."""
    return _changes(joins.full_outer_on_keys(current, previous, keys, value), keys)


@dataclass(frozen=True)
class Bucketed:
    """A version of a table as two stored tables: rows bucketed and sorted by the keys, and rows with a NULL key."""

    rows: DataFrame
    incomplete: DataFrame


def diff_of_buckets(
    current: Bucketed,
    previous: Bucketed,
    keys: Sequence[str] = ("series_reference", "period"),
    value: str = "data_value",
) -> DataFrame:
    """T3 for versions that are bucketed alike: bucket is merged with bucket, and no row is shuffled or sorted."""
    both = joins.full_outer_of_buckets(current.rows, previous.rows, keys, value)
    nothing = F.lit(None).cast(current.rows.schema[value].dataType)
    unmatched = [
        version.incomplete.select(
            *keys, (F.col(value) if new else nothing).alias("current_value"), (nothing if new else F.col(value)).alias("previous_value"),
            F.lit(new).alias("in_current"), F.lit(not new).alias("in_previous"),
        )
        for version, new in ((current, True), (previous, False))
    ]
    return _changes(both.unionByName(unmatched[0]).unionByName(unmatched[1]), keys)


def _changes(both: DataFrame, keys: Sequence[str]) -> DataFrame:
    kind = labels.change_type(
        F.col("in_current"), F.col("in_previous"), F.col("current_value"), F.col("previous_value")
    )
    return both.withColumn("change_type", kind).filter("change_type <> 'UNCHANGED'").select(
        *keys,
        "current_value",
        "previous_value",
        numbers.point_gap(F.col("current_value"), F.col("previous_value"), 4).alias("value_change"),
        "change_type",
    )
