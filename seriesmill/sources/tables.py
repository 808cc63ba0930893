"""Stored tables in the catalog: loads side by side, models by year, audit lines.

A store is a database at a folder of its own. A raw table holds its loads side by side,
as partitions named by the time of the load, and each load is partitioned by the year of
the period. A reader takes the newest load, or the newest one up to a moment. A model is
partitioned by year only, and a build replaces the years that it writes. All of it is
ordinary Parquet tables, which any Spark job with the same catalog reads by name.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import logging
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyarrow.fs import FileType
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.functions import periods
from seriesmill.operators import policies, quality, snapshots
from seriesmill.session import scratch_path
from seriesmill.sources import normalise
from seriesmill.sources.archives import locate

log = logging.getLogger(__name__)

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("log_id", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("run_timestamp", T.TimestampNTZType()),
        T.StructField("rows_loaded", T.LongType()),
        T.StructField("source_files", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("duration_secs", T.DoubleType()),
    ]
)
LOG = "ingestion_log"
#: Partition columns: the load, and the year of a row's period.
LOAD, YEAR = "load", "period_year"
_STAMP = "%Y%m%dT%H%M%S%f"


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def _with_year(df: DataFrame) -> DataFrame:
    """Add the year that partitions a table, from its period or its date."""
    if "period" in df.columns:
        return df.withColumn(YEAR, periods.year_of(F.col("period")))
    if "period_start_date" in df.columns:
        return df.withColumn(YEAR, F.year("period_start_date"))
    return df


def _laid_out(df: DataFrame) -> DataFrame:
    """Rows by year and, inside the files, by period.

    The rebalance hint lets Spark gather small years and split a year that holds most
    rows over several writers; a period filter skips row groups.
    """
    if YEAR not in df.columns:
        return df
    inside = [name for name in ("period", "period_start_date") if name in df.columns]
    return df.hint("rebalance", YEAR).sortWithinPartitions(YEAR, *inside)


@dataclass(frozen=True)
class TableStore:
    """Named tables below one folder that all executors reach."""

    spark: SparkSession
    root: str

    @property
    def database(self) -> str:
        """Name of the database that stands for the folder."""
        return "store_" + hashlib.sha1(self.root.encode()).hexdigest()[:16]

    def full_name(self, name: str) -> str:
        """Name of a table for `spark.table` and SQL."""
        return f"{self.database}.`{name}`"

    def _exists(self, name: str) -> bool:
        """Whether the table is in the catalog; one that an earlier session left in the folder is entered again.

        The latter is for sessions whose catalog ends with them. Such a table is external:
        dropping a partition of it leaves the files.
        """
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION '{self.root}'")
        if self.spark.catalog.tableExists(f"{self.database}.{name}"):
            return True
        storage, folder = locate(f"{self.root}/{name}")
        if storage.get_file_info(folder).type != FileType.Directory:
            return False
        try:
            columns = self.spark.read.parquet(f"{self.root}/{name}").columns
        except AnalysisException:  # no file in it
            return False
        self.spark.sql(f"CREATE TABLE {self.full_name(name)} USING parquet LOCATION '{self.root}/{name}'")
        if {LOAD, YEAR} & set(columns):
            self.spark.sql(f"MSCK REPAIR TABLE {self.full_name(name)}")
        return True

    def _ready(self, df: DataFrame, name: str, by: Sequence[str]) -> list[str]:
        """Make the table if there is none, and return its columns, the partitions' last."""
        if not self._exists(name):
            fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
            layout = f"PARTITIONED BY ({', '.join(by)})" if by else ""
            self.spark.sql(f"CREATE TABLE {self.full_name(name)} ({fields}) USING parquet {layout}")
        return self.spark.table(self.full_name(name)).columns

    def _drop(self, name: str, partitions: Sequence[str]) -> None:
        """Drop partitions, given as the catalog prints them."""

        def spec(partition: str) -> str:
            pairs = (part.split("=", 1) for part in partition.split("/"))
            return ", ".join(f"{c} = " + ("NULL" if v.startswith("__HIVE_DEFAULT") else f"'{v}'") for c, v in pairs)

        if partitions:
            listed = ", ".join(f"PARTITION ({spec(p)})" for p in partitions)
            self.spark.sql(f"ALTER TABLE {self.full_name(name)} DROP {listed}")

    def _partitions(self, name: str, load: str | None = None) -> list[str]:
        """Partitions of a table, or of one of its loads, from the catalog."""
        which = f" PARTITION ({LOAD} = '{load}')" if load else ""
        return [row.partition for row in self.spark.sql(f"SHOW PARTITIONS {self.full_name(name)}{which}").collect()]

    # --- raw tables and reports: loads side by side ---------------------------

    def write(self, df: DataFrame, name: str, at: dt.datetime | None = None) -> int:
        """A whole new load of a table, which readers take from then on; returns its rows.

        Loads never change, so a plan may read the table that it replaces.
        """
        return self.write_checked(df, name, (), at)[0]

    def write_checked(
        self, df: DataFrame, name: str, checks: Sequence[quality.Check], at: dt.datetime | None = None
    ) -> tuple[int, DataFrame | None]:
        """As `write`, with the verdicts of checks that are counted while the rows are written.

        Rows and failures are observed in the tasks that write, whose results Spark takes
        once however often they are tried, so nothing is read back. Spark's committer shows
        the files when the job has ended, so a failed load changes nothing.
        """
        load = f"{at or utc_now():{_STAMP}}-{utc_now():{_STAMP}}"
        rows = _laid_out(_with_year(df)).withColumn(LOAD, F.lit(load))
        by = [c for c in (LOAD, YEAR) if c in rows.columns]
        columns = self._ready(rows, name, by)
        seen = Observation()
        rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), *quality.counters(checks))
        rows.select(*columns).write.insertInto(self.full_name(name))
        if seen.get["rows"] == 0:  # no file says so, but the catalog does
            values = ", ".join([f"{LOAD} = '{load}'", f"{YEAR} = 0"][: len(by)])
            self.spark.sql(f"ALTER TABLE {self.full_name(name)} ADD IF NOT EXISTS PARTITION ({values})")
        return seen.get["rows"], quality.verdicts(self.spark, name, checks, seen.get) if checks else None

    def versions(self, name: str) -> list[Row]:
        """(snapshot_ts, load) of all loads, oldest first, from the catalog's list of partitions.

        A model has one version, without a time.
        """
        if not self._exists(name):
            return []
        if LOAD not in self.spark.table(self.full_name(name)).columns:
            return [Row(snapshot_ts=None, load=None)]
        loads = {p.split("/")[0].partition("=")[2] for p in self._partitions(name)}
        return [Row(snapshot_ts=dt.datetime.strptime(load.partition("-")[0], _STAMP), load=load) for load in sorted(loads)]

    def _newest(self, name: str, as_of: dt.datetime | None = None) -> str | None:
        known = [v.load for v in self.versions(name) if as_of is None or v.snapshot_ts <= as_of]
        return max(known, default=None)

    def has(self, name: str, as_of: dt.datetime | None = None) -> bool:
        """Whether there is a load to read."""
        return self._newest(name, as_of) is not None

    def read(self, name: str, as_of: dt.datetime | None = None, role: str | None = None) -> DataFrame:
        """A model, or the newest load of a table, or the newest one not after `as_of`.

        With `role`, the policies of the table apply (R1 to R3): a role that may not read
        the table's layer is refused, and so is an unknown one. Jobs of the store itself
        read without a role.
        """
        if not self._exists(name):
            raise LookupError(f"there is no table {name}")
        rows = self.spark.table(self.full_name(name))
        if LOAD in rows.columns:
            newest = self._newest(name, as_of)
            if newest is None:
                raise LookupError(f"table {name} has no load at {as_of}")
            rows = rows.filter(F.col(LOAD) == newest).drop(LOAD)
        return rows if role is None else policies.as_role(rows, name, role)

    def read_offset(self, name: str, seconds: int, now: dt.datetime | None = None) -> DataFrame:
        """The table as it was `seconds` ago."""
        return self.read(name, (now or utc_now()) - dt.timedelta(seconds=seconds))

    def retained(self, name: str, days: int, now: dt.datetime | None = None) -> list[Row]:
        """loads inside the retention window, and always the newest one."""
        floor = (now or utc_now()) - dt.timedelta(days=days)
        known = self.versions(name)
        return [v for v in known if v.snapshot_ts >= floor] or known[-1:]

    def expire(self, name: str, days: int, now: dt.datetime | None = None) -> int:
        """drop the loads beyond the retention window; returns how many."""
        kept = {v.load for v in self.retained(name, days, now)}
        gone = [v.load for v in self.versions(name) if v.load not in kept]
        for load in gone:
            self._drop(name, self._partitions(name, load))
        return len(gone)

    # --- models: replaced by year ----------------------------------------------

    def write_model(
        self,
        df: DataFrame,
        name: str,
        checks: Sequence[quality.Check] = (),
        years: Sequence[int] | None = None,
    ) -> DataFrame | None:
        """Replace a model, or only the given years of it; returns the verdicts of its checks.

        Partitions are overwritten one by one when the write has ended. A full build also
        drops the years that the model no longer has. Checks count what is written.
        """
        rows = _with_year(df)
        if YEAR not in rows.columns:
            years = None
        if years is not None:
            rows = rows.filter(F.col(YEAR).isin(list(years)))
        by = [YEAR] if YEAR in rows.columns else []
        columns = self._ready(rows, name, by)
        seen = Observation()
        spans = [F.collect_set(YEAR).alias("years")] if by else []
        counters = [F.count(F.lit(1)).alias("rows"), *spans, *quality.counters(checks)]
        writer = _laid_out(rows).observe(seen, *counters).select(*columns).write.mode("overwrite")
        if by:
            # By path, as an insert by name takes its mode from the session, where a
            # change would reach other writers.
            writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(YEAR)
            writer.parquet(f"{self.root}/{name}")
            self.spark.sql(f"MSCK REPAIR TABLE {self.full_name(name)}")
            self.spark.catalog.refreshTable(self.full_name(name))
            have = {f"{YEAR}={year}" for year in seen.get["years"]}
            stale = [p for p in self._partitions(name) if p not in have and "__HIVE_DEFAULT" not in p]
            replaced = stale if years is None else [p for p in stale if p in {f"{YEAR}={year}" for year in years}]
            self._drop(name, replaced)
        else:
            writer.insertInto(self.full_name(name))
        return quality.verdicts(self.spark, name, checks, seen.get) if checks else None

    # --- versions that are compared: bucketed by their keys ----------------------

    def write_bucketed(self, df: DataFrame, name: str, keys: Sequence[str], buckets: int) -> None:
        """Store a version so that it can be compared without a shuffle.

        One file per bucket, sorted by the keys. Rows with a NULL key, which match nothing,
        are a table of their own, as they would all be in one bucket.
        """
        self._exists(name)
        missing = F.lit(False)
        for key in keys:
            missing = missing | F.col(key).isNull()
        rows = df.filter(~missing).repartition(buckets, *keys).sortWithinPartitions(*keys)
        rows.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(f"{self.database}.{name}")
        df.filter(missing).write.mode("overwrite").saveAsTable(f"{self.database}.{name}_incomplete")

    def bucketed(self, name: str) -> snapshots.Bucketed:
        """A version that `write_bucketed` has stored."""
        return snapshots.Bucketed(*(self.spark.table(f"{self.database}.{n}") for n in (name, f"{name}_incomplete")))

    # --- audit ---------------------------------------------------------------

    def log_run(
        self,
        table_name: str,
        rows: int,
        source_files: str,
        status: str,
        error: str | None,
        seconds: float,
    ) -> None:
        """Append one audit line; trouble with the log never fails a load."""
        line = (
            str(uuid.uuid4()), table_name, utc_now(), rows, source_files, status,
            error[:2000] if error else None, float(seconds),
        )
        try:
            lines = self.spark.createDataFrame([line], AUDIT_SCHEMA).coalesce(1)
            self._ready(lines, LOG, ())
            lines.write.insertInto(self.full_name(LOG))
        except Exception as trouble:  # noqa: BLE001
            log.warning("could not write the ingestion log: %s", trouble)

    def audit_log(self) -> DataFrame:
        return self.read(LOG)

    def compact_log(self) -> None:
        """Put the lines of the audit log, one small file each, into one file.

        A copy is written to the shared folder first, from which the log can be restored
        if the job stops in between.
        """
        copy = scratch_path(self.spark, LOG)
        self.audit_log().coalesce(1).write.parquet(copy)
        lines = self.spark.read.schema(AUDIT_SCHEMA).parquet(copy)
        lines.coalesce(1).write.mode("overwrite").insertInto(self.full_name(LOG))

    def load(
        self,
        rows: DataFrame,
        table_name: str,
        source_name: str,
        at: dt.datetime | None = None,
        note: str | None = None,
    ) -> int:
        """Full refresh of one raw table from typed rows, with audit.

        `note` says in the audit line what the rows lack.
        """
        return self.load_checked(rows, table_name, source_name, (), at, note)[0]

    def load_checked(
        self,
        rows: DataFrame,
        table_name: str,
        source_name: str,
        checks: Sequence[quality.Check],
        at: dt.datetime | None = None,
        note: str | None = None,
    ) -> tuple[int, DataFrame | None]:
        """As `load`, with the verdicts of checks that are counted in the same pass."""
        started = time.monotonic()
        try:
            stamped = normalise.with_load_metadata(rows, source_name, at)
            typed = normalise.to_table_schema(stamped, table_name)
            n, verdicts = self.write_checked(typed, table_name, checks, at)
        except Exception as error:
            self.log_run(table_name, 0, source_name, "FAILED", str(error), 0)
            raise
        self.log_run(table_name, n, source_name, "SUCCESS", note, time.monotonic() - started)
        return n, verdicts


def materialise(
    df: DataFrame,
    name: str,
    layer: str,
    store: TableStore | None = None,
    years: Sequence[int] | None = None,
) -> DataFrame:
    """Staging models stay views, intermediate models and marts are stored."""
    if layer == "staging" or store is None:
        df.createOrReplaceTempView(name)
        return df
    store.write_model(df, name, years=years)
    return store.read(name)
