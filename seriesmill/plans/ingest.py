"""The load job over all sources with its status report."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from seriesmill.operators.quality import Check
from seriesmill.sources import archives, normalise
from seriesmill.sources.tables import TableStore

REPORT = "source_name string, target_table string, status string, rows_loaded bigint, message string"


@dataclass(frozen=True)
class Source:
    """One survey: where its archives lie and which raw table they fill."""

    name: str
    path: str
    target_table: str | None


@dataclass(frozen=True)
class RunReport:
    """One line per source and the exit status of the run."""

    lines: list[tuple]
    exit_code: int
    verdicts: list[DataFrame] = field(default_factory=list)

    def to_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.lines, REPORT)


def read_source(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Typed rows of the archives below a path, and the status of their members."""
    parsed = archives.parse_archives(spark, path)
    archives.require_series(parsed, path)
    return normalise.typed_rows(parsed.rows), parsed.manifest


def run_sources(
    spark: SparkSession,
    sources: list[Source],
    store: TableStore,
    at: dt.datetime | None = None,
    checks: dict[str, Sequence[Check]] | None = None,
) -> RunReport:
    """Read every source first, then load table by table.

    Sources that share a path share one pass over its archives. Trouble while reading
    stops the run with status 2. Trouble while loading counts against that source only:
    0 when all loaded, 1 when some, 2 when none. A source without a target table is
    reported and skipped. Members that were left out are counted in the report and in the
    audit log, and the status of every member is kept in the table `members_<source>`.
    `checks` by table are counted while it is loaded; their verdicts are in the report.
    """
    frames: dict[str, tuple[DataFrame, DataFrame]] = {}
    for source in sources:
        try:
            frames[source.path] = frames.get(source.path) or read_source(spark, source.path)
        except Exception as error:  # noqa: BLE001
            line = (source.name, source.target_table, "EXTRACT FAILED", 0, str(error))
            return RunReport([line], 2)

    lines, verdicts, loaded, failed = [], [], 0, 0
    for source in sources:
        rows, manifest = frames[source.path]
        if source.target_table is None:
            lines.append((source.name, None, "SKIPPED", 0, "no target table"))
            continue
        try:
            note = archives.left_out(manifest)
            store.write(manifest, f"members_{source.name}", at)
            wanted = (checks or {}).get(source.target_table, ())
            n, found = store.load_checked(rows, source.target_table, source.name, wanted, at, note)
            verdicts += [] if found is None else [found]
            lines.append((source.name, source.target_table, "SUCCESS", n, note))
            loaded += 1
        except Exception as error:  # noqa: BLE001
            lines.append((source.name, source.target_table, "FAILED", 0, str(error)))
            failed += 1
    return RunReport(lines, 0 if failed == 0 else 1 if loaded else 2, verdicts)
