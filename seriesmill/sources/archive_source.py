"""Archives of CSV files as a data source of their own.

    archive_source.register(spark)
    rows = spark.read.format("series_archives").load(folder)
    rows.filter("_source_file = 'employment.csv'")

The reader lists the archives below a folder and reads their directories; a partition is
one member of an archive, or several small ones. Conditions on the member's name are
pushed down, so members that they exclude are neither partitions nor opened. With the
option `report` the source gives one line per member instead: its status, its rows and
what is wrong with it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql.types import StructType

from seriesmill import schema
from seriesmill.session import ship_package
from seriesmill.sources import archives

FORMAT = "series_archives"
#: Unpacked bytes of a partition; 0 makes each member one.
PARTITION_BYTES = archives.TASK_BYTES
REPORT = "archive string, member string, status string, rows bigint, detail string"

# Conditions on a name that the reader can test, by the class of the pushed filter.
_TESTS: dict[type, Callable[[str, object], bool]] = {
    ds.EqualTo: lambda name, value: name == value,
    ds.EqualNullSafe: lambda name, value: name == value,
    ds.In: lambda name, value: name in value,
    ds.StringStartsWith: lambda name, value: name.startswith(value),
    ds.StringEndsWith: lambda name, value: name.endswith(value),
    ds.StringContains: lambda name, value: value in name,
}


class SeriesArchives(ds.DataSource):
    """Options: `path`, `report` (true or false), `partitionBytes`."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _report(self) -> bool:
        return self.options.get("report", "false").lower() == "true"

    def schema(self) -> StructType | str:
        return REPORT if self._report() else schema.TEXT_SCHEMA

    def reader(self, schema: StructType) -> ds.DataSourceReader:
        return ArchiveReader(
            self.options["path"], self._report(), int(self.options.get("partitionBytes", PARTITION_BYTES))
        )


class ArchiveReader(ds.DataSourceReader):
    """Members as partitions; only whole, readable series members give rows."""

    def __init__(self, path: str, report: bool, partition_bytes: int) -> None:
        self.path, self.report, self.partition_bytes = path, report, partition_bytes
        self.conditions: list[ds.Filter] = []

    def pushFilters(self, filters: list[ds.Filter]) -> Iterable[ds.Filter]:
        """Keep the conditions on the member's name, give back all others."""
        column = ("member",) if self.report else ("_source_file",)
        for condition in filters:
            if type(condition) in _TESTS and condition.attribute == column:
                self.conditions.append(condition)
            elif not (isinstance(condition, ds.IsNotNull) and condition.attribute == column and not self.report):
                yield condition

    def _wanted(self, name: str | None) -> bool:
        return all(name is not None and _TESTS[type(c)](name, c.value) for c in self.conditions)

    def partitions(self) -> Sequence[ds.InputPartition]:
        """Members in the order of archives, packed up to `partition_bytes`; no member is split."""
        with ThreadPoolExecutor() as pool:
            listed = pool.map(_directory, _archive_paths(self.path))
            members = [m for found in listed for m in found if self._wanted(m[1])]
        packed: list[list[tuple[str, str | None]]] = []
        room = 0
        for archive, member, size in members:
            if not packed or size > room:
                packed.append([])
                room = self.partition_bytes
            packed[-1].append((archive, member))
            room -= size
        return [ds.InputPartition(part) for part in packed] or [ds.InputPartition([])]

    def read(self, partition: ds.InputPartition) -> Iterator[pa.RecordBatch]:
        for archive, member in partition.value:
            status, rows, detail = _checked(archive, member)
            if self.report:
                line = [[archive], [member], [status], [rows], [detail]]
                kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()]
                names = ["archive", "member", "status", "rows", "detail"]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(line, kinds)], names)
            elif status == "series":
                yield from archives.member_batches(archive, member)


def _archive_paths(path: str) -> list[str]:
    """Full paths of the archives below a folder, or the one archive that `path` is."""
    file_system, inner = archives.locate(path)
    found = file_system.get_file_info(inner)
    if found.type == arrow_fs.FileType.Directory:
        below = file_system.get_file_info(arrow_fs.FileSelector(inner, recursive=True))
        files = sorted(f.path for f in below if f.type == arrow_fs.FileType.File and f.path.endswith(".zip"))
    else:
        files = [found.path]
    prefix = path[: path.index(inner)] if inner in path else "file:"
    return [prefix + file for file in files]


def _directory(path: str) -> list[tuple[str, str | None, int]]:
    """Candidate members of an archive with their unpacked size, from its directory alone."""
    try:
        with archives.opened(path) as archive:
            found = [(path, i.filename, i.file_size) for i in archive.infolist() if archives.is_series_member(i.filename)]
    except archives.UNREADABLE:  # no archive at all
        return [(path, None, 0)]
    return found or [(path, None, 0)]


def _checked(path: str, member: str | None) -> tuple[str, int, str | None]:
    """Status, rows and trouble of a member, by parsing it to its end."""
    if member is None:
        return "no candidate", 0, None
    try:
        counts = [batch.num_rows for batch in archives.member_batches(path, member)]
    except archives.UNREADABLE as error:
        return "unreadable", 0, str(error)
    return ("series", sum(counts), None) if counts else ("no period column", 0, None)


def register(spark: SparkSession) -> None:
    """Make the format known to the session and let it take conditions."""
    ship_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SeriesArchives)
