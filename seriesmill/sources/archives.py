"""ZIP archives of CSV files as distributed text rows.

Spark lists the archives and hands them out; tasks open them through the Arrow
file-system layer, so any storage with random access works. Three steps:

1. list members, one task item per archive (only the archive directory is read);
2. parse members once, packed into tasks by their size: rows and one line with the
   member's status go to a stored table. Is it a series file, and does it parse to
   its end?
3. leave out the rows of members that turned out bad; the statuses are the manifest.

A compressed member cannot be split, so one member is one unit of work; its rows
are streamed in bounded chunks and never held together. The driver sees counts only.
"""

from __future__ import annotations

import csv
import io
import itertools
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesmill import schema
from seriesmill.functions import text
from seriesmill.session import scratch_path, ship_package

CHUNK_ROWS = 50_000
TASK_BYTES = 32 * 1024**2  # unpacked bytes that are worth a task of their own
PERIOD_HEADERS = ("Period", "period")

_MEMBERS = "archive string, member string, bytes bigint"
# Columns beside those of a series row: where it comes from and what became of the member.
_ORIGIN = ["_archive", "_member", "_verdict", "_rows", "_detail"]


def is_series_member(name: str) -> bool:
    """`.csv` in lower case, and no skipped word in any case."""
    lowered = name.lower()
    return name.endswith(".csv") and not any(w in lowered for w in schema.SKIPPED_MEMBER_WORDS)


def locate(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """Arrow file system and path for a path as Spark prints it."""
    if path.startswith("file:"):
        return arrow_fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    # Spark's name of the object-store connector differs from Arrow's.
    return arrow_fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


#: What reading a faulty member raises.
UNREADABLE = (ValueError, zipfile.BadZipFile, zipfile.zlib.error)


@contextmanager
def opened(path: str):
    file_system, inner = locate(path)
    with file_system.open_input_file(inner) as handle, zipfile.ZipFile(handle) as archive:
        yield archive


def _chunks(archive: zipfile.ZipFile, member: str) -> Iterator[pd.DataFrame]:
    """S3: all columns as text, missing tokens as None."""
    with archive.open(member) as handle:
        yield from pd.read_csv(
            handle,
            dtype=str,
            chunksize=CHUNK_ROWS,
            keep_default_na=False,
            na_values=schema.CSV_MISSING_TOKENS,
        )


def _canonical(chunk: pd.DataFrame, member: str) -> pa.RecordBatch:
    """S5 to S7 for one chunk; each member's own header decides."""
    names = [schema.HEADER_SPELLINGS.get(column, column) for column in chunk.columns]
    columns = {}
    for name in schema.SERIES_COLUMNS:
        found = [chunk.iloc[:, i] for i, n in enumerate(names) if n == name]
        value = found[0] if found else None
        for other in found[1:]:
            value = value.where(value.notna(), other)
        columns[name] = (
            pa.nulls(len(chunk), pa.string())
            if value is None
            else pa.array(value, pa.string(), from_pandas=True)
        )
    columns["_source_file"] = pa.array([member] * len(chunk), pa.string())
    return pa.RecordBatch.from_pydict(columns)


def _list_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("archive").to_pylist():
            with opened(path) as archive:
                found = [i for i in archive.infolist() if is_series_member(i.filename)]
            # An archive without candidates still gets a line, to be reported later.
            names = [i.filename for i in found] or [None]
            sizes = [i.file_size for i in found] or [0]
            yield pa.RecordBatch.from_pydict(
                {
                    "archive": pa.array([path] * len(names), pa.string()),
                    "member": pa.array(names, pa.string()),
                    "bytes": pa.array(sizes, pa.int64()),
                }
            )


def _status_line(archive: str, member: str | None, status: str, rows: int, detail: str | None) -> dict:
    empty = {field.name: pa.nulls(1, pa.string()) for field in schema.TEXT_SCHEMA}
    return empty | {
        "_archive": pa.array([archive], pa.string()),
        "_member": pa.array([member], pa.string()),
        "_verdict": pa.array([status], pa.string()),
        "_rows": pa.array([rows], pa.int64()),
        "_detail": pa.array([detail], pa.string()),
    }


def member_batches(path: str, member: str) -> Iterator[pa.RecordBatch]:
    """Text rows of one member in bounded chunks; none at all for a table without a period column."""
    with opened(path) as archive:
        for chunk in _chunks(archive, member):
            if not any(name in chunk.columns for name in PERIOD_HEADERS):
                return
            yield _canonical(chunk, member)


def _member_rows(path: str, member: str, count: list[int]) -> Iterator[pa.RecordBatch]:
    """Rows of one member with their origin."""
    for batch in member_batches(path, member):
        n = batch.num_rows
        origin = [pa.array([path] * n, pa.string()), pa.array([member] * n, pa.string())]
        unset = [pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.string())]
        count[0] = (count[0] or 0) + n
        yield pa.RecordBatch.from_arrays([*batch.columns, *origin, *unset], [*batch.schema.names, *_ORIGIN])


def _parse_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of each member, then a line with its status."""
    for batch in batches:
        for item in batch.to_pylist():
            path, member, count = item["archive"], item["member"], [None]
            status, detail = "no candidate", None
            if member is not None:
                try:
                    yield from _member_rows(path, member, count)
                    status = "no period column" if count[0] is None else "series"
                except UNREADABLE as error:
                    status, detail = "unreadable", str(error)
            rows = count[0] or 0 if status == "series" else 0
            yield pa.RecordBatch.from_pydict(_status_line(path, member, status, rows, detail))


def _files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """Paths below a folder; the file contents are not read."""
    ship_package(spark)
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(F.col("path").alias("archive"), F.col("_metadata.file_path").alias("uri"))
    )
    return _spread(spark, listed)


def _spread(spark: SparkSession, items: DataFrame) -> DataFrame:
    """Hand the items out evenly, one by one."""
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return items.repartition(max(wanted, spark.sparkContext.defaultParallelism))


def _kept(df: DataFrame, name: str, *partitions: str) -> DataFrame:
    """Store an intermediate table in the shared folder."""
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(*partitions).parquet(path) if partitions else df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _packed(spark: SparkSession, members: DataFrame) -> DataFrame:
    """Deal members out so that a task gets about TASK_BYTES, or a single larger member.

    Members are split into groups by a hash, and the bytes of earlier members of the
    group give a member's bin. A window holds some ten thousand lines, whatever the
    number of members.
    """
    members = _kept(members, "members")
    size = members.agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")).first()
    groups = 1 + size.n // 10_000
    share = (size.bytes or 0) // spark.sparkContext.defaultParallelism + 1
    group = F.pmod(F.xxhash64("archive", "member"), F.lit(groups))
    before = (
        Window.partitionBy("_group").orderBy(F.desc("bytes"), "archive", "member")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    filled = F.coalesce(F.sum("bytes").over(before), F.lit(0))
    binned = _kept(
        members.withColumn("_group", group).withColumn("_bin", F.floor(filled / min(share, TASK_BYTES))), "bins"
    )
    bins = binned.groupBy("_group").agg((F.max("_bin") + 1).alias("_bins"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = _kept(bins.withColumn("_offset", F.coalesce(F.sum("_bins").over(earlier), F.lit(0))), "bin-offsets")
    tasks = offsets.agg(F.sum("_bins")).first()[0] or 1
    placed = binned.join(offsets, "_group")
    place = (F.col("_offset") + F.col("_bin")).cast("int")
    return placed.repartitionById(int(tasks), place).select("archive", "member", "bytes")


@dataclass(frozen=True)
class ParsedArchives:
    """Text rows of the good members, and (archive, member, status, rows, detail) of all candidates."""

    rows: DataFrame
    manifest: DataFrame


def parse_archives(spark: SparkSession, path: str) -> ParsedArchives:
    """Every member below `path`, unpacked and parsed once.

    Rows and statuses are stored together. A member that fails at its last line has
    rows there, too; they are left out by a join with the bad members, so no line of a
    bad member is ever returned.
    """
    members = _files(spark, path, "*.zip").mapInArrow(_list_members, _MEMBERS)
    shape = schema.TEXT_SCHEMA.simpleString()[len("struct<") : -1].replace(":", " ").replace(",", ", ")
    shape += ", _archive string, _member string, _verdict string, _rows bigint, _detail string"
    parsed = _packed(spark, members).mapInArrow(_parse_members, shape)
    staged = _kept(parsed.withColumn("_is_verdict", F.col("_verdict").isNotNull()), "parsed-members", "_is_verdict")
    names = {"_archive": "archive", "_member": "member", "_verdict": "status", "_rows": "rows", "_detail": "detail"}
    manifest = staged.filter("_is_verdict").select(*(F.col(old).alias(new) for old, new in names.items()))
    bad = manifest.filter("status <> 'series' and member is not null")
    bad = bad.select(F.col("archive").alias("_archive"), F.col("member").alias("_member"))
    rows = staged.filter("not _is_verdict").join(bad, ["_archive", "_member"], "left_anti")
    return ParsedArchives(rows.select(*[field.name for field in schema.TEXT_SCHEMA]), manifest)


def require_series(parsed: ParsedArchives, path: str) -> None:
    """Raise when there is no archive, or one without a readable series member, as the source job does."""
    verdicts = parsed.manifest.groupBy("archive").agg(F.max(F.col("status") == "series").alias("good"))
    counts = verdicts.agg(F.count("*").alias("n"), F.count_if(~F.col("good")).alias("empty")).first()
    if not counts.n or counts.empty:
        some = [row.archive for row in verdicts.filter(~F.col("good")).orderBy("archive").limit(20).collect()]
        raise ValueError(f"no time-series CSV found in {counts.empty or 'any'} archives: {some or path}")


def member_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Every candidate member with its status and row count."""
    return parse_archives(spark, path).manifest


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Text rows of all series members below `path`; see `require_series`."""
    parsed = parse_archives(spark, path)
    require_series(parsed, path)
    return parsed.rows


def left_out(manifest: DataFrame) -> str | None:
    """How many candidate members were left out and why; None if there are none."""
    bad = manifest.filter("status <> 'series' and member is not null").groupBy("status").count()
    counts = sorted((row.status, row["count"]) for row in bad.collect())
    return "members left out: " + ", ".join(f"{n} {status}" for status, n in counts) if counts else None


def _read_headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Header of each file that holds a series."""
    for batch in batches:
        for path, uri in zip(batch.column("archive").to_pylist(), batch.column("uri").to_pylist()):
            file_system, inner = locate(path)
            with file_system.open_input_file(inner) as handle:
                names = next(csv.reader(io.TextIOWrapper(handle, "utf-8-sig", newline="")), [])
            if is_series_member(path.rsplit("/", 1)[-1]) and any(name in names for name in PERIOD_HEADERS):
                yield pa.RecordBatch.from_pydict({"uri": [uri], "names": pa.array([names], pa.list_(pa.string()))})


# A comma outside quotes.
_SEPARATOR = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def read_csv_folder(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """S3 to S7 for unpacked CSV files, with Spark's own splittable reader.

    Tasks read the header line of each file, and Spark groups the files by it; the driver
    sees only the different headers, of which there is a handful. All files are then read at
    once, by place, and each row meets the header of its file by a join with the file's
    name. Set `multi_line` when quoted values hold line breaks; such files cannot be
    split. A file with a line of too many fields is left out as a whole, as an archive
    member is; a first pass finds such files.
    """
    headers = _files(spark, path, "*.csv").mapInArrow(_read_headers, "uri string, names array<string>")
    headers = _kept(headers, "headers")
    spellings = sorted(row.names for row in headers.select("names").distinct().collect())
    if not spellings:
        raise ValueError(f"no time-series CSV found in {path}")
    numbered = spark.createDataFrame(list(enumerate(spellings)), "_spelling int, names array<string>")
    files = headers.join(F.broadcast(numbered), "names").select(
        F.col("uri").alias("_uri"), "_spelling", F.size("names").alias("_width")
    )
    files = _kept(files, "header-of-file")

    widest = max(map(len, spellings))
    fields = [f"c{place}" for place in range(widest)]
    # Without pruning Spark also counts the fields that nobody reads.
    reader = spark.read.option("columnPruning", "false").option("pathGlobFilter", "*.csv")
    rows = reader.option("recursiveFileLookup", "true").csv(
        path, header=True, escape='"', multiLine=multi_line, mode="PERMISSIVE",
        schema=", ".join(f"{field} string" for field in [*fields, "_misfit"]),
        columnNameOfCorruptRecord="_misfit",
    ).select("*", F.col("_metadata.file_path").alias("_uri"), F.col("_metadata.file_name").alias("_source_file"))
    rows = rows.join(files, "_uri")
    # Only a line that differs from the widest header in its number of fields is a misfit.
    found = F.when(F.col("_misfit").isNull(), widest).otherwise(F.regexp_count("_misfit", F.lit(_SEPARATOR)) + 1)
    # Spark refuses to read the misfits alone, so one more column comes along.
    bad = rows.filter(found > F.col("_width")).groupBy("_uri").agg(F.max(fields[0]).alias("_sample"))
    good = rows.join(_kept(bad, "misfit-files").drop("_sample"), "_uri", "left_anti")
    return good.select(*(_by_spelling(name, spellings) for name in schema.SERIES_COLUMNS), "_source_file").select(
        *(
            text.null_if_token(F.col(name), schema.CSV_MISSING_TOKENS).alias(name)
            for name in [*schema.SERIES_COLUMNS, "_source_file"]
        )
    )


def _by_spelling(name: str, spellings: list[list[str]]) -> Column:
    """A column from its places in each header; the first place that has a value wins."""
    value = F.lit(None).cast("string")
    for number, header in enumerate(spellings):
        places = [f"c{i}" for i, spelt in enumerate(header) if schema.HEADER_SPELLINGS.get(spelt, spelt) == name]
        if places:
            value = F.when(F.col("_spelling") == number, F.coalesce(*places)).otherwise(value)
    return value.alias(name)


def _write_part(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    name = f"part-{TaskContext.get().partitionId():05d}"
    filled = (batch for batch in batches if batch.num_rows)
    first = next(filled, None)
    if first is None:
        return
    file_system, inner = locate(folder)
    file_system.create_dir(inner, recursive=True)
    rows, path = 0, f"{inner}/{name}.zip"
    with (
        file_system.open_output_stream(path) as out,
        zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive,
        archive.open(f"{name}.csv", "w", force_zip64=True) as member,
    ):
        for batch in itertools.chain([first], filled):
            lines = batch.to_pandas().to_csv(index=False, header=rows == 0)
            member.write(lines.encode("utf-8"))
            rows += batch.num_rows
    yield pa.RecordBatch.from_pydict(
        {"archive": [path], "rows": pa.array([rows], pa.int64())}
    )


def write_archives(df: DataFrame, folder: str) -> DataFrame:
    """One archive per partition of a text frame; returns the written files.

    The name depends on the partition only, so a repeated task replaces its file.
    An empty partition writes nothing.
    """
    ship_package(df.sparkSession)
    return df.mapInArrow(lambda batches: _write_part(batches, folder), "archive string, rows bigint")
