"""WARC archives of captures, and their index merged from sorted runs by a loser tree."""

from __future__ import annotations

import base64
import datetime as dt
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seriesmill.llm.scratch import map_batches, stored
from seriesmill.session import scratch_path

#: Bytes after which a task starts its next archive, and captures of one merge range.
ARCHIVE_BYTES, RANGE_ROWS = 256 * 1024**2, 50_000
#: Payloads of fewer bytes are never revisits.
LEAST_PAYLOAD = 0

_RESPONSE_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
_NEWLINE = b"\r\n"
_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels from the right, then the path and the query, lower case."""
    if url is None:
        return ""
    try:
        parts = urlsplit(url.lower())
        host = parts.netloc.rpartition("@")[2]
    except ValueError:
        return url.lower()
    name, colon, port = host.partition(":")
    reversed_name = ",".join(reversed(name.removeprefix("www.").split(".")))
    return f"{reversed_name}{colon}{port}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def _header_value(text: str) -> str:
    """Control characters and spaces would break a header line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def record(page_id: int | None, url: str | None, at: dt.datetime, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC 1.1 record: the response with its payload, or a revisit with the HTTP head alone."""
    head = _RESPONSE_HEAD.format(len(payload)).encode("ascii")
    block = head if revisit else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{page_id}>",
        f"WARC-Date: {(at or _EPOCH).astimezone(dt.timezone.utc):%Y-%m-%dT%H:%M:%SZ}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header_value(url)}")
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + 2 * _NEWLINE + block + 2 * _NEWLINE


def _head(stream: io.BufferedIOBase) -> dict[str, str]:
    found = {}
    while line := stream.readline().rstrip(_NEWLINE):
        name, _, value = line.decode("utf-8", "surrogatepass").partition(":")
        found[name.strip().lower()] = value.strip()
    return found


def _page(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if re.fullmatch(r"-?\d+", number) else None


def read_records(stream: io.BufferedIOBase) -> Iterator[dict]:
    """The records of an archive, one at a time; payloads of responses are checked against their digest."""
    while first := stream.readline():
        if not first.strip():
            continue
        head = _head(stream)
        block = io.BytesIO(stream.read(int(head["content-length"])))
        block.readline()
        http = _head(block)
        payload = block.read()
        revisit = head["warc-type"] == "revisit"
        digest = head["warc-payload-digest"].removeprefix("sha1:")
        if not revisit and payload_digest(payload) != digest:
            raise ValueError(f"{head['warc-record-id']}: the payload does not fit its digest")
        yield {
            "page_id": _page(head["warc-record-id"]),
            "url": head.get("warc-target-uri"),
            "captured_at": head["warc-date"],
            "payload_bytes": int(http["content-length"]) if revisit else len(payload),
            "payload_digest": digest,
            "record_type": head["warc-type"],
            "refers_to": _page(head.get("warc-refers-to")),
        }


def _place(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder that is named by a URI or a plain path."""
    return fs.FileSystem.from_uri(folder) if ":" in folder else (fs.LocalFileSystem(), folder)


class _ArchiveWriter:
    """Archives of one task. An archive appears under its name when it is complete, so a
    repeated task replaces what an earlier attempt wrote."""

    def __init__(self, folder: str, task: int) -> None:
        self._store, self._root = _place(folder)
        self._store.create_dir(self._root, recursive=True)
        self._task, self._number, self._out, self._size, self.names = task, 0, None, 0, []

    def add(self, record_bytes: bytes) -> None:
        if self._out is None:
            self._temporary = f"{self._root}/.{uuid.uuid4().hex}"
            self._out = self._store.open_output_stream(self._temporary, compression=None)
        member = gzip.compress(record_bytes, 6, mtime=0)
        self._out.write(member)
        self._size += len(member)
        if self._size >= ARCHIVE_BYTES:
            self.close()

    def close(self) -> None:
        if self._out is not None:
            self._out.close()
            name = f"run-{self._task:06d}-{self._number:04d}.warc.gz"
            self._store.move(self._temporary, f"{self._root}/{name}")
            self.names.append(name)
            self._out, self._size, self._number = None, 0, self._number + 1


def _write_batches(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        writer = _ArchiveWriter(folder, TaskContext.get().partitionId())
        for batch in batches:
            for page_id, url, at, payload, revisit, refers_to in zip(*(batch.column(k).to_pylist() for k in range(1, 7))):
                writer.add(record(page_id, url, at, payload or b"", refers_to, revisit))
        writer.close()
        yield pa.RecordBatch.from_arrays([pa.array(writer.names, pa.string())], ["name"])

    return run


def _key_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = pa.array([url_key(u) for u in batch.column(1).to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([keys, *batch.columns], ["url_key", *batch.schema.names])


def write_archives(captures: DataFrame, folder: str, least_payload: int = LEAST_PAYLOAD) -> DataFrame:
    """Write `captures` (page_id, url, captured_at, payload) as WARC files below `folder`; returns their names.

    Of the captures with equal payloads of at least `least_payload` bytes, the one with
    the smallest page_id is a response and the others are revisits of it. Each task
    writes a run sorted by URL key and time. First captures are found from digests
    alone; a payload is shuffled once, to join what it refers to, and a payload that a
    third of all pages share is split by adaptive execution.
    """
    digest = F.sha1("payload")
    pages = captures.select("page_id", "url", "captured_at", F.coalesce("payload", F.lit(b"")).alias("payload"))
    firsts = pages.select("page_id", digest.alias("sha1"), F.octet_length("payload").alias("bytes"))
    firsts = firsts.where(F.col("bytes") >= least_payload).groupBy("sha1")
    firsts = firsts.agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    firsts = stored(firsts.drop("copies"), "first-captures")
    rows = pages.withColumn("sha1", digest).join(firsts, "sha1", "left")
    revisit = F.col("first").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") != F.col("first")))
    rows = rows.select("page_id", "url", "captured_at", "payload", revisit.alias("revisit"), F.when(revisit, F.col("first")).alias("refers_to"))
    keyed = map_batches(
        rows, _key_batches,
        "url_key string, page_id long, url string, captured_at timestamp, payload binary, revisit boolean, refers_to long",
    )
    ordered = keyed.sortWithinPartitions("url_key", "captured_at", "page_id")
    return stored(map_batches(ordered, _write_batches(folder), "name string"), "archive-names")


_INDEX = (
    "run string, number long, url_key string, captured_at string, page_id long, url string, "
    "payload_bytes long, payload_digest string, record_type string, refers_to long"
)


def _read_batches(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    kinds = {"string": pa.string(), "long": pa.int64()}
    schema = pa.schema([(part.split()[0], kinds[part.split()[1]]) for part in _INDEX.split(", ")])

    def run(batches):
        store, root = _place(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with store.open_input_stream(f"{root}/{name}", compression=None) as raw:
                    rows = []
                    for number, found in enumerate(read_records(io.BufferedReader(_Members(raw)))):
                        rows.append(found | {"run": name, "number": number, "url_key": url_key(found["url"])})
                        if len(rows) == 5000:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema)

    return run


class _Members(io.RawIOBase):
    """The bytes of concatenated gzip members, unpacked as they are read."""

    def __init__(self, raw) -> None:
        self._raw, self._packed, self._plain = raw, zlib.decompressobj(31), b""

    def readable(self) -> bool:
        return True

    def readinto(self, target) -> int:
        while not self._plain:
            chunk = self._packed.unused_data if self._packed.eof else b""
            if self._packed.eof:
                self._packed = zlib.decompressobj(31)
            chunk = chunk or self._raw.read(1 << 20)
            if not chunk:
                return 0
            self._plain = self._packed.decompress(chunk)
        n = min(len(target), len(self._plain))
        target[:n], self._plain = self._plain[:n], self._plain[n:]
        return n


def read_index(names: DataFrame, folder: str) -> DataFrame:
    """One row per record of the archives: each archive is a run, `number` its place in the run."""
    n = max(1, names.count())
    return map_batches(names.repartition(min(n, 10_000)), _read_batches(folder), _INDEX)


class LoserTree:
    """k-way merge of sorted runs: each inner node keeps the run that lost there.

    The next row costs one comparison per level on the path of the run it came from.
    """

    _END = object()

    def __init__(self, runs: list[Iterator], key: Callable) -> None:
        self._runs, self._key, self._k = runs, key, max(1, len(runs))
        self._heads = [next(run, self._END) for run in runs] or [self._END]
        self._losers = [-1] * self._k
        for run in range(self._k):
            self._play(run)

    def _before(self, a: int, b: int) -> bool:
        if self._heads[a] is self._END or self._heads[b] is self._END:
            return self._heads[b] is self._END and self._heads[a] is not self._END
        return (self._key(self._heads[a]), a) < (self._key(self._heads[b]), b)

    def _play(self, run: int) -> None:
        node = (run + self._k) // 2
        while node:
            other = self._losers[node]
            if other < 0:  # the first to come here waits for its opponent
                self._losers[node] = run
                return
            if self._before(other, run):
                self._losers[node], run = run, other
            node //= 2
        self._losers[0] = run

    def __iter__(self) -> Iterator:
        while self._heads[winner := self._losers[0]] is not self._END:
            yield self._heads[winner]
            self._heads[winner] = next(self._runs[winner], self._END)
            self._play(winner)


_ORDER = ("url_key", "captured_at", "page_id", "run", "number")


def _merge_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the runs of one range; rows arrive run by run, each in order."""
    table = [batch for batch in batches if batch.num_rows]
    if not table:
        return
    rows = pa.Table.from_batches(table).combine_chunks()
    columns = [rows.column(name).to_pylist() for name in _ORDER]
    keys = [(k, a, -(1 << 63) if p is None else p, r, n) for k, a, p, r, n in zip(*columns)]
    borders = [0, *(i for i in range(1, len(keys)) if keys[i][3] != keys[i - 1][3]), len(keys)]
    runs = [iter(range(a, b)) for a, b in zip(borders, borders[1:])]
    order = list(LoserTree(runs, keys.__getitem__))
    part = TaskContext.get().partitionId()
    merged = rows.take(pa.array(order, pa.int64()))
    merged = merged.append_column("part", pa.array([part] * len(order), pa.int32()))
    merged = merged.append_column("place", pa.array(range(len(order)), pa.int64()))
    yield from merged.to_batches(max_chunksize=10_000)


def merged_index(index: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The captures of all runs in one global order by URL key and time, with their `position` in it.

    Ranges of the order are dealt out to tasks, cut by URL key, time, page and place, so
    the captures of one hot URL go to as many tasks as they need. A task gets the slice
    of each run that falls into its range, still sorted, and merges the slices with a
    loser tree. Positions follow from the number of captures in earlier ranges.
    """
    index = stored(index, "capture-runs")
    n = max(1, -(-index.count() // range_rows))
    ranged = index.repartitionByRange(n, *_ORDER).sortWithinPartitions("run", "number")
    schema = _INDEX + ", part int, place long"
    merged = stored(map_batches(ranged, _merge_batches, schema), "merged-captures")
    sizes = merged.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    earlier = W.partitionBy(F.lit(0)).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = stored(sizes.select("part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("offset")), "merge-offsets")
    return merged.join(offsets, "part").withColumn("position", F.col("offset") + F.col("place")).drop("part", "place", "offset")


def captures_of(pages: DataFrame) -> DataFrame:
    """Captures from `pages` (page_id, url, html): one second apart in the order of page_id.

    The table has no time of capture, so the page's number stands for it.
    """
    at = F.timestamp_seconds(F.lit(1_704_067_200) + F.pmod(F.coalesce(F.col("page_id").cast("long"), F.lit(0)), F.lit(10**9)))
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        at.alias("captured_at"), payload.alias("payload"),
    )


def archive_and_index(pages: DataFrame, least_payload: int = LEAST_PAYLOAD) -> DataFrame:
    """Write all pages as WARC records, read the archives back and merge their index.

    One row per page: page_id, payload_bytes, payload_digest, record_type, refers_to,
    url_key, captured_at, position. A null html is an empty payload, a null url has
    no target and an empty key, a null page_id is a revisit where another page has its
    payload. Rows that share page_id and payload are recorded alike. An empty table
    writes no archive and gives no rows. Other columns are ignored.
    """
    folder = scratch_path(pages.sparkSession, "warc")
    names = write_archives(captures_of(pages), folder, least_payload)
    index = merged_index(read_index(names, folder))
    return index.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured_at", "position"
    )
