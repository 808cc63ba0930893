"""Quality rules: line frequency across the documents of a host, and rules within a text."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from seriesmill.llm import words
from seriesmill.llm.scratch import map_batches, sent_if_small, stored, wrapped

#: Rules within a text: fewest words, words of a repeated window, and the percentage of
#: the text that such windows may cover.
LEAST_WORDS, WINDOW, MOST_REPEATED_PERCENT = 10, 5, 20
#: A line is boilerplate of a host from so many distinct documents on that hold it, and
#: from this percentage of the host's distinct documents on.
LEAST_DOCUMENTS, LEAST_PERCENT = 20, 10
#: A document is depleted when, without boilerplate, it has less than LEAST_WORDS words or
#: less than this percentage of its words.
LEAST_KEPT_PERCENT = 20

#: Hashes of boilerplate lines that are sent to the tasks; longer lists are joined by a shuffle.
MOST_SENT = 500_000

_SYMBOLS = "#*$%&|<>"
_SPACES = re.compile(r"[\x20\x09-\x0D]+")
_STRIP = "\x20\x09\x0a\x0b\x0c\x0d"


def normalised(line: str) -> str:
    """Lower case, digits as 0, single spaces."""
    return _SPACES.sub(" ", re.sub(r"[0-9]", "0", line)).strip(" ").lower()


def repeated_words(window_hashes: np.ndarray, n: int, width: int = WINDOW) -> int:
    """Words that lie in a window found twice or more."""
    if n < width:
        return 0
    _, which, count = np.unique(window_hashes, return_inverse=True, return_counts=True)
    change = np.zeros(n + 1, np.int64)
    twice = np.flatnonzero(count[which] > 1)
    change[twice] += 1
    np.subtract.at(change, twice + width, 1)
    return int((np.cumsum(change[:n]) > 0).sum())


_NEWLINE = np.zeros(256, bool)
_NEWLINE[10] = True
_PLAIN = bytes(48 if 48 <= b < 58 else 32 if b in (9, 11, 12, 13) else b for b in range(256))


def line_hashes(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the normalised form, and words, of each line with a word."""
    raw = (text or "").lower().encode("utf-8", "surrogatepass").translate(_PLAIN)
    raw = np.frombuffer(re.sub(rb" ?\n ?", b"\n", re.sub(rb" +", b" ", raw)).strip(b" "), np.uint8)
    starts, ends = words.bounds(raw, _NEWLINE)
    spaces = np.concatenate([[0], np.cumsum(raw == 32)])
    return words.signed(words.run_hashes(raw, starts, ends)), spaces[ends] - spaces[starts] + 1


def whole_text(text: str) -> int:
    """Digest of a text: copies share it, and no other text does."""
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def measure(text: str | None) -> dict:
    """Base measures of one text."""
    text = text or ""
    cased = words.hashes(text, lower=False)
    n = len(cased)
    lines = [line for line in text.split("\n") if line.strip(_STRIP)]
    return {
        "n_words": n,
        "word_chars": len(text) - sum(map(text.count, _STRIP)),
        "n_symbols": sum(map(text.count, _SYMBOLS)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": repeated_words(words.windows(cased, WINDOW), n),
    }


def without_lines(text: str | None, boilerplate: list[int] | None) -> tuple[str | None, int]:
    """A text less its lines of these hashes, and the words of these lines."""
    if not text or not boilerplate:
        return text, 0
    hashes, counts = line_hashes(text)
    drop = np.isin(hashes, boilerplate)
    if not drop.any():
        return text, 0
    flags = iter(drop)
    left = [line for line in text.split("\n") if not line.strip(_STRIP) or not next(flags)]
    return "\n".join(left), int(counts[drop].sum())


_NUMBERS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_HOLDERS = "host string, document long, lines array<long>"
_MEASURED = "doc_id long, " + ", ".join(f"{n} long" for n in _NUMBERS) + ", removed long, text string"


def _holder_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list] = [[], [], []]
        for host, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            lines = np.unique(line_hashes(text)[0])
            if len(lines):
                for column, value in zip(out, (host, whole_text(text), lines)):
                    column.append(value)
        kinds = [pa.string(), pa.int64(), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["host", "document", "lines"])


def _measure_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).to_pylist()
        found = [measure(text) for text in texts]
        columns = [pa.array([f[n] for f in found], pa.int64()) for n in _NUMBERS]
        left = [without_lines(*pair) for pair in zip(texts, batch.column(2).to_pylist())]
        columns += [pa.array([n for _, n in left], pa.int64()), pa.array([t for t, _ in left], pa.string())]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *_NUMBERS, "removed", "text"])


@F.arrow_udf(StringType())
def _cleaned(texts: pa.Array, lines: pa.Array) -> pa.Array:
    return pa.array([without_lines(*pair)[0] for pair in zip(texts.to_pylist(), lines.to_pylist())], pa.string())


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED_PERCENT
    )


def _host_key(host: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), host.cast("string")), F.lit(""))


def boilerplate(docs: DataFrame, host: str) -> DataFrame:
    """(host_key, lines): hashes of the boilerplate lines of each host that has any.

    For each host, the distinct texts that hold a line are counted: (host, line, text)
    without repeats first, then per line, so a line of a third of all documents is
    spread over its texts. A host's list holds ten times the lines of its average
    document at most, as each line is in LEAST_PERCENT of them.
    """
    rows = docs.select(_host_key(F.col(host)).alias("host"), F.col("text").cast("string").alias("text"))
    held = stored(map_batches(rows, _holder_batches, _HOLDERS), "line-holders", "zstd")
    documents = held.select("host", "document").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("documents"))
    lines = held.select("host", "document", F.explode("lines").alias("line")).distinct()
    counts = lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("holders"))
    frequent = counts.where(F.col("holders") >= LEAST_DOCUMENTS).join(documents, "host")
    frequent = frequent.where(F.col("holders") * 100 >= F.col("documents") * LEAST_PERCENT)
    return stored(frequent.groupBy(F.col("host").alias("host_key")).agg(F.collect_list("line").alias("lines")), "boilerplate")


def _with_boilerplate(rows: DataFrame, listed: DataFrame, key: Column) -> DataFrame:
    """Each row with the boilerplate lines of its host; texts stay where they are if the lists are small."""
    most = listed.agg(F.sum(F.size("lines") + F.lit(2))).first()[0] or 0
    listed = listed.withColumnsRenamed({"host_key": "_host_key", "lines": "_lines"})
    return rows.join(F.broadcast(listed) if most <= MOST_SENT else listed, key == F.col("_host_key"), "left")


def _judged(docs: DataFrame, listed: DataFrame, host: str) -> DataFrame:
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), _host_key(F.col(host)).alias("host")
    )
    rows = _with_boilerplate(rows, listed, F.col("host")).select("doc_id", "text", "_lines")
    measured = map_batches(rows, _measure_batches, _MEASURED)
    left = F.col("n_words") - F.col("removed")
    depleted = (F.col("removed") > 0) & (
        (left < LEAST_WORDS) | (left * 100 < F.col("n_words") * LEAST_KEPT_PERCENT)
    )
    return measured.select(
        "doc_id", *_NUMBERS, base_failed().alias("base_failed"), (~(base_failed() | depleted)).alias("kept"),
        F.col("removed").alias("line_words_removed"), "text",
    )


def judge(docs: DataFrame, host: str = "source") -> DataFrame:
    """One row per row of `docs` (doc_id, text and the host's column): measures, verdict and cleaned text.

    Lines are normalised and hashed. For each host, the distinct documents that hold a
    line are counted; exact copies count as one document. A line of at least
    LEAST_DOCUMENTS documents and LEAST_PERCENT of the host's documents is removed from
    all documents of the host: `text` is without it, and `line_words_removed` counts the
    words so removed. A document that is depleted by it is rejected, as is one that fails
    the base rules. The measures are those of the whole text.

    A null or empty text has no words, fails the base rules and holds no line. A null
    host is a host of its own. Repeated rows are judged alike. Empty tables give no
    rows; other columns are ignored.
    """
    return _judged(docs, boilerplate(docs, host), host)


def keep_good(docs: DataFrame, host: str = "source") -> DataFrame:
    """The documents that pass, with their columns and `text` without boilerplate lines (see `judge`).

    Rows of one doc_id stay if any of them passes. A column `n_chars` is set to the
    length of a text that lost lines. Columns of any other name are carried along. Null
    texts and repeated rows are as in `judge`.

    The rejected ids are the smaller side of the join, so texts stay where they are
    if there are few enough of them to send to the tasks.
    """
    listed = boilerplate(docs, host)
    ids = _judged(docs, listed, host).groupBy("doc_id").agg(F.max("kept").alias("kept"))
    bad = stored(ids.where("not kept").select(F.col("doc_id").alias("_bad")), "rejected")
    good = wrapped(docs.join(sent_if_small(bad), docs.doc_id.eqNullSafe(bad["_bad"]), "left_anti"))
    row = F.col("row")
    rows = _with_boilerplate(good, listed, _host_key(row[host]))
    clean = _cleaned(row["text"].cast("string"), F.col("_lines"))
    rows = rows.withColumn("_clean", F.when(F.col("_lines").isNull(), row["text"]).otherwise(clean))
    changed = ~F.col("_clean").eqNullSafe(row["text"])
    length = F.when(changed, F.length("_clean")).otherwise(row["n_chars"]) if "n_chars" in docs.columns else None
    now = {"text": F.col("_clean"), "n_chars": length}
    return rows.select(*[now.get(c, row[c]).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])
