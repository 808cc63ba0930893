"""URL filters: host and path rules, and a Bloom filter cascade for exact membership."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.llm import words
from seriesmill.llm.scratch import map_batches, stored

#: Rules of the registered query: verdict, host, path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Words in a host that put its pages on the list of the registered query.
LISTED_WORDS = ("ads", "adult", "bets", "casino", "pills", "spam")
#: Bits and hashes per key on the first level and on the others; levels at most.
FIRST, OTHERS, MOST_LEVELS = (10, 7), (3, 2), 64
#: Listed keys of one block of the cascade, on average at most. The filters of a block
#: take some 30 MB at this size, and one block at a time is sent to the tasks.
BLOCK_KEYS = 1 << 24

_U = np.uint64


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    host = F.regexp_extract(url, r"://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """(rule, verdict) of the longest rule that fits; null if none does.

    A rule fits its host and all subdomains where the path starts with the rule's.
    """
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        own = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        chosen = F.when(fits, own).otherwise(chosen)
    return chosen


def key_hashes(key: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes of a key; null is a key of its own."""
    text = F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit(""))
    return F.xxhash64(text), F.xxhash64(text, F.lit(1))


def _places(first: np.ndarray, second: np.ndarray, level: int, hashes: int, size: int) -> np.ndarray:
    """Bit numbers of each key on a level, one row per hash."""
    salt = _U((2 * level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    a, b = words.mix(first + salt), words.mix(second ^ salt) | _U(1)
    steps = np.arange(hashes, dtype=_U)[:, None]
    return words.mix(a[None, :] + steps * b[None, :]) % _U(size)


def _knows(level: int, hashes: int, bits: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    places = _places(first, second, level, hashes, 64 * len(bits))
    return ((bits[places >> _U(6)] >> (places & _U(63))) & _U(1)).astype(bool).all(axis=0)


def _hashed(batch: pa.RecordBatch, names: tuple[str, str]) -> list[np.ndarray]:
    return [batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64).view(_U) for n in names]


def _set_bits(level: int, hashes: int, words_: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(word, bits) of the keys of each batch, one row per word that has a bit."""

    def run(batches):
        for batch in batches:
            places = _places(*_hashed(batch, ("first", "second")), level, hashes, 64 * words_).ravel()
            word, which = np.unique(places >> _U(6), return_inverse=True)
            bits = np.zeros(len(word), _U)
            np.bitwise_or.at(bits, which, _U(1) << (places & _U(63)))
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(bits.view(np.int64))], ["word", "bits"])

    return run


def _mistaken(level: int, hashes: int, sent: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(_knows(level, hashes, sent.value, *_hashed(batch, ("first", "second")))))

    return run


def _filter(keys: DataFrame, n: int, level: int, per_key: tuple[int, int]) -> tuple[int, np.ndarray]:
    """Hashes per key and bits of a Bloom filter of `keys`; the bits are or-ed before and after the shuffle."""
    size, hashes = per_key
    length = max(1, -(-n * size // 64))
    parts = map_batches(keys, _set_bits(level, hashes, length), "word long, bits long")
    table = parts.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(length, _U)
    bits[table["word"].to_numpy()] = table["bits"].to_numpy().view(_U)
    return hashes, bits


@dataclass(frozen=True)
class Cascade:
    """Exact membership for all keys of the universe that it was built from.

    A block holds the keys whose hash leaves its number as remainder, as a list of
    levels (hashes per key, bits).
    """

    blocks: list[Broadcast]

    def add_listed(self, df: DataFrame, key: Column, out: str = "listed") -> DataFrame:
        """Add whether each row's key is listed: a narrow pass over the rows for each block, no join.

        A key outside the universe may be taken for listed. Null is a key like any other.
        """
        first, second = key_hashes(key)
        rows = df.withColumns({"_first": first, "_second": second, out: F.lit(False)})
        for number, sent in enumerate(self.blocks):
            rows = map_batches(rows, _look_up(number, len(self.blocks), sent, out), rows.schema)
        return rows.drop("_first", "_second")


def _look_up(number: int, blocks: int, sent: Broadcast, out: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for batch in batches:
            first, second = _hashed(batch, ("_first", "_second"))
            open_ = first % _U(blocks) == _U(number)
            at = batch.schema.get_field_index(out)
            listed = batch.column(at).to_numpy(zero_copy_only=False).astype(bool)
            # The first level that does not know a key decides; odd levels know listed keys.
            for level, (hashes, bits) in enumerate(sent.value):
                rows = np.flatnonzero(open_)
                known = _knows(level, hashes, bits, first[rows], second[rows])
                listed[rows[~known]] = level % 2 == 1
                open_[rows[~known]] = False
            listed[open_] = len(sent.value) % 2 == 1
            columns = list(batch.columns)
            columns[at] = pa.array(listed)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return run


def build_cascade(keys: DataFrame, block_keys: int = BLOCK_KEYS) -> Cascade:
    """Cascade from (key, listed): all keys of the corpus and whether they are on the list.

    Level 1 encodes the listed keys. Level 2 encodes the other keys that level 1 knows
    by mistake, level 3 the listed keys that level 2 knows, and so on until a level
    makes no mistake. Every level is built and tested by tasks over stored keys; the
    driver holds the bits of one block.

    A key that occurs often is one key, listed if any of its rows is; a null mark is not
    listed. Without listed keys nothing is listed, and an empty table gives such a
    cascade too.
    """
    spark = keys.sparkSession
    first, second = key_hashes(F.col("key"))
    universe = keys.select(first.alias("first"), second.alias("second"), F.coalesce("listed", F.lit(False)).alias("listed"))
    universe = stored(universe.groupBy("first", "second").agg(F.max("listed").alias("listed")), "url-keys")
    n = universe.where("listed").count()
    blocks = max(1, -(-n // block_keys))
    remainder = F.pmod(F.pmod("first", F.lit(blocks)) + (F.when(F.col("first") < 0, (1 << 64) % blocks).otherwise(0)), F.lit(blocks))
    sent = []
    for number in range(blocks):
        own = universe.where(remainder == number) if blocks > 1 else universe
        inside, outside = own.where("listed").drop("listed"), own.where("not listed").drop("listed")
        levels: list[tuple[int, np.ndarray]] = []
        while size := inside.count():
            if len(levels) == MOST_LEVELS:
                raise ValueError("two keys of the universe share both hashes")
            level = len(levels)
            levels.append(_filter(inside, size, level, FIRST if level == 0 else OTHERS))
            bits = spark.sparkContext.broadcast(levels[-1][1])
            wrong = map_batches(outside, _mistaken(level, levels[-1][0], bits), "first long, second long")
            inside, outside = stored(wrong, "mistaken-keys"), inside
        sent.append(spark.sparkContext.broadcast(levels))
    return Cascade(sent)


def page_key(host: Column, path: Column) -> Column:
    return F.concat(host, path)


def judge_urls(pages: DataFrame, listed: Callable[[Column], Column], rules: tuple = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, listed) for each row of `pages` (page_id, url).

    The longest rule that fits decides. Where none does, a page is blocked if its host
    and path are on the list. The list is what `listed` says of a host; it is evaluated
    once for each distinct key when the cascade is built, and pages only ask the cascade.

    A null url or one without :// has an empty host and path, which are a key like any
    other. Repeated rows are judged alike, an empty table gives no rows, and other
    columns are ignored.
    """
    url = F.col("url").cast("string")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    keys = rows.select("host", page_key(F.col("host"), F.col("path")).alias("key"))
    cascade = build_cascade(keys.select("key", listed(F.col("host")).alias("listed")))
    asked = cascade.add_listed(rows, page_key(F.col("host"), F.col("path")))
    chosen = asked.withColumn("chosen", rule_of(F.col("host"), F.col("path"), rules))
    own = F.when(F.col("listed"), "block").otherwise("allow")
    return chosen.select(
        "page_id", "host", "path", F.col("chosen.rule").alias("rule"),
        F.coalesce("chosen.verdict", own).alias("verdict"), "listed",
    )


def host_has_word(names: tuple[str, ...] = LISTED_WORDS) -> Callable[[Column], Column]:
    """Hosts with one of the words between dots and hyphens."""
    pattern = rf"(^|[.-])({'|'.join(names)})([.-]|$)"
    return lambda host: host.rlike(pattern)
