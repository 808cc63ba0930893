"""Token sequences in training order: keyed Feistel permutation and fixed-stride shards."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seriesmill.llm import tokenizer, words
from seriesmill.llm.scratch import map_batches, stored
from seriesmill.session import scratch_path, ship_package

#: Tokens of a sequence, sequences of a shard, and rounds of the Feistel network.
LENGTH, SHARD_SEQUENCES, ROUNDS = 2048, 2048, 6
KEY = "training-order-1"
_U = np.uint64


def feistel(index: np.ndarray, n: int, key: str = KEY) -> np.ndarray:
    """Slot of each index under a keyed permutation of 0 .. n-1.

    A balanced Feistel network permutes the smallest range of 4^b numbers that holds n.
    A value at or above n is sent through it again until it falls below (cycle-walking),
    which keeps the map one to one on 0 .. n-1 and takes under four walks on average.
    """
    half = max(1, -(-(max(n, 2) - 1).bit_length() // 2))
    mask = _U((1 << half) - 1)
    digest = hashlib.blake2b(key.encode(), digest_size=8 * ROUNDS).digest()
    keys = np.frombuffer(digest, "<u8").astype(_U)
    out = index.astype(_U)
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] >> _U(half), out[walking] & mask
        for k in keys:
            left, right = right, left ^ (words.mix(right + k) & mask)
        out[walking] = (left << _U(half)) | right
        walking = walking[out[walking] >= _U(n)]
    return out.astype(np.int64)


def _encode_batches(path: str, kind: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        encoder, part, before = tokenizer.load(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, starts, counts = [], [], []
            for text in batch.column(1).to_pylist():
                own = np.array([*encoder.encode(text), encoder.end] if text else [], kind)
                ids.append(own.tobytes())
                starts.append(before)
                counts.append(len(own))
                before += len(own)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([part] * len(ids), pa.int32()), pa.array(starts, pa.int64()),
                    pa.array(counts, pa.int64()), pa.array(ids, pa.binary()),
                ],
                ["doc_id", "part", "start", "n_tokens", "tokens"],
            )

    return run


def tokenised(docs: DataFrame, path: str) -> tuple[DataFrame, int]:
    """Stored (doc_id, part, start, n_tokens, tokens) and the bytes of a token.

    `part` is the task that read the document and `start` the tokens before it in that
    task. A null or empty text has no tokens; any other ends with the end token.
    """
    width = 2 if tokenizer.load(path).end < 1 << 16 else 4
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, part int, start long, n_tokens long, tokens binary"
    rows = map_batches(texts, _encode_batches(path, f"<u{width}"), schema)
    return stored(rows, "token-ids", "zstd"), width


def _assemble(length: int, width: int, end: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Join the pieces of a sequence, which arrive one after the other."""
    schema = pa.schema(
        [("shard", pa.int64()), ("slot", pa.int64()), ("sequence", pa.int64()), ("n_tokens", pa.int32()), ("tokens", pa.binary())]
    )
    padding = np.full(length, end, f"<u{width}").tobytes()

    def closed(slot, sequence, shard, pieces):
        ids = b"".join(pieces)
        n = len(ids) // width
        return {"shard": shard, "slot": slot, "sequence": sequence, "n_tokens": n, "tokens": ids + padding[len(ids) :]}

    def run(batches):
        current, pieces = None, []
        for batch in batches:
            out = []
            for shard, slot, sequence, piece in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if current is not None and current[0] != slot:
                    out.append(closed(*current, pieces))
                    pieces = []
                current = (slot, sequence, shard)
                pieces.append(piece)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if current is not None:
            yield pa.RecordBatch.from_pylist([closed(*current, pieces)], schema)

    return run


def write_shards(
    docs: DataFrame,
    folder: str,
    path: str | None = None,
    length: int = LENGTH,
    shard_sequences: int = SHARD_SEQUENCES,
    key: str = KEY,
) -> None:
    """Tokenise `docs` (doc_id, text) and write its sequences in training order below `folder`.

    Tokens of all documents, each closed by the end token, form one stream, cut into
    sequences of `length` tokens; the last is filled up with the end token. Sequence i
    gets slot feistel(i), and the slots k * shard_sequences and on form shard k, the
    folder `shard=k` with one file. Every row of a file has the same number of bytes of
    tokens and rows stand in the order of slots, so slot s is row s mod shard_sequences
    of shard s div shard_sequences, and a reader resumes anywhere without an index.

    Documents are read and tokenised once. The position of a document in the stream is
    the number of tokens of earlier tasks, one number per task, plus those before it in
    its own task. Only token pieces are shuffled, once, to the task that writes their
    shard. Files are committed by Spark's writer, so lost tasks leave nothing behind.

    Null and empty texts add nothing. Repeated rows and documents that share a doc_id
    are documents of their own. An empty table writes nothing but an empty folder.
    """
    spark = docs.sparkSession
    path = path or tokenizer.default_path()
    end = tokenizer.load(path).end
    rows, width = tokenised(docs, path)
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0")
    earlier = W.partitionBy(F.lit(0)).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("base"), "tokens")
    bases = stored(bases, "token-bases")
    total = bases.agg(F.sum("tokens")).first()[0] or 0
    n = -(-total // length)
    shards = -(-n // shard_sequences)

    ship_package(spark)
    slot_of = F.pandas_udf(_slots(n, key), "long")
    placed = rows.where("n_tokens > 0").join(bases.drop("tokens"), "part")
    placed = placed.select((F.col("base") + F.col("start")).alias("at"), "n_tokens", "tokens")
    first, last = F.expr(f"at div {length}"), F.expr(f"(at + n_tokens - 1) div {length}")
    pieces = placed.withColumn("sequence", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.col("at"), F.col("sequence") * length)
    stop = F.least(F.col("at") + F.col("n_tokens"), (F.col("sequence") + 1) * length)
    pieces = pieces.select(
        "sequence", begin.alias("begin"),
        _bytes(F.col("tokens"), (begin - F.col("at")) * width, (stop - begin) * width).alias("piece"),
    ).withColumn("slot", slot_of("sequence"))
    pieces = pieces.withColumn("shard", F.expr(f"slot div {shard_sequences}"))
    dealt = pieces.repartitionById(max(1, shards), F.col("shard").cast("int"))
    ordered = dealt.sortWithinPartitions("slot", "begin").select("shard", "slot", "sequence", "piece")
    schema = "shard long, slot long, sequence long, n_tokens int, tokens binary"
    sequences = map_batches(ordered, _assemble(length, width, end), schema)
    sequences.write.option("compression", "zstd").partitionBy("shard").parquet(folder)


def _slots(n: int, key: str) -> Callable[[pd.Series], pd.Series]:
    def slots(sequence: pd.Series) -> pd.Series:
        return pd.Series(feistel(sequence.to_numpy(np.int64), n, key))

    return slots


def _bytes(column: Column, start: Column, length: Column) -> Column:
    return F.substring(column, (start + 1).cast("int"), length.cast("int"))


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """(slot, shard, sequence, n_tokens, tokens) of written shards."""
    schema = "slot long, sequence long, n_tokens int, tokens binary, shard long"
    return spark.read.schema(schema).parquet(folder)


def training_order(docs: DataFrame, path: str | None = None, length: int = LENGTH) -> DataFrame:
    """Write shards to the shared folder and read back slot, place and digest of each sequence."""
    folder = scratch_path(docs.sparkSession, "training-shards")
    write_shards(docs, folder, path, length)
    rows = read_shards(docs.sparkSession, folder)
    return rows.select(
        "slot", "shard", (F.col("slot") % SHARD_SEQUENCES).alias("row_in_shard"), "sequence",
        F.col("n_tokens").cast("long").alias("n_tokens"), F.octet_length("tokens").cast("long").alias("stride"),
        F.sha1("tokens").alias("tokens_sha1"),
    )
