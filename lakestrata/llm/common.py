"""Helpers shared by the operators: words, hashes, shared files and token ids."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.llm.encoding import kept_encoder, slices

# What separates words, and the capitals that are lower-cased.
WORD = r"[^\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, CAPITALS, CAPITALS.lower())


def words(text: Column) -> Column:
    """Array of words of a text; a null text has none."""
    return F.regexp_extract_all(text_or_empty(text), F.lit(WORD), F.lit(0))


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def shared_path(spark: SparkSession, what: str) -> str:
    """A new path under ``spark.checkpoint.dir``; set here only for a local session without one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = tempfile.mkdtemp(prefix="lakestrata-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{what}-{uuid.uuid4().hex}"


def stored(df: DataFrame, what: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts lineage and survives lost executors."""
    path = shared_path(df.sparkSession, what)
    df.write.parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    written.stored_path = path
    return written


def released(*frames: DataFrame) -> None:
    """Delete the files of ``stored`` frames that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def chunks(column: pa.ListArray, limit: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows lo to hi of a column of arrays of longs, their values one behind the other, and where each row ends there.

    A chunk has at most ``limit`` values, or one row with more.
    """
    offsets = column.offsets.to_numpy()
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        values = column.values.slice(offsets[lo], offsets[hi] - offsets[lo]).to_numpy(zero_copy_only=False)
        yield lo, hi, values, (offsets[lo + 1 : hi + 1] - offsets[lo]).astype(np.int64)
        lo = hi


def longs(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64), pa.int64())


def window_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of each run of ``length`` word hashes (polynomial modulo 2**64, then mixed).

    The base is odd, so it has an inverse and a run's polynomial is a difference of two prefix sums.
    """
    n = len(hashes) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    base = 0x9E3779B97F4A7C15
    with np.errstate(over="ignore"):
        down = np.full(len(hashes), pow(base, -1, 1 << 64), np.uint64).cumprod()
        up = np.full(n, base, np.uint64)
        up[0] = pow(base, length, 1 << 64)
        sums = np.concatenate([np.zeros(1, np.uint64), (hashes * down).cumsum()])
        h = (sums[length:] - sums[:-length]) * up.cumprod()
        h ^= h >> np.uint64(30)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(27)
        h *= np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def tokenized(df: DataFrame, tokenizer_path: str, end_id: int, key: str = "doc_id", text: str = "text",
              curve: Callable | None = None) -> DataFrame:
    """Token ids of each whole text with an end id, written once: ``key``, ``text_hash``, ``n_tokens``, ``ids``, ``row``.

    ``ids`` are little-endian unsigned integers of ``width`` bytes, 2 or, where the vocabulary needs them, 4.  ``row``
    tells equal rows apart.  ``curve`` makes a number for each of some documents' ids, in the same pass.
    """
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("doc_id"), text_or_empty(F.col(text)).alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_encoder(tokenizer_path)
        end = np.array([end_id], encoder.width)
        for batch in batches:
            texts = batch.column("text")
            for lo, hi in slices(texts):
                arrays = [np.concatenate([ids.astype(encoder.width), end]) for ids in encoder.ids(texts.slice(lo, hi - lo))]
                numbers = curve(arrays) if curve else np.zeros(hi - lo, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(lo, hi - lo),
                        batch.column("text_hash").slice(lo, hi - lo),
                        pa.array([len(a) for a in arrays], pa.int64()),
                        pa.array(np.full(hi - lo, encoder.width.itemsize, np.int32)),
                        pa.array([a.tobytes() for a in arrays], pa.binary()),
                        pa.array(numbers, pa.int64()),
                    ],
                    ["doc_id", "text_hash", "n_tokens", "width", "ids", "curve"],
                )
                del arrays
                pa.default_memory_pool().release_unused()  # else freed memory stays with the worker

    schema = f"doc_id {kind}, text_hash long, n_tokens long, width int, ids binary, curve long"
    return stored(rows.mapInArrow(encode, schema).withColumn("row", F.monotonically_increasing_id()), "token-ids")


def read_ids(data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, dtype=f"<u{width}").astype("<u4")


def in_order(tokens: DataFrame, order: list[str]) -> DataFrame:
    """Rows of ``tokenized`` dealt to sorted ranges; text hash, length and row number part a hot key."""
    keys = [*order, "text_hash", "n_tokens", "row"]
    parts = max(1, int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return tokens.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)


def range_starts(held: DataFrame) -> DataFrame:
    """part, part_start: the ids before each range, from rows of (part, n).  One sum per range reaches the driver."""
    sums = sorted((r["part"], r["n"]) for r in held.groupBy("part").agg(F.sum("n").alias("n")).collect())
    starts, before = [], 0
    for part, n in sums:
        starts.append((part, before))
        before += n
    return held.sparkSession.createDataFrame(starts, "part int, part_start long")


def ordered_stream(tokens: DataFrame, order: list[str], what: str) -> DataFrame:
    """Rows of ``tokenized`` in one global order, with ``stream_start``: the ids before each row.

    Rows are cut into sorted ranges, numbered inside each task and written to the shared folder.
    """
    schema = tokens.schema.simpleString()[len("struct<") : -1]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            sizes = batch.column("n_tokens").to_numpy()
            ends = np.cumsum(sizes) + before
            more = [pa.array(np.full(len(sizes), part, np.int32)), pa.array(ends - sizes)]
            names = [*batch.schema.names, "part", "within"]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names)
            before = int(ends[-1]) if len(ends) else before

    numbered = stored(in_order(tokens, order).mapInArrow(number, f"{schema}, part int, within long"), what)
    offsets = range_starts(numbered.select("part", F.col("n_tokens").alias("n")))  # one row per range
    return numbered.join(F.broadcast(offsets), "part").select(
        "*", (F.col("part_start") + F.col("within")).alias("stream_start")
    )
