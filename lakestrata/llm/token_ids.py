"""Token-id output: canonical length-limited Huffman blocks with bit-offset checkpoints."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import in_order, range_starts, read_ids, shared_path, tokenized

MAX_BITS = 18
BLOCK = 1 << 16  # ids per block
COUNTED = 1 << 20  # ids that are counted together
STEP = 64  # ids per checkpoint


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits, by package-merge; 0 for unused ids."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.int64)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64)
    levels, merged, is_leaf = [], weights, np.ones(len(order), bool)
    for _ in range(limit - 1):
        levels.append(is_leaf)
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weights, pairs])
        leaf = np.concatenate([np.ones(len(weights), bool), np.zeros(len(pairs), bool)])
        by = np.argsort(both, kind="stable")
        merged, is_leaf = both[by], leaf[by]
    levels.append(is_leaf)
    take = 2 * len(order) - 2
    for level in reversed(levels):
        leaves = int(level[:take].sum())
        lengths[order[:leaves]] += 1
        take = 2 * (take - leaves)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, id)."""
    codes, code, last = np.zeros(len(lengths), np.int64), 0, 0
    used = np.flatnonzero(lengths)
    for i in used[np.argsort(lengths[used], kind="stable")]:
        code <<= int(lengths[i]) - last
        codes[i], last = code, int(lengths[i])
        code += 1
    return codes


def decoding_table(lengths: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Id, times 32, and code length for each value of the next ``limit`` bits."""
    used = np.flatnonzero(lengths)
    order = used[np.argsort(lengths[used], kind="stable")]
    fill = 1 << (limit - lengths[order])
    table = np.ones(1 << limit, np.int64)
    table[: int(fill.sum())] = np.repeat(order << 5 | lengths[order], fill)
    return table


def encode(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, list[int]]:
    """Payload and the bit offset of every ``STEP``-th id."""
    size = lengths[ids]
    ends = np.cumsum(size)
    starts = ends - size
    # A code lies in one or two words of 32 bits; the bits of a word are disjoint, so adding joins them.
    shifted = codes[ids].astype(np.uint64) << (64 - (starts & 31) - size).astype(np.uint64)
    word, n = starts >> 5, int(ends[-1] >> 5) + 2 if len(ids) else 0
    high = np.bincount(word, (shifted >> np.uint64(32)).astype(np.float64), n)
    low = np.bincount(word + 1, (shifted & np.uint64(0xFFFFFFFF)).astype(np.float64), n)
    payload = (high + low).astype(">u4").tobytes()
    return payload[: (int(ends[-1]) + 7) // 8 if len(ids) else 0], starts[::STEP].tolist()


def decode(payload: bytes, checkpoints: np.ndarray, n: int, table: np.ndarray) -> np.ndarray:
    """All ids of a block: the lanes between checkpoints advance together."""
    # Padded, as the last lane may go on to its full length.
    raw = np.frombuffer(payload + b"\0" * (STEP * MAX_BITS // 8 + 8), np.uint8).astype(np.int64)
    # The 32 bits that start at each byte.
    data = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
    at, out = np.array(checkpoints, np.int64), np.zeros((STEP, len(checkpoints)), np.uint32)
    mask = (1 << MAX_BITS) - 1
    for k in range(STEP):
        found = table[data[at >> 3] >> (32 - MAX_BITS - (at & 7)) & mask]
        out[k] = found >> 5
        at += found & 31
    return out.T.reshape(-1)[:n].astype("<u4")


def added(total: np.ndarray, held: list[np.ndarray]) -> np.ndarray:
    """Counts per id, with those of more arrays."""
    more = np.bincount(np.concatenate(held)) if held else np.zeros(0, np.int64)
    out = np.zeros(max(len(total), len(more)), np.int64)
    out[: len(total)] += total
    out[: len(more)] += more
    return out


def write_ids(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = 2,
              text: str = "text", doc_id: str = "doc_id") -> None:
    """Write the ids of all documents in ascending id order to ``path``: ``codes``, ``blocks`` and ``ranges``.

    The files of ``blocks`` ascend by name, and the documents in them by id.  A block holds a bounded number of ids,
    the slices of documents it covers and its checkpoints, and is decoded alone.  A slice's start counts from its
    range, and ``ranges`` has the ids before each.  Null and empty texts hold the end id; equal rows are all written, nulls first; other columns are not read.
    """
    spark = docs.sparkSession
    tokens = tokenized(docs, tokenizer_path, end_id, doc_id, text)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, size = np.zeros(0, np.int64), [], 0
        for batch in batches:
            for data, width in zip(batch.column("ids"), batch.column("width").to_pylist()):
                held.append(np.frombuffer(data.as_buffer(), f"<u{width}"))
                size += len(held[-1])
                if size >= COUNTED:
                    total, held, size = added(total, held), [], 0
        total = added(total, held)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["id", "n"])

    partial = tokens.select("ids", "width").mapInArrow(count, "id long, n long")
    rows = partial.groupBy("id").agg(F.sum("n").alias("n")).collect()  # at most one per vocabulary entry
    counts = np.zeros(max((r["id"] for r in rows), default=0) + 1, np.int64)
    for r in rows:
        counts[r["id"]] = r["n"]
    lengths = code_lengths(counts)
    codes = canonical_codes(lengths)
    kind = docs.schema[doc_id].dataType.simpleString()
    used = np.flatnonzero(lengths)
    pairs = pd.DataFrame({"id": used, "bits": lengths[used]})
    spark.createDataFrame(pairs, "id long, bits long").coalesce(1).write.parquet(f"{path}/codes")

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, before = TaskContext.get().partitionId(), 0
        held: list = []
        size = 0

        def block() -> pd.DataFrame:
            ids = np.concatenate([p for *_, p in held])
            payload, marks = encode(ids, lengths, codes)
            slices = [{"doc_id": d, "within": s, "n_tokens": n, "piece": k, "length": len(p)} for d, s, n, k, p in held]
            return pd.DataFrame([{"part": part, "n": len(ids), "payload": payload, "checkpoints": marks, "slices": slices}])

        for batch in batches:
            for r in batch.itertuples(index=False):
                ids = read_ids(r.ids, r.width)
                if held and size + len(ids) > BLOCK:
                    yield block()
                    held, size = [], 0
                for k in range(0, len(ids), BLOCK):
                    held.append((r.doc_id, before, r.n_tokens, k, ids[k : k + BLOCK]))
                    size += len(held[-1][-1])
                    if size >= BLOCK:
                        yield block()
                        held, size = [], 0
                before += len(ids)
        if held:
            yield block()

    # Each task writes the file of its own range, so the names keep the order.
    in_order(tokens, ["doc_id"]).select("doc_id", "n_tokens", "width", "ids").mapInPandas(
        blocks,
        "part int, n long, payload binary, checkpoints array<long>, "
        f"slices array<struct<doc_id: {kind}, within: long, n_tokens: long, piece: long, length: long>>",
    ).write.parquet(f"{path}/blocks")
    range_starts(spark.read.parquet(f"{path}/blocks").select("part", "n")).coalesce(1).write.parquet(f"{path}/ranges")


def read_slices(spark, path: str, kind: str = "bigint", cut_only: bool = False) -> DataFrame:
    """Decode the files: doc_id, start, n_tokens, piece (first id within the document), crc32 and its ids as 32-bit.

    With ``cut_only`` the ids are returned of documents that lie in several pieces only.
    """
    rows = spark.read.parquet(f"{path}/codes").collect()  # at most one per vocabulary entry
    lengths = np.zeros(max((r["id"] for r in rows), default=0) + 1, np.int64)
    for r in rows:
        lengths[r["id"]] = r["bits"]

    def decoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lookup = decoding_table(lengths)
        for batch in batches:
            for b in batch.itertuples(index=False):
                ids, at, out = decode(b.payload, b.checkpoints, b.n, lookup), 0, []
                for s in b.slices:
                    part = ids[at : at + s["length"]].tobytes()
                    given = None if cut_only and s["length"] == s["n_tokens"] else part
                    start = b.part_start + s["within"]
                    out.append((s["doc_id"], start, s["n_tokens"], s["piece"], zlib.crc32(part), given))
                    at += s["length"]
                yield pd.DataFrame(out, columns=["doc_id", "start", "n_tokens", "piece", "piece_crc32", "ids"])

    # One row per range.
    blocks = spark.read.parquet(f"{path}/blocks").join(F.broadcast(spark.read.parquet(f"{path}/ranges")), "part")
    return blocks.mapInPandas(
        decoded, f"doc_id {kind}, start long, n_tokens long, piece long, piece_crc32 long, ids binary"
    )


def digests(slices: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of each document's ids; long documents have their pieces joined."""

    @F.pandas_udf("long")
    def crc(pieces: pd.Series) -> pd.Series:
        def one(found) -> int:
            value = 0
            for p in sorted(found, key=lambda p: p["piece"]):
                value = zlib.crc32(p["ids"], value)
            return value

        return pieces.map(one)

    # One pass: a document in one piece has its digest already.
    given = F.when(F.col("ids").isNotNull(), F.struct("piece", "ids"))
    found = slices.groupBy("doc_id", "start", "n_tokens").agg(
        F.max("piece_crc32").alias("whole"), F.collect_list(given).alias("p")
    )
    joined = F.when(F.size("p") == 0, F.col("whole")).otherwise(crc("p"))
    return found.select("doc_id", "start", "n_tokens", joined.alias("ids_crc32"))


def round_trip(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Write all documents and return the digests of what the files hold."""
    path = shared_path(docs.sparkSession, "token-ids")
    write_ids(docs, tokenizer_path, path, end_id)
    return digests(read_slices(docs.sparkSession, path, docs.schema["doc_id"].dataType.simpleString(), cut_only=True))
