"""Packing along a space-filling curve: neighbours in content share a sequence."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import ordered_stream, read_ids, tokenized

DIMS, BITS = 4, 8
FEATURES = 1024  # length of the hashed vector
SEQUENCE = 2048
GROUP = 256  # documents whose vectors are held together


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place of each point (rows of integers below ``2**bits``) on the Hilbert curve."""
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    bit = 1 << (bits - 1)
    while bit > 1:
        low = bit - 1
        for d in range(dims):
            turn = (x[d] & bit) != 0
            swap = np.where(turn, 0, (x[0] ^ x[d]) & low)
            x[0] ^= np.where(turn, low, swap)
            x[d] ^= swap
        bit >>= 1
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    flip, bit = np.zeros_like(x[0]), 1 << (bits - 1)
    while bit > 1:
        flip ^= np.where((x[dims - 1] & bit) != 0, bit - 1, 0)
        bit >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for d in range(dims):
            key = (key << 1) | ((x[d] >> b) & 1)
    return key


def curve_points(arrays: list[np.ndarray], projection: np.ndarray) -> np.ndarray:
    """Hashed term vectors of the documents, projected to ``DIMS`` signed numbers and cut to ``BITS`` bits."""
    out = []
    for at in range(0, len(arrays), GROUP):
        group = arrays[at : at + GROUP]
        ids = np.concatenate(group).astype(np.uint64)
        slots = (ids * np.uint64(0x9E3779B1) >> np.uint64(7)) % np.uint64(FEATURES)
        of = np.repeat(np.arange(len(group)) * FEATURES, [len(g) for g in group])
        counts = np.bincount(slots.astype(np.int64) + of, minlength=len(group) * FEATURES).reshape(len(group), FEATURES)
        vectors = np.sqrt(counts)
        vectors /= np.maximum(np.sqrt(counts.sum(axis=1, keepdims=True)), 1.0)
        # Summed in one order for each document, whatever stands beside it.
        out.append(np.stack([(vectors * column).sum(axis=1) for column in projection.T], axis=1))
    places = (np.tanh(np.concatenate(out)) + 1) / 2 * (1 << BITS)
    return np.clip(places, 0, (1 << BITS) - 1).astype(np.int64)


def packed(docs: DataFrame, tokenizer_path: str, end_id: int = 1, sequence: int = SEQUENCE,
           text: str = "text", doc_id: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """One row per piece, with its ids and its place: a stream along the curve, cut every ``sequence`` ids.

    Only the last sequence may need padding; its padded length is the next power of two.  Null and empty texts
    hold the end id alone; equal rows are all packed; an empty table gives no pieces.  Other columns of ``docs``
    are not read.  Without ``with_ids`` the pieces have their crc32 only.
    """
    projection = np.random.default_rng(7).normal(size=(FEATURES, DIMS)) * 2.0

    def curve(arrays: list[np.ndarray]) -> np.ndarray:
        return hilbert_keys(curve_points(arrays, projection))

    # Tokenised once: the range cut reads the stored rows twice.
    tokens = tokenized(docs, tokenizer_path, end_id, doc_id, text, curve)
    stream = ordered_stream(tokens, ["curve", "doc_id"], "packed").select(
        "doc_id", "n_tokens", "width", "ids", "stream_start"
    )
    kind = docs.schema[doc_id].dataType.simpleString()

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zlib

        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                ids, start = read_ids(r.ids, r.width), 0
                while start < len(ids):
                    seq, offset = divmod(r.stream_start + start, sequence)
                    part = ids[start : start + sequence - offset].tobytes()
                    n = len(part) // 4
                    out.append((r.doc_id, start, n, zlib.crc32(part), len(ids), seq, offset, part if with_ids else None))
                    start += n
            yield pd.DataFrame(out, columns=columns)

    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    found = stream.mapInPandas(
        pieces,
        f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
        "offset long, ids binary",
    )
    return found if with_ids else found.drop("ids")
