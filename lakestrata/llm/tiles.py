"""A stated query set against all rows, in tiles: each task meets a bounded block of rows with a bounded slot of queries."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import stored

ROWS = 4096  # rows of a block on average; fewer where vectors are long
CELLS = 1 << 20  # numbers of a block on average
QUERIES = 1 << 16  # queries of a tile on average
CHUNK = 64  # queries that are scored together


def whole_vectors(df: DataFrame, row_id: str, vector: str, scale: int, keep: dict[str, Column]) -> DataFrame:
    """row, id, ``w`` (each component x as floor(scale * x), x as double) and ``keep``, written once.

    Rows without id, with a null vector or with a null or non-finite component take no part; an empty vector does.
    ``row`` tells repeated rows apart.  A component beyond 32 bits after scaling raises an error.
    """
    v = F.col(vector)
    # Not-a-number is greater than infinity in Spark.
    sound = F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("int"))
    used = df.where(F.col(row_id).isNotNull() & v.isNotNull() & sound)
    rows = used.select(F.col(row_id).alias("id"), whole.alias("w"), *(c.alias(n) for n, c in keep.items()))
    return stored(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")


def tiled(rows: DataFrame, queries: DataFrame, score: Any, schema: str) -> DataFrame:
    """The frames that ``score`` returns for every block of ``rows`` and chunk of ``queries``.

    Both have row, id and w.  Rows are dealt to blocks and queries to slots by a hash, so no key can be hot; a row
    goes to one tile per slot and a query to one tile per block.  A task streams its tiles, holding one block:
    ``score.block(rows)`` gets its rows in ascending order of id, ``score.chunk(block, queries)`` some queries.
    """
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("w")).alias("d")).first()
    width = max(64, min(ROWS, CELLS // max(1, size["d"] or 1)))
    blocks = max(1, -(-size["n"] // width))
    slots = max(1, -(-queries.count() // QUERIES))
    deal = lambda n, seed: F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>"))
    left = rows.withColumns({"kind": F.lit(0), "block": deal(blocks, 1)}).withColumn("slot", every(slots))
    right = queries.withColumns({"kind": F.lit(1), "slot": deal(slots, 2)}).withColumn("block", every(blocks))
    both = left.unionByName(right, allowMissingColumns=True)
    both = both.withColumn("tile", F.col("block") * slots + F.col("slot")).drop("block", "slot")
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(blocks * slots, 20_000))
    dealt = both.repartition(tasks, "tile").sortWithinPartitions("tile", "kind", "id", "row")

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        tile, block = None, None
        for batch in batches:
            if not len(batch):
                continue
            t, k = batch["tile"].to_numpy(), batch["kind"].to_numpy()
            new = np.flatnonzero((t[1:] != t[:-1]) | (k[1:] != k[:-1])) + 1
            for lo, hi in zip([0, *new], [*new, len(batch)]):
                part = batch.iloc[lo:hi]
                if k[lo] == 0:
                    if t[lo] != tile:
                        held, tile, block = [], t[lo], None
                    held.append(part)
                elif t[lo] == tile:
                    if block is None:
                        block, held = score.block(pd.concat(held, ignore_index=True)), []
                    for at in range(0, len(part), CHUNK):
                        found = score.chunk(block, part.iloc[at : at + CHUNK])
                        if len(found):
                            yield found

    return dealt.mapInPandas(scored, schema)


def entries(vectors: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, dimension and weight of every component that is not zero; vectors may differ in length."""
    lengths = np.array([len(v) for v in vectors], np.int64)
    flat = np.concatenate([np.asarray(v, np.int64) for v in vectors]) if lengths.sum() else np.zeros(0, np.int64)
    place = np.repeat(np.arange(len(vectors)), lengths)
    dim = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    some = flat != 0
    return place[some], dim[some], flat[some]


def whole_type(bound: int) -> type:
    """The integer type that holds sums up to ``bound``; an error where none does."""
    if bound >= 1 << 62:
        raise OverflowError("scores do not fit 64 bits")
    return np.int32 if bound < 1 << 31 else np.int64


def best(scores: np.ndarray, usable: np.ndarray, k: int) -> list[np.ndarray]:
    """For each line of ``scores`` the places of its ``k`` highest usable values, ties to the left; in no order."""
    n = scores.shape[1]
    out = []
    if n and (abs(int(scores.max())) + abs(int(scores.min())) + 1) * n < 1 << 62:
        keys = np.where(usable, scores.astype(np.int64) * n + np.arange(n)[::-1], np.iinfo(np.int64).min)
        chosen = np.argpartition(keys, -k, axis=1)[:, -k:] if n > k else np.tile(np.arange(n), (len(scores), 1))
        return [c[u[c]] for c, u in zip(chosen, usable)]
    for line, use in zip(scores, usable):
        order = np.lexsort((np.arange(n), -line))
        out.append(order[use[order]][:k])
    return out
