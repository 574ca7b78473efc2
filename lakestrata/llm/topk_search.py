"""Exact top-k search: term-at-a-time accumulation over postings, selection per block, then a merge."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.llm.tiles import best, entries, tiled, whole_type, whole_vectors


class Postings:
    """The inverted index of a block: for each dimension the places and weights of its entries."""

    def __init__(self, rows: pd.DataFrame):
        self.ids, self.rows = rows["id"].to_numpy(), rows["row"].to_numpy()
        place, dim, weight = entries(rows["w"].tolist())
        order = np.argsort(dim, kind="stable")
        dims, first = np.unique(dim[order], return_index=True)
        self.lists = {
            d: (place[order[lo:hi]], weight[order[lo:hi]]) for d, lo, hi in zip(dims, first, [*first[1:], len(order)])
        }
        self.most = int(np.abs(weight).max(initial=0))


def accumulated(block: Postings, vectors: list) -> np.ndarray:
    """Scores of every row of the block (lines) for every query (columns), one term after the other."""
    place, dim, weight = entries(vectors)
    terms = np.unique(dim)
    kind = whole_type(block.most * int(np.abs(weight).max(initial=0)) * max(1, len(terms)))
    scores = np.zeros((len(block.ids), len(vectors)), kind)
    for d in terms:
        if d in block.lists:
            at, w = block.lists[d]
            mine = dim == d
            query = np.zeros(len(vectors), kind)
            query[place[mine]] = weight[mine]
            spread = np.multiply.outer(w.astype(kind), query)
            if len(at) == len(scores):
                scores += spread
            else:
                scores[at] += spread
    return scores


class Search:
    def __init__(self, k: int):
        self.k = k

    def block(self, rows: pd.DataFrame) -> Postings:
        return Postings(rows)

    def chunk(self, block: Postings, queries: pd.DataFrame) -> pd.DataFrame:
        scores = accumulated(block, queries["w"].tolist()).T
        own = block.rows[None, :] == queries["row"].to_numpy()[:, None]
        chosen = best(scores, ~own, self.k)
        lines = np.repeat(np.arange(len(chosen)), [len(c) for c in chosen])
        at = np.concatenate(chosen)
        return pd.DataFrame(
            {
                "query_row": queries["row"].to_numpy()[lines],
                "query_id": queries["id"].to_numpy()[lines],
                "id": block.ids[at],
                "score": scores[lines, at].astype(np.int64),
            }
        )


def top_k(vectors: DataFrame, queries: Column, k: int = 20, scale: int = 64, row_id: str = "vec_id",
          vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), the id, score: the ``k`` highest inner products of each query row with other rows.

    Components count as floor(scale * x).  Every row is scored: a block's postings are scattered into one dense
    score array per query, the block's best are selected by partition, and Spark keeps the best of all blocks.
    Ties go to the smaller id.  ``queries`` is a condition on ``vectors``; null is false.  Rows without id or
    with a null, or with a null or non-finite component, take no part.  Vectors of different lengths agree on
    the dimensions that both have; an empty vector scores 0.  Repeated rows are queries and candidates each, and
    are each other's candidates; an empty table or no query gives no rows.  Other columns are not read.
    """
    kind = vectors.schema[row_id].dataType.simpleString()
    rows = whole_vectors(vectors, row_id, vector, scale, {"asks": F.coalesce(queries, F.lit(False))})
    found = tiled(
        rows.select("row", "id", "w"),
        rows.where("asks").select("row", "id", "w"),
        Search(k),
        f"query_row long, query_id {kind}, id {kind}, score long",
    )
    # Spark limits each query to k rows a task before the shuffle.
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(row_id), "score")


# Rows that take part, with whole-number components.
SOUND = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
INNER = "CAST(list_sum(list_transform(list_zip({a}, {b}), lambda p: p[1] * p[2])) AS BIGINT)"

ORACLE = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings WHERE vec_id IS NOT NULL AND {SOUND}),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, {INNER.format(a="q.w", b="c.w")} AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
