"""Hard-negative mining: threshold joins over an index that leaves out what suffix norms cover."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.llm.common import stored
from lakestrata.llm.tiles import entries, tiled, whole_type, whole_vectors
from lakestrata.llm.topk_search import INNER, SOUND

STEP = 0.85  # each round lowers the threshold to this share
FLOOR = 0.05  # under this share of the longest vector the next round takes everything
SLACK = 1e-9  # rounding of the bounds
PAIRS = 1 << 14  # pairs whose left-out components are added together


class SuffixIndex:
    """Postings of a block whose lists grow as the threshold falls.

    Dimensions are taken in one order.  As long as the norm of a row's leading components is under a threshold,
    they alone cannot reach it with a query of length 1, so they stay out of the index.  A list holds its rows by
    that norm, so a lower threshold adds the next rows of each list.
    """

    def __init__(self, rows: pd.DataFrame):
        self.ids, self.rows, self.labels = (rows[c].to_numpy() for c in ("id", "row", "label"))
        place, dim, weight = entries(rows["w"].tolist())
        dims, column, often = np.unique(dim, return_inverse=True, return_counts=True)
        order = np.argsort(-often, kind="stable")  # frequent dimensions first: they are the ones left out
        self.dims = dims[order]
        self.w = np.zeros((len(rows), len(dims)), np.int64)
        self.w[place, np.argsort(order)[column]] = weight
        self.norms = np.zeros((len(rows), len(dims) + 1))
        np.sqrt(np.cumsum(self.w.astype(float) ** 2, axis=1), out=self.norms[:, 1:])
        self.longest = float(self.norms[:, -1].max(initial=0.0))
        self.lists, self.keys = [], []
        for d in range(len(dims)):
            at = np.flatnonzero(self.w[:, d])
            at = at[np.argsort(-self.norms[at, d + 1], kind="stable")]
            self.lists.append(at)
            self.keys.append(-self.norms[at, d + 1])

    def columns_of(self, vectors: list) -> np.ndarray:
        """The queries' components in the order of the index; dimensions that no row has add nothing."""
        place, dim, weight = entries(vectors)
        out = np.zeros((len(vectors), len(self.dims)), np.int64)
        by = np.argsort(self.dims)
        spot = np.searchsorted(self.dims, dim, sorter=by)
        here = by[np.minimum(spot, len(by) - 1)] if len(by) else np.zeros(len(dim), np.int64)
        known = self.dims[here] == dim if len(by) else np.zeros(len(dim), bool)
        out[place[known], here[known]] = weight[known]
        return out


def lowered(block: SuffixIndex, queries: np.ndarray, usable: np.ndarray, levels, enough: Callable) -> None:
    """Lower the threshold until ``enough(query, places, scores, threshold)`` holds for every query.

    In each round it gets all usable rows with a score of at least the threshold (none below is known), once the
    partial scores and the norms of what is left out have pruned the others.  ``levels`` are falling thresholds for
    a query of length 1; after the last the threshold is minus infinity and every row is scored.
    """
    count = len(block.ids)
    bound = int(np.abs(block.w).max(initial=0)) * int(np.abs(queries).max(initial=0)) * max(1, len(block.dims))
    partial = np.zeros((count, len(queries)), whole_type(bound))
    weights, asked = block.w.astype(partial.dtype), queries.astype(partial.dtype)
    ahead = np.zeros((len(queries), queries.shape[1] + 1))
    np.sqrt(np.cumsum(queries.astype(float) ** 2, axis=1), out=ahead[:, 1:])
    length = ahead[:, -1]
    done = np.zeros(len(block.dims), np.int64)
    open_ = np.ones(len(queries), bool)
    for level in [*levels, None]:
        least = level or 0.0
        for d, (at, key) in enumerate(zip(block.lists, block.keys)):
            upto = len(at) if level is None else int(np.searchsorted(key, -least, side="right"))
            if upto > done[d]:
                new = at[done[d] : upto]
                partial[new] += np.multiply.outer(weights[new, d], asked[:, d])
                done[d] = upto
        if level is None:
            out = np.zeros(count, np.int64)
            limit = np.full(len(queries), -np.inf)
        else:
            out = (block.norms[:, 1:] < least).sum(axis=1)  # leading components of each row that are left out
            limit = least * length
        rest = block.norms[np.arange(count), out][:, None] * ahead[:, out].T
        near = usable & open_ & ((partial + rest) * (1 + SLACK) + SLACK * (1 + np.abs(partial)) >= limit)
        at, of = np.nonzero(near)
        score = partial[at, of].astype(np.int64)
        shown = np.arange(len(block.dims))
        for lo in range(0, len(at) if out.any() else 0, PAIRS):
            x, q = at[lo : lo + PAIRS], of[lo : lo + PAIRS]
            left_out = np.where(shown < out[x][:, None], block.w[x], 0)
            score[lo : lo + PAIRS] += np.einsum("pd,pd->p", left_out, queries[q])
        keep = score >= limit[of]
        at, of, score = at[keep], of[keep], score[keep]
        by = np.argsort(of, kind="stable")  # places stay in ascending order within a query
        first = np.searchsorted(of[by], np.arange(len(queries) + 1))
        for q in np.flatnonzero(open_):
            mine = by[first[q] : first[q + 1]]
            open_[q] = not enough(q, at[mine], score[mine], limit[q])
        if not open_.any():
            return


def falling(top: float, least: float) -> list[float]:
    out = []
    while top > least and top > 0:
        out.append(top)
        top *= STEP
    return out


def highest(at: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places within ``at`` of its ``k`` best scores, ties to the smaller place."""
    return np.lexsort((at, -score))[:k]


class Positives:
    """The best rows of a block with the query's label."""

    def __init__(self, k: int):
        self.k = k

    def block(self, rows: pd.DataFrame) -> SuffixIndex:
        return SuffixIndex(rows)

    def chunk(self, block: SuffixIndex, queries: pd.DataFrame) -> pd.DataFrame:
        row, label, ids = (queries[c].to_numpy() for c in ("row", "label", "id"))
        usable = (block.labels[:, None] == label[None, :]) & (block.rows[:, None] != row[None, :])
        wanted = np.minimum(usable.sum(axis=0), self.k)
        found: dict[int, tuple] = {}

        def enough(q, at, score, limit) -> bool:
            if len(at) < wanted[q]:
                return False
            order = highest(at, score, self.k)
            found[q] = (at[order], score[order])
            return True

        levels = falling(0.6 * block.longest, FLOOR * block.longest)
        lowered(block, block.columns_of(queries["w"].tolist()), usable, levels, enough)
        frames = [
            pd.DataFrame({"anchor_row": row[q], "anchor_id": ids[q], "id": block.ids[at], "row": block.rows[at], "score": score})
            for q, (at, score) in found.items()
            if len(at)
        ]
        return pd.concat(frames, ignore_index=True) if frames else pd.DataFrame()


class Negatives:
    """The best rows of a block with another label in the window of each positive of the query."""

    def __init__(self, k: int, low: int, high: int):
        self.k, self.low, self.high = k, low, high

    def block(self, rows: pd.DataFrame) -> SuffixIndex:
        return SuffixIndex(rows)

    def chunk(self, block: SuffixIndex, queries: pd.DataFrame) -> pd.DataFrame:
        row, label, ids = (queries[c].to_numpy() for c in ("row", "label", "id"))
        windows = [[(p["rank"], p["id"], int(p["score"])) for p in w] for w in queries["windows"]]
        usable = block.labels[:, None] != label[None, :]
        vectors = block.columns_of(queries["w"].tolist())
        found: list[pd.DataFrame] = []

        def enough(q, at, score, limit) -> bool:
            open_windows = []
            for rank, positive, p in windows[q]:
                inside = np.flatnonzero((100 * score >= self.low * p) & (100 * score <= self.high * p))
                if len(inside) < self.k and 100 * limit > self.low * p:
                    open_windows.append((rank, positive, p))
                    continue
                order = inside[highest(at[inside], score[inside], self.k)]
                if len(order):
                    found.append(
                        pd.DataFrame(
                            {"anchor_row": row[q], "anchor_id": ids[q], "positive_rank": rank, "positive_id": positive,
                             "positive_score": p, "id": block.ids[at[order]], "score": score[order]}
                        )
                    )
            windows[q] = open_windows
            return not open_windows

        length = np.sqrt((vectors.astype(float) ** 2).sum(axis=1))
        tops = [max(p for *_, p in w) * self.high / 100 / n for w, n in zip(windows, length) if n > 0]
        floors = [min(p for *_, p in w) * self.low / 100 / n for w, n in zip(windows, length) if n > 0]
        levels = falling(STEP * max(tops, default=0.0), STEP * min(floors, default=0.0))
        lowered(block, vectors, usable, levels, enough)
        return pd.concat(found, ignore_index=True) if found else pd.DataFrame()


def mined(vectors: DataFrame, anchors: Column, row_id: str = "vec_id", vector: str = "embedding", label: Column | str = "label",
          scale: int = 256, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    An anchor's positives are its ``positives`` best other rows of its label; for each of them the first ``negatives``
    rows of other labels are kept whose score is ``low`` to ``high`` percent of the positive's.  Scores are inner
    products of floor(scale * x).  Blocks of rows are joined with anchors above a threshold that falls until every
    window of a block has its rows or its lower end is reached, and Spark keeps the best of all blocks.

    Rows without id or label, with a null vector or with a null or non-finite component take no part; a null in
    ``anchors`` is false.  Ties go to the smaller id.  Repeated rows are anchors, positives and negatives each.
    Vectors of different lengths agree on the dimensions that both have.  A negative positive score has an empty
    window; a score of 0 takes rows of score 0.  An empty table or no anchor gives no rows; other columns are not read.
    """
    kind = vectors.schema[row_id].dataType.simpleString()
    group = F.col(label) if isinstance(label, str) else label
    labelled = vectors.where(group.isNotNull())
    rows = whole_vectors(labelled, row_id, vector, scale, {"label": group.cast("string"), "asks": F.coalesce(anchors, F.lit(False))})
    base = rows.select("row", "id", "label", "w")
    asks = rows.where("asks").select("row", "id", "label", "w")
    near = tiled(base, asks, Positives(positives), f"anchor_row long, anchor_id {kind}, id {kind}, row long, score long")
    order = Window.partitionBy("anchor_row").orderBy(F.desc("score"), "id", "row")
    chosen = near.withColumn("rank", F.row_number().over(order)).where((F.col("rank") <= positives) & (F.col("score") >= 0))
    # At most ``positives`` entries per anchor.
    windows = chosen.groupBy(F.col("anchor_row").alias("row")).agg(F.collect_list(F.struct("rank", "id", "score")).alias("windows"))
    asking = stored(asks.join(windows, "row"), "windows")
    found = tiled(
        base,
        asking,
        Negatives(negatives, low, high),
        f"anchor_row long, anchor_id {kind}, positive_rank int, positive_id {kind}, positive_score long, id {kind}, score long",
    )
    order = Window.partitionBy("anchor_row", "positive_rank").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


ORACLE = f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND {SOUND}),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS other, a.label = c.label AS same, {INNER.format(a="a.w", b="c.w")} AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
  other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
