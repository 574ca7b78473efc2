"""Exact search and hard negatives against all pairs in plain Python, and against their SQL."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.compare import connect, differences
from lakestrata.llm import hard_negatives, queries, tiles, topk_search

SCHEMA = "vec_id long, embedding array<float>, label int, score long, rank string, w int, row int, tile int, kind int"


def padded(rows):
    return [(*r, -1, "clash", 0, 0, 0, 0) for r in rows]


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(11)
    centre = rng.normal(size=(4, 8))
    out = [
        (i, [float(np.float32(x)) for x in centre[i % 4] + rng.normal(size=8) * 0.7], i % 4) for i in range(400)
    ]
    out += [
        (400, [0.25] * 8, 1),  # ties
        (401, [0.25] * 8, 2),
        (402, [0.25] * 8, 1),
        (420, out[20][1], 0),
        (20, out[20][1], 0),  # a repeated row
        (500, None, 1),
        (520, [0.1, None, 0.2], 1),
        (540, [0.1, float("nan"), 0.2], 1),
        (560, [float("inf"), 1.0], 1),
        (580, [], 1),
        (600, [0.5, -0.5, 1.5], 2),  # shorter
        (700, [0.5] * 12, None),
        (None, [0.5] * 8, 1),
        (800, [0.0] * 8, 3),
    ]
    return padded(out)


@pytest.fixture(params=[(4096, 1 << 16), (64, 7)], ids=["one tile", "many tiles"])
def small_tiles(request, monkeypatch):
    monkeypatch.setattr(tiles, "ROWS", request.param[0])
    monkeypatch.setattr(tiles, "QUERIES", request.param[1])
    monkeypatch.setattr(tiles, "CHUNK", 5)


def sound(rows, scale):
    out = []
    for vec_id, v, label, *_ in rows:
        if vec_id is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            out.append((vec_id, [math.floor(scale * float(np.float32(x))) for x in v], label))
    return out


def inner(a, b):
    return sum(x * y for x, y in zip(a, b))


def test_top_k_equals_all_pairs(spark, rows, small_tiles):
    good, expected = sound(rows, 64), []
    for q, (query_id, v, _) in enumerate(good):
        if query_id % 20 == 0:
            scored = sorted((-inner(v, w), i) for c, (i, w, _) in enumerate(good) if c != q)[:20]
            expected += [(query_id, k, i, -s) for k, (s, i) in enumerate(scored, start=1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = topk_search.top_k(docs, F.col("vec_id") % 20 == 0)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_fewer_rows_than_k_and_empty_tables(spark, rows):
    docs = spark.createDataFrame(rows[:5], SCHEMA)
    assert topk_search.top_k(docs, F.col("vec_id") == 0).count() == 4
    assert topk_search.top_k(docs, F.lit(None).cast("boolean")).collect() == []
    empty = spark.createDataFrame([], SCHEMA)
    assert topk_search.top_k(empty, F.col("vec_id") == 0).collect() == []
    assert hard_negatives.mined(empty, F.col("vec_id") == 0).collect() == []


def all_pairs_negatives(rows, every):
    good = [(i, w, label) for i, w, label in sound(rows, 256) if label is not None]
    out = []
    for a, (anchor, v, label) in enumerate(good):
        if anchor % every:
            continue
        scored = [(-inner(v, w), i, c) for c, (i, w, _) in enumerate(good) if c != a]
        same = sorted(s for s in scored if good[s[2]][2] == label)[:5]
        other = sorted(s for s in scored if good[s[2]][2] != label)
        for p, positive, _ in same:
            window = [(s, i) for s, i, _ in other if 30 * -p <= 100 * -s <= 90 * -p][:10]
            out += [(anchor, positive, k, i, -p, -s) for k, (s, i) in enumerate(window, start=1)]
    return sorted(out)


def test_hard_negatives_equal_all_pairs(spark, rows, small_tiles):
    docs = spark.createDataFrame(rows, SCHEMA)
    found = hard_negatives.mined(docs, F.col("vec_id") % 10 == 0)
    expected = all_pairs_negatives(rows, 10)
    assert sorted(map(tuple, found.collect())) == expected and len(expected) > 500


def test_the_index_leaves_out_what_norms_cover():
    """At a high threshold part of the components is neither indexed nor scored for most pairs; nothing is lost."""
    import pandas as pd

    rng = np.random.default_rng(3)
    vectors = [list(map(int, v)) for v in rng.normal(size=(500, 32)) * 50]
    block = hard_negatives.SuffixIndex(pd.DataFrame({"id": range(500), "row": range(500), "label": "x", "w": vectors}))
    asked = block.columns_of(vectors[:9])
    exact = np.array(vectors) @ np.array(vectors[:9]).T
    level = 0.5 * block.longest
    outside = (block.norms[:, 1:] < level).sum()
    assert 0.1 < outside / block.w.size < 0.9
    seen = {}

    def enough(q, at, score, limit):
        if np.isfinite(limit):
            seen[q] = (set(at.tolist()), limit, score.tolist() == exact[at, q].tolist())
        return True

    hard_negatives.lowered(block, asked, np.ones((500, 9), bool), [level], enough)
    for q, (at, limit, equal) in seen.items():
        assert equal and at == set(np.flatnonzero(exact[:, q] >= limit).tolist())
    assert len(seen) == 9


def test_scores_beyond_64_bits_are_an_error():
    with pytest.raises(OverflowError):
        tiles.whole_type(1 << 62)


@pytest.mark.parametrize("name", ["op12_topk_search", "op13_hard_negatives"])
def test_queries_equal_their_sql(spark, sf_dir, name):
    assert differences(spark, connect(sf_dir), queries.QUERIES[name], queries.ORACLES[name], sf_dir) == []
