"""Substring dedup against plain Python: covered words, factors and odd tables."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakestrata.llm import substring_dedup
from lakestrata.llm.common import window_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words_of(text):
    return WORD.findall(text or "")


def brute_force(rows):
    """(doc_id, n_words, n_removed, kept_sha256) of each row, straight from the contract."""
    first = {}
    for i, text in rows:
        w = words_of(text)
        for k in range(len(w) - 49):
            if i is not None:
                key = tuple(w[k : k + 50])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, text in rows:
        w = words_of(text)
        keep = [True] * len(w)
        for k in range(len(w) - 49):
            if i is not None and first[tuple(w[k : k + 50])] < i:
                keep[k : k + 50] = [False] * 50
        kept = " ".join(x for x, y in zip(w, keep) if y)
        out.append((i, len(w), len(w) - sum(keep), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def corpus():
    rng = np.random.default_rng(11)
    draw = lambda n: [f"w{x}" for x in rng.integers(0, 400, n)]
    passages = [draw(n) for n in (49, 50, 51, 70, 130, 400)]
    rows = []
    for i in range(80):
        parts = []
        for _ in range(int(rng.integers(1, 5))):
            p = list(passages[int(rng.integers(len(passages)))])
            lo = int(rng.integers(0, 15))
            p = p[lo:] if rng.random() < 0.5 else p[: len(p) - lo]
            if rng.random() < 0.3:
                p[int(rng.integers(len(p)))] = "edited"
            parts += p + (draw(int(rng.integers(0, 40))) if rng.random() < 0.6 else [])
        rows.append((int(rng.integers(-10, 1000)), (" " if i % 2 else "\n\t").join(parts)))
    same = rows[5][1]
    rows += [(rows[5][0], same), (2000, same), (2001, same + " tail"), (rows[7][0], rows[9][1])]  # repeats, two texts of an id
    rows += [(3000, "a " * 300), (3001, "a " * 120), (3002, "b " * 60 + "a " * 60), (3003, "a b " * 90)]  # ties of all anchors
    rows += [(4000, None), (4001, ""), (4002, "short"), (None, same), (None, None)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(5)


def test_covered_words_equal_brute_force(docs, rows):
    got = substring_dedup.deduplicated(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    expected = brute_force(rows)
    assert sorted(map(tuple, got), key=str) == expected
    assert sum(r[2] > 0 for r in expected) > 30


def test_small_chunks_change_nothing(docs, rows, monkeypatch):
    monkeypatch.setattr(substring_dedup, "CHUNK", 100)
    got = substring_dedup.deduplicated(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == brute_force(rows)


def test_factors_are_in_their_sources_and_cover_the_removed_words(spark, docs, rows):
    named = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"), "text")
    texts = {(r.doc_id, r.th): words_of(r.text) for r in named.collect()}
    found = substring_dedup.factors(docs).collect()
    covered = {}
    for f in found:
        own, source = texts[f.id, f.th], texts[f.source_id, f.source_th]
        assert f.source_id < f.id and f.length >= 50
        assert own[f.start : f.start + f.length] == source[f.source_start : f.source_start + f.length]
        covered.setdefault((f.id, f.th), set()).update(range(f.start, f.start + f.length))
    lost = {(r[0], r[1], r[2]) for r in brute_force(rows) if r[2]}
    assert {(k[0], len(texts[k]), len(v)) for k, v in covered.items()} == lost
    whole = [f for f in found if f.id == 2000]  # an exact copy is few factors, not one per window
    assert len(whole) < len(texts[2000, whole[0].th]) / 20


def test_ids_of_text_and_clashing_names(spark, rows):
    rows = [(str(i).zfill(5) if i is not None else None, text, -7, "mine") for i, text in rows if i is None or i >= 0]
    docs = spark.createDataFrame(rows, "doc_id string, text string, n_words int, C string")
    got = substring_dedup.deduplicated(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == brute_force([r[:2] for r in rows])
    own = substring_dedup.shortened(docs)
    assert own.columns == docs.columns
    kept = own.collect()
    assert len(kept) == len(rows) and {(r.n_words, r.C) for r in kept} == {(-7, "mine")}
    assert substring_dedup.deduplicated(docs.where("false")).count() == 0


def test_window_minima_and_hashes():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 50, 200).astype(np.uint64)
    for span in (1, 2, 7, 31, 32):
        expected = [values[k : k + span].min() for k in range(200 - span + 1)]
        assert substring_dedup.window_minima(values, span).tolist() == expected
    hashes = rng.integers(0, 2**63, 300).astype(np.uint64)
    for length in (1, 5, 50, 300):
        got = window_hashes(hashes, length)
        alone = [window_hashes(hashes[k : k + length], length)[0] for k in range(300 - length + 1)]
        assert got.tolist() == alone
