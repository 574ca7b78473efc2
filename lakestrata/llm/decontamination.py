"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment of passages with items."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import stored, text_or_empty, window_hashes

SEED = 5  # words of a seed; an item with fewer is one seed
LIMIT = 0.5  # alignment score over that of a full copy
FILTER_BITS = 1 << 22
MATCH, OTHER, GAP = 2, -1, -1


def plain_words(text):
    return F.regexp_extract_all(F.lower(text_or_empty(text)), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def alignment_score(a: np.ndarray, b: np.ndarray) -> int:
    """Best local alignment of two word arrays (match 2, other word -1, gap -1)."""
    best, row, steps = 0, np.zeros(len(b) + 1, np.int64), -GAP * np.arange(len(b) + 1)
    for w in a:
        new = np.zeros(len(b) + 1, np.int64)
        new[1:] = np.maximum(np.maximum(0, row[:-1] + np.where(b == w, MATCH, OTHER)), row[1:] + GAP)
        row = np.maximum.accumulate(new + steps) - steps
        best = max(best, int(row.max()))
    return best


def grams(rows: DataFrame, lengths: list[int], bits: np.ndarray | None, whole_below: int = 0) -> DataFrame:
    """h, pos and the key columns of each n-gram; of those whose bit is set, where ``bits`` is given.

    With ``whole_below`` a text of fewer words is one n-gram.
    """
    keys = [c for c in rows.columns if c != "wh"]
    schema = rows.select(*keys).schema.simpleString()[len("struct<") : -1]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                words = np.asarray(r.wh, np.int64).view(np.uint64)
                for n in [len(words)] if len(words) < whole_below else lengths:
                    h = window_hashes(words, n) if n else words
                    at = np.arange(len(h))
                    if bits is not None:
                        slot = (h % np.uint64(FILTER_BITS)).astype(np.int64)
                        at = np.flatnonzero(bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1)
                    if len(at):
                        columns = {k: getattr(r, k) for k in keys}
                        yield pd.DataFrame({**columns, "h": h[at].view(np.int64), "pos": at.astype("int32")})

    return rows.mapInPandas(cut, f"{schema}, h long, pos int")


def matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id",
            item_id: str = "item_id", item_text: str = "text", limit: float = LIMIT) -> DataFrame:
    """doc_id, item_id, score (1 for a full copy): documents that hold a benchmark item, edited or not.

    Documents are searched through a fixed-size bit filter of the items' n-grams, so only possible seeds are
    shuffled.  Every n-gram of an item is a seed, so any one that a document shares leads to an alignment; none is
    left out for being frequent.  Passages of equal words are aligned once.  Null and empty texts match nothing; a
    null document id is not returned; repeated rows give one result.
    """
    hashed = lambda words: F.transform(words, lambda w: F.xxhash64(w))
    items = benchmark.select(F.col(item_id).alias("item"), hashed(plain_words(F.col(item_text))).alias("wh"))
    items = stored(items.where("size(wh) > 0 and item is not null").dropDuplicates(), "items")
    short = sorted(r["n"] for r in items.select(F.least(F.size("wh"), F.lit(SEED)).alias("n")).distinct().collect())
    item_grams = stored(
        grams(items.withColumn("len", F.size("wh")), [SEED], None, whole_below=SEED), "item-grams"
    )

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        flags = np.zeros(FILTER_BITS, np.uint8)
        for batch in batches:
            flags[(batch["h"].to_numpy().view(np.uint64) % np.uint64(FILTER_BITS)).astype(np.int64)] = 1
        yield pd.DataFrame({"bits": [np.packbits(flags, bitorder="little").tobytes()]})

    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in item_grams.select("h").mapInPandas(fill, "bits binary").toLocalIterator():  # half a megabyte each
        bits |= np.frombuffer(r["bits"], np.uint8)

    rows = docs.select(
        F.col(doc_id).alias("id"), F.xxhash64(text_or_empty(F.col(text))).alias("th"), F.col(text).alias("body")
    ).where(F.col("id").isNotNull())
    searched = rows.select("id", "th", hashed(plain_words(F.col("body"))).alias("wh"))
    hits = stored(grams(searched, short, bits), "hits")

    # Every item n-gram that a document holds is a seed: an edited one beside it cannot mask it.
    seeds = item_grams.select("item", "len", "h", F.col("pos").alias("ipos"))

    # A passage reaches half an item over each side of a stretch of diagonals one item long.
    stretch = F.floor((F.col("pos") - F.col("ipos")) / F.col("len"))
    found = hits.join(seeds, "h").select("id", "th", "item", "len", stretch.alias("part")).distinct()
    start = F.greatest(F.lit(0), (F.col("part") * F.col("len") - F.col("len") / 2).cast("int"))
    end = ((F.col("part") + 2) * F.col("len") + F.col("len") / 2).cast("int") + 1
    cut = stored(
        rows.dropDuplicates(["id", "th"])
        .join(found, ["id", "th"])
        .withColumn("passage", F.slice(hashed(plain_words(F.col("body"))), start + 1, end - start))
        .select("id", "item", "len", "passage", F.xxhash64("passage").alias("ph")),
        "passages",
    )
    once = cut.dropDuplicates(["item", "len", "ph"]).select("item", "len", "ph", "passage")
    items = items.select("item", F.size("wh").alias("len"), "wh")

    @F.pandas_udf("long")
    def align(passage: pd.Series, item: pd.Series) -> pd.Series:
        return pd.Series([alignment_score(np.asarray(p), np.asarray(q)) for p, q in zip(passage, item)], dtype="int64")

    scored = once.join(items, ["item", "len"]).withColumn("score", align("passage", "wh") / (MATCH * F.col("len")))
    good = scored.where(F.col("score") >= limit).select("item", "len", "ph", "score").dropDuplicates(["item", "len", "ph"])
    return cut.select("id", "item", "len", "ph").join(good, ["item", "len", "ph"]).groupBy("id", "item").agg(
        F.max("score").alias("score")
    ).select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "score")


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item."""
    held = matches(docs, benchmark).select(F.col("doc_id").alias("__held")).distinct()
    return docs.join(held, F.col("doc_id") == F.col("__held"), "left_anti")
