"""N-gram Jaccard join: size-banded tiles, bitmap bounds, exact intersection of sorted arrays."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from lakestrata.llm.common import chunks, longs, lower_ascii, released, stored, text_or_empty, window_hashes, word_hashes

SHINGLE = 5
PERCENT = 80
LANES = 16  # signature: LANES words of 64 bits
SPREAD = 4  # bits of a wide signature per element, at least
CHUNK = 1 << 19  # words that a worker handles at once; bounds its memory
WIDTH = 3  # steps of a factor 1 / 0.8 in size that a band spans
COMMON = 1 << 16  # common shingles whose order is known; any order gives the same result


def shingle_sets(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", n: int = SHINGLE) -> DataFrame:
    """One row per row of ``docs``: id, ``th`` (hash of the text), ``s``, the sorted distinct hashes of its shingles
    (without words none), and their bitmap ``g``."""
    body = F.xxhash64(text_or_empty(F.col(text))).alias("th")
    hashes = word_hashes(lower_ascii(text_or_empty(F.col(text)))).alias("wh")
    rows = docs.select(F.col(doc_id).alias("id"), body, hashes)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, values, ends in chunks(batch.column("wh"), CHUNK):
                found, signatures = [], np.empty((hi - lo, LANES), np.int64)
                for k, h in enumerate(np.split(values.view(np.uint64), ends[:-1])):
                    s = np.unique(window_hashes(h, min(n, len(h)) or 1).view(np.int64))
                    bits = np.zeros(LANES * 64, np.uint8)
                    bits[s.view(np.uint64) % np.uint64(LANES * 64)] = 1
                    found.append(s)
                    signatures[k] = np.packbits(bits).view(np.int64)
                edges = np.cumsum([0] + [len(s) for s in found]).astype(np.int32)
                lanes = np.arange(0, signatures.size + 1, LANES, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(lo, hi - lo),
                        batch.column("th").slice(lo, hi - lo),
                        pa.ListArray.from_arrays(pa.array(edges), longs(np.concatenate(found))),
                        pa.ListArray.from_arrays(pa.array(lanes), longs(signatures.ravel())),
                    ],
                    ["id", "th", "s", "g"],
                )

    kind = docs.schema[doc_id].dataType.simpleString()
    return rows.mapInArrow(sets, f"id {kind}, th long, s array<long>, g array<long>")


def common_shingles(sets: DataFrame) -> np.ndarray:
    """Up to ``COMMON`` shingles that are frequent, rarest first; bounds the driver's share and the closure.

    Copies count too, so that the sets need no shuffle before.  Only the order of prefixes depends on it, never a result.
    """

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                values, counts = np.unique(np.concatenate(batch["s"].to_numpy()), return_counts=True)
                often = counts >= 4
                yield pd.DataFrame({"h": values[often], "n": counts[often]})

    totals = sets.select("s").mapInPandas(local, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    top = totals.orderBy(F.desc("n"), "h").limit(COMMON).collect()
    return np.array([r["h"] for r in reversed(top)], np.int64)


def prefixes(sets: DataFrame, common: np.ndarray, percent: int = PERCENT) -> DataFrame:
    """row, ``p`` (the prefix shingles of its set) and ``bands``: its tiles are all pairs of both.

    Linked sets share a shingle among the first ``n - ceil(0.8 n) + 1`` of one order, and their sizes differ by
    a factor of 1 / 0.8 at most: each set visits its own band and that of its largest partners, the same or the next.
    """
    by_hash = np.argsort(common, kind="stable")
    hashes = common[by_hash]
    step = math.log(100 / percent)
    place = lambda size: math.log(size) / (WIDTH * step)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found, bands = [], []
            for s in batch["s"]:
                s = np.asarray(s, np.int64)
                rank = np.zeros(len(s), np.int64)
                if len(hashes):
                    at = np.minimum(np.searchsorted(hashes, s), len(hashes) - 1)
                    rank = np.where(hashes[at] == s, by_hash[at] + 1, 0)
                keep = len(s) - (percent * len(s) + 99) // 100 + 1
                found.append(s[np.lexsort((s, rank))[:keep]])
                # A hair's breadth over the edge keeps rounding from parting two sets.
                low, high = math.floor(place(len(s))), math.floor(place(len(s) * 100 / percent) + 1e-9)
                bands.append(np.arange(low, high + 1, dtype=np.int32))
            yield pd.DataFrame({"row": batch["row"], "p": found, "bands": bands})

    filled = sets.where("id is not null and n > 0").select("row", "s")
    return filled.mapInPandas(cut, "row long, p array<long>, bands array<int>")


@F.pandas_udf(ArrayType(LongType()))
def wide_bitmaps(sets: pd.Series) -> pd.Series:
    """A bitmap of each set, of the power of two from ``SPREAD`` bits an element on, ``LANES`` words at least."""

    def one(s: np.ndarray) -> np.ndarray:
        bits = np.zeros(max(LANES * 64, 1 << (SPREAD * len(s) - 1).bit_length()), np.uint8)
        bits[s.view(np.uint64) % np.uint64(len(bits))] = 1
        return np.packbits(bits).view(np.int64)

    return sets.map(lambda s: one(np.array(s, np.int64)))


def bounded(pairs: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that can be links by the bitmaps ``g`` of their sets and their sizes ``n``."""
    left = signatures.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("g").alias("ga"))
    right = signatures.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("g").alias("gb"))
    both = pairs.join(left, "a").join(right, "b")
    # Sizes of links differ by a factor of 1 / 0.8 at most, so the widths are the same or one is twice the other.
    alike = both.where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    width = F.least(F.size("ga"), F.size("gb"))
    fold = lambda g: F.when(F.size(g) == width, F.col(g)).otherwise(
        F.zip_with(F.slice(g, 1, width), F.slice(g, width + 1, width), lambda p, q: p.bitwiseOR(q))
    )
    alike = alike.withColumns({"ga": fold("ga"), "gb": fold("gb")})
    # Each bit of one signature that the other lacks stands for an element that the other lacks.
    only = lambda x, y: F.aggregate(
        F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseAND(F.bitwise_not(q)))), F.lit(0), lambda c, v: c + v
    )
    bound = F.least(F.col("na") - only(F.col("ga"), F.col("gb")), F.col("nb") - only(F.col("gb"), F.col("ga")))
    return alike.where((100 + percent) * bound >= percent * (F.col("na") + F.col("nb"))).select("a", "b")


def verified(pairs: DataFrame, small: DataFrame, fetch: Callable, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) that are links: bounded from above by their bitmaps, short ones and then wide, then intersected.

    ``small`` has id, n and g; ``fetch`` makes the sets (row, s) of the rows that are in a pair that the bound leaves.
    These are written first, so Spark knows their size before it chooses how to join.  Whole sets are moved only for
    the pairs that the wide bitmaps leave.
    """
    rough = stored(bounded(pairs, small, percent), "rough")
    asked = stored(rough.select(F.explode(F.array("a", "b")).alias("row")).distinct(), "asked")
    asked_sets = stored(fetch(asked), "asked-sets")
    wide = asked_sets.select(F.col("row").alias("id"), F.size("s").alias("n"), wide_bitmaps("s").alias("g"))
    wide = stored(wide, "wide")
    near = stored(bounded(rough, wide, percent), "near")
    one = asked_sets.select(F.col("row").alias("a"), F.col("s").alias("sa"))
    two = asked_sets.select(F.col("row").alias("b"), F.col("s").alias("sb"))

    @F.pandas_udf("long")
    def overlap(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([len(np.intersect1d(p, q, assume_unique=True)) for p, q in zip(x, y)], dtype="int64")

    exact = near.join(one, "a").join(two, "b").withColumn("common", overlap("sa", "sb"))
    linked = (100 + percent) * F.col("common") >= percent * (F.size("sa") + F.size("sb"))
    found = stored(exact.where(linked).select("a", "b"), "links")
    released(rough, near, asked, asked_sets, wide)
    return found


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """id, comp: the smallest id reachable over links (a, b).  Labels spread and jump until none changes."""
    both = stored(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links"
    )
    labels = stored(both.groupBy("a").agg(F.least("a", F.min("b")).alias("comp")).withColumnRenamed("a", "id"), "labels")
    while True:
        spread = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("comp").alias("near"))
        near = labels.join(spread.withColumnRenamed("a", "id"), "id").select(
            "id", F.col("comp").alias("was"), F.least("comp", "near").alias("via")
        )
        jump = labels.select(F.col("id").alias("via"), F.col("comp").alias("far"))
        moved = stored(
            near.join(jump, "via", "left").select("id", "was", F.least("via", "far").alias("comp")), "labels"
        )
        released(labels)
        labels = moved
        if moved.where("comp <> was").limit(1).count() == 0:
            released(both)
            return nodes.join(labels.drop("was"), "id", "left").select("id", F.coalesce("comp", "id").alias("comp"))


def grouped(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: id, th, n_shingles, component_id (the smallest id reachable by links) and ``first``.

    Equal sets become one node first, whatever their ids, so different texts of one id are placed each by its own
    words; ``first`` marks the text that stands for its component.  Each tile's members are compared with its smallest one; tiles
    that this leaves in several components compare all members outside their largest component with all of
    another component, so every pair that could still join two components is tested.  Null and empty texts
    link with nothing and are first; a null id gives itself null and is first.
    """
    key = F.struct("n", F.xxhash64("s"), F.hash("s"))
    sets = shingle_sets(docs, text, doc_id).withColumn("n", F.size("s")).withColumn("k", key)
    sets = stored(sets.withColumn("row", F.monotonically_increasing_id()), "sets")  # numbers fixed by the write
    member = stored(sets.select("id", "th", F.col("n").cast("long").alias("n_shingles"), "k"), "members")
    filled = sets.where("n > 0 and id is not null")
    least = filled.groupBy("k").agg(F.min(F.struct("id", "th", "row")).alias("rep"))
    heads = stored(least.select("k", F.struct("rep.id", "rep.th").alias("rep"), F.col("rep.row").alias("node")), "heads")
    nodes = stored(heads.select(F.col("node").alias("id")), "nodes")
    small = stored(sets.select(F.col("row").alias("id"), "n", "g").join(nodes, "id"), "signatures")
    cuts = prefixes(sets, common_shingles(filled)).withColumnRenamed("row", "id").join(nodes, "id")
    cuts = stored(cuts, "prefixes")
    released(sets)  # the largest table; sets are made again for candidate pairs only

    def fetch(asked: DataFrame) -> DataFrame:
        reps = heads.select(F.col("node").alias("row"), F.col("rep.id").alias("i"), F.col("rep.th").alias("h"))
        reps = stored(reps.join(asked, "row"), "asked-texts")
        body = docs.select(F.col(doc_id).alias("d"), text_or_empty(F.col(text)).alias("body"))
        held = body.join(reps, (F.col("d") == F.col("i")) & (F.xxhash64("body") == F.col("h")))
        held = held.groupBy("row").agg(F.first("body").alias("body"))  # repeated rows have one text
        return shingle_sets(held, "body", "row").select(F.col("id").alias("row"), "s")

    rows = cuts.select("id", "bands", F.explode("p").alias("shingle")).select("id", "shingle", F.explode("bands").alias("band"))
    # One number per shingle and band: tiles that fall together only add candidates.
    rows = stored(rows.select(F.xxhash64("shingle", "band").alias("tile"), "id"), "tiles")
    tiles = rows.groupBy("tile").agg(F.min("id").alias("a"), F.max("id").alias("hi")).where("a < hi")
    tiles = stored(tiles.drop("hi"), "shared-tiles")
    live = stored(rows.join(tiles, "tile").select("tile", "a", "id"), "live")
    released(rows, tiles, cuts)
    first = verified(live.where("a < id").select("a", F.col("id").alias("b")).distinct(), small, fetch)
    comp = stored(components(nodes, first), "components")
    placed = live.join(comp, "id").select("tile", "id", "comp")
    mixed = placed.groupBy("tile").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi")
    open_rows = stored(placed.join(mixed.drop("lo", "hi"), "tile"), "open")
    released(live)
    most = open_rows.groupBy("tile", "comp").agg(F.count("*").alias("n"))
    most = most.groupBy("tile").agg(F.max(F.struct("n", "comp")).getField("comp").alias("main"))
    minor = open_rows.join(most, "tile").where("comp <> main").select(
        "tile", F.col("id").alias("x"), F.col("comp").alias("cx")
    )
    cross = minor.join(open_rows, "tile").where("cx <> comp")
    cross = cross.select(F.least("x", "id").alias("a"), F.greatest("x", "id").alias("b")).distinct()
    second = verified(cross.join(first, ["a", "b"], "left_anti"), small, fetch)
    released(open_rows, small, first)
    star = comp.where("comp <> id").select(F.col("comp").alias("a"), F.col("id").alias("b"))
    final = stored(components(nodes, star.union(second)), "components")
    released(comp, second)
    placed = heads.join(final.withColumnRenamed("id", "node"), "node")
    chosen = placed.groupBy("comp").agg(F.min(F.struct("rep", "k")).alias("chosen"))
    texts = placed.join(chosen, "comp").select("k", "chosen")
    joined = member.join(texts, "k", "left")
    lone = (F.col("n_shingles") == 0) | F.col("id").isNull()
    return joined.select(
        "id",
        "th",
        "n_shingles",
        F.when(lone, F.col("id")).otherwise(F.col("chosen.rep.id")).alias("component_id"),
        (lone | (F.struct("id", "th") == F.col("chosen.rep"))).alias("first"),
    )


def linked_components(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: id, n_shingles and component_id, the smallest id reachable by links."""
    return grouped(docs, text, doc_id).select("id", "n_shingles", "component_id")


def representatives(docs: DataFrame) -> DataFrame:
    """The documents without those that another text of their component stands for: clean ones all stay.

    Rows of one id and one text are one document and stay or go together; a null id always stays.
    """
    others = grouped(docs).where(~F.col("first")).select(F.col("id").alias("__id"), F.col("th").alias("__th"))
    others = stored(others.distinct(), "others")  # Spark then knows its size
    same = (F.col("doc_id") == F.col("__id")) & (F.xxhash64(text_or_empty(F.col("text"))) == F.col("__th"))
    return docs.join(others, same, "left_anti")
