"""Substring dedup: documents parsed into factors that documents with smaller ids hold.

Every window of ``LENGTH`` words selects its smallest anchor; neighbouring windows with one anchor form a phrase.  The
distinct phrases of all documents are the reference, dealt to blocks by the hashes of their windows.  A document's
phrases are looked up in every block, and its factors grow greedily over them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import chunks, longs, released, stored, text_or_empty, window_hashes, word_hashes, words

LENGTH = 50  # words of the shortest factor that is removed
ANCHOR = 20  # words of an anchor
CHUNK = 1 << 19  # words that a worker handles at once


def window_minima(values: np.ndarray, span: int) -> np.ndarray:
    """The smallest of each ``span`` neighbouring values, by doubling widths."""
    width = 1
    while 2 * width <= span:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    rest = span - width
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def phrases_of(hashes: np.ndarray, ends: np.ndarray, length: int, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """Phrases of texts that lie one behind the other: text, first window and number of windows, and anchor.

    A phrase is a longest run of windows of one text that select one anchor value.  Equal windows select equal ones.
    """
    if len(hashes) < length:
        none = np.empty(0, np.int64)
        return none, none, none, np.empty(0, np.uint64)
    least = window_minima(window_hashes(hashes, anchor), length - anchor + 1)
    starts = np.arange(len(least))
    text = np.searchsorted(ends, starts, side="right")
    inside = starts + length <= ends[text]
    starts, text, least = starts[inside], text[inside], least[inside]
    first = np.ones(len(starts), bool)
    first[1:] = (text[1:] != text[:-1]) | (least[1:] != least[:-1])
    at = np.flatnonzero(first)
    return text[at], starts[at], np.diff(np.append(at, len(starts))), least[at]


def mixed(text: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    return anchor * np.uint64(0x9E3779B97F4A7C15) + text.astype(np.uint64)


def parsed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH) -> DataFrame:
    """One row per id and text that has factors: id, th (hash of the text) and ``factors``.

    A factor is (start, length, source_id, source_th, source_start): that many words from ``start`` on are also those
    of the source, a document with a smaller id, from ``source_start`` on.  Each window takes as its source the
    smallest (id, th, place) that holds it, and a factor goes on while the next window's source goes on too.  Windows
    across the border of two phrases or factors belong to a phrase as all others do, so they are looked up as well and
    factors overlap there: no common run of ``length`` words is lost.  A null id is neither source nor parsed; a
    shorter or empty text has no factors; equal rows are parsed once; an empty table gives no row.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.where(F.col(doc_id).isNotNull()).select(
        F.col(doc_id).alias("id"), F.xxhash64(text_or_empty(F.col(text))).alias("th"), F.col(text).alias("body")
    )
    hashed = rows.select("id", "th", word_hashes(F.col("body")).alias("wh")).where(F.size("wh") >= length)

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, _, values, ends in chunks(batch.column("wh"), CHUNK):
                owner, _, _, least = phrases_of(values.view(np.uint64), ends, length)
                at = pa.array(owner + lo)
                columns = [longs(least), batch.column("id").take(at), batch.column("th").take(at)]
                yield pa.RecordBatch.from_arrays(columns, ["a", "id", "th"])

    found = stored(hashed.mapInArrow(anchors, f"a long, id {kind}, th long"), "anchors")
    shared = found.groupBy("a").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi")
    shared = stored(shared.select("a"), "shared-anchors")  # written first, so a hot anchor's join can be split
    hits = found.join(shared, "a").groupBy("id", "th").agg(F.collect_set("a").alias("hit"))  # within one document
    suspects = rows.join(hits, ["id", "th"]).select("id", "th", word_hashes(F.col("body")).alias("wh"), "hit")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = batch.column("hit")
            for lo, hi, values, ends in chunks(batch.column("wh"), CHUNK):
                values = values.view(np.uint64)
                owner, start, n, least = phrases_of(values, ends, length)
                part = hit.slice(lo, hi - lo)
                known = mixed(np.repeat(np.arange(hi - lo), np.diff(part.offsets.to_numpy())),
                              part.flatten().to_numpy(zero_copy_only=False).view(np.uint64))
                keep = np.isin(mixed(owner, least), known)  # a chance match only adds a lookup
                owner, start, n = owner[keep], start[keep], n[keep]
                edges = np.concatenate([[0], n.cumsum()])
                every = np.repeat(start - edges[:-1], n) + np.arange(edges[-1])
                wins = longs(window_hashes(values, length)[every])
                at = pa.array(owner + lo)
                columns = [
                    batch.column("id").take(at),
                    batch.column("th").take(at),
                    pa.array((start - np.concatenate([[0], ends])[owner]).astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), wins),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["id", "th", "at", "wins"])

    pieces = suspects.mapInArrow(cut, f"id {kind}, th long, at int, wins array<long>")
    pieces = stored(pieces.withColumn("c", F.xxhash64("wins")), "phrases")
    released(found, shared)
    place = F.struct("id", "th", "at")
    reference = pieces.groupBy("c").agg(F.min(place).alias("src"), F.max("id").alias("hi"), F.first("wins").alias("wins"))
    windows = reference.select("c", "src", "hi", F.posexplode("wins").alias("k", "w")).select(
        "w", "c", "k", "src.id", "src.th", (F.col("src.at") + F.col("k")).alias("at"), "hi"
    )
    windows = stored(windows, "windows")
    first = windows.groupBy("w").agg(F.min(place).alias("src"), F.max("hi").alias("hi")).where("src.id < hi")
    first = stored(first.select("w", "src"), "sources")
    runs = windows.select("w", "c", "k").join(first, "w").groupBy(
        "c", F.col("src.id").alias("sid"), F.col("src.th").alias("sth"), (F.col("src.at") - F.col("k")).alias("shift")
    )
    runs = stored(runs.agg(F.collect_list("k").alias("ks")), "runs")  # at most one per window of a phrase
    released(windows, first)
    held = pieces.select("c", "id", "th", "at").join(runs, "c").where("sid < id")
    held = held.groupBy("id", "th").agg(F.collect_set(F.struct("at", "ks", "sid", "sth", "shift")).alias("found"))

    def grown(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for found in batch["found"]:
                lines: dict[tuple, list] = {}
                for r in found:
                    lines.setdefault((r["sid"], r["sth"], r["shift"] - r["at"]), []).append(np.asarray(r["ks"]) + r["at"])
                factors = []
                for (sid, sth, shift), starts in lines.items():
                    starts = np.unique(np.concatenate(starts))
                    breaks = np.flatnonzero(np.diff(starts) > 1) + 1
                    for lo, hi in zip(np.append(0, breaks), np.append(breaks, len(starts))):
                        at, end = int(starts[lo]), int(starts[hi - 1])
                        factors.append((at, end - at + length, sid, sth, at + int(shift)))
                out.append(sorted(factors))
            yield pd.DataFrame({"id": batch["id"], "th": batch["th"], "factors": out})

    factor = f"struct<start:int,length:int,source_id:{kind},source_th:bigint,source_start:int>"
    done = stored(held.mapInPandas(grown, f"id {kind}, th long, factors array<{factor}>"), "factors")
    released(pieces, runs)
    return done


def factors(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH) -> DataFrame:
    """One row per factor: id, th, start, length, source_id, source_th, source_start (see ``parsed``)."""
    return parsed(docs, text, doc_id, length).select("id", "th", F.inline("factors"))


def measured(docs: DataFrame, text: str, doc_id: str, length: int) -> DataFrame:
    """``docs`` with their words, and those left of them, under private names."""
    marks = parsed(docs, text, doc_id, length).select(
        F.col("id").alias("__id"), F.col("th").alias("__th"), F.col("factors").alias("__factors")
    )
    hashed = F.xxhash64(text_or_empty(F.col(text)))
    joined = docs.join(marks, (F.col(doc_id) == F.col("__id")) & (hashed == F.col("__th")), "left")
    stop = lambda f: f["start"] + f["length"]
    # Factors ascend, so the words after each one, up to the next, are those from the furthest end so far on.
    far = F.aggregate(
        "__factors",
        F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<at:int,n:int>>").alias("gaps")),
        lambda acc, f: F.struct(
            F.greatest(acc["end"], stop(f)).alias("end"),
            F.when(
                f["start"] > acc["end"],
                F.concat(acc["gaps"], F.array(F.struct(acc["end"].alias("at"), (f["start"] - acc["end"]).alias("n")))),
            ).otherwise(acc["gaps"]).alias("gaps"),
        ),
    )
    split = joined.withColumn("__words", words(F.col(text))).withColumn("__far", far)
    last = F.struct(F.col("__far.end").alias("at"), (F.size("__words") - F.col("__far.end")).alias("n"))
    gaps = F.concat(F.col("__far.gaps"), F.array(last))
    kept = F.flatten(F.transform(gaps, lambda g: F.slice("__words", g["at"] + 1, g["n"])))
    return split.withColumn("__kept", F.when(F.col("__factors").isNull(), F.col("__words")).otherwise(kept))


def shortened_text(text: str):
    """A text from which nothing goes stays byte for byte; others are their kept words joined by spaces."""
    cut = F.size("__kept") < F.size("__words")
    return F.when(cut, F.array_join("__kept", " ")).otherwise(F.col(text))


def deduplicated(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH) -> DataFrame:
    """All columns of ``docs``, the text without covered words, and n_words, n_removed, kept_sha256.

    A text from which nothing goes stays byte for byte as it is; others are their kept words joined by spaces.
    ``kept_sha256`` is of the kept words joined by one space in every case.  Null texts have no words.  Columns of
    the input with the three names are replaced; ``shortened`` keeps them.
    """
    done = measured(docs, text, doc_id, length)
    size = F.size("__words").cast("long")
    return done.withColumns(
        {
            "n_words": size,
            "n_removed": size - F.size("__kept"),
            "kept_sha256": F.sha2(F.array_join("__kept", " "), 256),
            text: shortened_text(text),
        }
    ).drop("__id", "__th", "__factors", "__far", "__words", "__kept")


def shortened(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH) -> DataFrame:
    """``docs`` with exactly their own columns, the text without covered words; every row stays."""
    done = measured(docs, text, doc_id, length).withColumn(text, shortened_text(text))
    return done.select(*(F.col(f"`{c}`") for c in docs.columns))
