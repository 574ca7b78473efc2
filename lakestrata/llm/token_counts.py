"""Edit-aware token counts: segment trees kept per document, re-encoded only around edits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import stored, text_or_empty
from lakestrata.llm.encoding import Encoder, kept_encoder, slices

LEAF = 32  # segments (words with the space before them) of a leaf


class CountTree:
    """Sums of token counts over leaves; they are spaced so that edits change a path, not the tree."""

    def __init__(self, counts: np.ndarray):
        self.size = 1 << max(1, int(len(counts) - 1).bit_length())
        self.sums = np.zeros(2 * self.size, np.int64)
        self.sums[self.size : self.size + len(counts)] = counts
        level = self.size
        while level > 1:
            self.sums[level // 2 : level] = self.sums[level : 2 * level : 2] + self.sums[level + 1 : 2 * level : 2]
            level //= 2

    def replace(self, first: int, last: int, total: int) -> None:
        """Leaves ``first`` up to ``last`` now count ``total`` together; updates their ancestors alone."""
        lo, hi = first + self.size, max(first, last - 1) + self.size
        self.sums[lo : hi + 1] = 0
        self.sums[lo] = total
        while lo > 1:
            lo, hi = lo // 2, hi // 2
            at = np.arange(lo, hi + 1)
            self.sums[at] = self.sums[2 * at] + self.sums[2 * at + 1]

    @property
    def total(self) -> int:
        return int(self.sums[1])


def leaves_of(sizes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Characters and tokens of each leaf, from those of each segment."""
    first = np.arange(0, len(sizes), LEAF)
    return np.add.reduceat(lengths, first) if len(first) else lengths, np.add.reduceat(sizes, first) if len(first) else sizes


def keyed(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    body = text_or_empty(F.col(text))
    return docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(body).alias("text_hash"), body.alias("body"))


def count_trees(docs: DataFrame, tokenizer_path: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, text_hash, chars, counts: the leaves of every document's tree, written once.

    A leaf is a run of whole segments, so encoding it alone gives its ids.  A null or empty text has no leaves; equal
    rows have one tree; special strings are ordinary text.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_encoder(tokenizer_path, special_as_text=True)
        for batch in batches:
            texts = batch.column("body")
            for lo, hi in slices(texts):
                _, sizes, counts, lengths = encoder.segments(texts.slice(lo, hi - lo), measured=True)
                starts = np.cumsum(counts) - counts
                # Where each leaf of each text starts; a text without segments has none.
                n_leaves = -(-counts // LEAF)
                edges = np.concatenate([[0], np.cumsum(n_leaves)])
                first = np.repeat(starts - edges[:-1] * LEAF, n_leaves) + np.arange(edges[-1]) * LEAF
                sums = [np.add.reduceat(x, first) if len(first) else x for x in (lengths, sizes)]
                offsets = pa.array(edges, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(lo, hi - lo),
                        batch.column("text_hash").slice(lo, hi - lo),
                        *(pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in sums),
                    ],
                    ["doc_id", "text_hash", "chars", "counts"],
                )

    schema = f"doc_id {kind}, text_hash long, chars array<int>, counts array<int>"
    return stored(keyed(docs, text, doc_id).mapInArrow(grow, schema), "count-trees")


def edited(encoder: Encoder, body: str, chars: np.ndarray, counts: np.ndarray, edits) -> tuple[int, int, int]:
    """Tokens after the edits, leaves then, and segments that were encoded for them."""
    slots, tree, encoded = np.arange(len(counts)), CountTree(counts), 0
    for e in edits:
        at = min(max(int(e["at"] or 0), 0), len(body))
        stop = min(at + max(int(e["length"] or 0), 0), len(body))
        insert = e["insert"] or ""
        ends = np.cumsum(chars)
        # The leaves that hold the edit and one character on each side: a border of leaves with two
        # untouched characters, no space and then white space, parts what is encoded.
        first = int(np.searchsorted(ends, max(at - 1, 0), side="right"))
        last = int(np.searchsorted(ends, min(stop, len(body) - 1), side="right")) + 1 if len(body) else first
        start, until = int(ends[first - 1]) if first else 0, int(ends[last - 1]) if last else 0
        _, sizes, _, lengths = encoder.segments([body[start:at] + insert + body[stop:until]], measured=True)
        encoded += len(sizes)
        new_chars, new_counts = leaves_of(sizes, lengths)
        body = body[:at] + insert + body[stop:]
        chars = np.concatenate([chars[:first], new_chars, chars[last:]])
        counts = np.concatenate([counts[:first], new_counts, counts[last:]])
        if last > first and len(new_counts):
            lo, hi = int(slots[first]), int(slots[last - 1]) + 1
            slots = np.concatenate([slots[:first], np.full(len(new_counts), lo), slots[last:]])
            mine = slice(*np.searchsorted(slots, [lo, hi]))  # a border slot may hold other leaves too
            tree.replace(lo, hi, int(counts[mine].sum()))
            slots[mine] = lo
        else:
            tree, slots = CountTree(counts), np.arange(len(counts))
    return tree.total, len(counts), encoded


def recount(docs: DataFrame, edits: DataFrame, tokenizer_path: str, text: str = "text", doc_id: str = "doc_id",
            trees: DataFrame | None = None) -> DataFrame:
    """doc_id, n_before, n_tokens, n_leaves, n_encoded: counts before and after each document's edits.

    ``trees`` are the kept leaves of ``count_trees`` on the same documents; without them they are grown here.
    ``edits`` has doc_id, seq, at, length, insert: characters replaced in the text as the edits before left it.
    Only leaves that an edit or the character beside it touches are encoded again (``n_encoded`` segments); a
    document without edits encodes nothing.  A null text is empty; positions past the end mean the end; null edit
    fields mean 0 or no text; equal ids get the same edits and a null id none; edits of equal ``seq`` go by place;
    repeated rows are counted each; an empty table gives no rows; other columns are not read.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    trees = count_trees(docs, tokenizer_path, text, doc_id) if trees is None else trees
    # Everything meets on one hash of the id, which null ids have too, so each side is shuffled once.
    key = F.xxhash64("doc_id").alias("__key")
    of = edits.where(F.col("doc_id").isNotNull()).groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("seq", "at", "length", "insert"))).alias("edits")
    )
    leaves = trees.select(key, F.col("text_hash").alias("__hash"), "chars", "counts")
    known = leaves.join(of, "__key", "left").dropDuplicates(["__key", "__hash"])
    rows = keyed(docs, text, doc_id).withColumn("__key", F.xxhash64("doc_id"))
    # Differing bits and not an equality, so that the rows stay where the id's hash has put them.
    joined = rows.join(known, (rows["__key"] == known["__key"]) & (rows["text_hash"].bitwiseXOR(known["__hash"]) == 0))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = kept_encoder(tokenizer_path, special_as_text=True)
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                chars, counts = np.asarray(r.chars, np.int64), np.asarray(r.counts, np.int64)
                before = int(counts.sum())
                after = (before, len(counts), 0) if r.edits is None else edited(encoder, r.body, chars, counts, r.edits)
                out.append((r.doc_id, before, *after))
            yield pd.DataFrame(out, columns=["doc_id", "n_before", "n_tokens", "n_leaves", "n_encoded"])

    return joined.select("doc_id", "body", "chars", "counts", "edits").mapInPandas(
        count, f"doc_id {kind}, n_before long, n_tokens long, n_leaves long, n_encoded long"
    )
