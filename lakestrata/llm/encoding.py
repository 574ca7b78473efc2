"""Token ids of whole texts, with each distinct segment of text encoded once."""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# White space as Unicode has it, which is what ends and starts pre-tokens.
SPACE = "\t-\r \x85\xa0  -     　"
SEGMENT = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
MARK = "\x02"  # stands before a stop or comma that is cut from its word
UNEVEN = f"[{SPACE}](?:[ \n]|\\z)|{MARK}"  # read by Arrow
KNOWN = 1 << 19  # segments that are remembered before all are forgotten
FEW = 64  # segments this many times fewer than the known ones are encoded without a search
TOGETHER = 1 << 14  # new segments that go through the tokenizer together; bounds its memory
SLICE = 1 << 21  # bytes of text that are encoded together; bounds a worker's memory


class Encoder:
    """Encodes texts through their segments: white space and the word after it.

    The byte-level pre-tokenizer never joins a character with white space behind it, and looks past a run of white
    space only to the character after it, so a text's ids are its segments' ids in order.  Segments repeat, so only
    new ones go through the tokenizer.  ``special_as_text`` reads special strings as ordinary text.
    """

    def __init__(self, path: str, special_as_text: bool = False):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread per worker
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.tokenizer.model._resize_cache(0)  # segments are remembered here; its own cache would only be missed
        vocabulary = self.tokenizer.get_vocab()
        self.width = np.dtype("<u2" if max(vocabulary.values(), default=0) < 1 << 16 else "<u4")
        # A vocabulary entry has one character per byte of text.
        self.bytes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, i in vocabulary.items():
            self.bytes[i] = len(token)
        self.plain = Segments(self.each)
        self.spaced = Segments(self.joined)

    def each(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all segments in a row, and how many each has."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(segments, add_special_tokens=False)]
        return np.array([i for ids in found for i in ids], self.width), np.array([len(ids) for ids in found], np.int64)

    def joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words after a space, or that start with a line break, encoded as one text."""
        text = (" " + " ".join(words)).replace(" \n", "\n")
        if MARK in text:
            # A mark could join what is before it here.
            return self.each([w if w[0] == "\n" else w[1:] if w[0] == MARK else " " + w for w in words])
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.width)
        column = pa.array(words, pa.large_string())
        own = pc.starts_with(column, "\n").to_numpy(zero_copy_only=False)
        ends = np.cumsum(pc.binary_length(column).to_numpy() + ~own)
        upto = np.cumsum(self.bytes[ids])
        last = np.searchsorted(upto, ends)
        if len(upto) and upto[-1] == ends[-1] and (upto[last] == ends).all():
            return ids, np.diff(last + 1, prepend=0)
        return self.each([w if w[0] == "\n" else " " + w for w in words])

    def segments(self, texts: list[str] | pa.Array, measured: bool = False) -> tuple[np.ndarray, ...]:
        """Ids of all texts, ids of each segment, segments of each text, and where ``measured`` their lengths."""
        column = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        uneven = pc.match_substring_regex(column, UNEVEN)
        even = pc.replace_substring(column.filter(pc.invert(uneven)), "\n", " \n")
        if not measured:
            # Letters or digits never join a mark that ends the word, so words with and without one share their ids.
            even = pc.replace_substring_regex(even, r"([A-Za-z0-9])([.,]) ", rf"\1 {MARK}\2 ")
        cut = pc.split_pattern(even, " ")
        starts, words = cut.offsets.to_numpy(), cut.values
        rest = np.ones(len(words), bool)
        rest[starts[:-1]] = False
        firsts = iter(zip(words.take(pa.array(starts[:-1])).to_pylist(), (np.diff(starts) - 1).tolist()))
        odd = iter(column.filter(uneven).to_pylist())
        plain: list[str] = []
        order, counts = [], []  # stretches of plain and spaced segments in turn, and the segments of each text
        for u in uneven.to_pylist():
            if u:
                first, more = SEGMENT.findall(next(odd)), 0
            else:
                word, more = next(firsts)
                first = [word] if word else []
            plain += first
            order += (len(first), more)
            counts.append(len(first) + more)
        plain, spaced = pa.array(plain, pa.large_string()), words.filter(pa.array(rest))
        del column, even, cut, words, rest  # large, and not needed while ids are looked up
        found = self.plain.look(plain), self.spaced.look(spaced)
        kinds = np.repeat(np.arange(len(order)) % 2, order).astype(bool)
        sizes, starts = np.zeros(len(kinds), np.int64), np.zeros(len(kinds), np.int64)
        for kind, (_, start, size), before in ((~kinds, found[0], 0), (kinds, found[1], len(found[0][0]))):
            sizes[kind], starts[kind] = size, before + start
        flat = np.concatenate([found[0][0], found[1][0]])
        out = gather(flat, starts, sizes), sizes, np.array(counts, np.int64)
        if not measured:
            return out
        lengths = np.zeros(len(kinds), np.int64)
        lengths[~kinds] = pc.utf8_length(plain).to_numpy()
        # A spaced segment is kept without its space, but for those that start with a line break.
        own = pc.starts_with(spaced, "\n").to_numpy(zero_copy_only=False)
        lengths[kinds] = pc.utf8_length(spaced).to_numpy() + ~own
        return *out, lengths

    def ids(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        """The ids of each text."""
        ids, sizes, counts = self.segments(texts)
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(counts)]
        return np.split(ids, ends[:-1]) if len(texts) else []


@lru_cache(maxsize=1)
def kept_encoder(path: str, special_as_text: bool = False) -> Encoder:
    """The encoder that a worker keeps from task to task, with what it remembers."""
    return Encoder(path, special_as_text)


class Segments:
    """Ids of segments that were seen before, by their place in order of coming."""

    def __init__(self, encode):
        self.encode = encode
        self.forget()

    @property
    def known(self) -> list[str]:
        return self.seen.to_pylist()

    def forget(self) -> None:
        self.seen = pa.array([], pa.large_string())
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.table, self.again = np.zeros(0, np.uint32), np.zeros(0, bool)

    def shrink(self) -> None:
        """Keep the segments that came again; all are forgotten if these are more than half."""
        kept = np.flatnonzero(self.again)
        if 2 * len(kept) > KNOWN:
            return self.forget()
        self.seen = self.seen.take(pa.array(kept))
        self.table = gather(self.table, self.starts[kept], self.sizes[kept])
        self.sizes, self.again = self.sizes[kept], np.zeros(len(kept), bool)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def look(self, segments: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A table of ids, where each segment's ids start in it, and how many it has."""
        if len(segments) * FEW < len(self.seen):
            ids, sizes = self.encode(segments.to_pylist()) if len(segments) else (self.table[:0], self.sizes[:0])
            return ids, np.cumsum(sizes) - sizes, sizes
        if len(self.seen) > KNOWN:
            self.shrink()
        # Arrow finds the distinct ones and those that are known, so only new ones become Python strings.
        coded = segments.dictionary_encode()
        distinct = coded.dictionary
        old, at = len(self.seen), np.full(len(distinct), -1)
        spot = pc.fill_null(pc.index_in(self.seen, distinct), -1).to_numpy()  # the smaller side is hashed
        here = np.flatnonzero(spot >= 0)
        at[spot[here]] = here
        missing = np.flatnonzero(at < 0)
        at[missing] = np.arange(old, old + len(missing))
        if len(missing):
            new = distinct.take(pa.array(missing))
            self.seen = pa.concat_arrays([self.seen, new])
            found = [self.encode(new.slice(lo, TOGETHER).to_pylist()) for lo in range(0, len(new), TOGETHER)]
            sizes = np.concatenate([n for _, n in found])
            self.starts = np.concatenate([self.starts, len(self.table) + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.table = np.concatenate([self.table, *(ids for ids, _ in found)])
        codes = coded.indices.to_numpy()
        self.again = np.concatenate([self.again, np.zeros(len(missing), bool)])
        self.again[at[(at < old) | (np.bincount(codes, minlength=len(distinct)) > 1)]] = True
        at = at[codes]
        return self.table, self.starts[at], self.sizes[at]


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` from each start, in a row."""
    ends = np.cumsum(sizes)
    return flat[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]


def slices(texts: pa.Array, limit: int = SLICE):
    """Ranges of rows whose texts hold at most ``limit`` bytes together; a longer text is alone."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    lo, before = 0, 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield lo, hi
        lo, before = hi, int(ends[hi - 1])
