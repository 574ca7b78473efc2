"""Interpolated modified Kneser-Ney model: counted in parts of the keys, kept as mapped tables of a few bytes a gram."""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Callable, Iterator
from functools import reduce
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import released, shared_path, stored, text_or_empty
from lakestrata.llm.encoding import slices
from lakestrata.llm.mapped import INDEX, coded, decoded, find, indexed, mask, mixed, narrow, opened, packed, saved, summed, unmixed, unpacked

ORDER = 3
END = np.uint64(1)  # hash of the end mark; a word has it with a chance of 2**-64
LONG = 512  # bytes of a word that are hashed eight at a time
SLICE = 1 << 21  # bytes of text that are split at once
BUFFER = 2_000_000  # grams that a task sorts at once
PART = 1_500_000  # training tokens for each part of the tables
ROUNDS = 2  # passes over the training texts, each for its share of the parts: bounds what is shuffled at once
BLOCKS = "part int, data binary"
STATS = 4  # of a context: sum of its counts, and how many of them are 1, 2 and more


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct words of some texts, the place there of each word, and the words of each text."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    found = lists.values.dictionary_encode()
    distinct, places = found.dictionary, found.indices.to_numpy(zero_copy_only=False)
    empty = pc.index(distinct, "").as_py()  # comes before a leading white space and after a trailing one
    filled = places != empty
    held = np.concatenate([[0], np.cumsum(filled)])
    places = places[filled]
    if empty >= 0:
        distinct = pa.concat_arrays([distinct[:empty], distinct[empty + 1 :]])
        places = places - (places > empty)
    return word_hashes(distinct), places, np.diff(held[lists.offsets.to_numpy()])


def word_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of words, from eight bytes at a time; those of equal length up to eight bytes all differ."""
    words = words.cast(pa.binary())
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, np.int32, len(words) + 1, 4 * words.offset).astype(np.int64) if len(words) else np.zeros(1, np.int64)
    data = np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    data = np.concatenate([data, np.zeros(8, np.uint8)])
    starts, sizes = ends[:-1], np.diff(ends)
    hashes = mixed(sizes.astype(np.uint64) + np.uint64(END), 64)
    rows, at = np.flatnonzero((sizes > 0) & (sizes <= LONG)), 0
    while len(rows):
        eight = data[(starts[rows] + at)[:, None] + np.arange(8)].view("<u8")[:, 0]
        rest = sizes[rows] - at
        eight &= (np.uint64(1) << (8 * np.minimum(rest, 8)).astype(np.uint64)) - np.uint64(1)
        hashes[rows] = mixed(hashes[rows] ^ eight, 64)
        at += 8
        rows = rows[rest > 8]
    for row in np.flatnonzero(sizes > LONG):
        digest = hashlib.blake2b(data[starts[row] : ends[row + 1]].tobytes(), digest_size=8).digest()
        hashes[row] = int.from_bytes(digest, "little")
    return hashes


def texts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    for batch in batches:
        for lo, hi in slices(batch.column("body"), SLICE):
            rows = batch.slice(lo, hi - lo)
            yield rows, rows.column("body")


def blocks(found: list[tuple[int, bytes]]) -> pa.RecordBatch:
    parts, data = zip(*found) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(data, pa.binary())], ["part", "data"])


def by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    """The blocks of each part that a task got."""
    held: dict[int, list[bytes]] = {}
    for batch in batches:
        for part, data in zip(batch.column("part").to_pylist(), batch.column("data").to_pylist()):
            held.setdefault(part, []).append(data)
    while held:
        yield held.popitem()


def dealt(found: DataFrame, parts: int, build: Callable, what: str) -> tuple[DataFrame, list[np.ndarray]]:
    """Blocks shuffled to their parts and built there: the stored blocks for the next step, and a line of numbers per part.

    ``build`` takes a part and its blocks, and gives blocks and the line.  What was shuffled is let go.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data in by_part(batches):
            further, line = build(part, data)
            yield blocks([*further, (-1, np.array([part, *line], "<i8").tobytes())])

    spark = found.sparkSession
    out = stored(found.where("part >= 0").repartitionById(parts, F.col("part")).mapInArrow(run, BLOCKS), what)
    lines = [np.frombuffer(r["data"], "<i8") for r in out.where("part < 0").collect()]  # a few numbers per part
    gc.collect()
    spark._jvm.System.gc()  # else shuffle files stay until the driver happens to collect its garbage
    return out, lines


class Vocabulary:
    """Mapped hashes and counts of the training words; the number of a word is its place."""

    def __init__(self, folder: str, parts: int, sizes: dict[int, int]):
        self.folder, self.parts, self.sizes = folder, parts, sizes
        self.starts = np.concatenate([[0], np.cumsum([sizes.get(p, 0) for p in range(parts)])])
        self.open: dict[int, list[np.ndarray]] = {}

    @property
    def size(self) -> int:
        return int(self.starts[-1])

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each word (or the one that stands for unknown words) and its count."""
        numbers, counts = np.full(len(hashes), self.unknown, np.uint64), np.zeros(len(hashes), np.int64)
        home = hash_part(hashes, self.parts)
        for part in np.unique(home).tolist():
            if self.sizes.get(part):
                keys, held = self.opened(part)
                at = np.flatnonzero(home == part)
                spot = np.minimum(np.searchsorted(keys, hashes[at]), len(keys) - 1)
                hit = keys[spot] == hashes[at]
                numbers[at[hit]] = (spot[hit] + self.starts[part]).astype(np.uint64)
                counts[at] = np.where(hit, held[spot], 0)
        return numbers, counts

    def opened(self, part: int) -> list[np.ndarray]:
        if part not in self.open:
            self.open[part] = opened(f"{self.folder}/words-{part:06d}")
        return self.open[part]

    # Numbers after those of the words.
    @property
    def start(self) -> int:
        return self.size

    @property
    def pad(self) -> int:
        return self.size + 1

    @property
    def unknown(self) -> int:
        return self.size + 2

    @property
    def bits(self) -> int:
        return self.unknown.bit_length()


def hash_part(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Equal ranges of hashes, in order."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def counted_words(train: DataFrame, folder: str) -> tuple[Vocabulary, int]:
    """The vocabulary, written with counts, and the number of training tokens, end marks among them."""
    parts = max(1, int(train.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sent() -> pa.RecordBatch:
            keys, _, n = summed(*map(np.concatenate, zip(*held)))
            home, found = hash_part(keys, parts), []
            for part in np.unique(home).tolist():
                lo, hi = np.searchsorted(home, [part, part + 1])
                found.append((part, packed(np.diff(keys[lo:hi], prepend=np.uint64(0)), n[lo:hi])))
            return blocks(found)

        held: list[tuple[np.ndarray, np.ndarray]] = []
        for rows, texts in texts_of(batches):
            hashes, places, _ = split_words(texts)
            counts = np.bincount(places, minlength=len(hashes))
            held.append((np.append(hashes, END), np.append(counts, len(rows))))
            if sum(len(keys) for keys, _ in held) >= BUFFER:
                keys, _, n = summed(*map(np.concatenate, zip(*held)))
                held = [(keys, n)]
                if len(keys) >= BUFFER // 2:
                    yield sent()
                    held = []
        if held:
            yield sent()

    def build(part: int, data: list[bytes]):
        read = [unpacked(d, 2) for d in data]
        keys, _, n = summed(np.concatenate([np.cumsum(k) for k, _ in read]), np.concatenate([c for _, c in read]))
        saved(f"{folder}/words-{part:06d}", [keys, narrow(n, n.max())])
        return [], [len(keys), int(n.sum())]

    out, lines = dealt(train.mapInArrow(count, BLOCKS), parts, build, "words")
    released(out)
    return Vocabulary(folder, parts, {int(p): int(n) for p, n, _ in lines}), sum(int(n) for _, _, n in lines)


def sequences(numbers: np.ndarray, sizes: np.ndarray, order: int, words: Vocabulary, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The word numbers of some texts one behind the other, and where each text ends there.

    Each text is ``order`` - 1 start marks, its words, the end mark and a pad.
    """
    ends = np.cumsum(sizes + order + 1)
    flat = np.full(int(ends[-1]) if len(ends) else 0, words.start, np.uint64)
    first = ends - sizes - 2  # of each text's words
    before = np.cumsum(sizes) - sizes
    flat[np.arange(len(numbers)) + np.repeat(first - before, sizes)] = numbers
    flat[ends - 2] = end
    flat[ends - 1] = words.pad
    return flat, ends


class Grams:
    """Keys of grams: the word numbers side by side, mixed; or a mixed hash where 64 bits don't hold them."""

    def __init__(self, size: int, bits: int, part_bits: int):
        self.size, self.word_bits = size, bits
        self.exact = size * bits <= 64
        self.bits = min(64, size * bits)
        self.part_bits = min(self.bits, part_bits)
        self.rest = self.bits - self.part_bits

    def key(self, words: list[np.ndarray], n: int) -> np.ndarray:
        key = np.zeros(n, np.uint64)
        for w in words:
            key = (key << np.uint64(self.word_bits)) | w if self.exact else mixed(key, 64) + w
        return mixed(key, self.bits)

    def part(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(self.rest)).astype(np.int64)

    def shown(self, keys: np.ndarray, words: list[np.ndarray]) -> list[np.ndarray]:
        """Sorted keys of a part as columns of a block."""
        return [np.diff(keys, prepend=keys[:1] & ~mask(self.rest))] if self.exact else words

    @property
    def columns(self) -> int:
        return 1 if self.exact else self.size

    @property
    def joined(self) -> bool:
        """Whether 64 bits hold a key inside its part and a word after it."""
        return self.exact and self.rest + self.word_bits <= 64

    def join(self, keys: np.ndarray, words: np.ndarray) -> np.ndarray:
        return (keys & mask(self.rest)) << np.uint64(self.word_bits) | words

    def parted(self, part: int, both: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys and words of ``join``."""
        key = (both >> np.uint64(self.word_bits)) + np.uint64((part << self.rest) & int(mask(64)))
        return key, both & mask(self.word_bits)

    def regained(self, part: int, columns: list[np.ndarray]) -> np.ndarray:
        if not self.exact:
            return self.key(columns, len(columns[0]))
        return np.cumsum(columns[0]) + np.uint64((part << self.rest) & int(mask(64)))

    def words(self, keys: np.ndarray, hashed: list[np.ndarray]) -> list[np.ndarray]:
        """The words of each key; ``hashed`` are those that came along where the key doesn't hold them."""
        if not self.exact:
            return hashed
        plain = unmixed(keys, self.bits)
        back = range(self.size - 1, -1, -1)
        return [(plain >> np.uint64(k * self.word_bits)) & mask(self.word_bits) for k in back]

    def blocks(self, keys: np.ndarray, words: list[np.ndarray], *columns: np.ndarray) -> list[tuple[int, bytes]]:
        """Sorted distinct keys with columns, a block for each part."""
        home, found = self.part(keys), []
        parts = np.unique(home)
        for part, lo, hi in zip(parts.tolist(), np.searchsorted(home, parts), np.searchsorted(home, parts, side="right")):
            key = self.shown(keys[lo:hi], [w[lo:hi] for w in words])
            found.append((part, packed(*key, *(c[lo:hi] for c in columns))))
        return found


def gram_kinds(order: int, words: Vocabulary, n_train: int) -> dict[int, Grams]:
    return {k: Grams(k, words.bits, (n_train // PART).bit_length()) for k in range(order)}


def sorted_grams(key: np.ndarray, word: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (key, word) in order, the place of one row of each, and the sum of ``n``."""
    order = np.lexsort((word, key))
    key, word = key[order], word[order]
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (word[1:] != word[:-1])]) if len(key) else np.empty(0, bool)
    first = np.flatnonzero(new)
    return key[first], word[first], order[first], np.add.reduceat(n[order], first) if len(first) else n


def runs(values: np.ndarray, n: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and how many there are or the sum of ``n``."""
    if n is None:
        values = np.sort(values)
    else:
        order = np.argsort(values, kind="stable")  # made of sorted runs
        values = values[order]
    first = heads(values)
    return values[first], np.diff(first, append=len(values)) if n is None else np.add.reduceat(n[order], first) if len(first) else n


def heads(key: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)


def top_blocks(words: list[np.ndarray], grams: Grams) -> list[tuple[int, bytes]]:
    """Grams of the full order as blocks by their context: contexts, grams of each, last words and counts."""
    keys, found = grams.key(words[:-1], len(words[-1])), []
    for part, rows in by_home(grams.part(keys)):
        if grams.joined:
            both, n = runs(grams.join(keys[rows], words[-1][rows]), None)
            key, last = grams.parted(part, both)
            own, named = heads(key), []
        else:
            key, last, at, n = sorted_grams(keys[rows], words[-1][rows], np.ones(len(rows), np.int64))
            own = heads(key)
            named = [w[rows][at[own]] for w in words[:-1]]
        found.append((part, packed(*grams.shown(key[own], named), np.diff(own, append=len(key)), last, n)))
    return found


def numbered(texts: pa.Array, order: int, words: Vocabulary, end: int):
    """``sequences`` of some texts and their sizes; their words' places among distinct ones, their numbers and counts."""
    hashes, places, sizes = split_words(texts)
    numbers, counts = words.find(hashes)
    flat, ends = sequences(numbers[places], sizes, order, words, end)
    return flat, ends, sizes, places, numbers, counts


def tables(train: DataFrame, order: int, words: Vocabulary, end: int, n_train: int, folder: str) -> dict[int, list[np.ndarray]]:
    """Writes the tables of every order and gives their lines: part, rows, sum of counts, counts of 1 to 4, and of 3 or more.

    ``k`` words have a count (occurrences at the top, distinct left neighbours below) and, below the top, what their
    followers count.  A gram's table is parted by its key, the top one by its context's.
    """
    kinds = gram_kinds(order, words, n_train)
    top = kinds[order - 1]
    rounds = min(ROUNDS, 1 << top.part_bits)

    def grams(turn: int):
        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[list[np.ndarray]] = []
            for _, texts in texts_of(batches):
                flat, ends, *_ = numbered(texts, order, words, end)
                whole = np.ones(len(flat), bool)
                for k in range(1, order):
                    whole[ends - k] = False
                at = np.flatnonzero(whole)
                key = top.key([flat[at + k] for k in range(order - 1)], len(at))
                at = at[top.part(key) % rounds == turn]
                held.append([flat[at + k] for k in range(order)])
                if sum(len(h[0]) for h in held) >= BUFFER:
                    yield blocks(top_blocks([np.concatenate(w) for w in zip(*held)], top))
                    held = []
            if held:
                yield blocks(top_blocks([np.concatenate(w) for w in zip(*held)], top))

        return cut

    def line(rows: int, n: np.ndarray) -> list[int]:
        return [rows, int(n.sum()), *(int((n == c).sum()) for c in (1, 2, 3, 4)), int((n >= 3).sum())]

    def build_top(part: int, data: list[bytes]):
        read = [unpacked(d, top.columns + 3) for d in data]
        keys, last, n, named = [], [], [], []
        for *context, followers, w, c in read:
            followers = followers.astype(np.int64)
            keys.append(np.repeat(top.regained(part, context), followers))
            named.append([np.repeat(x, followers) for x in context] if not top.exact else [])
            last.append(w)
            n.append(c)
        named = [np.concatenate(x) for x in zip(*named)]
        key, last, n = np.concatenate(keys), np.concatenate(last), np.concatenate(n).astype(np.int64)
        del keys, read
        if top.joined:
            both, n = runs(top.join(key, last), n)
            key, last = top.parted(part, both)
        else:
            key, last, at, n = sorted_grams(key, last, n)
            named = [x[at] for x in named]
        real = last != np.uint64(words.pad)
        own = heads(key)
        stats = [np.add.reduceat(np.where(real, x, 0), own) for x in (n, n == 1, n == 2, n >= 3)]
        saved(f"{folder}/context{order - 1}-{part:06d}", [*indexed(key[own] & mask(top.rest), top.rest), *coded(*stats)])
        rows = len(own)
        row = np.repeat(np.arange(rows, dtype=np.uint64), np.diff(own, append=len(key)))[real]
        key, last, n, named = key[real], last[real], n[real], [x[real] for x in named]
        bits = rows.bit_length() + words.bits
        entry = mixed(row << np.uint64(words.bits) | last, bits)
        order_of = np.argsort(entry)
        saved(f"{folder}/gram{order}-{part:06d}", [*indexed(entry[order_of], bits), *coded(n[order_of])])
        if order == 1:
            return [], line(rows, n)
        after = [*top.words(key, named)[1:], last]
        key, at, ones = summed(top.key(after, len(last)), np.ones(len(last), np.int64))
        zeros = [np.zeros(len(key), np.int64)] * STATS
        return top.blocks(key, [w[at] for w in after], ones, *zeros), line(rows, n)

    def build(k: int):
        kind, below = kinds[k], kinds[k - 1]

        def run(part: int, data: list[bytes]):
            read = [unpacked(d, kind.columns + 1 + STATS) for d in data]
            keys = np.concatenate([kind.regained(part, r[: kind.columns]) for r in read])
            named = [np.concatenate([r[i] for r in read]) for i in range(kind.columns)] if not kind.exact else []
            sums = [np.concatenate([r[kind.columns + i] for r in read]).astype(np.int64) for i in range(1 + STATS)]
            key, at, n, *stats = summed(keys, *sums)
            del read, keys, sums
            contexts, inside = f"{folder}/context{k}-{part:06d}", key & mask(kind.rest)
            if k < order - 1:
                saved(contexts, [*indexed(inside, kind.rest), *coded(*stats)])
                rows, held = len(key), n
            else:  # written with the top table
                index = opened(contexts)
                rows = int(index[0][0])
                place = find(index, inside)
                if (place < 0).any():
                    raise RuntimeError("a gram is missing among the contexts")
                held = np.zeros(rows, np.int64)
                held[place] = n
            saved(f"{folder}/gram{k}-{part:06d}", coded(held))
            if k == 1:
                return [], line(rows, n)
            known = n > 0
            named = kind.words(key[known], [x[at[known]] for x in named])
            n = n[known]
            size, none = len(n), np.zeros(len(n), np.int64)
            # Each gram is one follower of its first words, and makes one left neighbour of its last ones.
            both = [np.concatenate([a, b]) for a, b in zip(named[:-1], named[1:])]
            columns = [(none, none + 1), (n, none), (n == 1, none), (n == 2, none), (n >= 3, none)]
            key, at, *columns = summed(below.key(both, 2 * size), *(np.concatenate(c).astype(np.int64) for c in columns))
            return below.blocks(key, [w[at] for w in both], *columns), line(rows, n)

        return run

    lines: dict[int, list[np.ndarray]] = {order: []}
    found: list[DataFrame] = []
    for turn in range(rounds):
        out, own = dealt(train.mapInArrow(grams(turn), BLOCKS), 1 << top.part_bits, build_top, "grams")
        lines[order] += own
        found.append(out)
    for k in range(order - 1, 0, -1):
        out, lines[k] = dealt(reduce(DataFrame.unionAll, found), 1 << kinds[k].part_bits, build(k), "grams")
        released(*found)
        found = [out]
    released(*found)
    return lines


class Table:
    """Mapped tables of grams of one size; each part is opened when it is first asked for."""

    def __init__(self, folder: str, what: str, parts: set[int]):
        self.folder, self.what, self.parts, self.open = folder, what, parts, {}

    def part(self, part: int) -> list[np.ndarray] | None:
        if part not in self.open:
            path = f"{self.folder}/{self.what}-{part:06d}"
            self.open[part] = opened(path) if part in self.parts else None
        return self.open[part]


def by_home(home: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The rows of each part."""
    order = np.argsort(narrow(home, home.max() if len(home) else 0), kind="stable")
    home = home[order]
    parts, starts = np.unique(home, return_index=True)
    for part, rows in zip(parts.tolist(), np.split(order, starts[1:])):
        yield part, rows


def discounts(lines: list[np.ndarray]) -> list[float]:
    """Discounts for counts 1, 2 and more, from the counts of counts."""
    n1, n2, n3, n4 = (sum(int(x[i]) for x in lines) for i in range(3, 7))
    if not (n1 and n2):
        return [0.5, 0.5, 0.5]
    y = n1 / (n1 + 2 * n2)
    raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return [min(max(d, 0.05), k - 0.05) for d, k in zip(raw, (1, 2, 3))]


def local_folder(path: str) -> str:
    parts = urlparse(path)
    if parts.scheme not in ("", "file"):
        raise RuntimeError("memory-mapped models need spark.checkpoint.dir on a mounted shared file system")
    return parts.path


def score(docs: DataFrame, training, text: str = "text", doc_id: str = "doc_id", order: int = ORDER) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every whole text.

    ``training`` is a condition on ``docs``; its nulls count as held out.  All n-grams of all training texts are
    kept, and the tables grow with them.  A null or empty text is the end mark alone; repeated rows are scored
    and counted each; without training rows every probability is uniform.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(F.col(text)).alias("body"),
                       F.coalesce(training, F.lit(False)).alias("train"))
    folder = local_folder(shared_path(docs.sparkSession, "kneser-ney"))
    train = rows.where("train").select("body")
    words, n_train = counted_words(train, folder)
    vocabulary = words.size
    (end,), (end_count,) = (x.tolist() for x in words.find(np.array([END])))
    words.open.clear()  # mapped again by each worker
    lines = tables(train, order, words, end, n_train, folder) if n_train else {k: [] for k in range(1, order + 1)}
    cut = {k: np.array([0.0, *discounts(lines[k])]) for k in lines}
    once = [sum(int(x[i]) for x in lines[1]) for i in (2, 3, 4, 7)]  # sum, and how many are 1, 2 and more
    root = (float(once[0] or 1), float(np.dot(once[1:], cut[1][1:]) or 1))
    kinds = gram_kinds(order, words, n_train)
    parts = {k: {int(x[0]) for x in lines[k]} for k in lines}

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = {k: Table(folder, f"gram{k}", parts[k]) for k in range(1, order + 1)}
        # The contexts of the full order are parted like its grams, and written with them.
        contexts = {k: Table(folder, f"context{k}", parts[order if k == order - 1 else k]) for k in range(min(1, order - 1), order)}

        def mass(k: int, n: np.ndarray) -> np.ndarray:
            return n - cut[k][np.minimum(n, 3).astype(np.int64)]

        def looked_up(k: int, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
            """Count of each gram, and as a context its total, the mass left by the discounts, and its row."""
            n, total, left, row = np.zeros(len(key)), np.zeros(len(key)), np.zeros(len(key)), np.full(len(key), -1)
            for part, some in by_home(kinds[k].part(key)):
                if (held := contexts[k].part(part)) is not None:
                    row[some] = found = find(held, key[some] & mask(kinds[k].rest))
                    codes, totals, *few = held[INDEX:]
                    over = sum(d * x for d, x in zip(cut[k + 1][1:], few))
                    total[some], left[some] = decoded([codes, totals, over], found)
                    if (own := grams[k].part(part)) is not None:
                        (n[some],) = decoded(own, found)
            return n, total, left, row

        for batch, texts in texts_of(batches):
            flat, ends, sizes, places, numbers, counts = numbered(texts, order, words, end)
            first = ends - sizes - 2  # the first word of each text
            at = np.arange(len(places) + len(sizes)) + np.repeat(first - (np.cumsum(sizes + 1) - sizes - 1), sizes + 1)
            # Grams that end at a token or at the start mark before the first one, which is needed as a context only.
            spots = np.arange(len(at) + len(sizes)) + np.repeat(first - 1 - (np.cumsum(sizes + 2) - sizes - 2), sizes + 2)
            before = np.arange(len(at)) + np.repeat(np.arange(len(sizes)), sizes + 1)  # the spot before each token
            c, is_word = np.full(len(at), float(end_count)), np.ones(len(at), bool)
            is_word[np.cumsum(sizes + 1) - 1] = False
            c[is_word] = counts[places]
            distinct = np.append(numbers, np.array([end, words.start], np.uint64))
            local = np.full(len(at), len(numbers))
            local[is_word] = places
            local = np.insert(local, np.cumsum(sizes + 1) - sizes - 1, len(numbers) + 1)
            p = None
            for k in range(1, order):
                if k == 1:  # each distinct word once
                    key = kinds[1].key([distinct], len(distinct))
                    key, n, total, left, row = (x[local] for x in (key, *looked_up(1, key)))
                else:
                    key = kinds[k].key([flat[spots - j] for j in range(k - 1, -1, -1)], len(spots))
                    n, total, left, row = looked_up(k, key)
                own = mass(k, n[before + 1])
                if k == 1:
                    p = own / root[0] + root[1] / root[0] / (vocabulary + 1)
                else:
                    p = np.where(seen, own / size + share / size * p, p)
                total, share = total[before], left[before]
                seen = total > 0
                size = np.where(seen, total, 1.0)
            n = np.zeros(len(at))
            if order == 1:
                home, row = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
            else:
                home, row = kinds[order - 1].part(key[before]), row[before]
            for part, some in by_home(home):
                if (held := grams[order].part(part)) is not None:
                    bits = int(contexts[order - 1].part(part)[0][0]).bit_length() + words.bits
                    entry = np.maximum(row[some], 0).astype(np.uint64) << np.uint64(words.bits) | flat[at[some]]
                    found = np.where(row[some] < 0, -1, find(held, mixed(entry, bits)))
                    (n[some],) = decoded(held[INDEX:], found)
            if order == 1:
                p = mass(1, n) / root[0] + root[1] / root[0] / (vocabulary + 1)
            else:
                p = np.where(seen, mass(order, n) / size + share / size * p, p)
            base, logs = np.log10((c + 0.1) / (n_train + 0.1 * (vocabulary + 1))), np.log10(p)
            edges = np.concatenate([[0], np.cumsum(sizes + 1)]).tolist()
            spans = list(zip(edges[:-1], edges[1:]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pc.invert(batch.column("train")),
                    pa.array(sizes + 1, pa.int64()),
                    pa.array([int((c[a:b] > 0).sum()) for a, b in spans], pa.int64()),
                    pa.array(np.full(len(sizes), n_train), pa.int64()),
                    pa.array([float(base[a:b].sum()) for a, b in spans], pa.float64()),
                    pa.array([float(logs[a:b].sum()) for a, b in spans], pa.float64()),
                ],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    return rows.mapInArrow(
        rate,
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double",
    )
