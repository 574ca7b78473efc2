"""Tables in mapped files: sorted keys as a directory and the rest of each key, and columns as small codes."""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow as pa

BUCKET_BITS = 3  # about eight to sixteen keys in a place of the directory
FEW = 1 << 22  # numbers below it are told apart by a table
FACTORS = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9)


def mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def mixed(keys: np.ndarray, bits: int) -> np.ndarray:
    """A one-to-one change of the numbers below ``2**bits``, after which they lie evenly; ``unmixed`` undoes it."""
    half = np.uint64(bits // 2 + 1)
    for factor in FACTORS:
        keys = keys * np.uint64(factor) & mask(bits)
        keys = keys ^ (keys >> half)
    return keys


def unmixed(keys: np.ndarray, bits: int) -> np.ndarray:
    half = np.uint64(bits // 2 + 1)
    for factor in reversed(FACTORS):
        keys = keys ^ (keys >> half)
        keys = keys * np.uint64(pow(factor, -1, 1 << 64)) & mask(bits)
    return keys


def narrow(values: np.ndarray, most: int) -> np.ndarray:
    """Whole numbers up to ``most`` in the smallest type that holds it."""
    return values.astype(np.min_scalar_type(int(most)))


def packed(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers, compressed byte by byte of equal weight; ``unpacked`` reads them."""
    sizes = np.array([len(c) for c in columns], "<u8")
    planes = [np.ascontiguousarray(c.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes() for c in columns]
    return sizes.tobytes() + pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def unpacked(data: bytes, columns: int) -> list[np.ndarray]:
    sizes = np.frombuffer(data, "<u8", columns).astype(np.int64)
    planes = pa.decompress(data[8 * columns :], int(8 * sizes.sum()), codec="zstd", asbytes=True)
    out, at = [], 0
    for n in sizes:
        bytes_of = np.frombuffer(planes, np.uint8, 8 * n, at).reshape(8, n).T
        out.append(np.ascontiguousarray(bytes_of).view("<u8").reshape(n))
        at += int(8 * n)
    return out


def summed(keys: np.ndarray, *columns: np.ndarray) -> list[np.ndarray]:
    """Distinct keys in order, the place of one row of each, and the columns added up by key."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return [keys[first], order[first], *(np.add.reduceat(c[order], first) if len(first) else c for c in columns)]


def saved(path: str, arrays: list[np.ndarray]) -> None:
    """Unsigned arrays in one file, written under a name of its own and then renamed: a repeated task leaves the same file."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    own = f"{path}-{uuid.uuid4().hex}"
    head = [len(arrays), *(x for a in arrays for x in (a.dtype.itemsize, len(a)))]
    with open(own, "wb") as out:
        out.write(np.array(head, "<u8").tobytes())
        for a in arrays:
            out.write(a.tobytes())
            out.write(bytes(-a.nbytes % 8))
    os.replace(own, path)


def opened(path: str) -> list[np.ndarray]:
    """The arrays of ``saved``, mapped: only the touched pages are read, and shared by the workers of a machine."""
    data = np.memmap(path, np.uint8, "r").view(np.ndarray)
    count = int(data[:8].view("<u8")[0])
    head = data[8 : 8 + 16 * count].view("<u8").reshape(count, 2)
    out, at = [], 8 + 16 * count
    for size, n in head.astype(np.int64):
        out.append(data[at : at + size * n].view(f"<u{size}"))
        at += int(size * n + -(size * n) % 8)
    return out


def indexed(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    """Distinct sorted keys below ``2**bits`` for ``find``, in about three bytes each if they lie evenly."""
    top = max(0, min(bits, len(keys).bit_length() - BUCKET_BITS))
    rest = bits - top
    starts = np.searchsorted(keys, np.arange(1 << top, dtype=np.uint64) << np.uint64(rest))
    low = keys & mask(rest)
    shape = np.array([len(keys), rest], np.uint64)
    high = narrow(low >> np.uint64(16), (1 << max(0, rest - 16)) - 1)
    return [shape, narrow(np.append(starts, len(keys)), len(keys)), (low & mask(16)).astype(np.uint16), high]


INDEX = 4  # arrays of ``indexed``


def find(index: list[np.ndarray], keys: np.ndarray) -> np.ndarray:
    """The row of each key, or -1."""
    (n, rest), starts, low, high = index[0].tolist(), *index[1:INDEX]
    if not n:
        return np.full(len(keys), -1)
    place = (keys >> np.uint64(rest)).astype(np.int64)
    lo, end = starts[place].astype(np.int64), starts[place + 1].astype(np.int64)
    wanted = keys & mask(rest)
    kind = np.uint32 if rest <= 32 else np.uint64
    wanted = wanted.astype(kind)

    def at(rows: np.ndarray) -> np.ndarray:
        rows = np.minimum(rows, n - 1)
        return high[rows].astype(kind) << kind(16) | low[rows]

    step = 1 << int((end - lo).max(initial=0)).bit_length()
    while step := step >> 1:
        following = lo + step
        lo = np.where((following <= end) & (at(following - 1) < wanted), following, lo)
    return np.where((lo < end) & (at(lo) == wanted), lo, -1)


def ranks(values: np.ndarray) -> np.ndarray:
    """The place of each of some whole numbers among the distinct ones."""
    most = int(values.max(initial=0))
    if most >= FEW:
        return np.unique(values, return_inverse=True)[1]
    seen = np.zeros(most + 1, np.int64)
    seen[values] = 1
    return (np.cumsum(seen) - 1)[values]


def coded(*columns: np.ndarray) -> list[np.ndarray]:
    """A code per row and the columns of the rows that the codes stand for."""
    codes = np.zeros(len(columns[0]), np.int64)
    for c in columns:
        places = ranks(c)
        codes = ranks(codes * (int(places.max(initial=0)) + 1) + places)
    one = np.zeros(int(codes.max(initial=-1)) + 1, np.int64)
    one[codes] = np.arange(len(codes))  # any row of each code
    return [narrow(codes, max(1, len(one))), *(c[one].astype(np.uint64) for c in columns)]


def decoded(arrays: list[np.ndarray], rows: np.ndarray) -> list[np.ndarray]:
    """The columns at ``rows``, 0 where the row is -1."""
    codes, *tables = arrays
    if not len(codes):
        return [np.zeros(len(rows)) for _ in tables]
    at, hit = codes[np.maximum(rows, 0)], rows >= 0
    return [np.where(hit, t.astype(np.float64)[at], 0.0) for t in tables]
