"""Shared helpers: written tables, rows packed apart, and vectorised word hashing of Arrow text columns.

Words are maximal runs of bytes outside ``\\x20 \\x09-\\x0D`` of the UTF-8 text. Word and shingle hashes have 64 bits;
two different shingles of one pair of documents collide with a probability of about ``|union|^2 / 2^65``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framegauge.functions.storage import discard, shared_dir, written

__all__ = ["discard", "shared_dir", "written"]

U64 = np.uint64


def packed(df: DataFrame, replaced: list[str], **extra: Column) -> DataFrame:
    """``df`` as one struct column ``_row`` beside the extra columns, so that no name of the input can clash with an
    operator's own; columns that the operator replaces are left out."""
    low = {c.lower() for c in replaced}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in low]
    return df.select(F.struct(*kept).alias("_row"), *(v.alias(k) for k, v in extra.items()))


def bitmap(places: DataFrame, bits: int) -> bytes:
    """A bit for every place (column ``place``, 0 to bits - 1); bits is a multiple of 32768."""
    parts = places.groupBy(F.expr("bitmap_bucket_number(place + 1)").alias("k")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(place + 1))").alias("bits")).toArrow()
    out = np.zeros((bits // 32768, 4096), np.uint8)
    for k, x in zip(parts.column("k").to_pylist(), parts.column("bits").to_pylist(), strict=True):
        out[k - 1] = np.frombuffer(x, np.uint8)
    return out.tobytes()


def marked(marks: bytes, places: np.ndarray) -> np.ndarray:
    """Which places have a bit."""
    return (np.frombuffer(marks, np.uint8)[places >> 3] >> (places & 7).astype(np.uint8) & 1).astype(bool)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, element by element."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_BASE = 0x9E6C63D0876A9A47 | 1
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base to the powers 1 to n, and its inverse (modulo 2^64) to the powers 0 to n - 1."""
    if not _POWERS or _POWERS[0].size < n:
        size = max(n, (1 << 20) + 4096)
        up = np.cumprod(np.full(size, _BASE, U64))
        down = np.cumprod(np.concatenate([[U64(1)], np.full(size - 1, pow(_BASE, -1, 1 << 64), U64)]))
        if size > 1 << 24:  # not kept for a rare huge word
            return up[:n], down[:n]
        _POWERS[:] = [up, down]
    return _POWERS[0][:n], _POWERS[1][:n]


def _block(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes and word starts of one block of bytes; a word also ends at an offset. A word's hash is a polynomial of its
    bytes: the difference of two running sums, times a power that takes the word's place out."""
    solid = ~_SPACE[data]
    start = solid.copy()
    start[1:] &= ~solid[:-1]
    cut = offsets[(offsets > 0) & (offsets < data.size)]
    start[cut] = solid[cut]
    starts = np.flatnonzero(start)
    if not starts.size:
        return np.empty(0, U64), starts
    stop = ~solid
    stop |= start
    ends = np.flatnonzero(solid[:-1] & stop[1:]) + 1
    if solid[-1]:
        ends = np.append(ends, data.size)
    up, down = _powers(data.size)
    sums = np.zeros(data.size + 1, U64)
    np.cumsum(_BYTE[data] * up, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64)), starts


def hash_words(data: np.ndarray, offsets: np.ndarray, lower: bool = True, block: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and, for each document, the index of its first word (one more entry than documents).

    Works in blocks cut at white space, so scratch memory doesn't grow with a document's length."""
    if lower:
        data = _LOWER[data]
    hashes, starts, at = [], [], 0
    while at < data.size:
        end = min(at + block, data.size)
        while end < data.size:
            stop = np.flatnonzero(_SPACE[data[end : end + 4096]])
            if stop.size:
                end += int(stop[0])
                break
            end = min(end + 4096, data.size)
        lo, hi = np.searchsorted(offsets, [at, end])
        h, s = _block(data[at:end], offsets[lo:hi] - at)
        hashes.append(h)
        starts.append(s + at)
        at = end
    if not hashes:
        return np.empty(0, U64), np.zeros(len(offsets), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), offsets)


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """One hash for each run of n words; of fewer words, the whole sequence as one; none of none."""
    if not words.size:
        return words
    k = min(n, words.size)
    m = words.size - k + 1
    acc = words[:m] ^ U64(k if k < n else 0)
    for j in range(1, k):
        acc = mix(acc * U64(0x9FB21C651E98DF25) + words[j : j + m])
    return mix(acc)


def text_chunks(column: pa.Array | pa.ChunkedArray, limit: int = 1 << 20):
    """(first row, end row, bytes, offsets) of runs of rows with about ``limit`` bytes; nulls are empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_utf8())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    _, off, raw = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.empty(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def shingle_sets(column: pa.Array, n: int, lower: bool = True):
    """(row, sorted distinct shingle hashes) of every row of an Arrow text column."""
    for lo, hi, data, offsets in text_chunks(column):
        words, at = hash_words(data, offsets, lower)
        whole = shingle_hashes(words, n)  # also across rows, which are left out below
        for i in range(hi - lo):
            a, b = at[i], at[i + 1]
            x = np.sort(whole[a : b - n + 1] if b - a >= n else shingle_hashes(words[a:b], n))
            yield lo + i, x[np.concatenate([[True], x[1:] != x[:-1]])] if x.size > 1 else x
