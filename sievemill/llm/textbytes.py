"""Vectorised words and word hashes over the byte buffers of Arrow string columns.

Texts are never turned into Python strings here: words are byte ranges between separator bytes, and a
word's 64-bit hash is a polynomial over its bytes, finished with a bit mixer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
CHUNK_BYTES = 1 << 20

#: ASCII white space: U+0020 and U+0009 to U+000D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: ASCII bytes other than digits and letters; every byte of a non-ASCII character belongs to a word.
PUNCT = np.zeros(256, bool)
PUNCT[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
#: A-Z to a-z, other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_BASE = 0x9E3779B97F4A7C15
_POW = np.ones(1, U64)
_INV = np.ones(1, U64)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    global _POW, _INV
    if len(_POW) < n:
        inverse = pow(_BASE, -1, 1 << 64)
        size = max(n, 1 << 16)
        p, q = np.full(size, _BASE, U64), np.full(size, inverse, U64)
        p[0] = q[0] = 1
        _POW, _INV = np.multiply.accumulate(p), np.multiply.accumulate(q)
    return _POW, _INV


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every input bit moves every output bit."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


@dataclass
class Chunk:
    """Consecutive rows of a batch: their bytes, row limits in them, words, and each row's limits in the words."""

    first_row: int
    buf: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    row_ptr: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    def word_rows(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), np.diff(self.row_ptr))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, the same wherever the word stands."""
        out = np.empty(len(self.starts), U64)
        at = 0
        while at < len(out):
            low = self.starts[at]
            to = max(at + 1, int(np.searchsorted(self.ends, low + CHUNK_BYTES, "right")))
            high = self.ends[to - 1]
            power, inverse = _tables(int(high - low) + 1)
            sums = np.zeros(high - low + 1, U64)
            np.cumsum((self.buf[low:high].astype(U64) + U64(1)) * power[: high - low], out=sums[1:])
            s, e = self.starts[at:to] - low, self.ends[at:to] - low
            out[at:to] = (sums[e] - sums[s]) * inverse[s] + (e - s).astype(U64)
            at = to
        return mix64(out)


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row limits of a string column without nulls."""
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    limits = np.frombuffer(offsets, np.int64, len(column) + 1, 8 * column.offset) if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), limits


def tokenize(buf: np.ndarray, offsets: np.ndarray, separators: np.ndarray, first_row: int = 0) -> Chunk:
    """Words of rows: maximal runs of bytes that are no separators, never across rows."""
    word = ~separators[buf]
    edges = offsets[(offsets > 0) & (offsets < len(buf))]
    start, end = word.copy(), word.copy()
    start[1:] &= ~word[:-1]
    end[:-1] &= ~word[1:]
    start[edges] = word[edges]
    end[edges - 1] = word[edges - 1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return Chunk(first_row, buf, offsets, starts, ends, np.searchsorted(starts, offsets))


def chunks(column: pa.Array, separators: np.ndarray, lower: bool = False, size: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The rows of a column in order, about `size` bytes at a time and one row at least."""
    data, limits = raw(column)
    at, n = 0, len(limits) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(limits, limits[at] + size, "right")) - 1)
        buf = data[limits[at] : limits[to]]
        yield tokenize(LOWER[buf] if lower else buf, limits[at : to + 1] - limits[at], separators, at)
        at = to


def ngram_hashes(h: np.ndarray, k: int, base: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    """Unmixed hashes of k consecutive words from each place; the last k-1 places hold values without meaning."""
    b, mask = base, (1 << 64) - 1
    total, length, power, unit = None, 0, h.copy(), 1
    factor = b  # base ** unit
    while k:
        if k & 1:
            if total is None:
                total, length = power, unit
            else:  # the words so far, then `unit` more
                total = total * U64(factor) + _shifted(power, length)
                length += unit
        k >>= 1
        if k:
            power = power * U64(factor) + _shifted(power, unit)
            factor = factor * factor & mask
            unit *= 2
    return total


def _shifted(x: np.ndarray, by: int) -> np.ndarray:
    out = np.zeros_like(x)
    if by < len(x):
        out[: len(x) - by] = x[by:]
    return out
