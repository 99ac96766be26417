"""Vectorised text primitives on Arrow string buffers (numpy, inside tasks).

A batch of texts is one byte buffer plus document offsets; words and n-grams
are index arrays into it.  Hashes of byte ranges come from one running
polynomial sum per batch, so a range costs two lookups whatever its length.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15           # odd, hence invertible modulo 2^64
#: Bytes that separate words: the space and 0x09-0x0D.
SPACES = bytes([0x20, *range(0x09, 0x0E)])


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser (splitmix64) of uint64 values."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


@lru_cache(maxsize=4)
def _byte_table(lower: bool) -> np.ndarray:
    codes = np.arange(256, dtype=U64)
    if lower:
        codes[ord("A"):ord("Z") + 1] += U64(32)
    return mix64(codes + U64(0x632BE59BD9B4E019))


_POWERS: dict[int, np.ndarray] = {}


def _powers(n: int, base: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2^64, kept per worker and grown by doubling."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        with np.errstate(over="ignore"):
            have = np.full(size, base, U64)
            have[0] = 1
            have = np.multiply.accumulate(have)
        _POWERS[base] = have
    return have[:n]


def column_bytes(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], col.type)
    col = col.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    n = len(col)
    _, offsets, data = col.buffers()
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64)[col.offset:col.offset + n + 1]
    if data is None:
        return np.zeros(0, np.uint8), off - off[0]
    return np.frombuffer(data, np.uint8)[off[0]:off[-1]], off - off[0]


@lru_cache(maxsize=1)
def _space_table() -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(SPACES)] = True
    return t


def word_spans(buf: np.ndarray, off: np.ndarray):
    """(start, end, document) of every word ``[^\\x20\\x09-\\x0D]+``; words never cross documents."""
    n = len(buf)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    solid = ~_space_table()[buf]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:]
    cut = off[:-1][np.diff(off) > 0]          # first byte of each non-empty document
    begins[cut] = solid[cut]
    last = off[1:][np.diff(off) > 0] - 1
    ends[last] = solid[last]
    s, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return s, e, np.searchsorted(off, s, side="right") - 1


class RangeHash:
    """64-bit hashes of any byte ranges of one buffer."""

    def __init__(self, buf: np.ndarray, lower: bool = False):
        n = len(buf)
        self.sums = np.zeros(n + 1, U64)
        np.cumsum(_byte_table(lower)[buf] * _powers(n, BASE), out=self.sums[1:])
        self.inverse = _powers(n + 1, pow(BASE, -1, 1 << 64))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.inverse[start]
        return mix64(h + (end - start).astype(U64) * U64(0xD6E8FEB86659FD93))

    def windows(self, k: int) -> np.ndarray:
        """Hashes of the ``k`` bytes from every position where they fit."""
        if len(self.sums) <= k:
            return np.zeros(0, U64)
        h = (self.sums[k:] - self.sums[:-k]) * self.inverse[:len(self.sums) - k]
        return mix64(h)


def runs_of(mask: np.ndarray):
    """(start, end) of the maximal runs of true values."""
    edge = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def slices(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated index ranges ``start .. start+length-1``."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    out = np.ones(total, np.int64)
    heads = np.cumsum(lengths) - lengths
    live = lengths > 0
    heads, first = heads[live], starts[live]
    out[heads] = first
    out[heads[1:]] -= first[:-1] + lengths[live][:-1] - 1
    return np.cumsum(out)


def sub_batches(off: np.ndarray, size: int):
    """Ranges of documents of about ``size`` bytes (one document at least)."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + size, side="right")) - 1)
        yield i, j
        i = j
