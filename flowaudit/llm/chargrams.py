"""Hashed character n-grams of Arrow batches."""

from __future__ import annotations

import numpy as np

from .textops import BASE, RangeHash, U64, mix64


class CharGrams:
    """n-grams over code points, A-Z lower-cased, never across documents."""

    def __init__(self, buf: np.ndarray, off: np.ndarray):
        rh = RangeHash(buf, lower=True)
        self.start = np.flatnonzero((buf & 0xC0) != 0x80)
        self.bound = np.searchsorted(self.start, off)              # documents in characters
        self.doc = np.repeat(np.arange(len(off) - 1), np.diff(self.bound))
        self.sums = rh.sums[np.append(self.start, len(buf))]
        self.inverse = rh.inverse[self.start]

    def buckets(self, n: int, bits: int):
        """(bucket, place of the first character) of every n-gram."""
        count = len(self.start) - n + 1
        if count <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        h = (self.sums[n:] - self.sums[:-n]) * self.inverse[:count]
        h = (mix64(h + U64(n * BASE % (1 << 64))) >> U64(64 - bits)).astype(np.int64)
        if n > 1:
            at = np.flatnonzero(self.doc[:count] == self.doc[n - 1:])
            return h[at], at
        return h, np.arange(count)
