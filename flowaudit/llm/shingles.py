"""Distinct word shingles of a batch of texts, as sorted 64-bit hashes per document."""

from __future__ import annotations

import numpy as np

from .textops import RangeHash, U64, mix64, slices, word_spans


def shingle_sets(buf: np.ndarray, off: np.ndarray, width: int):
    """(hashes, offsets): each document's distinct ``width``-word shingles.

    A-Z are lower-cased.  A document with fewer words has one shingle, its
    whole sequence; one without words has none.  Hashes are sorted within a
    document.
    """
    docs = len(off) - 1
    s, e, d = word_spans(buf, off)
    counts = np.bincount(d, minlength=docs) if len(d) else np.zeros(docs, np.int64)
    h = RangeHash(buf, lower=True).of(s, e)
    made = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    first = np.cumsum(counts) - counts
    at = slices(first, made)
    owner = np.repeat(np.arange(docs), made)
    room = np.minimum(counts, width)[owner]
    out = np.full(len(at), 0x51, U64)
    for j in range(width):
        live = room > j
        nxt = mix64(out * U64(0xA0761D6478BD642F) + h[np.where(live, at + j, at)])
        out = np.where(live, nxt, out)
    order = np.lexsort((out, owner)) if docs > 1 else np.argsort(out)
    out, owner = out[order], owner[order]
    if len(out):
        fresh = np.ones(len(out), bool)
        fresh[1:] = (out[1:] != out[:-1]) | (owner[1:] != owner[:-1])
        out, owner = out[fresh], owner[fresh]
    sizes = np.bincount(owner, minlength=docs) if len(out) else np.zeros(docs, np.int64)
    return out, np.concatenate(([0], np.cumsum(sizes)))
