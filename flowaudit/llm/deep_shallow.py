"""Deep-shallow ordering of fixed-width suffix windows, for many groups at once.

The shallow phase is a multikey quicksort over 8-byte characters: every group
is split by its next character until ``SHALLOW`` bytes are ordered.  What is
left are groups with a long common prefix; the deep phase builds a blind trie
over each: the common prefix is skipped without ordering it, the group
branches on the first byte in which its members differ, and so on until all
members are apart or equal over the whole width.  Both phases advance all
groups together, one level at a time.
"""

from __future__ import annotations

import numpy as np

from .textops import U64

SHALLOW = 24


class Windows:
    """``width`` bytes from any position of a buffer, read as big-endian 8-byte characters."""

    def __init__(self, buf: np.ndarray, width: int):
        padded = np.concatenate((buf, np.zeros(8 * (width // 8 + 2), np.uint8)))
        self.chars = np.ndarray(len(buf) + width, ">u8", padded, strides=(1,))
        self.bytes, self.width = padded, width
        self.count = -(-width // 8)

    def char(self, at: np.ndarray, j: int) -> np.ndarray:
        c = self.chars[at + 8 * j].astype(U64)
        spare = 8 * (j + 1) - self.width
        return c >> U64(8 * spare) << U64(8 * spare) if spare > 0 else c


def _split(group: np.ndarray, value: np.ndarray):
    """Order by value within group; returns the order and the finer groups, numbered from 0."""
    order = np.lexsort((value, group))
    g, v = group[order], value[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (g[1:] != g[:-1]) | (v[1:] != v[:-1])
    return order, np.cumsum(fresh) - 1


def _common(win: Windows, at: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Bytes that each window has in common with its group's first window."""
    out = np.full(len(at), win.width, np.int64)
    open_ = np.arange(len(at))
    for j in range(win.count):
        diff = win.char(at[open_], j) ^ win.char(first[open_], j)
        differs = diff != 0
        d = diff[differs]
        # leading equal bytes of an 8-byte character, from the exponent of its top 32 bits
        high = (d >> U64(32)).astype(np.int64)
        part = np.where(high > 0, high, (d & U64(0xFFFFFFFF)).astype(np.int64))
        top = np.frexp(part.astype(np.float64))[1]
        out[open_[differs]] = 8 * j + np.where(high > 0, 0, 4) + (32 - top) // 8
        open_ = open_[~differs]
        if not len(open_):
            break
    return out


def suffix_groups(buf: np.ndarray, at: np.ndarray, width: int, group: np.ndarray | None = None):
    """(order, rank): windows of ``width`` bytes at ``at`` in lexicographic order within ``group``.

    ``at[order]`` is sorted; ``rank`` (along that order) is equal for equal
    windows and grows by one between different ones.  Windows of different
    groups never share a rank.
    """
    n = len(at)
    win = Windows(buf, width)
    order, rank = np.arange(n), np.zeros(n, np.int64)
    if group is not None:
        order, rank = _split(group, np.zeros(n, np.int8))
    open_ = _ties(rank)
    for j in range(min(SHALLOW, width) // 8):                        # shallow: multikey quicksort
        order, rank, open_ = _refine(order, rank, open_, lambda w, _: win.char(at[w], j))
    while len(open_):                                                # deep: blind tries
        heads = np.flatnonzero(np.concatenate(([True], np.diff(rank[open_]) != 0)))
        size = np.diff(np.append(heads, len(open_)))
        members = at[order[open_]]
        skip = np.minimum.reduceat(_common(win, members, np.repeat(members[heads], size)), heads)
        apart = np.repeat(skip < width, size)
        skip = np.repeat(skip, size)[apart]
        open_ = open_[apart]
        if not len(open_):
            break
        order, rank, open_ = _refine(order, rank, open_, lambda w, o: win.bytes[at[w] + skip], all_at=True)
    return order, rank


def _ties(rank: np.ndarray) -> np.ndarray:
    """Places whose rank is shared."""
    if not len(rank):
        return np.zeros(0, np.int64)
    same = rank[1:] == rank[:-1]
    tied = np.zeros(len(rank), bool)
    tied[1:] |= same
    tied[:-1] |= same
    return np.flatnonzero(tied)


def _refine(order, rank, open_, value, all_at=False):
    """Splits the groups at the places ``open_`` by a further value of their members."""
    if not len(open_):
        return order, rank, open_
    inner, finer = _split(rank[open_], value(order[open_], open_))
    order = order.copy()
    order[open_] = order[open_][inner]
    fresh = np.ones(len(rank), bool)
    fresh[1:] = rank[1:] != rank[:-1]
    within = np.zeros(len(open_), bool)
    within[1:] = finer[1:] != finer[:-1]
    fresh[open_] |= within
    new = np.cumsum(fresh) - 1
    return order, new, open_[_ties(finer)]
