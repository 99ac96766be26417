"""Operator 2: token-id matrices by best-fit-decreasing packing.

Documents are tokenised in tasks.  A document longer than a row is split into
whole rows and a remainder, losing nothing.  Pieces are packed in decreasing
length; each goes to the row with the least room that still holds it, found in
O(log capacity) by a segment tree over the possible amounts of room.  A task
packs ``window`` ids at a time, so its memory does not depend on the input.

Every row of the result is one row of the id matrix, with the cumulative
lengths of its segments and the position ids, which restart at each segment.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .textops import column_bytes, slices
from .tokens import END_OF_DOCUMENT, Encoder, public_path

CAPACITY, WINDOW = 2048, 4 << 20
_OWN = 40
_DDL = ("sequence_id long, ids binary, n_tokens int, cu_seqlens array<int>, positions binary, doc_ids array<long>, "
        "doc_starts array<long>")


class RoomTree:
    """Rows by their room; ``take(n)`` finds the row with the least room >= n."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()              # leaves 0 .. capacity
        self.any = bytearray(2 * self.size)                 # whether a row below has this room
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def put(self, row: int, room: int):
        stack = self.rows[room]
        stack.append(row)
        if len(stack) == 1:
            i = room + self.size
            while i and not self.any[i]:
                self.any[i] = 1
                i >>= 1

    def take(self, need: int):
        """(row, room), or None if no row has room for ``need``."""
        have, i = self.any, need + self.size
        if not have[i]:
            while i > 1 and (i & 1 or not have[i + 1]):     # up, until a right sibling has rows
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:                            # down, to its least room
                i <<= 1
                if not have[i]:
                    i += 1
        room = i - self.size
        row = self.rows[room].pop()
        if not self.rows[room]:
            while i:
                have[i] = 0
                if i == 1 or have[i ^ 1]:
                    break
                i >>= 1
        return row, room


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Row of each piece (1 .. capacity ids), packed in decreasing length; ties in the given order."""
    tree, rows = RoomTree(capacity), 0
    out = np.empty(len(lengths), np.int64)
    for piece in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[piece])
        found = tree.take(n) if n < capacity else None
        if found is None:
            found = (rows, capacity)
            rows += 1
        out[piece] = found[0]
        if found[1] > n:
            tree.put(found[0], found[1] - n)
    return out


def _matrix(doc_ids: pa.Array, ids: np.ndarray, off: np.ndarray, capacity: int, pad_id: int, first: int):
    """One record batch of packed rows from whole documents."""
    size = np.diff(off)
    parts = -(-size // capacity)
    doc = np.repeat(np.arange(len(size)), parts)
    within = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
    start = within * capacity
    length = np.minimum(size[doc] - start, capacity)
    row = best_fit(length, capacity)
    order = np.argsort(row, kind="stable")
    row, doc, start, length = row[order], doc[order], start[order], length[order]
    rows = int(row[-1]) + 1
    count = np.bincount(row, minlength=rows)
    head = np.cumsum(count) - count
    ahead = np.cumsum(length) - length
    ahead -= np.repeat(ahead[head], count)
    matrix = np.full((rows, capacity), pad_id, "<u4")
    places = np.zeros((rows, capacity), "<u4")
    at = slices(row * capacity + ahead, length)
    matrix.ravel()[at] = ids[slices(off[doc] + start, length)]
    places.ravel()[at] = slices(np.zeros(len(length), np.int64), length)
    used = np.add.reduceat(length, head)
    ends = np.insert(ahead + length, head, 0)                   # 0 and the running ends of each row
    lists = np.concatenate(([0], np.cumsum(count))).astype(np.int32)
    binary = lambda m: pa.FixedSizeBinaryArray.from_buffers(                                  # noqa: E731
        pa.binary(4 * capacity), rows, [None, pa.py_buffer(m.tobytes())]).cast(pa.binary())
    return pa.RecordBatch.from_arrays([
        pa.array(first + np.arange(rows)), binary(matrix), pa.array(used.astype(np.int32)),
        pa.ListArray.from_arrays(pa.array(lists + np.arange(rows + 1, dtype=np.int32)), pa.array(ends.astype(np.int32))),
        binary(places), pa.ListArray.from_arrays(pa.array(lists), doc_ids.take(pa.array(doc))),
        pa.ListArray.from_arrays(pa.array(lists), pa.array(start))], names=_COLUMNS), rows


_COLUMNS = ["sequence_id", "ids", "n_tokens", "cu_seqlens", "positions", "doc_ids", "doc_starts"]


def pack_matrix(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, window: int = WINDOW,
                end_id: int = END_OF_DOCUMENT, pad_id: int = 0) -> DataFrame:
    """Packed rows of ``docs`` (doc_id, text).

    Returns sequence_id, ids and positions (``capacity`` little-endian
    unsigned 32-bit numbers each), n_tokens (ids before the padding),
    cu_seqlens (0 and the end of each segment), and per segment doc_ids and
    doc_starts (its first id's place in the document).  A document's ids are
    those of its whole text, then ``end_id``; a null or empty text is
    ``end_id`` alone.  Repeated rows are packed as rows of their own, a null
    doc_id stays null; an empty table gives an empty result; other columns are
    ignored.
    """
    path = tokenizer or public_path()

    def run(batches):
        encoder = Encoder.of(path)
        base, made = TaskContext.get().partitionId() << _OWN, 0
        held, size = [], 0

        def flush():
            nonlocal made
            ids = np.concatenate([x[1] for x in held])
            off = np.concatenate(([0], np.cumsum(np.concatenate([np.diff(x[2]) for x in held]))))
            batch, rows = _matrix(pa.concat_arrays([x[0] for x in held]), ids, off, capacity, pad_id, base + made)
            made += rows
            for a in range(0, rows, 1024):
                yield batch.slice(a, 1024)
        for batch in batches:
            buf, off = column_bytes(batch.column(1))
            for i, j, ids, o in encoder.documents(buf, off, end_id):
                held.append((batch.column(0).slice(i, j - i), ids, o))
                size += len(ids)
                if size >= window:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, _DDL)


def write_matrix(packed: DataFrame, path: str) -> None:
    """Writes packed rows as Parquet; ids and positions are fixed-width binary rows of the matrices."""
    packed.write.mode("errorifexists").option("compression", "zstd").parquet(path)
