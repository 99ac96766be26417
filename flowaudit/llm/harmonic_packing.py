"""Operator 9: harmonic packing of token ids into sequences of ``capacity``.

Class k holds the pieces of at most capacity / k ids, k of which fill a
sequence.  A document is first cut into whole sequences; a remainder whose
class would waste more than ``capacity / slack`` gives off the largest piece
of the form capacity // k, and the rest goes on, so that every class is filled
almost exactly.  Each task fills its own classes as it reads and emits a
sequence once it has its k pieces, whatever other tasks do.  What is left in
unfilled sequences (under k pieces per class and task) is ranked per class
over all tasks and filled in the same way; the last unfilled sequence of each
class, a number of pieces that depends on ``capacity`` alone, is closed by
next-fit over descending lengths.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import stage
from .textops import column_bytes
from .tokens import END_OF_DOCUMENT, Encoder, public_path

CAPACITY, SLACK = 2048, 64
_OWN = 40                 # bits of a task's own sequence number
_COLUMNS = ["doc_id", "start", "length", "ids", "doc_tokens", "class", "sequence_id", "offset"]
_DDL = "doc_id long, start long, length long, ids binary, doc_tokens long, class int, sequence_id long, offset long"


def cut(sizes: np.ndarray, capacity: int, slack: int):
    """(document, start, length, class) of the pieces of documents of the given sizes, in order."""
    doc, start, length = [], [], []
    who, at, left = np.arange(len(sizes)), np.zeros(len(sizes), np.int64), sizes.astype(np.int64)
    whole = left // capacity
    doc.append(np.repeat(who, whole))
    first = np.cumsum(whole) - whole
    start.append((np.arange(int(whole.sum())) - np.repeat(first, whole)) * capacity)
    length.append(np.full(int(whole.sum()), capacity, np.int64))
    at, left = whole * capacity, left - whole * capacity
    while True:
        live = left > 0
        who, at, left = who[live], at[live], left[live]
        if not len(who):
            break
        k = capacity // left
        fits = capacity - k * left <= capacity // slack
        take = np.where(fits, left, capacity // (k + 1))
        doc.append(who)
        start.append(at)
        length.append(take)
        at, left = at + take, left - take
    doc, start, length = (np.concatenate(x) for x in (doc, start, length))
    order = np.lexsort((start, doc))
    doc, start, length = doc[order], start[order], length[order]
    return doc, start, length, capacity // length


def _pieces(batch, encoder, capacity, slack, end_id):
    ids_col = batch.column(0)
    buf, off = column_bytes(batch.column(1))
    for i, j, ids, o in encoder.documents(buf, off, end_id):
        sizes = np.diff(o)
        doc, start, length, k = cut(sizes, capacity, slack)
        ends = np.concatenate(([0], np.cumsum(length))) * 4
        blobs = pa.Array.from_buffers(pa.large_binary(), len(length), [
            None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(ids.astype("<u4").tobytes())])
        yield pa.Table.from_arrays(
            [ids_col.slice(i, j - i).take(pa.array(doc)), pa.array(start), pa.array(length), blobs.cast(pa.binary()),
             pa.array(sizes[doc]), pa.array(k.astype(np.int32))], names=_COLUMNS[:6])


def _with(t: pa.Table, sequence, offset) -> list[pa.RecordBatch]:
    none = pa.nulls(t.num_rows, pa.int64())
    t = t.append_column("sequence_id", none if sequence is None else pa.array(sequence)) \
        .append_column("offset", none if offset is None else pa.array(offset))
    return t.combine_chunks().to_batches()


def _offsets(length: np.ndarray, sequence: np.ndarray) -> np.ndarray:
    """Running length within runs of equal sequence."""
    before = np.cumsum(length) - length
    head = np.concatenate(([True], sequence[1:] != sequence[:-1])) if len(sequence) else np.zeros(0, bool)
    return before - np.repeat(before[head], np.diff(np.append(np.flatnonzero(head), len(sequence))))


def _fill(path, capacity, slack, end_id):
    def run(batches):
        encoder = Encoder.of(path)
        base, made, held = TaskContext.get().partitionId() << _OWN, 0, None
        for batch in batches:
            for new in _pieces(batch, encoder, capacity, slack, end_id):
                t = new if held is None else pa.concat_tables([held, new])
                k = t.column("class").to_numpy()
                order = np.argsort(k, kind="stable")
                ks = k[order]
                heads = np.flatnonzero(np.concatenate(([True], ks[1:] != ks[:-1])))
                size = np.diff(np.append(heads, len(ks)))
                rank = np.arange(len(ks)) - np.repeat(heads, size)
                full = size // ks[heads]                                   # sequences filled per class
                done = rank < np.repeat(full * ks[heads], size)
                number = np.repeat(np.cumsum(full) - full, size) + rank // ks
                out = t.take(pa.array(order[done]))
                seq = base + made + number[done]
                if out.num_rows:
                    yield from _with(out, seq, _offsets(out.column("length").to_numpy(), seq))
                made += int(full.sum())
                held = t.take(pa.array(order[~done]))
        if held is not None and held.num_rows:
            yield from _with(held, None, None)
    return run


def _close(capacity: int, first: int):
    """Next-fit over descending lengths, for the bounded remainder."""
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")])
        seq, used, out = first, 0, []
        for n in t.column("length").to_pylist():
            if used + n > capacity:
                seq, used = seq + 1, 0
            out.append((seq, used))
            used += n
        drop = t.select(_COLUMNS[:6])
        return pa.Table.from_batches(_with(drop, [s for s, _ in out], [o for _, o in out]))
    return run


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, slack: int = SLACK,
         end_id: int = END_OF_DOCUMENT) -> DataFrame:
    """The pieces of ``docs`` (doc_id, text), each with its place in a sequence.

    Returns doc_id, start, length, ids (little-endian unsigned 32-bit),
    doc_tokens, sequence_id and offset.  A document's ids are those
    of its whole text by the ``tokenizer`` file, then ``end_id``; a null or
    empty text is ``end_id`` alone.  Every id is in exactly one piece.
    Offsets within a sequence have no gaps; :func:`padded_length` tells what a
    sequence is padded to.  Repeated rows are packed as rows of their own; a
    null doc_id stays null.  An empty table gives an empty result; other
    columns are ignored.
    """
    path = tokenizer or public_path()
    made = stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                 .mapInArrow(_fill(path, capacity, slack, end_id), _DDL), "pieces")
    rest = made.where("sequence_id IS NULL").drop("sequence_id", "offset") \
        .withColumn("worker", F.pmod(F.xxhash64("doc_id", "start", "length"), F.lit(1 << 10)).cast("int"))
    # rank of each unplaced piece within its class: by worker, then within the worker
    ahead = rest.groupBy("class", "worker").agg(F.count("*").alias("n"))
    every = Window.partitionBy("class")
    ahead = ahead.withColumn("ahead", F.sum("n").over(every.orderBy("worker")) - F.col("n")) \
        .withColumn("total", F.sum("n").over(every)).drop("n")
    own = Window.partitionBy("class", "worker").orderBy("doc_id", "start", "ids")
    ranked = stage(rest.withColumn("r", F.row_number().over(own) - 1).join(ahead, ["class", "worker"]).select(
        *_COLUMNS[:6], F.floor((F.col("ahead") + F.col("r")) / F.col("class")).alias("bin"),
        (F.col("ahead") + F.col("r")).alias("r"), F.floor(F.col("total") / F.col("class")).alias("full")), "rest")
    bins = Window.partitionBy("class", "bin").orderBy("r")
    late = F.lit(1 << 61) + F.shiftleft(F.col("class").cast("long"), 45) + F.col("bin")
    filled = ranked.where("bin < full").select(
        *_COLUMNS[:6], late.alias("sequence_id"), (F.sum("length").over(bins) - F.col("length")).alias("offset"))
    last = ranked.where("bin >= full").select(*_COLUMNS[:6], F.lit(0).alias("all")).groupBy("all") \
        .applyInArrow(_close(capacity, 1 << 62), _DDL)
    placed = made.where("sequence_id IS NOT NULL").unionByName(filled).unionByName(last)
    return placed.drop("class")


def padded_length(used, capacity: int = CAPACITY):
    """Length of a sequence of ``used`` ids after padding (a column expression)."""
    return F.when(used.bitwiseAND(used - 1) == 0, used).otherwise(F.lit(capacity))
