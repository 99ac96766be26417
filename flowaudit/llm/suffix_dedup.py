"""Operator 8: removal of byte strings that an earlier document holds, by suffix sorting.

A byte goes if it lies in a ``width``-byte string that also starts in a
document with a smaller doc_id.  Documents are dealt into chunks of bounded
size; a chunk is visited three times over one shuffle of the texts:

1. Anchors.  The anchor of a ``width``-byte window is its ``ANCHOR``-byte
   substring of least hash, so equal windows have equal anchors.  Each chunk
   sends its distinct anchor hashes to the hash's bucket, which answers with a
   bit for those that other chunks have too.  A window whose anchor is in one
   document only occurs nowhere else; this discards most of the input.
2. Segments.  For the shared anchors a chunk sends, once per distinct segment,
   the bytes spanned by the windows of an anchor, with the smallest doc_id of
   the chunk that holds them.  A bucket orders the suffixes of its segments by
   deep-shallow sorting (:mod:`.deep_shallow`); equal neighbours are equal
   windows, whose smallest doc_id is answered as one bit per window.
3. Cuts.  A chunk marks the windows that an earlier document holds, and cuts
   the bytes they cover.

An anchor with very many distinct surroundings (a common line, say) would
gather them in one bucket.  Its windows are dealt by their own content
instead, one entry per chunk and distinct window, so no bucket depends on how
often a string occurs.  All results are exact; hashes only choose where bytes
meet, but for entries that coincide in 64 bits within one bucket.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from .common import shuffle_width
from .deep_shallow import suffix_groups
from .textops import RangeHash, U64, column_bytes, mix64, runs_of, slices, sub_batches

WIDTH, ANCHOR = 50, 24
CHUNK_BYTES = 4 << 20     # text per chunk
STEP = 1 << 20            # text hashed at once
HOT = 256                 # distinct surroundings (summed over chunks) from which windows are dealt singly
LAST = np.iinfo(np.int64).max
_HOT_MARK = 255


def anchors(buf: np.ndarray, off: np.ndarray, width: int, anchor: int):
    """Per anchor, in text order: hash, segment hash, first and last window start, position, document."""
    out = []
    span = width - anchor + 1
    for i, j in sub_batches(off, STEP):
        b, o = buf[off[i]:off[j]], off[i:j + 1] - off[i]
        n = len(b) - width + 1
        if n <= 0:
            continue
        rh = RangeHash(b)
        h = rh.windows(anchor)
        least = (h >> U64(32) << U64(32)) | np.arange(len(h), dtype=U64)
        size = 1
        while 2 * size <= span:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < span:
            least = np.minimum(least[:n], least[span - size:])
        valid = np.ones(n, bool)
        ends = o[1:]
        lo = np.minimum(np.maximum(ends - width + 1, o[:-1]), n)
        valid[slices(lo, np.minimum(ends, n) - lo)] = False
        s = np.flatnonzero(valid)
        if not len(s):
            continue
        at = (least[s] & U64(0xFFFFFFFF)).astype(np.int64)
        head = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        tail = np.append(head[1:], len(s)) - 1
        s_lo, s_hi, at = s[head], s[tail], at[head]
        seg = mix64(rh.of(s_lo, s_hi + width) + (at - s_lo).astype(U64))
        doc = np.searchsorted(o, s_lo, side="right") - 1
        out.append((h[at], seg, s_lo + off[i], s_hi + off[i], at + off[i], doc + i))
    if not out:
        z = np.zeros(0, np.int64)
        return z.astype(U64), z.astype(U64), z, z, z, z
    return tuple(np.concatenate(c) for c in zip(*out))


class Chunk:
    """The distinct anchors of a chunk, in an order that every visit repeats."""

    def __init__(self, t: pa.Table, buckets: int, width: int, anchor: int):
        self.buf, self.off = column_bytes(t.column("_text"))
        ids = t.column("_doc").combine_chunks()
        self.ids = ids.fill_null(LAST).to_numpy(zero_copy_only=False)
        self.width = width
        h, self.seg, self.lo, self.hi, self.at, self.doc = anchors(self.buf, self.off, width, anchor)
        bucket = ((h & U64(0xFFFFFF)) % U64(buckets)).astype(np.int64)
        top = h >> U64(24)
        self.order = np.lexsort((self.seg, top, bucket))
        b, t_ = bucket[self.order], top[self.order]
        fresh = np.ones(len(b), bool)
        fresh[1:] = (b[1:] != b[:-1]) | (t_[1:] != t_[:-1])
        self.heads = np.flatnonzero(fresh)
        self.which = np.empty(len(b), np.int64)             # anchor -> its distinct anchor
        self.which[self.order] = np.cumsum(fresh) - 1
        self.bucket, self.top = b[self.heads], t_[self.heads]

    def surroundings(self) -> np.ndarray:
        s = self.seg[self.order]
        new = np.ones(len(s), np.int64)
        new[1:] = s[1:] != s[:-1]
        new[self.heads] = 1
        return np.add.reduceat(new, self.heads) if len(s) else new

    def local_shared(self) -> np.ndarray:
        if not len(self.heads):
            return np.zeros(0, bool)
        d = self.ids[self.doc[self.order]]
        return np.minimum.reduceat(d, self.heads) != np.maximum.reduceat(d, self.heads)

    def entries(self, shared: np.ndarray, hot: np.ndarray, buckets: int):
        """Occurrences (start, windows, doc id, entry) and distinct entries (bucket, first occurrence, mark)."""
        sh, ho = shared[self.which], hot[self.which]
        cold, warm = np.flatnonzero(sh & ~ho), np.flatnonzero(sh & ho)
        n = self.hi[warm] - self.lo[warm] + 1
        start = np.concatenate((self.lo[cold], slices(self.lo[warm], n)))
        windows = np.concatenate((self.hi[cold] - self.lo[cold] + 1, np.ones(int(n.sum()), np.int64)))
        doc = self.ids[np.concatenate((self.doc[cold], np.repeat(self.doc[warm], n)))]
        text = self.buf[slices(start[len(cold):], np.full(int(n.sum()), self.width))]
        ends = np.arange(int(n.sum()) + 1, dtype=np.int64) * self.width
        own = RangeHash(text).of(ends[:-1], ends[1:])
        ident = np.concatenate((self.seg[cold], own))
        bucket = np.concatenate((self.bucket[self.which[cold]], (mix64(own) % U64(buckets)).astype(np.int64)))
        mark = np.concatenate((self.at[cold] - self.lo[cold], np.full(int(n.sum()), _HOT_MARK, np.int64)))
        order = np.lexsort((ident, mark == _HOT_MARK, bucket))
        b, i, m = bucket[order], ident[order], mark[order] == _HOT_MARK
        fresh = np.ones(len(b), bool)
        fresh[1:] = (b[1:] != b[:-1]) | (i[1:] != i[:-1]) | (m[1:] != m[:-1])
        heads = np.flatnonzero(fresh)
        entry = np.empty(len(b), np.int64)
        entry[order] = np.cumsum(fresh) - 1
        least = np.minimum.reduceat(doc[order], heads) if len(heads) else np.zeros(0, np.int64)
        return start, windows, doc, entry, b[heads], order[heads], mark, least


def _runs(values: np.ndarray):
    heads = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else []
    return zip(heads, [*heads[1:], len(values)])


def _rows(rows, names, types):
    return pa.Table.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)


_MESSAGE = ["kind", "chunk", "bucket", "blob"]
_TYPES = [pa.int32(), pa.int32(), pa.int32(), pa.binary()]
_DDL = "kind int, chunk int, bucket int, blob binary"


def _bits(mask: np.ndarray) -> bytes:
    return np.packbits(mask).tobytes()


def _mask(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def _nullable(t: pa.DataType) -> pa.DataType:
    """``t`` with fields that may be null, as the declared result has them."""
    if pa.types.is_struct(t):
        return pa.struct([pa.field(f.name, _nullable(f.type)) for f in t])
    if pa.types.is_map(t):
        return pa.map_(t.key_type, _nullable(t.item_type))
    return pa.list_(_nullable(t.value_type)) if pa.types.is_list(t) else t


def _visit_anchors(buckets, width, anchor):
    def run(t: pa.Table) -> pa.Table:
        c = Chunk(t, buckets, width, anchor)
        chunk = t.column("_chunk")[0].as_py()
        count = np.minimum(c.surroundings(), 255).astype(np.uint8)
        packed = np.empty((len(c.top), 6), np.uint8)
        packed[:, :5] = c.top.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:]
        packed[:, 5] = count
        return _rows([(0, chunk, int(c.bucket[a]), packed[a:b].tobytes()) for a, b in _runs(c.bucket)],
                     _MESSAGE, _TYPES)
    return run


def _answer_anchors(hot: int):
    def run(t: pa.Table) -> pa.Table:
        chunks, blobs = t.column("chunk").to_pylist(), t.column("blob").to_pylist()
        data = np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, 6)
        wide = np.zeros((len(data), 8), np.uint8)
        wide[:, 3:] = data[:, :5]
        key = wide.view(">u8").ravel().astype(U64)
        order = np.argsort(key, kind="stable")
        heads = np.flatnonzero(np.concatenate(([True], key[order][1:] != key[order][:-1])))
        size = np.diff(np.append(heads, len(order)))
        around = np.add.reduceat(data[order, 5].astype(np.int64), heads)
        shared, burning = np.empty(len(key), bool), np.empty(len(key), bool)
        shared[order] = np.repeat(size > 1, size)
        burning[order] = np.repeat(around >= hot, size)
        at, rows = 0, []
        for chunk, blob in zip(chunks, blobs):
            n = len(blob) // 6
            rows.append((0, chunk, t.column("bucket")[0].as_py(),
                         _bits(shared[at:at + n]) + _bits(burning[at:at + n])))
            at += n
        return _rows(rows, _MESSAGE, _TYPES)
    return run


def _anchor_flags(c: Chunk, answers: pa.Table):
    got = dict(zip(answers.column("bucket").to_pylist(), answers.column("blob").to_pylist()))
    shared, hot = np.zeros(len(c.heads), bool), np.zeros(len(c.heads), bool)
    for a, b in _runs(c.bucket):
        blob, n = got[int(c.bucket[a])], b - a
        shared[a:b], hot[a:b] = _mask(blob[:-(-n // 8)], n), _mask(blob[-(-n // 8):], n)
    return shared | c.local_shared(), hot


def _visit_segments(buckets, width, anchor):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _rows([], _MESSAGE, _TYPES)
        c = Chunk(docs, buckets, width, anchor)
        chunk = docs.column("_chunk")[0].as_py()
        shared, hot = _anchor_flags(c, answers)
        start, windows, _, _, bucket, first, mark, least = c.entries(shared, hot, buckets)
        rows = [(1, chunk, chunk % buckets, _bits(shared) + _bits(hot))]     # back to the last visit
        zip_ = zstandard.ZstdCompressor(level=1)
        for a, b in _runs(bucket):
            f = first[a:b]
            body = c.buf[slices(start[f], windows[f] + width - 1)]
            blob = b"".join((np.uint32(b - a).tobytes(), windows[f].astype(np.uint8).tobytes(),
                             mark[f].astype(np.uint8).tobytes(), least[a:b].tobytes(), body.tobytes()))
            rows.append((0, chunk, int(bucket[a]), zip_.compress(blob)))
        return _rows(rows, _MESSAGE, _TYPES)
    return run


def _earliest(text, off, windows, mark, doc, width, anchor):
    """Smallest doc id of every window of distinct entries, in entry order."""
    base = np.cumsum(windows) - windows
    best = np.repeat(doc, windows)
    cold = np.flatnonzero(mark != _HOT_MARK)
    if len(cold):
        at = off[cold] + mark[cold]
        key = RangeHash(text).of(at, at + anchor)
        _, family, size = np.unique(key, return_inverse=True, return_counts=True)
        several = size[family] > 1
        cold, family = cold[several], family[several]
        n = windows[cold]
        start, place = slices(off[cold], n), slices(base[cold], n)
        offset = np.repeat(mark[cold], n) - (start - np.repeat(off[cold], n))     # anchor's place in the window
        order, rank = suffix_groups(text, start, width, np.repeat(family, n) * (width + 1) + offset)
        if len(order):
            heads = np.flatnonzero(np.concatenate(([True], rank[1:] != rank[:-1])))
            low = np.minimum.reduceat(best[place[order]], heads)
            best[place[order]] = low[rank]
    return best, base


def _answer_segments(width, anchor):
    def run(t: pa.Table) -> pa.Table:
        rows, parts = [], []
        unzip = zstandard.ZstdDecompressor()
        for kind, chunk, bucket, blob in zip(*(t.column(c).to_pylist() for c in _MESSAGE)):
            if kind == 1:
                rows.append((1, chunk, bucket, blob))
                continue
            raw = unzip.decompress(blob)
            n = int(np.frombuffer(raw, np.uint32, 1)[0])
            windows = np.frombuffer(raw, np.uint8, n, 4).astype(np.int64)
            mark = np.frombuffer(raw, np.uint8, n, 4 + n).astype(np.int64)
            doc = np.frombuffer(raw, np.int64, n, 4 + 2 * n)
            parts.append((chunk, bucket, windows, mark, doc, np.frombuffer(raw, np.uint8, -1, 4 + 10 * n)))
        if parts:
            windows, mark, doc, text = (np.concatenate([p[k] for p in parts]) for k in (2, 3, 4, 5))
            off = np.concatenate(([0], np.cumsum(windows + width - 1)))
            ident = mix64(RangeHash(text).of(off[:-1], off[1:]) + mark.astype(U64))
            order = np.lexsort((doc, ident))
            heads = np.flatnonzero(np.concatenate(([True], ident[order][1:] != ident[order][:-1])))
            first = order[heads]                              # distinct entries, with their smallest doc id
            entry = np.empty(len(order), np.int64)
            entry[order] = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(order))))
            size = windows[first] + width - 1
            body = text[slices(off[first], size)]
            best, base = _earliest(body, np.cumsum(size) - size, windows[first], mark[first], doc[first],
                                   width, anchor)
            before = best[slices(base[entry], windows)] < np.repeat(doc, windows)
            ends = np.cumsum(windows)
            at = 0
            for chunk, bucket, w, *_ in parts:
                a, b = (ends[at - 1] if at else 0), (ends[at + len(w) - 1] if len(w) else 0)
                rows.append((0, chunk, bucket, _bits(before[a:b])))
                at += len(w)
        return _rows(rows, _MESSAGE, _TYPES)
    return run


def _visit_cuts(buckets, width, anchor, whole_characters):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        names = ["_doc", "_rest", "_bytes", "_starts", "_ends", "_kept"]
        kinds = answers.column("kind").to_pylist()
        blobs = answers.column("blob").to_pylist()
        at = answers.column("bucket").to_pylist()
        c = Chunk(docs, buckets, width, anchor)
        covered = np.zeros(len(c.buf) + 1, np.int32)
        if len(c.heads):
            flags = next(b for k, b in zip(kinds, blobs) if k == 1)
            half, n = -(-len(c.heads) // 8), len(c.heads)
            start, windows, doc, entry, bucket, first, _, least = c.entries(
                _mask(flags[:half], n), _mask(flags[half:], n), buckets)
            got = {b: x for k, b, x in zip(kinds, at, blobs) if k == 0}
            own = windows[first]
            base = np.cumsum(own) - own
            earlier = np.zeros(int(own.sum()), bool)
            for a, b in _runs(bucket):
                n = int(own[a:b].sum())
                earlier[base[a]:base[a] + n] = _mask(got[int(bucket[a])], n)
            gone = np.repeat(doc > least[entry], windows) | earlier[slices(base[entry], windows)]
            s = slices(start, windows)[gone]
            covered[s] += 1
            covered[s + width] -= 1
        keep = np.cumsum(covered[:-1]) == 0
        if whole_characters and len(keep):
            lead = np.flatnonzero((c.buf & 0xC0) != 0x80)
            keep = np.repeat(np.logical_and.reduceat(keep, lead), np.diff(np.append(lead, len(keep))))
        # maximal runs, never across documents
        off = c.off
        edge = np.zeros(len(keep) + 1, bool)
        edge[off] = True
        gone = ~keep
        begins, ends = gone.copy(), gone.copy()
        begins[1:] &= keep[:-1] | edge[1:-1]
        ends[:-1] &= keep[1:] | edge[1:-1]
        b, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        d = np.searchsorted(off, b, side="right") - 1
        per = np.concatenate(([0], np.cumsum(np.bincount(d, minlength=len(off) - 1)))).astype(np.int32)
        kept_at = np.concatenate(([0], np.cumsum(keep)))[off]
        left = pa.Array.from_buffers(pa.large_binary(), len(off) - 1, [
            None, pa.py_buffer(kept_at.astype(np.int64).tobytes()), pa.py_buffer(c.buf[keep].tobytes())])
        lists = [pa.ListArray.from_arrays(pa.array(per), pa.array(v - off[d])) for v in (b, e)]
        rest = docs.column("_rest")
        return pa.Table.from_arrays([docs.column("_doc"), rest.cast(_nullable(rest.type)), pa.array(np.diff(off)), *lists,
                                     left.cast(pa.binary())], names=names)
    return run


def drop_repeats(docs: DataFrame, width: int = WIDTH, anchor: int = ANCHOR, chunk_bytes: int = CHUNK_BYTES,
                 hot: int = HOT, carry: bool = True, whole_characters: bool = False) -> DataFrame:
    """Cuts from ``docs`` (doc_id, text, ...) the bytes that earlier documents hold.

    Returns doc_id, ``rest`` (the other input columns as a struct, null if
    ``carry`` is false), n_bytes, ``starts`` and ``ends`` (the maximal removed
    byte spans, ends exclusive) and ``kept`` (the remaining bytes).  With
    ``whole_characters`` a character that loses a byte is removed as a whole,
    so that ``kept`` is UTF-8 again.

    Texts are taken as UTF-8 bytes, a null text as empty; texts shorter than
    ``width`` keep everything.  Matches never cross documents.  Rows with the
    same doc_id do not remove each other's bytes.  A row without doc_id counts
    as later than all others.  An empty table gives an empty result.  Rows are
    dealt to chunks by their whole contents, so many rows of one id or of none
    spread like any others; only rows alike in every column share a chunk.
    """
    if not 0 < anchor <= width < 256 + anchor - 2:
        raise ValueError("anchor must be positive and at most width")
    spark = docs.sparkSession
    rest = [c for c in docs.columns if c not in ("doc_id", "text")] if carry else []
    text = F.col("text").cast("string")
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    chunks = max(shuffle_width(spark), -(-total // chunk_bytes))
    # rows without id, or of one id, are dealt by all that they hold (maps have no hash)
    spread_by = [F.col(f"_rest.`{c}`") for c in rest if "map<" not in docs.schema[c].dataType.simpleString()]
    other = F.struct(*[F.col(f"`{c}`") for c in rest]) if rest else F.lit(None).cast("int")
    base = docs.select(F.col("doc_id").cast("long").alias("_doc"), text.alias("_text"), other.alias("_rest")) \
        .withColumn("_chunk", F.pmod(F.xxhash64("_doc", "_text", *spread_by), F.lit(chunks)).cast("int")) \
        .repartition(chunks, "_chunk")
    by = base.groupBy("_chunk")
    flags = by.applyInArrow(_visit_anchors(chunks, width, anchor), _DDL) \
        .groupBy("bucket").applyInArrow(_answer_anchors(hot), _DDL)
    cuts = by.cogroup(flags.groupBy("chunk")).applyInArrow(_visit_segments(chunks, width, anchor), _DDL) \
        .groupBy("bucket").applyInArrow(_answer_segments(width, anchor), _DDL)
    kind = base.schema["_rest"].dataType.simpleString()
    done = by.cogroup(cuts.groupBy("chunk")).applyInArrow(
        _visit_cuts(chunks, width, anchor, whole_characters),
        f"_doc long, _rest {kind}, _bytes long, _starts array<long>, _ends array<long>, _kept binary")
    return done.select(F.col("_doc").alias("doc_id"), F.col("_rest").alias("rest"), F.col("_bytes").alias("n_bytes"),
                       F.col("_starts").alias("starts"), F.col("_ends").alias("ends"), F.col("_kept").alias("kept"))
