"""Operator 13: exact deduplication through an extendible-hash index.

1.  Tasks fold their batches: texts are lower-cased (A-Z only) and hashed, and
    the equal texts of a batch become one entry with the ids of its rows, so a
    text that a third of the rows share leaves a task once per batch.
2.  The index, bucket files in the shared folder, has one row per key (hash,
    bytes).  While a bucket holds more keys than its capacity, it is split by
    the next bit of the hash, its file is written anew as two, and the
    directory doubles where its depth no longer suffices.  A bucket is a range
    of the key space.
3.  Owner tasks take whole buckets: they see the entries sorted by key, compare
    those of one key byte by byte and chain texts that differ.  A key with more
    entries than a page holds (the index knows) is dealt in pages, whose first
    texts are compared once more.

Only texts whose key may have several entries are moved: a bitmap of fixed
size, filled from the index, tells the scanning tasks.  Where it is too small
for the number of such keys, it lets more texts through, never fewer.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import ensure_checkpoint_dir
from .common import stage
from .textops import RangeHash, U64, column_bytes, slices, sub_batches

BATCH = 1 << 22
SIGN = np.uint64(1 << 63)
#: Bits of the bitmap of keys with several entries.
MAP_BITS = 23
#: Buckets that a directory is planned for; beyond, the capacity grows instead.
MAX_BUCKETS = 1 << 14

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32

KEYS = "key long, n_bytes long"
ENTRIES = "bucket int, key long, n_bytes long, deal int, ids array<long>, nulls long, text binary, sha string"


def map_place(keys: np.ndarray, n_bytes: np.ndarray) -> np.ndarray:
    """Bit of the bitmap for a key: its leading bits, mixed with the length."""
    mixed = (keys.view(U64) ^ SIGN) + n_bytes.astype(U64) * U64(0x9E3779B97F4A7C15)
    return (mixed >> U64(64 - MAP_BITS)).astype(np.int64)


def fold(bits: int, directory: "Directory | None" = None, bitmap: np.ndarray | None = None):
    """Entries of each batch: one per distinct text, with the ids of its rows.

    Without a directory only (key, n_bytes) of the entries.  With it, also
    the bucket, the ids, the digest, and the text if the bitmap has its key.
    ``bits`` shortens the hash (tests force collisions); entries are told
    apart by key, length and bytes whatever it is.
    """
    starts = None if directory is None else directory.starts()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        deal = 0
        for batch in batches:
            buf, off = column_bytes(batch.column(1))
            for i, j in sub_batches(off, BATCH):
                part = _LOWER[buf[off[i]:off[j]]]
                raw = part.tobytes()
                start, end = off[i:j] - off[i], off[i + 1:j + 1] - off[i]
                h = RangeHash(part).of(start, end) >> U64(64 - bits) << U64(64 - bits)
                key = (h ^ SIGN).view(np.int64)                       # the signed order is the order of the hash
                order, heads = _equal(raw, key, start, end)
                lead = order[heads]
                n_bytes = end[lead] - start[lead]
                if starts is None:
                    yield pa.RecordBatch.from_arrays([pa.array(key[lead]), pa.array(n_bytes)], ["key", "n_bytes"])
                    continue
                docs = batch.column(0).slice(i, j - i).take(pa.array(order))
                null = np.asarray(docs.is_null())
                counts = np.diff(np.append(heads, len(order)))
                nulls = np.add.reduceat(null, heads, dtype=np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts - nulls))).astype(np.int32)),
                                                 docs.filter(pa.array(~null)).cast(pa.int64()))
                sent = bitmap[map_place(key[lead], n_bytes)]
                at = np.concatenate(([0], np.cumsum(np.where(sent, n_bytes, 0)))).astype(np.int32)
                text = part[slices(start[lead][sent], n_bytes[sent])]
                valid = pa.py_buffer(np.packbits(sent, bitorder="little"))
                sha = [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(start[lead].tolist(), end[lead].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array((np.searchsorted(starts, key[lead], side="right") - 1).astype(np.int32)), pa.array(key[lead]),
                     pa.array(n_bytes), pa.array(((deal + np.arange(len(lead))) & 0x7FFFFFFF).astype(np.int32)), lists,
                     pa.array(nulls), pa.BinaryArray.from_buffers(pa.binary(), len(lead), [
                         valid, pa.py_buffer(at), pa.py_buffer(text)]), pa.array(sha)],
                    [c.split()[0] for c in ENTRIES.split(", ")])
                deal += len(lead)
    return run


def _equal(raw: bytes, key, start, end):
    """(order, heads): rows ordered so that equal texts adjoin, and where each distinct text begins."""
    order = np.lexsort((end - start, key))
    k, n = key[order], (end - start)[order]
    new = np.ones(len(order), bool)
    new[1:] = (k[1:] != k[:-1]) | (n[1:] != n[:-1])
    runs = np.flatnonzero(new)
    for a, b in zip(runs.tolist(), np.append(runs[1:], len(order)).tolist()):
        if b - a > 1:                                                 # one key: chain by bytes
            chain: dict[bytes, list[int]] = {}
            for r in order[a:b].tolist():
                chain.setdefault(raw[start[r]:end[r]], []).append(r)
            at = a
            for rows in chain.values():
                order[at:at + len(rows)] = rows
                new[at:at + len(rows)] = [True] + [False] * (len(rows) - 1)
                at += len(rows)
    return order, np.flatnonzero(new)


class Directory:
    """Buckets of an extendible hash: prefixes of the hash, each with its local depth.

    A directory of ``2 ** depth`` slots points all slots of one prefix at one
    bucket; kept here are the buckets, whose first keys in order do the same."""

    def __init__(self, depth: int):
        self.depth = depth
        self.buckets = [(p, depth) for p in range(1 << depth)]

    def starts(self) -> np.ndarray:
        """First key of every bucket, ascending."""
        return np.array([(p << (64 - d)) - (1 << 63) for p, d in self.buckets], np.int64)

    def split(self, numbers: set[int]) -> None:
        """Split buckets by one more bit; the directory doubles where that exceeds its depth."""
        parts = [[(2 * p, d + 1), (2 * p + 1, d + 1)] if i in numbers else [(p, d)] for i, (p, d) in enumerate(self.buckets)]
        self.buckets = [b for part in parts for b in part]
        self.depth = max(d for _, d in self.buckets)


def place(directory: Directory):
    """Adds the number of the bucket that holds each key."""
    starts = directory.starts()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.searchsorted(starts, b.column(0).to_numpy(zero_copy_only=False), side="right") - 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at.astype(np.int32))], [*b.schema.names, "bucket"])
    return run


def build_index(keys: DataFrame, capacity: int) -> tuple[Directory, DataFrame]:
    """Directory and index (key, n_bytes, entries) of the entries' ``keys``.

    Each round writes one file per bucket for the keys of new buckets and
    counts them; a bucket within ``capacity`` keeps its file, the others are
    split.  What comes to the driver is one count per bucket.  Keys that agree
    in all bits stay in one bucket, however full.
    """
    spark = keys.sparkSession
    schema = "key long, n_bytes long, entries long, bucket int"
    new = stage(keys.groupBy("key", "n_bytes").agg(F.count("*").alias("entries")), "keys")
    n = new.count()
    capacity = max(capacity, math.ceil(n / MAX_BUCKETS))
    directory = Directory(max(0, math.ceil(math.log2(max(1, n / capacity))) - 1))
    kept = []
    while True:
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/flowaudit-llm/index-{uuid.uuid4().hex}"
        new.mapInArrow(place(directory), schema).repartition("bucket").write.partitionBy("bucket").parquet(path)
        files = spark.read.schema(schema).parquet(path) if not new.isEmpty() else new.withColumn("bucket", F.lit(0))
        sizes = files.groupBy("bucket").agg(F.count("*").alias("n"), (F.min("key") < F.max("key")).alias("more")).collect()
        full = {r["bucket"] for r in sizes if r["n"] > capacity and r["more"] and directory.buckets[r["bucket"]][1] < 63}
        kept.append(files.where(~F.col("bucket").isin(list(full))) if full else files)
        if not full:
            break
        new = files.where(F.col("bucket").isin(list(full))).drop("bucket")
        directory.split(full)
    index = kept[0].drop("bucket")
    for d in kept[1:]:
        index = index.unionAll(d.drop("bucket"))
    return directory, index


def multiple(index: DataFrame) -> np.ndarray:
    """Bitmap of the keys with several entries; at most ``2 ** MAP_BITS / 8`` bytes come to the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = map_place(*(b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)))
            yield pa.RecordBatch.from_arrays([pa.array(at >> 3), pa.array(1 << (at & 7))], ["byte", "bit"])

    marks = index.where("entries > 1").select("key", "n_bytes").mapInArrow(run, "byte long, bit long")
    got = marks.groupBy("byte").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (MAP_BITS - 3), np.uint8)
    out[got["byte"].to_numpy()] = got["bits"].to_numpy()
    return np.unpackbits(out, bitorder="little").astype(bool)


def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``link`` to entries sorted by (key, n_bytes, page): the place of the text in its key's chain,
    in order of first sight, and ``first``: whether it was seen first.  Memory: the distinct texts of one key."""
    last, texts = None, {}
    for b in batches:
        names = b.schema.names
        keys = zip(*(b.column(names.index(c)).to_pylist() for c in ("key", "n_bytes", "page")))
        text = b.column(names.index("text"))
        link, first = [], []
        for i, k in enumerate(keys):
            if k != last:
                last, texts = k, {}
            t = text[i].as_py()
            first.append(t not in texts)
            link.append(texts.setdefault(t, len(texts)))
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(link, pa.int32()), pa.array(first, pa.bool_())],
                                         [*names, "link", "first"])


def chained(entries: DataFrame) -> DataFrame:
    by = ["bucket", "key", "n_bytes", "page"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in entries.schema.fields) + ", link int, first boolean"
    return entries.repartition("bucket", "page").sortWithinPartitions(*by).mapInArrow(chain, schema)


def duplicates(docs: DataFrame, capacity: int = 2_000, page: int = 256, bits: int = 64) -> DataFrame:
    """Groups of equal texts of ``docs`` (doc_id, text), equal when identical after lower-casing A-Z.

    Returns per row doc_id, keep_id (the largest doc_id of its group),
    group_size, kept (one row of the group, one with keep_id) and text_sha256
    of the lower-cased text.  A null text counts as empty.  Rows without
    doc_id belong to groups too but are kept only where no row has an id.
    Repeated rows count one by one, and one of them is kept.  Texts of any
    length are compared whole.  An empty table gives an empty result; other
    columns are ignored.  ``capacity`` is the number of keys of a bucket,
    ``page`` the number of entries of one key that one task compares, ``bits``
    the length of the hash.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    directory, index = build_index(texts.mapInArrow(fold(bits), KEYS), capacity)
    total = index.agg(F.sum("entries")).first()[0] or 0
    page = max(page, total // 10_000)                     # hence at most 10,000 keys have several pages
    hot = index.where(F.col("entries") > page).select(
        "key", "n_bytes", F.ceil(F.col("entries") / F.lit(page)).cast("int").alias("pages"))
    entries = texts.mapInArrow(fold(bits, directory, multiple(index)), ENTRIES) \
        .join(F.broadcast(hot), ["key", "n_bytes"], "left") \
        .withColumn("page", F.when(F.col("pages").isNull(), F.lit(0)).otherwise(F.col("deal") % F.col("pages"))) \
        .withColumn("paged", F.col("pages").isNotNull()).drop("pages", "deal")
    alone = entries.where("text IS NULL").withColumn("link", F.lit(0)).withColumn("first", F.lit(True))
    several = chained(entries.where("text IS NOT NULL")).withColumn("text", F.expr("IF(first AND paged, text, NULL)"))
    found = stage(alone.unionByName(several).withColumn("tag", F.monotonically_increasing_id()), "chains")
    # the first texts of the pages of a key meet in one chain
    again = stage(chained(found.where("first AND paged").select(
        "bucket", "key", "n_bytes", F.lit(0).alias("page"), "text", F.struct("page", "link").alias("seen"))).select(
        "key", "n_bytes", "seen.page", F.col("seen.link").alias("was"), "link"), "pages")
    same = ["key", "n_bytes", "page", "was"]
    linked = found.where("NOT paged").select("key", "n_bytes", "link", "ids", "nulls", "sha", "tag").unionByName(
        found.where("paged").withColumnRenamed("link", "was").drop("text").join(again, same)
        .select("key", "n_bytes", "link", "ids", "nulls", "sha", "tag"))
    group = ["key", "n_bytes", "link"]
    whole = linked.groupBy(*group).agg(
        F.sum(F.size("ids") + F.col("nulls")).alias("group_size"),
        F.max(F.struct(F.array_max("ids").alias("id"), F.col("tag"))).alias("best"))
    rows = linked.join(whole, group).withColumn("rows", F.concat("ids", F.array_repeat(F.lit(None).cast("long"), F.col("nulls").cast("int"))))
    stays = F.coalesce(F.array_position("ids", F.col("best.id")), F.lit(1)) - 1
    return rows.select(F.posexplode("rows").alias("pos", "doc_id"), F.col("best.id").alias("keep_id"),
                       F.col("group_size").cast("long").alias("group_size"),
                       ((F.col("tag") == F.col("best.tag"))).alias("here"), stays.alias("stays"), F.col("sha").alias("text_sha256")) \
        .select("doc_id", "keep_id", "group_size", (F.col("here") & (F.col("pos") == F.col("stays"))).alias("kept"), "text_sha256")


def duplicates_sql(table: str = "documents") -> str:
    """DuckDB twin of :func:`duplicates`."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH norm AS (SELECT doc_id, translate(coalesce(text, ''), '{upper}', '{lower}') AS t FROM {table})
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM norm WINDOW g AS (PARTITION BY t)"""
