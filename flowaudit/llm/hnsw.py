"""Operator 10: nearest neighbours by inner product, with one small-world graph per shard.

Equal vectors are one node of the graph.  Vectors get one more component,
sqrt(R^2 - |x|^2) with R the shard's largest norm, so that all have the same
length and the inner product with a query (whose extra component is 0) is
unchanged; the graph is built on these.  A shard holds vectors of one norm band
(a factor of 16) only and is scaled to components up to 1: beside a much longer
vector, R^2 would swallow all differences between the others in float32.

Nodes are numbered by falling level: layer l of a shard is the nodes below
``sizes[l]``, and its links are one flat array of ``sizes[l]`` x degree node
numbers (-1: none).  Nodes are inserted in batches that at most double the
graph; searches, neighbour selection and pruning run for a whole batch in
numpy.  The index is a table with one row per shard; blocks of queries meet
every shard, and the shards' results are merged by score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import stage
from .textops import U64, mix64

DEGREE, EF_BUILD, EF_SEARCH = 16, 64, 192
SHARD_ROWS, QUERY_BLOCK = 8192, 2048
BATCH, STEP = 256, 4
#: Binary digits of a norm band; the bands are [1/4, 4), [4, 64) and so on.
BAND = 4


def beam(vectors, links, queries, entry, ef: int):
    """Best-first search of one layer for all queries at once: (ids, similarities), unordered, -1 where none."""
    n, width = len(queries), links.shape[1]
    seen = np.zeros((n, len(links)), bool)
    ids = np.full((n, ef), -1, np.int64)
    sims = np.full((n, ef), -np.inf, np.float32)
    done = np.zeros((n, ef), bool)
    start = entry if entry.ndim == 2 else entry[:, None]
    take = min(ef, start.shape[1])
    ids[:, :take] = start[:, :take]
    sims[:, :take] = np.einsum("qed,qd->qe", vectors[ids[:, :take]], queries)
    np.put_along_axis(seen, ids[:, :take], True, axis=1)
    live = np.arange(n)
    step = min(STEP, ef)
    while len(live):
        open_ = np.where(done[live] | (ids[live] < 0), -np.inf, sims[live])
        best = np.argpartition(-open_, step - 1, axis=1)[:, :step] if step < ef else np.tile(np.arange(ef), (len(live), 1))
        usable = np.take_along_axis(open_, best, axis=1) > -np.inf
        going = usable.any(axis=1)
        live, best, usable = live[going], best[going], usable[going]
        if not len(live):
            break
        at = live[:, None]
        done[at, best] |= usable
        near = np.where(usable[:, :, None], links[ids[at, best]], -1).reshape(len(live), step * width)
        near.sort(axis=1)
        fresh = near >= 0
        fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
        fresh &= ~seen[at, near]
        seen[np.broadcast_to(at, near.shape)[fresh], near[fresh]] = True
        s = np.full(near.shape, -np.inf, np.float32)
        r, c = np.nonzero(fresh)
        s[r, c] = np.einsum("kd,kd->k", vectors[near[r, c]], queries[live[r]])
        all_ids = np.concatenate((ids[live], np.where(fresh, near, -1)), axis=1)
        all_sims = np.concatenate((sims[live], s), axis=1)
        all_done = np.concatenate((done[live], np.zeros(near.shape, bool)), axis=1)
        top = np.argpartition(-all_sims, ef - 1, axis=1)[:, :ef]
        ids[live] = np.take_along_axis(all_ids, top, axis=1)
        sims[live] = np.take_along_axis(all_sims, top, axis=1)
        done[live] = np.take_along_axis(all_done, top, axis=1)
    return ids, sims


def select(vectors, ids, sims, degree: int):
    """Up to ``degree`` diverse neighbours per row: a candidate nearer to a chosen one than to the row comes last."""
    order = np.argsort(-sims, axis=1, kind="stable")
    ids, sims = np.take_along_axis(ids, order, axis=1), np.take_along_axis(sims, order, axis=1)
    valid = (ids >= 0) & (sims > -np.inf)
    v = vectors[np.maximum(ids, 0)]
    between = v @ v.transpose(0, 2, 1)
    nearest = np.full(ids.shape, -np.inf, np.float32)
    chosen, count = np.zeros(ids.shape, bool), np.zeros(len(ids), np.int64)
    for c in range(ids.shape[1]):
        ok = valid[:, c] & (count < degree) & (nearest[:, c] < sims[:, c])
        chosen[:, c] = ok
        count += ok
        nearest[ok] = np.maximum(nearest[ok], between[ok, c])
    rank = np.where(chosen, 0, np.where(valid, 1, 2))            # then the passed-over, nearest first
    top = np.argsort(rank, axis=1, kind="stable")[:, :degree]
    out = np.where(np.take_along_axis(rank, top, axis=1) < 2, np.take_along_axis(ids, top, axis=1), -1)
    if out.shape[1] < degree:
        out = np.pad(out, ((0, 0), (0, degree - out.shape[1])), constant_values=-1)
    return out


def _link_back(vectors, links, who, to):
    """Adds ``to -> who`` links; a node with too many keeps a diverse selection."""
    ok = to >= 0
    who, to = np.broadcast_to(who[:, None], to.shape)[ok], to[ok]
    order = np.argsort(to, kind="stable")
    who, to = who[order], to[order]
    heads = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1]))) if len(to) else np.zeros(0, np.int64)
    size = np.diff(np.append(heads, len(to)))
    rank = np.arange(len(to)) - np.repeat(heads, size)
    degree = links.shape[1]
    for r in range(0, int(rank.max()) + 1 if len(rank) else 0, DEGREE):
        now = (rank >= r) & (rank < r + DEGREE)
        nodes, row = np.unique(to[now], return_inverse=True)
        wide = np.full((len(nodes), degree + DEGREE), -1, np.int64)
        wide[:, :degree] = links[nodes]
        wide[row, degree + rank[now] - r] = who[now]
        sims = np.einsum("kwd,kd->kw", vectors[np.maximum(wide, 0)], vectors[nodes])
        sims[wide < 0] = -np.inf
        links[nodes] = select(vectors, wide, sims, degree)


def build(vectors: np.ndarray, degree: int = DEGREE, ef: int = EF_BUILD):
    """(order, layers): node numbering (by falling level) and links per layer, layer 0 first."""
    n = len(vectors)
    u = (mix64(np.arange(n, dtype=U64) + U64(0x51ED)) >> U64(11)).astype(np.float64) / 2 ** 53
    level = np.minimum((-np.log(np.maximum(u, 1e-12)) / np.log(degree)).astype(np.int64), 30)
    order = np.argsort(-level, kind="stable")
    v, level = np.ascontiguousarray(vectors[order], np.float32), level[order]
    layers = [np.full((int((level >= l).sum()), degree * (2 if l == 0 else 1)), -1, np.int64)
              for l in range(int(level.max()) + 1)] if n else []
    a = 1
    while a < n:
        b = min(n, a + min(BATCH, a))
        q = v[a:b]
        entry = np.zeros((b - a, 1), np.int64)
        for l in range(len(layers) - 1, -1, -1):
            inside = min(a, len(layers[l]))                    # nodes of the layer inserted so far
            linked = max(0, min(b, len(layers[l])) - a)        # the batch's nodes of this layer come first
            view = layers[l][:inside]
            if not linked:
                entry = beam(v, view, q, entry, 1)[0]
                continue
            ids, sims = beam(v, view, q, entry, ef)
            mates = q @ q[:linked].T
            mates[np.arange(linked), np.arange(linked)] = -np.inf
            cand = np.concatenate((ids[:linked], np.tile(np.arange(a, a + linked), (linked, 1))), axis=1)
            near = np.concatenate((sims[:linked], mates[:linked]), axis=1)
            keep = np.argpartition(-near, min(ef, near.shape[1]) - 1, axis=1)[:, :ef]
            to = select(v, np.take_along_axis(cand, keep, axis=1), np.take_along_axis(near, keep, axis=1), degree)
            layers[l][a:a + linked, :degree] = to
            _link_back(v, layers[l], np.arange(a, a + linked), to)
            best = np.argsort(-sims, axis=1)[:, :8]
            entry = np.take_along_axis(ids, best, axis=1)
            entry = np.where(entry < 0, ids.max(axis=1, keepdims=True), entry)
            entry = entry[:, :1] if l == 0 else entry[:, :1]
        a = b
    return order, layers


def search(v, layers, queries, ef: int):
    """Node numbers (row per query, -1 where none) of about the ``ef`` nearest."""
    entry = np.zeros((len(queries), 1), np.int64)
    for l in range(len(layers) - 1, 0, -1):
        entry = beam(v, layers[l], queries, entry, 1)[0]
    return beam(v, layers[0], queries, entry, min(ef, len(v)))[0]


def scaled(x: np.ndarray, axis=None) -> np.ndarray:
    """``x`` times the power of two that brings the largest component (of each row: axis 1) to [1/2, 1)."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=axis, keepdims=True))[1])


def _same_length(x: np.ndarray) -> np.ndarray:
    """The shard's vectors, scaled, with the component that makes their lengths equal."""
    x = scaled(x)
    norm = (x ** 2).sum(axis=1)
    return np.concatenate((x, np.sqrt(np.maximum(norm.max() - norm, 0))[:, None]), axis=1).astype(np.float32)


_INDEX = ("shard int, dim int, sizes array<int>, degrees array<int>, links binary, vectors binary, members array<long>, "
          "first array<int>")


def _build_shard(degree, ef):
    def run(t: pa.Table) -> pa.Table:
        ids = t.column("vec_id").to_numpy()
        x = t.column("v").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], np.ascontiguousarray(x[order])
        _, rep, which = np.unique(x.view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel(),
                                  return_index=True, return_inverse=True)
        distinct = x[rep]
        number, layers = build(_same_length(distinct), degree, ef)
        place = np.empty(len(number), np.int64)
        place[number] = np.arange(len(number))
        node = place[which]
        by = np.lexsort((ids, node))
        first = np.concatenate(([0], np.cumsum(np.bincount(node, minlength=len(number)))))
        row = {"shard": t.column("shard")[0].as_py(), "dim": x.shape[1], "sizes": [len(l) for l in layers],
               "degrees": [l.shape[1] for l in layers],
               "links": b"".join(l.astype("<i4").tobytes() for l in layers),
               "vectors": distinct[number].astype("<f8").tobytes(), "members": ids[by].tolist(), "first": first.tolist()}
        return pa.Table.from_pylist([row], schema=pa.schema([
            ("shard", pa.int32()), ("dim", pa.int32()), ("sizes", pa.list_(pa.int32())), ("degrees", pa.list_(pa.int32())),
            ("links", pa.binary()), ("vectors", pa.binary()), ("members", pa.list_(pa.int64())),
            ("first", pa.list_(pa.int32()))]))
    return run


def _search_shard(k, ef):
    def run(index: pa.Table, queries: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not index.num_rows or not queries.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                             "score": pa.array([], pa.float64())})
        r = index.to_pylist()[0]
        x = np.frombuffer(r["vectors"], "<f8").reshape(-1, r["dim"])
        v = _same_length(x)
        layers, at = [], 0
        raw = np.frombuffer(r["links"], "<i4").astype(np.int64)
        for n, d in zip(r["sizes"], r["degrees"]):
            layers.append(raw[at:at + n * d].reshape(n, d))
            at += n * d
        members, first = np.array(r["members"]), np.array(r["first"])
        qid = queries.column("vec_id").to_numpy()
        q = queries.column("v").combine_chunks().flatten().to_numpy().reshape(len(qid), -1)
        out = []
        for a in range(0, len(qid), 512):
            own, y = qid[a:a + 512], q[a:a + 512]
            got = search(v, layers, np.pad(scaled(y, 1), ((0, 0), (0, 1))).astype(np.float32), ef)
            exact = np.where(got >= 0, np.einsum("qed,qd->qe", x[np.maximum(got, 0)], y), -np.inf)
            row, col = np.nonzero(got >= 0)
            node, score = got[row, col], exact[row, col]
            size = first[node + 1] - first[node]
            start = np.cumsum(size) - size
            pick = np.arange(int(size.sum())) + np.repeat(first[node] - start, size)
            row, score, ids = np.repeat(row, size), np.repeat(score, size), members[pick]
            other = ids != own[row]
            row, score, ids = row[other], score[other], ids[other]
            order = np.lexsort((ids, -score, row))
            row, score, ids = row[order], score[order], ids[order]
            head = np.searchsorted(row, np.arange(len(own)))
            best = np.arange(len(row)) - head[row] < k
            out.append((own[row[best]], ids[best], score[best]))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*out)], names=names)
    return run


def usable_vectors(rows: DataFrame) -> DataFrame:
    """vec_id, v (doubles): the distinct rows that take part; a vec_id may have several vectors.

    Left out: null ids, vectors that are null, empty, zero, or hold null or
    non-finite components, and those whose length is not the most common one
    (the larger of two equally common)."""
    v = F.col("embedding").cast("array<double>")
    ok = rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")) \
        .where("vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0") \
        .where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))) \
        .where(F.exists("v", lambda x: x != 0))
    length = ok.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c")).agg(F.max_by("n", F.struct("c", "n"))).first()[0]
    return ok.where(F.size("v") == (length or 0)).distinct()


def _band(v):
    """Number of the norm band of a vector column; squares are taken of components up to 1."""
    top = F.array_max(F.transform(v, lambda x: F.abs(x)))
    squares = F.aggregate(v, F.lit(0.0), lambda a, x: a + (x / top) * (x / top))
    return F.floor((F.log2(top) + F.log2(squares) / 2 + BAND / 2) / BAND).cast("int")


def build_index(vectors: DataFrame, k: int, shard_rows: int = SHARD_ROWS, degree: int = DEGREE, ef: int = EF_BUILD):
    """One row per shard, of one norm band each.  Of equal vectors the ``k + 1`` least ids are kept: no more can be in a result."""
    few = vectors.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("r") <= k + 1)
    few = stage(few.select("vec_id", "v", _band(F.col("v")).alias("band")), "vectors")
    shards, deal = 0, []
    for r in few.groupBy("band").count().orderBy("band").collect():         # doubles have 525 bands
        n = -(-r["count"] // shard_rows)
        deal += [F.lit(r["band"]), F.struct(F.lit(shards).alias("first"), F.lit(n).alias("n"))]
        shards += n
    at = F.create_map(*deal)[F.col("band")] if deal else F.struct(F.lit(0).alias("first"), F.lit(1).alias("n"))
    dealt = few.withColumn("at", at).select(
        "vec_id", "v", (F.col("at.first") + F.pmod(F.xxhash64("v"), F.col("at.n"))).cast("int").alias("shard"))
    shards = max(1, shards)
    return stage(dealt.groupBy("shard").applyInArrow(_build_shard(degree, ef), _INDEX), "index"), shards


def nearest(rows: DataFrame, k: int = 20, is_query=None, shard_rows: int = SHARD_ROWS, degree: int = DEGREE,
            ef_build: int = EF_BUILD, ef: int = EF_SEARCH, block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` largest inner products found for each query.

    ``rows``: vec_id, embedding; queries are the rows for which ``is_query``
    (a condition on vec_id; default: ids divisible by 20) holds, candidates
    every row of another vec_id, each distinct vector of an id for itself; an id
    with several vectors asks once, with the least.  Equal scores are ranked by vec_id.  Scores are exact, in
    double precision; which neighbours are found is approximate (``ef``).  For
    the rows that take part see :func:`usable_vectors`; a query without
    candidates gives no rows, nor does an empty table.
    """
    vectors = stage(usable_vectors(rows), "usable")
    index, shards = build_index(vectors, k, shard_rows, degree, ef_build)
    asks = vectors.where(F.col("vec_id") % 20 == 0 if is_query is None else is_query(F.col("vec_id"))) \
        .groupBy("vec_id").agg(F.min("v").alias("v"))
    blocks = max(1, -(-asks.count() // block))
    asks = asks.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")) \
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    index = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = index.groupBy("shard", "block").cogroup(asks.groupBy("shard", "block")) \
        .applyInArrow(_search_shard(k, ef), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
