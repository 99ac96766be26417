"""Random forests whose trees end where their rows meet (M3).

Rows are binned once (at most ``BINS`` bins a feature) and kept as blocks.  A
row's weight in a tree is a Poisson draw from (seed, block, tree), so any task
draws it again.  Trees grow in two phases:

* nodes of more than ``LOCAL`` rows are split level by level: tasks add up class
  weights by (tree, node, feature, bin), the best split is chosen where a node's
  sums meet, and the driver gets one short row per such node;
* the rows of every smaller node are dealt to one task, which grows the rest of
  the tree below it (a *piece*), all its nodes of a level at once.

A node draws the square root of the features (rounded up), splits by Gini impurity
until it is pure, nothing is gained or the depth is reached, and siblings that are
leaves of one prediction become one leaf, as in Spark's forest.

The driver holds the tops of the trees only, a number of nodes in proportion to
rows / ``LOCAL``; pieces stay a table.  To score, rows go down the tops, meet
their pieces, and the leaves' class shares are averaged by block of rows.
"""

from __future__ import annotations

import base64
import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.labels import MAX_CLASSES
from ..session import cut_lineage
from .boosting import BLOCK_ROWS, NOISE, PART_BLOCKS

#: Bins of a feature, rows of a node that one task finishes, and rows that one task scores with a piece.
BINS, LOCAL, SHARE = 32, 262_144, 1_000_000
#: Scored rows of a block: 2 ** SCORED of consecutive row numbers.
SCORED = 13

STATE = "block long, n long, bins binary, y binary, w binary"
PIECE = "tree int, node int, feature binary, cut binary, link binary, shares binary"
GROWN = f"{PIECE}, root binary, gains binary"
SPLIT = "tree int, node int, feature int, bin int, gain double, n long, n_left long, total binary, lower binary"


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
    names = [f.split() for f in ddl.split(", ")]
    cols = zip(*rows) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(cols, names)], [n for n, _ in names])


def _bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """(features, rows) bins of (features, rows) values; missing values come last."""
    return np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x)]).astype(np.uint8) if len(x) \
        else np.zeros((0, x.shape[1]), np.uint8)


def bin_edges(rows: DataFrame, names: list[str], n_bins: int = BINS) -> list[np.ndarray]:
    """At most ``n_bins - 1`` borders per feature: the middles between all its values if there are at most
    ``n_bins``, else approximate quantiles of its finite values."""
    def few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0)] * len(names)
        for b in batches:
            for i in range(len(names)):
                if len(held[i]) <= n_bins:
                    x = b.column(i).to_numpy(zero_copy_only=False)
                    held[i] = np.unique(np.append(held[i], x[~np.isnan(x)]))[:n_bins + 1]
        yield _batch([(i, h.tobytes()) for i, h in enumerate(held)], "i int, found binary")
    found = [np.zeros(0)] * len(names)
    for r in rows.select(*names).mapInArrow(few, "i int, found binary").collect():      # n_bins + 1 values per task and feature
        found[r[0]] = np.unique(np.append(found[r[0]], np.frombuffer(r[1])))
    many = [n for n, f in zip(names, found) if len(f) > n_bins]
    probs = [i / n_bins for i in range(1, n_bins)]
    row = rows.select(*[F.percentile_approx(F.when(F.abs(F.col(n)) < float("inf"), F.col(n)), probs, 10_000).alias(n)
                        for n in many]).first() if many else {}
    with np.errstate(invalid="ignore"):
        return [np.unique(np.array(row[n] if row[n] is not None else [], float)) if n in many else
                np.where(np.isfinite(m := (f[:-1] + f[1:]) / 2), m, f[:-1]) for n, f in zip(names, found)]


def _draws(seed: int, block: int, tree: int, w: np.ndarray, bootstrap: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a block that a tree has, and their weights in it."""
    if not bootstrap:
        return np.flatnonzero(w > 0), w[w > 0]
    times = np.random.default_rng([seed, block, tree]).poisson(1.0, len(w)) * w
    rows = np.flatnonzero(times > 0)
    return rows, times[rows]


def _subsets(rng, m: int, p: int, k: int) -> np.ndarray:
    """(m, k) features, ascending, drawn for m nodes."""
    if k >= p:
        return np.tile(np.arange(p), (m, 1))
    return np.sort(np.argpartition(rng.random((m, p)), k - 1, axis=1)[:, :k], axis=1)


def _squares(s: np.ndarray) -> np.ndarray:
    """Sum of squared class weights by their total, over the last axis; 0 where there are none."""
    total = s.sum(axis=-1)
    return np.einsum("...k,...k->...", s, s) / np.where(total > 0, total, 1.0)


# ---- a piece: all that is below one node, in one task -------------------------

def _candidates(node: np.ndarray, bins: np.ndarray, y: np.ndarray, w: np.ndarray, counts: np.ndarray):
    """(score, bin, class weights up to it) of each node's best cut of one feature; score -inf where there is none."""
    m, k = counts.shape
    key = node * BINS + bins
    if m * BINS <= 4 * len(node):                                        # nodes of many rows: all cells
        left = np.bincount(key * k + y, w, m * BINS * k).reshape(m, BINS, k).cumsum(axis=1)[:, :-1]
        right = counts[:, None, :] - left
        score = np.where((left.sum(axis=2) > 0) & (right.sum(axis=2) > NOISE * counts.sum(axis=1)[:, None]),
                         _squares(left) + _squares(right), -np.inf)
        at = score.argmax(axis=1)
        own = np.arange(m)
        return score[own, at], at, left[own, at]
    order = np.argsort(key, kind="stable")
    key, sums = key[order], np.zeros((len(order) + 1, k))
    sums[np.arange(1, len(order) + 1), y[order]] = w[order]
    np.cumsum(sums, axis=0, out=sums)
    node = key // BINS
    last = np.flatnonzero((key[:-1] != key[1:]) & (node[:-1] == node[1:]))    # ends of bins but the last of their node
    best, at, low = np.full(m, -np.inf), np.zeros(m, np.int64), np.zeros((m, k))
    if len(last):
        of = node[last]
        left = sums[last + 1] - sums[np.searchsorted(node, np.arange(m))[of]]
        score = _squares(left) + _squares(np.maximum(counts[of] - left, 0.0))
        starts = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        top = np.maximum.reduceat(score, starts)
        hit = np.flatnonzero(score == np.repeat(top, np.diff(np.append(starts, len(of)))))
        nodes, first = np.unique(of[hit], return_index=True)
        hit = hit[first]
        best[nodes], at[nodes], low[nodes] = score[hit], key[last[hit]] % BINS, left[hit]
    return best, at, low


def grow_piece(bins: np.ndarray, y: np.ndarray, w: np.ndarray, k: int, depth: int, n_try: int, rng) -> dict:
    """The tree of at most ``depth`` levels of splits below one node; ``bins`` is (features, rows).

    Flat arrays: ``feature`` (-1: leaf), ``cut`` (bins up to it go to the child ``link``,
    others to the next one), ``counts`` by class, ``gain``, ``level`` (start of each level)."""
    p, n = bins.shape
    flat = bins.ravel()
    rows, node = np.arange(n), np.zeros(n, np.int64)
    counts = np.bincount(y, w, k)[None, :]
    parts, level, base = [], [0], 0
    for d in range(depth + 1):
        m = len(counts)
        feature, cut, link, gain = np.full(m, -1, np.int16), np.zeros(m, np.uint8), np.zeros(m, np.int32), np.zeros(m)
        total = counts.sum(axis=1)
        is_open = (counts.max(axis=1) < total) & (d < depth)
        parts.append((feature, cut, link, counts, gain))
        level.append(base + m)
        if not is_open.any():
            break
        opened = np.flatnonzero(is_open)
        number = np.cumsum(is_open) - 1
        mine = np.flatnonzero(is_open[node])
        rows, node = rows[mine], number[node[mine]]
        yr, wr, here = y[rows], w[rows], counts[opened]
        tried = _subsets(rng, len(opened), p, n_try)
        best, low = np.full(len(opened), -np.inf), np.zeros(here.shape)
        pick, at = np.zeros(len(opened), np.int64), np.zeros(len(opened), np.int64)
        for j in range(tried.shape[1]):
            score, b, left = _candidates(node, flat[tried[node, j] * n + rows].astype(np.int64), yr, wr, here)
            up = score > best
            best[up], pick[up], at[up], low[up] = score[up], tried[up, j], b[up], left[up]
        won = best - _squares(here)
        split = won > NOISE * np.maximum(1.0, total[opened])
        if not split.any():
            break
        into = np.flatnonzero(split)
        where = opened[into]
        feature[where], cut[where], gain[where] = pick[into], at[into], won[into]
        link[where] = base + m + 2 * np.arange(len(into))
        mine = np.flatnonzero(split[node])
        rows, node = rows[mine], node[mine]
        node = 2 * (np.cumsum(split) - 1)[node] + (flat[pick[node] * n + rows] > at[node])
        counts = np.empty((2 * len(into), k))
        counts[::2], counts[1::2] = low[into], np.maximum(here[into] - low[into], 0.0)
        base += m
    out = dict(zip(("feature", "cut", "link", "counts", "gain"), map(np.concatenate, zip(*parts))))
    return out | {"level": level}


def pruned(t: dict) -> dict:
    """The tree with siblings that are leaves of one prediction merged, nodes renumbered."""
    feature, link, said = t["feature"].copy(), t["link"], t["counts"].argmax(axis=1)
    for a, b in reversed(list(zip(t["level"], t["level"][1:]))):
        inner = a + np.flatnonzero(feature[a:b] >= 0)
        one, two = link[inner], link[inner] + 1
        feature[inner[(feature[one] < 0) & (feature[two] < 0) & (said[one] == said[two])]] = -1
    kept = np.zeros(len(feature), bool)
    kept[0] = True
    for a, b in zip(t["level"], t["level"][1:]):
        inner = a + np.flatnonzero((feature[a:b] >= 0) & kept[a:b])
        kept[link[inner]] = kept[link[inner] + 1] = True
    number = (np.cumsum(kept) - 1).astype(np.int32)
    return {"feature": feature[kept], "cut": t["cut"][kept], "link": np.where(feature >= 0, number[link], 0)[kept],
            "counts": t["counts"][kept], "gain": np.where(feature >= 0, t["gain"], 0.0)[kept]}


def _packed(tree: int, node: int, t: dict) -> tuple:
    """A row of the table of pieces: a leaf's ``link`` is its class if it is pure, else the number of classes
    plus its place in ``shares``."""
    leaf = t["feature"] < 0
    shares = t["counts"][leaf] / np.maximum(t["counts"][leaf].sum(axis=1, keepdims=True), 1e-300)
    mixed = shares.max(axis=1) < 1.0
    link = t["link"].astype(np.int32)
    link[leaf] = np.where(mixed, shares.shape[1] + np.cumsum(mixed) - 1, shares.argmax(axis=1))
    return (tree, node, t["feature"].astype(np.int16).tobytes(), t["cut"].astype(np.uint8).tobytes(), link.tobytes(),
            shares[mixed].tobytes())


def _finish(k: int, p: int, max_depth: int, n_try: int, seed: int, levels: dict):
    """Grows the piece of one (tree, node) from its rows; ``levels`` holds the depths of the tops' open nodes."""
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("block")
        tree, node = t.column("tree")[0].as_py(), t.column("node")[0].as_py()
        col = lambda c, kind: [np.frombuffer(b.as_buffer(), kind) for b in t.column(c)]                 # noqa: E731
        y, w = np.concatenate(col("y", np.int16)).astype(np.int64), np.concatenate(col("w", np.float64))
        bins = np.concatenate([b.reshape(p, -1) for b in col("bins", np.uint8)], axis=1)
        grown = pruned(grow_piece(bins, y, w, k, max_depth - levels[tree, node], n_try,
                                  np.random.default_rng([seed, tree, node])))
        inner = grown["feature"] >= 0
        gains = np.bincount(grown["feature"][inner], grown["gain"][inner], p)
        root = grown["counts"][0] if not inner[0] else np.zeros(0)
        return pa.Table.from_batches([_batch([(*_packed(tree, node, grown), root.tobytes(), gains.tobytes())], GROWN)])
    return run


# ---- the tops of the trees -----------------------------------------------------

class Top:
    """The first nodes of a tree: inner ones, leaves and nodes with a piece (``feature`` -1 for both)."""

    def __init__(self, n: int, k: int):
        self.feature, self.cut, self.link, self.level = [-1], [0], [0], [0]
        self.rows, self.counts, self.gain = [n], [[0.0] * k], [0.0]

    def grow(self, node: int, feature: int, cut: int, gain: float, sides) -> list[int]:
        self.feature[node], self.cut[node], self.link[node], self.gain[node] = feature, cut, len(self.feature), gain
        new = [len(self.feature), len(self.feature) + 1]
        for rows, counts in sides:
            for part, v in ((self.feature, -1), (self.cut, 0), (self.link, 0), (self.level, self.level[node] + 1),
                            (self.rows, rows), (self.counts, counts), (self.gain, 0.0)):
                part.append(v)
        return new

    def walk(self, bins: np.ndarray) -> np.ndarray:
        return _walk(np.array(self.feature, np.int16), np.array(self.cut, np.uint8), np.array(self.link, np.int32), bins)


def _walk(feature: np.ndarray, cut: np.ndarray, link: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """Leaf that each of the rows of ``bins`` (features, rows) reaches."""
    n = bins.shape[1]
    at, flat, rows = np.zeros(n, np.int64), bins.ravel(), np.arange(n)
    f = feature[at]
    while True:
        on = np.flatnonzero(f >= 0)
        if not len(on):
            break
        if len(on) < len(rows):
            rows, f = rows[on], f[on]
        node = at[rows]
        node = link[node] + (flat[f.astype(np.int64) * n + rows] > cut[node])
        at[rows] = node
        f = feature[node]
    return at


def _read(batches: Iterator[pa.RecordBatch], p: int):
    for b in batches:
        for i in range(b.num_rows):
            get = lambda c, t: np.frombuffer(b.column(c)[i].as_buffer(), t)                              # noqa: E731
            yield b.column(0)[i].as_py(), get(2, np.uint8).reshape(p, -1), get(3, np.int16).astype(np.int64), get(4, np.float64)


def _level(p: int, k: int, tops: list[Top], tried: list[dict], seed: int, bootstrap: bool):
    """A task's class weights (and rows, as one more class) by (tree, node, feature tried, bin)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for block, bins, y, w in _read(batches, p):
            for t, nodes in enumerate(tried):
                if not nodes:
                    continue
                rows, wr = _draws(seed, block, t, w, bootstrap)
                at = tops[t].walk(bins[:, rows])
                number = np.full(len(tops[t].feature), -1)
                number[list(nodes)] = np.arange(len(nodes))
                of = number[at]
                rows, wr, of = rows[of >= 0], wr[of >= 0], of[of >= 0]
                which = np.array(list(nodes.values()))
                if t not in held:
                    held[t] = np.zeros((len(nodes), which.shape[1], BINS, k + 1))
                for j in range(which.shape[1]):
                    cell = (of * BINS + bins[which[of, j], rows]) * (k + 1)
                    size = len(nodes) * BINS * (k + 1)
                    held[t][:, j] += (np.bincount(cell + y[rows], wr, size) + np.bincount(cell + k, minlength=size)).reshape(-1, BINS, k + 1)
        for t, sums in held.items():
            for node, s in zip(tried[t], sums):
                yield _batch([(t, node, s.tobytes())], "tree int, node int, sums binary")
    return run


def _choose(k: int, tried: list[dict]):
    """Adds up the sums of each (tree, node) and picks its split; feature -1 if nothing is gained."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            for t, node, raw in zip(*(c.to_pylist() for c in b.columns)):
                part = np.frombuffer(raw)
                held[t, node] = held[t, node] + part if (t, node) in held else part
        out = []
        for (t, node), s in sorted(held.items()):
            s = s.reshape(-1, BINS, k + 1)
            total, left = s[0].sum(axis=0), s.cumsum(axis=1)[:, :-1]
            right = total - left
            score = np.where((left[..., k] > 0) & (right[..., k] > 0), _squares(left[..., :k]) + _squares(right[..., :k]), -np.inf)
            j, at = np.unravel_index(score.argmax(), score.shape)
            gain = float(score[j, at] - _squares(total[:k]))
            feature = int(tried[t][node][j]) if gain > NOISE * max(1.0, total[:k].sum()) else -1
            out.append((t, node, feature, int(at), gain, int(total[k]), int(left[j, at, k]), total[:k].tobytes(), left[j, at, :k].tobytes()))
        yield _batch(out, SPLIT)
    return run


def _dealt(p: int, tops: list[Top], small: list[set], seed: int, bootstrap: bool):
    """The rows of every block by (tree, node to finish)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, bins, y, w in _read(batches, p):
            for t, top in enumerate(tops):
                rows, wr = _draws(seed, block, t, w, bootstrap)
                for node, mine in _by_node(top.walk(bins[:, rows])):
                    if node in small[t]:
                        r = rows[mine]
                        yield _batch([(t, node, block, bins[:, r].tobytes(), y[r].astype(np.int16).tobytes(), wr[mine].tobytes())],
                                     "tree int, node int, block long, bins binary, y binary, w binary")
    return run


def _by_node(at: np.ndarray):
    """(node, its rows in order) of the nodes that rows are at."""
    order = np.argsort(at, kind="stable")
    nodes, starts = np.unique(at[order], return_index=True)
    for node, a, b in zip(nodes.tolist(), starts, [*starts[1:], len(at)]):
        yield node, order[a:b]


def _blocks(edges: list[np.ndarray], block_rows: int):
    """Rows (features..., y, w) to numbered blocks of binned rows."""
    p = len(edges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, n = TaskContext.get().partitionId() << 32, [], 0

        def pack():
            cols = [c.to_numpy() for c in pa.Table.from_batches(held).columns]
            return _batch([(number, n, _bins(np.stack(cols[:p]) if p else np.zeros((0, n)), edges).tobytes(),
                            cols[p].astype(np.int16).tobytes(), cols[p + 1].astype(np.float64).tobytes())], STATE)
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= block_rows:
                yield pack()
                number, held, n = number + 1, [], 0
        if n:
            yield pack()
    return run


class Forest:
    """A fitted forest: borders of the bins, the tops of the trees, the table of pieces and the features' importances."""

    def __init__(self, features, classes, edges, tops, pieces: DataFrame, n_pieces: int, importances):
        self.features, self.classes, self.edges = list(features), list(classes), [np.asarray(e, float) for e in edges]
        self.tops, self.pieces, self.n_pieces, self.importances = tops, pieces, n_pieces, np.asarray(importances, float)

    def with_probs(self, df: DataFrame) -> DataFrame:
        """``df`` with ``probs``, the mean of the trees' class shares over ``classes``; its rows are written once."""
        k, trees = len(self.classes), len(self.tops)
        edges, tops = self.edges, self.tops
        names = [f"_x{i}" for i in range(len(edges))]
        x = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))).alias(n) for c, n in zip(self.features, names)]
        rows = cut_lineage(df.select(*[F.col(f"`{c}`") for c in df.columns], *x, F.monotonically_increasing_id().alias("_row")))

        def by_piece(batches: Iterator[pa.RecordBatch]):
            """(tree, node, block, places in the block, bins) of rows as they come, some batches at a time."""
            held, n = [], 0
            for b in batches:
                held.append(b)
                n += b.num_rows
                if n >= BLOCK_ROWS:
                    yield from walked(held)
                    held, n = [], 0
            if n:
                yield from walked(held)

        def walked(held):
            cols = [c.to_numpy() for c in pa.Table.from_batches(held).columns]
            bins = _bins(np.stack(cols[1:]) if names else np.zeros((0, len(cols[0]))), edges)
            for block, mine in _by_node(cols[0] >> SCORED):
                here, places = bins[:, mine], (cols[0][mine] & ((1 << SCORED) - 1)).astype(np.uint16)
                for t, top in enumerate(tops):
                    for node, r in _by_node(top.walk(here)):
                        yield t, node, block, places[r], here[:, r]

        asked = rows.select("_row", *names)
        # where a piece may have more rows than one task should score, they are dealt by share of the blocks
        shares: dict = {}
        if rows.count() > SHARE:
            def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                seen: dict = {}
                for t, node, _, places, _ in by_piece(batches):
                    seen[t, node] = seen.get((t, node), 0) + len(places)
                yield _batch([(*key, n) for key, n in seen.items()], "tree int, node int, n long")
            busy = asked.mapInArrow(counts, "tree int, node int, n long").groupBy("tree", "node").agg(F.sum("n").alias("n"))
            shares = {(r[0], r[1]): math.ceil(r[2] / SHARE) for r in busy.where(F.col("n") > SHARE).collect()}

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for t, node, block, places, bins in by_piece(batches):
                share = hash(block) % shares.get((t, node), 1)
                yield _batch([(t, node, share, block, places.tobytes(), bins.tobytes())], sent)
        sent = "tree int, node int, share int, block long, places binary, bins binary"
        here = self.pieces
        if shares:
            more = df.sparkSession.createDataFrame([(*key, n) for key, n in shares.items()], "tree int, node int, n int")
            here = here.join(F.broadcast(more), ["tree", "node"], "left")
            here = here.withColumn("share", F.explode(F.sequence(F.lit(0), F.coalesce("n", F.lit(1)) - 1))).drop("n")
        else:
            here = here.withColumn("share", F.lit(0))
        parts = max(1, min(self.n_pieces + sum(shares.values()), 4 * df.sparkSession.sparkContext.defaultParallelism))
        reached, key = "block long, tree int, node int, places binary, link binary, shares binary", ["tree", "node", "share"]

        def meet(asking: pa.Table, piece: pa.Table) -> pa.Table:
            out = []
            if asking.num_rows:
                get = lambda c, kind: np.frombuffer(piece.column(c)[0].as_buffer(), kind)                # noqa: E731
                feature, cut, link, mixed = get("feature", np.int16), get("cut", np.uint8), get("link", np.int32), \
                    get("shares", np.float64).reshape(-1, k)
                for a in asking.select(["tree", "node", "block", "places", "bins"]).to_batches():
                    for t, node, block, places, bins in zip(*(c.to_pylist() for c in a.columns)):
                        n = len(places) // 2
                        to = link[_walk(feature, cut, link, np.frombuffer(bins, np.uint8).reshape(-1, n) if names else np.zeros((0, n), np.uint8))]
                        some, at = np.unique(to, return_inverse=True)
                        there = mixed[some[some >= k] - k]
                        some = np.where(some < k, some, k + np.cumsum(some >= k) - 1)
                        out.append((block, t, node, places, some[at].astype(np.uint16).tobytes(), there.tobytes()))
            return pa.Table.from_batches([_batch(out, reached)])

        def average(t: pa.Table) -> pa.Table:
            t = t.sort_by([("tree", "ascending"), ("node", "ascending")])
            total, seen = np.zeros((1 << SCORED, k)), np.zeros(1 << SCORED, bool)
            eye = np.eye(k)
            for places, link, mixed in zip(*(t.column(c) for c in ("places", "link", "shares"))):
                at = np.frombuffer(places.as_buffer(), np.uint16)
                own = np.concatenate((eye, np.frombuffer(mixed.as_buffer()).reshape(-1, k)))
                total[at] += own[np.frombuffer(link.as_buffer(), np.uint16)]
                seen[at] = True
            at = np.flatnonzero(seen)
            flat = pa.array((total[at] / trees).ravel())
            probs = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * k), flat)
            return pa.table({"_row": pa.array((t.column("block")[0].as_py() << SCORED) + at), "probs": probs})
        met = asked.mapInArrow(deal, sent).repartition(parts, *key).groupBy(*key) \
            .cogroup(here.repartition(parts, *key).groupBy(*key)).applyInArrow(meet, reached)
        wide = df.sparkSession.sparkContext.defaultParallelism
        found = met.repartition(wide, "block").groupBy("block").applyInArrow(average, "_row long, probs array<double>")
        return rows.drop(*names).join(found, "_row").drop("_row")

    def about(self) -> dict:
        """All but the pieces, for JSON."""
        return {"features": self.features, "classes": self.classes, "edges": [e.tolist() for e in self.edges],
                "tops": [t.__dict__ for t in self.tops], "n_pieces": self.n_pieces, "importances": self.importances.tolist()}

    @staticmethod
    def from_about(d: dict, pieces: DataFrame) -> "Forest":
        tops = [Top(0, 0) for _ in d["tops"]]
        for t, known in zip(tops, d["tops"]):
            t.__dict__.update(known)
        return Forest(**d | {"tops": tops, "pieces": pieces})

    def to_json(self) -> str:
        """The whole model as text, for a stage of a ``PipelineModel``, which is one text: for models that fit the driver."""
        rows = [[v if isinstance(v, int) else base64.b64encode(v).decode() for v in r] for r in self.pieces.collect()]
        return json.dumps(self.about() | {"pieces": rows})

    @staticmethod
    def from_json(text: str) -> "Forest":
        d = json.loads(text)
        rows = [tuple(v if isinstance(v, int) else bytearray(base64.b64decode(v)) for v in r) for r in d["pieces"]]
        return Forest.from_about(d, SparkSession.active().createDataFrame(rows, PIECE))


def fit_forest(train: DataFrame, features, index_col: str, classes, weight_col: str | None = None, trees: int = 100,
               max_depth: int = 15, seed: int = 42, bootstrap: bool = True, block_rows: int = BLOCK_ROWS,
               local: int = LOCAL) -> Forest:
    """A forest of ``trees`` trees of at most ``max_depth`` levels of splits on ``train``.

    ``index_col`` holds the position of the label in ``classes``; ``weight_col`` weighs rows.  Training
    values must be finite, as Spark's forest asks; when scoring, missing ones go right at every split.  A single tree tries all features at every node."""
    features, k, p = list(features), len(classes), len(list(features))
    if k > MAX_CLASSES or p > 32_767:
        raise ValueError(f"{k} classes or {p} features are too many")
    w = F.lit(1.0) if weight_col is None else F.col(weight_col).cast("double")
    names = [f"x{i}" for i in range(p)]
    rows = train.select(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))).alias(n) for c, n in zip(features, names)],
                        F.col(index_col).cast("int").alias("y"), w.alias("w"))
    bad = F.col("y").isNull() | F.col("w").isNull() | (F.col("w") < 0)
    for c in names:
        bad = bad | F.isnan(c) | (F.abs(F.col(c)) == float("inf"))
    n, missing = rows.agg(F.count("*"), F.count(F.when(bad, 1))).first()
    if missing or not n:
        raise ValueError(f"{missing} of {n} training rows have no label, no weight of at least 0 or a value that is NaN or infinite")
    edges = bin_edges(rows, names)
    spark, n_try = train.sparkSession, p if trees == 1 else math.ceil(math.sqrt(p))
    cores, blocks = spark.sparkContext.defaultParallelism, -(-n // block_rows)
    # small tables are spread over the cores as well, for the draws and walks of all trees
    parts = max(1, min(max(blocks, n // 4096), cores * -(-blocks // (cores * PART_BLOCKS))))
    state = cut_lineage(rows.repartition(parts).mapInArrow(_blocks(edges, block_rows), STATE)).persist(StorageLevel.MEMORY_AND_DISK)
    tops = [Top(n, k) for _ in range(trees)]
    try:
        open_nodes = [[0] if n > local and max_depth else [] for _ in tops]
        done: list[set] = [set() for _ in tops]                           # leaves of the tops
        while any(open_nodes):
            tried = [{node: _subsets(np.random.default_rng([seed, t, node, 1]), 1, p, n_try)[0] for node in nodes}
                     for t, nodes in enumerate(open_nodes)]
            found = state.mapInArrow(_level(p, k, tops, tried, seed, bootstrap), "tree int, node int, sums binary") \
                .repartition("tree", "node").mapInArrow(_choose(k, tried), SPLIT).collect()
            open_nodes = [[] for _ in tops]
            for r in sorted(found):
                top, total, low = tops[r.tree], np.frombuffer(r.total), np.frombuffer(r.lower)
                top.counts[r.node], top.rows[r.node] = total.tolist(), r.n
                if r.feature < 0:
                    done[r.tree].add(r.node)
                    continue
                sides = [(r.n_left, low.tolist()), (r.n - r.n_left, (total - low).tolist())]
                for node in top.grow(r.node, r.feature, r.bin, r.gain, sides):
                    if max(top.counts[node]) >= sum(top.counts[node]) or top.level[node] >= max_depth:
                        done[r.tree].add(node)
                    elif top.rows[node] > local:
                        open_nodes[r.tree].append(node)
        small = [{i for i, f in enumerate(t.feature) if f < 0} - d for t, d in zip(tops, done)]
        levels = {(t, node): tops[t].level[node] for t, nodes in enumerate(small) for node in nodes}
        wide = max(1, min(len(levels), 4 * cores))
        grown = cut_lineage(state.mapInArrow(_dealt(p, tops, small, seed, bootstrap),
                                             "tree int, node int, block long, bins binary, y binary, w binary")
                            .repartition(wide, "tree", "node").groupBy("tree", "node")
                            .applyInArrow(_finish(k, p, max_depth, n_try, seed, levels), GROWN))
    finally:
        state.unpersist()
    gains = np.zeros((trees, p))
    for r in grown.select("tree", "node", "root", "gains").collect():     # one short row per piece
        gains[r.tree] += np.frombuffer(r.gains)
        if len(r.root):                                                    # the piece is one leaf
            tops[r.tree].counts[r.node] = np.frombuffer(r.root).tolist()
            done[r.tree].add(r.node)
            small[r.tree].discard(r.node)
    for t, top in enumerate(tops):
        for node in range(len(top.feature) - 1, -1, -1):                  # children come after their parents
            pair = {top.link[node], top.link[node] + 1}
            if top.feature[node] >= 0 and pair <= done[t] and len({int(np.argmax(top.counts[c])) for c in pair}) == 1:
                top.feature[node] = -1
                done[t].add(node)
        inner = [i for i, f in enumerate(top.feature) if f >= 0]
        np.add.at(gains[t], [top.feature[i] for i in inner], [top.gain[i] for i in inner])
        small[t] |= {0} if not inner and 0 not in done[t] else set()
    single = [(t, node) for t in range(trees) for node in sorted(done[t])]
    leaves = [_packed(t, node, {"feature": np.full(1, -1), "cut": np.zeros(1), "link": np.zeros(1),
                                "counts": np.array([tops[t].counts[node] or [0.0] * k])}) for t, node in single]
    pieces = grown.where(F.length("root") == 0).select("tree", "node", "feature", "cut", "link", "shares")
    if leaves:
        pieces = pieces.unionByName(spark.createDataFrame([tuple(bytearray(v) if isinstance(v, bytes) else v for v in r)
                                                           for r in leaves], PIECE))
    sums = gains.sum(axis=1, keepdims=True)
    shares = (gains / np.where(sums > 0, sums, 1.0)).sum(axis=0)
    return Forest(features, classes, edges, tops, pieces, max(1, len(levels)),
                  shares / shares.sum() if shares.sum() > 0 else shares)
