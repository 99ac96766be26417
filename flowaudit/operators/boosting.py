"""Multinomial gradient boosting on histograms (M4-M6): all classes in one pass per tree level.

The training rows are binned once (quantile edges) and kept as blocks: a byte
per feature, label, weight and the current raw score of every class.  A round
grows one tree per class (one tree in all for two classes) level by level:

* tasks send rows down the unfinished trees and add up gradients and Hessians
  per (class, node, feature, bin); a task emits one array per (class, node);
* those arrays are summed by (class, node) and the best split of each is chosen
  where they meet, so the driver gets one short row per open node;
* the first pass of a round adds the last round's trees to the blocks' scores and
  keeps the blocks so advanced for its other passes; every ``CUT`` rounds they are
  checkpointed, so the lineage stays bounded.

A table of a few million sums a level (``WHOLE``) is held by one task, which goes through all levels and
rounds by itself: the fit is one job, as a job per level would take longer than its sums.  Where the sums of
all tasks are small (``DRIVER_BYTES``), the driver adds them up, so a level is one stage.

Rows marked for validation take no part in the trees; their loss is summed in
the first pass of a round, and boosting stops after ``patience`` rounds without
a better one.  The fitted model is a list of flat trees: it scores in numpy
inside an Arrow-batched UDF.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.labels import MAX_CLASSES
from ..session import cut_lineage

#: Rows of a block, blocks of a partition that is not the only one of its core, and rounds between two checkpoints.
BLOCK_ROWS = 65_536
PART_BLOCKS = 32
CUT = 10
#: A model of at most so many rows, rows x trees of a round, and of those x features, is fitted by one task.
#: Its rows lie in blocks of so many times the usual size.
WHOLE_ROWS, WHOLE_SCORES, WHOLE, WIDE = 1 << 21, 1 << 23, 1 << 26, 4
#: Bytes of a level's sums, of all tasks, up to which the driver adds them up, and rows whose derivatives are taken at once.
DRIVER_BYTES, SLICE = 1 << 25, 8192
#: Ways of the bins of features that are summed together, and cells of such sums (of all open nodes).
JOINT, JOINT_CELLS = 8192, 1 << 16
#: Bin of missing values in :meth:`BoostedTrees.raw`, and the cut of a leaf: no bin lies above it.
TOP = 255
#: Rows scored at once, and rows explained at once; the most features of a leaf whose ways are tabled.
SCORED, EXPLAINED, TABLE = 8192, 32_768, 10
#: Share of a split's gain below which it is rounding noise.
NOISE = 1e-12

STATE = "n long, bins binary, y binary, w binary, val binary, raw binary"
PARTIAL = "cls int, node int, hist binary"
CHOSEN = "cls int, node int, feature int, bin int, gain double, gl double, hl double, gr double, hr double"


class Tree:
    """Flat binary tree: inner nodes send ``x <= threshold`` left, missing values right."""

    def __init__(self):
        self.feature, self.bin, self.threshold = [-1], [0], [0.0]
        self.left, self.right, self.value, self.cover, self.gain = [0], [0], [0.0], [0.0], [0.0]

    def grow(self, node: int, feature: int, at: int, threshold: float, gain: float) -> tuple[int, int]:
        self.feature[node], self.bin[node], self.threshold[node], self.gain[node] = feature, at, threshold, gain
        out = len(self.feature), len(self.feature) + 1
        self.left[node], self.right[node] = out
        for _ in out:
            for part, empty in ((self.feature, -1), (self.bin, 0), (self.threshold, 0.0), (self.left, 0), (self.right, 0),
                                (self.value, 0.0), (self.cover, 0.0), (self.gain, 0.0)):
                part.append(empty)
        return out

    def arrays(self) -> dict[str, np.ndarray]:
        return {k: np.array(v) for k, v in self.__dict__.items()}


def steps(tree: dict, cuts: np.ndarray) -> tuple:
    """(feature, cut, children, depth) of a flat tree for :func:`walk`; a leaf is its own children."""
    inner = tree["feature"] >= 0
    own = np.arange(len(inner))
    children = np.stack([np.where(inner, tree["left"], own), np.where(inner, tree["right"], own)], 1).astype(np.intp)
    level, depth = np.flatnonzero(inner[:1]), 0
    while len(level):
        level, depth = children[level].ravel(), depth + 1
        level = level[inner[level]]
    return np.where(inner, tree["feature"], 0).astype(np.intp), np.where(inner, cuts, TOP).astype(np.uint8), children.ravel(), depth


def walk(tree: tuple, bins: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Node that each row reaches after ``depth`` of the tree's :func:`steps` (all by default); ``bins`` is (features, rows)."""
    feature, cut, children, deepest = tree
    n = bins.shape[1]
    depth = deepest if depth is None else min(depth, deepest)
    if not depth:
        return np.zeros(n, np.intp)
    at = children.take((bins[feature[0]] > cut[0]).astype(np.intp))
    if depth > 1:
        flat, starts, rows = bins.reshape(-1), feature * n, np.arange(n)
        for _ in range(depth - 1):
            cell = starts.take(at)
            cell += rows
            down = flat.take(cell) > cut.take(at)
            at *= 2
            at += down
            at = children.take(at)
    return at


def gradients(raw: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the logistic loss per (row, tree): softmax, or one score for two classes."""
    g, h = derivatives(raw.T, y, w)
    return g.T, h.T


def _slopes(raw: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """:func:`derivatives` of a block, few rows at a time, so that the arrays in between stay in the processor's cache."""
    g, h = np.empty(raw.shape), np.empty(raw.shape)
    for at in range(0, len(y), SLICE):
        s = slice(at, at + SLICE)
        g[:, s], h[:, s] = derivatives(raw[:, s].astype(np.float64), y[s], w[s])
    return g, h


def derivatives(raw: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """:func:`gradients` of scores by (tree, row)."""
    p = shares(raw)
    if len(raw) == 1:
        g, h = p[1:] - y, p[1:] * p[:1]
    else:
        h = 1.0 - p
        h *= p
        h *= 2.0
        g = p
        g[y, np.arange(len(y))] -= 1.0
    np.maximum(h, 1e-16, out=h)
    g *= w
    h *= w
    return g, h


def probabilities(raw: np.ndarray) -> np.ndarray:
    """(rows, classes) of raw scores; one column means the log odds of the second class."""
    return shares(raw.T).T


def shares(raw: np.ndarray) -> np.ndarray:
    """:func:`probabilities` of scores by (tree, row)."""
    if len(raw) == 1:
        raw = np.concatenate((np.zeros_like(raw), raw))
    e = raw - raw.max(axis=0)
    np.exp(e, out=e)
    e /= e.sum(axis=0)
    return e


def _read(batch: pa.RecordBatch, i: int, p: int, k: int):
    get = lambda c, t: np.frombuffer(batch.column(batch.schema.get_field_index(c))[i].as_buffer(), t)     # noqa: E731
    n = batch.column(0)[i].as_py()
    return (get("bins", np.uint8).reshape(p, n), get("y", np.int16).astype(np.int64), get("w", np.float64),
            get("val", np.bool_), get("raw", np.float32).reshape(k, n))


def _pack(bins, y, w, val, raw) -> pa.RecordBatch:
    parts = [bins.tobytes(), y.astype(np.int16).tobytes(), w.tobytes(), val.tobytes(), raw.astype(np.float32).tobytes()]
    return pa.RecordBatch.from_arrays([pa.array([len(y)], pa.int64()), *[pa.array([b], pa.binary()) for b in parts]],
                                      ["n", "bins", "y", "w", "val", "raw"])


def _blocks(edges: list[np.ndarray], start: np.ndarray, block_rows: int, n_bins: int):
    """Rows (features..., y, w, val) to blocks of binned rows, (features, rows); bin ``n_bins`` holds
    missing values, and rows for validation come last."""
    p = len(edges)

    def pack(t: pa.Table):
        cols = [t.column(i).to_numpy() for i in range(p + 3)]
        val = cols[p + 2].astype(bool)
        order = np.argsort(val, kind="stable")
        bins = np.empty((p, t.num_rows), np.uint8)
        for i, e in enumerate(edges):
            x = cols[i][order]
            bins[i] = np.where(np.isnan(x), n_bins, np.searchsorted(e, x, side="left"))
        y, w = cols[p].astype(np.int64)[order], cols[p + 1].astype(np.float64)[order]
        return _pack(bins, y, w, val[order], np.tile(start[:, None], (1, t.num_rows)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= block_rows:
                yield pack(pa.Table.from_batches(held))
                held, n = [], 0
        if n:
            yield pack(pa.Table.from_batches(held))
    return run


def _unpacked(p: int, k: int, trees: list[dict] = ()):
    """Blocks of a stream of batches, their scores advanced by a round's ``trees``."""
    def run(batches: Iterator[pa.RecordBatch]):
        paths = [steps(t, t["bin"]) for t in trees]
        for b in batches:
            for i in range(b.num_rows):
                bins, y, w, val, raw = _read(b, i, p, k)
                if paths:
                    raw = raw.copy()
                    for c, path in enumerate(paths):
                        raw[c] += trees[c]["value"].astype(np.float32).take(walk(path, bins))
                yield bins, y, w, val, raw
    return run


def _advance(p: int, k: int, trees: list[dict]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _unpacked(p, k, trees)(batches):
            yield _pack(*block)
    return run


def _loss(raw: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Weighted loss of rows for validation, and their weight."""
    q = shares(raw.astype(np.float64))[y, np.arange(len(y))]
    return np.array([-(w * np.log(np.maximum(q, 1e-15))).sum(), w.sum()])


def _open_rows(nodes: list[int], of: np.ndarray, n_nodes: int, g: np.ndarray, h: np.ndarray):
    """(place of its node among the open ones, g, h, number) of the rows in open nodes; no numbers if that is all rows."""
    number = np.full(n_nodes, -1, np.intp)
    number[nodes] = np.arange(len(nodes))
    place = number.take(of)
    if not len(place) or place.min() >= 0:
        return place, g, h, None
    rows = np.flatnonzero(place >= 0)
    return place.take(rows), g.take(rows), h.take(rows), rows


def _add_up(held: np.ndarray, codes: np.ndarray, cells: int, place: np.ndarray, g: np.ndarray, h: np.ndarray, rows) -> None:
    """Adds derivatives to ``held``, (2, codes, open nodes x cells)."""
    first = place * cells
    cell = np.empty_like(first)
    for at, column in enumerate(codes):
        np.add(first, column[:len(first)] if rows is None else column.take(rows), out=cell)
        held[0, at] += np.bincount(cell, g, held.shape[2])
        held[1, at] += np.bincount(cell, h, held.shape[2])


class Together:
    """Features of few bins summed together: a cell holds the rows of one bin of each, and a feature's sums are
    those over the others, so that a row is added once for all of them."""

    def __init__(self, blocks: list[np.ndarray]):
        used = [1 + max(int(bins[f].max(initial=0)) for bins in blocks) for f in range(len(blocks[0]))]
        self.groups: list[tuple[list[int], list[int]]] = []
        for f in sorted(range(len(used)), key=lambda f: (used[f], f)):
            if not self.groups or math.prod(self.groups[-1][1]) * used[f] > JOINT:
                self.groups.append(([], []))
            self.groups[-1][0].append(f)
            self.groups[-1][1].append(used[f])
        self.codes = [[self._code(bins, *of) for bins in blocks] for of in self.groups]

    @staticmethod
    def _code(bins: np.ndarray, features: list[int], used: list[int]) -> np.ndarray:
        out = np.zeros((1, bins.shape[1]), np.uint16)
        for f, n in zip(features, used):
            out *= np.uint16(n)
            out += bins[f]
        return out

    def sums(self, bins: list[np.ndarray], opened, nodes: int, size: int) -> np.ndarray:
        """(2, features, nodes x size) sums of the blocks' :func:`_open_rows`."""
        held = np.zeros((2, len(bins[0]), nodes * size))
        for (features, used), codes in zip(self.groups, self.codes):
            cells = math.prod(used)
            if len(features) == 1 or nodes * cells > JOINT_CELLS:
                for block, rows in zip(bins, opened):
                    own = np.zeros((2, len(features), nodes * size))
                    _add_up(own, block[features], size, *rows)
                    held[:, features] += own
                continue
            joint = np.zeros((2, 1, nodes * cells))
            for code, rows in zip(codes, opened):
                _add_up(joint, code, cells, *rows)
            joint = joint.reshape(2, nodes, *used)
            for i, f in enumerate(features):
                others = tuple(2 + j for j in range(len(features)) if j != i)
                held[:, f].reshape(2, nodes, size)[:, :, :used[i]] = joint.sum(axis=others)
        return held


def _by_node(held: np.ndarray, nodes: list[int], size: int, depth: int):
    """(node, sums by (feature, bin)) of the open nodes that have rows."""
    for node, s in zip(nodes, held.reshape(2, held.shape[1], -1, size).transpose(2, 1, 3, 0)):
        if depth == 0 or s[0, :, 1].any():
            yield node, np.ascontiguousarray(s).ravel()


def level_sums(blocks, n_bins: int, trees: list[dict], open_nodes: list[list[int]], depth: int):
    """{(class, node): sums of gradients and Hessians by (feature, bin)} of the open nodes, and
    (validation loss, its weight), which is summed at depth 0 only."""
    held, loss, size = {}, np.zeros(2), n_bins + 1
    paths = [steps(t, t["bin"]) for t in trees]
    for bins, y, w, val, raw in blocks:
        n = len(y) - int(val.sum())                                      # rows for validation come last
        if depth == 0 and n < len(y):
            loss += _loss(raw[:, n:], y[n:], w[n:])
        g, h = _slopes(raw[:, :n], y[:n], w[:n])
        for c, nodes in enumerate(open_nodes):
            if not nodes:
                continue
            if c not in held:
                held[c] = np.zeros((2, len(bins), len(nodes) * size))
            _add_up(held[c], bins, size, *_open_rows(nodes, walk(paths[c], bins, depth)[:n], len(trees[c]["feature"]), g[c], h[c]))
    return {(c, node): s for c, part in held.items() for node, s in _by_node(part, open_nodes[c], size, depth)}, loss


def _partial(unpacked, n_bins: int, trees: list[dict], open_nodes: list[list[int]], depth: int):
    """A task's part of :func:`level_sums`, one row per (class, node); the loss under class -1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, loss = level_sums(unpacked(batches), n_bins, trees, open_nodes, depth)
        rows = [(c, node, s.tobytes()) for (c, node), s in sums.items()]
        if depth == 0:
            rows.append((-1, -1, loss.tobytes()))
        for at in range(0, len(rows), 256):
            cls, node, hist = zip(*rows[at:at + 256])
            yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int32()), pa.array(node, pa.int32()),
                                              pa.array(hist, pa.binary())], ["cls", "node", "hist"])
    return run


def split_level(trees: list[Tree], found: list[tuple], depth: int, edges, rate: float, reg: float,
                min_child: float) -> list[list[int]]:
    """Grow ``trees`` by the splits ``found`` (class, node, *best_split); the new open nodes of each tree.

    A node whose weight is not that of two children of ``min_child`` has no split, so its sums are not asked for."""
    open_nodes = [[] for _ in trees]
    for c, node, feature, at, gain, gl, hl, gr, hr in sorted(found):
        t = trees[c]
        if depth == 0:
            t.cover[0], t.value[0] = hl + hr, -rate * (gl + gr) / (hl + hr + reg)
        if feature < 0:
            continue
        cut = edges[feature][at] if at < len(edges[feature]) else np.inf
        for child, g, h in zip(t.grow(node, feature, at, float(cut), gain), (gl, gr), (hl, hr)):
            t.cover[child], t.value[child] = h, -rate * g / (h + reg)
            if h >= 2 * min_child * (1 - 1e-9):
                open_nodes[c].append(child)
    return open_nodes


def _boost(rounds: int, patience: int, validated: bool, grow, advance) -> tuple[list, list, int]:
    """(rounds of trees, losses before each round, best round): ``grow`` gives a round's loss and trees,
    ``advance`` adds trees to the scores."""
    kept, best, losses = [], (np.inf, 0), []
    for r in range(rounds + validated):
        loss, trees = grow()
        if loss[1] > 0:
            losses.append(float(loss[0] / loss[1]))
            best = min(best, (losses[-1], r))
            if r - best[1] >= patience:
                break
        if r == rounds or all(t["feature"][0] < 0 and t["value"][0] == 0.0 for t in trees):
            break
        kept.append(trees)
        if r + 1 == rounds and not validated:
            break
        advance(trees)
    return kept, losses, best[1]


def _down(tree: dict, bins: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Nodes one level below the nodes ``at`` of the rows; rows at leaves stay."""
    feature, cut, children, _ = steps(tree, tree["bin"])
    n = bins.shape[1]
    cell = (feature * n).take(at)
    cell += np.arange(n)
    down = bins.reshape(-1).take(cell) > cut.take(at)
    return children.take(2 * at + down)


def _whole_fit(pack, joint: bool, p: int, k: int, n_bins: int, edges, rounds: int, patience: int, validated: bool,
               max_depth: int, rate: float, reg: float, min_child: float):
    """All rounds over the rows of the only partition; each row of JSON is a round's trees, the last (losses, best round).

    Between levels a row's node is kept, and within a round the derivatives, which tasks that meet level by
    level work out anew; the sums are the same, but for their order where features are summed together (``joint``)."""
    size = n_bins + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = [(bins, y, w, len(y) - int(val.sum()), raw.copy())
                  for bins, y, w, val, raw in _unpacked(p, k)(pack(batches))]
        at: list = []
        columns = [bins for bins, *_ in blocks]
        together = Together(columns) if joint else None

        def grow():
            loss = sum((_loss(raw[:, n:], y[n:], w[n:]) for _, y, w, n, raw in blocks if n < len(y)), np.zeros(2))
            slopes = [_slopes(raw[:, :n], y[:n], w[:n]) for _, y, w, n, raw in blocks]
            at[:] = [[np.zeros(len(y), np.intp) for _, y, *_ in blocks] for _ in range(k)]
            trees, open_nodes = [Tree() for _ in range(k)], [[0] for _ in range(k)]
            for depth in range(max_depth):
                found = []
                for c, nodes in enumerate(open_nodes):
                    if not nodes:
                        continue
                    opened = [_open_rows(nodes, here[:n], len(trees[c].feature), g[c], h[c])
                              for (_, _, _, n, _), (g, h), here in zip(blocks, slopes, at[c])]
                    if together is None:
                        held = np.zeros((2, p, len(nodes) * size))
                        for bins, rows in zip(columns, opened):
                            _add_up(held, bins, size, *rows)
                    else:
                        held = together.sums(columns, opened, len(nodes), size)
                    found += [(c, node, *best_split(s.reshape(p, size, 2), reg, min_child))
                              for node, s in _by_node(held, nodes, size, depth)]
                open_nodes = split_level(trees, found, depth, edges, rate, reg, min_child)
                for c in {c for c, _, feature, *_ in found if feature >= 0}:
                    tree = trees[c].arrays()
                    at[c] = [_down(tree, bins, here) for (bins, *_), here in zip(blocks, at[c])]
                if not any(open_nodes):
                    break
            return loss, [t.arrays() for t in trees]

        def advance(trees):
            for c, t in enumerate(trees):
                value = t["value"].astype(np.float32)
                for (*_, raw), here in zip(blocks, at[c]):
                    raw[c] += value.take(here)
        kept, losses, best = _boost(rounds, patience, validated, grow, advance)
        for r in [*([{name: v.tolist() for name, v in t.items()} for t in trees] for trees in kept), [losses, best]]:
            yield pa.RecordBatch.from_arrays([pa.array([json.dumps(r)])], ["value"])
    return run


def best_split(hist: np.ndarray, reg: float, min_child: float) -> tuple:
    """(feature, bin, gain, GL, HL, GR, HR) of a (features, bins + 1, 2) histogram; feature -1 if no split helps.

    The last cell of a feature holds missing values, which go right.  The
    smallest (feature, bin) of equal gains is taken."""
    total = hist[0].sum(axis=0)
    left = np.cumsum(hist[:, :-1], axis=1)
    right = total - left
    score = lambda s: s[..., 0] ** 2 / (s[..., 1] + reg)                                             # noqa: E731
    gain = score(left) + score(right) - score(total)
    gain[(left[..., 1] < min_child) | (right[..., 1] < min_child)] = -np.inf
    at = np.unravel_index(np.argmax(gain), gain.shape)
    if not gain[at] > NOISE * max(1.0, float(score(total))):
        return -1, 0, 0.0, float(total[0]), float(total[1]), 0.0, 0.0
    return (int(at[0]), int(at[1]), float(gain[at]), *map(float, left[at]), *map(float, right[at]))


def _choose(p: int, n_bins: int, reg: float, min_child: float):
    """Sums the partial histograms by (class, node) and picks each node's split."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            for c, node, raw in zip(*(col.to_pylist() for col in b.columns)):
                part = np.frombuffer(raw, np.float64)
                held[c, node] = held[c, node] + part if (c, node) in held else part
        rows = [(c, node, -1, 0, 0.0, float(s[0]), float(s[1]), 0.0, 0.0) if c < 0 else
                (c, node, *best_split(s.reshape(p, n_bins + 1, 2), reg, min_child)) for (c, node), s in sorted(held.items())]
        if rows:
            names = [f.split() for f in CHOSEN.split(", ")]
            kinds = {"int": pa.int32(), "double": pa.float64()}
            yield pa.RecordBatch.from_arrays([pa.array(col, kinds[t]) for col, (_, t) in zip(zip(*rows), names)],
                                             [n for n, _ in names])
    return run


def bin_edges(train: DataFrame, features, n_bins: int) -> list[np.ndarray]:
    """At most ``n_bins - 1`` borders per feature: approximate quantiles of its finite values."""
    probs = [i / n_bins for i in range(1, n_bins)]
    x = lambda c: F.col(f"`{c}`").cast("double")                                                     # noqa: E731
    row = train.select(*[F.percentile_approx(F.when(F.abs(x(c)) < float("inf"), x(c)), probs, 10_000).alias(f"q{i}")
                         for i, c in enumerate(features)]).first()
    return [np.unique(np.array(q if q is not None else [], float)) for q in row]


class BoostedTrees:
    """A fitted multinomial boosted model: flat trees per round and class."""

    def __init__(self, features, classes, start, rounds, best_round=None, losses=()):
        self.features, self.classes, self.start = list(features), list(classes), np.asarray(start, float)
        self.rounds = rounds                             # [round][class] -> arrays of a flat tree
        self.best_round, self.losses = best_round, list(losses)
        self._steps = None

    def _compiled(self) -> tuple[list[np.ndarray], list[list[tuple]]]:
        """Borders of each feature and the trees' :func:`steps` over the bins between them."""
        if self._steps is None:
            cuts = [[] for _ in self.features]
            for t in (t for trees in self.rounds for t in trees):
                inner = t["feature"] >= 0
                for f in np.unique(t["feature"][inner]):
                    cuts[f].append(t["threshold"][inner & (t["feature"] == f)])
            borders = [np.unique(np.concatenate(c)) if c else np.zeros(0) for c in cuts]

            def path(t):
                at = np.zeros(len(t["feature"]), np.int64)
                for f, b in enumerate(borders):
                    mine = t["feature"] == f
                    at[mine] = np.searchsorted(b, t["threshold"][mine])
                return steps(t, at)
            self._steps = borders, [[path(t) for t in trees] for trees in self.rounds]
        return self._steps

    def binned(self, x: np.ndarray) -> np.ndarray:
        """(features, rows) bins of a (rows, features) array between the trees' borders; missing values are ``TOP``."""
        borders, _ = self._compiled()
        bins = np.empty((len(borders), len(x)), np.uint8)
        for f, b in enumerate(borders):
            bins[f] = np.where(np.isnan(x[:, f]), TOP, np.searchsorted(b, x[:, f], side="left"))
        return bins

    def raw(self, x: np.ndarray) -> np.ndarray:
        """(rows, trees per round) raw scores of a (rows, features) array; NaN is missing."""
        _, paths = self._compiled()
        out = np.tile(self.start, (len(x), 1))
        for at in range(0, len(x), SCORED):
            bins, here = self.binned(x[at:at + SCORED]), out[at:at + SCORED]
            for trees, of in zip(self.rounds, paths):
                for c, t in enumerate(trees):
                    here[:, c] += t["value"].take(walk(of[c], bins))
        return out

    def __getstate__(self):
        return self.__dict__ | {"_steps": None}

    def probs(self) -> Column:
        """Array of the class probabilities of a row, over ``classes``."""
        model = self

        @F.pandas_udf("array<double>")
        def score(x: pd.DataFrame) -> pd.Series:
            p = probabilities(model.raw(x.to_numpy(dtype=float, na_value=np.nan)))
            return pd.Series(list(p[:, :len(model.classes)]))
        return score(F.struct(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(self.features)]))

    def gains(self) -> np.ndarray:
        """Share of each feature in the total gain of all splits."""
        out = np.zeros(len(self.features))
        for trees in self.rounds:
            for t in trees:
                inner = t["feature"] >= 0
                np.add.at(out, t["feature"][inner], t["gain"][inner])
        return out / out.sum() if out.sum() > 0 else out

    def to_json(self) -> str:
        trees = [[{k: v.tolist() for k, v in t.items()} for t in r] for r in self.rounds]
        return json.dumps({"features": self.features, "classes": self.classes, "start": self.start.tolist(), "rounds": trees,
                           "best_round": self.best_round, "losses": self.losses})

    @staticmethod
    def from_json(text: str) -> "BoostedTrees":
        d = json.loads(text)
        d["rounds"] = [[{k: np.array(v) for k, v in t.items()} for t in r] for r in d["rounds"]]
        return BoostedTrees(**d)


def fit_boosted(train: DataFrame, features, index_col: str, classes, weight_col: str | None = None, rounds: int = 100,
                max_depth: int = 6, rate: float = 0.3, reg: float = 1.0, min_child: float = 1.0, n_bins: int = 64,
                validation_col: str | None = None, patience: int = 10, block_rows: int = BLOCK_ROWS,
                whole_rows: int | None = None) -> BoostedTrees:
    """Boost ``rounds`` rounds of trees of ``max_depth`` levels on ``train``.

    ``index_col`` holds the position of the label in ``classes``; rows where it
    is null are left out.  ``weight_col`` weighs rows (a null weight is 0).  With
    ``validation_col`` (boolean) boosting ends after ``patience`` rounds without
    a lower loss of the marked rows, and the model keeps the rounds up to the
    best.  Missing values go right at every split; infinite ones are ordered.
    An empty training set gives equal probabilities.  One task fits a model of at most ``whole_rows`` rows
    (``WHOLE_ROWS``, or one block where ``block_rows`` are given) that is within the other bounds there.
    """
    features, k_classes = list(features), len(classes)
    if k_classes > MAX_CLASSES or not 2 <= n_bins <= 254:
        raise ValueError(f"{k_classes} classes or {n_bins} bins are too many")
    p, k = len(features), 1 if k_classes <= 2 else k_classes
    y, val = F.col(index_col).cast("int"), F.lit(False) if validation_col is None else F.coalesce(F.col(validation_col), F.lit(False))
    w = F.lit(1.0) if weight_col is None else F.coalesce(F.col(weight_col).cast("double"), F.lit(0.0))
    rows = train.where(F.col(index_col).isNotNull()).select(
        *[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))).alias(f"x{i}") for i, c in enumerate(features)],
        y.alias("y"), w.alias("w"), val.alias("val"))
    edges = bin_edges(rows.where("NOT val"), [f"x{i}" for i in range(p)], n_bins)
    start = np.zeros(k)
    model = BoostedTrees(features, classes, start, [])
    n = rows.count()
    if not n:
        return model
    pack, validated = lambda size: _blocks(edges, start, size, n_bins), validation_col is not None
    settings = (rate, reg, min_child)
    if whole_rows is None:
        whole_rows = WHOLE_ROWS if block_rows == BLOCK_ROWS else block_rows
    if n <= block_rows or n <= whole_rows and n * k <= WHOLE_SCORES and n * k * p <= WHOLE:
        fitted = _whole_fit(pack(block_rows if n <= block_rows else WIDE * block_rows), n > block_rows, p, k, n_bins, edges, rounds, patience, validated, max_depth, *settings)
        *kept, last = (json.loads(r[0]) for r in rows.repartition(1).mapInArrow(fitted, "value string").collect())
        kept, (losses, best) = [[{name: np.array(v) for name, v in t.items()} for t in trees] for trees in kept], last
    else:
        kept, losses, best = _by_levels(rows, n, pack(block_rows), p, k, n_bins, edges, rounds, patience, validated, max_depth,
                                        block_rows, *settings)
    model.rounds = kept
    if losses:
        model.rounds, model.best_round, model.losses = kept[:best], best, losses
    return model


def _by_levels(rows: DataFrame, n: int, pack, p, k, n_bins, edges, rounds, patience, validated, max_depth, block_rows, *settings):
    """:func:`_boost` over blocks of rows that many tasks hold, a job per level."""
    # a partition a core, each sending its sums once a pass, until a partition would hold PART_BLOCKS blocks
    cores, blocks = rows.sparkSession.sparkContext.defaultParallelism, -(-n // block_rows)
    parts = max(1, min(blocks, cores * -(-blocks // (cores * PART_BLOCKS))))
    # without the plan of the rows, which the planning of every pass would go through
    held = [cut_lineage(rows.repartition(parts).mapInArrow(pack, STATE)).persist(StorageLevel.MEMORY_AND_DISK)]
    passed = 0

    def grow():
        out = _round(held[-1], parts, _unpacked(p, k), p, k, n_bins, edges, max_depth, *settings)
        while len(held) > 1:                     # the round has filled its own blocks
            held.pop(0).unpersist()
        return out

    def advance(trees):
        nonlocal passed
        passed += 1
        new = held[-1].mapInArrow(_advance(p, k, trees), STATE)
        held.append((cut_lineage(new) if passed % CUT == 0 else new).persist(StorageLevel.MEMORY_AND_DISK))
    try:
        return _boost(rounds, patience, validated, grow, advance)
    finally:
        for state in held:
            state.unpersist()


def _round(state: DataFrame, parts: int, unpacked, p, k, n_bins, edges, max_depth, rate, reg, min_child):
    trees, open_nodes, loss = [Tree() for _ in range(k)], [[0] for _ in range(k)], [0.0, 0.0]
    choose = _choose(p, n_bins, reg, min_child)
    for depth in range(max_depth):
        sums = state.mapInArrow(_partial(unpacked, n_bins, [t.arrays() for t in trees], open_nodes, depth), PARTIAL)
        if parts * sum(map(len, open_nodes)) * p * (n_bins + 1) * 16 <= DRIVER_BYTES:
            found = [tuple(r.values()) for b in choose(sums.toArrow().to_batches()) for r in b.to_pylist()]
        else:
            found = [tuple(r) for r in sums.repartition("cls", "node").mapInArrow(choose, CHOSEN).collect()]
        loss = next(([f[5], f[6]] for f in found if f[0] < 0), loss)
        open_nodes = split_level(trees, [f for f in found if f[0] >= 0], depth, edges, rate, reg, min_child)
        if not any(open_nodes):
            break
    return loss, [t.arrays() for t in trees]


# ---- exact attribution (X2, X3) ---------------------------------------------

def _leaves(tree: dict) -> list[tuple]:
    """(value, {feature: [above, up to, missing allowed, share of the cover]}) of every leaf.

    A path's conditions on one feature are one interval; the share is the
    product of the children's shares of their parents' cover along the path."""
    out, todo = [], [(0, {})]
    while todo:
        node, path = todo.pop()
        f = int(tree["feature"][node])
        if f < 0:
            out.append((float(tree["value"][node]), path))
            continue
        lo, hi, nan, share = path.get(f, (-np.inf, np.inf, True, 1.0))
        cut, cover = float(tree["threshold"][node]), float(tree["cover"][node])
        a, b = int(tree["left"][node]), int(tree["right"][node])
        todo.append((a, path | {f: (lo, min(hi, cut), False, share * float(tree["cover"][a]) / cover)}))
        todo.append((b, path | {f: (max(lo, cut), hi, nan, share * float(tree["cover"][b]) / cover)}))
    return out


def _gains(o: np.ndarray, z: np.ndarray, values: np.ndarray) -> np.ndarray:
    """(patterns, leaves, d) Shapley values of leaves, ``o`` telling which conditions a pattern meets."""
    from math import factorial
    d = o.shape[2]
    weight = [factorial(s) * factorial(d - s - 1) / factorial(d) for s in range(d)]
    q = np.zeros((*o.shape[:2], d + 1))
    q[..., 0] = 1.0
    for j in range(d):                                                                # times (z + o t)
        up = np.where(o[..., j, None], q[..., :-1], 0.0)
        q *= z[:, j, None]
        q[..., 1:] += up
    out = np.empty(o.shape)
    for j in range(d):
        # the quotient by (z + o t): from the highest power where o is 1, else a plain division by z
        rest, total = np.zeros(o.shape[:2]), np.zeros(o.shape[:2])
        safe = np.where(z[:, j] > 0, z[:, j], 1.0)
        for s in range(d - 1, -1, -1):
            rest = np.where(o[..., j], q[..., s + 1] - z[:, j] * rest, q[..., s] / safe)
            total += weight[s] * rest
        out[..., j] = values * (o[..., j] - z[:, j]) * total
    return out


def shapley(model: BoostedTrees, x: np.ndarray, cls: int = 0) -> tuple[np.ndarray, float]:
    """Exact Shapley values (rows, features) of the raw score ``cls`` and the score without any feature.

    A feature outside a coalition takes both ways of a split by cover.  A leaf
    is then worth value * product over its path's features of o (1 if the row
    meets the feature's interval, else 0) inside and z (the share) outside the
    coalition; with Q(t) the product of (z + o t), a feature's value weighs the
    coefficients of Q(t) / (z + o t) by coalition size.  That is quadratic in
    the depth for each leaf; leaves with equally many features go together.
    Where the rows are more than the ways to meet a leaf's d conditions, the
    2^d ways are worked out and each row looks its own up.
    """
    out, base = np.zeros((len(x), len(model.features))), float(model.start[cls])
    borders, _ = model._compiled()
    bins = model.binned(x)
    for trees in model.rounds:
        by_size: dict[int, list] = {}
        for value, path in _leaves(trees[cls]):
            base += value * float(np.prod([s[3] for s in path.values()]))
            if path:
                by_size.setdefault(len(path), []).append((value, path))
        for d, leaves in by_size.items():
            table = d <= TABLE and len(x) > 2 ** d
            ways = ((np.arange(2 ** d)[:, None] >> np.arange(d)) & 1).astype(bool) if table else None
            step = max(1, 2_000_000 // (max(1, len(ways) if table else len(x)) * d))
            for i in range(0, len(leaves), step):
                part = leaves[i:i + step]
                values, z = np.array([v for v, _ in part]), np.array([[s[3] for s in path.values()] for _, path in part])
                # (feature, rows that meet its condition) of every leaf
                met = (((f, _meets(bins[f], borders[f], *s[:3])) for f, s in path.items()) for _, path in part)
                if table:
                    gain = _gains(np.broadcast_to(ways[:, None, :], (len(ways), len(part), d)), z, values)
                    for leaf, conditions in enumerate(met):
                        way, of = np.zeros(len(x), np.uint16), np.zeros((len(ways), out.shape[1]))
                        for j, (f, m) in enumerate(conditions):
                            way |= m.astype(np.uint16) << j
                            of[:, f] = gain[:, leaf, j]
                        out += of.take(way, axis=0)
                else:
                    o = np.stack([np.stack([m for _, m in conditions], -1) for conditions in met], 1)
                    gain = _gains(o, z, values)
                    for leaf, (_, path) in enumerate(part):
                        for j, f in enumerate(path):
                            out[:, f] += gain[:, leaf, j]
    return out, base


def _meets(bins: np.ndarray, borders: np.ndarray, lo: float, hi: float, nan: bool) -> np.ndarray:
    """Whether the values of these bins lie above ``lo`` and up to ``hi``, or are missing where ``nan`` allows it."""
    met = bins <= (TOP if nan and hi == np.inf else np.searchsorted(borders, hi))
    if lo > -np.inf:
        met &= bins > np.searchsorted(borders, lo)
    return met


def attribute(model: BoostedTrees, rows: DataFrame, key: str, cls: int = 0) -> DataFrame:
    """(key, feature, value, contribution): exact Shapley values of each row's raw score (log odds for two classes)."""
    names = np.array(model.features, object)

    def explained(part: pa.Table) -> pa.RecordBatch:
        part = part.combine_chunks()
        x = np.stack([part.column(i + 1).to_numpy() for i in range(len(names))], 1)
        phi, _ = shapley(model, x, cls)
        keys = part.column(0).take(pa.array(np.repeat(np.arange(len(x)), len(names)))).combine_chunks()
        return pa.RecordBatch.from_arrays([
            keys.chunk(0) if isinstance(keys, pa.ChunkedArray) else keys,
            pa.array(np.tile(names, len(x)), pa.string()), pa.array(x.ravel()), pa.array(phi.ravel())],
            ["key", "feature", "value", "contribution"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= EXPLAINED:
                yield explained(pa.Table.from_batches(held))
                held, n = [], 0
        if n:
            yield explained(pa.Table.from_batches(held))
    kind = rows.schema[key].dataType.simpleString()
    from ..session import spread
    return spread(rows.select(key, *[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))).alias(f"x{i}")
                                     for i, c in enumerate(model.features)])) \
        .mapInArrow(run, f"key {kind}, feature string, value double, contribution double").withColumnRenamed("key", key)
