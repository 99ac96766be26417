"""Operator 3: quality rules by gradient-boosted trees over document statistics.

``statistics`` computes whole-text statistics in numpy; ``fit`` grows
histogram trees on a bounded sample of labelled rows; the forest is flattened
into numpy node arrays, so scoring walks all rows down a level at a time.
Features named in ``MONOTONE`` may only push the verdict one way: a split that
would break this is not made, and each child's values are bounded by the
middle of the split above it, so the whole forest is monotone in them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .textops import RangeHash, U64, column_bytes, mix64, sub_batches, word_spans
from .toxicity import _labelled

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
MIN_WORDS, REPEAT_PERCENT = 20, 30
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Direction in which a feature may move the probability of good quality; 0: any.
FEATURES = {"log_words": 0, "word_length": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1,
            "upper_share": -1, "mark_share": 0, "digit_share": 0, "line_words": 0, "distinct_share": 0,
            "short_share": 0}
MAX_ROWS = 20_000
STEP = 1 << 20


def _per(values, docs):
    return np.bincount(values, minlength=docs)[:docs] if len(values) else np.zeros(docs, np.int64)


def _repeated_words(h: np.ndarray, d: np.ndarray, docs: int) -> np.ndarray:
    """Words in ``WINDOW``-word windows that occur twice or more in the text."""
    n = len(h) - WINDOW + 1
    if n <= 0:
        return np.zeros(docs, np.int64)
    w = mix64(d[:n].astype(U64))
    for j in range(WINDOW):
        w = mix64(w * U64(0xA0761D6478BD642F) + h[j:n + j])
    inside = np.flatnonzero(d[:n] == d[WINDOW - 1:])
    _, which, count = np.unique(w[inside], return_inverse=True, return_counts=True)
    at = inside[count[which] > 1]
    cover = np.zeros(len(h) + 1, np.int32)
    cover[at] += 1
    cover[at + WINDOW] -= 1
    return _per(d[np.cumsum(cover[:-1]) > 0], docs)


def statistics(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(base counts, features) per document."""
    docs = len(off) - 1
    s, e, d = word_spans(buf, off)
    n = _per(d, docs)
    rh = RangeHash(buf)
    h = rh.of(s, e)
    lead = (buf & 0xC0) != 0x80
    points = np.concatenate(([0], np.cumsum(lead)))
    chars = points[e] - points[s]
    word_chars = np.bincount(d, chars, docs).astype(np.int64)[:docs]

    def count(table):
        c = np.concatenate(([0], np.cumsum(table[buf])))
        return np.diff(c[off])
    flag = lambda codes: np.isin(np.arange(256), list(codes)).astype(np.int64)                   # noqa: E731
    symbols = count(flag(SYMBOLS))
    upper, lower = count(flag(range(65, 91))), count(flag(range(97, 123)))
    marks, digits = count(flag(b"!?.,;:")), count(flag(b"0123456789"))
    # lines with a word, and those equal to an earlier one
    newline = np.flatnonzero(buf == 10)
    begin = np.sort(np.concatenate((off[:-1], newline + 1)))
    owner = np.searchsorted(off, begin, side="right") - 1
    # an empty document's start coincides with the next one's; a line start at a document's end is empty
    begin, keep = np.unique(np.minimum(begin, len(buf)), return_index=True)
    owner = owner[keep]
    end = np.append(begin[1:], len(buf))
    end = end - ((end > begin) & (buf[np.maximum(end - 1, 0)] == 10) if len(buf) else 0)
    worded = np.searchsorted(s, end) > np.searchsorted(s, begin)
    lines, lo = rh.of(begin[worded], end[worded]), owner[worded]
    distinct = np.unique(mix64(lines + mix64(lo.astype(U64))), return_index=True)[1]
    dup = _per(lo, docs) - _per(lo[distinct], docs)
    repeat = _repeated_words(h, d, docs)
    vocabulary = _per(d[np.unique(mix64(h + mix64(d.astype(U64))), return_index=True)[1]], docs)
    short = _per(d[chars <= 2], docs)
    base = np.stack([n, word_chars, symbols, dup, repeat], axis=1).astype(np.int64)
    share = lambda a, b: a / np.maximum(b, 1)                                                    # noqa: E731
    features = np.stack([
        np.log1p(n), share(word_chars, n), share(symbols, n), share(dup, _per(lo, docs)), share(repeat, n),
        share(upper, upper + lower), share(marks, n), share(digits, word_chars), share(n, _per(lo, docs)),
        share(vocabulary, n), share(short, n)], axis=1)
    return base, features


@dataclass
class Forest:
    """Trees as flat arrays: node i sends x[feature[i]] <= threshold[i] to left[i], else to right[i]."""
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            z += self.value[at]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def boost(x: np.ndarray, y: np.ndarray, monotone: list[int], trees: int = 60, depth: int = 4, rate: float = 0.2,
          bins: int = 64, l2: float = 1.0, least: float = 2.0) -> Forest:
    """Newton boosting of the logistic loss on histograms; a leaf is a node that points to itself."""
    rows, width = x.shape
    start = float(np.log((y.sum() + 1) / (rows - y.sum() + 1)))
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def node():
        i = len(feature)
        for a, v in ((feature, 0), (threshold, np.inf), (left, i), (right, i), (value, 0.0)):
            a.append(v)
        return i
    if rows and 0 < y.sum() < rows:
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for f in range(width)]
        code = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
        z = np.full(rows, start)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-z))
            g, h = y - p, p * (1 - p)
            root = node()
            roots.append(root)
            open_ = [(root, np.arange(rows), -np.inf, np.inf)]
            for level in range(depth + 1):
                below = []
                for i, own, lo, hi in open_:
                    weight = lambda a, b: np.clip(a / (b + l2), lo, hi)                           # noqa: E731
                    gain_of = lambda a, b, w: a * w - 0.5 * (b + l2) * w * w                      # noqa: E731
                    gs, hs = g[own].sum(), h[own].sum()
                    value[i] = float(weight(gs, hs)) * rate
                    best = (1e-6, None)
                    for f in range(width) if level < depth else ():
                        k = len(cuts[f]) + 1
                        if k < 2:
                            continue
                        gl = np.cumsum(np.bincount(code[own, f], g[own], k))[:-1]
                        hl = np.cumsum(np.bincount(code[own, f], h[own], k))[:-1]
                        wl, wr = weight(gl, hl), weight(gs - gl, hs - hl)
                        gain = gain_of(gl, hl, wl) + gain_of(gs - gl, hs - hl, wr) - gain_of(gs, hs, weight(gs, hs))
                        ok = (hl >= least) & (hs - hl >= least) & ((wr - wl) * monotone[f] >= 0)
                        gain = np.where(ok, gain, -np.inf)
                        c = int(np.argmax(gain))
                        if gain[c] > best[0]:
                            best = (gain[c], (f, c, float(wl[c]), float(wr[c])))
                    if best[1] is None:
                        z[own] += value[i]
                        continue
                    f, c, wl, wr = best[1]
                    feature[i], threshold[i] = f, float(cuts[f][c])
                    left[i], right[i] = node(), node()
                    mid = (wl + wr) / 2
                    bound = {1: ((lo, mid), (mid, hi)), -1: ((mid, hi), (lo, mid)), 0: ((lo, hi), (lo, hi))}[monotone[f]]
                    goes = code[own, f] <= c
                    below += [(left[i], own[goes], *bound[0]), (right[i], own[~goes], *bound[1])]
                open_ = below
    arrays = [np.array(a, t) for a, t in ((feature, np.int64), (threshold, float), (left, np.int64),
                                          (right, np.int64), (value, float))]
    return Forest(*arrays, np.array(roots, np.int64), depth, start)


def fit(docs: DataFrame, labels: DataFrame, column: str = "quality", usable=lambda doc_id: F.lit(True),
        max_rows: int = MAX_ROWS) -> Forest:
    """Trees from at most ``max_rows`` labelled rows (``labels``: doc_id, 0/1 ``column``), chosen by a hash of the id.

    Rows with null ids or labels are left out; without both classes the
    forest has no trees and gives every document the smoothed base rate."""
    def run(batches):
        for batch in batches:
            buf, off = column_bytes(batch.column(0))
            for i, j in sub_batches(off, STEP):
                _, x = statistics(buf[off[i]:off[j]], off[i:j + 1] - off[i])
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(i, j - i), *map(pa.array, x.T)],
                                                 ["y", *FEATURES])
    ddl = "y int, " + ", ".join(f"{f} double" for f in FEATURES)
    got = _labelled(docs, labels, column, max_rows, usable).mapInArrow(run, ddl).toPandas() \
        .sort_values(["y", *FEATURES])
    return boost(got[list(FEATURES)].to_numpy(float), (got["y"].to_numpy() > 0).astype(float), list(FEATURES.values()))


def judge(docs: DataFrame, forest: Forest, threshold: float = 0.5) -> DataFrame:
    """doc_id, the base counts, base_failed, probability (of good quality) and kept, one row per row of ``docs``.

    ``base_failed``: fewer than 20 words, or over 30 % of the words in
    repeated windows.  ``kept`` is false if it failed, else probability >=
    ``threshold``.  A null or empty text has no words and fails.  Repeated
    rows and rows without doc_id are judged as any other; other columns are
    ignored; an empty table gives an empty result.
    """
    def run(batches):
        for batch in batches:
            buf, off = column_bytes(batch.column(1))
            for i, j in sub_batches(off, STEP):
                base, x = statistics(buf[off[i]:off[j]], off[i:j + 1] - off[i])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), *map(pa.array, base.T), pa.array(forest.probability(x))],
                    ["doc_id", *BASE, "probability"])
    ddl = "doc_id long, " + ", ".join(f"{c} long" for c in BASE) + ", probability double"
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, ddl).withColumn("base_failed", failed) \
        .withColumn("kept", ~F.col("base_failed") & (F.col("probability") >= threshold))
