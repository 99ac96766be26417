"""Operator 6: toxicity by a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features are the presence of hashed character n-grams, each scaled by its
log-count ratio r = log(P(gram | toxic) / P(gram | clean)) (Wang and Manning,
2012); a logistic regression is fitted on the scaled features.  Grams are
ranked by how far apart their document rates are in the two classes, and the
``features`` best are used (at most two per labelled row, so that a small
sample does not get more features than it can tell apart).

The fit reads a bounded sample of labelled rows (``max_rows``, chosen by a
hash of the id); scoring covers every text as a whole.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .chargrams import CharGrams
from .textops import column_bytes, sub_batches

ORDERS, BITS = (3, 4, 5), 18
FEATURES, MAX_ROWS = 4096, 20_000
#: Least standard score of the difference between a gram's shares in the two classes for it to be a feature.
APART = 3.0
STEP = 1 << 20


@dataclass
class Model:
    slot: np.ndarray          # bucket -> feature, ``len(weight)`` where the gram is not used
    ratio: np.ndarray
    weight: np.ndarray
    bias: float

    def presence(self, buf, off) -> np.ndarray:
        """documents x features: which used grams a document has."""
        docs, size = len(off) - 1, len(self.ratio)
        seen = np.zeros(docs * (size + 1), bool)
        grams = CharGrams(buf, off)
        for n in ORDERS:
            h, at = grams.buckets(n, BITS)
            seen[grams.doc[at] * (size + 1) + self.slot[h]] = True
        return seen.reshape(docs, size + 1)[:, :size]

    def scores(self, buf, off) -> np.ndarray:
        out = []
        v = (self.ratio * self.weight).astype(np.float32)
        for i, j in sub_batches(off, STEP):
            z = self.presence(buf[off[i]:off[j]], off[i:j + 1] - off[i]).astype(np.float32) @ v
            out.append(1.0 / (1.0 + np.exp(-np.clip(z.astype(np.float64) + self.bias, -40, 40))))
        return np.concatenate(out) if out else np.zeros(0)


def _labelled(docs: DataFrame, labels: DataFrame, column: str, max_rows: int, usable) -> DataFrame:
    """text and y of at most ``max_rows`` labelled documents, one row each; only their ids are broadcast.

    Of several rows of one id the least text is taken (null if no row has one)."""
    ids = labels.select(F.col("doc_id").cast("long").alias("id"), F.col(column).cast("int").alias("y")) \
        .where("id IS NOT NULL AND y IS NOT NULL").where(usable(F.col("id"))) \
        .groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(max_rows)
    text = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    return text.join(F.broadcast(ids), "id").groupBy("id", "y").agg(F.min("text").alias("text")).select("text", "y")


def _document_counts(train: DataFrame):
    """(toxic, clean) numbers of documents per bucket, summed by Spark."""
    def run(batches):
        for batch in batches:
            buf, off = column_bytes(batch.column(0))
            y = batch.column(1).to_numpy(zero_copy_only=False) > 0
            both = np.zeros((2, 1 << BITS), np.int32)
            for i, j in sub_batches(off, STEP):
                grams = CharGrams(buf[off[i]:off[j]], off[i:j + 1] - off[i])
                keys = []
                for n in ORDERS:
                    h, at = grams.buckets(n, BITS)
                    keys.append((grams.doc[at] << BITS) + h)
                key = np.unique(np.concatenate(keys))
                toxic = y[i:j][key >> BITS]
                for row, mask in ((0, toxic), (1, ~toxic)):
                    both[row] += np.bincount(key[mask] & ((1 << BITS) - 1), minlength=1 << BITS).astype(np.int32)
            at = np.flatnonzero(both.any(axis=0))
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(both[0, at].astype(np.int64)),
                                              pa.array(both[1, at].astype(np.int64))], ["bucket", "pos", "neg"])
    rows = train.mapInArrow(run, "bucket long, pos long, neg long").groupBy("bucket") \
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).toPandas()
    counts = np.zeros((2, 1 << BITS))
    counts[:, rows["bucket"].to_numpy(np.int64)] = rows[["pos", "neg"]].to_numpy(np.float64).T
    return counts


def _regression(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, y: np.ndarray, l2: float, steps: int):
    """L2-regularised logistic regression on sparse rows, by Adam over the whole sample."""
    width = len(values)
    w, b = np.zeros(width), math.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    x = values[cols]
    for t in range(1, steps + 1):
        z = np.bincount(rows, x * w[cols], len(y)) + b
        g = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) / len(y)
        grad = np.append(np.bincount(cols, x * g[rows], width) + l2 * w, g.sum())
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        step = 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-9)
        w -= step[:-1]
        b -= step[-1]
    return w, b


def fit(docs: DataFrame, labels: DataFrame, column: str = "toxic", usable=lambda doc_id: F.lit(True),
        features: int = FEATURES, max_rows: int = MAX_ROWS, alpha: float = 1.0, l2: float = 1e-4,
        steps: int = 300) -> Model:
    """Learns from the rows of ``labels`` (doc_id, ``column``) whose id ``usable`` accepts.

    Rows with a null label or id are left out; of several labels of a document
    the largest counts.  Without any label the model scores 0.5, and with one
    class only that class's smoothed rate.
    """
    train = _labelled(docs, labels, column, max_rows, usable).cache()
    try:
        pos, neg = _document_counts(train)
        ratio = np.log((pos + alpha) / (pos + alpha).sum()) - np.log((neg + alpha) / (neg + alpha).sum())
        sizes = {int(r.y > 0): r.n for r in train.groupBy("y").agg(F.count("*").alias("n")).collect()}
        n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
        if not n1 or not n0:
            used = np.zeros(0, np.int64)
        else:
            p = (pos + neg) / (n1 + n0)
            apart = np.abs(pos / n1 - neg / n0) / np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / n1 + 1 / n0))
            order = np.argsort(-apart, kind="stable")[:features]
            used = np.sort(order[apart[order] >= APART])
        slot = np.full(1 << BITS, len(used), np.int32)
        slot[used] = np.arange(len(used))
        model = Model(slot, ratio[used], np.zeros(len(used)), math.log((n1 + 1) / (n0 + 1)))

        def run(batches):
            for batch in batches:
                buf, off = column_bytes(batch.column(0))
                for i, j in sub_batches(off, STEP):
                    seen = model.presence(buf[off[i]:off[j]], off[i:j + 1] - off[i])
                    r, c = np.nonzero(seen)
                    at = np.concatenate(([0], np.cumsum(np.bincount(r, minlength=j - i)))).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(1).slice(i, j - i), pa.ListArray.from_arrays(
                            pa.array(at), pa.array(c.astype(np.int32)))], ["y", "grams"])
        if len(used):
            # bounded: max_rows rows of at most ``features`` numbers
            got = train.mapInArrow(run, "y int, grams array<int>").toArrow()
            grams = got.column("grams").combine_chunks()
            rows = np.repeat(np.arange(len(grams)), grams.value_lengths().to_numpy())
            y = (got.column("y").to_numpy() > 0).astype(np.float64)
            model.weight, model.bias = _regression(rows, grams.flatten().to_numpy(), model.ratio, y, l2, steps)
    finally:
        train.unpersist()
    return model


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """All columns of ``docs`` with ``score`` (0 to 1) and ``predicted`` (1 if score >= threshold).

    Clashing columns are replaced.  A null or empty text has no grams and gets
    the model's base rate.
    """
    keep = [c for c in docs.columns if c not in ("score", "predicted")]

    def run(batches):
        for batch in batches:
            s = model.scores(*column_bytes(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s)], ["row", "score"])
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
                         F.col("text").cast("string").alias("text"))
    kind = packed.schema["row"].dataType.simpleString()
    return packed.mapInArrow(run, f"row {kind}, score double").select(
        *[F.col("row")[c].alias(c) for c in keep], "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
