"""Multilayer perceptron with row weights (M7, B13): rectified units, softmax, mini-batch Adam.

Training goes in rounds of one Spark job.  Every task starts from the round's
parameters, takes mini-batch steps over its blocks of rows, one after another,
and gives back its parameters and Adam moments; these are averaged by the
weight of the rows behind them, first in groups of tasks, and start the next
round.  A round reads the rows once, a task holds one block at a time, and what
reaches the driver is one parameter vector per group, whatever the rows.

Every tenth row of a block is kept out of the steps; the weighted loss on these
rows decides when to stop and which round's parameters stay.
"""

from __future__ import annotations

import base64
import json
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.labels import MAX_CLASSES
from . import profile as A

#: Rows of one packed block; a table of fewer rows is trained by one task alone.
BLOCK_ROWS = 16_384
#: Largest parameter vector (it travels with every task and comes back from every group).
MAX_PARAMETERS = 4_000_000
#: Every how manieth row of a block is kept out of the steps.
HELD_OUT = 10

STATE = "n long, x binary, y binary, w binary"
PART = "grp int, weight double, loss double, held double, steps double, theta binary"


def layer_views(theta: np.ndarray, sizes: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(weights, bias) of each layer as views into the flat vector."""
    out, at = [], 0
    for a, b in zip(sizes, sizes[1:]):
        out.append((theta[at:at + a * b].reshape(a, b), theta[at + a * b:at + (a + 1) * b]))
        at += (a + 1) * b
    return out


def n_parameters(sizes: list[int]) -> int:
    return sum((a + 1) * b for a, b in zip(sizes, sizes[1:]))


def start_parameters(sizes: list[int], seed: int) -> np.ndarray:
    """Uniform start within sqrt(6 / (inputs + outputs)) of each layer, no bias."""
    rng = np.random.default_rng(seed)
    theta = np.zeros(n_parameters(sizes))
    for (w, _), (a, b) in zip(layer_views(theta, sizes), zip(sizes, sizes[1:])):
        w[:] = rng.uniform(-1, 1, (a, b)) * math.sqrt(6.0 / (a + b))
    return theta


def forward(theta: np.ndarray, sizes: list[int], x: np.ndarray) -> list[np.ndarray]:
    """Inputs of every layer, then the class probabilities."""
    layers, acts = layer_views(theta, sizes), [x]
    for i, (w, b) in enumerate(layers):
        z = acts[-1] @ w + b
        if i < len(layers) - 1:
            acts.append(np.maximum(z, 0.0))
        else:
            z = np.exp(z - z.max(axis=1, keepdims=True))
            acts.append(z / z.sum(axis=1, keepdims=True))
    return acts


def losses(probs: np.ndarray, y: np.ndarray) -> np.ndarray:
    return -np.log(np.maximum(probs[np.arange(len(y)), y], 1e-15))


def gradient(theta: np.ndarray, sizes: list[int], x: np.ndarray, y: np.ndarray, w: np.ndarray, decay: float) -> np.ndarray:
    """Gradient of the weighted mean cross entropy plus ``decay`` / 2 of the squared weights (not the biases)."""
    return Steps(theta, sizes, decay, len(y)).gradient(x, y, w)


class Steps:
    """Mini-batch Adam steps on ``theta`` and its moments ``m`` and ``v``, all in place.

    The arrays of a step are made once and written again by every step, as its time would else go into
    fetching fresh memory; each number is reckoned as by plain expressions."""

    def __init__(self, theta: np.ndarray, sizes: list[int], decay: float, batch: int, m: np.ndarray | None = None,
                 v: np.ndarray | None = None):
        self.theta, self.m, self.v, self.decay = theta, m, v, decay
        self.out, self.spare, self.other = np.zeros_like(theta), np.empty_like(theta), np.empty_like(theta)
        self.layers, self.slopes, self.shrink = (layer_views(a, sizes) for a in (theta, self.out, self.spare))
        self.acts, self.deltas = ([np.empty((batch, s)) for s in sizes[1:]] for _ in range(2))
        self.live, self.rows = [np.empty((batch, s), bool) for s in sizes[1:]], np.arange(batch)

    def gradient(self, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
        """As the function of that name; the array is overwritten by the next call."""
        n, last = len(y), len(self.layers) - 1
        acts = [x, *(a[:n] for a in self.acts)]
        for i, (weights, bias) in enumerate(self.layers):
            z = np.matmul(acts[i], weights, out=acts[i + 1])
            z += bias
            if i < last:
                np.maximum(z, 0.0, out=z)
        z -= z.max(axis=1, keepdims=True)
        np.exp(z, out=z)
        z /= z.sum(axis=1, keepdims=True)
        delta = z
        delta[self.rows[:n], y] -= 1.0
        delta *= (w / w.sum())[:, None]
        for i in range(last, -1, -1):
            (weights, _), (gw, gb), (less, _) = self.layers[i], self.slopes[i], self.shrink[i]
            np.matmul(acts[i].T, delta, out=gw)
            gw += np.multiply(weights, self.decay, out=less)
            delta.sum(axis=0, out=gb)
            if i:
                delta = np.matmul(delta, weights.T, out=self.deltas[i - 1][:n])
                delta *= np.greater(acts[i], 0, out=self.live[i - 1][:n])
        return self.out

    def step(self, x: np.ndarray, y: np.ndarray, w: np.ndarray, t: float, rate: float) -> None:
        """The ``t``-th step."""
        g, m, v, a, b = self.gradient(x, y, w), self.m, self.v, self.spare, self.other
        np.subtract(g, m, out=a)
        a *= 0.1
        m += a
        np.multiply(g, g, out=a)
        a -= v
        a *= 0.001
        v += a
        np.divide(m, 1 - 0.9 ** t, out=a)
        a *= rate
        np.divide(v, 1 - 0.999 ** t, out=b)
        np.sqrt(b, out=b)
        b += 1e-8
        a /= b
        self.theta -= a


def _pack_blocks(p: int, block_rows: int, means: np.ndarray, scales: np.ndarray):
    def pack(t: pa.Table) -> pa.RecordBatch:
        x = np.stack([t.column(i).to_numpy() for i in range(p)], 1)
        x = np.where(np.isfinite(x), (x - means) / scales, 0.0).astype(np.float32)
        y, w = t.column(p).to_numpy().astype(np.int32), t.column(p + 1).to_numpy().astype(np.float64)
        return pa.RecordBatch.from_arrays([pa.array([len(y)]), *[pa.array([v.tobytes()], pa.binary()) for v in (x, y, w)]],
                                          ["n", "x", "y", "w"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            while b.num_rows:
                part = b.slice(0, block_rows - n)
                held.append(part)
                n, b = n + part.num_rows, b.slice(part.num_rows)
                if n == block_rows:
                    yield pack(pa.Table.from_batches(held))
                    held, n = [], 0
        if n:
            yield pack(pa.Table.from_batches(held))
    return run


def _train(sizes, state: np.ndarray, steps: float, rnd: int, groups: int, seed: int, batch: int, rate: float,
           decay: float, step: bool):
    """Blocks of one task to its weighted sums: loss of the start on the held-out rows, and what the steps made of it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid = TaskContext.get().partitionId()
        theta, m, v = (s.copy() for s in np.split(state, 3))
        start, t, weight, loss, held, block = theta.copy(), steps, 0.0, 0.0, 0.0, 0
        steps_on = Steps(theta, sizes, decay, batch, m, v)
        for b in batches:
            for i in range(b.num_rows):
                n = b.column(0)[i].as_py()
                x = np.frombuffer(b.column(1)[i].as_buffer(), np.float32).reshape(n, sizes[0]).astype(np.float64)
                y = np.frombuffer(b.column(2)[i].as_buffer(), np.int32)
                w = np.frombuffer(b.column(3)[i].as_buffer(), np.float64)
                out = np.arange(n) % HELD_OUT == HELD_OUT - 1
                if out.any():
                    loss += float((losses(forward(start, sizes, x[out])[-1], y[out]) * w[out]).sum())
                    held += float(w[out].sum())
                rest = np.flatnonzero(~out & (w > 0))
                weight += float(w[rest].sum())
                order = np.random.default_rng([seed, rnd, pid, block]).permutation(rest) if step else rest[:0]
                x, y, w = x[order], y[order], w[order]
                for at in range(0, len(order), batch):
                    t += 1
                    steps_on.step(x[at:at + batch], y[at:at + batch], w[at:at + batch], t, rate)
                block += 1
        if block:
            yield _part(pid % groups, weight, loss, held, t * weight, np.concatenate([theta, m, v]) * weight)
    return run


def _part(grp, weight, loss, held, steps, theta) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "grp": pa.array([grp], pa.int32()), "weight": [float(weight)], "loss": [float(loss)], "held": [float(held)],
        "steps": [float(steps)], "theta": pa.array([theta.tobytes()], pa.binary())})


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, theta = np.zeros(4), None
    for b in batches:
        for i in range(b.num_rows):
            total += [b.column(c)[i].as_py() for c in range(1, 5)]
            part = np.frombuffer(b.column(5)[i].as_buffer(), np.float64)
            theta = part.copy() if theta is None else theta + part
    if theta is not None:
        yield _part(0, *total, theta)


class Perceptron:
    """A fitted network: layer sizes, flat parameters, and the centre and scale of every input."""

    def __init__(self, features, classes, sizes, theta, means, scales, losses=(), best_round=0):
        self.features, self.classes, self.sizes = list(features), list(classes), list(sizes)
        self.theta, self.means, self.scales = (np.asarray(v, float) for v in (theta, means, scales))
        self.losses, self.best_round = list(losses), best_round

    def predict(self, x: np.ndarray) -> np.ndarray:
        x = np.where(np.isfinite(x), (x - self.means) / self.scales, 0.0)
        return forward(self.theta, self.sizes, x)[-1]

    def probs(self) -> Column:
        """Array of the class probabilities of a row, over ``classes``."""
        model = self

        @F.pandas_udf("array<double>")
        def score(x: pd.DataFrame) -> pd.Series:
            return pd.Series(list(model.predict(x.to_numpy(dtype=float, na_value=np.nan))))
        return score(F.struct(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(self.features)]))

    def to_json(self) -> str:
        return json.dumps({"features": self.features, "classes": self.classes, "sizes": self.sizes,
                           "theta": base64.b64encode(self.theta.tobytes()).decode(), "means": self.means.tolist(),
                           "scales": self.scales.tolist(), "losses": self.losses, "best_round": self.best_round})

    @staticmethod
    def from_json(text: str) -> "Perceptron":
        d = json.loads(text)
        d["theta"] = np.frombuffer(base64.b64decode(d["theta"]))
        return Perceptron(**d)


def fit_perceptron(train: DataFrame, features, index_col: str, classes, weight_col: str | None = None,
                   hidden=(128, 64, 32), rounds: int = 50, batch: int = 200, rate: float = 0.001, decay: float = 0.0001,
                   patience: int = 10, tol: float = 1e-4, seed: int = 42, block_rows: int = BLOCK_ROWS) -> Perceptron:
    """Train on the rows of ``train``; ``index_col`` is the label's position in ``classes`` (null: left out).

    Inputs are centred and scaled by the training rows' means and deviations; a
    missing or infinite input then counts as 0.  ``weight_col`` weighs rows (a
    null weight is 0).  Training ends after ``rounds`` passes, or after
    ``patience`` passes without a held-out loss lower by ``tol``; the parameters
    of the lowest loss stay.  The result depends on the number of blocks and
    not on the cluster's timing.  An empty table gives the untrained network."""
    features = list(features)
    sizes = [len(features), *hidden, len(classes)]
    if len(classes) > MAX_CLASSES or n_parameters(sizes) > MAX_PARAMETERS:
        raise ValueError(f"{len(classes)} classes or {n_parameters(sizes)} parameters are too many")
    names = [f"x{i}" for i in range(len(features))]
    w = F.lit(1.0) if weight_col is None else F.coalesce(F.col(weight_col).cast("double"), F.lit(0.0))
    value = lambda c: F.when(F.abs(F.col(f"`{c}`").cast("double")) < float("inf"), F.col(f"`{c}`").cast("double"))
    rows = train.where(F.col(index_col).isNotNull()).select(
        *[F.when(~F.isnan(value(c)), value(c)).alias(x) for x, c in zip(names, features)],
        F.col(index_col).cast("int").alias("y"), w.alias("w"))
    stats = {r["feature"]: r for r in A.wide_stats(rows, names, {
        "mean": lambda c: F.avg(F.col(c)), "std": lambda c: F.stddev_pop(F.col(c)), "rows": lambda c: F.count(F.lit(1))}).collect()}
    means, scales = (np.array([stats[x][k] or other for x in names], float) for k, other in (("mean", 0.0), ("std", 1.0)))
    n = max((r["rows"] for r in stats.values()), default=0)
    parts = max(1, min(-(-n // block_rows), 4 * train.sparkSession.sparkContext.defaultParallelism))
    groups = math.isqrt(parts - 1) + 1
    state = np.concatenate([start_parameters(sizes, seed), np.zeros(2 * n_parameters(sizes))])
    model = Perceptron(features, classes, sizes, state[:n_parameters(sizes)], means, scales)
    blocks = rows.select(*[F.coalesce(x, F.lit(float("nan"))).alias(x) for x in names], "y", "w").repartition(parts) \
        .mapInArrow(_pack_blocks(len(features), block_rows, means, scales), STATE).persist(StorageLevel.MEMORY_AND_DISK)
    steps, best, gained, history = 0.0, (np.inf, 0), (np.inf, 0), []
    try:
        for r in range(rounds + 1 if n else 0):
            sums = blocks.mapInArrow(_train(sizes, state, steps, r, groups, seed, batch, rate, decay, r < rounds), PART)
            if groups > 1:
                sums = sums.repartition(groups, "grp").sortWithinPartitions("grp", "weight", "theta").mapInArrow(_add_up, PART)
            found = sorted(sums.collect(), key=lambda f: (f.weight, bytes(f.theta)))
            weight, held = sum(f.weight for f in found), sum(f.held for f in found)
            # without held-out rows (fewer than ten in all) the last pass stays
            now = sum(f.loss for f in found) / held if held > 0 else -float(r)
            history.append(now)
            if now < best[0]:
                best, model.theta = (now, r), state[:n_parameters(sizes)].copy()
            if now < gained[0] - tol:
                gained = (now, r)
            elif r - gained[1] >= patience:
                break
            if weight <= 0:
                break
            state = sum(np.frombuffer(f.theta, np.float64) for f in found) / weight
            steps = sum(f.steps for f in found) / weight
    finally:
        blocks.unpersist()
    model.losses, model.best_round = history, best[1]
    return model
