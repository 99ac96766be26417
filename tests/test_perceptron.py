"""M7: the perceptron against numeric gradients, on separable data, with weights, and saved."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowaudit.operators import models as M
from flowaudit.operators import perceptron as P


def test_gradient_equals_differences():
    rng = np.random.default_rng(0)
    sizes = [3, 5, 4, 3]
    theta = P.start_parameters(sizes, 1) + rng.normal(0, 0.1, P.n_parameters(sizes))
    x, y, w = rng.normal(size=(20, 3)), rng.integers(0, 3, 20), rng.random(20) + 0.1

    def loss(t):
        fit = (P.losses(P.forward(t, sizes, x)[-1], y) * w).sum() / w.sum()
        return fit + 0.01 / 2 * sum((a ** 2).sum() for a, _ in P.layer_views(t, sizes))
    got = P.gradient(theta, sizes, x, y, w, 0.01)
    for i in range(0, len(theta), 3):
        e = np.zeros_like(theta)
        e[i] = 1e-6
        assert got[i] == pytest.approx((loss(theta + e) - loss(theta - e)) / 2e-6, abs=1e-6)


def _rings(spark, n=3000, parts=3):
    rng = np.random.default_rng(5)
    r, a = rng.integers(0, 3, n), rng.random(n) * 2 * np.pi
    rad = 1.0 + 2.0 * r + rng.normal(0, 0.15, n)
    rows = [(int(i), float(1e6 * u), float(v), "abc"[k]) for i, (u, v, k) in enumerate(zip(rad * np.cos(a), rad * np.sin(a), r))]
    return spark.createDataFrame(rows, "id long, u double, v double, y string").repartition(parts)


def test_learns_rings_over_several_blocks_and_survives_saving(spark, tmp_path):
    df = _rings(spark)
    m = M.fit(df, ["u", "v"], "y", "mlp", hidden=[24, 16], maxIter=60, block_rows=400, rate=0.01, batch=32)
    assert m.net.losses[m.net.best_round] == min(m.net.losses) < 0.2 < m.net.losses[0]
    got = m.score(df, keep=["id"]).select("*", F.aggregate("probs", F.lit(0.0), lambda a, b: a + b).alias("s")).collect()
    assert np.mean([r.y_true == r.y_pred for r in got]) > 0.95
    assert all(r.s == pytest.approx(1.0) for r in got)
    m.save(str(tmp_path / "m"))
    back = M.FlowModel.load(str(tmp_path / "m")).score(df, keep=["id"])
    assert {r.id: r.probs for r in back.collect()} == {r.id: r.probs for r in got}


def test_weights_count_like_copies_and_zero_weights_not_at_all(spark):
    # one input value, so the best network gives the weighted class shares
    rows = [(1.0, "a", 3.0)] * 300 + [(1.0, "b", 1.0)] * 300 + [(1.0, "c", 0.0)] * 200 + [(1.0, "c", None)] * 50
    df = spark.createDataFrame(rows, "x double, y string, w double").repartition(4)
    m = M.fit(df, ["x"], "y", "mlp", weight_col="w", hidden=[4], maxIter=80, rate=0.05, batch=50, tol=0.0)
    a, b, c = m.score(df).first().probs
    assert a == pytest.approx(0.75, abs=0.03) and b == pytest.approx(0.25, abs=0.03) and c < 0.02


def test_missing_infinite_few_and_no_rows(spark):
    rows = [(float("nan"), 1.0, "a"), (float("inf"), None, "b"), (2.0, 2.0, "a"), (None, -1.0, "b")]
    df = spark.createDataFrame(rows, "u double, v double, y string")
    m = M.fit(df, ["u", "v"], "y", "mlp", hidden=[3], maxIter=2)
    assert m.net.best_round == 2          # fewer than ten rows: nothing held out, the last pass stays
    assert all(np.isfinite(r.probs).all() for r in m.score(df).collect())
    one = M.fit(df.where("y = 'a'"), ["u", "v"], "y", "mlp", hidden=[3], maxIter=2)
    assert one.score(df).first().probs == [1.0]
    none = P.fit_perceptron(df.where("false").withColumn("k", F.lit(0)), ["u", "v"], "k", ["a", "b"], hidden=[3])
    assert none.losses == [] and np.isfinite(none.theta).all()
