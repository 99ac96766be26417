"""Experiments do shared work once; the perceptron's steps in place are the plain ones, bit by bit."""

import numpy as np
import pytest

from flowaudit.operators import perceptron as P
from flowaudit.plans import experiments as XP


def rows(spark, n=240):
    sizes = {"BENIGN": 0.6, "Bot": 0.25, "DDoS": 0.15}
    rng = np.random.default_rng(3)
    labels = rng.choice(list(sizes), n, p=list(sizes.values()))
    return spark.createDataFrame([(i, str(c), float(rng.normal() + len(c)), float(rng.normal())) for i, c in enumerate(labels)],
                                 "id long, label string, a double, b double")


def counted(monkeypatch, name):
    calls, real = [], getattr(XP, name)

    def count(*a, **k):
        calls.append(name)
        return real(*a, **k)
    monkeypatch.setattr(XP, name, count)
    return calls


def test_a_fold_has_one_chain_for_all_models(spark, monkeypatch):
    calls = counted(monkeypatch, "prepare")
    models = {"a": ("tree", {"maxDepth": 2}), "b": ("tree", {"maxDepth": 3})}
    results, ci = XP.cross_validate(rows(spark), ["a", "b"], "label", "id", models, k=2, bootstrap_iterations=5, parallelism=2)
    assert len(calls) == 2
    assert [r["model"] for r in results.collect()] == [r["model"] for r in ci.collect()] == ["a", "b"]
    alone = XP.cross_validate(rows(spark), ["a", "b"], "label", "id", {"b": models["b"]}, k=2, bootstrap_iterations=5)
    for both, one in zip((results, ci), alone):
        b, o = both.where("model = 'b'").drop("fit_seconds").first(), one.drop("fit_seconds").first()
        assert b.asDict() == pytest.approx(o.asDict())


def test_grown_rows_are_made_once_for_all_strategies(spark, monkeypatch):
    calls = counted(monkeypatch, "smote")
    out = XP.imbalance_ablation(rows(spark), ["a", "b"], "label", "id", model_kind="tree", maxDepth=3, parallelism=2,
                                strategies=["undersample_smote", "undersample_smote_class_weight"]).collect()
    assert len(calls) == 1 and len(out) == 2


@pytest.mark.parametrize("sizes", [[3, 8, 4], [2, 5, 6, 3], [4, 2]])
def test_steps_in_place_are_the_plain_steps(sizes):
    rng, decay, rate = np.random.default_rng(1), 1e-3, 1e-2
    x, y, w = rng.normal(size=(53, sizes[0])), rng.integers(0, sizes[-1], 53).astype(np.int32), rng.random(53)
    theta = P.start_parameters(sizes, 5)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    here, mh, vh = theta.copy(), m.copy(), v.copy()
    steps, t = P.Steps(here, sizes, decay, 20, mh, vh), 0
    for at in range(0, 53, 20):                       # the last batch is a short one
        xs, ys, ws = x[at:at + 20], y[at:at + 20], w[at:at + 20]
        acts, layers, g = P.forward(theta, sizes, xs), P.layer_views(theta, sizes), np.zeros_like(theta)
        delta = acts[-1].copy()
        delta[np.arange(len(ys)), ys] -= 1.0
        delta *= (ws / ws.sum())[:, None]
        for i in range(len(layers) - 1, -1, -1):
            gw, gb = P.layer_views(g, sizes)[i]
            gw[:], gb[:] = acts[i].T @ delta + decay * layers[i][0], delta.sum(axis=0)
            if i:
                delta = (delta @ layers[i][0].T) * (acts[i] > 0)
        assert np.array_equal(g, P.gradient(theta, sizes, xs, ys, ws, decay))
        t += 1
        m += 0.1 * (g - m)
        v += 0.001 * (g * g - v)
        theta -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        steps.step(xs, ys, ws, t, rate)
        assert np.array_equal(theta, here) and np.array_equal(m, mh) and np.array_equal(v, vh)
