"""M3: the forest that finishes small nodes where their rows meet."""

import numpy as np
import pytest

from flowaudit.operators import forest as R
from flowaudit.operators import models as M

K = 3


def _rows(n=600, seed=1):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.normal(size=n), rng.integers(0, 4, n), rng.normal(size=n)], 1)
    y = ((x[:, 0] > 0.3).astype(int) + (x[:, 1] == 2) + (rng.random(n) < .15)) % K
    return x, y


def _frame(spark, x, y):
    return spark.createDataFrame([(i, *map(float, r), "abc"[c]) for i, (r, c) in enumerate(zip(x, y))],
                                 "id long, u double, v double, w double, y string")


def _plain(bins, y, w, depth):
    """The same tree by recursion over rows: (feature, cut, left, right) or the class weights of a leaf."""
    count = np.bincount(y, w, K)
    gini = lambda s: (s ** 2).sum() / s.sum()                                                        # noqa: E731
    best = (0.0,)
    for f in range(len(bins)) if depth and count.max() < count.sum() else ():
        for c in np.unique(bins[f])[:-1]:
            low = bins[f] <= c
            gain = gini(np.bincount(y[low], w[low], K)) + gini(np.bincount(y[~low], w[~low], K)) - gini(count)
            if gain > best[0] + 1e-9:
                best = (gain, f, c, low)
    if len(best) == 1:
        return count
    _, f, c, low = best
    a, b = (_plain(bins[:, s], y[s], w[s], depth - 1) for s in (low, ~low))
    if isinstance(a, np.ndarray) and isinstance(b, np.ndarray) and a.argmax() == b.argmax():
        return count
    return f, c, a, b


def _of(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree / tree.sum()


@pytest.mark.parametrize("local", [10 ** 6, 40])
@pytest.mark.parametrize("depth", [0, 3, 30])
def test_a_whole_tree_is_the_plain_one(spark, local, depth):
    x, y = _rows()
    df = M.class_index(list("abc"), "y")
    df = _frame(spark, x, y).withColumn("i", df)
    one = R.fit_forest(df, ["u", "v", "w"], "i", list("abc"), trees=1, max_depth=depth, bootstrap=False, local=local, block_rows=100)
    assert (len(one.tops[0].feature) > 1) == (local == 40 and depth > 0)
    assert [len(e) for e in one.edges] == [31, 3, 31]
    known = R._bins(x.T, one.edges)
    x[::41, 2] = np.nan                                      # missing values are scored, by the higher side of every cut
    df = _frame(spark, x, y)
    bins = R._bins(x.T, one.edges)
    want = _plain(known, y, np.ones(len(y)), depth)
    got = {r.id: r.probs for r in one.with_probs(df).select("id", "probs").collect()}
    assert len(got) == len(x)
    assert all(got[i] == pytest.approx(_of(want, bins[:, i])) for i in range(len(x)))


def test_cells_and_sorted_rows_give_the_same_cuts():
    rng = np.random.default_rng(3)
    node, bins, y = rng.integers(0, 5, 700), rng.integers(0, R.BINS, 700), rng.integers(0, K, 700)
    w = rng.integers(1, 4, 700).astype(float)
    counts = np.stack([np.bincount(y[node == i], w[node == i], K) for i in range(5)])
    dense = R._candidates(node, bins, y, w, counts)
    many = np.zeros((700, K))                                # nodes without rows make the cells too many
    many[:5] = counts
    sparse = R._candidates(node, bins, y, w, many)
    for a, b in zip(dense, sparse):
        assert np.allclose(a, b[:5])
    assert (sparse[0][5:] == -np.inf).all()


def test_forest_learns_with_tops_shares_and_weights(spark, monkeypatch):
    monkeypatch.setattr(R, "SHARE", 100)
    x, y = _rows(900)
    df = _frame(spark, x, y).withColumn("i", M.class_index(list("abc"), "y")).selectExpr("*", "1.0 + id % 3 AS wt")
    f = R.fit_forest(df, ["u", "v", "w"], "i", list("abc"), "wt", trees=15, max_depth=8, local=100, block_rows=200)
    assert any(len(t.feature) > 1 for t in f.tops)
    assert f.importances.sum() == pytest.approx(1) and f.importances.argmin() == 2
    got = sorted(f.with_probs(df).select("id", "probs").collect())
    assert len(got) == 900 and all(sum(r.probs) == pytest.approx(1) for r in got)
    assert np.mean([np.argmax(r.probs) == c for r, c in zip(got, y)]) > .8
    assert got == sorted(f.with_probs(df).select("id", "probs").collect())
    text = R.Forest.from_json(f.to_json())
    assert got == sorted(text.with_probs(df).select("id", "probs").collect())


def test_saved_forest_scores_alike(spark, tmp_path):
    x, y = _rows(200)
    df = _frame(spark, x, y)
    m = M.fit(df, ["u", "v", "w"], "y", "forest", numTrees=4, maxDepth=5)
    assert m.forest is not None and not m.pipelines          # no model that is whole on the driver
    m.save(str(tmp_path / "m"))
    back = M.FlowModel.load(str(tmp_path / "m"))
    assert sorted(back.score(df, keep=["id"]).collect()) == sorted(m.score(df, keep=["id"]).collect())
    assert back.importances() == m.importances()


def test_one_class_is_one_leaf(spark):
    df = spark.createDataFrame([(float(i), "a") for i in range(20)], "u double, y string")
    m = M.fit(df, ["u"], "y", "forest", numTrees=3, maxDepth=5)
    assert {(r.y_pred, r.score) for r in m.score(df).collect()} == {("a", 1.0)}
    assert m.importances() == [("u", 0.0)]


@pytest.mark.parametrize("value", [float("nan"), float("inf"), None])
def test_training_values_must_be_finite(spark, value):
    df = spark.createDataFrame([(float(i), "ab"[i % 2]) for i in range(20)] + [(value, "a")], "u double, y string")
    with pytest.raises(ValueError, match="1 of 21"):
        M.fit(df, ["u"], "y", "forest", numTrees=3, maxDepth=5)
