"""Boosted trees against plain Python, exact attribution against all subsets, and small real runs of the experiments."""

import itertools
import math

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from flowaudit.operators import boosting as B
from flowaudit.operators import explain as XA
from flowaudit.operators import models as M


def frame(spark, n=400, classes=3, seed=0, p=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, p)).round(2)
    y = (x[:, 0] + x[:, 1] * (x[:, 2] > 0) > 0).astype(int) + (classes > 2) * (x[:, 2] > 1.0)
    x[rng.random((n, p)) < 0.05] = np.nan
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r], f"c{k}", 1.0 + i % 3) for i, (r, k) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"f{j} double" for j in range(p)) + ", label string, w double")


FEATS = [f"f{j}" for j in range(4)]


def plain(x, y, w, edges, k, rounds, depth, rate=0.3, reg=1.0, min_child=1.0):
    """Raw scores of the same boosting, one loop per candidate split."""
    raw = np.zeros((len(y), k), np.float32)

    def leaf(g, h):
        return -rate * g / (h + reg)

    def grow(rows, g, h, d):
        G, H = g[rows].sum(), h[rows].sum()
        best = (1e-9, None)
        if d < depth:
            for f in range(x.shape[1]):
                for cut in [*edges[f], np.inf]:
                    left = rows[x[rows, f] <= cut]
                    gl, hl = g[left].sum(), h[left].sum()
                    if hl < min_child or H - hl < min_child:
                        continue
                    gain = gl**2 / (hl + reg) + (G - gl)**2 / (H - hl + reg) - G**2 / (H + reg)
                    if gain > best[0] + 1e-9:
                        best = (gain, (f, cut))
        if best[1] is None:
            return {int(r): leaf(G, H) for r in rows}
        f, cut = best[1]
        down = x[rows, f] <= cut
        return grow(rows[down], g, h, d + 1) | grow(rows[~down], g, h, d + 1)

    for _ in range(rounds):
        g, h = B.gradients(raw.astype(float), y, w)
        new = [grow(np.arange(len(y)), g[:, c], h[:, c], 0) for c in range(k)]
        for c in range(k):
            raw[:, c] += np.array([new[c][i] for i in range(len(y))], np.float32)
    return raw


@pytest.mark.parametrize("classes", [2, 3])
def test_equals_plain_boosting(spark, classes):
    df = frame(spark, classes=classes)
    pdf = df.orderBy("id").toPandas()
    names = sorted(pdf.label.unique())
    k = 1 if classes == 2 else classes
    d = df.withColumn("i", M.class_index(names, "label"))
    edges = B.bin_edges(d, FEATS, 16)
    x, y = pdf[FEATS].to_numpy(float), pdf.label.map(names.index).to_numpy()
    want = plain(x, y, pdf.w.to_numpy(), edges, k, rounds=12, depth=3)
    for block_rows in (1000, 64):                  # one block, and seven that meet level by level
        m = B.fit_boosted(d, FEATS, "i", names, "w", rounds=12, max_depth=3, n_bins=16, block_rows=block_rows)
        assert np.abs(m.raw(x) - want).max() < 1e-4
        probs = np.array([r[0] for r in df.orderBy("id").select(m.probs()).collect()])
        assert np.allclose(probs.sum(axis=1), 1.0) and probs.shape == (400, classes)
    assert (probs.argmax(axis=1) == y).mean() > 0.9
    again = B.BoostedTrees.from_json(m.to_json())
    assert (again.raw(x) == m.raw(x)).all()


def test_passes_walk_no_earlier_round(spark, monkeypatch):
    """The blocks that a round's passes read hold the scores of all rounds before, under a short plan."""
    df = frame(spark, classes=3)
    d = df.withColumn("i", M.class_index(["c0", "c1", "c2"], "label"))
    seen, real = [], B._round

    def spy(state, *args):
        out = real(state, *args)
        plan = state._jdf.queryExecution().analyzed().toString()
        seen.append((sum(float(np.frombuffer(r[0], np.float32).sum()) for r in state.select("raw").collect()), plan.count("\n")))
        return out
    monkeypatch.setattr(B, "_round", spy)
    m = B.fit_boosted(d, FEATS, "i", ["c0", "c1", "c2"], rounds=13, max_depth=2, n_bins=16, block_rows=64)
    x = df.select(*FEATS).toPandas().to_numpy(float)
    for r, (total, lines) in enumerate(seen):
        first = B.BoostedTrees(m.features, m.classes, m.start, m.rounds[:r])
        assert abs(first.raw(x).sum() - total) < 1e-2 and lines <= B.CUT + 1
    assert len(seen) == 13


def test_weights_are_copies(spark):
    df = frame(spark, 200, 2)
    a = M.fit(df.withColumn("w", F.lit(2.0)), FEATS, "label", "gbt", weight_col="w", maxIter=3, maxDepth=2)
    b = M.fit(df.unionAll(df), FEATS, "label", "gbt", maxIter=3, maxDepth=2)
    x = df.select(*FEATS).toPandas().to_numpy(float)
    assert np.allclose(a.boosted.raw(x), b.boosted.raw(x))


def test_early_stopping_and_unseen_classes(spark):
    df = frame(spark, 300, 2).withColumn("val", F.col("id") % 3 == 0)
    df = df.withColumn("label", F.when(F.col("id") % 30 == 0, "only in validation").when(
        F.col("id") % 5 == 0, F.concat(F.lit("c"), (F.col("id") % 2).cast("string"))).otherwise(F.col("label")))
    m = M.fit(df, FEATS, "label", "gbt", maxIter=200, maxDepth=4, validationIndicatorCol="val", patience=10)
    b = m.boosted
    assert m.classes == ["c0", "c1"] and len(b.losses) < 200
    assert len(b.losses) - 1 - b.best_round == 10 and len(b.rounds) == b.best_round == int(np.argmin(b.losses))
    kept = M.drop_unseen_classes(df.where("val"), df.where("NOT val"), "label")
    assert kept.where("label = 'only in validation'").isEmpty() and kept.columns == df.columns


def test_edge_tables(spark):
    df = frame(spark, 60, 2)
    one = M.fit(df.withColumn("label", F.lit("c0")), FEATS, "label", "gbt", maxIter=2)
    assert one.score(df).select("y_pred", F.size("probs")).distinct().collect() == [("c0", 1)]
    empty = B.fit_boosted(df.where("false").withColumn("i", F.lit(0.0)), FEATS, "i", ["a", "b"], rounds=2)
    assert df.limit(1).select(empty.probs()).first()[0] == [0.5, 0.5]
    with pytest.raises(ValueError):
        B.fit_boosted(df.withColumn("i", F.lit(0.0)), FEATS, "i", ["a", "b"], n_bins=255)


def test_attribution_equals_all_subsets(spark):
    p = 8
    df = frame(spark, 300, 3, p=p)
    feats = [f"f{j}" for j in range(p)]
    m = M.fit(df, feats, "label", "gbt", maxIter=3, maxDepth=5)
    x = df.orderBy("id").select(*feats).toPandas().to_numpy(float)[:4]

    def worth(tree, row, known, node=0):
        f = tree["feature"][node]
        if f < 0:
            return tree["value"][node]
        a, b = tree["left"][node], tree["right"][node]
        if f in known:
            return worth(tree, row, known, a if row[f] <= tree["threshold"][node] else b)
        return sum(tree["cover"][c] / tree["cover"][node] * worth(tree, row, known, c) for c in (a, b))

    cls = 2
    got, base = B.shapley(m.boosted, x, cls)
    assert np.allclose(got.sum(axis=1) + base, m.boosted.raw(x)[:, cls])
    for i, row in enumerate(x):
        v = {s: sum(worth(t[cls], row, s) for t in m.boosted.rounds)
             for n in range(p + 1) for s in itertools.combinations(range(p), n)}
        for f in range(p):
            want = sum(math.factorial(len(s)) * math.factorial(p - len(s) - 1) / math.factorial(p)
                       * (v[tuple(sorted((*s, f)))] - v[s]) for s in v if f not in s)
            assert abs(got[i, f] - want) < 1e-9
    out = XA.tree_attribution(m, df.where("id < 4"), "id", cls).collect()
    assert len(out) == 4 * p and all(abs(got[r["id"], feats.index(r["feature"])] - r["contribution"]) < 1e-9 for r in out)


def test_attribution_of_many_rows(spark, monkeypatch):
    """Many rows are explained by the ways to meet a leaf's conditions, with the values that few rows get."""
    df = frame(spark, 300, 2, p=5)
    feats = [f"f{j}" for j in range(5)]
    m = M.fit(df, feats, "label", "gbt", maxIter=4, maxDepth=4).boosted
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 5)).round(2)
    x[rng.random(x.shape) < 0.1] = np.nan
    x[rng.random(x.shape) < 0.05] = np.inf
    few = np.concatenate([B.shapley(m, x[i:i + 2])[0] for i in range(0, 500, 2)])
    worked, real = [], B._gains
    monkeypatch.setattr(B, "_gains", lambda o, z, values: worked.append(o.shape) or real(o, z, values))
    many, base = B.shapley(m, x)
    assert np.abs(many - few).max() < 1e-12 and np.allclose(many.sum(axis=1) + base, m.raw(x)[:, 0])
    assert worked and all(ways <= 2 ** d for ways, _, d in worked)


def test_permutation_importance_equals_plain(spark):
    df = frame(spark, 150, 2).withColumn("key", F.concat(F.lit("k"), F.col("id").cast("string"))) \
        .withColumn("label", F.substring("label", 2, 1))
    m = M.fit(df, FEATS, "label", "gbt", maxIter=5, maxDepth=3)
    got = {r["feature"]: r for r in XA.permutation_importance(m, df, FEATS, "label", "key", repeats=3, seed=7).collect()}
    import hashlib
    pdf = df.withColumn("h", F.xxhash64("key")).withColumns({f"h{r}": F.xxhash64("key", F.lit(r)) for r in range(3)}).toPandas()
    x, y = pdf[FEATS].to_numpy(float), (pdf.label == "1").to_numpy()
    order = lambda col, seed: np.argsort([hashlib.md5(f"{seed}-{v}".encode()).hexdigest() for v in pdf[col]])     # noqa: E731

    def f1(z):
        pred = m.boosted.raw(z)[:, 0] > 0
        return 2 * (pred & y).sum() / (pred.sum() + y.sum())
    donors = order("h", 7)
    for j, f in enumerate(FEATS):
        drops = []
        for r in range(3):
            z = x.copy()
            z[order(f"h{r}", 8), j] = x[donors, j]
            drops.append(f1(x) - f1(z))
        assert abs(got[f]["importance_mean"] - np.mean(drops)) < 1e-9 and abs(got[f]["importance_std"] - np.std(drops)) < 1e-9


def test_experiments_run(spark):
    from flowaudit.plans import experiments as XP
    from flowaudit.sources.fixtures import FLOW_FEATURES, flows
    f = flows(spark, SMALL)
    out = XP.ablation(f, FLOW_FEATURES, "label", "flow_id", maxIter=2, maxDepth=2, parallelism=3).collect()
    assert [r["recipe"] for r in out] == XP.ABLATION_RECIPES and all(0 <= r["f1_macro"] <= 1 for r in out)
    out = XP.imbalance_ablation(f, FLOW_FEATURES, "label", "flow_id", maxIter=2, maxDepth=2, parallelism=3).collect()
    assert [r["strategy"] for r in out] == XP.IMBALANCE_STRATEGIES and all(0 <= r["pr_auc"] <= 1 for r in out)


def test_whole_fit_equals_levels(spark, monkeypatch):
    """A table of several blocks is fitted by one task in one job, and gives the trees of the job per level,
    whether the driver adds a level's sums up or tasks do; the marked rows end both alike."""
    df = frame(spark, classes=3).withColumn("val", F.col("id") % 4 == 0)
    d = df.withColumn("i", M.class_index(["c0", "c1", "c2"], "label"))
    x = df.select(*FEATS).toPandas().to_numpy(float)

    def fitted(**more):
        return B.fit_boosted(d, FEATS, "i", ["c0", "c1", "c2"], "w", rounds=12, max_depth=3, n_bins=16, block_rows=64,
                             validation_col="val", patience=3, **more)
    levels, real = [], B._round
    monkeypatch.setattr(B, "_round", lambda *args: levels.append(1) or real(*args))
    whole = fitted(whole_rows=1000)
    assert not levels and len(whole.rounds) > 3
    there = fitted()
    monkeypatch.setattr(B, "DRIVER_BYTES", 0)
    apart = fitted()
    assert len(levels) >= 2 * len(whole.losses)
    for other in (there, apart):
        assert other.best_round == whole.best_round and np.allclose(other.losses, whole.losses)
        assert np.abs(other.raw(x) - whole.raw(x)).max() < 1e-4
