"""Literal cases for faults found in review: constants, scales, lone classes, caps, row ids."""

import math

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from flowaudit.functions.rowwise import engineered_features
from flowaudit.operators import correlation as K
from flowaudit.operators import metrics as E
from flowaudit.operators import models as M
from flowaudit.operators import profile as A
from flowaudit.operators import splits as S
from flowaudit.operators.smote import class_knn, smote
from flowaudit.plans import audit
from flowaudit.sources.flows import content_ids, read_flows


def test_pearson_of_constants_is_undefined(spark):
    rng = np.random.default_rng(0)
    rows = [(0.1, 0.3 if i % 2 else None, float(v), float(v) * 2e9 + 5, float(i % 7) if i % 2 else 3.0)
            for i, v in enumerate(rng.standard_normal(20011))]
    df = spark.createDataFrame(rows, "a double, b double, x double, y double, z double").repartition(7)
    r = K.pearson_matrix(df, df.columns)
    assert np.isnan(r[0]).all() and np.isnan(r[:, 0]).all() and np.isnan(r[1, [0, 1, 2]]).all()
    assert r[2, 3] == pytest.approx(1.0) and abs(r[2, 4]) < 0.05
    assert K.correlated_to_drop(df.columns, r, 0.95, "abs_later") == ["y"]
    # constant on the rows it shares with the other column only
    few = spark.createDataFrame([(7.3, 1.0), (7.3, 2.0), (9.0, None), (7.3, 5.0)], "p double, q double")
    assert np.isnan(K.pearson_matrix(few, ["p", "q"])[0, 1])


def test_vif_does_not_depend_on_units(spark):
    rng = np.random.default_rng(1)
    n = 4000
    x = np.stack([rng.exponential(1.2e8, n), rng.integers(1, 20, n), rng.integers(0, 2, n), rng.exponential(1e9, n)], axis=1)
    want = [float(v) for v in np.diag(x.T @ x) * np.diag(np.linalg.inv((x / x.std(0)).T @ (x / x.std(0)))) / x.std(0) ** 2]
    df = spark.createDataFrame(x.tolist(), "a double, b double, c double, d double")
    got = {r.feature: r.vif for r in K.vif(df, df.columns).collect()}
    assert [got[c] for c in "abcd"] == pytest.approx(want, rel=1e-6)
    tied = df.withColumn("e", F.col("a") * 3).withColumn("f", F.lit(0.0))
    got = {r.feature: r.vif for r in K.vif(tied, tied.columns).collect()}
    assert got["a"] == got["e"] == got["f"] == math.inf and got["b"] < 10


@pytest.mark.parametrize("kind", ["logreg", "tree", "forest"])
def test_probabilities_match_classes_and_scoring_needs_no_label(spark, kind):
    rows = [(i, float(i % 10), float(i * 7 % 11), str(int(i % 10 > 4))) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, u double, v double, y string")
    m = M.fit(df, ["u", "v"], "y", kind, maxIter=20, numTrees=3, maxDepth=4)
    got = m.score(df.drop("y"), keep=["id"]).collect()
    assert all(len(r.probs) == len(m.classes) == 2 and r.y_true is None for r in got)
    assert all(r.y_pred == rows[r.id][3] for r in got)


def test_operational_projection_reproduces_published_counts(spark):
    rows = [(3199, 1, 125, 675), (3197, 3, 99, 701), (3186, 14, 62, 738)]
    got = [tuple(r)[4:] for r in E.operational_projection(
        spark.createDataFrame(rows, "tn long, fp long, fn long, tp long")).orderBy("fp").collect()]
    assert got == [(3125.0, 312500.0, 46875.0), (9375.0, 247500.0, 140625.0), (43750.0, 155000.0, 656250.0)]


def test_smote_small_classes(spark):
    rows = [(i, "A", float(i), 1.0) for i in range(10)] + [(100, "B", 5.0, 2.0)]
    df = spark.createDataFrame(rows, "id long, y string, u double, v double")
    with pytest.raises(ValueError, match="one row"):
        smote(df, "y", "id", ["u", "v"])
    nn = {r.id: len(r.nbrs) for r in class_knn(df, "y", "id", ["u", "v"], k=3).collect()}
    assert nn.pop(100) == 0 and set(nn.values()) == {3} and len(nn) == 10


def test_every_row_gets_neighbours(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(i, "A", *map(float, v)) for i, v in enumerate(rng.standard_normal((300, 8)))],
                               "id long, y string, " + ", ".join(f"c{k} double" for k in range(8)))
    assert class_knn(df, "y", "id", [f"c{k}" for k in range(8)], k=5, block=16).count() == 300


def test_days_outside_the_week_fail(spark):
    df = spark.createDataFrame([(1, "Monday"), (2, "Friday")], "id int, day string")
    assert {r.split for r in S.chronological_split(df, "day").collect()} == {"train", "test"}
    with pytest.raises(PySparkException, match="Sunday"):
        S.chronological_split(df.withColumn("day", F.lit("Sunday")), "day").collect()


def test_near_constant_needs_a_share(spark):
    with pytest.raises(ValueError):
        A.near_constant_columns(spark.range(3), ["id"], share=0.0)


def test_combined_flags_need_all_flags():
    assert "eng_combined_flags" not in engineered_features({"fin_flag_count", "syn_flag_count"})


def test_load_flows_keeps_every_row_with_stable_ids(spark, tmp_path):
    head = " Flow Duration, Label\n"
    (tmp_path / "Monday-a.csv").write_text(head + "1,BENIGN\n" * 30 + "2,Bot\n")
    (tmp_path / "Friday-b.csv").write_text(head + "".join(f"{i},BENIGN\n" for i in range(40)))
    a = audit.load_flows(spark, str(tmp_path))
    assert a.count() == 71 and a.select("row_id").distinct().count() == 71
    assert a.where("Label = 'Bot'").count() == 1
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        b = audit.load_flows(spark, str(tmp_path))
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert audit.load_flows(spark, str(tmp_path), sample_frac=0.5).where("Label = 'Bot'").count() == 0
    known = read_flows(spark, str(tmp_path), header=head.strip("\n"))
    assert known.count() == 71 and sorted(known.columns) == sorted(read_flows(spark, str(tmp_path)).columns)


def test_content_ids_number_equal_rows(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    assert content_ids(df).select("row_id").distinct().count() == 3


def _small(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(240):
        y = ["BENIGN", "Bot", "DDoS"][0 if i % 8 < 5 else 1 if i % 8 < 7 else 2]
        rows.append((i, y, float(rng.normal("BBD".index(y[0]) * 2, 1)), float(i % 13), float(rng.exponential(2000)), 0.1))
    rows += [(900, "Rare", 1.0, 1.0, 1.0, 0.1)]
    return spark.createDataFrame(rows, "id long, label string, u double, v double, w double, k double").coalesce(2).cache()


def test_ablation_recipes_and_grid(spark):
    from flowaudit.plans import experiments as XP
    df = _small(spark)
    out = XP.ablation(df, ["u", "v", "w", "k"], "label", "id", model_kind="tree", maxDepth=3, parallelism=3).collect()
    assert [r.recipe for r in out] == XP.ABLATION_RECIPES
    n = {r.recipe: r.n_features for r in out}
    assert n["original"] == 4 and n["cleaned"] == n["reduced"] == 3
    assert all(0 <= r.f1_macro <= 1 and r.inference_seconds >= 0 for r in out)
    out = XP.imbalance_ablation(df, ["u", "v", "w"], "label", "id", model_kind="mlp", strategies=XP.PAPER_STRATEGIES,
                                parallelism=3, hidden=[4], maxIter=3).collect()
    assert [r.strategy for r in out] == XP.PAPER_STRATEGIES


def test_empty_split_parts_are_reported(spark):
    from flowaudit.plans import experiments as XP
    df = _small(spark).withColumn("day", F.lit("Monday"))
    out = XP.split_strategy_experiment(df, ["u", "v"], "label", "id", {"T": ("tree", {"maxDepth": 2})},
                                       strategies=["random_original", "chronological"]).collect()
    assert [r.strategy for r in out] == ["random_original", "chronological"]
    assert out[1].accuracy is None and out[0].accuracy > 0


def test_balanced_and_projected_parts(spark, tmp_path):
    from flowaudit.plans import paper
    from flowaudit.sources.store import read_split
    rng = np.random.default_rng(3)
    rows = [(i, ["Benign", "Bot"][i % 10 == 0], *map(float, rng.normal(i % 10 == 0, 1, 3))) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, label_category string, a double, b double, c double")
    out, _, enc = paper.prepare_paper_split(df, ["a", "b", "c"], "id", str(tmp_path / "s"), n_quantiles=20,
                                            balance=({"Benign": 100}, {"Bot": 100}))
    balanced = read_split(spark, str(tmp_path / "s"), "train", balanced=True)
    assert {r["label"]: r["count"] for r in balanced.groupBy("label").count().collect()} == {0: 100, 1: 100}
    plain = read_split(spark, str(tmp_path / "s"), "train")
    assert plain.count() == out.where("split = 'train'").count() < 400
    paper.write_projected_split(out, ["a", "b", "c"], "id", str(tmp_path / "p"))
    back = read_split(spark, str(tmp_path / "p"), "test")
    assert back.count() == out.where("split = 'test'").count() and any(c.startswith("pc") for c in back.columns)
