"""Properties of splits, resampling, neighbours and fitted statistics on the fixtures."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from flowaudit.operators import balance as B
from flowaudit.operators import leakage as J
from flowaudit.operators import metrics as E
from flowaudit.operators import splits as S
from flowaudit.operators.duplicates import drop_all_copies, keep_first
from flowaudit.operators.fitted import MedianImputer
from flowaudit.operators.smote import class_knn, smote
from flowaudit.sources.fixtures import DIRTY_FEATURES, flows, flows_dirty, scores, table


def test_three_way_split_disjoint_complete(spark):
    f = flows(spark, SMALL)
    sp = S.three_way_split(f, "label", "flow_id")
    assert sp.count() == f.count()
    assert sp.select("flow_id").distinct().count() == f.count()
    c = {r["split"]: r["count"] for r in sp.groupBy("split").count().collect()}
    n = f.count()
    assert c["test"] == pytest.approx(0.2 * n, abs=8) and c["val"] == pytest.approx(0.2 * n, abs=8)


def test_grouped_and_dedup_splits_do_not_leak(spark):
    d = flows_dirty(spark, SMALL)
    for strategy in ("grouped", "random_deduplicated"):
        sp = S.split(d, strategy, "label", "row_id", DIRTY_FEATURES)
        lk = J.leakage(sp.where("split = 'train'"), sp.where("split = 'test'"), DIRTY_FEATURES).first()
        assert lk["n_leaked"] == 0 and lk["n_test"] > 0
    sp = S.split(d, "random_original", "label", "row_id", DIRTY_FEATURES)
    lk = J.leakage(sp.where("split = 'train'"), sp.where("split = 'test'"), DIRTY_FEATURES).first()
    assert lk["n_leaked"] >= 0


def test_resampling_counts(spark):
    f = flows(spark, SMALL)
    counts = {r["label"]: r["count"] for r in f.groupBy("label").count().collect()}
    u = {r["label"]: r["count"] for r in B.undersample(f, "label", "flow_id").groupBy("label").count().collect()}
    assert set(u.values()) == {min(counts.values())}
    o = {r["label"]: r["count"] for r in B.oversample(f, "label", "flow_id").groupBy("label").count().collect()}
    assert set(o.values()) == {max(counts.values())}
    ws = B.weighted_sample(f, "label", "flow_id")
    assert ws.count() == f.count()


def test_smote_targets_and_segment(spark):
    f = flows(spark, SMALL)
    feats = ["total_fwd_packets", "total_backward_packets", "fwd_packet_length_max"]
    out = smote(f, "label", "flow_id", feats, targets={"Bot": 40, "DDoS": 50})
    c = {r["label"]: r["count"] for r in out.groupBy("label").count().collect()}
    assert c["Bot"] == 40 and c["DDoS"] == 50
    # synthetic points stay inside the class bounding box
    box = f.groupBy("label").agg(*[F.min(x).alias(f"lo_{x}") for x in feats], *[F.max(x).alias(f"hi_{x}") for x in feats])
    syn = out.where("synthetic").join(box, "label")
    bad = syn.where(" OR ".join(f"{x} < lo_{x} - 1e-9 OR {x} > hi_{x} + 1e-9" for x in feats)).count()
    assert bad == 0


def test_class_knn_is_exact(spark):
    e = table(spark, SMALL, "embeddings")
    cols = [f"e{i}" for i in range(16)]
    wide = e.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(cols[i]) for i in range(16)])
    nn = class_knn(wide, "label", "vec_id", cols, k=3, block=8)
    got = {r["vec_id"]: [x["key"] for x in r["nbrs"]] for r in nn.collect()}
    pdf = wide.toPandas()
    for lab, g in pdf.groupby("label"):
        x = g[cols].to_numpy()
        ids = g["vec_id"].to_numpy()
        dist = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
        for i, rid in enumerate(ids):
            order = sorted((dist[i, j], ids[j]) for j in range(len(ids)) if j != i)[:3]
            assert got[rid] == [int(b) for _, b in order]


def test_auc_invariant_to_monotone_map(spark):
    s = scores(spark, SMALL)
    a = E.ranking_metrics(s, "y", "score").first()["roc_auc"]
    b = E.ranking_metrics(s.withColumn("score", F.exp(F.col("score") * 3)), "y", "score").first()["roc_auc"]
    assert a == pytest.approx(b)


def test_fit_on_train_ignores_test_rows(spark):
    s = flows_dirty(spark, SMALL)
    tr = s.where("row_id % 5 < 3")
    m1 = MedianImputer(inputCols=["flow_bytes_s"]).fit(tr).getStats()
    m2 = MedianImputer(inputCols=["flow_bytes_s"]).fit(tr.unionByName(s.limit(0))).getStats()
    assert m1 == m2


def test_drop_all_copies_subset_of_keep_first(spark):
    d = flows_dirty(spark, SMALL)
    keys = DIRTY_FEATURES + ["label", "day"]
    c3 = set(r[0] for r in drop_all_copies(d, keys).select("row_id").collect())
    c4 = set(r[0] for r in keep_first(d, keys, "row_id").select("row_id").collect())
    assert c3 <= c4


def test_threshold_sweep_matches_brute_force(spark):
    s = scores(spark, SMALL).where("split = 'val'")
    sw = {round(r["threshold"], 2): r for r in E.threshold_sweep(s, "y", "score").collect()}
    pdf = s.toPandas()
    for k in (1, 17, 50, 99):
        t = k / 100
        pred = pdf.score >= t
        fp = int(((pdf.y == 0) & pred).sum())
        fn = int(((pdf.y == 1) & ~pred).sum())
        assert sw[round(t, 2)]["fp"] == fp and sw[round(t, 2)]["fn"] == fn
