"""Literal frames with hand-computed answers (NULL/NaN/Inf/-0.0, ties, zero division, one class)."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from flowaudit.functions import labels as L
from flowaudit.operators import correlation as K
from flowaudit.operators import duplicates as U
from flowaudit.operators import metrics as E
from flowaudit.operators import profile as A
from flowaudit.schema import FlowSchema

NAN, INF = float("nan"), float("inf")


def test_tiny_null_distinct_and_null_safe(spark):
    rows = [(1, NAN), (1, NAN), (2, None), (2, None), (0, -0.0), (0, 0.0), (3, INF)]
    df = spark.createDataFrame(rows, "k int, x double")
    assert df.distinct().count() == 4
    sch = FlowSchema(("x",), label="k", day=None)
    assert U.exact_duplicate_count(df, sch).first()[0] == 3
    m = A.missing_counts(df, ["x"]).first()
    assert m["n_missing"] == 4
    assert A.inf_counts(df, ["x"]).first()["n_inf"] == 1


def test_tiny_cm_metrics(spark):
    # 3 classes, class 'c' never predicted
    pairs = [("a", "a")] * 3 + [("a", "b")] + [("b", "b")] * 2 + [("b", "a")] + [("c", "a"), ("c", "b"), ("c", "b")]
    df = spark.createDataFrame(pairs, "y string, p string")
    rep = {r["class"]: r for r in E.per_class_report(df, "y", "p").collect()}
    assert rep["a"]["precision"] == pytest.approx(3 / 5)
    assert rep["a"]["recall"] == pytest.approx(3 / 4)
    assert rep["c"]["precision"] == 0.0 and rep["c"]["recall"] == 0.0 and rep["c"]["f1"] == 0.0
    s = E.summary_metrics(df, "y", "p").first()
    assert s["accuracy"] == pytest.approx(5 / 10)
    # MCC (multiclass): c*s - sum p_k t_k over sqrt(...)
    t = {"a": 4, "b": 3, "c": 3}
    p = {"a": 5, "b": 5, "c": 0}
    c, n = 5, 10
    num = c * n - sum(p[k] * t[k] for k in t)
    den = math.sqrt((n * n - sum(v * v for v in p.values())) * (n * n - sum(v * v for v in t.values())))
    assert s["mcc"] == pytest.approx(num / den)
    assert s["balanced_accuracy"] == pytest.approx((3 / 4 + 2 / 3 + 0) / 3)
    cm = E.confusion_matrix(df, "y", "p")
    assert cm.count() == 9 and cm.where("cnt = 0").count() == 3


def test_tiny_ties_ranking(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.8, 1), (0.8, 1), (0.1, 0)], "s double, y int")
    r = E.ranking_metrics(df, "y", "s").first()
    # positives 3, negatives 2; pairs: (0.9 vs 0.8) win, (0.9 vs 0.1) win, each 0.8-pos vs 0.8-neg tie, vs 0.1 win
    assert r["roc_auc"] == pytest.approx((2 + 2 * (0.5 + 1)) / 6)
    # AP: threshold 0.9: P=1, R=1/3 ; threshold 0.8: P=3/4, R=1
    assert r["pr_auc"] == pytest.approx(1 / 3 * 1 + 2 / 3 * 0.75)


def test_tiny_oneclass(spark):
    df = spark.createDataFrame([(0, 0, 0.2), (0, 1, 0.7), (0, 0, 0.1)], "y int, p int, s double")
    c = E.binary_from_counts(E.binary_counts(df, "y", "p")).first()
    assert c["fnr"] == 0.0 and c["mcc"] == 0.0 and c["far"] == pytest.approx(1 / 3)
    r = E.ranking_metrics(df, "y", "s").first()
    assert math.isnan(r["roc_auc"]) and math.isnan(r["pr_auc"])


def test_tiny_chain_drop_policies(spark):
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=400), rng.normal(size=400)
    a, b, c = x + 0.75 * y, x + y, 0.75 * x + y
    d = -c + 0.01 * rng.normal(size=400)
    pdf = pd.DataFrame({"a": a, "b": b, "c": c, "d": d})
    df = spark.createDataFrame(pdf)
    cols = ["a", "b", "c", "d"]
    r = K.pearson_matrix(df, cols)
    assert np.allclose(r, pdf.corr().values, atol=1e-9)
    keep = lambda drop: [c for c in cols if c not in drop]
    assert keep(K.correlated_to_drop(cols, r, 0.98, "signed_earlier")) == ["c", "d"]
    assert keep(K.correlated_to_drop(cols, r, 0.95, "abs_later")) == ["a"]
    assert keep(K.correlated_to_drop(cols, r, 0.95, "abs_earlier")) == ["d"]


def test_tiny_labels(spark):
    df = spark.createDataFrame([("Web Attack � XSS",), ("Web Attack  XSS",), ("Web Attack - XSS",),
                                (" BENIGN ",)], "l string")
    out = df.select(L.normalise_label("l").alias("l")).select(
        "l", L.label_family("l").alias("f"), L.binary_label("l").alias("b")).collect()
    assert [r["l"] for r in out] == ["Web Attack - XSS"] * 3 + ["BENIGN"]
    assert [r["f"] for r in out] == ["Web Attack"] * 3 + ["Benign"]
    assert [r["b"] for r in out] == [1, 1, 1, 0]
    scrub = df.select(L.ascii_scrub("l").alias("s")).first()["s"]
    assert scrub == "Web Attack - XSS"
    with pytest.raises(Exception):
        spark.createDataFrame([("Unknown",)], "l string").select(L.label_family("l")).collect()


def test_tiny_csv(spark, tmp_path):
    from flowaudit.sources.flows import read_flows
    d = tmp_path / "flows"
    d.mkdir()
    (d / "Monday-WorkingHours.csv").write_text(
        " Flow Duration, Fwd Header Length, Fwd Header Length, Flow Bytes/s, Label\n"
        "10,1,1,Infinity,BENIGN\n20,2,2,NaN,BENIGN\n30,3,3,,BENIGN\n40,4,4,junk,BENIGN\n")
    (d / "Tuesday-WorkingHours.csv").write_text(
        " Label, Flow Bytes/s, Flow Duration, Fwd Header Length, Fwd Header Length\n"
        "FTP-Patator,1.5,50,5,5\n")
    df = read_flows(spark, str(d), names="snake", label="Label")
    assert "fwd_header_length.1" not in df.columns and "fwd_header_length" in df.columns
    rows = {r["flow_duration"]: r for r in df.collect()}
    assert rows[10.0]["flow_bytes_s"] == INF
    assert rows[20.0]["flow_bytes_s"] is None and rows[30.0]["flow_bytes_s"] is None
    assert rows[40.0]["flow_bytes_s"] is None
    assert rows[50.0]["label"] == "FTP-Patator" and rows[50.0]["day"] == "Tuesday"
    assert rows[10.0]["day"] == "Monday"
    with pytest.raises(FileNotFoundError):
        read_flows(spark, str(tmp_path / "empty"))


def test_quantiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    v = np.round(rng.normal(size=777), 2)
    df = spark.createDataFrame(pd.DataFrame({"v": v}))
    probs = [0.0, 0.25, 0.5, 0.75, 0.95, 0.99, 0.999, 1.0]
    got = {r["p"]: r["q"] for r in A.quantiles(df, ["v"], probs).collect()}
    for p in probs:
        assert got[p] == pytest.approx(np.quantile(v, p), abs=1e-12)


def test_streaming_ingest_and_score(spark, tmp_path):
    from flowaudit.operators import models as M
    from flowaudit.streaming.ingest import read_flows_stream, score_stream
    src = tmp_path / "in"
    src.mkdir()
    header = "Flow Duration,Total Fwd Packets,Label"
    lines = [f"{i},{i % 7},{'BENIGN' if i % 3 else 'Bot'}" for i in range(60)]
    (src / "Friday-WorkingHours.csv").write_text(header + "\n" + "\n".join(lines) + "\n")
    st = read_flows_stream(spark, str(src), header, names="snake")
    batch = spark.createDataFrame([(float(i), float(i % 7), "BENIGN" if i % 3 else "Bot") for i in range(60)],
                                  "flow_duration double, total_fwd_packets double, label string")
    m = M.fit(batch, ["flow_duration", "total_fwd_packets"], "label", "tree", maxDepth=3)
    q = score_stream(st, m, str(tmp_path / "out"), str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 60 and set(out.columns) >= {"y_true", "y_pred", "probs", "epoch"}


def test_model_config_and_persistence(spark, tmp_path):
    from flowaudit.operators import models as M
    assert M.model_from_config({"model": {"type": "MLP", "args": {"hidden1_size": 64, "hidden2_size": 64}}}) == \
        ("mlp", {"hidden": [64, 64], "maxIter": 200})
    df = spark.createDataFrame([(float(i), "a" if i % 2 else "b") for i in range(40)], "x double, label string")
    m = M.fit(df, ["x"], "label", "logreg")
    m.save(str(tmp_path / "m"))
    back = M.FlowModel.load(str(tmp_path / "m"))
    a = [r["y_pred"] for r in m.score(df).collect()]
    b = [r["y_pred"] for r in back.score(df).collect()]
    assert a == b


def test_one_hot_and_resample(spark):
    from flowaudit.functions.labels import one_hot_drop_first
    from flowaudit.operators.splits import resample_with_replacement
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z"), (4, "y")], "id long, c string")
    oh = one_hot_drop_first(df, ["c"])
    assert oh.columns == ["id", "c_y", "c_z"]
    r = resample_with_replacement(df, "id", n=100, seed=3)
    assert r.count() == 100


def test_paper_pipeline_end_to_end(spark, tmp_path):
    from flowaudit.plans.paper import run_paper_pipeline
    from flowaudit.sources.fixtures import flows
    from flowaudit.sources.store import read_split
    f = flows(spark, "/root/testdata/sf0.001").select(
        F.col("flow_duration").alias(" Flow Duration"), F.col("total_fwd_packets").alias("Total Fwd Packets"),
        F.col("total_backward_packets").alias("Total Backward Packets"),
        F.col("fwd_packet_length_max").alias("Fwd Packet Length Max"), F.col("label").alias("Label"))
    f.write.option("header", True).csv(str(tmp_path / "raw" / "Monday-WorkingHours.csv"))
    out, scaler, enc = run_paper_pipeline(spark, str(tmp_path / "raw"), str(tmp_path / "processed"))
    tr = read_split(spark, str(tmp_path / "processed"), "train")
    te = read_split(spark, str(tmp_path / "processed"), "test")
    assert tr.count() > te.count() > 0
    lo, hi = tr.agg(F.min("total_fwd_packets"), F.max("total_fwd_packets")).first()
    assert 0.0 <= lo <= hi <= 1.0
