"""Registered checks: models (rows only), forensics (SQL twins), attribution, SMOTE."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Window, functions as F

from ..operators import fitted as FT
from ..operators import forensics as X
from ..operators import models as M
from ..operators import splits as S
from ..registry import query
from ..session import cut_lineage
from ..sources.fixtures import FLOW_FEATURES, flows, scores, table, with_views

RAW = ["total_fwd_packets", "flow_duration"]


# ---- forensics on scores joined with the flow features ----------------------

def scored_flows(spark, sf):
    """scores x flows (1:1 on the order key); binary prediction at 0.5; features
    z-scored with train statistics; the two raw features kept."""
    s = scores(spark, sf)
    f = flows(spark, sf).select("flow_id", *FLOW_FEATURES)
    j = s.join(f, s.row_id == f.flow_id).drop("flow_id")
    j = j.withColumn("pred", (F.col("score") >= 0.5).cast("int"))
    j = j.select("*", *[F.col(c).alias(f"raw_{c}") for c in RAW])
    scaler = FT.StandardScaler(inputCols=FLOW_FEATURES).fit(j.where("split = 'train'"))
    return scaler.transform(j)


_SCALED_SQL = ("sj AS (SELECT s.*, " + ", ".join(f"f.{c} AS {c}" for c in FLOW_FEATURES)
               + ", CASE WHEN s.score >= 0.5 THEN 1 ELSE 0 END AS pred FROM scores s JOIN flows f ON s.row_id = f.flow_id),\n"
               "st AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}, coalesce(nullif(stddev_pop({c}), 0), 1) AS s_{c}"
                                            for c in FLOW_FEATURES) + " FROM sj WHERE split = 'train'),\n"
               "sc AS (SELECT sj.* EXCLUDE (" + ", ".join(FLOW_FEATURES) + "), "
               + ", ".join(f"sj.{c} AS raw_{c}" for c in RAW) + ", "
               + ", ".join(f"(sj.{c} - m_{c}) / s_{c} AS {c}" for c in FLOW_FEATURES) + " FROM sj, st)")


def _dist_sql(prefix: str) -> str:
    return "sqrt(" + " + ".join(f"(sc.{c} - {prefix}.{c}) * (sc.{c} - {prefix}.{c})" for c in FLOW_FEATURES) + ")"


_CENT_SQL = ("cent AS (SELECT y_true AS cls, " + ", ".join(f"avg({c}) AS {c}" for c in FLOW_FEATURES)
             + " FROM sc WHERE split = 'train' GROUP BY y_true)")


@query("error_rows", with_views("""
SELECT row_id, CASE WHEN y = 0 THEN 'FP' ELSE 'FN' END AS error_type FROM scores
WHERE (y = 0 AND score >= 0.5) OR (y = 1 AND score < 0.5)
""", "scores"))
def q_error_rows(spark, sf):
    s = scores(spark, sf).withColumn("pred", (F.col("score") >= 0.5).cast("int"))
    return X.error_rows(s, "y", "pred").select("row_id", "error_type")


@query("error_summary", with_views("""
SELECT split, count_if(y = 0 AND score >= 0.5) AS fp, count_if(y = 1 AND score < 0.5) AS fn, count(*) AS n,
  round(count_if(y = 0 AND score >= 0.5) * 100.0 / count(*), 6) AS fp_pct,
  round(count_if(y = 1 AND score < 0.5) * 100.0 / count(*), 6) AS fn_pct FROM scores GROUP BY split
""", "scores"))
def q_error_summary(spark, sf):
    s = scores(spark, sf).withColumn("pred", (F.col("score") >= 0.5).cast("int"))
    r = X.error_summary(s, "y", "pred", by=["split"])
    return r.withColumns({c: F.round(c, 6) for c in ["fp_pct", "fn_pct"]})


@query("misclassified", with_views("SELECT row_id, y_true, y_pred FROM scores WHERE y_true <> y_pred", "scores"))
def q_misclassified(spark, sf):
    return X.misclassified(scores(spark, sf)).select("row_id", "y_true", "y_pred")


@query("fn_by_class", with_views("""
SELECT y_true, count_if(y_pred = 'BENIGN') AS fn, count(*) AS total FROM scores WHERE y_true <> 'BENIGN' GROUP BY y_true
""", "scores"))
def q_fn_by_class(spark, sf):
    return X.fn_by_class(scores(spark, sf))


@query("centroids", with_views(f"""WITH {_SCALED_SQL}, {_CENT_SQL}
SELECT cls AS y_true, feature, round(mean, 6) + 0.0 AS mean FROM cent UNPIVOT (mean FOR feature IN ({', '.join(FLOW_FEATURES)}))
""", "flows", "scores"))
def q_centroids(spark, sf):
    sc = scored_flows(spark, sf).where("split = 'train'")
    return X.centroids(sc, FLOW_FEATURES, "y_true").withColumn("mean", F.round("mean", 6) + 0.0)


@query("nearest_centroid", with_views(f"""WITH {_SCALED_SQL}, {_CENT_SQL},
d AS (SELECT sc.row_id, cent.cls, {_dist_sql('cent')} AS dist FROM sc, cent
      WHERE sc.split = 'test' AND cent.cls <> 'BENIGN')
SELECT row_id, arg_min(cls, (dist, cls)) AS closest_class, round(min(dist), 6) AS closest_distance FROM d GROUP BY row_id
""", "flows", "scores"))
def q_nearest_centroid(spark, sf):
    sc = scored_flows(spark, sf)
    cents = X.centroid_map(sc.where("split = 'train' AND y_true <> 'BENIGN'"), FLOW_FEATURES, "y_true")
    out = X.nearest_centroid(sc.where("split = 'test'"), FLOW_FEATURES, cents)
    return out.select("row_id", "closest_class", F.round("closest_distance", 6).alias("closest_distance"))


@query("fn_analysis", with_views(f"""WITH {_SCALED_SQL}, {_CENT_SQL},
cnt AS (SELECT y_true AS cls, count(*) AS n FROM sc WHERE split = 'train' GROUP BY y_true)
SELECT sc.y_true AS attack_type, sc.day, round(sc.score, 4) AS probability,
  round({_dist_sql('b')}, 2) AS distance_to_benign,
  CASE WHEN coalesce(cnt.n, 0) < 100 THEN 'Yes' ELSE 'No' END AS rare_in_training,
  raw_total_fwd_packets, raw_flow_duration, sc.row_id
FROM sc JOIN (SELECT * FROM cent WHERE cls = 'BENIGN') b ON true LEFT JOIN cnt ON cnt.cls = sc.y_true
WHERE sc.split = 'test' AND sc.y = 1 AND sc.pred = 0
""", "flows", "scores"))
def q_fn_analysis(spark, sf):
    sc = scored_flows(spark, sf)
    return X.fn_analysis(sc.where("split = 'test'"), sc.where("split = 'train'"), FLOW_FEATURES, "y_true", "day")


@query("fp_analysis", with_views(f"""WITH {_SCALED_SQL}, {_CENT_SQL},
d AS (SELECT sc.row_id, cent.cls, {_dist_sql('cent')} AS dist FROM sc, cent
      WHERE sc.split = 'test' AND sc.y = 0 AND sc.pred = 1 AND cent.cls <> 'BENIGN'),
best AS (SELECT row_id, arg_min(cls, (dist, cls)) AS closest_attack, min(dist) AS dist FROM d GROUP BY row_id)
SELECT sc.day, round(sc.score, 4) AS probability, best.closest_attack, round(best.dist, 2) AS distance_to_attack,
  raw_total_fwd_packets, raw_flow_duration, sc.row_id
FROM sc JOIN best USING (row_id)
""", "flows", "scores"))
def q_fp_analysis(spark, sf):
    sc = scored_flows(spark, sf)
    return X.fp_analysis(sc.where("split = 'test'"), sc.where("split = 'train'"), FLOW_FEATURES, "y_true", "day")


_TWO_MODELS = """errs AS (
  SELECT 'threshold' AS model, row_id, CASE WHEN y = 0 THEN 'FP' ELSE 'FN' END AS error_type FROM scores
  WHERE (y = 0 AND score >= 0.5) OR (y = 1 AND score < 0.5)
  UNION ALL
  SELECT 'multiclass', row_id, CASE WHEN y = 0 THEN 'FP' ELSE 'FN' END FROM scores
  WHERE (y = 0 AND y_pred <> 'BENIGN') OR (y = 1 AND y_pred = 'BENIGN'))"""


def _two_models(spark, sf):
    s = scores(spark, sf)
    a = X.error_rows(s.withColumn("pred", (F.col("score") >= 0.5).cast("int")), "y", "pred", "threshold")
    b = X.error_rows(s.withColumn("pred", (F.col("y_pred") != "BENIGN").cast("int")), "y", "pred", "multiclass")
    return a.unionByName(b)


@query("worst_model", with_views(f"""WITH {_TWO_MODELS}
SELECT model, count(*) AS n_errors FROM errs GROUP BY model ORDER BY n_errors DESC, model LIMIT 1
""", "scores"))
def q_worst_model(spark, sf):
    return X.worst_model(_two_models(spark, sf))


@query("cohort_means", with_views(f"""WITH {_SCALED_SQL}
SELECT CASE WHEN y = 0 THEN 'FP' ELSE 'FN' END AS error_type, """ + ", ".join(
    f"round(avg({c}), 6) AS {c}" for c in FLOW_FEATURES) + """ FROM sc
WHERE (y = 0 AND pred = 1) OR (y = 1 AND pred = 0) GROUP BY 1
""", "flows", "scores"))
def q_cohort_means(spark, sf):
    e = X.error_rows(scored_flows(spark, sf), "y", "pred")
    m = X.cohort_means(e, FLOW_FEATURES)
    return m.withColumns({c: F.round(c, 6) for c in FLOW_FEATURES})


@query("cohorts", with_views("""
SELECT CASE WHEN y = 1 AND score >= 0.5 THEN 'tp' WHEN y = 0 AND score < 0.5 THEN 'tn'
  WHEN y = 0 AND score >= 0.5 THEN 'fp' ELSE 'fn' END AS cohort, count(*) AS n, min(row_id) AS first_row_id
FROM scores GROUP BY 1
""", "scores"))
def q_cohorts(spark, sf):
    s = scores(spark, sf).withColumn("pred", (F.col("score") >= 0.5).cast("int"))
    return X.cohorts(s)


# ---- models (rows-only: Spark ML weights differ from any other library) ------

def model_data(spark, sf, binary=True, once=False):
    """Train, test and validation part; ``once``: of flows that are computed and checkpointed first."""
    f = cut_lineage(flows(spark, sf)) if once else flows(spark, sf)
    f = f.withColumn("y", (F.col("label") != "BENIGN").cast("int").cast("string")) if binary else f
    sp = S.three_way_split(f, "label", "flow_id")
    return sp.where("split = 'train'"), sp.where("split = 'test'"), sp.where("split = 'val'")


def _scored(spark, sf, kind, binary=True, **params):
    tr, te, _ = model_data(spark, sf, binary, once=kind in ("gbt", "gbt_ovr"))
    m = M.fit(tr, FLOW_FEATURES, "y" if binary else "label", kind, **params)
    return m.score(te, keep=["flow_id"]).select("flow_id", "y_true", "y_pred", F.round("score", 6).alias("score"))


for _name, _kind, _bin, _params in [
        ("model_logreg", "logreg", True, {}),
        ("model_tree", "tree", True, {}),
        ("model_forest", "forest", False, {"numTrees": 50, "maxDepth": 15}),
        ("model_gbt_binary", "gbt", True, {"maxIter": 100, "maxDepth": 6}),
        ("model_gbt_multiclass", "gbt_ovr", False, {"maxIter": 50, "maxDepth": 6}),
        ("model_mlp", "mlp", False, {"hidden": [128, 64, 32], "maxIter": 100})]:
    def _mk(kind=_kind, binary=_bin, params=_params):
        return lambda spark, sf: _scored(spark, sf, kind, binary, **params)
    query(_name)(_mk())


@query("model_gbt_early_stopping")
def q_gbt_early_stopping(spark, sf):
    f = cut_lineage(flows(spark, sf)).withColumn("y", (F.col("label") != "BENIGN").cast("int").cast("string"))
    sp = S.three_way_split(f, "label", "flow_id")
    tv = sp.where("split <> 'test'").withColumn("is_val", F.col("split") == "val")
    m = M.fit(tv, FLOW_FEATURES, "y", "gbt", maxIter=100, maxDepth=6, validationIndicatorCol="is_val", patience=10)
    return m.score(sp.where("split = 'test'"), keep=["flow_id"]).select("flow_id", "y_true", "y_pred", "score")


@query("drop_unseen_classes", with_views("""
SELECT flow_id, label FROM flows WHERE flow_id % 3 = 1
AND label IN (SELECT label FROM flows WHERE flow_id % 3 = 0 AND total_fwd_packets > (SELECT avg(total_fwd_packets) * 1.5 FROM flows))
""", "flows"))
def q_drop_unseen_classes(spark, sf):
    """Validation rows of the classes that the training part, flows of many packets, has."""
    f = flows(spark, sf)
    many = f.agg(F.avg("total_fwd_packets") * 1.5).first()[0]
    train = f.where((F.col("flow_id") % 3 == 0) & (F.col("total_fwd_packets") > many))
    return M.drop_unseen_classes(f.where("flow_id % 3 = 1"), train, "label").select("flow_id", "label")


@query("feature_importances")
def q_feature_importances(spark, sf):
    tr, _, _ = model_data(spark, sf, False)
    m = M.fit(tr, FLOW_FEATURES, "label", "forest", numTrees=50, maxDepth=15)
    return spark.createDataFrame(m.importances(20), "feature string, importance double")


@query("model_comparison")
def q_model_comparison(spark, sf):
    tr, te, _ = model_data(spark, sf, True)
    tr = tr.persist(StorageLevel.MEMORY_AND_DISK)          # shared by the fits of all models
    try:
        models, _ = M.train_all(tr, FLOW_FEATURES, "y")
    finally:
        tr.unpersist()
    return M.evaluate_all(models, te, task="binary", keep=("flow_id",))


@query("toxic_classifier")
def q_toxic_classifier(spark, sf):
    """M1 on the documents/labels pair: a real imbalanced 0/1 label with text-derived features."""
    d = table(spark, sf, "documents")
    lab = table(spark, sf, "labels")
    feats = d.select("doc_id", F.col("n_chars").cast("double").alias("n_chars"),
                     F.size(F.split("text", r"\s+")).cast("double").alias("n_words"),
                     F.length(F.regexp_replace("text", r"[^0-9]", "")).cast("double").alias("n_digits"),
                     F.length(F.regexp_replace("text", r"[^A-Z]", "")).cast("double").alias("n_upper"),
                     F.length(F.regexp_replace("text", r"[^!?]", "")).cast("double").alias("n_marks"))
    j = feats.join(lab, "doc_id").withColumn("toxic", F.col("toxic").cast("string"))
    cols = ["n_chars", "n_words", "n_digits", "n_upper", "n_marks"]
    sp = S.stratified_split(j, "toxic", "doc_id", 0.3)
    from ..operators.balance import balanced_weights
    tr = balanced_weights(sp.where("split = 'train'"), "toxic")
    m = M.fit(tr, cols, "toxic", "logreg", weight_col="weight")
    return m.score(sp.where("split = 'test'"), keep=["doc_id"]).select("doc_id", "y_true", "y_pred", "score")


@query("quantile_uniform")
def q_quantile_uniform(spark, sf):
    tr, te, _ = model_data(spark, sf, False)
    m = FT.QuantileUniform(inputCols=FLOW_FEATURES, nQuantiles=1000).fit(tr)
    return m.transform(te).select("flow_id", *FLOW_FEATURES)


def _wide_embeddings(spark, sf, *keep):
    """The embeddings with a column per component, as many as the longest vector has, and those columns' names."""
    e = table(spark, sf, "embeddings")
    width = e.agg(F.max(F.size("embedding"))).first()[0] or 0
    cols = [f"e{i}" for i in range(width)]
    return e.select(*keep, *[F.get("embedding", F.lit(i)).cast("double").alias(c) for i, c in enumerate(cols)]), cols


@query("centred_pca")
def q_centred_pca(spark, sf):
    wide, cols = _wide_embeddings(spark, sf, "vec_id")
    m = FT.CentredPCA(inputCols=cols, k=0, target=0.99).fit(wide)
    out = m.transform(wide)
    return out.select("vec_id", *[c for c in out.columns if c.startswith("pc")])


@query("importance_selection")
def q_importance_selection(spark, sf):
    tr, _, _ = model_data(spark, sf, False)
    from ..functions.labels import class_list
    si = tr.withColumn("label_idx", M.class_index(class_list(tr, "label"), "label"))
    m = FT.ImportanceSelector(inputCols=FLOW_FEATURES, labelCol="label_idx").fit(si)
    return spark.createDataFrame([(c,) for c in m.kept()], "feature string")


# ---- J5 / B7-B9: neighbours and SMOTE -------------------------------------

@query("class_knn", """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
d AS (SELECT a.vec_id, a.label, b.vec_id AS neighbour, list_distance(a.x, b.x) AS dist
      FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, neighbour) - 1 AS rank FROM d)
SELECT vec_id, label, CAST(rank AS INTEGER) AS rank, neighbour, round(dist, 6) AS distance FROM r WHERE rank < 5
""")
def q_class_knn(spark, sf):
    from ..operators.smote import class_knn
    wide, cols = _wide_embeddings(spark, sf, "vec_id", "label")
    nn = class_knn(wide, "label", "vec_id", cols, k=5, vectors=False)
    return nn.select("vec_id", "label", F.posexplode("nbrs").alias("rank", "nb")).select(
        "vec_id", "label", F.col("rank").cast("int").alias("rank"), F.col("nb.key").alias("neighbour"),
        F.round("nb.d", 6).alias("distance"))


@query("smote")
def q_smote(spark, sf):
    from ..operators.smote import smote
    return smote(flows(spark, sf), "label", "flow_id", FLOW_FEATURES, targets={"Heartbleed": 200, "Infiltration": 300, "Bot": 400})


@query("under_then_smote")
def q_under_then_smote(spark, sf):
    from ..operators.smote import under_then_smote
    return under_then_smote(flows(spark, sf), "label", "flow_id", FLOW_FEATURES, under={"BENIGN": 2000, "DoS Hulk": 1000},
                            over={"Heartbleed": 500, "Infiltration": 500, "Bot": 500, "DDoS": 500})


# ---- experiments and attribution (rows only) ----------------------------------

from . import experiments as XP  # noqa: E402
from ..operators import explain as XA  # noqa: E402
from ..sources.fixtures import DIRTY_FEATURES, flows_dirty  # noqa: E402

#: Models of the reference's cross-validation (its forest has no depth limit; Spark's is 30).
_CV_MODELS = {"Random Forest": ("forest", {"numTrees": 50, "maxDepth": 30}),
              "Multilayer Perceptron": ("mlp", {"hidden": [64, 32], "maxIter": 20})}


@query("threshold_analysis_val")
def q_threshold_analysis_val(spark, sf):
    sweep, _ = XP.threshold_analysis(flows(spark, sf), FLOW_FEATURES, "label", "flow_id")
    return sweep


@query("threshold_analysis_test")
def q_threshold_analysis_test(spark, sf):
    _, chosen = XP.threshold_analysis(flows(spark, sf), FLOW_FEATURES, "label", "flow_id")
    return chosen


@query("cv_results")
def q_cv_results(spark, sf):
    return XP.cross_validate(flows(spark, sf), FLOW_FEATURES, "label", "flow_id", _CV_MODELS, k=5, parallelism=4)[0]


@query("cv_bootstrap_ci")
def q_cv_bootstrap_ci(spark, sf):
    return XP.cross_validate(flows(spark, sf), FLOW_FEATURES, "label", "flow_id", _CV_MODELS, k=5, parallelism=4)[1]


_CLEAN = {c: f"CASE WHEN isnan({c}) OR isinf({c}) THEN NULL ELSE {c} END" for c in DIRTY_FEATURES}


@query("fitted_chain", with_views("WITH cl AS (SELECT row_id, " + ", ".join(f"{x} AS {c}" for c, x in _CLEAN.items())
       + " FROM flows_dirty),\nmed AS (SELECT " + ", ".join(f"median({c}) AS {c}" for c in DIRTY_FEATURES)
       + " FROM cl WHERE row_id % 3 = 0),\nim AS (SELECT row_id, "
       + ", ".join(f"coalesce(cl.{c}, med.{c}) AS {c}" for c in DIRTY_FEATURES) + " FROM cl, med),\nst AS (SELECT "
       + ", ".join(f"avg({c}) AS m_{c}, coalesce(nullif(stddev_pop({c}), 0), 1) AS s_{c}" for c in DIRTY_FEATURES)
       + " FROM im WHERE row_id % 3 = 0),\nkept AS (SELECT "
       + ", ".join(f"count(DISTINCT {c}) > 1 AS k_{c}" for c in DIRTY_FEATURES)
       + " FROM cl WHERE row_id % 3 = 0)\n"
       + " UNION ALL ".join(f"SELECT row_id, '{c}' AS feature, round(({c} - m_{c}) / s_{c}, 6) + 0.0 AS value "
                            f"FROM im, st, kept WHERE k_{c}" for c in DIRTY_FEATURES), "flows_dirty"))
def q_fitted_chain(spark, sf):
    """C17: the chain fitted on a third of the dirty flows, saved, loaded and applied to all of them."""
    from pyspark.ml import PipelineModel
    from ..sources.store import scratch_path
    d = flows_dirty(spark, sf).select("row_id", *DIRTY_FEATURES)
    path = scratch_path(spark, "chain")
    FT.FlowChain(inputCols=list(DIRTY_FEATURES)).fit(d.where("row_id % 3 = 0")).write().overwrite().save(path)
    chain = PipelineModel.load(path)
    out, kept = chain.transform(d), FT.kept_columns(chain)
    long = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), (F.round(c, 6) + 0.0).alias("value")) for c in kept]))
    return out.select("row_id", long.alias("v")).select("row_id", "v.feature", "v.value")


@query("deployed_pipeline")
def q_deployed_pipeline(spark, sf):
    """C17: chain and boosted trees as one saved pipeline, loaded, scoring the test part's raw rows."""
    from pyspark.ml import PipelineModel
    from ..sources.store import scratch_path
    sp = S.stratified_split(flows(spark, sf), "label", "flow_id", 0.3)
    path = scratch_path(spark, "deployed")
    XP.fit_deployable(sp.where("split = 'train'"), FLOW_FEATURES, "label", maxIter=50, maxDepth=6) \
        .write().overwrite().save(path)
    return PipelineModel.load(path).transform(sp.where("split = 'test'")).select("flow_id", "y_true", "y_pred", "score")


@query("ablation")
def q_ablation(spark, sf):
    return XP.ablation(flows(spark, sf), FLOW_FEATURES, "label", "flow_id", parallelism=3)


@query("imbalance_ablation")
def q_imbalance_ablation(spark, sf):
    return XP.imbalance_ablation(flows(spark, sf), FLOW_FEATURES, "label", "flow_id", parallelism=3)


@query("paper_imbalance_grid")
def q_paper_imbalance_grid(spark, sf):
    """The neural network under the five strategies of the grid."""
    return XP.imbalance_ablation(flows(spark, sf), FLOW_FEATURES, "label", "flow_id", model_kind="mlp",
                                 strategies=XP.PAPER_STRATEGIES, parallelism=2, hidden=[64, 64], maxIter=50)


@query("clipping_experiment")
def q_clipping_experiment(spark, sf):
    return XP.clipping_experiment(flows(spark, sf), FLOW_FEATURES, "label", "flow_id")


@query("redundancy_experiment")
def q_redundancy_experiment(spark, sf):
    return XP.redundancy_experiment(flows(spark, sf), FLOW_FEATURES, "label", "flow_id")


@query("split_strategy_experiment")
def q_split_strategy_experiment(spark, sf):
    return XP.split_strategy_experiment(flows_dirty(spark, sf), DIRTY_FEATURES, "label", "row_id", M.DEFAULT_MODELS,
                                        parallelism=4)


def _binary_model(spark, sf):
    tr, te, _ = model_data(spark, sf, True, once=True)
    (tr, te), feats = XP.prepare(tr, [te], FLOW_FEATURES, scale=False)
    m = M.fit(tr, feats, "y", "gbt", maxIter=100, maxDepth=10)
    return m, tr, te, feats


@query("permutation_importance")
def q_permutation_importance(spark, sf):
    m, tr, te, feats = _binary_model(spark, sf)
    return XA.permutation_importance(m, te, feats, "y", "flow_id", repeats=5)


@query("global_attribution")
def q_global_attribution(spark, sf):
    m, _, te, _ = _binary_model(spark, sf)
    return XA.global_attribution(XA.tree_attribution(m, te, "flow_id"))


@query("local_attribution")
def q_local_attribution(spark, sf):
    """X3 for the first representative of each cohort (F8)."""
    m, _, te, _ = _binary_model(spark, sf)
    sc = m.score(te, keep=["flow_id"]).withColumn("y", F.col("y_true").cast("int")) \
          .withColumn("pred", F.col("y_pred").cast("int"))
    firsts = X.cohorts(sc, key="flow_id").select("cohort", F.col("first_flow_id").alias("flow_id"))
    attr = XA.tree_attribution(m, te.join(firsts.select("flow_id"), "flow_id", "left_semi"), "flow_id")
    return XA.local_top(attr, "flow_id").join(firsts, "flow_id")


@query("linear_attribution", with_views(f"""WITH {_SCALED_SQL},
w AS (SELECT {", ".join(f"avg({c}) FILTER (y = 1) - avg({c}) FILTER (y = 0) AS w_{c}, avg({c}) AS b_{c}" for c in FLOW_FEATURES)}
      FROM sc WHERE split = 'train'),
v AS (SELECT row_id, feature, value FROM sc UNPIVOT (value FOR feature IN ({", ".join(FLOW_FEATURES)})) WHERE split = 'test'),
l AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, w_{c} AS w, b_{c} AS b FROM w" for c in FLOW_FEATURES)})
SELECT row_id, feature, round(value, 6) + 0.0 AS value, round(w * (value - b), 6) + 0.0 AS contribution FROM v JOIN l USING (feature)
""", "flows", "scores"))
def q_linear_attribution(spark, sf):
    """Linear X2/X3: the weights are the classes' mean differences of the scaled training features."""
    sc = scored_flows(spark, sf)
    when = lambda y, c: F.avg(F.when(F.col("y") == y, F.col(c)))                                     # noqa: E731
    means = sc.where("split = 'train'").select(*[(when(1, c) - when(0, c)).alias(f"w_{c}") for c in FLOW_FEATURES],
                                               *[F.avg(c).alias(f"b_{c}") for c in FLOW_FEATURES]).first()
    out = XA.linear_attribution({c: means[f"w_{c}"] for c in FLOW_FEATURES}, sc.where("split = 'test'"),
                                {c: means[f"b_{c}"] for c in FLOW_FEATURES})
    return out.withColumns({c: F.round(c, 6) + 0.0 for c in ("value", "contribution")})


@query("global_importance_table")
def q_global_importance_table(spark, sf):
    m, _, te, feats = _binary_model(spark, sf)
    perm = XA.permutation_importance(m, te, feats, "y", "flow_id", repeats=5)
    attr = XA.tree_attribution(m, te, "flow_id")
    return XA.global_table(perm, m.importances(20), XA.global_attribution(attr, top=len(feats)))


@query("train_all_times")
def q_train_all_times(spark, sf):
    """M8: fit several models on one training set; one (model, fit_seconds) row each."""
    tr, _, _ = model_data(spark, sf, False)
    tr = tr.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return M.train_all(tr, FLOW_FEATURES, "label")[1]
    finally:
        tr.unpersist()
