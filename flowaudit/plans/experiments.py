"""Experiments: threshold analysis, cross-validation + bootstrap, feature-set
ablation, imbalance ablation, clipping and redundancy experiments, split
strategies (E14-E18, M11-M14, B12, B13).

Each experiment is a short loop over configurations (recipes, folds,
strategies); every step inside is a distributed Spark job (fit statistics,
Spark ML fit, one scoring pass, metrics from the grouped confusion table).
Scored frames are cached once per evaluation and released after.
"""

from __future__ import annotations

import time
from threading import Lock

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from ..functions.labels import class_list
from ..functions.rowwise import engineered_features
from ..operators import balance as B
from ..operators import clean as C
from ..operators import metrics as E
from ..operators import models as M
from ..operators import splits as S
from ..operators.fitted import ClipUpper, DropColumns, FlowChain, ImportanceSelector, Log1pHeavy, kept_columns
from ..operators.smote import smote


def _pmap(fn, items, parallelism: int = 1) -> list:
    """Run independent configurations; ``parallelism > 1`` submits their Spark
    jobs from threads so small jobs overlap (fit times are then wall times
    under contention)."""
    items = list(items)
    if parallelism <= 1:
        return [fn(x) for x in items]
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return list(pool.map(fn, items))


def prepare(train: DataFrame, other: list[DataFrame], features, scale: bool = True, fill_zero: bool = False):
    """The chain C17 fitted on ``train``: transformed (train, *other) and the kept features."""
    chain = FlowChain(inputCols=list(features), scale=scale, fillZero=fill_zero).fit(train)
    return [chain.transform(d) for d in (train, *other)], kept_columns(chain)


def fit_deployable(train: DataFrame, features, label: str, kind: str = "gbt_ovr", seed: int = 42, **params):
    """C17 with the classifier: one ``PipelineModel`` from raw rows to class names,
    which ``save`` and ``PipelineModel.load`` carry to another session."""
    chain = FlowChain(inputCols=list(features)).fit(train)
    model = M.fit(chain.transform(train), kept_columns(chain), label, kind, seed=seed, **params)
    return M.whole_pipeline(chain, model)


def threshold_analysis(df: DataFrame, features, label: str, key: str, benign: str = "BENIGN",
                       model_kind: str = "gbt", seed: int = 42, **model_params):
    """Section 3.2: binary target, 60/20/20, fitted chain, boosted trees,
    threshold sweep on validation, chosen thresholds applied to test."""
    # the rows are computed once for the split, the chain, the fit and both scorings
    d = df.withColumn("_y", (F.col(label) != benign).cast("int").cast("string")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sp = S.three_way_split(d, label, key, seed=seed)
        (tr, va, te), feats = prepare(sp.where("split = 'train'"),
                                      [sp.where("split = 'val'"), sp.where("split = 'test'")], features)
        params = {"maxIter": 100, "maxDepth": 6} if model_kind == "gbt" else {}
        params.update(model_params)
        m = M.fit(tr, feats, "_y", model_kind, seed=seed, **params)
        val, test = (m.score(part, keep=[key]).withColumn("y", F.col("y_true").cast("int"))
                     .persist(StorageLevel.MEMORY_AND_DISK) for part in (va, te))
        sweep = E.threshold_sweep(val, "y", "score")
        picks = E.pick_thresholds(sweep)
        chosen = E.apply_thresholds(test, "y", "score", picks)
        test.count()                                 # scored while the rows are kept
    finally:
        d.unpersist()
    return sweep, chosen


#: Classes with fewer rows leave cross-validation, ablation and imbalance runs.
MIN_CLASS_ROWS = 5


def _multiclass_scores(sc: DataFrame, model_classes, classes=None) -> dict:
    """Six scores; with ``classes`` the probabilities are put onto that list
    first, so classes the model never saw count with probability 0 (P8)."""
    if classes is not None:
        sc = M.pad_probs(sc, model_classes, classes)
    s = E.summary_metrics(sc, "y_true", "y_pred").first()
    r = E.ovr_auc(sc, "y_true", "probs", classes or model_classes, missing=0.0).first()
    return {"f1_macro": s["macro_f1"], "f1_weighted": s["weighted_f1"], "f2_macro": s["macro_f2"],
            "mcc": s["mcc"], "roc_auc": r["roc_auc_ovr"], "pr_auc": r["pr_auc_macro"]}


def _scored(model, test: DataFrame, key: str, work):
    """``work`` on the scored test rows, which are kept while it runs."""
    sc = model.score(test, keep=[key]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return work(sc)
    finally:
        sc.unpersist()


def cross_validate(df: DataFrame, features, label: str, key: str, models: dict, k: int = 5,
                   test_size: float = 0.3, seed: int = 42, bootstrap_iterations: int = 100,
                   parallelism: int = 1):
    """E14 + E18: stratified k-fold CV on the training part (chain fitted per
    fold), mean and population std of six scores over the global class list,
    mean fit time; the first fold's model is bootstrapped on the test part.
    Classes below ``MIN_CLASS_ROWS`` rows are left out."""
    import numpy as np
    spark = df.sparkSession
    sp = S.stratified_split(C.filter_rare_classes(df, label, MIN_CLASS_ROWS), label, key, test_size, seed) \
        .persist(StorageLevel.MEMORY_AND_DISK)
    train = S.kfold(sp.where("split = 'train'"), label, key, k, seed).persist(StorageLevel.MEMORY_AND_DISK)
    test = sp.where("split = 'test'")
    rows, boot_rows = [], []

    def chain(f):
        # the test part goes through the first fold's chain as well
        return prepare(train.where(F.col("fold") != f), [train.where(F.col("fold") == f), test], features)

    def run(name, f):
        (kind, params), ((tr, va, te), feats) = models[name], chains[f]
        t0 = time.time()
        m = M.fit(tr, feats, label, kind, seed=seed, **params)
        secs = time.time() - t0
        scores = _scored(m, va, key, lambda sc: _multiclass_scores(sc, m.classes, classes))
        return scores, secs, None if f else _scored(m, te, key, lambda sc: E.bootstrap_ci(
            E.bootstrap_metrics(sc, "y_true", "y_pred", bootstrap_iterations, seed)).first())
    try:
        classes = class_list(sp, label)
        # a fold's chain does not depend on the model; the models' folds are one list, so that none waits for
        # the last fold of the model before
        chains = _pmap(chain, range(k), parallelism)
        done = iter(_pmap(lambda nf: run(*nf), [(name, f) for name in models for f in range(k)], parallelism))
        for name in models:
            folds = [next(done) for _ in range(k)]
            scores, times, ci = [x[0] for x in folds], [x[1] for x in folds], folds[0][2]
            row = {"model": name}
            for metric in scores[0]:
                vals = np.array([s[metric] for s in scores], dtype=float)
                row[f"{metric}_mean"], row[f"{metric}_std"] = float(vals.mean()), float(vals.std())
            row["fit_seconds"] = float(np.mean(times))
            rows.append(row)
            boot_rows.append({"model": name, **ci.asDict()})
    finally:
        train.unpersist()
        sp.unpersist()
    return spark.createDataFrame(rows), spark.createDataFrame(boot_rows)


ABLATION_RECIPES = ["original", "cleaned", "reduced", "log", "engineered", "selected"]


def ablation(df: DataFrame, features, label: str, key: str, model_kind: str = "gbt_ovr",
             test_size: float = 0.3, seed: int = 42, parallelism: int = 1, **model_params) -> DataFrame:
    """Six feature recipes, one result row each (recipe, n_features,
    F1/F2 macro, MCC, PR-AUC macro, fit and inference seconds).

    original: missing as 0; cleaned: constants dropped, medians; reduced: also
    without correlated columns; log: then log1p; engineered: the same on the
    features with the engineered ones; selected: then the 25 most important."""
    spark = df.sparkSession
    params = {"maxIter": 50, "maxDepth": 6} if model_kind == "gbt_ovr" else {}
    params.update(model_params)
    d = C.filter_rare_classes(df, label, MIN_CLASS_ROWS)
    eng = engineered_features(set(d.columns))
    sp = S.stratified_split(d.withColumns(eng), label, key, test_size, seed).persist(StorageLevel.MEMORY_AND_DISK)
    tr0, te0 = sp.where("split = 'train'"), sp.where("split = 'test'")
    feats0 = list(features)

    def run(recipe):
        feats = feats0 + (list(eng) if recipe in ("engineered", "selected") else [])
        (tr, te), feats = prepare(tr0, [te0], feats, scale=False, fill_zero=recipe == "original")
        if recipe not in ("original", "cleaned"):
            dc = DropColumns(inputCols=feats, rule="correlated", threshold=0.95).fit(tr)
            tr, te, feats = dc.transform(tr), dc.transform(te), dc.kept()
        if recipe in ("log", "engineered", "selected"):
            lg = Log1pHeavy(inputCols=feats).fit(tr)
            tr, te = lg.transform(tr), lg.transform(te)
        if recipe == "selected":
            idx = tr.withColumn("_li", M.class_index(classes, label))
            feats = ImportanceSelector(inputCols=feats, labelCol="_li").fit(idx).kept()
        t0 = time.time()
        m = M.fit(tr, feats, label, model_kind, seed=seed, **params)
        fit_s = time.time() - t0

        def work(sc):
            t1 = time.time()
            sc.count()                       # the scoring pass itself
            return time.time() - t1, _multiclass_scores(sc, m.classes, classes)
        infer_s, s = _scored(m, te, key, work)
        return (recipe, len(feats), s["f1_macro"], s["f2_macro"], s["mcc"], s["pr_auc"], fit_s, infer_s)
    try:
        classes = class_list(sp, label)
        out = _pmap(run, ABLATION_RECIPES, parallelism)
    finally:
        sp.unpersist()
    return spark.createDataFrame(out, "recipe string, n_features int, f1_macro double, f2_macro double, "
                                      "mcc double, pr_auc double, fit_seconds double, inference_seconds double")


IMBALANCE_STRATEGIES = ["none", "class_weight", "undersample", "oversample", "smote"]
PAPER_STRATEGIES = ["none", "class_weight", "weighted_sampler", "undersample_smote", "undersample_smote_class_weight"]


def imbalance_ablation(df: DataFrame, features, label: str, key: str, model_kind: str = "gbt_ovr",
                       strategies=IMBALANCE_STRATEGIES, test_size: float = 0.3, seed: int = 42,
                       benign: str = "BENIGN", parallelism: int = 1, **model_params) -> DataFrame:
    """B12 (and B13 with an MLP and ``PAPER_STRATEGIES``): resampling on the
    training part only; F1/F2 macro, MCC, PR-AUC, minority recall, benign FPR.

    ``undersample_smote`` cuts every class to the median class size, then grows
    the smaller ones to it."""
    spark = df.sparkSession
    params = {"maxIter": 50, "maxDepth": 6} if model_kind == "gbt_ovr" else {}
    params.update(model_params)
    d = C.filter_rare_classes(df, label, MIN_CLASS_ROWS)
    sp = S.stratified_split(d, label, key, test_size, seed).persist(StorageLevel.MEMORY_AND_DISK)

    def middle(t):
        counts = C.class_counts(t, label)
        goal = sorted(counts.values())[len(counts) // 2]
        under = {c: min(n, goal) for c, n in counts.items()}
        return smote(B.undersample(t, label, key, under, seed), label, key, feats, {c: goal for c in under}, seed=seed)

    made, lock = [], Lock()

    def grown():
        # the rows of :func:`middle` are made once for all strategies that train on them
        with lock:
            if not made:
                made.append(middle(tr).persist(StorageLevel.MEMORY_AND_DISK))
        return made[0]

    def run(s):
        weight = None
        if s == "class_weight":
            t, weight = B.balanced_weights(tr, label), "weight"
        elif s == "weighted_sampler":
            t = B.weighted_sample(tr, label, key, seed=seed)
        elif s == "undersample":
            t = B.undersample(tr, label, key, seed=seed)
        elif s == "oversample":
            t = B.oversample(tr, label, key, seed=seed)
        elif s == "smote":
            t = smote(tr, label, key, feats, seed=seed)
        elif s == "undersample_smote":
            t = grown()
        elif s == "undersample_smote_class_weight":
            t, weight = B.balanced_weights(grown(), label), "weight"
        elif s == "none":
            t = tr
        else:
            raise ValueError(f"unknown strategy {s}")
        t0 = time.time()
        m = M.fit(t, feats, label, model_kind, weight_col=weight, seed=seed, **params)
        fit_s = time.time() - t0
        r, mr, bf = _scored(m, te, key, lambda sc: (
            _multiclass_scores(sc, m.classes, classes), E.minority_recall(sc, "y_true", "y_pred", mc).first()[0],
            E.benign_fpr(sc, "y_true", "y_pred", benign).first()[0]))
        return (s, r["f1_macro"], r["f2_macro"], r["mcc"], r["pr_auc"], mr, bf, fit_s)
    try:
        classes = class_list(sp, label)
        (tr, te), feats = prepare(sp.where("split = 'train'"), [sp.where("split = 'test'")], features, scale=False)
        tr = tr.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            mc = B.minority_class(tr, label).first()[label]
            out = _pmap(run, strategies, parallelism)
        finally:
            for t in made:
                t.unpersist()
            tr.unpersist()
    finally:
        sp.unpersist()
    return spark.createDataFrame(out, "strategy string, f1_macro double, f2_macro double, mcc double, "
                                      "pr_auc double, minority_recall double, benign_fpr double, fit_seconds double")


def clipping_experiment(df: DataFrame, features, label: str, key: str, seed: int = 42,
                        rare_below: int = 100, num_trees: int = 20) -> DataFrame:
    """Recall of rare classes with and without P14 clipping (99.9th train percentile)."""
    d = C.filter_rare_classes(df, label, 2)
    sp = S.stratified_split(d, label, key, 0.3, seed).persist(StorageLevel.MEMORY_AND_DISK)
    (tr, te), feats = prepare(sp.where("split = 'train'"), [sp.where("split = 'test'")], features, scale=False)
    counts = C.class_counts(d, label)
    rare = [c for c, n in counts.items() if n < rare_below]
    res = {}
    for variant in ("base", "clipped"):
        a, b = tr, te
        if variant == "clipped":
            cl = ClipUpper(inputCols=feats, p=99.9).fit(tr)
            a, b = cl.transform(tr), cl.transform(te)
        m = M.fit(a, feats, label, "forest", numTrees=num_trees, maxDepth=30, seed=seed)
        rep = E.per_class_report(m.score(b, keep=[key]), "y_true", "y_pred").collect()
        res[variant] = {r["class"]: r["recall"] for r in rep}
    sp.unpersist()
    rows = [(c, res["base"].get(c), res["clipped"].get(c),
             (res["clipped"].get(c) or 0.0) - (res["base"].get(c) or 0.0)) for c in rare if c in res["base"]]
    return df.sparkSession.createDataFrame(rows, "class string, recall_base double, recall_clipped double, impact double")


def redundancy_experiment(df: DataFrame, features, label: str, key: str, seed: int = 42,
                          threshold: float = 0.95, num_trees: int = 20) -> DataFrame:
    """Macro-F1 and fit time before/after C13 (|r| > 0.95, drop the earlier column)."""
    d = C.filter_rare_classes(df, label, 2)
    sp = S.stratified_split(d, label, key, 0.3, seed).persist(StorageLevel.MEMORY_AND_DISK)
    (tr, te), feats = prepare(sp.where("split = 'train'"), [sp.where("split = 'test'")], features, scale=False)
    drop = C.correlated_column_list(tr, feats, threshold, "abs_earlier")
    reduced = [c for c in feats if c not in drop]
    out = {}
    for name, fs in (("before", feats), ("after", reduced)):
        t0 = time.time()
        m = M.fit(tr, fs, label, "forest", numTrees=num_trees, maxDepth=30, seed=seed)
        secs = time.time() - t0
        f1 = E.summary_metrics(m.score(te, keep=[key]), "y_true", "y_pred").first()["macro_f1"]
        out[name] = (len(fs), f1, secs)
    sp.unpersist()
    return df.sparkSession.createDataFrame(
        [(out["before"][0], out["after"][0], out["before"][1], out["after"][1], out["before"][2], out["after"][2])],
        "features_before int, features_after int, f1_macro_before double, f1_macro_after double, "
        "train_seconds_before double, train_seconds_after double")


def split_strategy_experiment(df: DataFrame, features, label: str, key: str, models: dict,
                              strategies=("random_original", "random_deduplicated", "grouped", "chronological"),
                              day: str = "day", seed: int = 42, parallelism: int = 1) -> DataFrame:
    """M14 (+T9): for each split strategy, leakage percent and the metrics of every model."""
    from ..operators.leakage import leakage
    spark = df.sparkSession

    def run(s):
        sp = S.split(df, s, label, key, features, day, seed=seed).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            lk = leakage(sp.where("split = 'train'"), sp.where("split = 'test'"), features).first()["leakage_pct"]
            if sp.where("split = 'train'").isEmpty() or sp.where("split = 'test'").isEmpty():
                # an empty part has no metrics, but the strategy is still reported
                return [(s, name, lk, None, None, None, None) for name in models]
            (tr, te), feats = prepare(sp.where("split = 'train'"), [sp.where("split = 'test'")], features)
            rows = []
            tr, te = tr.persist(StorageLevel.MEMORY_AND_DISK), te.persist(StorageLevel.MEMORY_AND_DISK)
            for name, (kind, params) in models.items():
                m = M.fit(tr, feats, label, kind, seed=seed, **params)
                s_ = E.summary_metrics(m.score(te, keep=[key]), "y_true", "y_pred").first()
                rows.append((s, name, lk, s_["accuracy"], s_["macro_f1"], s_["weighted_f1"], s_["mcc"]))
            tr.unpersist()
            te.unpersist()
            return rows
        finally:
            sp.unpersist()

    out = [r for rows in _pmap(run, strategies, parallelism) for r in rows]
    return spark.createDataFrame(out, "strategy string, model string, leakage_pct double, accuracy double, "
                                      "macro_f1 double, weighted_f1 double, mcc double")
