"""Classifiers on Spark ML.

Linear models and single trees are a ``PipelineModel``: VectorAssembler -> classifier.  Labels are
indexed outside of it, over a fixed alphabetical class list (P7), so scoring
needs the features only.  Scoring (M9) returns the evaluation contract used by
:mod:`metrics`: ``y_true`` (null for rows without a label column), ``y_pred``
(class names), ``probs`` (array over the fitted class list) and ``score`` (the
probability of the second class, i.e. class 1 for 0/1 labels).
Boosted trees (M4-M6) are fitted by :mod:`boosting`, all classes at once, as
Spark's GBT is binary only; the perceptron (M7) by :mod:`perceptron`, as Spark's
has neither row weights nor rectified units; forests (M3) by :mod:`forest`, as
Spark's sends the sums of all open nodes from every partition.
"""

from __future__ import annotations

import json
import time

from pyspark import StorageLevel

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.rowwise import argmax
from .boosting import BoostedTrees, fit_boosted
from .fitted import _StatsModel
from .forest import Forest, fit_forest
from .perceptron import Perceptron, fit_perceptron

FEATURES_COL = "features"
INDEX_COL = "label_idx"


def classifier(kind: str, weight_col: str | None = None, seed: int = 42, **params):
    """Spark ML estimator by name; defaults follow the reference configurations."""
    common = dict(featuresCol=FEATURES_COL, labelCol=INDEX_COL)
    if kind == "logreg":            # M1
        est = LogisticRegression(maxIter=params.get("maxIter", 1000), **common)
    elif kind == "tree":            # M2 (unlimited depth -> Spark's cap 30)
        est = DecisionTreeClassifier(maxDepth=params.get("maxDepth", 30), seed=seed, **common)
    else:
        raise ValueError(f"unknown model kind {kind}")
    if weight_col:
        est.setWeightCol(weight_col)
    return est


class FlowModel:
    """A fitted classifier with its class list and feature names (names are never lost, C20)."""

    def __init__(self, kind, features, label, classes, pipelines, fit_seconds, boosted: BoostedTrees | None = None,
                 net: Perceptron | None = None, forest: Forest | None = None):
        self.kind, self.features, self.label = kind, list(features), label
        self.classes, self.pipelines, self.fit_seconds = list(classes), pipelines, fit_seconds
        self.boosted, self.net, self.forest = boosted, net, forest

    # -- M9 ------------------------------------------------------------------
    def score(self, df: DataFrame, keep=()) -> DataFrame:
        keep = [c for c in keep if c in df.columns]
        own = self.boosted or self.net
        if own is not None:
            return self._contract(df, keep, own.probs())
        if self.forest is not None:
            truth = [self.label] if self.label in df.columns else []
            used = dict.fromkeys([*keep, *truth, *self.features])
            return self._contract(self.forest.with_probs(df.select(*[F.col(f"`{c}`") for c in used])), keep, F.col("probs"))
        out = self.pipelines[0].transform(df)
        # a single class is fitted with an empty second slot
        probs = F.slice(vector_to_array("probability"), 1, len(self.classes))
        return self._contract(out, keep, probs)

    def _contract(self, out: DataFrame, keep, probs) -> DataFrame:
        classes = F.array(*[F.lit(c) for c in self.classes])
        truth = F.col(self.label).cast("string") if self.label in out.columns else F.lit(None).cast("string")
        res = out.select(*keep, truth.alias("y_true"), probs.alias("probs"))
        return res.select("*", F.element_at(classes, argmax("probs") + 1).alias("y_pred"),
                          F.element_at("probs", 2 if len(self.classes) > 1 else 1).alias("score"))

    # -- M10 -----------------------------------------------------------------
    def importances(self, top: int = 20) -> list[tuple[str, float]]:
        if self.boosted is not None:
            vals = self.boosted.gains()
        elif self.forest is not None:
            vals = self.forest.importances
        elif self.pipelines and hasattr(self.pipelines[0].stages[-1], "featureImportances"):
            vals = self.pipelines[0].stages[-1].featureImportances.toArray()
        else:
            return []
        pairs = sorted(zip(self.features, map(float, vals)), key=lambda t: (-t[1], t[0]))
        return pairs[:top]

    def save(self, path: str) -> None:
        """Persist each pipeline (Spark ML writer) under ``path``, with what
        the model needs besides: kind, features, label, classes."""
        for i, pm in enumerate(self.pipelines):
            pm.write().overwrite().save(f"{path}/pipeline_{i}")
        about = {"kind": self.kind, "features": self.features, "label": self.label, "classes": self.classes,
                 "pipelines": len(self.pipelines), "fit_seconds": self.fit_seconds,
                 "boosted": None if self.boosted is None else self.boosted.to_json(),
                 "net": None if self.net is None else self.net.to_json(),
                 "forest": None if self.forest is None else self.forest.about()}
        if self.forest is not None:
            self.forest.pieces.write.mode("overwrite").parquet(f"{path}/pieces")
        spark = SparkSession.active()
        spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")

    @staticmethod
    def load(path: str) -> "FlowModel":
        about = json.loads(SparkSession.active().read.text(f"{path}/about").first()[0])
        pms = [PipelineModel.load(f"{path}/pipeline_{i}") for i in range(about["pipelines"])]
        trees, net, forest = about.get("boosted"), about.get("net"), about.get("forest")
        return FlowModel(about["kind"], about["features"], about["label"], about["classes"], pms, about["fit_seconds"],
                         None if trees is None else BoostedTrees.from_json(trees),
                         None if net is None else Perceptron.from_json(net),
                         None if forest is None else
                         Forest.from_about(forest, SparkSession.active().read.parquet(f"{path}/pieces")))


class OwnClassifier(_StatsModel):
    """Boosted trees, a perceptron or a forest as a stage: ``probs`` over the fitted classes.

    Stats: ``kind`` (``boosted``, ``net`` or ``forest``) and ``model``, its JSON text."""

    def _transform(self, df: DataFrame) -> DataFrame:
        s = self.getStats()
        if s["kind"] == "forest":
            return Forest.from_json(s["model"]).with_probs(df)
        own = {"boosted": BoostedTrees, "net": Perceptron}[s["kind"]].from_json(s["model"])
        return df.withColumn("probs", own.probs())


class NamedScores(_StatsModel):
    """The columns of the evaluation contract as a stage: ``probs``, ``y_pred``
    and ``score`` added to the rows, and ``y_true`` where the label is there.

    Stats: ``classes`` and ``label``."""

    def _transform(self, df: DataFrame) -> DataFrame:
        s = self.getStats()
        if "probs" not in df.columns:
            # a single class is fitted with an empty second slot
            df = df.withColumn("probs", F.slice(vector_to_array("probability"), 1, len(s["classes"])))
        df = df.drop(FEATURES_COL, "rawPrediction", "probability", "prediction")
        names = F.array(*[F.lit(c) for c in s["classes"]])
        truth = {"y_true": F.col(f"`{s['label']}`").cast("string")} if s["label"] in df.columns else {}
        return df.withColumns({**truth, "y_pred": F.element_at(names, argmax("probs") + 1),
                               "score": F.element_at("probs", 2 if len(s["classes"]) > 1 else 1)})


def whole_pipeline(chain: PipelineModel, model: FlowModel) -> PipelineModel:
    """C17: the stages of a fitted chain and of a classifier fitted behind it as one ``PipelineModel``."""
    if model.boosted is not None:
        own = [OwnClassifier(model.features, {"kind": "boosted", "model": model.boosted.to_json()})]
    elif model.net is not None:
        own = [OwnClassifier(model.features, {"kind": "net", "model": model.net.to_json()})]
    elif model.forest is not None:
        own = [OwnClassifier(model.features, {"kind": "forest", "model": model.forest.to_json()})]
    else:
        own = model.pipelines[0].stages
    return PipelineModel([*chain.stages, *own, NamedScores(model.features, {"classes": model.classes, "label": model.label})])


def _stages(features, est):
    return [VectorAssembler(inputCols=list(features), outputCol=FEATURES_COL, handleInvalid="keep"), est]


def class_index(classes, label):
    """Position of a label in the class list (a column expression, null for others)."""
    known = F.create_map(*[x for i, c in enumerate(classes) for x in (F.lit(c), F.lit(float(i)))])
    return F.element_at(known, F.col(label).cast("string"))


def drop_unseen_classes(rows: DataFrame, train: DataFrame, label: str) -> DataFrame:
    """``rows`` of classes that ``train`` has; others, and rows without a label, go."""
    return rows.join(train.select(label).distinct(), label, "left_semi").select(*rows.columns)


def fit(train: DataFrame, features, label: str, kind: str, weight_col: str | None = None,
        seed: int = 42, **params) -> FlowModel:
    """M1-M7: fit one model; classes are the distinct training labels (P8:
    re-encoded contiguously after any class filtering).

    Boosted trees take ``validationIndicatorCol``: the rows it marks only decide
    when to stop (M6, after ``patience`` rounds without gain); those of classes
    that no training row has are left out (J6)."""
    from ..functions.labels import class_list
    train = train.withColumn(label, F.col(label).cast("string"))
    t0 = time.time()
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        marks = params.pop("validationIndicatorCol", None)
        classes = class_list(train if marks is None else train.where(~F.coalesce(F.col(marks), F.lit(False))), label)
        indexed = train.withColumn(INDEX_COL, class_index(classes, label))
        if kind in ("gbt", "gbt_ovr"):            # M4, M5, M6
            names = {"maxIter": "rounds", "maxDepth": "max_depth", "stepSize": "rate"}
            trees = fit_boosted(indexed, features, INDEX_COL, classes, weight_col, validation_col=marks,
                                **{names.get(k, k): v for k, v in params.items()})
            return FlowModel(kind, features, label, classes, [], time.time() - t0, trees)
        if kind == "mlp":                         # M7
            net = fit_perceptron(indexed, features, INDEX_COL, classes, weight_col, seed=seed,
                                 **{"rounds" if k == "maxIter" else k: v for k, v in params.items()})
            return FlowModel(kind, features, label, classes, [], time.time() - t0, net=net)
        if kind == "forest":                      # M3
            names = {"numTrees": "trees", "maxDepth": "max_depth"}
            grown = fit_forest(indexed, features, INDEX_COL, classes, weight_col, seed=seed,
                               **{names[k]: v for k, v in params.items() if k in names})
            return FlowModel(kind, features, label, classes, [], time.time() - t0, forest=grown)
        est = classifier(kind, weight_col=weight_col, seed=seed, **params)
        pm = Pipeline(stages=_stages(features, est)).fit(indexed)
        return FlowModel(kind, features, label, classes, [pm], time.time() - t0)
    finally:
        train.unpersist()


def pad_probs(scored: DataFrame, model_classes, all_classes, out: str = "probs") -> DataFrame:
    """Re-index model probabilities onto a global class list (0 for
    classes the model never saw)."""
    idx = {c: i for i, c in enumerate(model_classes)}
    arr = F.array(*[(F.col("probs")[idx[c]] if c in idx else F.lit(0.0)) for c in all_classes])
    return scored.withColumn(out, arr)


DEFAULT_MODELS = {
    "Logistic Regression": ("logreg", {}),
    "Decision Tree": ("tree", {}),
    "Random Forest": ("forest", {"numTrees": 100, "maxDepth": 15}),
    "Gradient Boosting": ("gbt_ovr", {"maxIter": 50, "maxDepth": 6}),
    "Neural Network": ("mlp", {"hidden": [128, 64, 32]}),
}


def train_all(train: DataFrame, features, label: str, models: dict | None = None,
              weight_col: str | None = None) -> tuple[dict, DataFrame]:
    """M8: fit every model; returns the models and a (model, fit_seconds) table."""
    models = models or DEFAULT_MODELS
    fitted, times = {}, []
    for name, (kind, params) in models.items():
        m = fit(train, features, label, kind, weight_col=weight_col, **params)
        fitted[name] = m
        times.append((name, float(m.fit_seconds)))
    spark = train.sparkSession
    return fitted, spark.createDataFrame(times, "model string, fit_seconds double")


def evaluate_all(models: dict, test: DataFrame, task: str = "multiclass", keep=("row_id",)) -> DataFrame:
    """One metric row per model (binary: 11 metrics; multiclass: 8), rounded to 6."""
    from . import metrics as E
    rows = []
    for name, m in models.items():
        sc = m.score(test, keep).cache()
        if task == "binary":
            c = E.binary_counts(sc.withColumn("_y", F.col("y_true").cast("int"))
                                  .withColumn("_p", F.col("y_pred").cast("int")), "_y", "_p")
            b = E.binary_from_counts(c).drop("alerts_per_10k", "tn", "fp", "fn", "tp")
            r = E.ranking_metrics(sc.withColumn("_y", F.col("y_true").cast("int")), "_y", "score")
            row = _one_row_join(b, r)
        else:
            s = E.summary_metrics(sc, "y_true", "y_pred").drop("macro_f2")
            o = E.ovr_auc(sc, "y_true", "probs", m.classes)
            row = _one_row_join(s, o.select("roc_auc_ovr"))
        row = row.select(F.lit(name).alias("model"), *[F.round(c, 6).alias(c) for c in row.columns])
        rows.append((row.schema, tuple(row.first())))        # one row, read while the scores are kept
        sc.unpersist()
    return test.sparkSession.createDataFrame([r for _, r in rows], rows[0][0])


def _one_row_join(a: DataFrame, b: DataFrame) -> DataFrame:
    """Join two single-row frames on a constant key."""
    return a.withColumn("_k", F.lit(1)).join(b.withColumn("_k", F.lit(1)), "_k").drop("_k")


def model_from_config(config: dict) -> tuple[str, dict]:
    """(kind, params) from a ``{"model": {"type": ..., "args": {...}}}`` config.

    ``MLP`` maps to the perceptron with the configured hidden sizes; ``DBN`` (a
    stacked-RBM network, not built) is served by the same perceptron with its
    hidden sizes; other names map to the classic models."""
    m = config.get("model", config)
    kind, args = m.get("type"), dict(m.get("args", {}))
    import re
    numbered = sorted((int(mm.group(1)), v) for k, v in args.items() if (mm := re.fullmatch(r"hidden(\d+)_size", k)))
    hidden = ([v for _, v in numbered] or args.get("hidden_sizes") or args.get("n_hidden") or [128, 64, 32])
    if isinstance(hidden, int):
        hidden = [hidden]
    if kind in ("MLP", "DBN"):
        return "mlp", {"hidden": list(hidden), "maxIter": int(args.get("max_iter", 200))}
    table = {"LogisticRegression": "logreg", "DecisionTree": "tree", "RandomForest": "forest",
             "GradientBoosting": "gbt_ovr", "XGB": "gbt_ovr"}
    if kind not in table:
        raise NotImplementedError(f"no classifier for model type {kind!r}; known are MLP, DBN and {sorted(table)}")
    return table[kind], args
