"""Fitted transformers as Spark ML Estimator/Model pairs.

``fit`` runs one aggregate job over the training rows and keeps a few
numbers per column (a median, a mean and a std, a quantile grid of at most
1000 points); ``transform`` applies them as literals in a single projection
(codegen, no join, no shuffle).  Fitted numbers are stored as a JSON param,
so models persist with the default ML writer (S16).
"""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.missing import nan_to_null, replace_infs
from . import clean as C
from . import profile as A


class _HasStats(Params):
    stats = Param(Params._dummy(), "stats", "fitted statistics (JSON)", TypeConverters.toString)

    def getStats(self) -> dict:
        return json.loads(self.getOrDefault(self.stats))


class _Base(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    method = Param(Params._dummy(), "method", "exact | approx quantiles", TypeConverters.toString)

    def _init(self, inputCols, method="exact"):
        self._setDefault(method="exact")
        if inputCols is not None:
            self._set(inputCols=list(inputCols))
        self._set(method=method)


class _StatsModel(Model, HasInputCols, _HasStats, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self, inputCols=None, stats=None):
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=list(inputCols))
        if stats is not None:
            self._set(stats=json.dumps(stats))


# ---- C5 median imputation ---------------------------------------------------

class MedianImputer(_Base):
    """Exact medians on the fit rows; NULL/NaN -> median."""

    @keyword_only
    def __init__(self, inputCols=None, method="exact"):
        super().__init__()
        self._init(inputCols, method)

    def _fit(self, df: DataFrame):
        cols = self.getInputCols()
        qm = A.quantile_map(A.quantiles(df, cols, [0.5], self.getOrDefault(self.method)))
        return MedianImputerModel(cols, {c: qm.get((c, 0.5)) for c in cols})


class MedianImputerModel(_StatsModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        s = self.getStats()
        return df.withColumns({c: F.coalesce(nan_to_null(F.col(c).cast("double")),
                                             F.lit(s[c]).cast("double")) for c in self.getInputCols()})


# ---- C14 z-score ------------------------------------------------------------

class StandardScaler(_Base):
    """C14: (x - mean) / population std, std 0 -> 1 (fitted on train)."""

    @keyword_only
    def __init__(self, inputCols=None):
        super().__init__()
        self._init(inputCols)

    def _fit(self, df: DataFrame):
        cols = self.getInputCols()
        w = A.wide_stats(df, cols, {"mean": lambda c: F.avg(F.col(c)),
                                    "std": lambda c: F.stddev_pop(F.col(c))}).collect()
        st = {r["feature"]: [r["mean"], r["std"]] for r in w}
        return StandardScalerModel(cols, st)


class StandardScalerModel(_StatsModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        s = self.getStats()
        out = {}
        for c in self.getInputCols():
            mean, std = s[c]
            std = 1.0 if not std else std
            out[c] = (F.col(c) - F.lit(mean or 0.0)) / F.lit(std)
        return df.withColumns(out)


# ---- P14 clip at an upper train percentile ---------------------------------

class ClipUpper(_Base):
    """Cap each column at its ``p``-th train percentile."""

    p = Param(Params._dummy(), "p", "percentile (0-100)", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, inputCols=None, p=99.9, method="exact"):
        super().__init__()
        self._init(inputCols, method)
        self._set(p=p)

    def _fit(self, df: DataFrame):
        cols, q = self.getInputCols(), self.getOrDefault(self.p) / 100.0
        qm = A.quantile_map(A.quantiles(df, cols, [q], self.getOrDefault(self.method)))
        return ClipUpperModel(cols, {c: qm.get((c, round(q, 12))) for c in cols})


class ClipUpperModel(_StatsModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        s = self.getStats()
        return df.withColumns({c: F.least(F.col(c), F.lit(s[c])) for c in self.getInputCols()
                               if s[c] is not None})


# ---- P15 log1p on heavy columns ---------------------------------------------

class Log1pHeavy(_Base):
    """log1p on columns whose train max > 1000 and min >= 0 (the column
    list is fitted once, so train and test transform alike)."""

    @keyword_only
    def __init__(self, inputCols=None):
        super().__init__()
        self._init(inputCols)

    def _fit(self, df: DataFrame):
        cols = self.getInputCols()
        w = A.wide_stats(df, cols, {"lo": lambda c: F.min(nan_to_null(F.col(c))),
                                    "hi": lambda c: F.max(nan_to_null(F.col(c)))}).collect()
        heavy = [r["feature"] for r in w if r["hi"] is not None and r["hi"] > 1000 and r["lo"] >= 0]
        return Log1pHeavyModel(cols, {"heavy": heavy})


class Log1pHeavyModel(_StatsModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.log1p(F.col(c)) for c in self.getStats()["heavy"]})


# ---- C8 / C9 / C12 column droppers ------------------------------------------

class DropColumns(_Base):
    """C8 (``constant``), C7 (``low_std``), C10 (``duplicate``) or C12
    (``correlated``: |r| > threshold, later column) - decided on the fit rows."""

    rule = Param(Params._dummy(), "rule", "constant|low_std|duplicate|correlated", TypeConverters.toString)
    threshold = Param(Params._dummy(), "threshold", "rule threshold", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, inputCols=None, rule="constant", threshold=0.95):
        super().__init__()
        self._init(inputCols)
        self._set(rule=rule, threshold=threshold)

    def _fit(self, df: DataFrame):
        cols, rule = self.getInputCols(), self.getOrDefault(self.rule)
        t = self.getOrDefault(self.threshold)
        if rule == "constant":
            drop = C.constant_column_list(df, cols)
        elif rule == "low_std":
            drop = C.low_std_columns(df, cols, t)
        elif rule == "duplicate":
            drop = C.duplicate_column_list(df, cols)
        elif rule == "correlated":
            drop = C.correlated_column_list(df, cols, t, "abs_later")
        else:
            raise ValueError(rule)
        return DropColumnsModel(cols, {"drop": drop, "keep": [c for c in cols if c not in drop]})


class DropColumnsModel(_StatsModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        return df.drop(*self.getStats()["drop"])

    def kept(self) -> list[str]:
        return self.getStats()["keep"]


# ---- C1 / C6 as stages, and the chain C17 -------------------------------------

class MissingMarker(_StatsModel):
    """C1 as a stage: +-Inf and NaN become NULL."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return replace_infs(df, self.getInputCols())


class FillConstant(_StatsModel):
    """C6 as a stage: missing values become ``stats["value"]``."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return C.fill_constant(df, self.getInputCols(), self.getStats()["value"])


class FlowChain(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """C17: C1 -> C8 (constant columns go) -> C5 median -> C14, or C1 -> C6 zero with ``fillZero``.

    ``fit`` returns one ``PipelineModel`` of the fitted stages, each fitted on
    the rows as the stages before it leave them; :func:`kept_columns` tells the
    features that come out.  It persists with the ML writer and takes further
    stages, such as those of a fitted classifier (``models.whole_pipeline``)."""

    scale = Param(Params._dummy(), "scale", "z-score the columns (C14)", TypeConverters.toBoolean)
    fillZero = Param(Params._dummy(), "fillZero", "fill with zero in place of C8, C5 and C14", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, inputCols=None, scale=True, fillZero=False):
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=list(inputCols))
        self._set(scale=scale, fillZero=fillZero)

    def _fit(self, df: DataFrame):
        cols = self.getInputCols()
        stages = [MissingMarker(cols, {})]
        df = stages[0].transform(df)
        if self.getOrDefault(self.fillZero):
            return PipelineModel([*stages, FillConstant(cols, {"value": 0.0})])
        drop = DropColumns(inputCols=cols, rule="constant").fit(df)
        cols, df = drop.kept(), drop.transform(df)
        stages.append(drop)
        for est in [MedianImputer(inputCols=cols)] + [StandardScaler(inputCols=cols)] * self.getOrDefault(self.scale):
            stages.append(est.fit(df))
            df = stages[-1].transform(df)
        return PipelineModel(stages)


def kept_columns(chain: PipelineModel) -> list[str]:
    """Feature columns that leave a fitted chain."""
    cols = list(chain.stages[0].getInputCols())
    for st in chain.stages:
        if isinstance(st, DropColumnsModel):
            cols = [c for c in cols if c not in st.getStats()["drop"]]
    return cols


# ---- C15 quantile -> uniform ------------------------------------------------

class QuantileUniform(_Base):
    """Map each column through its train CDF onto [0, 1].

    Fit: ``min(n_quantiles, n)`` evenly spaced exact quantiles per column.
    Transform: a vectorised pandas UDF interpolating forward and backward
    (the mean of the two handles repeated quantiles), clipped to [0, 1]."""

    nQuantiles = Param(Params._dummy(), "nQuantiles", "grid size", TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCols=None, nQuantiles=1000, method="exact"):
        super().__init__()
        self._init(inputCols, method)
        self._set(nQuantiles=nQuantiles)

    def _fit(self, df: DataFrame):
        cols = self.getInputCols()
        n = df.count()
        nq = max(2, min(self.getOrDefault(self.nQuantiles), n))
        refs = np.linspace(0.0, 1.0, nq).tolist()
        qm = A.quantile_map(A.quantiles(df, cols, refs, self.getOrDefault(self.method)))
        grid = {c: [qm.get((c, round(p, 12))) for p in refs] for c in cols}
        return QuantileUniformModel(cols, {"refs": refs, "grid": grid})


def _uniform_udf(q, refs):
    q = np.asarray(q, dtype="float64")
    refs = np.asarray(refs, dtype="float64")

    @F.pandas_udf(T.DoubleType())
    def to_uniform(x: pd.Series) -> pd.Series:
        v = x.to_numpy(dtype="float64", na_value=np.nan)
        up = np.interp(v, q, refs)
        down = -np.interp(-v, -q[::-1], -refs[::-1])
        y = 0.5 * (up + down)
        y = np.where(v <= q[0], refs[0], y)
        y = np.where(v >= q[-1], refs[-1], y)
        y = np.clip(y, 0.0, 1.0)
        return pd.Series(np.where(np.isnan(v), np.nan, y))

    return to_uniform


class QuantileUniformModel(_StatsModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        s = self.getStats()
        return df.withColumns({c: _uniform_udf(s["grid"][c], s["refs"])(F.col(c).cast("double"))
                               for c in self.getInputCols() if None not in s["grid"][c]})


# ---- C16 centred PCA --------------------------------------------------------

class CentredPCA(_Base):
    """Centre with train means, then ``ml.PCA`` (which does not centre);
    ``k=None`` picks the smallest k reaching ``target`` explained variance."""

    k = Param(Params._dummy(), "k", "components", TypeConverters.toInt)
    target = Param(Params._dummy(), "target", "variance share", TypeConverters.toFloat)
    outputCol = Param(Params._dummy(), "outputCol", "output vector", TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCols=None, k=0, target=0.99, outputCol="pca"):
        super().__init__()
        self._init(inputCols)
        self._set(k=k, target=target, outputCol=outputCol)

    def _fit(self, df: DataFrame):
        from pyspark.ml.feature import PCA, VectorAssembler
        cols = self.getInputCols()
        means = {r["feature"]: r["mean"] for r in A.wide_stats(
            df, cols, {"mean": lambda c: F.avg(F.col(c))}).collect()}
        centred = df.select(*[(F.col(c) - F.lit(means[c])).alias(c) for c in cols])
        vec = VectorAssembler(inputCols=cols, outputCol="_v").transform(centred)
        k = self.getOrDefault(self.k)
        full = PCA(k=len(cols), inputCol="_v", outputCol="_p").fit(vec)
        ev = full.explainedVariance.toArray()
        if not k:
            k = int(np.searchsorted(np.cumsum(ev), self.getOrDefault(self.target) - 1e-12) + 1)
            k = min(k, len(cols))
        pc = full.pc.toArray()[:, :k]
        return CentredPCAModel(cols, {"means": [means[c] for c in cols], "pc": pc.tolist(),
                                      "explained": ev[:k].tolist(), "out": self.getOrDefault(self.outputCol)})


class CentredPCAModel(_StatsModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        s = self.getStats()
        cols = self.getInputCols()
        pc = np.asarray(s["pc"], dtype=float)
        # one small matrix literal, walked per row: p x k separate terms would be p x k expressions to compile
        x = F.array(*[F.col(c).cast("double") - F.lit(float(m)) for c, m in zip(cols, s["means"])])
        axes = F.array(*[F.array(*[F.lit(float(v)) for v in pc[:, j]]) for j in range(pc.shape[1])])
        dot = lambda w: F.aggregate(F.zip_with(F.col("_x"), w, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)
        comps = [F.col("_pc")[j].alias(f"pc{j + 1}") for j in range(pc.shape[1])]
        df = df.withColumn("_x", x).withColumn("_pc", F.transform(axes, dot)).drop("_x")
        return df.select("*", *comps).drop("_pc")


# ---- C21 importance-based selection -----------------------------------------

class ImportanceSelector(_Base):
    """Keep features whose random-forest importance >= the mean, at most ``maxFeatures``."""

    labelCol = Param(Params._dummy(), "labelCol", "label", TypeConverters.toString)
    maxFeatures = Param(Params._dummy(), "maxFeatures", "cap", TypeConverters.toInt)
    numTrees = Param(Params._dummy(), "numTrees", "trees", TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCols=None, labelCol="label", maxFeatures=25, numTrees=10):
        super().__init__()
        self._init(inputCols)
        self._set(labelCol=labelCol, maxFeatures=maxFeatures, numTrees=numTrees)

    def _fit(self, df: DataFrame):
        from pyspark.ml.classification import RandomForestClassifier
        from pyspark.ml.feature import VectorAssembler
        cols = self.getInputCols()
        vec = VectorAssembler(inputCols=cols, outputCol="_v", handleInvalid="keep").transform(df)
        rf = RandomForestClassifier(featuresCol="_v", labelCol=self.getOrDefault(self.labelCol),
                                    numTrees=self.getOrDefault(self.numTrees), seed=42).fit(vec)
        imp = rf.featureImportances.toArray()
        order = sorted(range(len(cols)), key=lambda i: (-imp[i], i))
        keep = [i for i in order if imp[i] >= imp.mean()][: self.getOrDefault(self.maxFeatures)]
        keep_cols = [cols[i] for i in sorted(keep)]
        return DropColumnsModel(cols, {"drop": [c for c in cols if c not in keep_cols], "keep": keep_cols})
