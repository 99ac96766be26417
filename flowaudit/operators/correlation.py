"""Correlation, redundancy and variance structure (A21-A27, C11-C13 decisions).

Pairwise-complete Pearson needs, for every pair (i, j), sums over the rows
where both values are present.  Each task folds its Arrow batches into four
p x p matrices with numpy (counts, sums, sums of squares, cross products on
values shifted by the column means); one vector per task is summed with
``Summarizer`` and only the p x p result reaches the driver.  One scan, no
shuffle of rows, memory O(p^2) per task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.missing import nan_to_null


def _means(df: DataFrame, cols) -> np.ndarray:
    row = df.agg(*[F.avg(nan_to_null(F.col(c).cast("double"))).alias(f"m{i}")
                   for i, c in enumerate(cols)]).first()
    return np.array([0.0 if row[i] is None else float(row[i]) for i in range(len(cols))])


def gram_sums(df: DataFrame, cols) -> dict[str, np.ndarray]:
    """Pairwise-complete moment matrices N, SX, SXX, P, LO, HI (see module doc).

    Entry [i, j] of SX is the sum of (x_i - m_i) over rows where x_i and x_j
    are both present; P[i, j] is the sum of the centred cross product; LO and
    HI are the extremes of x_i on those rows."""
    cols = list(cols)
    p = len(cols)
    shift = _means(df, cols)
    sel = df.select(*[nan_to_null(F.col(c).cast("double")).alias(f"c{i}") for i, c in enumerate(cols)])

    def fold(batches):
        n = np.zeros((p, p)); sx = np.zeros((p, p)); sxx = np.zeros((p, p)); pr = np.zeros((p, p))
        lo = np.full((p, p), np.inf); hi = np.full((p, p), -np.inf)
        for pdf in batches:
            raw = pdf.to_numpy(dtype="float64", na_value=np.nan)
            m = ~np.isnan(raw)
            x0 = np.where(m, raw - shift, 0.0)
            mf = m.astype("float64")
            n += mf.T @ mf
            sx += x0.T @ mf
            sxx += (x0 * x0).T @ mf
            pr += x0.T @ x0
            # columns with the same missing rows share their extremes
            masks, owner = np.unique(m, axis=1, return_inverse=True)
            for k in range(masks.shape[1]):
                rows = raw[masks[:, k]]
                js = np.flatnonzero(owner.ravel() == k)
                if len(rows):
                    lo[:, js] = np.fmin(lo[:, js], np.fmin.reduce(rows, axis=0)[:, None])
                    hi[:, js] = np.fmax(hi[:, js], np.fmax.reduce(rows, axis=0)[:, None])
        yield pd.DataFrame({"v": [np.concatenate([n.ravel(), sx.ravel(), sxx.ravel(), pr.ravel()]).tolist()],
                            "lo": [lo.ravel().tolist()], "hi": [hi.ravel().tolist()]})

    parts = sel.mapInPandas(fold, "v array<double>, lo array<double>, hi array<double>")
    one = parts.select(*[array_to_vector(c).alias(c) for c in ("v", "lo", "hi")]).agg(
        Summarizer.metrics("sum").summary(F.col("v")).alias("v"),
        Summarizer.metrics("min").summary(F.col("lo")).alias("lo"),
        Summarizer.metrics("max").summary(F.col("hi")).alias("hi")).first()
    total = one["v"]["sum"].toArray()
    n, sx, sxx, pr = (total[k * p * p:(k + 1) * p * p].reshape(p, p) for k in range(4))
    return {"N": n, "SX": sx, "SXX": sxx, "P": pr, "LO": one["lo"]["min"].toArray().reshape(p, p),
            "HI": one["hi"]["max"].toArray().reshape(p, p), "shift": shift}


#: A variance below this share of the squared magnitude is rounding noise of the centred sums.
NO_VARIANCE = 1e-24


def pearson_from_sums(g: dict) -> np.ndarray:
    """r per pair; NaN with fewer than two common rows, and where a column is constant on them."""
    n, sx, sxx, pr = g["N"], g["SX"], g["SXX"], g["P"]
    sy, syy = sx.T, sxx.T
    with np.errstate(divide="ignore", invalid="ignore"):
        cov = pr - sx * sy / n
        vx = sxx - sx * sx / n
        vy = syy - sy * sy / n
        size = np.fmax(np.abs(g["LO"]), np.abs(g["HI"]))
        flat = (g["LO"] == g["HI"]) | (vx <= NO_VARIANCE * n * size * size)
        r = np.clip(cov / np.sqrt(vx * vy), -1.0, 1.0)
    r[(n < 2) | flat | flat.T] = np.nan
    return r


def pearson_matrix(df: DataFrame, cols) -> np.ndarray:
    """P x p pairwise-complete Pearson (NaN where undefined, e.g. constants)."""
    return pearson_from_sums(gram_sums(df, cols))


def matrix_to_pairs(spark, cols, r: np.ndarray, upper_only: bool = True) -> DataFrame:
    """Long form (feature_a, feature_b, r) with a before b in column order."""
    rows = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if (upper_only and j > i) or (not upper_only and i != j):
                v = float(r[i, j])
                rows.append((a, b, v))
    return spark.createDataFrame(rows, "feature_a string, feature_b string, r double")


def pearson_pairs(df: DataFrame, cols) -> DataFrame:
    cols = list(cols)
    return matrix_to_pairs(df.sparkSession, cols, pearson_matrix(df, cols))


def _row_sets(df: DataFrame, cols) -> tuple[list[list[tuple[int, int]]], np.ndarray]:
    """Column pairs (i < j) grouped by the rows on which both are present, and the p x p counts of those rows."""
    p = len(cols)
    here = [F.col(c).isNotNull() for c in cols]
    one = df.agg(*[F.count(F.when(here[i] & here[j], 1)).alias(f"n{i}_{j}") for i in range(p) for j in range(i, p)]).first()
    n = np.zeros((p, p), np.int64)
    for i in range(p):
        for j in range(i, p):
            n[i, j] = n[j, i] = one[f"n{i}_{j}"]
    # columns missing in the same rows count as one; where i is present only with j, the pair's rows are those of i
    same = [min(k for k in range(p) if n[k, i] == n[k, k] == n[i, i]) for i in range(p)]
    sets: dict = {}
    for i in range(p):
        for j in range(i + 1, p):
            key = [same[k] for k, o in ((i, j), (j, i)) if n[i, j] == n[k, k]][:1] or sorted((same[i], same[j]))
            sets.setdefault(tuple(key), []).append((i, j))
    return list(sets.values()), n


#: Values of the rows that one task of the rank correlation groups, where the table has more than a core's share.
PART_VALUES = 2_000_000


def spearman_matrix(df: DataFrame, cols, parallelism: int = 4) -> np.ndarray:
    """P x p pairwise-complete Spearman (average ranks for ties): each pair is ranked on the rows
    where both values are present.  NaN with fewer than two of them and where a column is constant.

    Pairs with the same rows share one run of Spark ML's distributed rank correlation: one run in all
    without missing values, at most one per pair."""
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import StorageLevel
    from pyspark.ml.feature import VectorAssembler
    cols = list(cols)
    p = len(cols)
    clean = df.select(*[nan_to_null(F.col(c).cast("double")).alias(f"c{i}") for i, c in enumerate(cols)]) \
        .persist(StorageLevel.MEMORY_AND_DISK)
    out = np.full((p, p), np.nan)
    try:
        sets, n = _row_sets(clean, clean.columns)
        out[np.diag_indices(p)] = np.where(np.diag(n) > 0, 1.0, np.nan)

        def run(pairs):
            used = sorted({k for pair in pairs for k in pair})
            names = [f"c{k}" for k in used]
            # its groups by row hold a partition's values at once
            rows = clean.select(*names).na.drop()
            values = int(n[pairs[0]]) * len(names)
            if values > rows.sparkSession.sparkContext.defaultParallelism * PART_VALUES:
                rows = rows.repartition(-(-values // PART_VALUES))
            vec = VectorAssembler(inputCols=names, outputCol="_v").transform(rows).select("_v")
            r = Correlation.corr(vec, "_v", "spearman").first()[0].toArray()
            for i, j in pairs:
                out[i, j] = out[j, i] = r[used.index(i), used.index(j)]
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            list(pool.map(run, [s for s in sets if n[s[0]] > 1]))
    finally:
        clean.unpersist()
    return out


def high_corr_pairs(spark, cols, r: np.ndarray, threshold: float = 0.95) -> DataFrame:
    """(later, earlier, r) pairs with |r| > threshold."""
    rows = [(cols[i], cols[j], float(r[i, j])) for i in range(len(cols)) for j in range(i)
            if not np.isnan(r[i, j]) and abs(r[i, j]) > threshold]
    return spark.createDataFrame(rows, "feature_a string, feature_b string, r double")


def correlated_to_drop(cols, r: np.ndarray, threshold: float, policy: str) -> list[str]:
    """Columns removed by the three drop policies.

    * ``signed_earlier`` (C11): r > t, drop the earlier column of each pair
    * ``abs_later``      (C12): |r| > t, drop the later column
    * ``abs_earlier``    (C13): |r| > t, drop the earlier column
    Decisions are made on all pairs at once (no re-evaluation after a drop)."""
    drop = []
    p = len(cols)
    for k, c in enumerate(cols):
        if policy == "signed_earlier":
            hit = any(r[i, k] > threshold for i in range(k + 1, p) if not np.isnan(r[i, k]))
        elif policy == "abs_later":
            hit = any(abs(r[i, k]) > threshold for i in range(k) if not np.isnan(r[i, k]))
        elif policy == "abs_earlier":
            hit = any(abs(r[i, k]) > threshold for i in range(k + 1, p) if not np.isnan(r[i, k]))
        else:
            raise ValueError(policy)
        if hit:
            drop.append(c)
    return drop


def duplicate_column_pairs(df: DataFrame, cols=None) -> DataFrame:
    """Column pairs equal in every row (missing equals missing; same type).

    Pass 1 fingerprints every column in one aggregate: the sum of
    xxhash64(row id, value) with a per-scan row id.  Only columns sharing a
    fingerprint are compared exactly in pass 2 (``bool_and(a <=> b)``)."""
    cols = list(cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)])
    types = {c: df.schema[c].dataType.simpleString() for c in cols}
    norm = {c: (nan_to_null(F.col(c)) + F.lit(0.0) if types[c] in ("double", "float") else F.col(c))
            for c in cols}
    rid = F.monotonically_increasing_id()
    base = df.select(rid.alias("_rid"), *[norm[c].alias(f"c{i}") for i, c in enumerate(cols)])
    fp = base.agg(*[F.sum(F.xxhash64(F.col("_rid"), F.col(f"c{i}")).cast("decimal(38,0)")).alias(f"f{i}")
                    for i in range(len(cols))]).first()
    buckets: dict = {}
    for i, c in enumerate(cols):
        buckets.setdefault((types[c], fp[i]), []).append(i)
    cands = [(a, b) for idx in buckets.values() for x, a in enumerate(idx) for b in idx[x + 1:]]
    spark = df.sparkSession
    if not cands:
        return spark.createDataFrame([], "feature_a string, feature_b string")
    chk = df.agg(*[F.bool_and(norm[cols[a]].eqNullSafe(norm[cols[b]])).alias(f"e{k}")
                   for k, (a, b) in enumerate(cands)]).first()
    rows = [(cols[a], cols[b]) for k, (a, b) in enumerate(cands) if chk[k]]
    return spark.createDataFrame(rows, "feature_a string, feature_b string")


def vif(df: DataFrame, cols) -> DataFrame:
    """Uncentred VIF (regression without intercept) from the Gram matrix
    X'X: VIF_i = G_ii * (G^-1)_ii.  VIF does not depend on units, so G is first
    scaled to a unit diagonal; columns that take part in an exact linear
    dependence (and all-zero columns) get +inf, the others the VIF over the
    independent directions.  Rows with a missing value in ``cols`` are left out."""
    cols = list(cols)
    clean = df.select(*[nan_to_null(F.col(c).cast("double")).alias(f"c{i}") for i, c in enumerate(cols)]).na.drop()
    p = len(cols)
    # powers of two near each column's magnitude keep the sums in range and cost no precision
    top = clean.agg(*[F.max(F.abs(f"c{i}")).alias(f"m{i}") for i in range(p)]).first()
    unit = np.array([2.0 ** -np.frexp(v)[1] if v else 1.0 for v in top])

    def fold(batches):
        g = np.zeros((p, p))
        for pdf in batches:
            x = pdf.to_numpy(dtype="float64") * unit
            g += x.T @ x
        yield pd.DataFrame({"v": [g.ravel().tolist()]})

    tot = clean.mapInPandas(fold, "v array<double>").select(array_to_vector("v").alias("v")).agg(
        Summarizer.metrics("sum").summary(F.col("v")).alias("s")).first()["s"]["sum"].toArray()
    vals = vif_from_gram(tot.reshape(p, p))
    return df.sparkSession.createDataFrame(list(zip(cols, vals)), "feature string, vif double")


def vif_from_gram(g: np.ndarray, tol: float = 1e-12) -> list[float]:
    d = np.sqrt(np.diag(g))
    live = np.flatnonzero(d > 0)
    out = np.full(len(g), np.inf)
    if len(live):
        vals, vecs = np.linalg.eigh(g[np.ix_(live, live)] / np.outer(d[live], d[live]))
        null = vals <= tol * len(live)
        tied = (vecs[:, null] ** 2).sum(axis=1) > 1e-8
        out[live] = np.where(tied, np.inf, (vecs[:, ~null] ** 2 / vals[~null]).sum(axis=1))
    return [float(v) for v in out]


def pca_explained_variance(df: DataFrame, vec_col: str, k: int | None = None, target: float = 0.99) -> DataFrame:
    """Explained-variance ratio per component (over all components),
    its cumulative sum and whether the component is needed for ``target``.
    The first ``k`` components; by default as many as the vectors have."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import vector_to_array
    k = k or df.agg(F.max(F.size(vector_to_array(vec_col)))).first()[0]
    model = PCA(k=k, inputCol=vec_col, outputCol="_pca").fit(df.select(vec_col))
    ev = [float(x) for x in model.explainedVariance.toArray()]
    rows, cum = [], 0.0
    for i, v in enumerate(ev):
        prev = cum
        cum += v
        rows.append((i + 1, v, cum, prev < target))
    return df.sparkSession.createDataFrame(
        rows, "component int, explained_variance_ratio double, cumulative double, needed boolean")
