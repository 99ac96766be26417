"""Data-quality profiling.

Column statistics that need no grouping (counts, min/max, moments,
count_if) run as ONE wide aggregate: each task folds its rows into a single
buffer per column, one row per task is shuffled, and the result row is
reshaped with ``stack``.  Only value tables unpivot to (feature, value) and
shuffle; quantiles keep the few values around each target rank.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.missing import INF, is_missing, nan_to_null
from ..functions.rowwise import port_bucket
from ..schema import BENIGN
from ..session import cut_lineage
from .ordered import prefix_sums


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    """Dtype-driven column selection."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in set(exclude)]


def _q(name: str) -> str:
    return "'" + name.replace("\\", "\\\\").replace("'", "\\'") + "'"


def wide_stats(df: DataFrame, cols, metrics: dict) -> DataFrame:
    """One aggregate pass; ``metrics`` maps a name to ``fn(column_name) -> Column``.

    Returns (feature, <metric>...) - one row per column."""
    cols = list(cols)
    aggs = [fn(c).alias(f"m{j}_{i}") for i, c in enumerate(cols) for j, fn in enumerate(metrics.values())]
    wide = df.agg(*aggs)
    names = list(metrics)
    casts = {}
    for j in range(len(names)):
        types = {wide.schema[f"m{j}_{i}"].dataType.simpleString() for i in range(len(cols))}
        if len(types) > 1:
            casts.update({f"m{j}_{i}": F.col(f"m{j}_{i}").cast("double") for i in range(len(cols))})
    if casts:
        wide = wide.withColumns(casts)
    parts = []
    for i, c in enumerate(cols):
        parts.append(_q(c))
        parts += [f"m{j}_{i}" for j in range(len(names))]
    stack = f"stack({len(cols)}, {', '.join(parts)}) AS (feature, {', '.join(names)})"
    return wide.selectExpr(stack)


# ---- A1, A14 ----------------------------------------------------------------

def shape(df: DataFrame, label: str | None = None) -> DataFrame:
    """A1 (+A14): rows, columns, numeric and categorical column counts."""
    num = len(numeric_columns(df))
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    if label:
        aggs.append(F.count_distinct(label).alias("n_labels"))
    return df.agg(*aggs).select(
        "*", F.lit(len(df.columns)).alias("n_columns"), F.lit(num).alias("n_numeric"),
        F.lit(len(df.columns) - num).alias("n_categorical"))


def dtype_histogram(df: DataFrame) -> DataFrame:
    """A1: number of columns per data type (schema only, no scan)."""
    spark = df.sparkSession
    rows = {}
    for f in df.schema.fields:
        rows[f.dataType.simpleString()] = rows.get(f.dataType.simpleString(), 0) + 1
    return spark.createDataFrame(sorted(rows.items()), "dtype string, n_columns int")


# ---- A3-A9 ------------------------------------------------------------------

def missing_counts(df: DataFrame, cols=None, only_positive: bool = False) -> DataFrame:
    """A3/A4: (feature, n_missing, frac_missing); NULL and NaN are missing."""
    cols = list(cols or df.columns)
    frac = {c: isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)) for c in cols}
    out = wide_stats(df, cols, {
        "n_missing": lambda c: F.count_if(is_missing(c, frac[c])),
        "n_rows": lambda c: F.count(F.lit(1)),
    })
    out = out.select("feature", F.col("n_missing").cast("bigint").alias("n_missing"),
                     (F.col("n_missing") / F.nullif(F.col("n_rows"), F.lit(0))).alias("frac_missing"))
    return out.where("n_missing > 0") if only_positive else out


def inf_counts(df: DataFrame, cols=None) -> DataFrame:
    """A5: (feature, n_inf) for columns with at least one +-Inf."""
    cols = [c for c in (cols or numeric_columns(df))
            if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))]
    if not cols:
        return df.sparkSession.createDataFrame([], "feature string, n_inf bigint")
    out = wide_stats(df, cols, {"n_inf": lambda c: F.count_if(F.abs(F.col(c)) == F.lit(INF))})
    return out.select("feature", F.col("n_inf").cast("bigint")).where("n_inf > 0")


def all_finite(df: DataFrame, cols=None) -> DataFrame:
    """True when no NULL, NaN or Inf appears in ``cols``."""
    cols = list(cols or numeric_columns(df))
    cond = F.lit(True)
    for c in cols:
        x = F.col(c).cast("double")
        cond = cond & x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(INF))
    return df.agg(F.coalesce(F.bool_and(cond), F.lit(True)).alias("all_finite"))


def missing_row_labels(df: DataFrame, cols, label: str) -> DataFrame:
    """Distinct labels of rows with any missing value in ``cols``."""
    cond = F.lit(False)
    for c in cols:
        cond = cond | is_missing(c, isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)))
    return df.where(cond).select(label).distinct()


def constant_columns(df: DataFrame, cols=None) -> DataFrame:
    """Columns with at most one distinct non-missing value.

    nunique <= 1  <=>  min = max (or no values) - a wide aggregate, no value table."""
    cols = list(cols or numeric_columns(df))
    out = wide_stats(df, cols, {
        "lo": lambda c: F.min(nan_to_null(F.col(c).cast("double"))),
        "hi": lambda c: F.max(nan_to_null(F.col(c).cast("double"))),
    })
    return out.where(F.col("lo").isNull() | (F.col("lo") == F.col("hi"))).select("feature")


def _counters(p: int, size: int):
    """A task's summary of each column: at most ``size`` values with counts, of which none is above the true one.

    Values of a batch are counted, added to the summary, and cut back to
    ``size`` by taking the next largest count off all (Misra and Gries): a value
    with more than a ``1 / (size + 1)`` share of the rows always stays."""
    def run(batches):
        held = [(np.zeros(0), np.zeros(0, np.int64)) for _ in range(p)]
        for b in batches:
            for i in range(p):
                x = b.column(i).to_numpy(zero_copy_only=False)
                v, n = np.unique(np.concatenate((held[i][0], x[~np.isnan(x)])), return_inverse=True)
                count = np.bincount(n, np.concatenate((held[i][1], np.ones(len(n) - len(held[i][0]), np.int64))),
                                    len(v)).astype(np.int64)
                if len(v) > size:
                    count -= np.partition(count, len(count) - size - 1)[len(count) - size - 1]
                    v, count = v[count > 0], count[count > 0]
                held[i] = v, count
        for i, (v, count) in enumerate(held):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), i, np.int32)), pa.array(v), pa.array(count)],
                                             ["f", "value", "cnt"])
    return run


def near_constant_columns(df: DataFrame, cols=None, share: float = 0.99) -> DataFrame:
    """Columns whose most frequent non-missing value has share > ``share``
    (constant columns excluded), with that share.

    Pass 1 summarises each column per task with ``2 / share`` counters, whose
    lower bounds are short by half of the share of the task's rows at most.  So
    a value above the share keeps a sum of half of it or more, which no more
    than ``2 / share`` values can have: the largest sums are the candidates that
    pass 2 counts exactly."""
    if not 0 < share <= 1:
        raise ValueError("share must be above 0 and at most 1")
    cols = list(cols or numeric_columns(df))
    spark = df.sparkSession
    empty = spark.createDataFrame([], "feature string, top_share double")
    vals = df.select(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))).alias(f"x{i}") for i, c in enumerate(cols)])
    size = math.ceil(2 / share)
    total = vals.agg(*[a for i in range(len(cols)) for a in (
        F.count_if(~F.isnan(f"x{i}")), F.min(f"x{i}"), F.max(F.when(~F.isnan(f"x{i}"), F.col(f"x{i}"))))]).first()
    n = {i: total[3 * i] for i in range(len(cols)) if total[3 * i] and total[3 * i + 1] != total[3 * i + 2]}
    if not n:
        return empty
    sums = vals.mapInArrow(_counters(len(cols), size), "f int, value double, cnt long").groupBy("f", "value").agg(F.sum("cnt").alias("cnt"))
    best = sums.withColumn("r", F.row_number().over(Window.partitionBy("f").orderBy(F.col("cnt").desc(), "value"))) \
        .where(F.col("r") <= size)
    candidates: dict[int, list[float]] = {}
    for r in best.select("f", "value").collect():                     # at most 2 / share values per column
        if r[0] in n:
            candidates.setdefault(r[0], []).append(r[1])
    counted = vals.agg(*[F.count_if(F.col(f"x{i}") == F.lit(v)) for i, vs in candidates.items() for v in vs]).first()
    tops, at = {}, 0
    for i, vs in candidates.items():
        tops[i] = max(counted[at:at + len(vs)])
        at += len(vs)
    rows = [(cols[i], tops[i] / n[i]) for i in tops if tops[i] / n[i] > share]
    return spark.createDataFrame(rows, "feature string, top_share double") if rows else empty


def value_table(df: DataFrame, cols) -> DataFrame:
    """A10: (feature, value, cnt); NaN folds into NULL, one shuffle."""
    cols = list(cols)
    long = (df.select(*[nan_to_null(F.col(c).cast("double")).alias(c) for c in cols])
              .unpivot([], cols, "feature", "value"))
    return long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("cnt"))


def std_columns(df: DataFrame, cols=None) -> DataFrame:
    """Sample standard deviation per column (missing ignored)."""
    cols = list(cols or numeric_columns(df))
    return wide_stats(df, cols, {"std": lambda c: F.stddev_samp(nan_to_null(F.col(c).cast("double")))})


def top_variance(df: DataFrame, cols=None, k: int = 20) -> DataFrame:
    """The ``k`` columns with the largest sample variance."""
    cols = list(cols or numeric_columns(df))
    v = wide_stats(df, cols, {"variance": lambda c: F.var_samp(nan_to_null(F.col(c).cast("double")))})
    return v.orderBy(F.col("variance").desc_nulls_last(), "feature").limit(k)


# ---- A11-A13, A29 -----------------------------------------------------------

def label_counts(df: DataFrame, label: str) -> DataFrame:
    """(label, cnt, pct).  The window runs over the aggregated table
    (one row per class), not over the rows."""
    g = df.groupBy(label).agg(F.count(F.lit(1)).alias("cnt"))
    return g.withColumn("pct", F.col("cnt") * 100.0 / F.sum("cnt").over(Window.partitionBy()))


def binary_balance(df: DataFrame, label: str, benign: str = BENIGN) -> DataFrame:
    """Benign and attack counts and the benign:attack ratio."""
    b = F.count_if(F.col(label) == benign)
    a = F.count_if(F.col(label) != benign)
    return df.agg(b.alias("n_benign"), a.alias("n_attack")).withColumn(
        "benign_attack_ratio", F.col("n_benign") / F.nullif(F.col("n_attack"), F.lit(0)))


def per_day(df: DataFrame, day: str, label: str, benign: str = BENIGN) -> DataFrame:
    """Records and attacks per capture day."""
    return df.groupBy(day).agg(F.count(F.lit(1)).alias("n_records"),
                               F.count_if(F.col(label) != benign).alias("n_attacks"))


def class_train_counts(train: DataFrame, label: str, rare_below: int = 100) -> DataFrame:
    """Training rows per class and the rare flag."""
    return (train.groupBy(label).agg(F.count(F.lit(1)).alias("train_count"))
                 .withColumn("rare", F.col("train_count") < rare_below))


# ---- A16, A15, A2 -----------------------------------------------------------

def _merged(pairs) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint closed intervals that cover ``pairs`` of (low, high), ascending."""
    out: list[list[float]] = []
    for lo, hi in sorted(pairs):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return np.array([a for a, _ in out], float), np.array([b for _, b in out], float)


def _bracketed(brackets: list):
    """One pass over the columns: how many values lie in and between the brackets, and the bracketed values.

    Cell ``2 j + 1`` is bracket j, an even cell the gap before or after; a row
    without value holds a cell's count, one with a value that value's count."""
    def run(batches):
        totals = [np.zeros(2 * len(lo) + 1, np.int64) for lo, _ in brackets]
        for b in batches:
            for i, (lo, hi) in enumerate(brackets):
                x = b.column(i).to_numpy(zero_copy_only=False)
                x = x[~np.isnan(x)]
                after, past = np.searchsorted(lo, x, side="right"), np.searchsorted(hi, x, side="left")
                totals[i] += np.bincount(after + past, minlength=len(totals[i]))
                v, n = np.unique(x[after > past], return_counts=True)
                if len(v):
                    cell = 2 * np.searchsorted(lo, v, side="right") - 1
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), i, np.int32)), pa.array(cell.astype(np.int32)),
                                                      pa.array(v), pa.array(n)], ["f", "cell", "value", "cnt"])
        for i, t in enumerate(totals):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(t), i, np.int32)), pa.array(np.arange(len(t), dtype=np.int32)),
                                              pa.nulls(len(t), pa.float64()), pa.array(t)], ["f", "cell", "value", "cnt"])
    return run


def quantiles(df: DataFrame, cols, probs, method: str = "exact",
              accuracy: int = 10_000) -> DataFrame:
    """(feature, p, q) with linear interpolation (numpy / quantile_cont).

    ``exact``: a mergeable sketch (one wide aggregate) brackets every target
    rank between two values; one scan then counts what lies in and between the
    brackets and keeps only the bracketed values, a few per ten thousand, whose
    running counts give the values at the ranks.  The counts show whether a
    rank missed its bracket; then the brackets are widened and scanned again.
    The driver sees counts per bracket and two values per target, nothing that
    grows with the rows.  Columns without a value are left out.
    ``approx``: ``percentile_approx`` sketches in one wide aggregate."""
    cols, probs = list(cols), [float(p) for p in probs]
    spark = df.sparkSession
    if method == "approx":
        w = wide_stats(df, cols, {"qs": lambda c: F.percentile_approx(
            nan_to_null(F.col(c).cast("double")), F.array(*[F.lit(p) for p in probs]), accuracy)})
        return (w.select("feature", F.posexplode("qs").alias("j", "q"))
                 .select("feature", F.element_at(F.array(*[F.lit(p) for p in probs]), F.col("j") + 1).alias("p"), "q"))
    vals = df.select(*[nan_to_null(F.col(f"`{c}`").cast("double")).alias(f"x{i}") for i, c in enumerate(cols)])
    accuracy, slack = max(accuracy, 100 * len(probs)), 2.0
    out: list[tuple] = []
    todo = list(range(len(cols)))
    while todo:
        e = slack / accuracy
        points = sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-e, e)})
        row = vals.agg(*[a for i in todo for a in (
            F.count(f"x{i}"), F.min(f"x{i}"), F.max(f"x{i}"), F.percentile_approx(f"x{i}", points, accuracy))]).first()
        sizes, brackets = {}, []
        for k, i in enumerate(todo):
            n, lo, hi, at = row[4 * k:4 * k + 4]
            sizes[i] = n
            if n == 0:
                brackets.append((np.zeros(0), np.zeros(0)))
            elif n <= accuracy or slack > accuracy:
                brackets.append((np.array([lo]), np.array([hi])))
            else:
                near = dict(zip(points, at))
                brackets.append(_merged([(lo if p - e <= 0 else near[p - e], hi if p + e >= 1 else near[p + e]) for p in probs]))
        kept = cut_lineage(vals.select(*[F.coalesce(f"x{i}", F.lit(float("nan"))).alias(f"x{i}") for i in todo])
                           .mapInArrow(_bracketed(brackets), "f int, cell int, value double, cnt long"))
        cells: dict[tuple[int, int], int] = {(r[0], r[1]): r[2] for r in kept.where("value IS NULL").groupBy("f", "cell")
                                             .agg(F.sum("cnt")).collect()}
        asked, where, missed = {}, {}, []
        for k, i in enumerate(todo):
            size = np.array([cells.get((k, c), 0) for c in range(2 * len(brackets[k][0]) + 1)])
            ends = np.cumsum(size)
            ranks = {r for p in probs if sizes[i] for r in (math.floor(p * (sizes[i] - 1)), math.ceil(p * (sizes[i] - 1)))}
            cell = {r: int(np.searchsorted(ends, r, side="right")) for r in ranks}
            if any(c % 2 == 0 for c in cell.values()):
                missed.append(i)
                continue
            for r, c in cell.items():
                asked.setdefault((k, c), []).append(r - int(ends[c] - size[c]))
                where[i, r] = (k, c, r - int(ends[c] - size[c]))
        found = {}
        if asked:
            targets = spark.createDataFrame([(k, c, sorted(r)) for (k, c), r in asked.items()], "f int, cell int, ranks array<long>")
            running = prefix_sums(kept.where("value IS NOT NULL").groupBy("f", "cell", "value").agg(F.sum("cnt").alias("cnt")),
                                  "value", ["cnt"], group_cols=["f", "cell"])
            hit = F.filter("ranks", lambda r: (r >= F.col("cum_cnt") - F.col("cnt")) & (r < F.col("cum_cnt")))
            # one row per bracket that is asked: columns x probabilities at most
            found = {(r[0], r[1], r[2]): r[3] for r in running.join(F.broadcast(targets), ["f", "cell"])
                     .select("f", "cell", F.explode(hit), "value").collect()}
        for i in todo:
            if i in missed or not sizes[i]:
                continue
            for p in probs:
                pos = p * (sizes[i] - 1)
                a, b = found[where[i, math.floor(pos)]], found[where[i, math.ceil(pos)]]
                out.append((cols[i], p, a + (b - a) * (pos - math.floor(pos))))
        todo, slack = missed, slack * 8
    return spark.createDataFrame(out, "feature string, p double, q double")


def quantile_map(qdf: DataFrame) -> dict:
    """Collect a small quantile table as {(feature, p): q} (features x probs rows)."""
    return {(r["feature"], round(r["p"], 12)): r["q"] for r in qdf.collect()}


def iqr_outlier_counts(df: DataFrame, cols, k: float = 1.5, method: str = "exact") -> DataFrame:
    """Per feature, the bounds and the number of values outside them.
    Bounds (2 numbers per feature) are applied as literals in a wide aggregate."""
    cols = list(cols)
    qm = quantile_map(quantiles(df, cols, [0.25, 0.75], method))
    out = []
    for c in cols:
        q1, q3 = qm.get((c, 0.25)), qm.get((c, 0.75))
        out.append((c, q1, q3))
    bounds = {c: (q1 - k * (q3 - q1), q3 + k * (q3 - q1)) for c, q1, q3 in out if q1 is not None}
    w = wide_stats(df, list(bounds), {"n_outliers": lambda c: F.count_if(
        (F.col(c) < F.lit(bounds[c][0])) | (F.col(c) > F.lit(bounds[c][1])))})
    spark = df.sparkSession
    b = spark.createDataFrame([(c, bounds[c][0], bounds[c][1]) for c in bounds],
                              "feature string, lower double, upper double")
    return b.join(w.select("feature", F.col("n_outliers").cast("bigint")), "feature")


def describe(df: DataFrame, cols=None, method: str = "exact") -> DataFrame:
    """A2 (numeric): count, mean, std, min, 25%, 50%, 75%, max per column."""
    cols = list(cols or numeric_columns(df))
    vals = {c: nan_to_null(F.col(c).cast("double")) for c in cols}
    m = wide_stats(df, cols, {
        "count": lambda c: F.count(vals[c]), "mean": lambda c: F.avg(vals[c]),
        "std": lambda c: F.stddev_samp(vals[c]), "min": lambda c: F.min(vals[c]),
        "max": lambda c: F.max(vals[c]),
    })
    q = (quantiles(df, cols, [0.25, 0.5, 0.75], method)
         .groupBy("feature").pivot("p", [0.25, 0.5, 0.75]).agg(F.first("q")))
    q = q.toDF("feature", "p25", "p50", "p75")
    return m.join(q, "feature", "left").select(
        "feature", F.col("count").cast("bigint").alias("count"), "mean", "std", "min",
        "p25", "p50", "p75", "max")


def top_value(df: DataFrame, col: str) -> DataFrame:
    """A2 (categorical): (feature, count, unique, top, freq); ties -> smallest value."""
    g = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("cnt"))
    return g.agg(
        F.sum("cnt").alias("count"), F.count(F.lit(1)).alias("unique"),
        F.min_by(F.col(col), F.struct(-F.col("cnt"), F.col(col))).alias("top"),
        F.max("cnt").alias("freq"),
    ).select(F.lit(col).alias("feature"), "count", "unique", "top", "freq")


# ---- A17, A18 ---------------------------------------------------------------

def histogram_by_class(df: DataFrame, col: str, label: str, bins: int = 50,
                       clip_p: float = 0.99, method: str = "exact", mode: str = "clip") -> DataFrame:
    """Share of each class's rows per bin (the data behind the distribution plots).

    ``clip``: finite values up to the ``clip_p`` quantile (larger ones are left
    out), ``bins`` equal-width bins over [min, quantile].
    ``symlog``: +-Inf -> missing -> median, and when the maximum exceeds 1000
    the values are binned on ``sign(x) * log1p(|x|)``."""
    x = nan_to_null(F.col(col).cast("double"))
    if mode == "clip":
        finite = df.where(x.isNotNull() & (F.abs(x) != F.lit(INF)))
        upper = quantile_map(quantiles(finite, [col], [clip_p], method))[(col, round(clip_p, 12))]
        src = finite.where(x <= F.lit(upper)).select(label, x.alias("_x"))
    elif mode == "symlog":
        clean = F.when(F.abs(x) == F.lit(INF), F.lit(None)).otherwise(x)
        base = df.select(label, clean.alias("_x"))
        med = quantile_map(quantiles(base, ["_x"], [0.5], method)).get(("_x", 0.5))
        src = base.withColumn("_x", F.coalesce(F.col("_x"), F.lit(med)))
        if (src.agg(F.max("_x")).first()[0] or 0) > 1000:
            src = src.withColumn("_x", F.signum("_x") * F.log1p(F.abs("_x")))
    else:
        raise ValueError(mode)
    lo, hi = src.agg(F.min("_x"), F.max("_x")).first()
    width = (hi - lo) if hi is not None and hi > lo else 1.0
    b = F.least(F.floor((F.col("_x") - F.lit(lo)) / F.lit(width) * bins), F.lit(bins - 1)).cast("int")
    g = src.groupBy(label, b.alias("bin")).agg(F.count(F.lit(1)).alias("cnt"))
    return g.withColumn("share", F.col("cnt") / F.sum("cnt").over(Window.partitionBy(label)))


def port_bucket_counts(df: DataFrame, port: str, label: str, benign: str = BENIGN) -> DataFrame:
    """Port bucket x Benign/Malicious counts, the '0' bucket removed."""
    kind = F.when(F.col(label) == benign, "Benign").otherwise("Malicious")
    return (df.select(port_bucket(port).alias("port_bucket"), kind.alias("kind"))
              .where(F.col("port_bucket") != "0")
              .groupBy("port_bucket").pivot("kind", ["Benign", "Malicious"]).count()
              .na.fill(0, ["Benign", "Malicious"]))
