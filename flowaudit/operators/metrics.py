"""Evaluation metrics (E1-E25) as Spark aggregates.

Scored input contract: one row per test row with the true class, the
predicted class and, for ranking metrics, a score.  Every confusion-based
metric reads one tiny table - ``groupBy(by, y, pred).count()`` - built with
partial aggregation, so the scored rows are scanned once whatever their
size.  Ranking metrics (ROC, PR, AUC, AP) first collapse rows to distinct
scores, then run bucketed prefix sums (:mod:`ordered`) - never a window over
the whole table.  Every function takes ``by`` grouping columns (model,
split, bootstrap iteration, class ...), so many evaluations share one pass.
Division by zero gives 0 where the reference library does, via ``try_divide``.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage, spread
from .ordered import hash_unit, prefix_sums


_G = "_fa_g"


def _with_group(df: DataFrame, by):
    """Ungrouped calls get a constant pseudo-group, so totals join on a key
    (no cartesian products anywhere)."""
    by = list(by)
    return (df, by) if by else (df.withColumn(_G, F.lit(0)), [_G])


def _div(a: Column, b: Column, zero=0.0) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(zero))


# ---- E1-E9: confusion-based ---------------------------------------------------

def confusion_counts(scored: DataFrame, y: str, pred: str, by=(), weight: str | None = None) -> DataFrame:
    """(by..., y_true, y_pred, cnt) - observed cells only."""
    w = F.sum(F.col(weight)) if weight else F.count(F.lit(1))
    return scored.groupBy(*by, F.col(y).alias("y_true"), F.col(pred).alias("y_pred")).agg(w.alias("cnt"))


def confusion_matrix(scored: DataFrame, y: str, pred: str, by=()) -> DataFrame:
    """Every (true, predicted) cell over the union of classes, zeros included.
    The class grid is exploded from the per-group class set (bounded by the
    class count), never from the rows."""
    user_by = list(by)
    sc, by = _with_group(scored, user_by)
    cm = confusion_counts(sc, y, pred, by)
    cls = cm.groupBy(*by).agg(F.array_union(F.collect_set("y_true"), F.collect_set("y_pred")).alias("cs"))
    grid = cls.select(*by, F.explode("cs").alias("y_true"), "cs").select(*by, "y_true", F.explode("cs").alias("y_pred"))
    out = grid.join(cm, by + ["y_true", "y_pred"], "left").na.fill(0, ["cnt"])
    return out.drop(_G) if not user_by else out


def normalised_confusion(scored: DataFrame, y: str, pred: str, by=()) -> DataFrame:
    """``row_norm`` = cnt / row total (recall view), ``col_norm`` = cnt / column total."""
    by = list(by)
    cm = confusion_matrix(scored, y, pred, by)
    return (cm.withColumn("row_norm", _div(F.col("cnt"), F.sum("cnt").over(Window.partitionBy(*by, "y_true"))))
              .withColumn("col_norm", _div(F.col("cnt"), F.sum("cnt").over(Window.partitionBy(*by, "y_pred")))))


def class_stats(cm: DataFrame, by=()) -> DataFrame:
    """(by..., cls, tp, p, t, total) from a confusion-count table.

    Every cell contributes to the true-class and the predicted-class rows
    (explode), so one aggregate yields all per-class counts - no joins."""
    user_by = list(by)
    cm, by = _with_group(cm, user_by)
    zero = F.lit(0).cast(cm.schema["cnt"].dataType)
    contrib = F.array(
        F.struct(F.col("y_true").alias("cls"), F.col("cnt").alias("t"), zero.alias("p"),
                 F.when(F.col("y_true") == F.col("y_pred"), F.col("cnt")).otherwise(zero).alias("tp")),
        F.struct(F.col("y_pred").alias("cls"), zero.alias("t"), F.col("cnt").alias("p"), zero.alias("tp")))
    st = (cm.select(*by, F.explode(contrib).alias("c"))
            .groupBy(*by, F.col("c.cls").alias("cls"))
            .agg(F.sum("c.tp").alias("tp"), F.sum("c.p").alias("p"), F.sum("c.t").alias("t")))
    st = st.withColumn("total", F.sum("t").over(Window.partitionBy(*by)))
    return st.drop(_G) if not user_by else st


def _fbeta(tp: Column, p: Column, t: Column, beta: float) -> Column:
    b2 = beta * beta
    return _div((1 + b2) * tp, (1 + b2) * tp + F.lit(b2) * (t - tp) + (p - tp))


def per_class_report(scored: DataFrame, y: str, pred: str, by=(), beta: float = 2.0) -> DataFrame:
    """E5: precision, recall, F1 (and F-beta) per class with support; 0 on zero division."""
    st = class_stats(confusion_counts(scored, y, pred, by), by)
    return st.select(*by, F.col("cls").alias("class"),
                     _div(F.col("tp"), F.col("p")).alias("precision"),
                     _div(F.col("tp"), F.col("t")).alias("recall"),
                     _fbeta(F.col("tp"), F.col("p"), F.col("t"), 1.0).alias("f1"),
                     _fbeta(F.col("tp"), F.col("p"), F.col("t"), beta).alias(f"f{beta:g}"),
                     F.col("t").alias("support"))


def summary_from_stats(st: DataFrame, by=(), beta: float = 2.0) -> DataFrame:
    """E4, E6-E8 from class statistics (one row per ``by`` group)."""
    by = list(by)
    prec = _div(F.col("tp"), F.col("p"))
    rec = _div(F.col("tp"), F.col("t"))
    f1 = _fbeta(F.col("tp"), F.col("p"), F.col("t"), 1.0)
    fb = _fbeta(F.col("tp"), F.col("p"), F.col("t"), beta)
    agg = [
        _div(F.sum("tp"), F.first("total")).alias("accuracy"),
        F.avg(F.when(F.col("t") > 0, rec)).alias("balanced_accuracy"),
        F.avg(prec).alias("macro_precision"),
        F.avg(rec).alias("macro_recall"),
        F.avg(f1).alias("macro_f1"),
        _div(F.sum(f1 * F.col("t")), F.sum("t")).alias("weighted_f1"),
        F.avg(fb).alias(f"macro_f{beta:g}"),
        F.sum("tp").alias("_c"), F.first("total").alias("_s"),
        F.sum(F.col("p") * F.col("t")).alias("_pt"),
        F.sum(F.col("p") * F.col("p")).alias("_pp"),
        F.sum(F.col("t") * F.col("t")).alias("_tt"),
        F.count_if(F.col("t") > 0).alias("n_true_classes"),
    ]
    g = st.groupBy(*by).agg(*agg) if by else st.agg(*agg)
    s, c = F.col("_s").cast("double"), F.col("_c").cast("double")
    den = F.sqrt((s * s - F.col("_pp")) * (s * s - F.col("_tt")))
    mcc = F.when(den > 0, (c * s - F.col("_pt")) / den).otherwise(F.lit(0.0))
    return g.withColumn("mcc", mcc).drop("_c", "_s", "_pt", "_pp", "_tt")


def summary_metrics(scored: DataFrame, y: str, pred: str, by=(), beta: float = 2.0) -> DataFrame:
    """E4 + E6 + E7 (macro) + E8 (multiclass MCC)."""
    return summary_from_stats(class_stats(confusion_counts(scored, y, pred, by), by), by, beta).drop("n_true_classes")


def binary_counts(scored: DataFrame, y: str, pred: str, by=(), weight: str | None = None) -> DataFrame:
    """Tn, fp, fn, tp for 0/1 labels."""
    yy, pp = F.col(y) == 1, F.col(pred) == 1
    w = F.col(weight) if weight else F.lit(1)

    def cnt(cond):
        return F.sum(F.when(cond, w).otherwise(0))
    agg = [cnt(~yy & ~pp).alias("tn"), cnt(~yy & pp).alias("fp"), cnt(yy & ~pp).alias("fn"), cnt(yy & pp).alias("tp")]
    return scored.groupBy(*by).agg(*agg) if by else scored.agg(*agg)


def binary_from_counts(c: DataFrame, beta: float = 2.0) -> DataFrame:
    """E7 (binary F-beta), E8 (binary MCC), E9 (FAR, FNR), E23 from tn/fp/fn/tp."""
    tn, fp, fn, tp = (F.col(x).cast("double") for x in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    den = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    b2 = beta * beta
    return c.select(
        "*",
        _div(tp + tn, n).alias("accuracy"),
        ((_div(tp, tp + fn) + _div(tn, tn + fp)) / 2).alias("balanced_accuracy"),
        _div(tp, tp + fp).alias("precision"),
        _div(tp, tp + fn).alias("recall"),
        _div(2 * tp, 2 * tp + fp + fn).alias("f1"),
        _div((1 + b2) * tp, (1 + b2) * tp + b2 * fn + fp).alias(f"f{beta:g}"),
        F.when(den > 0, (tp * tn - fp * fn) / den).otherwise(F.lit(0.0)).alias("mcc"),
        _div(fp, fp + tn).alias("far"),
        _div(fn, fn + tp).alias("fnr"),
        _div((tp + fp) * 10000, n).alias("alerts_per_10k"),
    )


# ---- E10-E13: ranking metrics --------------------------------------------------

def score_table(scored: DataFrame, y: str, score: str, by=(), positive=1) -> DataFrame:
    """(by..., score, pos, neg) - one row per distinct score (ties collapse)."""
    is_pos = F.col(y) == F.lit(positive)
    return scored.groupBy(*by, F.col(score).alias("score")).agg(
        F.count_if(is_pos).alias("pos"), F.count_if(~is_pos).alias("neg"))


def _curve(st: DataFrame, by) -> DataFrame:
    """Descending cumulative tp/fp per distinct score plus class totals."""
    user_by = list(by)
    st, by = _with_group(st, user_by)
    # distinct scores feed the bucket splits, the totals and the running sums
    st = cut_lineage(st)
    c = prefix_sums(st, "score", ["pos", "neg"], group_cols=by, descending=True)
    tot = st.groupBy(*by).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    out = c.join(tot, by)
    return out.drop(_G) if not user_by else out


def roc_points(scored: DataFrame, y: str, score: str, by=(), positive=1) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, highest first."""
    c = _curve(score_table(scored, y, score, by, positive), by)
    return c.select(*by, F.col("score").alias("threshold"),
                    _div(F.col("cum_neg"), F.col("N"), float("nan")).alias("fpr"),
                    _div(F.col("cum_pos"), F.col("P"), float("nan")).alias("tpr"))


def pr_points(scored: DataFrame, y: str, score: str, by=(), positive=1) -> DataFrame:
    """(threshold, precision, recall) at every distinct score."""
    c = _curve(score_table(scored, y, score, by, positive), by)
    return c.select(*by, F.col("score").alias("threshold"),
                    _div(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
                    _div(F.col("cum_pos"), F.col("P"), float("nan")).alias("recall"))


def ranking_metrics(scored: DataFrame, y: str, score: str, by=(), positive=1) -> DataFrame:
    """E11 ROC-AUC (tie-aware, = trapezoid) and E13 average precision
    (sum of recall steps times precision; ties grouped).  NaN when a group
    lacks positives or negatives."""
    by = list(by)
    c = _curve(score_table(scored, y, score, by, positive), by)
    # negatives strictly below this score = N - (cum_neg including this score)
    below = F.col("N") - F.col("cum_neg")
    auc_term = F.col("pos") * (below + 0.5 * F.col("neg"))
    ap_term = F.col("pos") * _div(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg"))
    agg = [F.sum(auc_term).alias("_auc"), F.sum(ap_term).alias("_ap"), F.first("P").alias("P"), F.first("N").alias("N")]
    g = c.groupBy(*by).agg(*agg) if by else c.agg(*agg)
    nan = F.lit(float("nan"))
    return g.select(*by,
                    F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("_auc") / (F.col("P") * F.col("N")))
                     .otherwise(nan).alias("roc_auc"),
                    F.when(F.col("P") > 0, F.col("_ap") / F.col("P")).otherwise(nan).alias("pr_auc"))


def one_vs_rest_long(scored: DataFrame, y: str, probs: str, classes, by=()) -> DataFrame:
    """Flatten (row, class) for one-vs-rest / micro curves: (by..., class, is_pos, score)."""
    arr = F.arrays_zip(F.array(*[F.lit(c) for c in classes]).alias("cls"), F.col(probs).alias("p"))
    return scored.select(*by, F.col(y).alias("_y"), F.explode(arr).alias("z")).select(
        *by, F.col("z.cls").alias("class"), (F.col("_y") == F.col("z.cls")).cast("int").alias("is_pos"),
        F.col("z.p").alias("score"))


def ovr_auc(scored: DataFrame, y: str, probs: str, classes, by=(), missing: float = float("nan")) -> DataFrame:
    """E11/E13 multiclass: macro one-vs-rest ROC-AUC and AP over ``classes``.
    A class absent from the truth makes ROC-AUC ``missing`` (NaN; 0.0 in CV)."""
    by = list(by)
    long = one_vs_rest_long(scored, y, probs, classes, by)
    per = ranking_metrics(long, "is_pos", "score", by + ["class"])
    agg = [F.when(F.count_if(F.isnan("roc_auc")) > 0, F.lit(missing)).otherwise(F.avg("roc_auc")).alias("roc_auc_ovr"),
           F.avg(F.when(~F.isnan("pr_auc"), F.col("pr_auc")).otherwise(0.0)).alias("pr_auc_macro")]
    return per.groupBy(*by).agg(*agg) if by else per.agg(*agg)


# ---- E15-E17: threshold sweep -------------------------------------------------

def threshold_bin(score: Column | str, steps: int = 100) -> Column:
    """Largest k in 0..steps-1 with k/steps <= score (0 when below every threshold)."""
    s = F.col(score) if isinstance(score, str) else score
    c0 = F.floor(s * steps)
    c1 = (F.when(c0 / F.lit(float(steps)) > s, c0 - 1)
           .when((c0 + 1) / F.lit(float(steps)) <= s, c0 + 1).otherwise(c0))
    return F.least(F.greatest(c1, F.lit(0)), F.lit(steps - 1)).cast("int")


def threshold_sweep(scored: DataFrame, y: str, score: str, by=(), steps: int = 100, beta: float = 2.0) -> DataFrame:
    """Thresholds k/steps (k = 1..steps-1): precision, recall, F1, F2, MCC,
    FP, FN, alerts per 10k.  One pass bins the scores (<= steps bins per group);
    a bin b counts as predicted-positive for every threshold k <= b, so the
    per-threshold counts come from exploding the bins, not from rescanning rows."""
    user_by = list(by)
    sc, by = _with_group(scored, user_by)
    yy = F.col(y) == 1
    bins = sc.groupBy(*by, threshold_bin(score, steps).alias("b")).agg(
        F.count_if(yy).alias("pos"), F.count_if(~yy).alias("neg"))
    tot = bins.groupBy(*by).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    hits = (bins.where(F.col("b") >= 1)
                .select(*by, F.explode(F.sequence(F.lit(1), F.col("b"))).alias("k"), "pos", "neg")
                .groupBy(*by, "k").agg(F.sum("pos").alias("tp"), F.sum("neg").alias("fp")))
    grid = tot.select(*by, "P", "N", F.explode(F.sequence(F.lit(1), F.lit(steps - 1))).alias("k"))
    j = grid.join(hits, by + ["k"], "left").na.fill(0, ["tp", "fp"])
    agg = j.select(*by, "k", "tp", "fp", (F.col("P") - F.col("tp")).alias("fn"), (F.col("N") - F.col("fp")).alias("tn"))
    out = binary_from_counts(agg, beta).withColumn("threshold", F.col("k") / F.lit(float(steps)))
    out = out.select(*by, "threshold", "precision", "recall", "f1", f"f{beta:g}", "mcc",
                     F.col("fp").cast("bigint").alias("fp"), F.col("fn").cast("bigint").alias("fn"),
                     "alerts_per_10k")
    return out.drop(_G) if not user_by else out


def pick_thresholds(sweep: DataFrame, by=(), default: float = 0.5) -> DataFrame:
    """(strategy, threshold): default, max F2 and max MCC (lowest threshold wins ties)."""
    user_by = list(by)
    sw, by = _with_group(sweep, user_by)

    def best(metric):
        return sw.groupBy(*by).agg(
            F.min_by("threshold", F.struct(-F.col(metric), F.col("threshold"))).alias("threshold"))
    f2, mcc = best("f2"), best("mcc")
    base = f2.select(*by).withColumn("threshold", F.lit(default))
    out = (base.withColumn("strategy", F.lit("Default (0.5)"))
           .unionByName(f2.withColumn("strategy", F.lit("Max F2")))
           .unionByName(mcc.withColumn("strategy", F.lit("Max MCC"))))
    return out.drop(_G) if not user_by else out


#: Threshold choices that one aggregate evaluates (four counts each).
MAX_CHOICES = 200


def apply_thresholds(scored: DataFrame, y: str, score: str, choices: DataFrame, beta: float = 2.0) -> DataFrame:
    """Metrics on ``scored`` for each (strategy, threshold) of ``choices``.
    The choices become literals of one wide aggregate; more than
    ``MAX_CHOICES`` are refused."""
    rows = choices.select("strategy", "threshold").limit(MAX_CHOICES + 1).collect()
    if len(rows) > MAX_CHOICES:
        raise ValueError(f"more than {MAX_CHOICES} threshold choices")
    yy = F.col(y) == 1
    aggs = []
    for i, r in enumerate(rows):
        pp = F.col(score) >= F.lit(float(r["threshold"]))
        aggs += [F.count_if(~yy & ~pp).alias(f"tn{i}"), F.count_if(~yy & pp).alias(f"fp{i}"),
                 F.count_if(yy & ~pp).alias(f"fn{i}"), F.count_if(yy & pp).alias(f"tp{i}")]
    w = scored.agg(*aggs)
    parts = []
    for i, r in enumerate(rows):
        parts.append(w.select(F.lit(r["strategy"]).alias("strategy"), F.lit(float(r["threshold"])).alias("threshold"),
                              *[F.col(f"{x}{i}").alias(x) for x in ("tn", "fp", "fn", "tp")]))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    m = binary_from_counts(u, beta)
    return m.select("strategy", "threshold", "precision", "recall", "f1", f"f{beta:g}", "mcc",
                    F.col("fp").cast("bigint").alias("fp"), F.col("fn").cast("bigint").alias("fn"), "alerts_per_10k")


# ---- E18: bootstrap -----------------------------------------------------------

#: Largest confusion table (observed cells) that the bootstrap resamples.
MAX_CELLS = 1_000_000


def binomial_quantile(m: int, p: float, u: float) -> int:
    """The least k with P(X <= k) >= u for X ~ Binomial(m, p).

    Reads the probabilities within ten standard deviations (and ten more steps)
    of the mean, by their ratios from the mode: what lies outside is below
    1e-19.  Time and memory grow with the square root of m at most."""
    if m <= 0 or p <= 0.0:
        return 0
    if p >= 1.0:
        return m
    mean = m * p
    reach = 10.0 * math.sqrt(mean * (1.0 - p)) + 10.0
    lo, hi = max(0, math.floor(mean - reach)), min(m, math.ceil(mean + reach))
    k = np.arange(lo, hi, dtype=np.float64)
    logs = np.concatenate(([0.0], np.cumsum(np.log((m - k) / (k + 1.0)) + math.log(p / (1.0 - p)))))
    cdf = np.cumsum(np.exp(logs - logs.max()))
    return lo + min(int(np.searchsorted(cdf, u * cdf[-1], "left")), hi - lo)


def _draw_cells(batches):
    """Rows (iter, cells sorted, one uniform per cell) -> (iter, y_true, y_pred, cnt) of one resample each."""
    for batch in batches:
        for it, cells, units in zip(batch["iter"], batch["cells"], batch["units"]):
            left = rest = sum(int(c["n"]) for c in cells)
            rows = []
            for c, u in zip(cells, units):
                n = int(c["n"])
                k = left if n == rest else binomial_quantile(left, n / rest, float(u))
                left, rest = left - k, rest - n
                if k:
                    rows.append((it, c["y"], c["p"], k))
            yield pd.DataFrame(rows, columns=["iter", "y_true", "y_pred", "cnt"])


def resampled_cells(scored: DataFrame, y: str, pred: str, iterations: int = 100, seed: int = 42) -> DataFrame:
    """Confusion cells (iter, y_true, y_pred, cnt) of ``iterations`` resamples of exactly n of the n rows.

    Rows drawn with replacement fall into the cells multinomially, so the cells
    are drawn and not the rows: in the order of (y, pred), nulls first, each
    cell takes a binomial share of the draws that are left, by the uniform
    md5(seed-cell-iter).  The rows are read once, by one aggregate; what follows
    is as large as the confusion table (at most ``MAX_CELLS``) times iterations.
    No rows give no cells."""
    cells = confusion_counts(scored.select(F.col(y).cast("string").alias("y"), F.col(pred).cast("string").alias("p")),
                             "y", "p")
    table = cells.agg(F.sort_array(F.collect_list(F.struct(F.col("y_true").alias("y"), F.col("y_pred").alias("p"),
                                                           F.col("cnt").alias("n")))).alias("cells"))
    fits = F.assert_true(F.size("cells") <= MAX_CELLS, F.lit(f"more than {MAX_CELLS} confusion cells"))
    table = table.where(fits.isNull() & (F.size("cells") > 0))
    unit = lambda c, i: hash_unit(i, seed, F.col("iter"))
    runs = spread(table.select("cells", F.explode(F.sequence(F.lit(0), F.lit(iterations - 1))).alias("iter")))
    return runs.select("iter", "cells", F.transform("cells", unit).alias("units")).mapInPandas(
        _draw_cells, "iter int, y_true string, y_pred string, cnt long")


def bootstrap_metrics(scored: DataFrame, y: str, pred: str, iterations: int = 100, seed: int = 42) -> DataFrame:
    """E18 (per iteration): macro-F1 and MCC of each resample of n rows (:func:`resampled_cells`)."""
    s = summary_from_stats(class_stats(resampled_cells(scored, y, pred, iterations, seed), ["iter"]), ["iter"])
    return s.select("iter", "macro_f1", "mcc", "n_true_classes")


def bootstrap_ci(per_iter: DataFrame, alpha: float = 0.95) -> DataFrame:
    """Mean and percentile interval over iterations with more than one true class."""
    lo, hi = (1 - alpha) / 2, alpha + (1 - alpha) / 2
    ok = per_iter.where(F.col("n_true_classes") > 1)
    return ok.agg(
        F.count(F.lit(1)).alias("n_iterations"),
        F.avg("macro_f1").alias("f1_mean"), F.percentile("macro_f1", lo).alias("f1_lower"),
        F.percentile("macro_f1", hi).alias("f1_upper"),
        F.avg("mcc").alias("mcc_mean"), F.percentile("mcc", lo).alias("mcc_lower"),
        F.percentile("mcc", hi).alias("mcc_upper"))


# ---- E19-E25 ------------------------------------------------------------------

def minority_recall(scored: DataFrame, y: str, pred: str, minority) -> DataFrame:
    """Recall of the given (rarest training) class."""
    return scored.agg(_div(F.count_if((F.col(y) == F.lit(minority)) & (F.col(pred) == F.lit(minority))),
                           F.count_if(F.col(y) == F.lit(minority))).alias("minority_recall"))


def benign_fpr(scored: DataFrame, y: str, pred: str, benign: str = "BENIGN", by=()) -> DataFrame:
    """E20 ('benign FPR'): share of attack rows predicted benign, +1e-9 in the denominator."""
    att = F.col(y) != F.lit(benign)
    fp = F.count_if(att & (F.col(pred) == F.lit(benign)))
    tn = F.count_if(att & (F.col(pred) != F.lit(benign)))
    e = (fp / (fp + tn + F.lit(1e-9))).alias("benign_fpr")
    return scored.groupBy(*by).agg(e) if by else scored.agg(e)


def operational_projection(counts: DataFrame, flows_per_day: float = 10_000_000, cost_per_alert: float = 15.0) -> DataFrame:
    """Per-day false alerts (false alarm rate fp / (fp + tn) x volume),
    missed attacks (share of all flows x volume) and alert cost, from tn/fp/fn/tp."""
    n = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    fa = _div(F.col("fp") * flows_per_day, F.col("fp") + F.col("tn"))
    return counts.select("*", fa.alias("false_alerts_per_day"),
                         _div(F.col("fn") * flows_per_day, n).alias("missed_attacks_per_day"),
                         (fa * cost_per_alert).alias("alert_cost_per_day"))


def log_loss(scored: DataFrame, p_true: Column, correct: Column, by=(), eps: float = 1e-15) -> DataFrame:
    """Mean cross-entropy of the true-class probability, and accuracy."""
    p = F.least(F.greatest(p_true, F.lit(eps)), F.lit(1 - eps))
    agg = [F.avg(-F.log(p)).alias("log_loss"), F.avg(correct.cast("double")).alias("accuracy")]
    return scored.groupBy(*by).agg(*agg) if by else scored.agg(*agg)


def relabel(table: DataFrame, key_col: str, key, new_name: str) -> DataFrame:
    """Pick one model's metric row and give it a new name."""
    return table.where(F.col(key_col) == F.lit(key)).withColumn(key_col, F.lit(new_name))


def micro_roc_points(scored: DataFrame, y: str, probs: str, classes, by=()) -> DataFrame:
    """E10 (micro average): ROC points over the flattened (row, class) pairs."""
    long = one_vs_rest_long(scored, y, probs, classes, by)
    return roc_points(long, "is_pos", "score", by)
