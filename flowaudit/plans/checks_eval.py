"""Registered checks: evaluation metrics (E*) on the ``scores`` view."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.rowwise import softmax
from ..operators import metrics as E
from ..operators.ordered import hash_unit  # noqa: F401
from ..registry import query
from ..sources.fixtures import scores, table, with_views

_BIN = "CASE WHEN score >= 0.5 THEN 1 ELSE 0 END"


def _scores_bin(spark, sf):
    return scores(spark, sf).withColumn("pred", (F.col("score") >= 0.5).cast("int"))


def _r(df, cols, d=6):
    return df.withColumns({c: F.round(c, d) for c in cols})


def _rsql(cols, d=6):
    return ", ".join(f"round({c}, {d}) AS {c}" for c in cols)


# ---- E1-E9 ----------------------------------------------------------------------

@query("confusion_matrix", with_views("""
WITH cls AS (SELECT y_true AS c FROM scores UNION SELECT y_pred FROM scores),
cm AS (SELECT y_true, y_pred, count(*) AS cnt FROM scores GROUP BY ALL)
SELECT a.c AS y_true, b.c AS y_pred, coalesce(cm.cnt, 0) AS cnt
FROM cls a CROSS JOIN cls b LEFT JOIN cm ON cm.y_true = a.c AND cm.y_pred = b.c
""", "scores"))
def q_confusion_matrix(spark, sf):
    return E.confusion_matrix(scores(spark, sf), "y_true", "y_pred")


@query("normalised_confusion", with_views("""
WITH cls AS (SELECT y_true AS c FROM scores UNION SELECT y_pred FROM scores),
cm AS (SELECT y_true, y_pred, count(*) AS cnt FROM scores GROUP BY ALL),
full_cm AS (SELECT a.c AS y_true, b.c AS y_pred, coalesce(cm.cnt, 0) AS cnt
  FROM cls a CROSS JOIN cls b LEFT JOIN cm ON cm.y_true = a.c AND cm.y_pred = b.c)
SELECT y_true, y_pred, cnt,
  round(coalesce(cnt / nullif(sum(cnt) OVER (PARTITION BY y_true), 0), 0), 6) AS row_norm,
  round(coalesce(cnt / nullif(sum(cnt) OVER (PARTITION BY y_pred), 0), 0), 6) AS col_norm
FROM full_cm
""", "scores"))
def q_normalised_confusion(spark, sf):
    return _r(E.normalised_confusion(scores(spark, sf), "y_true", "y_pred"), ["row_norm", "col_norm"])


_STATS_SQL = """
cm AS (SELECT y_true, y_pred, count(*) AS cnt FROM scores GROUP BY ALL),
t AS (SELECT y_true AS cls, sum(cnt) AS t FROM cm GROUP BY 1),
p AS (SELECT y_pred AS cls, sum(cnt) AS p FROM cm GROUP BY 1),
tp AS (SELECT y_true AS cls, sum(cnt) AS tp FROM cm WHERE y_true = y_pred GROUP BY 1),
st AS (SELECT coalesce(t.cls, p.cls) AS cls, coalesce(t.t, 0) AS t, coalesce(p.p, 0) AS p, coalesce(tp.tp, 0) AS tp,
              (SELECT sum(cnt) FROM cm) AS total
       FROM t FULL JOIN p ON t.cls = p.cls LEFT JOIN tp ON tp.cls = coalesce(t.cls, p.cls)),
m AS (SELECT cls, t, p, tp, total,
  coalesce(tp / nullif(p, 0), 0) AS prec, coalesce(tp / nullif(t, 0), 0) AS rec,
  coalesce(2.0 * tp / nullif(2.0 * tp + (t - tp) + (p - tp), 0), 0) AS f1,
  coalesce(5.0 * tp / nullif(5.0 * tp + 4.0 * (t - tp) + (p - tp), 0), 0) AS f2 FROM st)"""


@query("per_class_report", with_views(f"""WITH {_STATS_SQL}
SELECT cls AS class, {_rsql(['prec'])}, {_rsql(['rec'])}, {_rsql(['f1', 'f2'])}, t AS support FROM m
""".replace("round(prec, 6) AS prec", "round(prec, 6) AS precision").replace("round(rec, 6) AS rec", "round(rec, 6) AS recall").replace("t AS support", "CAST(t AS BIGINT) AS support"),
    "scores"))
def q_per_class_report(spark, sf):
    return _r(E.per_class_report(scores(spark, sf), "y_true", "y_pred"), ["precision", "recall", "f1", "f2"])


@query("summary_metrics", with_views(f"""WITH {_STATS_SQL},
agg AS (SELECT sum(tp) / max(total) AS accuracy, avg(CASE WHEN t > 0 THEN rec END) AS balanced_accuracy,
  avg(prec) AS macro_precision, avg(rec) AS macro_recall, avg(f1) AS macro_f1,
  coalesce(sum(f1 * t) / nullif(sum(t), 0), 0) AS weighted_f1, avg(f2) AS macro_f2,
  CAST(sum(tp) AS DOUBLE) AS c, CAST(max(total) AS DOUBLE) AS s,
  sum(CAST(p AS DOUBLE) * t) AS pt, sum(CAST(p AS DOUBLE) * p) AS pp, sum(CAST(t AS DOUBLE) * t) AS tt FROM m)
SELECT {_rsql(['accuracy', 'balanced_accuracy', 'macro_precision', 'macro_recall', 'macro_f1', 'weighted_f1', 'macro_f2'])},
  round(CASE WHEN (s * s - pp) * (s * s - tt) > 0 THEN (c * s - pt) / sqrt((s * s - pp) * (s * s - tt)) ELSE 0 END, 6) AS mcc
FROM agg
""", "scores"))
def q_summary_metrics(spark, sf):
    m = E.summary_metrics(scores(spark, sf), "y_true", "y_pred")
    return _r(m, m.columns)


_BIN_COUNTS = f"""bc AS (SELECT split,
  count_if(y = 0 AND {_BIN} = 0) AS tn, count_if(y = 0 AND {_BIN} = 1) AS fp,
  count_if(y = 1 AND {_BIN} = 0) AS fn, count_if(y = 1 AND {_BIN} = 1) AS tp FROM scores GROUP BY split)"""

_BIN_METRICS = """
  round(coalesce((tp + tn) / nullif(tp + tn + fp + fn, 0), 0), 6) AS accuracy,
  round((coalesce(tp / nullif(tp + fn, 0), 0) + coalesce(tn / nullif(tn + fp, 0), 0)) / 2, 6) AS balanced_accuracy,
  round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
  round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
  round(coalesce(2.0 * tp / nullif(2.0 * tp + fp + fn, 0), 0), 6) AS f1,
  round(coalesce(5.0 * tp / nullif(5.0 * tp + 4.0 * fn + fp, 0), 0), 6) AS f2,
  round(CASE WHEN (CAST(tp AS DOUBLE) + fp) * (tp + fn) * (tn + fp) * (tn + fn) > 0 THEN
    (CAST(tp AS DOUBLE) * tn - CAST(fp AS DOUBLE) * fn) / sqrt((CAST(tp AS DOUBLE) + fp) * (tp + fn) * (tn + fp) * (tn + fn)) ELSE 0 END, 6) AS mcc,
  round(coalesce(fp / nullif(fp + tn, 0), 0), 6) AS far,
  round(coalesce(fn / nullif(fn + tp, 0), 0), 6) AS fnr,
  round(coalesce((tp + fp) * 10000.0 / nullif(tp + tn + fp + fn, 0), 0), 6) AS alerts_per_10k"""

_BIN_COLS = ["accuracy", "balanced_accuracy", "precision", "recall", "f1", "f2", "mcc", "far", "fnr", "alerts_per_10k"]


@query("binary_metrics", with_views(f"WITH {_BIN_COUNTS} SELECT split, tn, fp, fn, tp, {_BIN_METRICS} FROM bc", "scores"))
def q_binary_metrics(spark, sf):
    c = E.binary_counts(_scores_bin(spark, sf), "y", "pred", by=["split"])
    return _r(E.binary_from_counts(c), _BIN_COLS)


@query("operational_projection", with_views(f"""WITH {_BIN_COUNTS}
SELECT split, tn, fp, fn, tp, round(coalesce(fp * 10000000.0 / nullif(fp + tn, 0), 0), 6) AS false_alerts_per_day,
  round(fn * 10000000.0 / (tn + fp + fn + tp), 6) AS missed_attacks_per_day,
  round(coalesce(fp * 10000000.0 / nullif(fp + tn, 0), 0) * 15.0, 6) AS alert_cost_per_day FROM bc
""", "scores"))
def q_operational_projection(spark, sf):
    c = E.binary_counts(_scores_bin(spark, sf), "y", "pred", by=["split"])
    return _r(E.operational_projection(c), ["false_alerts_per_day", "missed_attacks_per_day", "alert_cost_per_day"])


@query("relabel_baseline", with_views(f"""WITH {_BIN_COUNTS}
SELECT 'Baseline' AS split, tn, fp, fn, tp, {_BIN_METRICS} FROM bc WHERE split = 'test'
""", "scores"))
def q_relabel_baseline(spark, sf):
    c = E.binary_counts(_scores_bin(spark, sf), "y", "pred", by=["split"])
    return E.relabel(_r(E.binary_from_counts(c), _BIN_COLS), "split", "test", "Baseline")


# ---- E10-E13 --------------------------------------------------------------------

_CURVE_SQL = """st AS (SELECT score, count_if(y = 1) AS pos, count_if(y = 0) AS neg FROM scores GROUP BY score),
cv AS (SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC) AS cum_pos, sum(neg) OVER (ORDER BY score DESC) AS cum_neg,
       sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM st)"""


@query("roc_points", with_views(f"""WITH {_CURVE_SQL}
SELECT score AS threshold, round(cum_neg / N, 6) AS fpr, round(cum_pos / P, 6) AS tpr FROM cv
""", "scores"))
def q_roc_points(spark, sf):
    return _r(E.roc_points(scores(spark, sf), "y", "score"), ["fpr", "tpr"])


@query("pr_points", with_views(f"""WITH {_CURVE_SQL}
SELECT score AS threshold, round(cum_pos / (cum_pos + cum_neg), 6) AS precision, round(cum_pos / P, 6) AS recall FROM cv
""", "scores"))
def q_pr_points(spark, sf):
    return _r(E.pr_points(scores(spark, sf), "y", "score"), ["precision", "recall"])


@query("ranking_metrics", with_views(f"""WITH {_CURVE_SQL}
SELECT round(sum(pos * ((N - cum_neg) + 0.5 * neg)) / (max(P) * max(N)), 6) AS roc_auc,
       round(sum(pos * cum_pos / (cum_pos + cum_neg)) / max(P), 6) AS pr_auc FROM cv
""", "scores"))
def q_ranking_metrics(spark, sf):
    return _r(E.ranking_metrics(scores(spark, sf), "y", "score"), ["roc_auc", "pr_auc"])


@query("ranking_metrics_by_day", with_views("""
WITH st AS (SELECT day, score, count_if(y = 1) AS pos, count_if(y = 0) AS neg FROM scores GROUP BY day, score),
cv AS (SELECT day, score, pos, neg,
       sum(pos) OVER (PARTITION BY day ORDER BY score DESC) AS cum_pos, sum(neg) OVER (PARTITION BY day ORDER BY score DESC) AS cum_neg,
       sum(pos) OVER (PARTITION BY day) AS P, sum(neg) OVER (PARTITION BY day) AS N FROM st)
SELECT day, round(sum(pos * ((N - cum_neg) + 0.5 * neg)) / (max(P) * max(N)), 6) AS roc_auc,
       round(sum(pos * cum_pos / (cum_pos + cum_neg)) / max(P), 6) AS pr_auc FROM cv GROUP BY day
""", "scores"))
def q_ranking_metrics_by_day(spark, sf):
    return _r(E.ranking_metrics(scores(spark, sf), "y", "score", by=["day"]), ["roc_auc", "pr_auc"])


_OVR_SQL = """
WITH e AS (SELECT vec_id, label, list_transform(range(1, 11), lambda c: list_sum(list_transform(
  range(c, len(embedding) + 1, 10), lambda j: CAST(embedding[j] AS DOUBLE)))) AS x FROM embeddings),
m AS (SELECT vec_id, label, x, list_max(x) AS mx FROM e),
s AS (SELECT vec_id, label, x, mx, list_sum(list_transform(x, lambda v: exp(v - mx))) AS tot FROM m),
cls AS (SELECT DISTINCT label AS c FROM embeddings),
ranked AS (SELECT c, row_number() OVER (ORDER BY c) AS pos FROM cls),
long AS (SELECT r.c AS class, CASE WHEN s.label = r.c THEN 1 ELSE 0 END AS is_pos, exp(s.x[r.pos] - s.mx) / s.tot AS score
         FROM s, ranked r),
st AS (SELECT class, score, sum(is_pos) AS pos, count(*) - sum(is_pos) AS neg FROM long GROUP BY ALL),
cv AS (SELECT class, score, pos, neg,
       sum(pos) OVER (PARTITION BY class ORDER BY score DESC) AS cum_pos, sum(neg) OVER (PARTITION BY class ORDER BY score DESC) AS cum_neg,
       sum(pos) OVER (PARTITION BY class) AS P, sum(neg) OVER (PARTITION BY class) AS N FROM st),
per AS (SELECT class, sum(pos * ((N - cum_neg) + 0.5 * neg)) / (max(P) * max(N)) AS auc,
       sum(pos * cum_pos / (cum_pos + cum_neg)) / max(P) AS ap FROM cv GROUP BY class)
SELECT round(avg(auc), 6) AS roc_auc_ovr, round(avg(ap), 6) AS pr_auc_macro FROM per
"""


def _class_sums(vec: str, k: int):
    """k class scores out of a whole vector: class c sums the elements c, c + k, c + 2k, ..."""
    x = F.col(vec).cast("array<double>")
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda c: F.aggregate(
        F.filter(x, lambda _, j: j % k == c), F.lit(0.0), lambda a, v: a + v))


@query("ovr_auc", _OVR_SQL)
def q_ovr_auc(spark, sf):
    from ..functions.labels import class_list
    e = table(spark, sf, "embeddings")
    classes = class_list(e, "label")
    sc = e.select("label", softmax(_class_sums("embedding", 10)).alias("probs"))
    return _r(E.ovr_auc(sc, "label", "probs", classes), ["roc_auc_ovr", "pr_auc_macro"])


# ---- E15-E17 --------------------------------------------------------------------

_SWEEP_SQL = """sw_c AS (SELECT k, CAST(k AS DOUBLE) / 100 AS threshold,
  count_if(y = 1 AND score >= CAST(k AS DOUBLE) / 100) AS tp, count_if(y = 0 AND score >= CAST(k AS DOUBLE) / 100) AS fp,
  count_if(y = 1 AND score < CAST(k AS DOUBLE) / 100) AS fn, count_if(y = 0 AND score < CAST(k AS DOUBLE) / 100) AS tn
  FROM scores, range(1, 100) r(k) WHERE split = 'val' GROUP BY k),
sw AS (SELECT threshold,
  coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
  coalesce(2.0 * tp / nullif(2.0 * tp + fp + fn, 0), 0) AS f1, coalesce(5.0 * tp / nullif(5.0 * tp + 4.0 * fn + fp, 0), 0) AS f2,
  CASE WHEN (CAST(tp AS DOUBLE) + fp) * (tp + fn) * (tn + fp) * (tn + fn) > 0 THEN
    (CAST(tp AS DOUBLE) * tn - CAST(fp AS DOUBLE) * fn) / sqrt((CAST(tp AS DOUBLE) + fp) * (tp + fn) * (tn + fp) * (tn + fn)) ELSE 0 END AS mcc,
  fp, fn, coalesce((tp + fp) * 10000.0 / nullif(tp + tn + fp + fn, 0), 0) AS alerts_per_10k FROM sw_c)"""


def _val_sweep(spark, sf):
    return E.threshold_sweep(scores(spark, sf).where("split = 'val'"), "y", "score")


@query("threshold_sweep", with_views(f"""WITH {_SWEEP_SQL}
SELECT threshold, {_rsql(['precision', 'recall', 'f1', 'f2', 'mcc'])}, fp, fn, {_rsql(['alerts_per_10k'])} FROM sw
""", "scores"))
def q_threshold_sweep(spark, sf):
    return _r(_val_sweep(spark, sf), ["precision", "recall", "f1", "f2", "mcc", "alerts_per_10k"])


_PICK_SQL = """picks AS (SELECT 'Default (0.5)' AS strategy, 0.5 AS threshold
  UNION ALL SELECT 'Max F2', arg_min(threshold, (-f2, threshold)) FROM sw
  UNION ALL SELECT 'Max MCC', arg_min(threshold, (-mcc, threshold)) FROM sw)"""


@query("pick_thresholds", with_views(f"WITH {_SWEEP_SQL}, {_PICK_SQL} SELECT strategy, threshold FROM picks", "scores"))
def q_pick_thresholds(spark, sf):
    return E.pick_thresholds(_val_sweep(spark, sf)).select("strategy", "threshold")


@query("apply_thresholds", with_views(f"""WITH {_SWEEP_SQL}, {_PICK_SQL},
tc AS (SELECT strategy, threshold, count_if(y = 0 AND score < threshold) AS tn, count_if(y = 0 AND score >= threshold) AS fp,
   count_if(y = 1 AND score < threshold) AS fn, count_if(y = 1 AND score >= threshold) AS tp
   FROM picks, scores WHERE split = 'test' GROUP BY strategy, threshold)
SELECT strategy, threshold, {_BIN_METRICS.replace('AS accuracy,', 'AS _acc,')} FROM tc
""".replace("round(coalesce((tp + tn) / nullif(tp + tn + fp + fn, 0), 0), 6) AS _acc,", "")
   .replace("round((coalesce(tp / nullif(tp + fn, 0), 0) + coalesce(tn / nullif(tn + fp, 0), 0)) / 2, 6) AS balanced_accuracy,", "")
   .replace("round(coalesce(fp / nullif(fp + tn, 0), 0), 6) AS far,", "fp, fn,")
   .replace("round(coalesce(fn / nullif(fn + tp, 0), 0), 6) AS fnr,", ""), "scores"))
def q_apply_thresholds(spark, sf):
    s = scores(spark, sf)
    picks = E.pick_thresholds(E.threshold_sweep(s.where("split = 'val'"), "y", "score"))
    out = E.apply_thresholds(s.where("split = 'test'"), "y", "score", picks)
    return _r(out, ["precision", "recall", "f1", "f2", "mcc", "alerts_per_10k"])


# ---- E18-E20, E24 ----------------------------------------------------------------

# One binomial draw per (iteration, cell): the least k whose share of the probabilities around the mean reaches u.
_U = ("CAST(('0x' || substr(md5(concat('42-', CAST(i AS VARCHAR), '-', CAST(iter AS VARCHAR))), 1, 13)) AS BIGINT)"
      " / 4503599627370496.0")
_REACH = "(10 * sqrt(m * q * (1 - q)) + 10)"

_BOOT_SQL = f"""cells AS (SELECT y_true, y_pred, count(*) AS n FROM scores WHERE split = 'test' GROUP BY ALL),
cl AS (SELECT row_number() OVER (ORDER BY y_true, y_pred) - 1 AS i, y_true, y_pred, n,
  sum(n) OVER (ORDER BY y_true, y_pred ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM cells),
bw AS (SELECT CAST(it AS BIGINT) AS iter, CAST(-1 AS BIGINT) AS i, CAST(NULL AS VARCHAR) AS y_true,
    CAST(NULL AS VARCHAR) AS y_pred, CAST(0 AS BIGINT) AS w, CAST((SELECT sum(n) FROM cells) AS BIGINT) AS m
  FROM range(0, 100) r(it)
  UNION ALL
  SELECT iter, i, y_true, y_pred, k, m - k FROM (
    SELECT iter, i, y_true, y_pred, m, CAST(min(CASE WHEN cum >= u * total THEN k END) AS BIGINT) AS k FROM (
      SELECT *, sum(f) OVER (PARTITION BY iter ORDER BY k) AS cum, sum(f) OVER (PARTITION BY iter) AS total FROM (
        SELECT *, CASE WHEN q >= 1 THEN 1.0 ELSE exp(lgamma(m + 1.0) - lgamma(k + 1.0) - lgamma(m - k + 1.0)
                    + k * ln(q) + (m - k) * ln(1 - q)) END AS f FROM (
          SELECT *, {_U} AS u, unnest(CASE WHEN q >= 1 THEN [m] ELSE
            range(CAST(greatest(0, floor(m * q - {_REACH})) AS BIGINT),
                  CAST(least(m, ceil(m * q + {_REACH})) AS BIGINT) + 1) END) AS k FROM (
            SELECT b.iter, c.i, c.y_true, c.y_pred, b.m, CAST(c.n AS DOUBLE) / CAST(c.rest AS DOUBLE) AS q
            FROM bw b JOIN cl c ON c.i = b.i + 1)))) GROUP BY iter, i, y_true, y_pred, m)),
cm AS (SELECT iter, y_true, y_pred, sum(w) AS cnt FROM bw WHERE w > 0 GROUP BY ALL),
t AS (SELECT iter, y_true AS cls, sum(cnt) AS t FROM cm GROUP BY 1, 2),
p AS (SELECT iter, y_pred AS cls, sum(cnt) AS p FROM cm GROUP BY 1, 2),
tp AS (SELECT iter, y_true AS cls, sum(cnt) AS tp FROM cm WHERE y_true = y_pred GROUP BY 1, 2),
tot AS (SELECT iter, sum(cnt) AS total, count(DISTINCT y_true) AS n_true_classes FROM cm GROUP BY 1),
st AS (SELECT coalesce(t.iter, p.iter) AS iter, coalesce(t.cls, p.cls) AS cls, coalesce(t.t, 0) AS t,
              coalesce(p.p, 0) AS p, coalesce(tp.tp, 0) AS tp
       FROM t FULL JOIN p ON t.iter = p.iter AND t.cls = p.cls
       LEFT JOIN tp ON tp.iter = coalesce(t.iter, p.iter) AND tp.cls = coalesce(t.cls, p.cls)),
agg AS (SELECT st.iter, avg(coalesce(2.0 * tp / nullif(2.0 * tp + (t - tp) + (p - tp), 0), 0)) AS macro_f1,
  CAST(sum(tp) AS DOUBLE) AS c, CAST(max(total) AS DOUBLE) AS s, sum(CAST(p AS DOUBLE) * t) AS pt,
  sum(CAST(p AS DOUBLE) * p) AS pp, sum(CAST(t AS DOUBLE) * t) AS tt, max(n_true_classes) AS n_true_classes
  FROM st JOIN tot USING (iter) GROUP BY st.iter),
boot AS (SELECT iter, macro_f1, CASE WHEN (s * s - pp) * (s * s - tt) > 0 THEN (c * s - pt) / sqrt((s * s - pp) * (s * s - tt))
  ELSE 0 END AS mcc, n_true_classes FROM agg)"""


def _boot(spark, sf):
    return E.bootstrap_metrics(scores(spark, sf).where("split = 'test'"), "y_true", "y_pred", 100, 42)


@query("bootstrap_iterations", with_views(f"""WITH RECURSIVE {_BOOT_SQL}
SELECT CAST(iter AS INTEGER) AS iter, round(macro_f1, 6) AS macro_f1, round(mcc, 6) AS mcc, n_true_classes FROM boot
""", "scores"))
def q_bootstrap_iterations(spark, sf):
    b = _boot(spark, sf)
    return _r(b, ["macro_f1", "mcc"]).withColumn("iter", F.col("iter").cast("int"))


@query("bootstrap_ci", with_views(f"""WITH RECURSIVE {_BOOT_SQL}
SELECT count(*) AS n_iterations, round(avg(macro_f1), 6) AS f1_mean, round(quantile_cont(macro_f1, 0.025), 6) AS f1_lower,
  round(quantile_cont(macro_f1, 0.975), 6) AS f1_upper, round(avg(mcc), 6) AS mcc_mean,
  round(quantile_cont(mcc, 0.025), 6) AS mcc_lower, round(quantile_cont(mcc, 0.975), 6) AS mcc_upper
FROM boot WHERE n_true_classes > 1
""", "scores"))
def q_bootstrap_ci(spark, sf):
    ci = E.bootstrap_ci(_boot(spark, sf))
    return _r(ci, [c for c in ci.columns if c != "n_iterations"])


@query("minority_recall", with_views("""
WITH mc AS (SELECT arg_min(y_true, (cnt, y_true)) AS c FROM
  (SELECT y_true, count(*) AS cnt FROM scores WHERE split = 'train' GROUP BY y_true) t)
SELECT round(coalesce(count_if(y_true = c AND y_pred = c) / nullif(count_if(y_true = c), 0), 0), 6) AS minority_recall
FROM scores, mc WHERE split = 'test'
""", "scores"))
def q_minority_recall(spark, sf):
    from ..operators.balance import minority_class
    s = scores(spark, sf)
    mc = minority_class(s.where("split = 'train'"), "y_true").first()["y_true"]
    return _r(E.minority_recall(s.where("split = 'test'"), "y_true", "y_pred", mc), ["minority_recall"])


@query("benign_fpr", with_views("""
SELECT split, round(count_if(y_true <> 'BENIGN' AND y_pred = 'BENIGN')
  / (count_if(y_true <> 'BENIGN' AND y_pred = 'BENIGN') + count_if(y_true <> 'BENIGN' AND y_pred <> 'BENIGN') + 1e-9), 6)
  AS benign_fpr FROM scores GROUP BY split
""", "scores"))
def q_benign_fpr(spark, sf):
    return _r(E.benign_fpr(scores(spark, sf), "y_true", "y_pred", by=["split"]), ["benign_fpr"])


@query("log_loss", with_views("""
SELECT split, round(avg(-ln(least(greatest(CASE WHEN y = 1 THEN score ELSE 1 - score END, 1e-15), 1 - 1e-15))), 6) AS log_loss,
  round(avg(CASE WHEN (score >= 0.5) = (y = 1) THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM scores GROUP BY split
""", "scores"))
def q_log_loss(spark, sf):
    s = scores(spark, sf)
    p_true = F.when(F.col("y") == 1, F.col("score")).otherwise(1 - F.col("score"))
    correct = (F.col("score") >= 0.5) == (F.col("y") == 1)
    return _r(E.log_loss(s, p_true, correct, by=["split"]), ["log_loss", "accuracy"])


@query("micro_roc_points", _OVR_SQL.split("st AS (")[0] + """
st AS (SELECT score, sum(is_pos) AS pos, count(*) - sum(is_pos) AS neg FROM long GROUP BY score),
cv AS (SELECT score, sum(pos) OVER (ORDER BY score DESC) AS cum_pos, sum(neg) OVER (ORDER BY score DESC) AS cum_neg,
       sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM st)
SELECT round(score, 9) AS threshold, round(cum_neg / N, 6) AS fpr, round(cum_pos / P, 6) AS tpr FROM cv
""")
def q_micro_roc_points(spark, sf):
    """E10 micro average: one curve over every (row, class) pair of the softmax scores."""
    from ..functions.labels import class_list
    e = table(spark, sf, "embeddings")
    classes = class_list(e, "label")
    sc = e.select("label", softmax(_class_sums("embedding", 10)).alias("probs"))
    r = E.micro_roc_points(sc, "label", "probs", classes)
    return r.select(F.round("threshold", 9).alias("threshold"), F.round("fpr", 6).alias("fpr"),
                    F.round("tpr", 6).alias("tpr"))
