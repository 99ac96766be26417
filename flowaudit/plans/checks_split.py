"""Registered checks: splits (T*), leakage (J2, T9), class balance (B*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import balance as B
from ..operators import leakage as J
from ..operators import splits as S
from ..operators.duplicates import keep_first
from ..registry import query
from ..sources.fixtures import DIRTY_FEATURES, flows, flows_dirty, table, with_views

_DF = ", ".join(DIRTY_FEATURES)


def _md5(key: str, seed: int = 42) -> str:
    return f"md5(concat('{seed}-', CAST(CAST({key} AS BIGINT) AS VARCHAR)))"


def quota_sql(src: str, label: str, frac: float, name: str) -> str:
    """CTE body: per-class largest-remainder quota ``q`` for ``frac``."""
    f = f"CAST({frac!r} AS DOUBLE)"
    return f"""{name}_c AS (SELECT {label}, count(*) AS n FROM {src} GROUP BY {label}),
{name}_b AS (SELECT {label}, n, {f} * n AS e, floor({f} * n + 1e-9) AS fl FROM {name}_c),
{name}_w AS (SELECT ceil({f} * sum(n) - 1e-9) - sum(fl) AS extra FROM {name}_b),
{name}_r AS (SELECT {label}, n, fl, row_number() OVER (ORDER BY e - floor(e + 1e-9) DESC, {label}) AS rr FROM {name}_b),
{name} AS (SELECT {label}, CAST(least(n, fl + CASE WHEN rr <= extra THEN 1 ELSE 0 END) AS BIGINT) AS q
           FROM {name}_r, {name}_w)"""


def ranked_sql(src: str, label: str | None, key: str, name: str, seed: int = 42) -> str:
    part = f"PARTITION BY {label} " if label else ""
    return f"{name} AS (SELECT *, row_number() OVER ({part}ORDER BY {_md5(key, seed)}) AS rk FROM {src})"


def three_way_sql(src: str, label: str, key: str, test: float = 0.2, val: float = 0.2) -> str:
    """CTEs ending in ``tw`` = src + split."""
    return f"""{quota_sql(src, label, test, 'qt')},
tw_rest AS (SELECT c.{label}, c.n - t.q AS n FROM qt_c c JOIN qt t USING ({label})),
{quota_sql('tw_rest_rows', label, val / (1 - test), 'qv').replace('qv_c AS (SELECT ' + label + ', count(*) AS n FROM tw_rest_rows GROUP BY ' + label + ')', 'qv_c AS (SELECT * FROM tw_rest)')},
{ranked_sql(src, label, key, 'tw_rk')},
tw AS (SELECT r.* EXCLUDE (rk), CASE WHEN rk <= t.q THEN 'test' WHEN rk <= t.q + v.q THEN 'val' ELSE 'train' END AS split
       FROM tw_rk r JOIN qt t USING ({label}) JOIN qv v USING ({label}))"""


# ---- T: splits ---------------------------------------------------------------

@query("stratified_split", with_views(f"""WITH {quota_sql('flows', 'label', 0.2, 'qt')},
{ranked_sql('flows', 'label', 'flow_id', 'rk')}
SELECT flow_id, label, CASE WHEN rk <= q THEN 'test' ELSE 'train' END AS split FROM rk JOIN qt USING (label)
""", "flows"))
def q_stratified_split(spark, sf):
    return S.stratified_split(flows(spark, sf), "label", "flow_id", 0.2).select("flow_id", "label", "split")


@query("stratified_sample", with_views(f"""WITH src AS (SELECT * FROM flows WHERE label IN
  (SELECT label FROM flows GROUP BY label HAVING count(*) > 5)),
{quota_sql('src', 'label', 0.1, 'qt')},
{ranked_sql('src', 'label', 'flow_id', 'rk')}
SELECT flow_id, label FROM rk JOIN qt USING (label) WHERE rk <= q
""", "flows"))
def q_stratified_sample(spark, sf):
    from ..operators.clean import filter_rare_classes
    src = filter_rare_classes(flows(spark, sf), "label", 6)
    return S.stratified_sample(src, "label", "flow_id", 0.1).select("flow_id", "label")


@query("three_way_split", with_views(f"""WITH {three_way_sql('flows', 'label', 'flow_id')}
SELECT flow_id, label, split FROM tw
""", "flows"))
def q_three_way_split(spark, sf):
    return S.three_way_split(flows(spark, sf), "label", "flow_id").select("flow_id", "label", "split")


@query("paper_split", with_views(f"""WITH {quota_sql('flows', 'label', 0.4, 'qr')},
{ranked_sql('flows', 'label', 'flow_id', 'rk')},
rest AS (SELECT rk.* EXCLUDE (rk), rk <= q AS is_rest FROM rk JOIN qr USING (label)),
nv AS (SELECT ceil(CAST(0.5 AS DOUBLE) * count(*) - 1e-9) AS n_val FROM rest WHERE is_rest),
{ranked_sql('(SELECT * FROM rest WHERE is_rest)', None, 'flow_id', 'rk2')}
SELECT flow_id, label, 'train' AS split FROM rest WHERE NOT is_rest
UNION ALL
SELECT flow_id, label, CASE WHEN rk <= n_val THEN 'val' ELSE 'test' END FROM rk2, nv
""", "flows"))
def q_paper_split(spark, sf):
    return S.paper_split(flows(spark, sf), "label", "flow_id").select("flow_id", "label", "split")


_DEDUP_SQL = f"""dd AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {_DF} ORDER BY row_id) AS rn
      FROM flows_dirty) t WHERE rn = 1),
dd2 AS (SELECT * FROM dd WHERE label IN (SELECT label FROM dd GROUP BY label HAVING count(*) >= 3)),
{three_way_sql('dd2', 'label', 'row_id')}"""


@query("dedup_split", with_views(f"""WITH {_DEDUP_SQL}
SELECT row_id, label, split FROM tw
""", "flows_dirty"))
def q_dedup_split(spark, sf):
    return S.split(flows_dirty(spark, sf), "random_deduplicated", "label", "row_id",
                   DIRTY_FEATURES).select("row_id", "label", "split")


_GROUPED_SQL = f"""g AS (SELECT {_DF}, min(row_id) AS gid FROM flows_dirty GROUP BY ALL),
gn AS (SELECT count(*) AS n, ceil(CAST(0.2 AS DOUBLE) * count(*) - 1e-9) AS n_test FROM g),
gv AS (SELECT n_test, ceil(CAST(0.25 AS DOUBLE) * (n - n_test) - 1e-9) AS n_val FROM gn),
{ranked_sql('g', None, 'gid', 'grk')},
gs AS (SELECT grk.*, CASE WHEN rk <= n_test THEN 'test' WHEN rk <= n_test + n_val THEN 'val' ELSE 'train' END AS split
       FROM grk, gv),
gsplit AS (SELECT d.*, gs.split FROM flows_dirty d JOIN gs ON """ + " AND ".join(
    f"d.{c} IS NOT DISTINCT FROM gs.{c}" for c in DIRTY_FEATURES) + ")"


@query("grouped_split", with_views(f"""WITH {_GROUPED_SQL}
SELECT row_id, split FROM gsplit
""", "flows_dirty"))
def q_grouped_split(spark, sf):
    return S.grouped_split(flows_dirty(spark, sf), DIRTY_FEATURES, "row_id").select("row_id", "split")


@query("chronological_split", with_views("""
SELECT flow_id, CASE WHEN day IN ('Monday', 'Tuesday', 'Wednesday') THEN 'train'
  WHEN day = 'Thursday' THEN 'val' WHEN day = 'Friday' THEN 'test' END AS split FROM flows
""", "flows"))
def q_chronological_split(spark, sf):
    return S.chronological_split(flows(spark, sf), "day").select("flow_id", "split")


@query("kfold", f"""
SELECT event_id, event_type, CAST((row_number() OVER (PARTITION BY event_type ORDER BY {_md5('event_id')}) - 1) % 5
       AS INTEGER) AS fold FROM events
""")
def q_kfold(spark, sf):
    return S.kfold(table(spark, sf, "events"), "event_type", "event_id", 5).select("event_id", "event_type", "fold")


@query("sample_without_replacement", f"""
SELECT event_id FROM events ORDER BY {_md5('event_id')}, event_id LIMIT 1000
""")
def q_sample_without_replacement(spark, sf):
    return S.sample_without_replacement(table(spark, sf, "events"), "event_id", 1000).select("event_id")


@query("split_proportions", with_views(f"""WITH {three_way_sql('flows', 'label', 'flow_id')},
g AS (SELECT split, label, count(*) AS cnt FROM tw GROUP BY ALL)
SELECT split, label, cnt, round(cnt / sum(cnt) OVER (PARTITION BY split), 6) AS share,
       round(sum(cnt) OVER (PARTITION BY label) / sum(cnt) OVER (), 6) AS overall_share,
       round(abs(cnt / sum(cnt) OVER (PARTITION BY split) - sum(cnt) OVER (PARTITION BY label) / sum(cnt) OVER ()), 6) AS gap
FROM g
""", "flows"))
def q_split_proportions(spark, sf):
    tw = S.three_way_split(flows(spark, sf), "label", "flow_id")
    p = S.split_proportions(tw, "label")
    return p.select("split", "label", "cnt", *[F.round(c, 6).alias(c) for c in ["share", "overall_share", "gap"]])


# ---- J2 / T9: leakage --------------------------------------------------------

def _leak_sql(src: str) -> str:
    return f"""lk AS (SELECT {_DF}, max(CASE WHEN split = 'train' THEN 1 ELSE 0 END) AS in_train,
                  sum(CASE WHEN split = 'test' THEN 1 ELSE 0 END) AS n_te FROM {src}
                  WHERE split IN ('train', 'test') GROUP BY ALL)
SELECT CAST(coalesce(sum(n_te), 0) AS BIGINT) AS n_test,
       CAST(coalesce(sum(CASE WHEN in_train = 1 THEN n_te ELSE 0 END), 0) AS BIGINT) AS n_leaked,
       round(coalesce(sum(CASE WHEN in_train = 1 THEN n_te ELSE 0 END) * 100.0 / nullif(sum(n_te), 0), 0.0), 6)
         AS leakage_pct FROM lk"""


def _leak_spark(sp):
    r = J.leakage(sp.where("split = 'train'"), sp.where("split = 'test'"), DIRTY_FEATURES)
    return r.withColumn("leakage_pct", F.round("leakage_pct", 6))


@query("leakage_random", with_views(f"""WITH
src AS (SELECT * FROM flows_dirty WHERE label IN (SELECT label FROM flows_dirty GROUP BY label HAVING count(*) >= 3)),
{three_way_sql('src', 'label', 'row_id')},
{_leak_sql('tw')}""", "flows_dirty"))
def q_leakage_random(spark, sf):
    return _leak_spark(S.split(flows_dirty(spark, sf), "random_original", "label", "row_id", DIRTY_FEATURES))


@query("leakage_deduplicated", with_views(f"WITH {_DEDUP_SQL},\n{_leak_sql('tw')}", "flows_dirty"))
def q_leakage_dedup(spark, sf):
    return _leak_spark(S.split(flows_dirty(spark, sf), "random_deduplicated", "label", "row_id", DIRTY_FEATURES))


@query("leakage_grouped", with_views(f"WITH {_GROUPED_SQL},\n{_leak_sql('gsplit')}", "flows_dirty"))
def q_leakage_grouped(spark, sf):
    return _leak_spark(S.split(flows_dirty(spark, sf), "grouped", "label", "row_id", DIRTY_FEATURES))


@query("leakage_chronological", with_views(f"""WITH ch AS (SELECT *, CASE WHEN day IN ('Monday', 'Tuesday', 'Wednesday')
  THEN 'train' WHEN day = 'Thursday' THEN 'val' WHEN day = 'Friday' THEN 'test' END AS split FROM flows_dirty),
{_leak_sql('ch')}""", "flows_dirty"))
def q_leakage_chrono(spark, sf):
    return _leak_spark(S.split(flows_dirty(spark, sf), "chronological", "label", "row_id", DIRTY_FEATURES))


@query("leaked_rows", with_views(f"""WITH ch AS (SELECT *, CASE WHEN day IN ('Monday', 'Tuesday', 'Wednesday')
  THEN 'train' WHEN day = 'Thursday' THEN 'val' WHEN day = 'Friday' THEN 'test' END AS split FROM flows_dirty)
SELECT t.row_id FROM ch t WHERE t.split = 'test' AND EXISTS (SELECT 1 FROM ch r WHERE r.split = 'train' AND """
    + " AND ".join(f"t.{c} IS NOT DISTINCT FROM r.{c}" for c in DIRTY_FEATURES) + ")", "flows_dirty"))
def q_leaked_rows(spark, sf):
    sp = S.chronological_split(flows_dirty(spark, sf), "day")
    return J.leaked_rows(sp.where("split = 'train'"), sp.where("split = 'test'"), DIRTY_FEATURES).select("row_id")


def _leak_union_sql() -> str:
    def named(sql: str, name: str) -> str:
        return sql.replace("lk AS (", f"lk_{name} AS (").replace("FROM lk", f"FROM lk_{name}").replace(
            "SELECT CAST(coalesce(sum(n_te)", f"SELECT '{name}' AS strategy, CAST(coalesce(sum(n_te)")

    def body(sql: str) -> tuple[str, str]:
        head, _, tail = sql.rpartition(")\nSELECT ")
        return head + ")", "SELECT " + tail

    parts = {
        "random_original": f"""src AS (SELECT * FROM flows_dirty WHERE label IN (SELECT label FROM flows_dirty
             GROUP BY label HAVING count(*) >= 3)), {three_way_sql('src', 'label', 'row_id')}""",
    }
    r_ctes, r_sel = body(named(_leak_sql("tw"), "random_original"))
    import re
    d_sql = _DEDUP_SQL
    for name in ["qt_c", "qt_b", "qt_w", "qt_r", "qt", "qv_c", "qv_b", "qv_w", "qv_r", "qv",
                 "tw_rest", "tw_rk", "tw", "dd2", "dd"]:
        d_sql = re.sub(rf"\b{name}\b", "d" + name if name.startswith("d") else "d_" + name, d_sql)
    d_sql = d_sql.replace("d_tw AS (", "dtw AS (")
    d_sql = re.sub(r"\bd_tw\b", "dtw", d_sql)
    d_ctes, d_sel = body(named(_leak_sql("dtw"), "random_deduplicated"))
    g_ctes, g_sel = body(named(_leak_sql("gsplit"), "grouped"))
    c_ctes, c_sel = body(named(_leak_sql("ch"), "chronological"))
    ch = """ch AS (SELECT *, CASE WHEN day IN ('Monday', 'Tuesday', 'Wednesday') THEN 'train'
      WHEN day = 'Thursday' THEN 'val' WHEN day = 'Friday' THEN 'test' END AS split FROM flows_dirty)"""
    ctes = ",\n".join([parts["random_original"], r_ctes, d_sql, d_ctes, _GROUPED_SQL, g_ctes, ch, c_ctes])
    return "WITH " + ctes + "\n" + "\nUNION ALL\n".join([r_sel, d_sel, g_sel, c_sel])


@query("leakage_by_strategy", with_views(_leak_union_sql(), "flows_dirty"))
def q_leakage_by_strategy(spark, sf):
    r = J.leakage_by_strategy(flows_dirty(spark, sf), ["random_original", "random_deduplicated", "grouped",
                                                      "chronological"], "label", "row_id", DIRTY_FEATURES)
    return r.withColumn("leakage_pct", F.round("leakage_pct", 6))


# ---- B: class balance ---------------------------------------------------------

_TARGETS = {"BENIGN": 1000, "DoS Hulk": 500}


@query("balanced_weights", with_views("""
SELECT flow_id, label, round((SELECT count(*) FROM flows)
  / ((SELECT count(DISTINCT label) FROM flows) * count(*) OVER (PARTITION BY label)), 6) AS weight FROM flows
""", "flows"))
def q_balanced_weights(spark, sf):
    return B.balanced_weights(flows(spark, sf), "label").select("flow_id", "label", F.round("weight", 6).alias("weight"))


@query("inverse_frequency_weights", with_views("""
SELECT flow_id, label, round(1.0 / count(*) OVER (PARTITION BY label), 9) AS weight FROM flows
""", "flows"))
def q_inverse_frequency_weights(spark, sf):
    return B.inverse_frequency_weights(flows(spark, sf), "label").select(
        "flow_id", "label", F.round("weight", 9).alias("weight"))


@query("undersample_minority", with_views(f"""WITH {ranked_sql('flows', 'label', 'flow_id', 'rk')}
SELECT flow_id, label FROM rk WHERE rk <= (SELECT min(n) FROM (SELECT count(*) AS n FROM flows GROUP BY label) t)
""", "flows"))
def q_undersample_minority(spark, sf):
    return B.undersample(flows(spark, sf), "label", "flow_id").select("flow_id", "label")


@query("undersample_targets", with_views(f"""WITH {ranked_sql('flows', 'label', 'flow_id', 'rk')}
SELECT flow_id, label FROM rk WHERE rk <= CASE label WHEN 'BENIGN' THEN 1000 WHEN 'DoS Hulk' THEN 500 ELSE rk END
""", "flows"))
def q_undersample_targets(spark, sf):
    return B.undersample(flows(spark, sf), "label", "flow_id", _TARGETS).select("flow_id", "label")


@query("oversample_majority", with_views(f"""WITH c AS (SELECT label, count(*) AS n FROM flows GROUP BY label),
m AS (SELECT max(n) AS mx FROM c),
e AS (SELECT label, n, (mx - n) // n AS full_copies, (mx - n) % n AS rem FROM c, m),
{ranked_sql('flows', 'label', 'flow_id', 'rk')}
SELECT flow_id, label, CAST(copy AS INTEGER) AS copy FROM rk JOIN e USING (label),
  range(0, full_copies + CASE WHEN rk <= rem THEN 1 ELSE 0 END + 1) t(copy)
""", "flows"))
def q_oversample_majority(spark, sf):
    return B.oversample(flows(spark, sf), "label", "flow_id").select("flow_id", "label", "copy")


@query("weighted_sample")
def q_weighted_sample(spark, sf):
    return B.weighted_sample(flows(spark, sf), "label", "flow_id").select("flow_id", "label", "copy")


@query("stage_counts", with_views(f"""WITH {ranked_sql('flows', 'label', 'flow_id', 'rk')}
SELECT 'before' AS stage, label, count(*) AS cnt FROM flows GROUP BY label
UNION ALL
SELECT 'after', label, count(*) FROM rk
WHERE rk <= CASE label WHEN 'BENIGN' THEN 1000 WHEN 'DoS Hulk' THEN 500 ELSE rk END GROUP BY label
""", "flows"))
def q_stage_counts(spark, sf):
    f = flows(spark, sf)
    return B.stage_counts({"before": f, "after": B.undersample(f, "label", "flow_id", _TARGETS)}, "label")


@query("minority_class", with_views("""
SELECT arg_min(label, (cnt, label)) AS label, min(cnt) AS cnt
FROM (SELECT y_true AS label, count(*) AS cnt FROM scores WHERE split = 'train' GROUP BY y_true) t
""", "scores"))
def q_minority_class(spark, sf):
    from ..sources.fixtures import scores
    s = scores(spark, sf).where("split = 'train'").withColumnRenamed("y_true", "label")
    return B.minority_class(s, "label")


# ---- S10/S11, T11 ---------------------------------------------------------------

@query("split_roundtrip", with_views(f"""WITH {three_way_sql('flows', 'label', 'flow_id')}
SELECT flow_id, label FROM tw WHERE split = 'test'
""", "flows"))
def q_split_roundtrip(spark, sf):
    """S10 + S11: the 60/20/20 split written partitioned by split, the test part read back (pruned)."""
    from ..sources.store import read_split, scratch_path, write_split
    path = scratch_path(spark, "split")
    write_split(S.three_way_split(flows(spark, sf), "label", "flow_id").select("flow_id", "label", "split"), path)
    return read_split(spark, path, "test").select("flow_id", "label")


_U_DRAW = ("CAST(('0x' || substr(md5(concat('7-', CAST(id AS VARCHAR))), 1, 13)) AS BIGINT) / 4503599627370496.0")


@query("resample_with_replacement", f"""
WITH n AS (SELECT count(*) AS n FROM events),
draws AS (SELECT CAST(floor({_U_DRAW} * n) + 1 AS BIGINT) AS pos FROM range(0, (SELECT n FROM n)) r(id), n),
mult AS (SELECT pos, count(*) AS m FROM draws GROUP BY pos),
{ranked_sql('events', None, 'event_id', 'rk', 7)}
SELECT event_id, CAST(c AS INTEGER) AS copy FROM rk JOIN mult ON rk.rk = mult.pos, range(1, m + 1) t(c)
""")
def q_resample_with_replacement(spark, sf):
    r = S.resample_with_replacement(table(spark, sf, "events"), "event_id", seed=7)
    return r.select("event_id", F.col("copy").cast("int"))


@query("scaling_check", with_views("""
WITH tr AS (SELECT * FROM flows),
st AS (SELECT """ + ", ".join(f"avg({c}) AS m_{c}, coalesce(nullif(stddev_pop({c}), 0), 1) AS s_{c}" for c in
                             ["destination_port", "flow_duration", "total_fwd_packets", "total_backward_packets"]) + """ FROM tr),
z AS (SELECT """ + ", ".join(f"({c} - m_{c}) / s_{c} AS {c}" for c in
                            ["destination_port", "flow_duration", "total_fwd_packets", "total_backward_packets"]) + """ FROM tr, st)
SELECT round(avg(m), 6) + 0.0 AS mean_of_means, round(avg(s), 6) AS mean_of_stds FROM (
""" + "\nUNION ALL\n".join(f"SELECT avg({c}) AS m, stddev_samp({c}) AS s FROM z" for c in
                             ["destination_port", "flow_duration", "total_fwd_packets", "total_backward_packets"]) + ") t",
    "flows"))
def q_scaling_check(spark, sf):
    """After C14 z-scoring (fit on the same rows) the means average ~0, the stds ~1."""
    from ..operators.fitted import StandardScaler
    cols = ["destination_port", "flow_duration", "total_fwd_packets", "total_backward_packets"]
    f = flows(spark, sf)
    z = StandardScaler(inputCols=cols).fit(f).transform(f)
    r = S.scaling_check(z, cols)
    return r.select((F.round("mean_of_means", 6) + 0.0).alias("mean_of_means"),
                    F.round("mean_of_stds", 6).alias("mean_of_stds"))
