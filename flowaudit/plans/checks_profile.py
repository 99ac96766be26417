"""Registered checks: sources, label/feature expressions, profiling, duplicates, cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..registry import query
from ..schema import BENIGN, CAPTURE_FILES, FlowSchema
from ..sources.fixtures import DIRTY_FEATURES, FLOW_FEATURES, flows, flows_dirty, with_views
from ..operators import duplicates as U

DIRTY = FlowSchema(tuple(DIRTY_FEATURES), label="label", day="day", row_id="row_id")
CLEAN = FlowSchema(tuple(FLOW_FEATURES), label="label", day="day", row_id="flow_id")
_DF = ", ".join(DIRTY_FEATURES)


# ---- U: duplicate audit ---------------------------------------------------

@query("duplicate_audit", with_views(f"""
SELECT CAST(sum(n) AS BIGINT) AS total_rows,
       CAST(sum(n - n_rowkeys) AS BIGINT) AS exact_duplicates,
       CAST(sum(n - 1) AS BIGINT) AS feature_duplicates,
       CAST(count_if(conflicting) AS BIGINT) AS conflicting_label_vectors
FROM (SELECT {_DF}, sum(cnt) AS n, count(*) AS n_rowkeys, min(label) <> max(label) AS conflicting
      FROM (SELECT {_DF}, label, day, count(*) AS cnt FROM flows_dirty GROUP BY ALL) g
      GROUP BY {_DF}) v
""", "flows_dirty"))
def q_duplicate_audit(spark, sf):
    return U.audit_summary(flows_dirty(spark, sf), DIRTY)


@query("exact_duplicates", with_views(f"""
SELECT CAST(coalesce(sum(cnt - 1), 0) AS BIGINT) AS exact_duplicates
FROM (SELECT count(*) AS cnt FROM flows_dirty GROUP BY {_DF}, label, day) g
""", "flows_dirty"))
def q_exact_duplicates(spark, sf):
    return U.exact_duplicate_count(flows_dirty(spark, sf), DIRTY)


@query("feature_duplicates", with_views(f"""
SELECT CAST(coalesce(sum(cnt - 1), 0) AS BIGINT) AS feature_duplicates
FROM (SELECT count(*) AS cnt FROM flows_dirty GROUP BY {_DF}) g
""", "flows_dirty"))
def q_feature_duplicates(spark, sf):
    return U.feature_duplicate_count(flows_dirty(spark, sf), DIRTY)


@query("conflicting_vectors", with_views(f"""
SELECT {_DF}, count(*) AS n_rows, count(DISTINCT label) AS n_labels
FROM flows_dirty GROUP BY {_DF} HAVING count(DISTINCT label) > 1
""", "flows_dirty"))
def q_conflicting_vectors(spark, sf):
    return U.conflicting_vectors(flows_dirty(spark, sf), DIRTY).drop("labels").withColumn(
        "n_labels", F.col("n_labels").cast("bigint"))


@query("duplicates_per_day", with_views(f"""
SELECT day, CAST(sum(cnt) AS BIGINT) AS dup_rows
FROM (SELECT day, count(*) AS cnt FROM flows_dirty GROUP BY {_DF}, label, day) g
WHERE cnt > 1 GROUP BY day
""", "flows_dirty"))
def q_duplicates_per_day(spark, sf):
    return U.duplicates_by(flows_dirty(spark, sf), DIRTY, "day")


@query("duplicates_per_class", with_views(f"""
SELECT label, CAST(sum(cnt) AS BIGINT) AS dup_rows
FROM (SELECT label, count(*) AS cnt FROM flows_dirty GROUP BY {_DF}, label, day) g
WHERE cnt > 1 GROUP BY label
""", "flows_dirty"))
def q_duplicates_per_class(spark, sf):
    return U.duplicates_by(flows_dirty(spark, sf), DIRTY, "label")


@query("drop_all_copies", with_views(f"""
SELECT row_id, label, day, {_DF} FROM (
  SELECT *, count(*) OVER (PARTITION BY {_DF}, label, day) AS cnt FROM flows_dirty) t
WHERE cnt = 1
""", "flows_dirty"))
def q_drop_all_copies(spark, sf):
    return U.drop_all_copies(flows_dirty(spark, sf), list(DIRTY_FEATURES) + ["label", "day"])


@query("keep_first_per_vector", with_views(f"""
SELECT row_id, label, day, {_DF} FROM (
  SELECT *, row_number() OVER (PARTITION BY {_DF} ORDER BY row_id) AS rn FROM flows_dirty) t
WHERE rn = 1
""", "flows_dirty"))
def q_keep_first(spark, sf):
    return U.keep_first(flows_dirty(spark, sf), DIRTY_FEATURES, "row_id")


# ---- P: label and row-wise expressions -------------------------------------

from ..functions import labels as L  # noqa: E402
from ..functions import rowwise as R  # noqa: E402
from ..operators import profile as A  # noqa: E402
from ..sources.fixtures import scores, table  # noqa: E402

_FAMILY_SQL = """CASE label WHEN 'BENIGN' THEN 'Benign' WHEN 'PortScan' THEN 'PortScan'
  WHEN 'DDoS' THEN 'DoS/DDoS' WHEN 'DoS Hulk' THEN 'DoS/DDoS' WHEN 'DoS GoldenEye' THEN 'DoS/DDoS'
  WHEN 'DoS slowloris' THEN 'DoS/DDoS' WHEN 'DoS Slowhttptest' THEN 'DoS/DDoS'
  WHEN 'Heartbleed' THEN 'DoS/DDoS' WHEN 'FTP-Patator' THEN 'Brute Force'
  WHEN 'SSH-Patator' THEN 'Brute Force' WHEN 'Bot' THEN 'Botnet ARES'
  WHEN 'Web Attack - Brute Force' THEN 'Web Attack' WHEN 'Web Attack - Sql Injection' THEN 'Web Attack'
  WHEN 'Web Attack - XSS' THEN 'Web Attack' WHEN 'Infiltration' THEN 'Infiltration' END"""


@query("label_columns", with_views(f"""
SELECT flow_id, label, {_FAMILY_SQL} AS label_category,
       CAST(label <> 'BENIGN' AS INTEGER) AS binary_label,
       CASE WHEN label = 'BENIGN' THEN 'Benign' ELSE 'Attack' END AS binary_name
FROM (SELECT flow_id, regexp_replace(trim(label), '^Web Attack[^A-Za-z0-9]+', 'Web Attack - ') AS label
      FROM flows) t
""", "flows"))
def q_label_columns(spark, sf):
    f = flows(spark, sf).select("flow_id", L.normalise_label("label").alias("label"))
    return f.select("flow_id", "label", L.label_family("label").alias("label_category"),
                    L.binary_label("label").alias("binary_label"),
                    L.binary_name("label").alias("binary_name"))


@query("label_encode", with_views("""
SELECT flow_id, label, CAST(dense_rank() OVER (ORDER BY label) - 1 AS INTEGER) AS multi_label FROM flows
""", "flows"))
def q_label_encode(spark, sf):
    f = flows(spark, sf)
    enc = L.LabelEncoder().fit(f, "label")
    return f.select("flow_id", "label", enc.encode("label").alias("multi_label"))


@query("ascii_scrub", """
SELECT doc_id, regexp_replace(replace(text, '�', '-'), '[^\\x00-\\x7F]', '', 'g') AS text FROM documents
""")
def q_ascii_scrub(spark, sf):
    return table(spark, sf, "documents").select("doc_id", L.ascii_scrub("text").alias("text"))


@query("rare_class_filter", with_views("""
SELECT flow_id, label FROM flows
WHERE label IN (SELECT label FROM flows GROUP BY label HAVING count(*) > 5)
""", "flows"))
def q_rare_class_filter(spark, sf):
    from ..operators.clean import filter_rare_classes
    return filter_rare_classes(flows(spark, sf), "label", min_count=6).select("flow_id", "label")


@query("rare_class_filter_min50", with_views("""
SELECT flow_id, label FROM flows
WHERE label IN (SELECT label FROM flows GROUP BY label HAVING count(*) >= 50)
""", "flows"))
def q_rare_class_filter_min50(spark, sf):
    from ..operators.clean import filter_rare_classes
    return filter_rare_classes(flows(spark, sf), "label", min_count=50).select("flow_id", "label")


@query("dropped_classes", with_views("""
SELECT label FROM (SELECT DISTINCT label FROM flows)
EXCEPT SELECT label FROM flows GROUP BY label HAVING count(*) >= 50
""", "flows"))
def q_dropped_classes(spark, sf):
    from ..operators.clean import dropped_classes
    return dropped_classes(flows(spark, sf), "label", min_count=50)


_ENG_SQL = {
    "eng_total_packets": "total_fwd_packets + total_backward_packets",
    "eng_fwd_bwd_pkt_ratio": "total_fwd_packets / (total_backward_packets + 1e-6)",
    "eng_total_bytes": "total_length_of_fwd_packets + total_length_of_bwd_packets",
    "eng_fwd_bwd_byte_ratio": "total_length_of_fwd_packets / (total_length_of_bwd_packets + 1e-6)",
    "eng_bytes_per_packet": "(total_length_of_fwd_packets + total_length_of_bwd_packets)"
                            " / (total_fwd_packets + total_backward_packets + 1e-6)",
    "eng_combined_flags": "fin_flag_count + syn_flag_count + flow_id % 3 + flow_id % 5 + flow_id % 7 + flow_id % 11",
}


@query("engineered_features", with_views(
    "SELECT flow_id, " + ", ".join(f"{R.sig_round_sql(e)} AS {k}" for k, e in _ENG_SQL.items())
    + " FROM flows", "flows"))
def q_engineered_features(spark, sf):
    # the view has two of the six flag columns; the others are read off the key
    rest = zip(("rst", "psh", "ack", "urg"), (3, 5, 7, 11))
    f = flows(spark, sf).withColumns({f"{name}_flag_count": F.col("flow_id") % n for name, n in rest})
    eng = R.engineered_features(set(f.columns))
    return f.select("flow_id", *[R.sig_round(v).alias(k) for k, v in eng.items()])


@query("port_bucket", with_views("""
SELECT flow_id, CASE WHEN destination_port BETWEEN 1 AND 1023 THEN '1-1023'
  WHEN destination_port BETWEEN 1024 AND 49151 THEN '1024-49151'
  WHEN destination_port BETWEEN 49152 AND 65535 THEN '49152-65535' ELSE '0' END AS port_bucket
FROM flows
""", "flows"))
def q_port_bucket(spark, sf):
    return flows(spark, sf).select("flow_id", R.port_bucket("destination_port").alias("port_bucket"))


@query("negative_duration", with_views("SELECT flow_id, flow_duration FROM flows WHERE flow_duration < 0", "flows"))
def q_negative_duration(spark, sf):
    return flows(spark, sf).where(R.negative("flow_duration")).select("flow_id", "flow_duration")


@query("threshold_predicate", with_views(
    "SELECT row_id, CAST(score >= 0.5 AS INTEGER) AS pred FROM scores", "scores"))
def q_threshold_predicate(spark, sf):
    return scores(spark, sf).select("row_id", R.at_threshold("score", 0.5).alias("pred"))


@query("row_argmax", """
SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS argmax FROM embeddings
""")
def q_row_argmax(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", R.argmax("embedding").alias("argmax"))


@query("row_softmax", """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
m AS (SELECT vec_id, x, list_max(x) AS mx FROM e),
s AS (SELECT vec_id, x, mx, list_sum(list_transform(x, lambda v: exp(v - mx))) AS tot FROM m)
SELECT vec_id, CAST(pos - 1 AS INTEGER) AS pos, round(exp(x[pos] - mx) / tot, 6) AS p
FROM s, range(1, 65) r(pos) WHERE pos <= len(x)
""")
def q_row_softmax(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", R.softmax("embedding").alias("p"))
    return e.select("vec_id", F.posexplode("p").alias("pos", "p")).select(
        "vec_id", F.col("pos").cast("int"), F.round("p", 6).alias("p"))


@query("one_vs_rest", with_views("""
SELECT row_id, c.y_true AS class, CAST(s.y_true = c.y_true AS INTEGER) AS is_class
FROM scores s CROSS JOIN (SELECT DISTINCT y_true FROM scores) c
""", "scores"))
def q_one_vs_rest(spark, sf):
    s = scores(spark, sf)
    classes = L.class_list(s, "y_true")
    return s.select("row_id", F.arrays_zip(F.array(*[F.lit(c) for c in classes]).alias("class"),
                                           L.one_vs_rest("y_true", classes).alias("is_class")).alias("z")) \
            .select("row_id", F.explode("z").alias("z")).select("row_id", "z.class", "z.is_class")


# ---- A: profiling -----------------------------------------------------------

_DIRTY_ALL = ["row_id", "label", "day"] + DIRTY_FEATURES
_DIRTY_DOUBLE = DIRTY_FEATURES


def _per_column(cols, select_template: str, source: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, " + select_template.format(c=c) + f" FROM {source}" for c in cols)


def _missing_expr(c):
    return f"{c} IS NULL OR isnan({c})" if c in _DIRTY_DOUBLE else f"{c} IS NULL"


@query("shape", with_views("""
SELECT count(*) AS n_rows, count(DISTINCT label) AS n_labels, 11 AS n_columns, 9 AS n_numeric,
       2 AS n_categorical FROM flows_dirty
""", "flows_dirty"))
def q_shape(spark, sf):
    return A.shape(flows_dirty(spark, sf), label="label")


@query("missing_counts", with_views("\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, CAST(count_if({_missing_expr(c)}) AS BIGINT) AS n_missing, "
    f"round(count_if({_missing_expr(c)}) / count(*), 6) AS frac_missing FROM flows_dirty" for c in _DIRTY_ALL),
    "flows_dirty"))
def q_missing_counts(spark, sf):
    m = A.missing_counts(flows_dirty(spark, sf))
    return m.withColumn("frac_missing", F.round("frac_missing", 6))


@query("inf_counts", with_views(
    "SELECT * FROM (" + _per_column(_DIRTY_DOUBLE, "CAST(count_if(isinf({c})) AS BIGINT) AS n_inf", "flows_dirty")
    + ") t WHERE n_inf > 0", "flows_dirty"))
def q_inf_counts(spark, sf):
    return A.inf_counts(flows_dirty(spark, sf), DIRTY_FEATURES)


@query("all_finite", with_views(
    "SELECT coalesce(bool_and(" + " AND ".join(
        f"{c} IS NOT NULL AND isfinite({c})" for c in DIRTY_FEATURES) + "), true) AS all_finite FROM flows_dirty",
    "flows_dirty"))
def q_all_finite(spark, sf):
    return A.all_finite(flows_dirty(spark, sf), DIRTY_FEATURES)


@query("missing_row_labels", with_views(
    "SELECT DISTINCT label FROM flows_dirty WHERE " + " OR ".join(
        f"({_missing_expr(c)})" for c in DIRTY_FEATURES), "flows_dirty"))
def q_missing_row_labels(spark, sf):
    return A.missing_row_labels(flows_dirty(spark, sf), DIRTY_FEATURES, "label")


_NONAN = "CASE WHEN isnan({c}) THEN NULL ELSE {c} END"


@query("constant_columns", with_views(
    "SELECT feature FROM (" + _per_column(
        DIRTY_FEATURES, f"count(DISTINCT {_NONAN}) AS nu", "flows_dirty") + ") t WHERE nu <= 1",
    "flows_dirty"))
def q_constant_columns(spark, sf):
    return A.constant_columns(flows_dirty(spark, sf), DIRTY_FEATURES)


@query("near_constant_columns", with_views("""
WITH v AS (""" + _per_column(DIRTY_FEATURES, f"{_NONAN} AS value", "flows_dirty") + """),
c AS (SELECT feature, value, count(*) AS cnt FROM v WHERE value IS NOT NULL GROUP BY feature, value)
SELECT feature, round(max(cnt) / sum(cnt), 6) AS top_share FROM c
GROUP BY feature HAVING count(*) > 1 AND max(cnt) / sum(cnt) > 0.99
""", "flows_dirty"))
def q_near_constant_columns(spark, sf):
    return A.near_constant_columns(flows_dirty(spark, sf), DIRTY_FEATURES).withColumn(
        "top_share", F.round("top_share", 6))


@query("heavy_columns", with_views("""
WITH v AS (""" + _per_column(DIRTY_FEATURES, f"{_NONAN} AS value", "flows_dirty") + """),
c AS (SELECT feature, value, count(*) AS cnt FROM v WHERE value IS NOT NULL GROUP BY feature, value)
SELECT feature, round(max(cnt) / sum(cnt), 6) AS top_share FROM c
GROUP BY feature HAVING count(*) > 1 AND max(cnt) / sum(cnt) > 0.1
""", "flows_dirty"))
def q_heavy_columns(spark, sf):
    """A9 for any share: columns of which one value holds more than a tenth."""
    return A.near_constant_columns(flows_dirty(spark, sf), DIRTY_FEATURES, share=0.1).withColumn(
        "top_share", F.round("top_share", 6))


@query("value_table", with_views(
    "SELECT feature, value, count(*) AS cnt FROM (" + _per_column(
        DIRTY_FEATURES, f"{_NONAN} AS value", "flows_dirty") + ") t GROUP BY feature, value",
    "flows_dirty"))
def q_value_table(spark, sf):
    return A.value_table(flows_dirty(spark, sf), DIRTY_FEATURES)


@query("label_counts", with_views("""
SELECT label, count(*) AS cnt, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct
FROM flows_dirty GROUP BY label
""", "flows_dirty"))
def q_label_counts(spark, sf):
    return A.label_counts(flows_dirty(spark, sf), "label").withColumn("pct", F.round("pct", 6))


@query("binary_balance", with_views("""
SELECT count_if(label = 'BENIGN') AS n_benign, count_if(label <> 'BENIGN') AS n_attack,
       round(count_if(label = 'BENIGN') / nullif(count_if(label <> 'BENIGN'), 0), 6) AS benign_attack_ratio
FROM flows_dirty
""", "flows_dirty"))
def q_binary_balance(spark, sf):
    return A.binary_balance(flows_dirty(spark, sf), "label").withColumn(
        "benign_attack_ratio", F.round("benign_attack_ratio", 6))


@query("per_day", with_views("""
SELECT day, count(*) AS n_records, count_if(label <> 'BENIGN') AS n_attacks FROM flows_dirty GROUP BY day
""", "flows_dirty"))
def q_per_day(spark, sf):
    return A.per_day(flows_dirty(spark, sf), "day", "label")


_PROBS = [0.25, 0.5, 0.75, 0.95, 0.99, 0.999]
_EV = ["user_id", "value"]


@query("quantiles", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, CAST({p} AS DOUBLE) AS p, round(quantile_cont({c}, {p}), 6) AS q FROM events"
    for c in _EV for p in _PROBS))
def q_quantiles(spark, sf):
    return A.quantiles(table(spark, sf, "events"), _EV, _PROBS).withColumn("q", F.round("q", 6))


@query("quantiles_lineitem", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, CAST({p} AS DOUBLE) AS p, round(quantile_cont({c}, {p}), 6) AS q FROM lineitem"
    for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"] for p in _PROBS))
def q_quantiles_lineitem(spark, sf):
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return A.quantiles(table(spark, sf, "lineitem"), cols, _PROBS).withColumn("q", F.round("q", 6))


@query("iqr_outliers", "\nUNION ALL\n".join(f"""
SELECT '{c}' AS feature, round(lo, 6) AS lower, round(hi, 6) AS upper,
       (SELECT count(*) FROM events WHERE {c} < lo OR {c} > hi) AS n_outliers
FROM (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi
      FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM events) a) b"""
    for c in _EV))
def q_iqr_outliers(spark, sf):
    r = A.iqr_outlier_counts(table(spark, sf, "events"), _EV)
    return r.select("feature", F.round("lower", 6).alias("lower"), F.round("upper", 6).alias("upper"),
                    "n_outliers")


@query("describe", "\nUNION ALL\n".join(f"""
SELECT '{c}' AS feature, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
  round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
  round(quantile_cont({c}, 0.75), 6) AS p75, round(max({c}), 6) AS max FROM events""" for c in _EV))
def q_describe(spark, sf):
    d = A.describe(table(spark, sf, "events"), _EV)
    return d.select("feature", "count", *[F.round(c, 6).alias(c) for c in
                                         ["mean", "std", "min", "p25", "p50", "p75", "max"]])


@query("describe_categorical", """
SELECT 'event_type' AS feature, CAST(sum(cnt) AS BIGINT) AS count, count(*) AS unique,
       arg_min(event_type, (-cnt, event_type)) AS top, max(cnt) AS freq
FROM (SELECT event_type, count(*) AS cnt FROM events WHERE event_type IS NOT NULL GROUP BY event_type) g
""")
def q_describe_categorical(spark, sf):
    return A.top_value(table(spark, sf, "events"), "event_type")


@query("histogram_by_class", """
WITH f AS (SELECT event_type, value FROM events WHERE value IS NOT NULL AND isfinite(value)),
q AS (SELECT quantile_cont(value, 0.99) AS up FROM f),
k AS (SELECT event_type, value AS v FROM f, q WHERE value <= up),
b AS (SELECT max(v) AS up, min(v) AS lo FROM k),
x AS (SELECT event_type, v, up, lo FROM k, b),
h AS (SELECT event_type, CAST(least(floor((v - lo) / (CASE WHEN up > lo THEN up - lo ELSE 1.0 END) * 50), 49) AS INTEGER) AS bin,
             count(*) AS cnt FROM x GROUP BY ALL)
SELECT event_type, bin, cnt, round(cnt / sum(cnt) OVER (PARTITION BY event_type), 6) AS share FROM h
""")
def q_histogram_by_class(spark, sf):
    return A.histogram_by_class(table(spark, sf, "events"), "value", "event_type").withColumn(
        "share", F.round("share", 6))


@query("port_bucket_counts", with_views("""
SELECT port_bucket, count_if(label = 'BENIGN') AS Benign, count_if(label <> 'BENIGN') AS Malicious
FROM (SELECT label, CASE WHEN destination_port BETWEEN 1 AND 1023 THEN '1-1023'
  WHEN destination_port BETWEEN 1024 AND 49151 THEN '1024-49151'
  WHEN destination_port BETWEEN 49152 AND 65535 THEN '49152-65535' ELSE '0' END AS port_bucket FROM flows) t
WHERE port_bucket <> '0' GROUP BY port_bucket
""", "flows"))
def q_port_bucket_counts(spark, sf):
    return A.port_bucket_counts(flows(spark, sf), "destination_port", "label")


@query("std_columns", with_views(_per_column(
    FLOW_FEATURES, R.sig_round_sql("stddev_samp({c})") + " AS std", "flows"), "flows"))
def q_std_columns(spark, sf):
    return A.std_columns(flows(spark, sf), FLOW_FEATURES).withColumn("std", R.sig_round("std"))


@query("top_variance", with_views(
    "SELECT feature, " + R.sig_round_sql("variance") + " AS variance FROM (" + _per_column(
        FLOW_FEATURES, "var_samp({c}) AS variance", "flows") + ") t ORDER BY variance DESC, feature LIMIT 20",
    "flows"))
def q_top_variance(spark, sf):
    return A.top_variance(flows(spark, sf), FLOW_FEATURES).withColumn("variance", R.sig_round("variance"))


@query("class_train_counts", with_views("""
SELECT y_true, count(*) AS train_count, count(*) < 100 AS rare FROM scores WHERE split = 'train' GROUP BY y_true
""", "scores"))
def q_class_train_counts(spark, sf):
    return A.class_train_counts(scores(spark, sf).where("split = 'train'"), "y_true")


# ---- C: cleaning, A21-A27: correlation and redundancy -----------------------

from ..functions.missing import replace_infs  # noqa: E402
from ..operators import clean as C  # noqa: E402
from ..operators import correlation as K  # noqa: E402
from ..operators import fitted as FT  # noqa: E402

_C1 = "CASE WHEN isnan({c}) OR isinf({c}) THEN NULL ELSE {c} END"
_DIRTY_C1 = ("SELECT row_id, label, day, " + ", ".join(f"{_C1.format(c=c)} AS {c}" for c in DIRTY_FEATURES)
             + " FROM flows_dirty")


def dirty_c1(spark, sf):
    return replace_infs(flows_dirty(spark, sf), DIRTY_FEATURES)


def _long_sql(src: str, cols, id_col: str = "row_id", value: str = "{c}") -> str:
    return "\nUNION ALL\n".join(
        f"SELECT {id_col}, '{c}' AS feature, {i} AS pos, {value.format(c=c)} AS value FROM {src}"
        for i, c in enumerate(cols))


def _to_long(df, cols, id_col="row_id"):
    return df.select(id_col, *cols).unpivot([id_col], list(cols), "feature", "value")


@query("replace_infs", with_views(f"WITH c1 AS ({_DIRTY_C1}) SELECT row_id, flow_bytes_s FROM c1", "flows_dirty"))
def q_replace_infs(spark, sf):
    return dirty_c1(spark, sf).select("row_id", "flow_bytes_s")


@query("drop_missing_rows", with_views(
    "SELECT row_id, label FROM flows_dirty WHERE " + " AND ".join(
        f"{c} IS NOT NULL AND NOT isnan({c})" for c in DIRTY_FEATURES), "flows_dirty"))
def q_drop_missing_rows(spark, sf):
    return C.drop_missing_rows(flows_dirty(spark, sf), DIRTY_FEATURES).select("row_id", "label")


@query("drop_inf_rows", with_views(
    f"WITH c1 AS ({_DIRTY_C1}) SELECT row_id, label FROM c1 WHERE " + " AND ".join(
        f"{c} IS NOT NULL" for c in DIRTY_FEATURES), "flows_dirty"))
def q_drop_inf_rows(spark, sf):
    return C.drop_inf_rows(flows_dirty(spark, sf), DIRTY_FEATURES).select("row_id", "label")


@query("fill_constant", with_views(
    "SELECT row_id, CASE WHEN flow_bytes_s IS NULL OR isnan(flow_bytes_s) THEN 0.0 ELSE flow_bytes_s END"
    " AS flow_bytes_s FROM flows_dirty", "flows_dirty"))
def q_fill_constant(spark, sf):
    return C.fill_constant(flows_dirty(spark, sf), ["flow_bytes_s"]).select("row_id", "flow_bytes_s")


@query("low_std_columns", with_views(
    f"WITH c1 AS ({_DIRTY_C1}) SELECT feature FROM (" + _per_column(
        DIRTY_FEATURES, "stddev_samp({c}) AS sd", "c1") + ") t WHERE sd < 0.01", "flows_dirty"))
def q_low_std_columns(spark, sf):
    cols = C.low_std_columns(dirty_c1(spark, sf), DIRTY_FEATURES)
    return spark.createDataFrame([(c,) for c in cols], "feature string")


def _pairs_sql(src, cols, expr: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {i} AS ia, {j} AS ib, "
        + expr.format(a=a, b=b) + f" AS r FROM {src}"
        for i, a in enumerate(cols) for j, b in enumerate(cols) if j > i)


@query("duplicate_column_pairs", with_views(
    f"WITH c AS (SELECT " + ", ".join(f"CASE WHEN isnan({c}) THEN NULL ELSE {c} END AS {c}" for c in DIRTY_FEATURES)
    + " FROM flows_dirty) SELECT feature_a, feature_b FROM (" + _pairs_sql(
        "c", DIRTY_FEATURES, "bool_and({a} IS NOT DISTINCT FROM {b})") + ") t WHERE r", "flows_dirty"))
def q_duplicate_column_pairs(spark, sf):
    return K.duplicate_column_pairs(flows_dirty(spark, sf), DIRTY_FEATURES)


_PEARSON_SQL = f"WITH c1 AS ({_DIRTY_C1}), pr AS (" + _pairs_sql("c1", DIRTY_FEATURES, "corr({a}, {b})") + ")"


@query("pearson_pairs", with_views(_PEARSON_SQL + " SELECT feature_a, feature_b, round(r, 6) AS r FROM pr",
                                   "flows_dirty"))
def q_pearson_pairs(spark, sf):
    return K.pearson_pairs(dirty_c1(spark, sf), DIRTY_FEATURES).withColumn("r", F.round("r", 6))


@query("high_corr_pairs", with_views(
    _PEARSON_SQL + " SELECT feature_b AS feature_a, feature_a AS feature_b, round(r, 6) AS r FROM pr"
    " WHERE abs(r) > 0.95 AND NOT isnan(r)", "flows_dirty"))
def q_high_corr_pairs(spark, sf):
    r = K.pearson_matrix(dirty_c1(spark, sf), DIRTY_FEATURES)
    return K.high_corr_pairs(spark, DIRTY_FEATURES, r, 0.95).withColumn("r", F.round("r", 6))


for _name, _policy, _t, _sel in [
        ("correlated_drop_signed_earlier", "signed_earlier", 0.98, "feature_a FROM pr WHERE r > 0.98 AND NOT isnan(r)"),
        ("correlated_drop_abs_later", "abs_later", 0.95, "feature_b FROM pr WHERE abs(r) > 0.95 AND NOT isnan(r)"),
        ("correlated_drop_abs_earlier", "abs_earlier", 0.95, "feature_a FROM pr WHERE abs(r) > 0.95 AND NOT isnan(r)")]:
    def _mk(policy=_policy, t=_t):
        def fn(spark, sf):
            cols = C.correlated_column_list(dirty_c1(spark, sf), DIRTY_FEATURES, t, policy)
            return spark.createDataFrame([(c,) for c in cols], "feature string")
        return fn
    query(_name, with_views(_PEARSON_SQL + f" SELECT DISTINCT {_sel.replace(' FROM', ' AS feature FROM')}",
                            "flows_dirty"))(_mk())


_FR = ", ".join(FLOW_FEATURES)


def _spearman_sql(cols) -> str:
    ranks = ", ".join(
        f"(rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0) AS {c}" for c in cols)
    return f"WITH rk AS (SELECT {ranks} FROM flows), pr AS (" + _pairs_sql(
        "rk", cols, "corr({a}, {b})") + ") SELECT feature_a, feature_b, round(r, 6) AS r FROM pr"


@query("spearman_pairs", with_views(_spearman_sql(FLOW_FEATURES), "flows"))
def q_spearman_pairs(spark, sf):
    r = K.spearman_matrix(flows(spark, sf), FLOW_FEATURES)
    return K.matrix_to_pairs(spark, FLOW_FEATURES, r).withColumn("r", F.round("r", 6))


def _spearman_pairwise_sql(cols) -> str:
    """Each pair ranked on its own rows; a column that is constant on them gives NaN."""
    def rank(c):
        return f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0"
    return f"WITH c1 AS ({_DIRTY_C1}) " + "\nUNION ALL\n".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, CASE WHEN count(*) < 2 OR min(x) = max(x) OR min(y) = max(y) "
        f"THEN CAST('NaN' AS DOUBLE) ELSE round(corr(x, y), 6) END AS r FROM (SELECT {rank(a)} AS x, {rank(b)} AS y "
        f"FROM c1 WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
        for i, a in enumerate(cols) for b in cols[i + 1:])


@query("spearman_pairs_dirty", with_views(_spearman_pairwise_sql(DIRTY_FEATURES), "flows_dirty"))
def q_spearman_pairs_dirty(spark, sf):
    r = K.spearman_matrix(dirty_c1(spark, sf), DIRTY_FEATURES)
    return K.matrix_to_pairs(spark, DIRTY_FEATURES, r).withColumn("r", F.round("r", 6))


@query("vif")
def q_vif(spark, sf):
    cols = [c for c in FLOW_FEATURES if c not in C.constant_column_list(flows(spark, sf), FLOW_FEATURES)]
    return K.vif(flows(spark, sf), cols)


_MIXED = ["tenth", "price", "gap", "noise"]
_MIXED_SQL = """WITH mixed AS (SELECT CAST(0.1 AS DOUBLE) AS tenth, CAST(o_totalprice AS DOUBLE) * 1e4 AS price,
  CASE WHEN o_orderkey % 2 = 0 THEN CAST(7.3 AS DOUBLE) WHEN o_custkey % 3 = 0 THEN NULL ELSE CAST(o_custkey AS DOUBLE) END AS gap,
  CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey % 97 AS DOUBLE) END AS noise FROM orders)"""


def mixed_orders(spark, sf):
    """A non-zero constant, very different scales, and a column that is constant where another is present."""
    o = table(spark, sf, "orders")
    even = F.col("o_orderkey") % 2 == 0
    cust = F.col("o_custkey")
    return o.select(
        F.lit(0.1).alias("tenth"), (F.col("o_totalprice").cast("double") * 1e4).alias("price"),
        F.when(even, F.lit(7.3)).when(cust % 3 == 0, None).otherwise(cust.cast("double")).alias("gap"),
        F.when(even, (cust % 97).cast("double")).alias("noise"))


@query("pearson_constants", _MIXED_SQL + ", pr AS (" + "\nUNION ALL\n".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, CASE WHEN count(*) < 2 OR min({a}) = max({a}) OR min({b}) = max({b}) "
    f"THEN CAST('NaN' AS DOUBLE) ELSE corr({a}, {b}) END AS r FROM mixed WHERE {a} IS NOT NULL AND {b} IS NOT NULL"
    for i, a in enumerate(_MIXED) for b in _MIXED[i + 1:]) + ") SELECT feature_a, feature_b, round(r, 6) AS r FROM pr")
def q_pearson_constants(spark, sf):
    return K.pearson_pairs(mixed_orders(spark, sf), _MIXED).withColumn("r", F.round("r", 6))


@query("vif_pair", _MIXED_SQL + """, g AS (SELECT sum(price * price) AS a, sum(noise * noise) AS b, sum(price * noise) AS c
  FROM mixed WHERE noise IS NOT NULL)
SELECT unnest(['price', 'noise']) AS feature, round(a * b / (a * b - c * c), 6) AS vif FROM g""")
def q_vif_pair(spark, sf):
    """Closed form for two columns, a factor of 1e7 apart in scale."""
    return K.vif(mixed_orders(spark, sf), ["price", "noise"]).withColumn("vif", F.round("vif", 6))


@query("pca_explained_variance")
def q_pca_explained_variance(spark, sf):
    from pyspark.ml.functions import array_to_vector
    e = table(spark, sf, "embeddings").select(array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    return K.pca_explained_variance(e, "v", target=0.99)


@query("median_impute", with_views(
    f"WITH c1 AS ({_DIRTY_C1}) SELECT row_id, " + R.sig_round_sql(
        "coalesce(flow_bytes_s, (SELECT quantile_cont(flow_bytes_s, 0.5) FROM c1))") + " AS flow_bytes_s FROM c1",
    "flows_dirty"))
def q_median_impute(spark, sf):
    d = dirty_c1(spark, sf)
    m = FT.MedianImputer(inputCols=["flow_bytes_s"]).fit(d)
    return m.transform(d).select("row_id", R.sig_round("flow_bytes_s").alias("flow_bytes_s"))


@query("zscore", with_views(
    "WITH st AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}, coalesce(nullif(stddev_pop({c}), 0), 1) AS s_{c}"
                                     for c in FLOW_FEATURES) + " FROM flows) SELECT flow_id, "
    + ", ".join(f"round(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in FLOW_FEATURES) + " FROM flows, st", "flows"))
def q_zscore(spark, sf):
    f = flows(spark, sf)
    m = FT.StandardScaler(inputCols=FLOW_FEATURES).fit(f)
    return m.transform(f).select("flow_id", *[F.round(c, 6).alias(c) for c in FLOW_FEATURES])


@query("clip_upper", with_views(
    "WITH q AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.999) AS q_{c}" for c in FLOW_FEATURES)
    + " FROM flows) SELECT flow_id, " + ", ".join(
        f"{R.sig_round_sql(f'least({c}, q_{c})')} AS {c}" for c in FLOW_FEATURES) + " FROM flows, q", "flows"))
def q_clip_upper(spark, sf):
    f = flows(spark, sf)
    m = FT.ClipUpper(inputCols=FLOW_FEATURES, p=99.9).fit(f)
    return m.transform(f).select("flow_id", *[R.sig_round(c).alias(c) for c in FLOW_FEATURES])


@query("log1p_heavy", with_views(
    "WITH st AS (SELECT " + ", ".join(f"max({c}) AS hi_{c}, min({c}) AS lo_{c}" for c in FLOW_FEATURES)
    + " FROM flows) SELECT flow_id, " + ", ".join(
        f"{R.sig_round_sql(f'CASE WHEN hi_{c} > 1000 AND lo_{c} >= 0 THEN ln(1 + {c}) ELSE {c} END')} AS {c}"
        for c in FLOW_FEATURES) + " FROM flows, st", "flows"))
def q_log1p_heavy(spark, sf):
    f = flows(spark, sf)
    m = FT.Log1pHeavy(inputCols=FLOW_FEATURES).fit(f)
    return m.transform(f).select("flow_id", *[R.sig_round(F.col(c).cast("double")).alias(c) for c in FLOW_FEATURES])


@query("iqr_outlier_flags", """
WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
SELECT event_id, (value < q1 - 1.5 * (q3 - q1)) OR (value > q3 + 1.5 * (q3 - q1)) AS is_outlier FROM events, q
""")
def q_iqr_outlier_flags(spark, sf):
    ev = table(spark, sf, "events")
    qm = A.quantile_map(A.quantiles(ev, ["value"], [0.25, 0.75]))
    return ev.select("event_id", R.iqr_outlier("value", qm[("value", 0.25)], qm[("value", 0.75)]).alias("is_outlier"))


# ---- S: CSV ingest round trip ---------------------------------------------------

_RAW_NAMES = {"row_id": "Row Id", "label": "Label", "flow_duration": " Flow Duration",
              "total_fwd_packets": " Total Fwd Packets", "total_backward_packets": "Total Backward Packets",
              "total_length_of_fwd_packets": "Total Length of Fwd Packets", "flow_bytes_s": "Flow Bytes/s",
              "bwd_psh_flags": "Bwd PSH Flags", "cwe_flag_count": "CWE Flag Count",
              "subflow_fwd_packets": "Subflow Fwd Packets"}


@query("csv_roundtrip", with_views(
    "SELECT CAST(row_id AS DOUBLE) AS row_id, label, day, " + ", ".join(
        f"CASE WHEN isnan({c}) THEN NULL ELSE {c} END AS {c}" for c in DIRTY_FEATURES) + " FROM flows_dirty",
    "flows_dirty"))
def q_csv_roundtrip(spark, sf):
    """The dirty flows written as one CSV folder per capture day
    (Monday with another column order), read back with :func:`read_flows`."""
    from ..sources.flows import read_flows
    back = read_flows(spark, _write_days(spark, sf), names="snake", label="Label")
    return back.select("row_id", "label", "day", *DIRTY_FEATURES)


@query("load_flows", with_views("""SELECT day, label, count(*) AS cnt, count(*) AS ids FROM flows_dirty GROUP BY day, label""",
                                "flows_dirty"))
def q_load_flows(spark, sf):
    """S1/S2/S4/S6 through the one entry point: every row is loaded, each with an id of its own."""
    df = _audit.load_flows(spark, _write_days(spark, sf))
    return df.groupBy(F.col("Day").alias("day"), F.col("Label").alias("label")).agg(
        F.count(F.lit(1)).alias("cnt"), F.count_distinct("row_id").alias("ids"))


@query("capture_files", with_views("WITH f(file, day, content) AS (VALUES "
       + ", ".join(f"('{f}', '{d}', '{c}')" for f, d, c in CAPTURE_FILES) + """),
n AS (SELECT day, count(*) AS day_flows, count_if(label = 'BENIGN') AS day_benign FROM flows_dirty GROUP BY day)
SELECT file, day, content, coalesce(day_flows, 0) AS day_flows, coalesce(day_benign, 0) AS day_benign
FROM f LEFT JOIN n USING (day)""", "flows_dirty"))
def q_capture_files(spark, sf):
    """The capture files with the flows and benign flows of their days."""
    from ..sources.flows import capture_files
    n = flows_dirty(spark, sf).groupBy("day").agg(F.count(F.lit(1)).alias("day_flows"),
                                                  F.count_if(F.col("label") == BENIGN).alias("day_benign"))
    return capture_files(spark).join(n, "day", "left").na.fill(0, ["day_flows", "day_benign"])


def _write_days(spark, sf) -> str:
    from ..sources.store import scratch_path
    d = flows_dirty(spark, sf)
    base = scratch_path(spark, "csv")
    order = list(_RAW_NAMES)
    for day in ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday"]:
        cols = order if day != "Monday" else list(reversed(order))
        part = d.where(F.col("day") == day).select(*[F.col(c).alias(_RAW_NAMES[c]) for c in cols])
        part.write.mode("overwrite").option("header", True).csv(f"{base}/{day}-WorkingHours.csv")
    return base


# ---- C18 / C19 compositions (long form: the kept columns depend on the data) ---

from . import audit as _audit  # noqa: E402
from . import paper as _paper  # noqa: E402

_MED = ("med AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in DIRTY_FEATURES) + " FROM c1),\n"
        "imp AS (SELECT row_id, label, " + ", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in DIRTY_FEATURES)
        + " FROM c1, med)")


@query("clean_audit", with_views(f"""WITH c1 AS ({_DIRTY_C1}), {_MED},
lng AS ({_long_sql('imp', DIRTY_FEATURES)}),
const AS (SELECT feature FROM lng GROUP BY feature HAVING count(DISTINCT value) <= 1),
pairs AS (SELECT a.feature AS fa, b.feature AS fb FROM lng a JOIN lng b ON a.row_id = b.row_id AND a.pos < b.pos
          WHERE a.feature NOT IN (SELECT feature FROM const) AND b.feature NOT IN (SELECT feature FROM const)
          GROUP BY a.feature, b.feature HAVING bool_and(a.value IS NOT DISTINCT FROM b.value)),
dups AS (SELECT DISTINCT fb AS feature FROM pairs)
SELECT row_id, feature, {R.sig_round_sql('value')} AS value FROM lng
WHERE feature NOT IN (SELECT feature FROM const) AND feature NOT IN (SELECT feature FROM dups)
""", "flows_dirty"))
def q_clean_audit(spark, sf):
    out, _, _, _, sch = _audit.clean_audit(flows_dirty(spark, sf), DIRTY)
    return _to_long(out, list(sch.features)).select("row_id", "feature", R.sig_round("value").alias("value"))


@query("clean_audit_labels", with_views("""
SELECT row_id, CAST(dense_rank() OVER (ORDER BY label) - 1 AS INTEGER) AS multi_label,
       CAST(label <> 'BENIGN' AS INTEGER) AS binary_label FROM flows_dirty
""", "flows_dirty"))
def q_clean_audit_labels(spark, sf):
    out = _audit.clean_audit(flows_dirty(spark, sf), DIRTY)[0]
    return out.select("row_id", "multi_label", "binary_label")


_PAPER_PAIRS = _pairs_sql("c2", DIRTY_FEATURES, "corr({a}, {b})")


@query("clean_paper", with_views(f"""WITH c3 AS (SELECT * EXCLUDE (cnt) FROM (
    SELECT *, count(*) OVER (PARTITION BY {_DF}, label, day) AS cnt FROM flows_dirty) t WHERE cnt = 1),
c2 AS (SELECT * FROM c3 WHERE """ + " AND ".join(f"{c} IS NOT NULL AND isfinite({c})" for c in DIRTY_FEATURES) + f"""),
sd AS ({_per_column(DIRTY_FEATURES, 'stddev_samp({c}) AS sd', 'c2')}),
kept7 AS (SELECT feature FROM sd WHERE NOT (sd < 0.01)),
pr AS ({_PAPER_PAIRS}),
c11 AS (SELECT DISTINCT feature_a AS feature FROM pr WHERE r > 0.98 AND NOT isnan(r)
        AND feature_a IN (SELECT feature FROM kept7) AND feature_b IN (SELECT feature FROM kept7)),
lng AS ({_long_sql('c2', DIRTY_FEATURES)})
SELECT l.row_id, {_FAMILY_SQL.replace('CASE label', 'CASE c2.label')} AS label_category, l.feature,
       {R.sig_round_sql('l.value')} AS value
FROM lng l JOIN c2 ON c2.row_id = l.row_id
WHERE l.feature IN (SELECT feature FROM kept7) AND l.feature NOT IN (SELECT feature FROM c11)
""", "flows_dirty"))
def q_clean_paper(spark, sf):
    out, keep = _paper.clean_paper(flows_dirty(spark, sf), DIRTY_FEATURES, "label", "day")
    return (out.select("row_id", "label_category", *keep).unpivot(["row_id", "label_category"], keep, "feature", "value")
               .select("row_id", "label_category", "feature", R.sig_round("value").alias("value")))


@query("one_hot_drop_first", """
SELECT event_id, CAST(event_type = 'error' AS DOUBLE) AS event_type_error,
       CAST(event_type = 'purchase' AS DOUBLE) AS event_type_purchase,
       CAST(event_type = 'signup' AS DOUBLE) AS event_type_signup,
       CAST(event_type = 'view' AS DOUBLE) AS event_type_view FROM events
""")
def q_one_hot_drop_first(spark, sf):
    """P21 on the events' categorical column (levels: alphabetical, first dropped)."""
    return L.one_hot_drop_first(table(spark, sf, "events").select("event_id", "event_type"), ["event_type"])


@query("pearson_sample", with_views(
    f"WITH c1 AS ({_DIRTY_C1}), smp AS (SELECT * FROM c1 ORDER BY md5(concat('42-', CAST(row_id AS VARCHAR))), row_id"
    " LIMIT 10000), pr AS (" + _pairs_sql("smp", DIRTY_FEATURES, "corr({a}, {b})") + ")"
    " SELECT feature_a, feature_b, round(r, 6) AS r FROM pr", "flows_dirty"))
def q_pearson_sample(spark, sf):
    """A23 + A21: correlation on a 10,000-row hash-ordered sample (the limit is the feature)."""
    from ..operators.splits import sample_without_replacement
    smp = sample_without_replacement(dirty_c1(spark, sf), "row_id", 10000)
    return K.pearson_pairs(smp, DIRTY_FEATURES).withColumn("r", F.round("r", 6))


@query("table_roundtrip", with_views("""
SELECT label, count(*) AS cnt FROM flows_dirty GROUP BY label
""", "flows_dirty"))
def q_table_roundtrip(spark, sf):
    """S13 + S14 (CSV) and S15 (JSON): a result table written and read back."""
    from ..sources.store import read_table, scratch_path, write_table
    t = A.label_counts(flows_dirty(spark, sf), "label").select("label", "cnt")
    p1, p2 = scratch_path(spark, "csv"), scratch_path(spark, "json")
    write_table(t, p1, "csv")
    write_table(t, p2, "json")
    back = read_table(spark, p1, "csv").join(read_table(spark, p2, "json").withColumnRenamed("cnt", "cnt2"), "label")
    return back.where(F.col("cnt") == F.col("cnt2")).select("label", F.col("cnt").cast("bigint").alias("cnt"))


@query("histogram_symlog", with_views("""
WITH c AS (SELECT CASE WHEN label = 'BENIGN' THEN 'Benign' ELSE 'Attack' END AS kind,
                  CASE WHEN isnan(flow_bytes_s) OR isinf(flow_bytes_s) THEN NULL ELSE flow_bytes_s END AS v FROM flows_dirty),
m AS (SELECT quantile_cont(v, 0.5) AS med FROM c),
f AS (SELECT kind, coalesce(v, med) AS v FROM c, m),
t AS (SELECT kind, CASE WHEN (SELECT max(v) FROM f) > 1000 THEN sign(v) * ln(1 + abs(v)) ELSE v END AS v FROM f),
b AS (SELECT min(v) AS lo, max(v) AS hi FROM t),
h AS (SELECT kind, CAST(least(floor((v - lo) / (CASE WHEN hi > lo THEN hi - lo ELSE 1.0 END) * 50), 49) AS INTEGER) AS bin,
             count(*) AS cnt FROM t, b GROUP BY ALL)
SELECT kind, bin, cnt, round(cnt / sum(cnt) OVER (PARTITION BY kind), 6) AS share FROM h
""", "flows_dirty"))
def q_histogram_symlog(spark, sf):
    """A17, symmetric-log variant, benign vs attack (P6) on the dirty flow rate column."""
    d = flows_dirty(spark, sf).withColumn("kind", L.binary_name("label"))
    return A.histogram_by_class(d, "flow_bytes_s", "kind", mode="symlog").withColumn("share", F.round("share", 6))
