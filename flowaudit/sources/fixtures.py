"""Flow-shaped views derived from the given tables (orders, lineitem).

``flows``        one flow per order; label/day/features from order and line aggregates
``flows_dirty``  flows with NaN, NULL, +Inf, a constant, a near-constant and a
                 copied column, plus duplicated and label-conflicting rows
``scores``       stand-in model output (label, prediction, score, split)

Every view grows with its source tables.  The Spark builders below use the
DataFrame API; the ``*_SQL`` strings are the same definitions as text for the
DuckDB oracle, prepended as ``WITH`` clauses by :func:`with_views`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

FLOW_FEATURES = [
    "destination_port", "flow_duration", "total_fwd_packets", "total_backward_packets",
    "total_length_of_fwd_packets", "total_length_of_bwd_packets", "fwd_packet_length_max",
    "fin_flag_count", "syn_flag_count", "init_win_bytes_forward",
]
DIRTY_FEATURES = [
    "flow_duration", "total_fwd_packets", "total_backward_packets",
    "total_length_of_fwd_packets", "flow_bytes_s", "bwd_psh_flags", "cwe_flag_count",
    "subflow_fwd_packets",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _class_of(key: Column) -> Column:
    r = key % 200
    return (F.when(r < 160, "BENIGN").when(r < 180, "DoS Hulk").when(r < 190, "PortScan")
            .when(r < 196, "DDoS").when(r < 199, "Bot")
            .when(key % 1000 == 199, "Heartbleed").otherwise("Infiltration"))


def _day_of(key: Column) -> Column:
    r = key % 5
    return (F.when(r == 0, "Monday").when(r == 1, "Tuesday").when(r == 2, "Wednesday")
            .when(r == 3, "Thursday").otherwise("Friday"))


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flow per order.  Line aggregates are pre-aggregated per order
    (partial + final hash aggregate) before the join, so the join input is
    one row per order on both sides."""
    lines = (table(spark, sf_dir, "lineitem")
             .groupBy("l_orderkey")
             .agg(F.count(F.lit(1)).alias("n_lines"),
                  F.sum(F.col("l_quantity").cast("bigint")).alias("qty"),
                  F.max(F.col("l_quantity").cast("bigint")).alias("max_qty"),
                  F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("cents")))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    j = o.join(lines, o.o_orderkey == lines.l_orderkey, "left")
    k = F.col("o_orderkey")
    benign = (k % 200) < 160
    dbl = lambda c: c.cast("double")
    return j.select(
        k.alias("flow_id"),
        _class_of(k).alias("label"),
        _day_of(k).alias("day"),
        ((k * 7919) % 65536).alias("destination_port"),
        dbl((k * 31) % 97 - 1).alias("flow_duration"),
        dbl(F.coalesce("n_lines", F.lit(0)) + F.when(benign, 0).otherwise(5)).alias("total_fwd_packets"),
        dbl(F.coalesce("qty", F.lit(0))).alias("total_backward_packets"),
        dbl(F.coalesce("cents", F.lit(0))).alias("total_length_of_fwd_packets"),
        dbl(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("total_length_of_bwd_packets"),
        dbl(F.coalesce("max_qty", F.lit(0))).alias("fwd_packet_length_max"),
        dbl(k % 2).alias("fin_flag_count"),
        dbl(k % 3).alias("syn_flag_count"),
        dbl(F.col("o_custkey")).alias("init_win_bytes_forward"),
    )


def flows_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = flows(spark, sf_dir)
    fid = F.col("flow_id")
    base = f.select(
        "label", "day", "flow_duration", "total_fwd_packets", "total_backward_packets",
        "total_length_of_fwd_packets",
        F.when(F.col("flow_duration") == 0, F.lit(float("inf")))
         .when(fid % 37 == 0, F.lit(float("nan")))
         .when(fid % 41 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("total_length_of_fwd_packets") / F.col("flow_duration")).alias("flow_bytes_s"),
        F.lit(0.0).alias("bwd_psh_flags"),
        F.when(fid % 500 == 0, 1.0).otherwise(0.0).alias("cwe_flag_count"),
        F.col("total_fwd_packets").alias("subflow_fwd_packets"),
        fid,
    )
    # the three copies come from one scan: each flow explodes into its
    # original, an exact duplicate (every 20th) and a relabelled copy (every 50th)
    copy = lambda c, lab: F.struct(F.lit(c).alias("c"), lab.alias("lab"))
    copies = F.array(copy(0, F.col("label")),
                     F.when(fid % 20 == 0, copy(1, F.col("label"))),
                     F.when(fid % 50 == 1, copy(2, F.lit("PortScan"))))
    ex = base.select("*", F.explode(F.filter(copies, lambda x: x.isNotNull())).alias("cp"))
    return ex.select((fid * 3 + F.col("cp.c")).alias("row_id"), F.col("cp.lab").alias("label"), "day",
                     *DIRTY_FEATURES)


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = flows(spark, sf_dir)
    fid = F.col("flow_id")
    benign = F.col("label") == "BENIGN"
    return f.select(
        fid.alias("row_id"), "day", F.col("label").alias("y_true"),
        F.when(fid % 7 == 0, F.when(benign, "DoS Hulk").otherwise("BENIGN"))
         .otherwise(F.col("label")).alias("y_pred"),
        F.when(benign, 0).otherwise(1).alias("y"),
        (((fid * 7919) % 701 + F.when(benign, 0).otherwise(299)).cast("double") / 1000).alias("score"),
        F.when(fid % 5 < 3, "train").when(fid % 5 == 3, "val").otherwise("test").alias("split"),
    )


# ---------------------------------------------------------------------------
# SQL twins (DuckDB oracle); identical definitions as text.
# ---------------------------------------------------------------------------

FLOWS_SQL = """
SELECT o.o_orderkey AS flow_id,
  CASE WHEN o.o_orderkey % 200 < 160 THEN 'BENIGN'
       WHEN o.o_orderkey % 200 < 180 THEN 'DoS Hulk'
       WHEN o.o_orderkey % 200 < 190 THEN 'PortScan'
       WHEN o.o_orderkey % 200 < 196 THEN 'DDoS'
       WHEN o.o_orderkey % 200 < 199 THEN 'Bot'
       WHEN o.o_orderkey % 1000 = 199 THEN 'Heartbleed'
       ELSE 'Infiltration' END AS label,
  CASE o.o_orderkey % 5 WHEN 0 THEN 'Monday' WHEN 1 THEN 'Tuesday' WHEN 2 THEN 'Wednesday'
       WHEN 3 THEN 'Thursday' ELSE 'Friday' END AS day,
  (o.o_orderkey * 7919) % 65536 AS destination_port,
  CAST((o.o_orderkey * 31) % 97 - 1 AS DOUBLE) AS flow_duration,
  CAST(coalesce(l.n_lines, 0) + CASE WHEN o.o_orderkey % 200 < 160 THEN 0 ELSE 5 END AS DOUBLE) AS total_fwd_packets,
  CAST(coalesce(l.qty, 0) AS DOUBLE) AS total_backward_packets,
  CAST(coalesce(l.cents, 0) AS DOUBLE) AS total_length_of_fwd_packets,
  CAST(CAST(round(o.o_totalprice * 100) AS BIGINT) AS DOUBLE) AS total_length_of_bwd_packets,
  CAST(coalesce(l.max_qty, 0) AS DOUBLE) AS fwd_packet_length_max,
  CAST(o.o_orderkey % 2 AS DOUBLE) AS fin_flag_count,
  CAST(o.o_orderkey % 3 AS DOUBLE) AS syn_flag_count,
  CAST(o.o_custkey AS DOUBLE) AS init_win_bytes_forward
FROM orders o LEFT JOIN (
  SELECT l_orderkey, count(*) AS n_lines,
         sum(CAST(l_quantity AS BIGINT)) AS qty, max(CAST(l_quantity AS BIGINT)) AS max_qty,
         sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS cents
  FROM lineitem GROUP BY l_orderkey) l ON o.o_orderkey = l.l_orderkey
"""

FLOWS_DIRTY_SQL = """
WITH base AS (
  SELECT label, day, flow_duration, total_fwd_packets, total_backward_packets,
    total_length_of_fwd_packets,
    CASE WHEN flow_duration = 0 THEN CAST('Infinity' AS DOUBLE)
         WHEN flow_id % 37 = 0 THEN CAST('NaN' AS DOUBLE)
         WHEN flow_id % 41 = 0 THEN CAST(NULL AS DOUBLE)
         ELSE total_length_of_fwd_packets / flow_duration END AS flow_bytes_s,
    CAST(0 AS DOUBLE) AS bwd_psh_flags,
    CAST(CASE WHEN flow_id % 500 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS cwe_flag_count,
    total_fwd_packets AS subflow_fwd_packets, flow_id
  FROM flows)
SELECT flow_id * 3 AS row_id, label, day, flow_duration, total_fwd_packets, total_backward_packets, total_length_of_fwd_packets, flow_bytes_s, bwd_psh_flags, cwe_flag_count, subflow_fwd_packets FROM base
UNION ALL
SELECT flow_id * 3 + 1, label, day, flow_duration, total_fwd_packets, total_backward_packets, total_length_of_fwd_packets, flow_bytes_s, bwd_psh_flags, cwe_flag_count, subflow_fwd_packets FROM base WHERE flow_id % 20 = 0
UNION ALL
SELECT flow_id * 3 + 2, 'PortScan', day, flow_duration, total_fwd_packets, total_backward_packets, total_length_of_fwd_packets, flow_bytes_s, bwd_psh_flags, cwe_flag_count, subflow_fwd_packets FROM base WHERE flow_id % 50 = 1
"""

SCORES_SQL = """
SELECT flow_id AS row_id, day, label AS y_true,
  CASE WHEN flow_id % 7 = 0 THEN CASE WHEN label = 'BENIGN' THEN 'DoS Hulk' ELSE 'BENIGN' END ELSE label END AS y_pred,
  CASE WHEN label = 'BENIGN' THEN 0 ELSE 1 END AS y,
  CAST((flow_id * 7919) % 701 + CASE WHEN label = 'BENIGN' THEN 0 ELSE 299 END AS DOUBLE) / 1000 AS score,
  CASE WHEN flow_id % 5 < 3 THEN 'train' WHEN flow_id % 5 = 3 THEN 'val' ELSE 'test' END AS split
FROM flows
"""

_VIEW_SQL = {"flows": FLOWS_SQL, "flows_dirty": FLOWS_DIRTY_SQL, "scores": SCORES_SQL}
_DEPENDS = {"flows": [], "flows_dirty": ["flows"], "scores": ["flows"]}


def with_views(body: str, *views: str) -> str:
    """Prefix ``body`` with the fixture views it names (and what they need)."""
    order: list[str] = []
    for v in views:
        for d in _DEPENDS[v] + [v]:
            if d not in order:
                order.append(d)
    if not order:
        return body
    ctes = ",\n".join(f"{v} AS ({_VIEW_SQL[v]})" for v in order)
    stripped = body.lstrip()
    if stripped[:15].upper() == "WITH RECURSIVE ":
        return f"WITH RECURSIVE {ctes},\n{stripped[15:]}"
    if stripped[:4].upper() == "WITH" and stripped[4:5].isspace():
        return f"WITH {ctes},\n{stripped[5:]}"
    return f"WITH {ctes}\n{body}"


FIXTURES = {"flows": flows, "flows_dirty": flows_dirty, "scores": scores}
