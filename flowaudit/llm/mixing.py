"""Operator 4: mixing sources to target weights by systematic sampling.

Every document of a source expects ``target / source size`` copies.  Documents
are laid end to end, each as long as its expected copies; starting from one
random offset per source, a document is emitted once per integer boundary that
falls into its stretch.  The order along the line is (size class, md5 of the
id), so that every size class is taken at the same rate and the words taken
follow the target closely.

The prefix sums run in two levels: rows within a bucket (source, size class,
leading md5 digits), and bucket totals within a source.  The number of digits
follows the row count, so a bucket stays near ``bucket_rows`` whatever a
source's share, and it does not change the result.  All sums are integers in
units of 1 / ``ONE`` copies, hence exact and independent of the partitioning.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from .common import stage

ONE = 10_000_000
WORD = r"[^\x20\x09-\x0D]+"


def count_words(text):
    return F.coalesce(F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sized: DataFrame, weights: list[float], cap: int, total=None) -> DataFrame:
    """source, source_size, target: ``total`` (all sizes, if null) shared by weight.

    ``weights`` go round the sources in code point order, null last.  No
    target exceeds ``cap`` times its source's size; what is above is shared
    out again by weight.  Sources by the ratio of cap to weight: the next is
    capped if an equal share of what the capped ones leave would exceed it.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = per.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                           (F.row_number().over(by_name) - 1) % len(weights) + 1)) \
        .withColumn("most", cap * F.col("source_size"))
    ratio = [F.col("most") / F.col("w"), F.col("source").isNull(), F.col("source")]
    before = Window.orderBy(*ratio).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    budget = F.sum("source_size").over(every) if total is None else F.lit(total)
    per = per.withColumn("budget", budget) \
        .withColumn("gone", F.coalesce(F.sum("most").over(before), F.lit(0))) \
        .withColumn("left_w", F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))) \
        .withColumn("capped", (F.col("budget") - F.col("gone")).cast("double") * F.col("w")
                    > F.col("most").cast("double") * F.col("left_w"))
    rest = F.col("budget") - F.sum(F.when(F.col("capped"), F.col("most")).otherwise(0)).over(every)
    open_w = F.sum(F.when(F.col("capped"), F.lit(0.0)).otherwise(F.col("w"))).over(every)
    return per.withColumn("target", F.when(F.col("capped"), F.col("most").cast("double"))
                          .otherwise(rest.cast("double") * F.col("w") / open_w)) \
        .select("source", "source_size", "target")


def size_class(size):
    """Decimal length and two leading digits: about 90 classes per power of ten."""
    s = size.cast("string")
    return F.length(s) * 100 + F.rpad(s, 2, "0").substr(1, 2).cast("int")


def mix(docs: DataFrame, weights: list[float] = (1.0, 2.0, 3.0), cap: int = 3, total: int | None = None,
        seed: int = 17, bucket_rows: int = 100_000, carry: bool = False) -> DataFrame:
    """How often each document of ``docs`` (doc_id, text, source) enters the mix.

    Returns doc_id, source, size (words of the text; 0 for null or empty
    texts), source_size, target (words that its source should contribute) and
    copies (0 to ``cap``).  Rerunning gives the same copies.  A null source is
    a source of its own, ordered last; a source without words has target 0.
    Repeated rows are rows of their own; rows with equal doc_id and size class
    are interchangeable.  A null doc_id is ordered as an empty id.  An empty
    table gives an empty result; other columns are ignored, unless
    ``carry`` asks for them: then a struct ``row`` holds all input columns.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if carry else F.lit(None).cast("int")
    sized = stage(docs.select(F.col("doc_id"), F.col("source").cast("string").alias("source"),
                              count_words(F.col("text")).alias("size"), row.alias("row")), "sizes")
    rows = sized.count()
    digits = max(1, math.ceil(math.log(max(1, rows / bucket_rows), 16)))
    keyed = sized.withColumn("class", size_class(F.col("size"))) \
        .withColumn("place", F.md5(F.concat(F.lit(f"{seed}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))) \
        .withColumn("lead", F.substring("place", 1, digits))
    keys = ["source", "class", "lead"]
    shares = targets(sized, list(weights), cap, total)
    per = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size").cast("double") * ONE)) \
        .otherwise(0).cast("long")
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}/"), F.coalesce("source", F.lit("")))), 1, 7),
                    16, 10).cast("long") % ONE
    shares = shares.withColumn("each", F.least(per, F.lit(cap * ONE))).withColumn("offset", offset)
    name = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("")).alias("name")      # joins nulls too
    buckets = keyed.groupBy(*keys).agg(F.count("*").alias("n")) \
        .withColumn("ahead", F.sum("n").over(Window.partitionBy("source").orderBy("class", "lead")) - F.col("n")) \
        .select(name, "class", "lead", "ahead") \
        .join(shares.select(name, "source_size", "target", "each", "offset"), "name")
    ranked = keyed.select("doc_id", "source", name, "size", "class", "lead", "place", "row") \
        .withColumn("r", F.row_number().over(Window.partitionBy("name", "class", "lead").orderBy("place", "doc_id", "size")))
    at = lambda rank: F.floor((F.col("offset") + F.col("each") * rank) / F.lit(ONE).cast("decimal(18,0)"))
    rank = F.col("ahead") + F.col("r")
    return ranked.join(buckets, ["name", "class", "lead"]).select(
        "doc_id", "source", "size", "source_size", "target", (at(rank) - at(rank - 1)).cast("int").alias("copies"),
        *(["row"] if carry else []))


def mix_sql(table: str = "documents", seed: int = 17) -> str:
    """DuckDB twin of :func:`mix` with its default parameters."""
    return f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size FROM {table}),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, CAST((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS DOUBLE) AS w,
         3 * source_size AS most FROM per),
spread AS (
  SELECT *, CAST(sum(source_size) OVER () AS BIGINT) AS budget,
         CAST(coalesce(sum(most) OVER a, 0) AS BIGINT) AS gone,
         sum(w) OVER () - coalesce(sum(w) OVER a, 0.0) AS left_w
  FROM weighed
  WINDOW a AS (ORDER BY most / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
marked AS (SELECT *, CAST(budget - gone AS DOUBLE) * w > CAST(most AS DOUBLE) * left_w AS capped FROM spread),
aimed AS (
  SELECT source, source_size, CASE WHEN capped THEN CAST(most AS DOUBLE) ELSE
    CAST(budget - CAST(sum(CASE WHEN capped THEN most ELSE 0 END) OVER () AS BIGINT) AS DOUBLE) * w
      / sum(CASE WHEN capped THEN 0.0 ELSE w END) OVER () END AS target FROM marked),
shares AS (
  SELECT *, CASE WHEN source_size > 0 THEN
      least(CAST(floor(target / CAST(source_size AS DOUBLE) * {ONE}) AS BIGINT), {3 * ONE}) ELSE 0 END AS each,
    CAST('0x' || substr(md5('{seed}/' || coalesce(source, '')), 1, 7) AS BIGINT) % {ONE} AS shift
  FROM aimed),
ranked AS (
  SELECT doc_id, source, size, row_number() OVER (
    PARTITION BY source ORDER BY len(CAST(size AS VARCHAR)) * 100
      + CAST(substr(rpad(CAST(size AS VARCHAR), 2, '0'), 1, 2) AS INTEGER),
      md5('{seed}-' || coalesce(CAST(doc_id AS VARCHAR), '')), doc_id, size) AS r FROM sized)
SELECT doc_id, size, source_size, target,
       ((shift + each * r) // {ONE} - (shift + each * (r - 1)) // {ONE}) * size AS taken
FROM ranked JOIN shares ON ranked.source IS NOT DISTINCT FROM shares.source"""
