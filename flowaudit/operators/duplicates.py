"""Duplicate audit (U1-U6) and duplicate-driven row removal.

All counts come from one aggregation on the exact row key (the features'
128-bit digest + label + day) followed by a re-aggregation of its *distinct*
rows on the digest; the vectors themselves are not shuffled.  Partial aggregation collapses a hot vector
map-side, so a vector holding a third of the table costs one row per
map task, not one giant reducer.  Grouping treats NULL=NULL, NaN=NaN and
-0.0=0.0 as equal, like pandas ``duplicated``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.missing import row_digest
from ..schema import FlowSchema
from ..session import cut_lineage
from .digests import digest_counts, with_facts


def exact_groups(df: DataFrame, schema: FlowSchema) -> DataFrame:
    """(digest of the features, label, day, cnt): one row per distinct full row."""
    keys = [schema.label] + ([schema.day] if schema.day else [])
    return df.select(*row_digest(schema.features), *keys).groupBy("_d1", "_d2", *keys).agg(F.count(F.lit(1)).alias("cnt"))


def vector_groups(exact: DataFrame, schema: FlowSchema) -> DataFrame:
    """(digest, n, n_rowkeys, conflicting) from the exact groups."""
    return exact.groupBy("_d1", "_d2").agg(
        F.sum("cnt").alias("n"),
        F.count(F.lit(1)).alias("n_rowkeys"),
        (F.min(schema.label) != F.max(schema.label)).alias("conflicting"),
    )


def audit_summary(df: DataFrame, schema: FlowSchema) -> DataFrame:
    """One row with the audit counts."""
    v = vector_groups(exact_groups(df, schema), schema)
    return v.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_rows"),
        F.coalesce(F.sum(F.col("n") - F.col("n_rowkeys")), F.lit(0)).cast("bigint").alias("exact_duplicates"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("feature_duplicates"),
        F.count_if("conflicting").cast("bigint").alias("conflicting_label_vectors"),
    )


def exact_duplicate_count(df: DataFrame, schema: FlowSchema) -> DataFrame:
    """Rows that repeat an earlier row (all columns)."""
    return exact_groups(df, schema).agg(
        F.coalesce(F.sum(F.col("cnt") - 1), F.lit(0)).cast("bigint").alias("exact_duplicates"))


def feature_duplicate_count(df: DataFrame, schema: FlowSchema) -> DataFrame:
    """Rows repeating an earlier feature vector (label and day ignored)."""
    return (df.select(*row_digest(schema.features)).groupBy("_d1", "_d2").agg(F.count(F.lit(1)).alias("cnt"))
              .agg(F.coalesce(F.sum(F.col("cnt") - 1), F.lit(0)).cast("bigint").alias("feature_duplicates")))


def conflicting_vectors(df: DataFrame, schema: FlowSchema) -> DataFrame:
    """U3 (row form): feature vectors carrying more than one label, with the
    number of rows and distinct labels.  Distinct labels per vector are bounded
    by the class count, so ``collect_set`` stays small.  Labels are gathered by
    digest; vectors are fetched for the conflicting digests alone."""
    found = cut_lineage(digest_counts(df, schema.features, F.array_sort(F.collect_set(schema.label)).alias("labels"))
                        .where(F.size("labels") > 1))
    total = found.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    rows = with_facts(df.select(*schema.features, *row_digest(schema.features)), found, total, "inner")
    return (rows.groupBy("_d1", "_d2").agg(*[F.any_value(c).alias(c) for c in [*schema.features, "_n", "labels"]])
                .select(*schema.features, F.col("_n").alias("n_rows"), "labels", F.size("labels").alias("n_labels")))


def duplicates_by(df: DataFrame, schema: FlowSchema, by: str) -> DataFrame:
    """Rows in exact-duplicate groups (every copy counted) per ``by``.

    ``by`` is part of the row key, so this is a sum over the exact groups -
    no window and no join back to the rows."""
    return (exact_groups(df, schema).where(F.col("cnt") > 1)
            .groupBy(by).agg(F.sum("cnt").cast("bigint").alias("dup_rows")))


def _with_copies(df: DataFrame, keys) -> DataFrame:
    """``df`` with the digest of ``keys`` and ``_n``: how many rows have that key, NULL for one."""
    copied = cut_lineage(digest_counts(df, keys).where("_n > 1"))
    total = copied.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    return with_facts(df.select("*", *row_digest(keys)), copied, total)


def drop_all_copies(df: DataFrame, keys) -> DataFrame:
    """Keep only rows whose key occurs once (``keep=False``).

    Digests are counted; the rows are then filtered by the digests that occur
    more than once, without a shuffle of the rows while those are few."""
    return _with_copies(df, list(keys)).where("_n IS NULL").select(*df.columns)


def keep_first(df: DataFrame, keys, order_col: str) -> DataFrame:
    """C4: one row per key, the one with the smallest ``order_col`` (NULL last).

    Rows whose key no other row has pass as they are.  The others are reduced by
    ``min_by`` over a struct, an ordinary (partial + final) aggregate, so a hot
    key never gathers its rows in one task - unlike
    ``row_number() OVER (PARTITION BY key ...)``."""
    marked = _with_copies(df, list(keys))
    order = F.struct(F.col(order_col).isNull(), F.col(order_col))
    picked = marked.where("_n IS NOT NULL").groupBy("_d1", "_d2").agg(
        F.min_by(F.struct(*[F.col(c) for c in df.columns]), order).alias("_first"))
    return marked.where("_n IS NULL").select(*df.columns).unionByName(picked.select("_first.*"))
