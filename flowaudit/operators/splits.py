"""Deterministic splits and samples.

Row order is ``md5('<seed>-<row id>')`` - identical in Spark and DuckDB, so
every split has an exact SQL twin (``row_number() OVER (PARTITION BY class
ORDER BY md5(...))``).  A split by rank needs only the hash at each quota's
rank (:func:`ordered.hash_cuts`): the rows themselves are neither shuffled nor
sorted, they are told apart by one projection.  Per-class quotas come from the
class counts (bounded by the class count, computed on the driver by largest
remainder).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from ..functions.missing import row_digest
from ..functions.labels import MAX_CLASSES
from ..session import cut_lineage
from .digests import digest_counts, with_facts
from .ordered import hash_cuts, hash_key, hash_rank, within_cut


def _counts(df: DataFrame, label: str) -> dict:
    rows = df.groupBy(label).count().limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError("too many classes")
    return {r[0]: r[1] for r in rows}


def largest_remainder(counts: dict, frac: float, total: int | None = None) -> dict:
    """Per-class quotas summing to ``ceil(frac * n)`` (or ``total``): floor
    shares first, the rest by largest fractional part (ties: class name asc)."""
    n = sum(counts.values())
    want = math.ceil(frac * n - 1e-9) if total is None else total
    exact = {k: frac * v for k, v in counts.items()}
    q = {k: min(counts[k], math.floor(e + 1e-9)) for k, e in exact.items()}
    rest = want - sum(q.values())
    order = sorted(counts, key=lambda k: (-(exact[k] - math.floor(exact[k] + 1e-9)), str(k)))
    i = 0
    while rest > 0 and order:
        k = order[i % len(order)]
        if q[k] < counts[k]:
            q[k] += 1
            rest -= 1
        i += 1
        if i > 10 * len(order) + want:
            break
    return q


def stratified_split(df: DataFrame, label: str, key: str, test_size: float, seed: int = 42,
                     names=("train", "test"), out: str = "split") -> DataFrame:
    """``test_size`` of every class (largest-remainder quotas) goes to
    ``names[1]``, chosen by hash rank within the class."""
    q = largest_remainder(_counts(df, label), test_size)
    cuts = hash_cuts(df, key, seed, {k: [v] for k, v in q.items()}, label)
    return df.withColumn(out, F.when(within_cut(key, seed, cuts, 0, label), names[1]).otherwise(names[0]))


def stratified_sample(df: DataFrame, label: str, key: str, frac: float, seed: int = 42) -> DataFrame:
    """The stratified ``frac`` sample (the test side of T2)."""
    return stratified_split(df, label, key, frac, seed).where(F.col("split") == "test").drop("split")


def three_way_split(df: DataFrame, label: str, key: str, test_size: float = 0.2,
                    val_size: float = 0.2, seed: int = 42, out: str = "split",
                    counts: dict | None = None) -> DataFrame:
    """Stratified test, then stratified val from the rest with
    ``val_size / (1 - test_size)``; one pass finds both cuts."""
    counts = counts if counts is not None else _counts(df, label)
    qt = largest_remainder(counts, test_size)
    rest = {k: counts[k] - qt[k] for k in counts}
    qv = largest_remainder(rest, val_size / (1.0 - test_size))
    cuts = hash_cuts(df, key, seed, {k: [qt[k], qt[k] + qv[k]] for k in counts}, label)
    return df.withColumn(out, F.when(within_cut(key, seed, cuts, 0, label), "test")
                         .when(within_cut(key, seed, cuts, 1, label), "val").otherwise("train"))


def paper_split(df: DataFrame, label: str, key: str, train_size: float = 0.6,
                val_size: float = 0.2, test_size: float = 0.2, seed: int = 42,
                out: str = "split") -> DataFrame:
    """T4: stratified train / rest, then an unstratified cut of the rest:
    ``ceil(test/(val+test) * n_rest)`` rows become val, the others test."""
    counts = _counts(df, label)
    q_rest = largest_remainder(counts, val_size + test_size)
    in_rest = within_cut(key, seed, hash_cuts(df, key, seed, {k: [v] for k, v in q_rest.items()}, label), 0, label)
    n_rest = sum(q_rest.values())
    n_val = math.ceil(test_size / (val_size + test_size) * n_rest - 1e-9)
    cuts = hash_cuts(df.where(in_rest), key, seed, {None: [n_val]})
    return df.withColumn(out, F.when(~in_rest, "train").when(within_cut(key, seed, cuts), "val").otherwise("test"))


def grouped_split(df: DataFrame, features, key: str, test_size: float = 0.2,
                  val_size: float = 0.2, seed: int = 42, out: str = "split") -> DataFrame:
    """Identical feature vectors stay together.  A group is identified by
    its smallest row id; ``ceil(test_size * groups)`` groups go to test, then
    ``ceil(val/(1-test) * rest)`` of the rest to val.  Only rows whose vector
    others share look their group up (:func:`digests.with_facts`); a vector of
    one row is its own group."""
    groups = cut_lineage(digest_counts(df, features, F.min(key).alias("_gid")))
    n_groups, total = groups.agg(F.count("*"), F.coalesce(F.sum("_n"), F.lit(0))).first()
    n_test = math.ceil(test_size * n_groups - 1e-9)
    n_val = math.ceil(val_size / (1.0 - test_size) * (n_groups - n_test) - 1e-9)
    cuts = hash_cuts(groups, "_gid", seed, {None: [n_test, n_test + n_val]})
    rows = with_facts(df.select("*", *row_digest(features)), groups.where("_n > 1"), total) \
        .withColumn("_gid", F.coalesce("_gid", F.col(key)))
    return rows.withColumn(out, F.when(within_cut("_gid", seed, cuts), "test")
                           .when(within_cut("_gid", seed, cuts, 1), "val").otherwise("train")).select(*df.columns, out)


def chronological_split(df: DataFrame, day: str | None, out: str = "split") -> DataFrame:
    """Mon-Wed train, Thu val, Fri test; no day column means 'Monday'.
    A row of any other day (or none) fails the job: it belongs to no part."""
    d = F.col(day) if day and day in df.columns else F.lit("Monday")
    return df.withColumn(out, F.when(d.isin("Monday", "Tuesday", "Wednesday"), "train")
                         .when(d == "Thursday", "val").when(d == "Friday", "test")
                         .otherwise(F.raise_error(F.concat(F.lit("no split for day "), F.coalesce(d, F.lit("NULL"))))))


def split(df: DataFrame, strategy: str, label: str, key: str, features=None, day: str | None = "day",
          test_size: float = 0.2, val_size: float = 0.2, seed: int = 42,
          min_class_count: int = 3) -> DataFrame:
    """One entry point for the four strategies; adds a ``split`` column.

    ``random_original``/``random_deduplicated`` drop classes below
    ``min_class_count`` first (they cannot be stratified)."""
    from .duplicates import keep_first
    if strategy == "chronological":
        return chronological_split(df, day)
    if strategy == "grouped":
        return grouped_split(df, features, key, test_size, val_size, seed)
    if strategy == "random_deduplicated":
        df = keep_first(df, features, key)
    elif strategy != "random_original":
        raise ValueError(f"unknown split strategy {strategy}")
    counts = {k: v for k, v in _counts(df, label).items() if v >= min_class_count and k is not None}
    df = df.where(F.col(label).isin(sorted(counts)))
    return three_way_split(df, label, key, test_size, val_size, seed, counts=counts)


def kfold(df: DataFrame, label: str, key: str, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """Stratified folds ``(rank - 1) % k`` of the within-class hash rank."""
    r = hash_rank(df, [label], key, seed, out="_rank")
    return r.withColumn(out, ((F.col("_rank") - 1) % k).cast("int")).drop("_rank")


def sample_without_replacement(df: DataFrame, key: str, n: int = 1000, seed: int = 42) -> DataFrame:
    """The ``n`` rows first in hash order (top-k per task, then merged)."""
    return df.orderBy(hash_key(key, seed), F.col(key)).limit(n)


def split_proportions(df: DataFrame, label: str, split_col: str = "split") -> DataFrame:
    """Class share per split next to the overall share, and the gap."""
    from pyspark.sql import Window
    g = df.groupBy(split_col, label).agg(F.count(F.lit(1)).alias("cnt"))
    w_split = Window.partitionBy(split_col)
    w_class = Window.partitionBy(label)
    return (g.withColumn("share", F.col("cnt") / F.sum("cnt").over(w_split))
             .withColumn("overall_share", F.sum("cnt").over(w_class) / F.sum("cnt").over(Window.partitionBy()))
             .withColumn("gap", F.abs(F.col("share") - F.col("overall_share"))))


def resample_with_replacement(df: DataFrame, key: str, n: int | None = None, seed: int = 0,
                              copy_col: str = "copy") -> DataFrame:
    """``n`` draws with replacement (default n = rows); draw i picks row
    position ``floor(u_i * N) + 1`` in hash order.  Draws are counted per
    position before the join, so a row drawn many times is one join key."""
    from .ordered import hash_unit
    total = df.count()
    n = n or total
    spark = df.sparkSession
    draws = spark.range(n).select((F.floor(hash_unit("id", seed) * total) + 1).cast("bigint").alias("_pos"))
    mult = draws.groupBy("_pos").agg(F.count(F.lit(1)).alias("_mult"))
    ranked = hash_rank(df, [], key, seed, out="_pos", counts={(): total})
    return (ranked.join(mult, "_pos").withColumn(copy_col, F.explode(F.sequence(F.lit(1), F.col("_mult").cast("int"))))
                  .drop("_pos", "_mult"))


def scaling_check(df: DataFrame, cols, by=()) -> DataFrame:
    """T13 (second half): mean of the column means and mean of the column
    (sample) stds - ~0 and ~1 after z-scoring on the same rows."""
    from .profile import wide_stats
    w = wide_stats(df, list(cols), {"mean": lambda c: F.avg(c), "std": lambda c: F.stddev_samp(c)})
    return w.agg(F.avg("mean").alias("mean_of_means"), F.avg("std").alias("mean_of_stds"))
