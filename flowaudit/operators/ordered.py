"""Ordered primitives that stay distributed: prefix sums and hash ranks.

A window ``OVER (PARTITION BY g ORDER BY o)`` sends every row of a group to
one task; without ``PARTITION BY`` it sends the whole table to one task.
Both break when one class holds a third of all rows.  Here every row gets a
deterministic *bucket*, monotone in the order key within its group, sized so
that a bucket holds at most ~``bucket_rows`` rows:

1. per (group, bucket) totals - a small aggregate;
2. exclusive offsets of each bucket (a window over that small table);
3. running sums inside each bucket with an ordinary window partitioned by
   (group, bucket), plus the bucket's offset (join on the same keys, so the
   large side keeps its partitioning).

Buckets come from the data, not from partition ids, so every re-execution
(e.g. after a lost executor) assigns the same bucket to the same row.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.labels import MAX_CLASSES

_B = "_fa_bucket"
#: Quantile splits found by a sketch and sent with the plan, whatever the number of rows.
MAX_SPLITS = 1024


def bucket_rows(spark) -> int:
    return int(spark.conf.get("spark.flowaudit.bucketRows", "1000000"))


def n_buckets(spark, n: int, target: int | None = None) -> int:
    """Buckets for ``n`` rows: at most ``target`` rows each, and enough buckets
    to keep every core busy (2 x default parallelism) once buckets would still
    hold at least ``spark.flowaudit.minBucketRows`` rows."""
    target = target or bucket_rows(spark)
    min_rows = int(spark.conf.get("spark.flowaudit.minBucketRows", "10000"))
    par = 2 * spark.sparkContext.defaultParallelism
    return max(1, math.ceil(n / target), min(par, n // max(1, min_rows)))


def _group_counts(df: DataFrame, group_cols) -> dict:
    if not group_cols:
        return {(): df.count()}
    rows = df.groupBy(*group_cols).count().limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError("too many groups for bucketed prefix sums")
    return {tuple(r[g] for g in group_cols): r["count"] for r in rows}


def with_value_bucket(df: DataFrame, order_col: str, descending: bool = False,
                      target: int | None = None) -> DataFrame:
    """Add the bucket column (B = rows / target, at least one): at most
    ``MAX_SPLITS`` approximate-quantile splits of ``order_col``, found by a
    sketch of fixed size and applied with ``Bucketizer`` (a binary search on
    the JVM); beyond that each bucket is cut into equal steps of its range.  NULLs go first, NaN last; negated when descending."""
    target = target or bucket_rows(df.sparkSession)
    x = F.col(order_col).cast("double")
    n = df.count()
    nb = n_buckets(df.sparkSession, n, target)
    if nb == 1:
        out = df.withColumn(_B, F.when(x.isNull(), F.lit(-1)).when(F.isnan(x), F.lit(1)).otherwise(F.lit(0)))
    else:
        coarse = min(nb, MAX_SPLITS)
        probs = [i / coarse for i in range(1, coarse)]
        fin = F.when(F.abs(x) < float("inf"), x)
        qs, lo, hi = df.select(F.percentile_approx(x, probs, 10 * MAX_SPLITS + 10000), F.min(fin), F.max(fin)).first()
        splits = sorted({float(q) for q in qs or () if q is not None and not math.isnan(q)} - {float("inf"), float("-inf")})
        bz = Bucketizer(splits=[float("-inf"), *splits, float("inf")], inputCol="_fa_x", outputCol="_fa_bz",
                        handleInvalid="keep")
        out = bz.transform(df.withColumn("_fa_x", F.coalesce(x, F.lit(float("nan")))))
        fine = math.ceil(nb / coarse)
        place = F.col("_fa_bz").cast("int")
        if fine > 1 and lo is not None:
            # equal steps between the edges of a coarse bucket: monotone, so the order is kept
            edges = F.array(*[F.lit(v) for v in [float(lo), *splits, float(hi)]])
            a, b = F.element_at(edges, place + 1), F.element_at(edges, place + 2)
            step = F.floor((F.col("_fa_x") - a) / F.nullif(b - a, F.lit(0.0)) * fine).cast("bigint")
            inner = F.greatest(F.lit(0), F.least(F.coalesce(step, F.lit(0)), F.lit(fine - 1))).cast("int")
            inside = (place <= len(splits)) & (F.abs("_fa_x") < float("inf"))
            inner = F.when(inside, inner).when(F.col("_fa_x") > 0, fine - 1).otherwise(0)
            place = place * fine + inner
        out = out.withColumn(_B, F.when(x.isNull(), F.lit(-1)).otherwise(place)).drop("_fa_x", "_fa_bz")
    return out.withColumn(_B, -F.col(_B)) if descending else out


def prefix_sums(df: DataFrame, order_col: str, sum_cols, group_cols=(), bucket: Column | None = None,
                descending: bool = False, prefix: str = "cum_", tiebreak=()) -> DataFrame:
    """Add inclusive running sums ``prefix + c`` of ``sum_cols`` within
    ``group_cols`` ordered by ``order_col``.

    ``bucket`` must be non-decreasing in the order (non-increasing when
    ``descending``) within each group; by default it is derived from value
    quantiles.  Rows tied on (group, order) get an arbitrary order, so callers
    that need tie-aware totals aggregate ties first."""
    group_cols, sum_cols = list(group_cols), list(sum_cols)
    d = with_value_bucket(df, order_col, descending) if bucket is None else df.withColumn(_B, bucket)
    keys = group_cols + [_B]
    totals = d.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sum_cols])
    w_off = Window.partitionBy(*group_cols).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, *[F.coalesce(F.sum(c).over(w_off), F.lit(0)).alias(f"_off_{c}")
                                     for c in sum_cols])
    o = F.col(order_col).desc_nulls_last() if descending else F.col(order_col).asc_nulls_first()
    w_in = Window.partitionBy(*keys).orderBy(o, *[F.col(t) for t in tiebreak]).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = d.withColumns({f"_loc_{c}": F.sum(c).over(w_in) for c in sum_cols})
    cond = [local[k].eqNullSafe(offsets[k]) for k in keys]
    j = local.join(offsets, cond, "left")
    return j.select(*[local[c] for c in df.columns],
                    *[(local[f"_loc_{c}"] + F.coalesce(offsets[f"_off_{c}"], F.lit(0))).alias(prefix + c)
                      for c in sum_cols])


def hash_key(key: Column | str, seed: int) -> Column:
    """Deterministic sort key: md5 of '<seed>-<integer key>'.

    md5 of a string is identical in Spark and DuckDB, so the SQL twin is
    ``ORDER BY md5(concat(seed, '-', key))``.  Keys must be integers: doubles
    print differently in the two engines."""
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}-"), k.cast("bigint").cast("string")))


def hash_unit(key: Column | str, seed, salt: Column | None = None) -> Column:
    """Uniform number in [0, 1) from the first 13 hex digits of an md5 key;
    monotone in the md5 string.

    SQL twin: ``CAST(('0x' || substr(md5(...), 1, 13)) AS BIGINT) / 4503599627370496``."""
    k = F.col(key) if isinstance(key, str) else key
    parts = [F.lit(f"{seed}-"), k.cast("bigint").cast("string")]
    if salt is not None:
        parts += [F.lit("-"), salt.cast("bigint").cast("string")]
    h = F.md5(F.concat(*parts))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("bigint").cast("double") / float(16 ** 13)


def hash_rank(df: DataFrame, group_cols, key: str, seed: int, out: str = "rank",
              counts: dict | None = None) -> DataFrame:
    """``row_number() OVER (PARTITION BY group ORDER BY md5(seed-key))`` with
    hash buckets: ``floor(u * B_g)`` is monotone in the md5 order and uniform,
    so each bucket holds about ``bucket_rows`` rows of its group."""
    group_cols = list(group_cols)
    counts = counts if counts is not None else _group_counts(df, group_cols)
    total = max(1, sum(counts.values()))
    nb_total = n_buckets(df.sparkSession, total)
    nb = {k: max(1, math.ceil(nb_total * v / total)) for k, v in counts.items()}
    u = hash_unit(key, seed)
    if not group_cols:
        b = F.floor(u * F.lit(nb[()])).cast("int")
    elif len(group_cols) == 1:
        m = F.create_map(*[x for k, v in nb.items() for x in (F.lit(k[0]), F.lit(v))])
        b = F.floor(u * F.coalesce(m[F.col(group_cols[0])], F.lit(1))).cast("int")
    else:
        b = F.lit(0)
        for k, v in nb.items():
            cond = None
            for g, val in zip(group_cols, k):
                c = F.col(g).eqNullSafe(F.lit(val))
                cond = c if cond is None else cond & c
            b = F.when(cond, F.floor(u * F.lit(v)).cast("int")).otherwise(b)
    tmp = df.withColumn("_fa_h", hash_key(key, seed)).withColumn("_fa_one", F.lit(1))
    ranked = prefix_sums(tmp, "_fa_h", ["_fa_one"], group_cols=group_cols, bucket=b, prefix="_fa_cum")
    return ranked.withColumnRenamed("_fa_cum_fa_one", out).drop("_fa_h", "_fa_one")


#: Hex digits of the hash that the first pass of :func:`hash_cuts` tells apart, and that later ones do at most.
CUT_DIGITS = (2, 3)
#: A range of hashes with at most this many rows is ranked whole by one task.
CUT_ROWS = 4096


def _by_group(values: dict, group: Column) -> Column:
    """The value of the row's group (NULL if it has none); ``values`` may have one for the group NULL."""
    known = [x for g, v in values.items() if g is not None for x in (F.lit(g), F.lit(v))]
    found = F.create_map(*known)[group] if known else F.lit(None)
    return F.when(group.isNull(), F.lit(values[None])).otherwise(found) if None in values else found


def hash_cuts(df: DataFrame, key: str, seed: int, ranks: dict, group: str | None = None) -> dict:
    """``{value: [md5, ...]}``: the hash keys of the rows with the given ranks in the
    order of :func:`hash_key`, within each value of ``group`` (``ranks``: ``{value:
    [rank, ...]}``; with ``group=None`` the one value is None).

    A row is among the first ``rank`` of its group if and only if its hash is at
    most that key, so a split by rank is a projection: no row is shuffled or
    sorted.  Each pass counts the hashes by their next digits inside the range
    that holds the rank (partial counts, at most 4,096 a range); ranges of at
    most ``CUT_ROWS`` rows are ranked.  The driver gets one row per cut and
    pass.  Ranks below 1 give ``""`` (no row), ranks beyond the group ``"g"``
    (all).  Rows that share a key share a hash: all of them are on one side."""
    base = df.select((F.col(group) if group else F.lit(None).cast("int")).alias("_g"), hash_key(key, seed).alias("_h"))
    out = {g: ["" if r < 1 else "g" for r in rs] for g, rs in ranks.items()}
    open_ = [(g, "", int(r), i) for g, rs in ranks.items() for i, r in enumerate(rs) if r >= 1]
    small: list = []
    digits = CUT_DIGITS[0]

    def slots(cuts, at):
        """Field ``at`` of the first, second, ... cut of the row's group."""
        per: dict = {}
        for c in cuts:
            per.setdefault(c[0], []).append(c[at])
        return [_by_group({g: v[j] for g, v in per.items() if len(v) > j}, F.col("_g"))
                for j in range(max(map(len, per.values())))]

    def rows_in(cuts):
        """The rows in the ranges of ``cuts``, with their range ``_p``."""
        held = [F.when(F.col("_h").startswith(p), p) for p in slots(cuts, 1)]
        return base.withColumn("_p", F.coalesce(*held)).where("_p IS NOT NULL")

    def at_ranks(places, cuts, order):
        """(group, place, rank left in it, number of the cut, rows) of the places that hold the wanted ranks."""
        running = Window.partitionBy("_g", "_p").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ahead = F.col("_c") - F.col("_n")
        hits = [F.when((F.col("_p") == p) & (F.col("_c") >= r) & (ahead < r), F.struct((r - ahead).alias("r"), i.alias("i")))
                for p, r, i in zip(slots(cuts, 1), [r.cast("bigint") for r in slots(cuts, 2)], slots(cuts, 3))]
        return places.withColumn("_c", F.sum("_n").over(running)).withColumn("_w", F.explode(F.array(*hits))) \
            .where("_w IS NOT NULL").select("_g", order, "_w.r", "_w.i", "_n").collect()

    while open_:
        length = len(open_[0][1]) + digits
        counted = rows_in(open_).groupBy("_g", "_p", F.substring("_h", 1, length).alias("_q")).agg(F.count("*").alias("_n"))
        found = at_ranks(counted, open_, "_q")
        open_ = []
        for g, q, r, i, n in found:
            if r == n or length >= 32:
                out[g][i] = q + "f" * (32 - len(q))
            else:
                (small if n <= CUT_ROWS else open_).append((g, q, r, i))
        most = max((row[4] for row in found), default=1)
        digits = min(CUT_DIGITS[1], max(1, math.ceil(math.log(max(1.0, most / CUT_ROWS), 16))))
    if small:
        for g, h, _, i, _ in at_ranks(rows_in(small).withColumn("_n", F.lit(1)), small, "_h"):
            out[g][i] = h
    return out


def within_cut(key: str, seed: int, cuts: dict, i: int = 0, group: str | None = None) -> Column:
    """True for the rows at or before cut ``i`` of their group (:func:`hash_cuts`); False for groups without cuts."""
    cut = F.lit(cuts[None][i]) if group is None else _by_group({g: cs[i] for g, cs in cuts.items()}, F.col(group))
    return hash_key(key, seed) <= F.coalesce(cut, F.lit(""))
