"""Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs nothing that was staged."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/flowaudit-llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Whole groups, one at a time, of batches sorted by ``keys`` (memory: one group)."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        cols = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in cols)
        if last is not None and first != last:
            yield pa.Table.from_batches(held)
            held = []
        cuts = np.flatnonzero(change).tolist()
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            if a:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
        last = tuple(c[-1] for c in cols)
    if held:
        yield pa.Table.from_batches(held)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) of the nodes of ``edges`` (a long, b long).

    Alternates the large-star and small-star steps (Kiveris et al., 2014): each
    node's neighbours are linked to the smallest of them, until nothing
    changes; O(log n) rounds in practice.  A hub's edges stay
    separate rows; only its minimum is aggregated (map-side first) and joined
    back.  Every round is written to the shared folder.  Raises if it has not
    converged after ``max_rounds``.
    """
    pairs = lambda d: d.where("a != b").select(                    # noqa: E731
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    cur = stage(pairs(edges), "edges")
    size = None
    for _ in range(max_rounds):
        both = cur.unionAll(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = stage(both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                      .where("a != b").distinct(), "large")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
            F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
        cur = stage(pairs(small), "small")
        now = tuple(cur.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")),
                            F.count_distinct("a")).first())
        if now == size:
            break
        size = now
        if now[0] == now[2] and cur.join(cur.select(F.col("a").alias("b")), "b", "left_semi").isEmpty():
            break                                  # every node points straight at a root
    else:
        raise RuntimeError("components did not converge")
    roots = cur.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return cur.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots.distinct())


def ranked(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``df`` with ``rank`` (from 1, within ``group`` by ``order``, nulls first) and ``total`` (the group's rows).

    ``group`` has no nulls.  Equal rows are counted before they are ranked and
    spread out after, so none of them is moved twice; rows that tie in
    ``order`` follow their other columns.  Groups of any size are cut by range
    partitioning: a window holds the rows of one group in one range only, and
    the window over a group holds one row per range.
    """
    rest = [c for c in df.columns if c not in group + order]
    once = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    placed = stage(once.repartitionByRange(shuffle_width(df.sparkSession), *group, *order, *rest)
                   .withColumn("_part", F.spark_partition_id()), "ranges")
    parts = placed.groupBy(*group, "_part").agg(F.sum("_copies").alias("_n"))
    whole = Window.partitionBy(*group)
    parts = parts.select(*group, "_part", (F.sum("_n").over(whole.orderBy("_part")) - F.col("_n")).alias("_ahead"),
                         F.sum("_n").over(whole).alias("total"))
    inside = Window.partitionBy(*group, "_part").orderBy(*order, *rest) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.col("_ahead") + F.col("_last")
    return placed.withColumn("_last", F.sum("_copies").over(inside)).join(parts, [*group, "_part"]) \
        .withColumn("rank", F.explode(F.sequence(last - F.col("_copies") + 1, last))).select(*df.columns, "rank", "total")


def join_busy(rows: DataFrame, facts: DataFrame, keys: list[str], met: str, total: int, how: str = "inner") -> DataFrame:
    """``rows`` joined to ``facts`` (unique ``keys``, and ``met``: how many rows meet the fact), whatever the skew.

    Facts that more than a ten-thousandth of the ``total`` rows meet are
    broadcast; there are at most 10,000 of those.  The others meet by a plain
    join, where no key has more rows than that.  ``met`` is left out.
    """
    busy = max(1000, total // 10_000)
    hot = F.broadcast(facts.where(F.col(met) > busy).drop(met).withColumn("_hot", F.lit(True)))
    cold = facts.where(F.col(met) <= busy).drop(met)
    marked = rows.join(hot, keys, "left")
    new = [c for c in cold.columns if c not in keys]
    return marked.where("_hot").drop("_hot").unionByName(
        marked.where("_hot IS NULL").drop("_hot", *new).join(cold, keys, how))


def crc32_sql(values: str) -> str:
    """DuckDB CTEs (for WITH RECURSIVE): ``crcs`` (s, crc) of the texts ``s``, of one-byte characters, that ``values`` selects."""
    return f"""crc_bytes AS (
  SELECT s, 1 AS i, 4294967295::BIGINT AS c FROM ({values})
  UNION ALL
  SELECT s, i + 1, list_reduce(list_prepend(xor(c, ascii(substr(s, i, 1))::BIGINT), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
         lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END)
  FROM crc_bytes WHERE i <= length(s)),
crcs AS MATERIALIZED (SELECT s, 4294967295 - c AS crc FROM crc_bytes WHERE i = length(s) + 1)"""
