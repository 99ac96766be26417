"""Sinks and persisted splits.

Result tables are small (one row per model, threshold, class ...); they are
written as single CSV/JSON files.  Splits are large and are written as one
parquet dataset partitioned by ``split``, so reading one part prunes the
others at planning time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def write_split(df: DataFrame, path: str, split_col: str = "split") -> None:
    """One dataset, a folder per split value."""
    df.write.mode("overwrite").partitionBy(split_col).parquet(path)


def read_split(spark: SparkSession, path: str, part: str, balanced: bool = False,
               split_col: str = "split") -> DataFrame:
    """One part (``train``/``val``/``test``; ``train_balanced`` when
    ``balanced``) - partition pruning, only that folder is listed and read."""
    name = "train_balanced" if balanced and part == "train" else part
    return spark.read.parquet(path).where(F.col(split_col) == name)


def write_table(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Small result table as one CSV (with header) or JSON file."""
    w = df.coalesce(1).write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.parquet(path)


def read_table(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """S14."""
    if fmt == "csv":
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    if fmt == "json":
        return spark.read.json(path)
    return spark.read.parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint directory (never a machine-local temp dir)."""
    from ..session import ensure_checkpoint_dir
    import uuid
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/flowaudit-{name}-{uuid.uuid4().hex[:8]}"
