"""Stateless cleaning and column-drop decisions.

Decisions (which classes or columns to drop) are computed by one aggregate
and reach the driver as short lists bounded by the class or column count;
the drop itself is a projection or a literal ``isin`` filter that Catalyst
pushes into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.labels import MAX_CLASSES
from ..functions.missing import replace_infs
from . import correlation as K
from . import profile as A
from .duplicates import drop_all_copies, keep_first  # noqa: F401  (C3, C4)


def class_counts(df: DataFrame, label: str) -> dict:
    rows = df.groupBy(label).count().limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes in {label}")
    return {r[0]: r[1] for r in rows}


def valid_classes(df: DataFrame, label: str, min_count: int) -> list:
    return sorted(k for k, v in class_counts(df, label).items() if v >= min_count and k is not None)


def filter_rare_classes(df: DataFrame, label: str, min_count: int) -> DataFrame:
    """Keep rows of classes with at least ``min_count`` rows
    (P9's ``> 5`` is ``min_count=6``).  The semi-join to the valid classes is a
    literal ``isin`` filter - no join, pushed down to the scan."""
    return df.where(F.col(label).isin(valid_classes(df, label, min_count)))


def dropped_classes(df: DataFrame, label: str, min_count: int) -> DataFrame:
    """The classes removed by :func:`filter_rare_classes`."""
    counts = class_counts(df, label)
    gone = sorted(k for k, v in counts.items() if v < min_count and k is not None)
    field = df.schema[label]
    return df.sparkSession.createDataFrame([(g,) for g in gone], T.StructType([
        T.StructField(label, field.dataType, True)]))


def drop_missing_rows(df: DataFrame, cols=None) -> DataFrame:
    """Drop rows with any NULL or NaN (``na.drop`` treats NaN as missing)."""
    return df.na.drop("any", subset=list(cols) if cols else None)


def drop_inf_rows(df: DataFrame, cols) -> DataFrame:
    """C1 then C2 as in the paper pipeline: +-Inf -> missing -> row dropped."""
    return drop_missing_rows(replace_infs(df, cols), cols)


def fill_constant(df: DataFrame, cols, value: float = 0.0) -> DataFrame:
    """Constant imputation (NULL and NaN)."""
    return df.na.fill(value, subset=list(cols))


def low_std_columns(df: DataFrame, cols, threshold: float = 0.01) -> list[str]:
    """C7 decision: sample std < threshold (std undefined -> kept, like pandas)."""
    rows = A.std_columns(df, cols).collect()
    return [r["feature"] for r in rows if r["std"] is not None and r["std"] < threshold]


def constant_column_list(df: DataFrame, cols) -> list[str]:
    """C8/C9 decision: columns with at most one distinct non-missing value."""
    return [r["feature"] for r in A.constant_columns(df, cols).collect()]


def duplicate_column_list(df: DataFrame, cols) -> list[str]:
    """C10 decision: the later column of every identical pair."""
    cols = list(cols)
    pairs = K.duplicate_column_pairs(df, cols).collect()
    drop = []
    for r in pairs:
        later = r["feature_b"] if cols.index(r["feature_b"]) > cols.index(r["feature_a"]) else r["feature_a"]
        if later not in drop:
            drop.append(later)
    return [c for c in cols if c in drop]


def correlated_column_list(df: DataFrame, cols, threshold: float, policy: str) -> list[str]:
    """C11 (signed_earlier, 0.98), C12 (abs_later, 0.95), C13 (abs_earlier, 0.95)."""
    cols = list(cols)
    return K.correlated_to_drop(cols, K.pearson_matrix(df, cols), threshold, policy)


def drop_columns(df: DataFrame, cols) -> DataFrame:
    return df.drop(*cols)
