"""Missing-value semantics.

The flow tables come from pandas-style data with a single missing marker
(NaN).  Spark has NULL and NaN; here both count as missing, and +-Inf is a
separate, present value until :func:`inf_to_null` (C1) removes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

INF = float("inf")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_missing(c, fractional: bool = True) -> Column:
    """NULL or NaN."""
    c = _c(c)
    return (c.isNull() | F.isnan(c)) if fractional else c.isNull()


def row_digest(cols) -> list[Column]:
    """Two 64-bit digests (128 bits together) of the values of ``cols``.

    NULL equals NULL, NaN equals NaN and -0.0 equals 0.0, as in grouping.  The
    hash skips NULLs, so which columns are NULL is hashed besides.  Grouping
    on it moves 16 bytes per row in place of the whole vector; two different
    vectors among 1e11 share it with probability below 1e-16."""
    cols = list(cols)
    absent = [sum((F.when(F.col(c).isNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(cols[k:k + 60])),
                  F.lit(0).cast("bigint")) for k in range(0, len(cols), 60)]
    return [F.xxhash64(F.lit(seed), *cols, *absent).alias(f"_d{seed}") for seed in (1, 2)]


def nan_to_null(c) -> Column:
    c = _c(c)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def inf_to_null(c) -> Column:
    """+-Inf and NaN become NULL (the one missing marker)."""
    c = _c(c)
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(INF)), F.lit(None).cast("double")).otherwise(c.cast("double"))


def replace_infs(df: DataFrame, cols) -> DataFrame:
    """C1 over ``cols`` (one projection, no shuffle)."""
    return df.withColumns({c: inf_to_null(c) for c in cols})
