"""Registered queries: one Spark callable per operator, plus its SQL twin.

Each entry reads the given tables (directly or through the fixture views of
:mod:`flowaudit.sources.fixtures`) so its work grows with them.  Entries with
``sql=None`` have no relational definition (models, sampling with a random
component, iterative fits) and are checked by rows and by pytest properties.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _bigint_counts(sql: str) -> str:
    """DuckDB types ``count_if`` as HUGEINT; Spark's is BIGINT.  Wrap every
    ``count_if(...)`` of a SQL twin in ``CAST(... AS BIGINT)`` (lossless)."""
    out, i, key = [], 0, "count_if("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + len(key) - 1
        while k < len(sql):
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        out.append(sql[i:j])
        out.append("CAST(" + sql[j:k + 1] + " AS BIGINT)")
        i = k + 1


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = _bigint_counts(sql)
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from .plans import checks_profile, checks_split, checks_eval, checks_model  # noqa: F401
