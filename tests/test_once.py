"""Experiments compute the rows they are given once, and the rank correlation bounds the values of a task."""

import numpy as np
import pandas as pd
import pytest

from flowaudit.operators import correlation as K
from flowaudit.operators import leakage as J
from flowaudit.plans import experiments as XP

SCHEMA = "row_id long, label string, day string, a double, b double"


def counted(spark, n=240):
    """Rows of two classes over five days, and the number of them computed so far."""
    seen = spark.sparkContext.accumulator(0)
    days = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday"]

    def rows(frames):
        for f in frames:
            seen.add(len(f))
            i = f["id"]
            yield pd.DataFrame({"row_id": i, "label": np.where(i % 3 == 0, "Bot", "BENIGN"), "day": [days[v % 5] for v in i],
                                "a": (i % 50).astype(float), "b": (i * 7 % 11 + 5 * (i % 3 == 0)).astype(float)})
    return spark.range(0, n, 1, 3).mapInPandas(rows, SCHEMA), seen


def test_leakage_by_strategy_computes_rows_once(spark):
    df, seen = counted(spark)
    out = J.leakage_by_strategy(df, ["random_original", "random_deduplicated", "grouped", "chronological"],
                                "label", "row_id", ["a", "b"]).collect()
    assert seen.value == 240 and [r["strategy"] for r in out][-1] == "chronological"
    assert all(0 <= r["n_leaked"] <= r["n_test"] for r in out) and out[0]["n_test"] > 0


def test_threshold_analysis_computes_rows_once(spark):
    df, seen = counted(spark)
    sweep, chosen = XP.threshold_analysis(df, ["a", "b"], "label", "row_id", maxIter=2, maxDepth=2)
    assert sweep.count() > 0 and chosen.count() > 0 and seen.value == 240


@pytest.mark.parametrize("most", [5, 10_000_000])
def test_rank_correlation_of_small_parts(spark, monkeypatch, most):
    monkeypatch.setattr(K, "PART_VALUES", most)
    df, _ = counted(spark)
    pdf = df.toPandas()
    parts, real = [], K.Correlation.corr
    monkeypatch.setattr(K.Correlation, "corr", lambda d, *a: parts.append(d.rdd.getNumPartitions()) or real(d, *a))
    r = K.spearman_matrix(df, ["a", "b"])
    assert abs(r[0, 1] - pdf[["a", "b"]].corr("spearman").iloc[0, 1]) < 1e-9
    assert max(parts) >= (480 // most)
