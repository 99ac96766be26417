"""Resamples drawn by confusion cells."""

import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from flowaudit.operators import metrics as E


def _brute_quantile(m, p, u):
    acc = 0.0
    for k in range(m + 1):
        acc += math.comb(m, k) * p ** k * (1 - p) ** (m - k)
        if acc >= u:
            return k
    return m


def test_binomial_quantile_equals_the_summed_probabilities():
    rng = np.random.default_rng(3)
    for m in (1, 2, 7, 40, 150):
        for p in (0.001, 0.2, 0.5, 0.93, 0.9999):
            for u in rng.random(20):
                assert E.binomial_quantile(m, p, float(u)) == _brute_quantile(m, p, float(u))
    assert E.binomial_quantile(0, 0.4, 0.9) == 0 and E.binomial_quantile(9, 1.0, 0.1) == 9
    assert E.binomial_quantile(9, 0.0, 0.9) == 0 and E.binomial_quantile(5, 0.5, 0.0) == 0


def test_binomial_quantile_of_very_many_rows():
    m, p = 10 ** 11, 0.37
    sd = math.sqrt(m * p * (1 - p))
    mid, far = E.binomial_quantile(m, p, 0.5), E.binomial_quantile(m, p, 0.8413447460685429)
    assert abs(mid - m * p) <= 2 and abs((far - mid) / sd - 1) < 1e-4


def test_resamples_hold_exactly_n_rows_and_follow_the_cells(spark):
    cells = {("a", "a"): 500, ("a", "b"): 40, ("b", "b"): 60, (None, "a"): 3, ("b", None): 1}
    rows = [k for k, n in cells.items() for _ in range(n)]
    df = spark.createDataFrame(rows, "y string, p string").repartition(5)
    got = E.resampled_cells(df, "y", "p", 400, 7).collect()
    n = len(rows)
    totals, means = Counter(), Counter()
    for r in got:
        totals[r.iter] += r.cnt
        means[(r.y_true, r.y_pred)] += r.cnt / 400
    assert set(totals) == set(range(400)) and set(totals.values()) == {n}
    assert set(means) == set(cells)
    for k, c in cells.items():
        assert abs(means[k] - c) < 5 * math.sqrt(c * (1 - c / n) / 400)
    # covariance of a multinomial: -n p q
    by = {k: {r.iter: r.cnt for r in got if (r.y_true, r.y_pred) == k} for k in list(cells)[:2]}
    x, y = ([by[k].get(i, 0) for i in range(400)] for k in by)
    assert abs(np.cov(x, y)[0, 1] / (-500 * 40 / n) - 1) < 0.5
    again = E.resampled_cells(df.repartition(2), "y", "p", 400, 7).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_bootstrap_of_one_cell_and_of_no_rows(spark):
    one = spark.createDataFrame([("a", "a")] * 9, "y string, p string")
    assert {tuple(r) for r in E.resampled_cells(one, "y", "p", 3).collect()} == {(i, "a", "a", 9) for i in range(3)}
    none = one.where(F.lit(False))
    assert E.bootstrap_metrics(none, "y", "p", 3).collect() == []
