"""Quantiles by brackets (A16) and most frequent values by counters (A9) against plain counting."""

import numpy as np
import pandas as pd
import pytest

from flowaudit.operators import profile as A


def frame(spark, n=6000):
    rng = np.random.default_rng(3)
    v = np.round(rng.normal(size=n), 3)
    tied = rng.choice([0.0, 1.0, 7.5, np.inf, -np.inf], n, p=[0.5, 0.2, 0.28, 0.01, 0.01])
    some = np.where(rng.random(n) < 0.3, np.nan, rng.exponential(size=n))
    return pd.DataFrame({"v": v, "tied": tied, "some": some, "none": np.full(n, np.nan), "one": np.ones(n)})


@pytest.mark.parametrize("slices", [1, 7])
def test_quantiles_of_bracketed_values(spark, slices):
    pdf = frame(spark)
    df = spark.createDataFrame(pdf).repartition(slices)
    probs = [0.0, 0.001, 0.25, 0.5, 0.9, 0.999, 1.0]
    # 700 sketch points for 6,000 rows: the brackets leave most values out
    got = {(r["feature"], r["p"]): r["q"] for r in A.quantiles(df, list(pdf), probs, accuracy=1).collect()}
    assert not any(f == "none" for f, _ in got) and len(got) == 4 * len(probs)
    for c in ("v", "some", "one", "tied"):
        x = pdf[c].dropna().to_numpy()
        for p in probs:
            want = np.quantile(x, p)
            assert got[c, p] == pytest.approx(want, abs=1e-12) or (np.isnan(want) and np.isnan(got[c, p])), (c, p)


def test_few_values_are_kept():
    x = np.arange(100_000.0)
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array(np.append(x, np.nan))], ["x0"])
    lo, hi = A._merged([(10.0, 20.0), (15.0, 30.0), (500.0, 500.0)])
    assert lo.tolist() == [10.0, 500.0] and hi.tolist() == [30.0, 500.0]
    rows = [r for b in A._bracketed([(lo, hi)])([batch]) for r in b.to_pylist()]
    assert sum(r["value"] is not None for r in rows) == 22
    assert [r["cnt"] for r in rows if r["value"] is None] == [10, 21, 469, 1, 99_499]


def test_a_missed_rank_widens_its_bracket(spark, monkeypatch):
    pdf = frame(spark, 3000)[["v"]]
    merged, seen = A._merged, []

    def wrong(pairs):
        seen.append(1)
        return merged([(a, a) for a, _ in pairs]) if len(seen) == 1 else merged(pairs)
    monkeypatch.setattr(A, "_merged", wrong)
    got = A.quantiles(spark.createDataFrame(pdf), ["v"], [0.31, 0.77], accuracy=1).collect()
    assert len(seen) == 2 and {r["p"]: r["q"] for r in got} == {p: pytest.approx(np.quantile(pdf.v, p)) for p in (0.31, 0.77)}


@pytest.mark.parametrize("share", [0.05, 0.19, 0.49, 0.9])
def test_most_frequent_value_of_any_share(spark, share):
    rng = np.random.default_rng(11)
    n = 4000
    pdf = pd.DataFrame({
        "flat": rng.permutation(n).astype(float), "fifth": np.where(rng.random(n) < 0.2, 3.25, rng.normal(size=n)),
        "many": rng.integers(0, 12, n).astype(float), "half": np.where(np.arange(n) % 2 == 0, -1.0, rng.normal(size=n)),
        "gone": np.where(rng.random(n) < 0.95, np.nan, rng.integers(0, 2, n)), "one": np.ones(n), "none": np.full(n, np.nan)})
    got = {r["feature"]: r["top_share"] for r in A.near_constant_columns(
        spark.createDataFrame(pdf.sort_values("many")).coalesce(5), list(pdf), share).collect()}
    want = {c: pdf[c].value_counts(normalize=True).iloc[0] for c in pdf if pdf[c].nunique() > 1}
    assert got == {c: pytest.approx(s) for c, s in want.items() if s > share}
