import os
import sys

import numpy as np
import pandas as pd
import pytest

from conftest import SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))


def test_pairwise(spark):
    """No row is complete, yet every pair shares rows."""
    from flowaudit.operators.correlation import spearman_matrix
    rng = np.random.default_rng(3)
    x = np.round(rng.standard_normal((120, 6)), 1) + np.arange(120)[:, None] / 60
    for i in range(120):
        x[i, i % 5] = np.nan                             # columns 0..4 by turns; 5 is complete
    x[:, 4] = np.where(np.isnan(x[:, 4]), np.nan, 7.0)   # constant where present
    x = np.column_stack([x, x[:, 0] ** 3, np.full(120, np.nan)])
    cols = [f"f{i}" for i in range(x.shape[1])]
    df = spark.createDataFrame([tuple(None if v != v and (i + j) % 2 else float(v) for j, v in enumerate(r))
                                for i, r in enumerate(x)], ", ".join(f"{c} double" for c in cols))
    want = pd.DataFrame(x, columns=cols).corr(method="spearman", min_periods=2).to_numpy()
    got = spearman_matrix(df, cols)
    off = ~np.eye(len(cols), dtype=bool)
    assert np.allclose(got[off], want[off], atol=1e-9, equal_nan=True)
    assert np.isfinite(got[0, 1])


@pytest.mark.parametrize("name", ["spearman_pairs", "spearman_pairs_dirty"])
def test_twins(spark, name):
    import __spark_entry__ as E
    from check_oracle import compare, duck
    msg = compare(spark, duck(SMALL), name, E.queries()[name], E.oracle_sql()[name], SMALL)
    assert ": OK" in msg, msg
