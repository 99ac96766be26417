"""Driver contract smoke test and a quick oracle tier at sf0.001."""

import os
import sys

import pytest

from conftest import SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

QUICK = ["duplicate_audit", "conflicting_vectors", "label_columns", "missing_counts", "near_constant_columns",
         "quantiles", "pearson_pairs", "stratified_split", "grouped_split", "leakage_random", "undersample_targets",
         "confusion_matrix", "summary_metrics", "ranking_metrics", "threshold_sweep", "bootstrap_ci",
         "fn_analysis", "clean_audit", "clean_paper"]


def test_entry(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0]["total_rows"] > 0
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)


@pytest.mark.parametrize("name", QUICK)
def test_quick_oracle(spark, name):
    from check_oracle import compare, duck
    import __spark_entry__ as E
    msg = compare(spark, duck(SMALL), name, E.queries()[name], E.oracle_sql()[name], SMALL)
    assert ": OK" in msg, msg
