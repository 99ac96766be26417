"""The EDA findings on a table whose answers can be read off."""

from flowaudit.plans.audit import run_eda
from flowaudit.schema import FlowSchema


def test_findings_of_a_small_table(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(float(i), float(i), 1.0, 0.0 if i else 7.0, inf if i == 3 else None if i == 4 else nan if i == 5 else 2.0 * i,
             "BENIGN" if i % 4 else "Bot", "Monday") for i in range(200)]
    rows.append(rows[10])
    df = spark.createDataFrame(rows, "a double, twin double, one double, rare double, gaps double, label string, day string")
    got = run_eda(df, FlowSchema(("a", "twin", "one", "rare", "gaps"), row_id=None))
    assert set(got) == {"shape", "missing_values", "infinite_values", "constant_features", "near_constant_features",
                        "duplicate_rows", "class_distribution", "duplicate_columns"}
    assert got["shape"].first()["n_rows"] == 201
    assert [(r.feature, r.n_missing) for r in got["missing_values"].collect()] == [("gaps", 2)]
    assert [(r.feature, r.n_inf) for r in got["infinite_values"].collect()] == [("gaps", 1)]
    assert [r.feature for r in got["constant_features"].collect()] == ["one"]
    assert {r.feature for r in got["near_constant_features"].collect()} >= {"rare"}
    assert got["duplicate_rows"].first()["exact_duplicates"] == 1
    counts = {r["label"]: r for r in got["class_distribution"].collect()}
    assert set(counts) == {"BENIGN", "Bot"} and counts["Bot"].cnt == 50 and counts["BENIGN"].cnt == 151
    assert [(r.feature_a, r.feature_b) for r in got["duplicate_columns"].collect()] == [("a", "twin")]
