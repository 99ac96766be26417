"""C17: chain and classifier as one persisted pipeline, loaded by another process."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.ml import PipelineModel

from flowaudit.operators import models as M
from flowaudit.operators.fitted import FlowChain, kept_columns
from flowaudit.plans import experiments as XP

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
DDL = "id long, u double, v double, k double, label string"


def _rows():
    rows = [(i, float(i % 17), float("inf") if i % 23 == 0 else None if i % 11 == 0 else float(i % 3) * 5, 0.5, "abc"[i % 3])
            for i in range(240)]
    return rows + [(999, float("nan"), 5.0, 0.5, "b")]


@pytest.mark.parametrize("kind,params", [("gbt_ovr", {"maxIter": 4, "maxDepth": 3}), ("forest", {"numTrees": 3, "maxDepth": 4}),
                                         ("mlp", {"hidden": [6], "maxIter": 3}), ("logreg", {"maxIter": 10})])
def test_saved_pipeline_scores_raw_rows_like_its_parts(spark, tmp_path, kind, params):
    df = spark.createDataFrame(_rows(), DDL)
    whole = XP.fit_deployable(df, ["u", "v", "k"], "label", kind, **params)
    whole.write().overwrite().save(str(tmp_path / "m"))
    back = PipelineModel.load(str(tmp_path / "m"))
    chain = FlowChain(inputCols=["u", "v", "k"]).fit(df)
    assert kept_columns(chain) == ["u", "v"]
    parts = M.fit(chain.transform(df), ["u", "v"], "label", kind, **params)
    want = {r.id: (r.y_true, r.y_pred, r.probs) for r in parts.score(chain.transform(df), keep=["id"]).collect()}
    assert {r.id: (r.y_true, r.y_pred, r.probs) for r in back.transform(df).collect()} == want
    bare = back.transform(df.drop("label"))
    assert "y_true" not in bare.columns and {r.id: r.y_pred for r in bare.collect()} == {i: w[1] for i, w in want.items()}


def test_another_process_loads_it(spark, tmp_path):
    df = spark.createDataFrame(_rows(), DDL)
    whole = XP.fit_deployable(df, ["u", "v", "k"], "label", "gbt_ovr", maxIter=3, maxDepth=3)
    whole.write().overwrite().save(str(tmp_path / "m"))
    df.write.parquet(str(tmp_path / "d"))
    code = ("import sys, json\n"
            f"sys.path.insert(0, {ROOT!r})\n"
            "from flowaudit.session import get_spark\n"
            "from pyspark.ml import PipelineModel\n"
            "s = get_spark('local[2]', extra_conf={'spark.checkpoint.dir': sys.argv[1] + '/c'})\n"
            "out = PipelineModel.load(sys.argv[1] + '/m').transform(s.read.parquet(sys.argv[1] + '/d'))\n"
            "print('RESULT' + json.dumps({r.id: r.y_pred for r in out.collect()}))\n")
    env = {**os.environ, "FLOWAUDIT_DRIVER_MEMORY": "2g"}
    got = subprocess.run([sys.executable, "-c", code, str(tmp_path)], capture_output=True, text=True, timeout=180, env=env)
    line = next(x for x in got.stdout.splitlines() if x.startswith("RESULT"))
    assert json.loads(line[6:]) == {str(r.id): r.y_pred for r in whole.transform(df).collect()}


def test_chain_with_zero_fill_keeps_every_column(spark):
    df = spark.createDataFrame(_rows(), DDL)
    chain = FlowChain(inputCols=["u", "v", "k"], fillZero=True).fit(df)
    assert kept_columns(chain) == ["u", "v", "k"]
    out = {r.id: r for r in chain.transform(df).collect()}
    assert out[0].v == 0.0 and out[11].v == 0.0 and out[999].u == 0.0 and out[1].u == 1.0
