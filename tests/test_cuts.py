"""Splits by hash cuts, digest joins and header discovery."""

import random

import pytest
from pyspark.sql import Window, functions as F

from flowaudit.operators import digests, ordered, splits
from flowaudit.operators.balance import oversample, undersample
from flowaudit.operators.duplicates import conflicting_vectors, drop_all_copies, keep_first
from flowaudit.operators.ordered import hash_cuts, hash_key, within_cut
from flowaudit.schema import FlowSchema
from flowaudit.sources.flows import read_flows, read_headers


def ranked(df, group):
    w = Window.partitionBy(*group).orderBy(hash_key("id", 7))
    return df.withColumn("r", F.row_number().over(w))


@pytest.mark.parametrize("rows", [4096, 3])
def test_cuts_are_ranks(spark, monkeypatch, rows):
    """Ranks at both ends, beyond them, on a null group and on ranges that are cut again."""
    monkeypatch.setattr(ordered, "CUT_ROWS", rows)
    monkeypatch.setattr(ordered, "CUT_DIGITS", (1, 1) if rows == 3 else (2, 3))
    df = spark.range(3000).select("id", F.when(F.col("id") % 10 < 6, "a").when(F.col("id") % 10 < 9, "b").alias("g"))
    ranks = {"a": [0, 1, 700, 1800, 5000], "b": [899, 900, 1, 450, -3], None: [300, 299, 17, 1, 0]}
    cuts = hash_cuts(df, "id", 7, ranks, "g")
    got = ranked(df, ["g"]).select("g", "r", *[within_cut("id", 7, cuts, i, "g").alias(f"c{i}") for i in range(5)]).collect()
    assert len(got) == 3000
    for row in got:
        assert [row[f"c{i}"] for i in range(5)] == [row["r"] <= r for r in ranks[row["g"]]]
    whole = hash_cuts(df, "id", 7, {None: [1234]})
    assert df.where(within_cut("id", 7, whole)).count() == 1234


def test_cuts_of_equal_keys_and_no_rows(spark):
    same = spark.createDataFrame([(5,)] * 40, "id long")
    assert same.where(within_cut("id", 7, hash_cuts(same, "id", 7, {None: [3]}))).count() == 40
    none = same.where("id < 0")
    assert none.where(within_cut("id", 7, hash_cuts(none, "id", 7, {None: [3]}))).count() == 0


def test_splits_do_not_shuffle_rows(spark):
    df = spark.range(2000).select("id", (F.col("id") % 3).cast("string").alias("g"))
    for out in (splits.three_way_split(df, "g", "id"), splits.paper_split(df, "g", "id"),
                splits.stratified_split(df, "g", "id", 0.25), undersample(df, "g", "id", {"0": 5}),
                oversample(df, "g", "id", {"0": 2000})):
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
        out.count()
    sizes = {r[0]: r[1] for r in splits.paper_split(df, "g", "id").groupBy("split").count().collect()}
    assert sizes == {"train": 1200, "val": 400, "test": 400}


@pytest.mark.parametrize("limit", [1_000_000, 2])
def test_copies_by_digest_match_brute_force(spark, monkeypatch, limit):
    """Hot, plain and single vectors, nulls in them and in the order, with facts broadcast and dealt."""
    monkeypatch.setattr(digests, "MAX_BROADCAST", limit)
    monkeypatch.setattr(digests, "BUSY_SHARE", 8)
    rnd = random.Random(3)
    rows = []
    for i in range(400):
        a = rnd.choice([1.0] * 6 + [None, 2.0, 3.0, float(i)])
        b = rnd.choice([0.0, 0.0, None])
        rows.append((i if i % 50 else None, a, b, rnd.choice("xy") if a != 2.0 else "x"))
    df = spark.createDataFrame(rows, "id long, a double, b double, label string").repartition(5)
    groups = {}
    for r in rows:
        groups.setdefault(r[1:3], []).append(r)
    got = drop_all_copies(df, ["a", "b"]).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str(g[0]) for g in groups.values() if len(g) == 1)
    first = keep_first(df, ["a", "b"], "id").collect()
    want = [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]
    assert sorted(str((r.id, r.a, r.b)) for r in first) == sorted(str(w[:3]) for w in want)
    found = conflicting_vectors(df, FlowSchema(features=["a", "b"], label="label", day=None)).collect()
    assert {(r.a, r.b): (r.n_rows, r.labels, r.n_labels) for r in found} == \
        {k: (len(g), sorted({r[3] for r in g}), 2) for k, g in groups.items() if len({r[3] for r in g}) > 1}
    keyed = df.where("id IS NOT NULL")
    parts = splits.grouped_split(keyed, ["a", "b"], "id").collect()
    assert len(parts) == keyed.count()
    side = {}
    for r in parts:
        side.setdefault((r.a, r.b), set()).add(r.split)
    assert all(len(s) == 1 for s in side.values())
    n = len(side)
    assert sum(s == {"test"} for s in side.values()) == -(-n // 5)


def test_headers_are_read_by_a_job(spark, tmp_path, monkeypatch):
    """Mixed headers, names with blanks and signs, empty files, files of many lines."""
    body = {"Monday-a b%20.csv": "x,Label\n1,BENIGN\n" + "2,BENIGN\n" * 30000, "Tuesday-+ü.csv": "Label,x\r\nBENIGN,3\r\n",
            "Friday-c.csv": "x,Label\n4,BENIGN\n", "Sunday-none.csv": ""}
    for name, text in body.items():
        (tmp_path / name).write_bytes(text.encode())
    files = [str(tmp_path / n) for n in body]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    got = read_headers(spark, files)
    assert got == {"x,Label": [files[0], files[2]], "Label,x": [files[1]]}
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    df = read_flows(spark, str(tmp_path))
    assert {r.Day: (r.n, r.s) for r in df.groupBy("Day").agg(F.count("*").alias("n"), F.sum("x").alias("s")).collect()} == \
        {"Monday": (30001, 60001.0), "Tuesday": (1, 3.0), "Friday": (1, 4.0)}
    empty = tmp_path / "all_empty"
    empty.mkdir()
    (empty / "Monday-x.csv").write_text("")
    with pytest.raises(ValueError, match="all empty"):
        read_flows(spark, str(empty))


def test_components_follow_the_vectors(spark):
    from pyspark.ml.linalg import Vectors
    from flowaudit.operators.correlation import pca_explained_variance
    rnd = random.Random(1)
    df = spark.createDataFrame([(Vectors.dense([rnd.random() for _ in range(70)]),) for _ in range(90)], ["v"])
    rows = pca_explained_variance(df, "v").orderBy("component").collect()
    assert len(rows) == 70 and abs(rows[-1].cumulative - 1) < 1e-9


def test_threshold_choices_are_bounded(spark):
    from flowaudit.operators.metrics import MAX_CHOICES, apply_thresholds
    scored = spark.createDataFrame([(1, 0.9), (0, 0.2)], "y int, s double")
    many = spark.range(MAX_CHOICES + 1).select(F.lit("x").alias("strategy"), F.lit(0.5).alias("threshold"))
    with pytest.raises(ValueError, match="threshold choices"):
        apply_thresholds(scored, "y", "s", many)
    assert apply_thresholds(scored, "y", "s", many.limit(2)).count() == 2
