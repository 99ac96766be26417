import pandas as pd
from pyspark.sql import functions as F

from flowaudit.operators.ordered import hash_key, hash_rank, prefix_sums


def test_prefix_sums_match_pandas(spark):
    df = spark.range(0, 3000).select((F.col("id") % 4).alias("g"),
                                     ((F.col("id") * 7919) % 3001).cast("double").alias("o"),
                                     (F.col("id") % 5).alias("v"))
    for desc in (False, True):
        got = prefix_sums(df, "o", ["v"], ["g"], descending=desc).toPandas()
        got = got.sort_values(["g", "o"], ascending=[True, not desc])
        exp = got.groupby("g").v.cumsum()
        assert (got.cum_v.values == exp.values).all()


def test_prefix_sums_without_groups(spark):
    df = spark.range(0, 1000).select(((F.col("id") * 37) % 1009).cast("double").alias("o"), F.lit(1).alias("one"))
    got = prefix_sums(df, "o", ["one"]).toPandas().sort_values("o")
    assert list(got.cum_one) == list(range(1, 1001))


def test_hash_rank_is_row_number_over_md5(spark):
    df = spark.range(0, 2000).select("id", (F.col("id") % 3).cast("string").alias("g"))
    got = hash_rank(df, ["g"], "id", 42, out="rk").withColumn("h", hash_key("id", 42)).toPandas()
    got = got.sort_values(["g", "h"])
    assert (got.rk.values == (got.groupby("g").cumcount() + 1).values).all()


def test_bounded_splits_keep_the_order(spark, monkeypatch):
    from flowaudit.operators import ordered
    monkeypatch.setattr(ordered, "MAX_SPLITS", 4)
    rows = [(float(i * i % 997) * (-1) ** i,) for i in range(3000)] + [(float("inf"),)] * 60 + [(float("-inf"),)] * 60 + \
           [(float("nan"),)] * 60 + [(None,)] * 60 + [(7.5,)] * 300
    df = spark.createDataFrame(rows, "o double").withColumn("one", F.lit(1)).withColumn("k", F.monotonically_increasing_id())
    bucketed = ordered.with_value_bucket(df, "o", target=50)
    per = bucketed.groupBy("_fa_bucket").agg(F.min("o").alias("lo"), F.max("o").alias("hi")).orderBy("_fa_bucket").collect()
    assert len(per) > 20
    edge = [(r.lo, r.hi) for r in per if r.lo is not None and r.lo == r.lo and r.hi == r.hi]
    assert all(a[1] <= b[0] for a, b in zip(edge, edge[1:]))
    got = prefix_sums(df, "o", ["one"], tiebreak=["k"]).orderBy("cum_one").collect()
    assert [r.cum_one for r in got] == list(range(1, len(rows) + 1))
    vals = [r.o for r in got if r.o is not None and r.o == r.o]
    assert vals == sorted(vals) and got[0].o is None and got[-1].o != got[-1].o


def test_row_digest_tells_nulls_apart(spark):
    from flowaudit.functions.missing import row_digest
    nan = float("nan")
    df = spark.createDataFrame([(None, 1.0), (1.0, None), (None, 1.0), (nan, 0.0), (nan, -0.0), (None, None), (1.0, 1.0)],
                               "a double, b double")
    assert df.select(*row_digest(["a", "b"])).distinct().count() == df.distinct().count() == 5
