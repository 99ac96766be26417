import duckdb
import pandas as pd

from flowaudit.llm.mixing import mix, mix_sql


def both(spark, given, **kw):
    schema = "doc_id long, text string, source string, size int, name string"
    df = spark.createDataFrame([(d, t, s, 5, "n") for d, t, s in given], schema)
    rows = mix(df, **kw).selectExpr("doc_id", "size", "source_size", "target", "copies * size taken").collect()
    documents = pd.DataFrame(given, columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64"})   # noqa: F841
    want = duckdb.sql(mix_sql()).fetchall()
    got = pd.DataFrame(list(map(tuple, rows)), columns=["doc_id", "size", "source_size", "target", "taken"])
    return got, sorted(map(str, map(tuple, rows))), sorted(map(str, want))


def test_matches_sql(spark):
    rows = [(i, "w " * (i * 37 % 101), ["b", "a", None, "é", "z", "\U0001F600"][i * i % 6]) for i in range(400)]
    rows += [(3, "w w", "a"), (3, "w w", "a"), (None, "x\x0by\xa0z", None), (900, None, "a"), (901, "", "empty"),
             (902, "w " * 30000, "b")]
    got, a, b = both(spark, rows, bucket_rows=7)
    assert a == b
    assert (got.taken <= 3 * got["size"]).all()
    per = got.groupby(["target", "source_size"], as_index=False).agg(taken=("taken", "sum"), big=("size", "max"))
    assert ((per.taken - per.target).abs() <= 3 * per.big).all()


def test_targets_sum_and_cap(spark):
    rows = [(i, "w " * n, s) for i, (n, s) in enumerate([(10, "a"), (1000, "b"), (20, "c"), (5, "d")])]
    got, a, b = both(spark, rows)
    assert a == b
    t = got.set_index("doc_id").target
    assert abs(t.sum() - 1035) < 1e-6 and t[0] == 30 and t[2] == 60 and t[3] == 15 and abs(t[1] - 930) < 1e-9


def test_empty(spark):
    assert mix(spark.createDataFrame([], "doc_id long, text string, source string")).collect() == []
