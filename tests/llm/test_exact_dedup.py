import hashlib

import duckdb
import numpy as np
import pandas as pd

from flowaudit.llm.exact_dedup import Directory, build_index, duplicates, duplicates_sql

SCHEMA = "text string, doc_id long, link int, page string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault((t or "").translate(LOWER), []).append(d)
    out = []
    for t, ids in groups.items():
        best = max((d for d in ids if d is not None), default=None)
        first = ids.index(best)
        out += [(d, best, len(ids), i == first, hashlib.sha256(t.encode()).hexdigest()) for i, d in enumerate(ids)]
    return sorted(map(repr, out))


def run(spark, rows, parts=3, **kw):
    df = spark.createDataFrame([(t, d, 1, "x") for d, t in rows], SCHEMA).repartition(parts)
    return sorted(map(repr, map(tuple, duplicates(df, **kw).collect())))


def table():
    rows = [(i, f"Text {i % 90} É é") for i in range(400)] + [(1000 + i, "the HOT text" if i % 2 else "The hot TEXT") for i in range(300)]
    rows += [(2000, None), (2001, ""), (None, ""), (None, "no id"), (None, "no id"), (None, "NO ID"), (5, "twice"), (5, "twice"),
             (5, "other"), (-3, "É"), (-4, "é"), (3000, "long " * 300000), (3001, "LONG " * 300000), (3002, "long " * 300000 + "x"),
             (3003, "ß"), (3004, "\x00"), (3005, "\n"), (3006, " ")]
    return rows


def test_equals_brute_force(spark):
    rows = table()
    assert run(spark, rows) == brute(rows)
    # overfull buckets, pages of two entries, and hashes of six bits: different texts chained under one key
    assert run(spark, rows, parts=9, capacity=4, page=2, bits=6) == brute(rows)


def test_sql_twin(spark):
    documents = pd.DataFrame(table(), columns=["doc_id", "text"]).astype({"doc_id": "Int64"})     # noqa: F841
    assert sorted(map(repr, duckdb.sql(duplicates_sql()).fetchall())) == brute(table())


def test_index_splits(spark):
    rng = np.random.default_rng(1)
    keys = [(int(k), 3) for k in rng.integers(-2**63, 2**63 - 1, 500)] + [(int(k), 3) for k in rng.integers(0, 1000, 60)] + [(7, n) for n in range(40)]
    directory, index = build_index(spark.createDataFrame(keys + keys[:50], "key long, n_bytes long"), 32)
    starts = directory.starts()
    assert (np.diff(starts) > 0).all() and starts[0] == -2**63 and directory.depth > 20 > directory.buckets[-1][1]
    got = index.collect()
    assert sorted((r.key, r.n_bytes) for r in got) == sorted(set(keys)) and sum(r.entries for r in got) == len(keys) + 50
    held = np.searchsorted(starts, [k for k, _ in sorted(set(keys))], side="right") - 1
    sizes = {b: len({k for (k, _), h in zip(sorted(set(keys)), held) if h == b}) for b in set(held.tolist())}
    assert max(sizes.values()) <= 32


def test_directory():
    d = Directory(1)
    d.split({1})
    assert d.depth == 2 and d.buckets == [(0, 1), (2, 2), (3, 2)]
    assert d.starts().tolist() == [-2**63, 0, 2**62]


def test_small_tables(spark):
    assert run(spark, [], parts=1) == []
    assert run(spark, [(None, None)], parts=1) == brute([(None, None)])
