import random

import numpy as np
import pytest

from flowaudit.llm.deep_shallow import suffix_groups
from flowaudit.llm.suffix_dedup import drop_repeats


def brute(rows, width=50):
    big = 1 << 62
    ids = [big if d is None else d for d, _ in rows]
    texts = [(t or "").encode() for _, t in rows]
    first = {}
    for d, b in zip(ids, texts):
        for s in range(len(b) - width + 1):
            w = b[s:s + width]
            first[w] = min(d, first.get(w, d))
    out = []
    for (doc, _), d, b in zip(rows, ids, texts):
        gone = [False] * len(b)
        for s in range(len(b) - width + 1):
            if first[b[s:s + width]] < d:
                gone[s:s + width] = [True] * width
        spans, s = [], None
        for k, g in enumerate(gone + [False]):
            if g and s is None:
                s = k
            if not g and s is not None:
                spans.append((s, k))
                s = None
        out.append((doc, len(b), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(d, t, "z", 3) for d, t in rows], "doc_id long, text string, _chunk string, kept int")
    got = drop_repeats(df, **kw)
    return sorted(((r.doc_id, r.n_bytes, list(zip(r.starts, r.ends)), bytes(r.kept)) for r in got.collect()), key=str)


def corpus(seed):
    rnd = random.Random(seed)
    piece = lambda n: "".join(rnd.choice("ab é\n") for _ in range(n))              # noqa: E731
    common = [piece(rnd.randint(20, 140)) for _ in range(6)]
    rows = []
    for d in range(90):
        parts = [rnd.choice(common) if rnd.random() < .5 else piece(rnd.randint(0, 90)) for _ in range(rnd.randint(0, 7))]
        text = "".join(parts)
        if rows and rnd.random() < .25:
            text = list(rnd.choice(rows)[1] or "")
            for _ in range(rnd.randint(0, 3)):
                if text:
                    text[rnd.randrange(len(text))] = "X"
            text = "".join(text)
        rows.append((rnd.randint(0, 300), text))
    return rows


@pytest.mark.parametrize("seed,hot", [(1, 256), (2, 2)])
def test_matches_brute_force(spark, seed, hot):
    rows = corpus(seed)
    assert run(spark, rows, hot=hot, chunk_bytes=500) == brute(rows)


def test_edges(spark):
    p = "The quick brown fox jumps over the lazy dog, twice a day. "
    long = "".join(f"{i * 7919 % 10007} " for i in range(120000))
    rows = [(5, p), (5, p), (7, p * 3), (None, p + "tail"), (None, "unseen" * 20), (None, "unseen" * 20), (8, None), (9, ""),
            (10, p[:49]), (11, p[:50]), (12, "é" * 40 + p), (13, "é" * 40), (20, long), (21, "x" + long)]
    got = run(spark, rows)
    small = lambda r: [x for x in r if x[1] < 10000]                                  # noqa: E731
    assert small(got) == brute([r for r in rows if r[0] not in (20, 21)])
    a, b = (next(x for x in got if x[0] == d) for d in (20, 21))
    assert a[2] == [] and b[3] == b"x" and b[2] == [(1, len(long) + 1)]
    assert run(spark, []) == []


def test_keeps_other_columns(spark):
    df = spark.createDataFrame([(1, "a", "s"), (2, None, None)], "doc_id int, text string, rest string")
    assert sorted((r.doc_id, r.rest.rest) for r in drop_repeats(df).collect()) == [(1, "s"), (2, None)]


def test_suffix_groups_sorts():
    rng = np.random.default_rng(3)
    base = rng.integers(97, 99, 300, dtype=np.uint8)
    buf = np.concatenate((base, base, base[::-1]))
    at = rng.permutation(len(buf) - 50)
    order, rank = suffix_groups(buf, at, 50)
    windows = [bytes(buf[a:a + 50]) for a in at[order]]
    assert windows == sorted(windows)
    assert [a == b for a, b in zip(windows, windows[1:])] == list(np.diff(rank) == 0)


def test_rows_of_one_id_and_without_id_spread_over_chunks(spark, monkeypatch):
    from pyspark.sql import functions as F
    from flowaudit.llm import suffix_dedup as D
    sizes = spark.sparkContext.accumulator(0)
    seen = D._visit_anchors

    def counted(*args):
        run = seen(*args)

        def call(t):
            sizes.add(t.num_rows ** 2)
            return run(t)
        return call
    monkeypatch.setattr(D, "_visit_anchors", counted)
    n = 2000
    rows = spark.range(n).select(
        F.when(F.col("id") % 2 == 0, 7).cast("long").alias("doc_id"), F.lpad(F.col("id").cast("string"), 8, "0").alias("text"),
        F.create_map(F.lit("k"), F.col("id")).alias("m"), F.lit("s").alias("source"))
    out = D.drop_repeats(rows, chunk_bytes=200).collect()
    assert len(out) == n and all(r.n_bytes == 8 and not r.starts for r in out)
    # chunks of a few rows each: the squares would be two million in two chunks
    assert sizes.value < 100_000
