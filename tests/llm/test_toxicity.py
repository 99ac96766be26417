import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowaudit.llm.chargrams import CharGrams
from flowaudit.llm.queries import remainder
from flowaudit.llm.textops import column_bytes
from flowaudit.llm.toxicity import APART, BITS, FEATURES, ORDERS, _labelled, fit, score


def test_grams_are_characters_within_documents():
    texts = ["Añb", None, "añb", "日本", "x"]
    g = CharGrams(*column_bytes(pa.array(texts)))
    for n in (1, 2, 3):
        h, at = g.buckets(n, 40)
        per = {}
        for b, d in zip(h.tolist(), g.doc[at].tolist()):
            per.setdefault(d, []).append(b)
        assert {d: len(v) for d, v in per.items()} == {
            d: len(t) - n + 1 for d, t in enumerate(texts) if t and len(t) >= n}
        assert per[0] == per[2]


def corpus(n, seed=0):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh ") for _ in range(6))           # noqa: E731
    rows = []
    for i in range(n):
        w = [word() for _ in range(rnd.randint(0, 60))]
        y = i % 4 == 0
        if y:
            w.insert(rnd.randint(0, len(w)), rnd.choice(["Zxquv", "wyrzm"]))
        rows.append((i, " ".join(w), int(y)))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus(800)
    docs = spark.createDataFrame([(i, t, 0.5, "p") for i, t, _ in rows], "doc_id long, text string, score double, row string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (3, None), (5000, 1)], "doc_id long, toxic int")
    model = fit(docs, labels, usable=lambda i: remainder(i, 4) != 2)
    got = {r.doc_id: r for r in score(docs, model).where(remainder(F.col("doc_id"), 4) == 2).collect()}
    truth = {i: y for i, _, y in rows}
    assert len(got) > 100
    assert sum(r.predicted != truth[i] for i, r in got.items()) <= 0.03 * len(got)
    assert all(0 <= r.score <= 1 and r.row == "p" for r in got.values())
    again = fit(docs, labels, usable=lambda i: remainder(i, 4) != 2)
    assert again.bias == pytest.approx(model.bias, abs=1e-9)


def test_sample_is_bounded_by_rows(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(500)] + [(2, None), (3, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (9, 1)], "doc_id long, toxic int")
    rows = _labelled(docs, labels, "toxic", 20_000, lambda i: F.lit(True)).collect()
    assert sorted(map(repr, map(tuple, rows))) == ["('c', 0)", "('text 0', 1)", "(None, 0)"]
    assert _labelled(docs.where("doc_id = 1"), labels.where("doc_id = 1"), "toxic", 1, lambda i: F.lit(True)).count() == 1


def test_ratios_and_regression_by_brute_force(spark):
    """Features, log-count ratios and weights against plain Python on the same grams."""
    rows = corpus(160, seed=5)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    model = fit(docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"), steps=40)
    g = CharGrams(*column_bytes(pa.array([t for _, t, _ in rows])))
    sets = [set() for _ in rows]
    for n in ORDERS:
        for b, d in zip(*(x.tolist() for x in (lambda h, at: (h, g.doc[at]))(*g.buckets(n, BITS)))):
            sets[d].add(b)
    y = [v for *_, v in rows]
    n1, n0 = sum(y), len(y) - sum(y)
    pos, neg = [0] * (1 << BITS), [0] * (1 << BITS)
    for s, v in zip(sets, y):
        for b in s:
            (pos if v else neg)[b] += 1
    total = [sum(c) + (1 << BITS) for c in (pos, neg)]
    z = {}
    for b in set().union(*sets):
        p = (pos[b] + neg[b]) / len(y)
        z[b] = abs(pos[b] / n1 - neg[b] / n0) / math.sqrt(max(p * (1 - p), 1e-12) * (1 / n1 + 1 / n0))
    used = sorted(b for b in z if z[b] >= APART)
    assert len(used) < FEATURES and np.flatnonzero(model.slot < len(used)).tolist() == used
    ratio = [math.log((pos[b] + 1) / total[0]) - math.log((neg[b] + 1) / total[1]) for b in used]
    assert np.allclose(model.ratio, ratio)
    x = np.array([[r if b in s else 0.0 for b, r in zip(used, ratio)] for s in sets])
    w, bias, m, v = np.zeros(len(used)), math.log((n1 + 1) / (n0 + 1)), np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for t in range(1, 41):
        e = (1 / (1 + np.exp(-(x @ w + bias))) - y) / len(y)
        grad = np.append(x.T @ e + 1e-4 * w, e.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
        move = 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-9)
        w, bias = w - move[:-1], bias - move[-1]
    assert np.allclose(model.weight, w, atol=1e-6) and abs(model.bias - bias) < 1e-6
    got = {r.doc_id: r.score for r in score(docs, model).collect()}
    assert all(abs(got[i] - 1 / (1 + math.exp(-(x[i] @ w + bias)))) < 1e-4 for i in got)


def test_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (2, ""), (None, "a b"), (4, "bad word " * 30000)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in score(docs, fit(docs, none)).collect()} == {0.5}
    # three labels tell nothing: no gram is apart by three standard scores, and all get the base rate
    few = fit(docs, spark.createDataFrame([(1, 0), (2, 0), (4, 1)], "doc_id long, toxic int"))
    assert len(few.weight) == 0 and {round(r.score, 6) for r in score(docs, few).collect()} == {0.4}
    more = docs.unionAll(spark.createDataFrame([(i, "bad word" if i % 2 else "ok") for i in range(10, 50)], docs.schema))
    model = fit(more, spark.createDataFrame([(1, 0), (2, 0), (4, 1)] + [(i, i % 2) for i in range(10, 50)], "doc_id long, toxic int"))
    got = {(r.doc_id, r.text): r.score for r in score(docs, model).collect()}
    assert got[1, None] == got[2, ""] < got[4, "bad word " * 30000]
    assert score(docs.where("false"), model).collect() == []
