import random
import re

import numpy as np
import pyarrow as pa

from flowaudit.llm.quality import BASE, FEATURES, boost, fit, judge, statistics
from flowaudit.llm.textops import column_bytes

SPLIT = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    w = SPLIT.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if SPLIT.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    marked = {i + j for i, x in enumerate(windows) if windows.count(x) > 1 for j in range(8)}
    return [len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(marked)]


def texts(seed=1):
    rnd = random.Random(seed)
    out = [None, "", " \n ", "\n", "a", "a\na\na", "a\n\na\n", "x " * 30, "é|ü #1", "a b c d e f g h " * 3 + "\n tail"]
    for _ in range(120):
        vocabulary = [rnd.choice(["ab", "Çé", "x|", "9", "日本"]) + str(k) for k in range(rnd.randint(1, 6))]
        lines = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 12))) for _ in range(rnd.randint(0, 9))]
        out.append("\n".join(lines) + rnd.choice(["", "\n", "\n\n"]))
    return out


def test_statistics_match_brute_force():
    t = texts()
    base, x = statistics(*column_bytes(pa.array(t)))
    assert base.tolist() == [brute(v) for v in t]
    assert x.shape == (len(t), len(FEATURES)) and np.isfinite(x).all()
    alone = [statistics(*column_bytes(pa.array([v], pa.string())))[1][0] for v in t]
    assert np.allclose(np.stack(alone), x)


def test_forest_is_monotone_and_learns():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] + 0.3 * np.sin(9 * x[:, 1]) + 0.1 * rng.standard_normal(4000)) < 0.5).astype(float)
    forest = boost(x[:3000], y[:3000], [-1, 0, 0])
    assert ((forest.probability(x[3000:]) > .5) == (y[3000:] > .5)).mean() > .9
    grid = np.repeat(rng.random((50, 3)), 40, axis=0)
    grid[:, 0] = np.tile(np.linspace(-1, 2, 40), 50)
    p = forest.probability(grid).reshape(50, 40)
    assert (np.diff(p, axis=1) <= 1e-12).all()


def test_judge(spark):
    rnd = random.Random(7)
    rows, truth = [], {}
    for i in range(600):
        words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 9))) for _ in range(rnd.randint(25, 80))]
        good = i % 3 > 0
        rows.append((i, " ".join(words if good else [w + rnd.choice("#*$%") for w in words])))
        truth[i] = good
    extra = [(1000, None), (1001, ""), (1002, "w " * 200), (None, rows[1][1]), (1, rows[1][1]), (1003, "word " * 40000)]
    docs = spark.createDataFrame([(d, t, True, "y") for d, t in rows + extra],
                                 "doc_id long, text string, kept boolean, y string")
    labels = spark.createDataFrame([(i, int(g)) for i, g in truth.items() if i < 400] + [(None, 1), (2, None)],
                                   "doc_id long, quality int")
    got = judge(docs, fit(docs, labels))
    assert got.columns == ["doc_id", *BASE, "probability", "base_failed", "kept"]
    by = [tuple(r) for r in got.collect()]
    assert len(by) == len(rows) + len(extra)
    want = {(d, *brute(t)) for d, t in rows + extra[:4]}
    assert want <= {r[:6] for r in by}
    for r in by:
        assert r[7] == (r[1] < 20 or 100 * r[5] > 30 * r[1]) and (not r[7] or not r[8])
    held = [r for r in by if r[0] is not None and 400 <= r[0] < 1000]
    assert sum(r[8] != truth[r[0]] for r in held) <= 4
    assert judge(docs.where("false"), fit(docs.where("false"), labels)).collect() == []
