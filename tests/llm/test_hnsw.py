import numpy as np

from flowaudit.llm.hnsw import build, nearest, search


def brute(rows, k):
    usable = {}
    for i, v in rows:
        if i is None or v is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        usable[i] = min(usable.get(i, v), v)
    size = max(set(map(len, usable.values())), key=lambda n: (sum(len(v) == n for v in usable.values()), n), default=0)
    usable = {i: np.array(v, np.float64) for i, v in usable.items() if len(v) == size}
    out = {}
    for i, q in usable.items():
        if i % 20 == 0:
            got = sorted((-float(v @ q), j) for j, v in usable.items() if j != i)[:k]
            out[i] = [(j, -s) for s, j in got]
    return out


def collect(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: sorted(v) for q, v in out.items()}


def test_graph_recall():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((3000, 24)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    order, layers = build(x)
    got = search(x[order], layers, x[:200], 64)
    want = np.argsort(-(x[:200] @ x.T), axis=1)[:, :10]
    recall = np.mean([len(set(order[g[g >= 0]]) & set(w)) / 10 for g, w in zip(got, want)])
    assert recall > .9
    for l in layers:
        assert l.max() < len(l) and (l != np.arange(len(l))[:, None]).all()


def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(1)
    x = (rng.standard_normal((2500, 16)) * rng.uniform(.2, 3, (2500, 1))).astype(np.float32)
    rows = [(i, x[i].tolist()) for i in range(2500)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, shard int")
    got, want = collect(nearest(df, shard_rows=700, block=50)), brute(rows, 20)
    assert got.keys() == want.keys()
    hits = 0
    for q, found in got.items():
        assert [r for r, *_ in found] == list(range(1, 21))
        score = dict(brute([rows[q]] + [rows[j] for _, j, _ in found], 20)[q])
        assert all(abs(s - score[j]) < 1e-9 for _, j, s in found)
        assert [(-s, j) for _, j, s in found] == sorted((-s, j) for _, j, s in found)
        hits += len({j for _, j, _ in found} & {j for j, _ in want[q]})
    assert hits >= .9 * 20 * len(want)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0]) for i in range(0, 60)] + [(60, None), (61, []), (62, [0.0, 0.0]), (63, [None, 1.0]), (64, [nan, 1.0]),
            (65, [inf, 1.0]), (66, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (80, [3.0, -1.0]), (81, [0.5, 0.5]), (81, [0.5, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = collect(nearest(df, k=20))
    assert {q: [(j, s) for _, j, s in v] for q, v in got.items()} == brute(rows, 20)
    assert nearest(df.where("false")).collect() == []
    assert nearest(df.where("vec_id = 20")).collect() == []


def test_recall_beside_long_vectors(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((2500, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[7::500] *= 1e4
    for long in (1, 1e20):
        x[13::500] *= long                                   # the second time some of norm 1e20 as well
        rows = [(i, x[i].tolist()) for i in range(2500)]
        got = collect(nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), block=50))
        want = brute(rows, 20)
        assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
        hits = sum(len({j for _, j, _ in got[q]} & {j for j, _ in want[q]}) for q in want)
        print("recall", long, hits / (20 * len(want)))
        assert hits >= .95 * 20 * len(want)


def test_ids_with_several_vectors(spark):
    rng = np.random.default_rng(6)
    rows = [(i // 2, rng.standard_normal(8).tolist()) for i in range(160)] + [(3, [9.0] * 8), (3, [9.0] * 8), (5, [9.0] * 8)]
    got = collect(nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), block=2))
    distinct = sorted({(i, tuple(v)) for i, v in rows})
    assert set(got) == {0, 20, 40, 60}
    for q, found in got.items():
        y = np.array(min(v for i, v in distinct if i == q))
        want = sorted((-float(np.array(v) @ y), i) for i, v in distinct if i != q)[:20]
        assert [j for _, j, _ in found] == [j for _, j in want]
        assert np.allclose([s for *_, s in found], [-s for s, _ in want])
