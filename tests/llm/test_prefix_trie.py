import hashlib
import random
import zlib

import duckdb
import numpy as np
import pandas as pd

from flowaudit.llm.prefix_trie import centroid_rollup, rebuild, trie, trie_sql

SCHEMA = "text string, conv_id long, digest int, turn long, role string, owner string"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute(rows):
    own = {}
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            own.setdefault(c, []).append(((t is not None, t or 0), sha(f"{len(r.encode())}:{r}{x}"), r, x))
    own = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in own.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        built[c] = own.get(base, [])[:h] + own[c][h:]
    nodes = {}
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            nodes.setdefault(tuple(built[c][:d]), []).append(c)
    out = []
    for k, members in nodes.items():
        sub = [q for q in nodes if q[:len(k)] == k]
        kids = [q for q in sub if len(q) == len(k) + 1]
        leaves = [q for q in sub if not any(z[:len(q)] == q and len(z) > len(q) for z in sub)]
        saved = sum((len(nodes[q]) - 1) * len(q[-1][1].encode()) for q in sub if q)
        out.append((members[0], len(k), nodes[k[:-1]][0] if k else None, len(members), len(kids), len(leaves), saved,
                    sha(",".join(str(c) for c in members if len(built[c]) == len(k)))))
    return sorted(map(repr, out))


def run(spark, rows, **kw):
    df = spark.createDataFrame([(x, c, 1, t, r, "o") for c, t, r, x in rows], SCHEMA)
    return sorted(map(repr, map(tuple, trie(*rebuild(df), **kw).collect())))


def table():
    rng = random.Random(3)
    rows = [(c, t, "u" if t % 2 == 0 else "a", rng.choice(["x", "y", f"z{c}"])) for c in range(60) for t in range(rng.randrange(1, 12))]
    rows += [(c, t, "u", "same" * (t + 1)) for c in range(100, 140) for t in range(9)]              # exact copies
    rows += [(500, t, "u", f"deep {t}") for t in range(70)] + [(505, t, "u", f"deep {t}") for t in range(41)]
    rows += [(-7, 0, "u", "negative"), (-5, 0, "u", "base"), (-5, 1, "a", "b2"), (None, 0, "u", "nobody"), (61, None, None, None),
             (61, 2, "u", "é"), (61, 2, "u", "é"), (61, 2, "a", "é"), (71, 1, "", ""), (72, 5, "ab", "c"), (73, 5, "a", "bc"),
             (9223372036854775807, 0, "u", "x"), (80, 0, "u", "long " * 60000)]
    rng.shuffle(rows)
    return rows


def test_equals_brute_force(spark):
    want = brute(table())
    assert run(spark, table()) == want
    # chains over several blocks of turns, and components split by Spark down to four nodes
    assert run(spark, table(), block=3, small=4) == want


def test_sql_twin(spark):
    c, t, r, x = zip(*table())
    conversations = pd.DataFrame({"conv_id": pd.array(c, "Int64"), "turn": pd.array(t, "Int64"), "role": r, "text": x})   # noqa: F841
    assert sorted(map(repr, duckdb.sql(trie_sql()).fetchall())) == brute(table())


def test_small_tables(spark):
    assert run(spark, []) == []
    one = [(int(zlib.crc32(b"7") and 7), 0, "u", "t")]
    assert run(spark, one) == brute(one)


def test_centroids_of_random_forests():
    rng = np.random.default_rng(2)
    for shape in ("random", "chain", "star", "broom"):
        n = 300
        at = np.arange(n)
        parent = {"random": np.array([0] + [int(rng.integers(0, i)) for i in range(1, n)]), "chain": np.maximum(at - 1, 0),
                  "star": np.zeros(n, int), "broom": np.where(at < n // 2, np.maximum(at - 1, 0), n // 2 - 1)}[shape]
        parent = np.concatenate((parent, parent + n))                   # two trees
        own, values = rng.integers(1, 9, 2 * n), rng.integers(-5, 50, (2 * n, 2))
        weight, want = own.copy(), values.copy()
        for i in range(2 * n - 1, -1, -1):
            if parent[i] != i:
                weight[parent[i]] += weight[i]
                want[parent[i]] += want[i]
        order = rng.permutation(2 * n)
        place = np.argsort(order)
        assert (centroid_rollup(place[parent[order]], weight[order], values[order]) == want[order]).all()
