import hashlib
import zlib

import duckdb
import pandas as pd

from flowaudit.llm.merkle import manifest, manifest_sql, proof_digest

SCHEMA = "lang string, doc_id long, leaf int, text string, source string, n_chars long, n int, block string"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(*fields):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def climb(nodes):
    """Root, and for each node the (before, after) siblings of each level."""
    proofs = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(at):
            lo, hi = p // 3 * 3, min(len(nodes), p // 3 * 3 + 3)
            proofs[i].append(("".join(nodes[lo:p]), "".join(nodes[p + 1:hi])))
        nodes = [sha("".join(nodes[i:i + 3])) for i in range(0, len(nodes), 3)]
        at = [p // 3 for p in at]
    return nodes[0], proofs


def brute(rows):
    by = {}
    for d, s, lang, n, t in rows:
        odd = d is not None and zlib.crc32(str(d).encode()) % 2 == 0 and t is not None
        whole = leaf(d, s, lang, n, t)
        by.setdefault(s, []).append((d is not None, d or 0, whole, leaf(d, s, lang, n, t.replace("\n", "")) if odd else whole, d))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    built = {}
    for s in names:
        by[s].sort(key=lambda r: r[:4])
        built[s] = climb([r[2] for r in by[s]])
    root, tops = climb([built[s][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for r, proof in zip(by[s], built[s][1]):
            steps = proof + tops[k]
            cur = r[3]
            for b, a in steps:
                cur = sha(b + cur + a)
            out.append((r[4], r[2], built[s][0], root, sha("".join(b + a for b, a in steps)), cur, cur == root))
    return out


def run(spark, rows, levels):
    df = spark.createDataFrame([(lang, d, 7, t, s, n, 9, "x") for d, s, lang, n, t in rows], SCHEMA)
    out = manifest(df, levels=levels).select("doc_id", "leaf", "subroot", "root", proof_digest("steps"), "folded_root",
                                             "verified")
    return sorted(map(repr, map(tuple, out.collect())))


def table():
    rows = [(i * 7 % 1000, f"s{i % 4}", "en", i, f"line {i}\nnext {i % 3}\n") for i in range(120)]
    rows += [(2000 + i, "one big", None, None, f"a\n{i}" if i % 2 else "b") for i in range(100)]
    rows += [(5, None, None, None, None), (6, None, "é", -3, ""), (None, None, "de", 1, "x\ny"), (None, None, "de", 1, "x\ny"),
             (7, "s1", "en", 2, "tie\n"), (7, "s1", "en", 2, "tie\n"), (7, "s1", "en", 2, "tie\nother"), (-12, "", "", 0, "\n"),
             (9, "é", "en", 4, "long\n" * 40000), (10, "\U0001F600", "en", 4, "z")]
    return rows


def test_equals_brute_force(spark):
    rows = table()
    want = sorted(map(repr, brute(rows)))
    for levels in (2, 6):            # 2: several rounds of blocks for sources and for the subroots
        assert run(spark, rows, levels) == want


def test_sql_twin(spark):
    rows = table()
    documents = pd.DataFrame(rows, columns=["doc_id", "source", "lang", "n_chars", "text"])
    documents = documents.astype({"doc_id": "Int64", "n_chars": "Int64"})                     # noqa: F841
    got = duckdb.sql(manifest_sql(depth=5)).fetchall()
    assert sorted(map(repr, got)) == sorted(map(repr, brute(rows)))


def test_tampering_is_found(spark):
    got = {r[0]: r for r in brute(table()) if r[0] is not None}
    assert not got[2001][6] or zlib.crc32(b"2001") % 2
    assert {r[6] for r in got.values()} == {True, False}


def test_small_tables(spark):
    assert run(spark, [], 6) == []
    for n in (1, 3, 10):
        rows = [(i, "s", "en", 1, "t\n") for i in range(n)]
        assert run(spark, rows, 1) == sorted(map(repr, brute(rows)))
