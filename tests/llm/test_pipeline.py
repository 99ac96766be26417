import random
import sys

import numpy as np
import pytest

import corpus_pipeline as cp

from test_minhash_dedup import brute as near_brute          # noqa: E402
from test_suffix_dedup import brute as suffix_brute         # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
DDL = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of every stage on a small corpus."""
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(2, 7)))       # noqa: E731
    shared = " ".join(word() for _ in range(60))
    rows, toxic = [], {}
    for i in range(240):
        text = " ".join(word() for _ in range(rnd.randint(10, 120)))
        if i % 6 == 0:
            text += " " + shared
        if i % 10 == 3:
            text = rows[-3][1] or text
        if i % 10 == 4:
            w = (rows[-4][1] or text).split(" ")
            w[len(w) // 2] = "zz"
            text = " ".join(w)
        toxic[i] = int(i % 5 == 2)
        if toxic[i]:
            text += " zqxvillain"
        rows.append((i, text, "en", f"s{i % 4}", len(text)))
    rows += [(300, None, None, None, None), (301, "", "en", "s1", 0), (5, *rows[5][1:])]
    d = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, DDL).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(list(toxic.items()), "doc_id long, toxic int").write.parquet(f"{d}/labels.parquet")
    docs, out = spark.read.parquet(f"{d}/documents.parquet"), []
    for name, f in cp.STAGES:
        df = f(spark, docs, d)
        df.write.parquet(f"{d}/{name}")
        got = spark.read.parquet(f"{d}/{name}")
        out.append((docs.collect(), got.collect(), got.columns))
        docs = got
    return d, toxic, out


key = lambda rows: sorted(map(str, map(tuple, rows)))                                    # noqa: E731


def test_columns(stages):
    assert [c for *_, c in stages[2]][:-1] == [COLUMNS] * 4


def test_toxicity(stages):
    before, after, _ = stages[2][0]
    marked = lambda r: "villain" in (r.text or "")                                       # noqa: E731
    assert key(after) == key(r for r in before if not marked(r))


def near_kept(rows):
    """Rows that stay, by brute force: of each group of numbered rows the one of least doc_id."""
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    kept = {i for i, _, _, k in near_brute([(i, r[1]) for i, r in enumerate(order)], 5, 80) if k}
    return [r for i, r in enumerate(order) if i in kept]


def test_near_dedup(stages):
    before, after, _ = stages[2][1]
    want = near_kept([tuple(r) for r in before])
    assert len(want) < len(before)
    assert key(after) == key(want)


def test_near_dedup_counts_rows(spark):
    """Ids that repeat with different texts, repeated rows and rows without id."""
    rnd = random.Random(4)
    words = lambda n: [rnd.choice("abcdefgh") * rnd.randint(1, 9) for _ in range(n)]      # noqa: E731
    one, other = words(120), words(120)
    near = lambda w: " ".join([*w[:60], "zz", *w[61:]])                                  # noqa: E731
    rows = [(1, " ".join(one)), (1, " ".join(one)), (2, near(one)), (2, " ".join(other)), (3, near(other)),
            (None, " ".join(one)), (None, " ".join(words(50))), (None, ""), (None, None), (None, None), (4, "short"), (4, "short")]
    rows = [(d, t, "en", "s", 1) for d, t in rows]
    df = spark.createDataFrame(rows, DDL)
    got = cp.drop_near_copies(spark, df, "").collect()
    assert key(got) == key(near_kept(rows))
    assert sorted(r.doc_id for r in got if r.doc_id) == [1, 2, 4] and len(got) == 7


def test_stages_on_an_empty_table(spark):
    docs = spark.createDataFrame([], DDL)
    for name, f in cp.STAGES[1:]:                       # toxicity also reads labels
        assert f(spark, docs, "").collect() == []


def test_suffix_dedup(stages):
    before, after, _ = stages[2][2]
    want = {d: kept for d, _, _, kept in suffix_brute([(r.doc_id, r.text) for r in before])}
    assert len(after) == len(before) and sum(len(r.text) for r in after) < sum(len(r.text or "") for r in before)
    for r in after:
        assert r.text == want[r.doc_id].decode("utf-8", "ignore") and r.n_chars == len(r.text)
    rest = lambda rows: sorted((r.doc_id, str(r.lang), str(r.source)) for r in rows)     # noqa: E731
    assert rest(after) == rest(before)


def test_mixing(stages):
    before, after, _ = stages[2][3]
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}
    size = lambda r: len((r.text or "").split())                                         # noqa: E731
    total = sum(map(size, before))
    for k, s in enumerate(["s0", "s1", "s2", "s3"]):
        own = sum(size(r) for r in before if r.source == s)
        took = sum(size(r) for r in after if r.source == s)
        aim = min(3 * own, total * (k % 3 + 1) / 7)            # weights 1 2 3 1; the null source has no words
        assert abs(took - aim) <= 0.25 * aim
    assert max(np.unique([r.doc_id for r in after], return_counts=True)[1]) <= 6        # doc 5 is there twice


def test_packing(stages):
    before, after, _ = stages[2][4]
    copies = {}
    for r in before:
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    held = {}
    for p in after:
        held[p.doc_id] = held.get(p.doc_id, 0) + p.length
    one = {p.doc_id: p.doc_tokens for p in after}
    assert held == {d: n * one[d] for d, n in copies.items()}


def test_run(spark, stages):
    d, _, out = stages
    cols = ["doc_id", "start", "length", "ids", "doc_tokens"]
    assert key(cp.run(spark, d).select(*cols).collect()) == key((r.doc_id, r.start, r.length, r.ids, r.doc_tokens)
                                                                for r in out[4][1])
