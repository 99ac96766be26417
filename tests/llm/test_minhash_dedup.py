import random
import re

import pytest

from flowaudit.llm.minhash_dedup import near_duplicates


def brute(rows, width, percent):
    sets = []
    for i, (doc, text) in enumerate(rows):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = [x for x in re.split("[\x20\x09-\x0d]+", low) if x]
        sets.append({tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))} if w else set())
    par = list(range(len(rows)))

    def find(x):
        while par[x] != x:
            x = par[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None or not sets[i] or not sets[j]:
                continue
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * len(sets[i] | sets[j]):
                par[find(i)] = find(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[find(i)] = min(doc, low.get(find(i), doc))
    return sorted(((d, len(s), None if d is None else low[find(i)], d is None or d == low[find(i)])
                   for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, component_id string, node int")
    out = near_duplicates(df, **kw)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def corpus(seed, groups=12):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 6)))      # noqa: E731
    line = [word() for _ in range(30)]
    rows = []
    for g in range(groups):
        base = [word() for _ in range(rnd.randint(3, 150))] + (line if g % 2 else [])
        for c in range(rnd.randint(1, 9)):
            text = list(base)
            for _ in range(rnd.randint(0, max(1, len(base) // 25))):
                text[rnd.randrange(len(text))] = word()
            if c % 4 == 3:
                text = [x.upper() if x.isascii() else x for x in base]
            rows.append((len(rows) * 7 % 1009, rnd.choice([" ", "\n", "\t "]).join(text)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    rows = corpus(seed)
    assert run(spark, rows, width=3, percent=85) == brute(rows, 3, 85)


def test_tiny_blocks_split_lists(spark):
    rows = corpus(5, groups=5)
    assert run(spark, rows, width=3, percent=85, block=3) == brute(rows, 3, 85)


def test_edge_rows(spark):
    long = " ".join(f"w{i % 977}x{i}" for i in range(60000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE  two"), (6, "one"), (7, long), (8, long + " end"),
            (9, "a b c d e f g h"), (9, "a b c d e f g h"), (9, "q r s t u"), (None, "a b c d e f g h"), (12, "q r s t u"),
            (None, None), (20, "A\x85b c\xa0d e f")]
    assert run(spark, rows, width=3, percent=85) == brute(rows, 3, 85)
    assert run(spark, []) == []
