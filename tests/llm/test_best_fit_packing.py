import random
from collections import Counter, defaultdict

import numpy as np
from tokenizers import Tokenizer

from flowaudit.llm.best_fit_packing import best_fit, pack_matrix, write_matrix
from flowaudit.llm.tokens import public_path


def plain(lengths, capacity):
    room, out = [], [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        fit = [r for r in range(len(room)) if room[r] >= lengths[i]]
        if fit:
            r = min(fit, key=lambda r: room[r])
            room[r] -= lengths[i]
        else:
            r = len(room)
            room.append(capacity - lengths[i])
        out[i] = r
    return out, room


def test_best_fit_decreasing():
    rnd = random.Random(3)
    for capacity in (1, 7, 64, 100):
        for _ in range(20):
            lengths = [rnd.randint(1, capacity) for _ in range(rnd.randint(0, 80))]
            got = best_fit(np.array(lengths, np.int64), capacity)
            want, room = plain(lengths, capacity)
            used = Counter()
            for r, n in zip(got.tolist(), lengths):
                used[r] += n
            assert max(used.values(), default=0) <= capacity
            # rows with equal room are interchangeable
            assert sorted(capacity - u for u in used.values()) == sorted(room)


def test_round_trip(spark, tmp_path):
    rnd = random.Random(1)
    texts = [" ".join(rnd.choice(["alpha", "Beta", "naïve", "12", "—"]) for _ in range(rnd.randint(0, 300))) for _ in range(120)]
    rows = list(enumerate(texts)) + [(200, None), (201, ""), (202, "long word " * 20000), (None, "no id"), (3, texts[3])]
    df = spark.createDataFrame([(d, t, 1, "i") for d, t in rows], "doc_id long, text string, n_tokens int, ids string")
    path = str(tmp_path / "packed")
    write_matrix(pack_matrix(df.repartition(3), capacity=256, window=5000), path)
    got = spark.read.parquet(path).collect()
    tok = Tokenizer.from_file(public_path())
    want = defaultdict(list)
    for d, t in rows:
        want[d].append([*(tok.encode(t or "", add_special_tokens=False).ids), 1])
    pieces = defaultdict(list)
    for r in got:
        ids, pos = np.frombuffer(r.ids, "<u4"), np.frombuffer(r.positions, "<u4")
        assert len(ids) == len(pos) == 256 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens
        assert (ids[r.n_tokens:] == 0).all() and len(r.doc_ids) == len(r.doc_starts) == len(r.cu_seqlens) - 1
        for a, b, d, s in zip(r.cu_seqlens, r.cu_seqlens[1:], r.doc_ids, r.doc_starts):
            assert pos[a:b].tolist() == list(range(b - a))
            pieces[d].append((s, ids[a:b].tolist()))
    assert len({r.sequence_id for r in got}) == len(got)
    for d, docs in want.items():
        if len(docs) == 1:
            assert sum((p for _, p in sorted(pieces[d])), []) == docs[0]
        else:
            assert sum(len(p) for _, p in pieces[d]) == sum(map(len, docs))
    assert sum(r.n_tokens for r in got) >= 0.93 * 256 * (len(got) - 20)
    assert pack_matrix(df.where("false")).collect() == []
