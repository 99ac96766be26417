import random
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from flowaudit.llm.harmonic_packing import cut, pack
from flowaudit.llm.tokens import Encoder, public_path


def texts():
    rnd = random.Random(4)
    bits = ["It's", "we'll", " ", "  ", "\n\n", "\t", "naïve", "日本語", "a\xa0 b", "  x", "　 y", "1234 5", "...", "'s", "x'S",
            "<|endoftext|>"[:8], "word", "Straße", "é", "\x1c z", "\u0085 q", "😀 w", "don't", "—dash"]
    return ["".join(rnd.choice(bits) + rnd.choice(["", " ", "  ", "\n"]) for _ in range(rnd.randint(0, 40))) for _ in range(300)]


def test_ids_equal_the_tokenizer():
    import pyarrow as pa

    from flowaudit.llm.textops import column_bytes
    t = texts()
    want = [e.ids for e in Tokenizer.from_file(public_path()).encode_batch(t, add_special_tokens=False)]
    ids, off = Encoder(public_path()).encode(*column_bytes(pa.array(t)))
    assert [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:])] == want


def test_cut_covers_documents():
    sizes = np.array([1, 2, 2047, 2048, 2049, 700, 1500, 99999, 0])
    doc, start, length, k = cut(sizes, 2048, 64)
    assert (k * length <= 2048).all() and (length > 0).all()
    for d, n in enumerate(sizes):
        s, e = start[doc == d], length[doc == d]
        assert e.sum() == n and (s == np.cumsum(e) - e).all()


def test_round_trip_and_padding(spark):
    rows = [(i, t) for i, t in enumerate(texts())]
    rows += [(500, None), (501, ""), (7, rows[7][1]), (None, "no id"), (502, "long word " * 40000)]
    df = spark.createDataFrame([(d, t, 1, "c") for d, t in rows], "doc_id long, text string, sequence_id int, class string")
    got = pack(df.repartition(5)).collect()
    tok = Tokenizer.from_file(public_path())
    want = defaultdict(list)
    for d, t in rows:
        want[d].append([*(tok.encode(t or "", add_special_tokens=False).ids), 1])
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length
        pieces[r.doc_id].append((r.start, ids, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    for d, docs in want.items():
        p = sorted(pieces[d])
        if len(docs) == 1:
            assert sum((x for _, x, _ in p), []) == docs[0]
            assert {n for *_, n in p} == {len(docs[0])}
        else:
            assert len(p) % len(docs) == 0 and sum(len(x) for _, x, _ in p) == sum(map(len, docs))
    for s in sequences.values():
        s.sort()
        assert [o for o, _ in s] == [sum(n for _, n in s[:i]) for i in range(len(s))] and s[-1][0] + s[-1][1] <= 2048
    total = sum(r.length for r in got)
    assert len(sequences) * 2048 <= total * 1.05 + 2 * 2048


def test_empty(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_both_ways_of_encoding_give_the_tokenizers_ids():
    """Plain Latin texts (ranked merges) and all others (cuts through the tokenizer), mixed in one batch."""
    import numpy as np
    import pyarrow as pa
    from tokenizers import Tokenizer
    from flowaudit.llm.textops import column_bytes
    from flowaudit.llm.tokens import Encoder, plain_texts, public_path
    rnd = random.Random(8)
    alphabets = ["abc de\n", "é à ß ÿ ſ x", "aA'sS 't 'll 12 ½ ²  \t\r\n ", "日本 語 a", "\U0001F600 á ", "\x00\x1c\x1d\x85 b",
                 "<|endoftext|>", "«»¿ ¡÷×.,;"]
    texts = ["".join(rnd.choice(a) for _ in range(rnd.randrange(0, 80))) for a in alphabets for _ in range(60)]
    texts += [None, "", "a" * 9000, " " * 9000, "x <|endoftext|> y", "é" * 3000 + " z", "\n" * 50 + "a", "it's THEY'LL we've"]
    rnd.shuffle(texts)
    buf, off = column_bytes(pa.array(texts))
    encoder, tokenizer = Encoder(public_path()), Tokenizer.from_file(public_path())
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert encoder.ranked is not None and 0.3 < plain_texts(buf, off).mean() < 0.9
    for ids, at in (encoder.encode(buf, off), encoder.by_cuts(buf, off)):
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == want
        assert ids.dtype == np.uint32
