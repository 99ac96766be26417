import random

import pyarrow as pa

from flowaudit.llm.language import fit, predict
from flowaudit.llm.queries import remainder
from flowaudit.llm.textops import column_bytes

SYLLABLES = {"aa": ["ka", "to", "mi", "ñu"], "bb": ["str", "oun", "ght", "el"], "cc": ["ющ", "ия", "но", "ст"]}


def sentence(rnd, lang, n):
    return " ".join("".join(rnd.choice(SYLLABLES[lang]) for _ in range(rnd.randint(1, 4))) for _ in range(n))


def test_held_out_and_mixtures(spark):
    rnd = random.Random(2)
    rows = [(i, sentence(rnd, lang, rnd.randint(3, 60)), lang) for i, lang in enumerate(rnd.choices(list(SYLLABLES), k=500))]
    rows += [(900, None, "aa"), (901, "", "bb"), (902, "123 !?", None), (903, sentence(rnd, "aa", 30) + " " + sentence(rnd, "cc", 10), None),
             (None, sentence(rnd, "bb", 9), None), (904, sentence(rnd, "bb", 30000), None), (1, rows[1][1], rows[1][2])]
    docs = spark.createDataFrame([(*r, 1.0, "q") for r in rows], "doc_id long, text string, lang string, score double, letters string")
    model = fit(docs, usable=lambda i: remainder(i, 5) != 0)
    got = predict(docs, model).collect()
    assert len(got) == len(rows)
    lang = {(r.doc_id): r for r in got}
    wrong = [i for i, _, true in rows[:500] if lang[i].lang_pred != true]
    assert len(wrong) <= 2
    assert all(0 <= r.score <= 1 for r in got)
    assert [(lang[i].lang_pred, lang[i].score) for i in (900, 901, 902)] == [("und", 0.0)] * 3
    assert lang[903].lang_pred == "aa" and set(lang[903].languages) == {"aa", "cc"} and abs(lang[903].score - .75) < .05
    assert set(lang[904].languages) == {"bb"} and lang[None].lang_pred == "bb"


def test_brute_force_em():
    """The vectorised selection equals a plain loop over one document at a time."""
    import numpy as np

    from flowaudit.llm.language import BITS, ORDERS, ROUNDS, Model
    rng = np.random.default_rng(1)
    model = Model(["a", "b", "c"], rng.normal(-6, 2, (len(ORDERS) << BITS, 3)).astype(np.float32))
    texts = ["one two", "", "drei vier fünf sechs sieben", None, "x", "a b c d e f g h i j k l m"] * 2
    buf, off = column_bytes(pa.array(texts))
    d, logs = model.words(buf, off)
    got = model.proportions(buf, off)
    for doc in range(len(texts)):
        like = np.exp(logs[d == doc] - logs[d == doc].max(axis=1, keepdims=True)) if (d == doc).any() else None
        if like is None:
            assert (got[doc] == 0).all()
            continue

        def em(mix):
            for _ in range(ROUNDS):
                r = mix * like
                mix = (r / r.sum(axis=1, keepdims=True)).mean(axis=0)
            return mix, np.log((mix * like).sum(axis=1)).sum()
        mix, value = em(np.full(3, 1 / 3))
        while (mix > 0).sum() > 1:
            trial = mix.copy()
            trial[np.where(trial > 0, trial, np.inf).argmin()] = 0
            trial, now = em(trial / trial.sum())
            if value - now >= 0.5 * np.log(len(like) + 1):
                break
            mix, value = trial, now
        assert np.allclose(got[doc], mix, atol=1e-6)


def test_no_languages(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in predict(docs, fit(docs)).collect()] == [("und", 0.0)]
    assert predict(docs.where("false"), fit(docs)).collect() == []
