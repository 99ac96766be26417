"""Operator 5: language mixtures of documents by expectation-maximisation.

Per language, hashed character n-grams (1 to 3) have smoothed log likelihoods,
learned from a bounded number of labelled documents per language.  A word's
likelihood under a language is the product of its grams'.  For each document,
EM estimates the proportions of a mixture of languages that generates its
words.  The set of languages is chosen by penalised likelihood: starting from
all, the language of least proportion is dropped as long as the loss of log
likelihood is smaller than the penalty of log(words) / 2 per language.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .chargrams import CharGrams
from .textops import column_bytes, sub_batches, word_spans

ORDERS, BITS = (1, 2, 3), 16
PER_LANGUAGE, MAX_LANGUAGES = 5000, 500
ROUNDS, STEP = 8, 1 << 20
UNKNOWN = "und"


@dataclass
class Model:
    languages: list[str]
    logp: np.ndarray           # (order, bucket) x language, natural log of smoothed probabilities

    def words(self, buf: np.ndarray, off: np.ndarray):
        """(document, log likelihood per language) of every word."""
        s, e, d = word_spans(buf, off)
        grams = CharGrams(buf, off)
        total = np.zeros((len(grams.start) + 1, len(self.languages)), np.float32)
        for k, n in enumerate(ORDERS):
            h, at = grams.buckets(n, BITS)
            total[at] += self.logp[(k << BITS) + h]
        # grams belong to the word in which they start
        a, b = np.searchsorted(grams.start, s), np.searchsorted(grams.start, e)
        edge = np.stack((a, b), axis=1).ravel()
        sums = np.add.reduceat(total, edge, axis=0)[::2] if len(edge) else total[:0]
        return d, sums / len(ORDERS)

    def proportions(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        """documents x languages; zero for languages left out, and for documents without words."""
        docs, width = len(off) - 1, len(self.languages)
        d, logs = self.words(buf, off)
        out = np.zeros((docs, width))
        if not len(d) or not width:
            return out
        has, first = np.unique(d, return_index=True)
        own = np.repeat(np.arange(len(has)), np.diff(np.append(first, len(d))))
        n = np.diff(np.append(first, len(d))).astype(np.float64)
        top = logs.max(axis=1, keepdims=True)
        like = np.exp(logs - top)

        def em(mix, like, first, own, n):
            for _ in range(ROUNDS):
                r = mix[own] * like
                total = r.sum(axis=1, keepdims=True)
                r /= np.maximum(total, 1e-300)
                mix = np.add.reduceat(r, first, axis=0) / n[:, None]
            total = (mix[own] * like).sum(axis=1)
            return mix, np.add.reduceat(np.log(np.maximum(total, 1e-300)), first)

        mix, loss = em(np.full((len(has), width), 1 / width), like, first, own, n)
        active = np.arange(len(has))
        while len(active):                         # drop the least language where that costs less than it saves
            used = (mix[active] > 0).sum(axis=1)
            active = active[used > 1]
            if not len(active):
                break
            trial = mix[active].copy()
            least = np.where(trial > 0, trial, np.inf).argmin(axis=1)
            trial[np.arange(len(active)), least] = 0
            trial /= np.maximum(trial.sum(axis=1, keepdims=True), 1e-300)
            size = n[active].astype(np.int64)
            start = np.cumsum(size) - size
            rows = np.arange(int(size.sum())) + np.repeat(first[active] - start, size)
            trial, now = em(trial, like[rows], start, np.repeat(np.arange(len(active)), size), n[active])
            drop = loss[active] - now < 0.5 * np.log(n[active] + 1)
            took = active[drop]
            mix[took], loss[took] = trial[drop], now[drop]
            active = took
        out[has] = mix
        return out


def fit(docs: DataFrame, usable=lambda doc_id: F.lit(True), per_language: int = PER_LANGUAGE) -> Model:
    """Gram likelihoods from ``docs`` (doc_id, text, lang) with a non-null lang whose id ``usable`` accepts.

    About ``per_language`` documents of each language are read, chosen by a
    hash of the id; a language with fewer gives all.  Raises with more than
    ``MAX_LANGUAGES`` languages.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang")) \
        .where("lang IS NOT NULL AND text IS NOT NULL AND id IS NOT NULL").where(usable(F.col("id")))
    counts = rows.groupBy("lang").count().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = [r["lang"] for r in counts]
    if not languages:
        return Model([], np.zeros((len(ORDERS) << BITS, 0), np.float32))
    share = F.create_map(*[x for r in counts for x in (F.lit(r["lang"]), F.lit(min(1.0, per_language / r["count"])))])
    code = F.create_map(*[x for k, lang in enumerate(languages) for x in (F.lit(lang), F.lit(k))])
    picked = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20)) \
        .select("text", code[F.col("lang")].alias("k"))

    def run(batches):
        size = len(languages) * (len(ORDERS) << BITS)
        for batch in batches:
            buf, off = column_bytes(batch.column(0))
            lang = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            total = np.zeros(size, np.int64)
            for i, j in sub_batches(off, STEP):
                grams = CharGrams(buf[off[i]:off[j]], off[i:j + 1] - off[i])
                for k, n in enumerate(ORDERS):
                    h, at = grams.buckets(n, BITS)
                    key = (lang[i:j][grams.doc[at]] * len(ORDERS) + k) * (1 << BITS) + h
                    total += np.bincount(key, minlength=size)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["key", "n"])
    got = picked.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros(len(languages) * (len(ORDERS) << BITS))
    table[got["key"].to_numpy(np.int64)] = got["n"].to_numpy(float)
    table = table.reshape(len(languages), len(ORDERS), 1 << BITS) + 0.5
    table = np.log(table / table.sum(axis=2, keepdims=True))
    return Model(languages, np.ascontiguousarray(table.reshape(len(languages), -1).T).astype(np.float32))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score (the proportion of the text in that language) and ``languages``.

    ``languages`` maps each language of the chosen set to its proportion.  A
    text that is null or has no letter is ``und`` with score 0, as is every
    text if the model knows no language.  Rows are judged one by one, repeated
    or without doc_id alike; other columns are ignored; an empty table gives
    an empty result.
    """
    names = np.array([*model.languages, UNKNOWN], object)

    def run(batches):
        for batch in batches:
            buf, off = column_bytes(batch.column(1))
            letters = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            for i, j in sub_batches(off, STEP):
                p = model.proportions(buf[off[i]:off[j]], off[i:j + 1] - off[i])
                p[~letters[i:j]] = 0
                best = p.argmax(axis=1) if p.shape[1] else np.zeros(j - i, np.int64)
                top = p[np.arange(j - i), best] if p.shape[1] else np.zeros(j - i)
                best = np.where(top > 0, best, len(names) - 1)
                r, c = np.nonzero(p)
                at = np.concatenate(([0], np.cumsum(np.bincount(r, minlength=j - i)))).astype(np.int32)
                found = pa.MapArray.from_arrays(pa.array(at), pa.array(names[c], pa.string()), pa.array(p[r, c]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(names[best], pa.string()),
                     pa.array(np.clip(top, 0, 1)), found], ["doc_id", "lang_pred", "score", "languages"])
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                       F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("letters")) \
        .mapInArrow(run, "doc_id long, lang_pred string, score double, languages map<string,double>")
