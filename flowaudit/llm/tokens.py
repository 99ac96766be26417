"""Byte-level BPE of whole Arrow batches with a public tokenizer file.

Where the file is plain byte-level BPE whose merges stand in the order of their
ids, texts of the characters below U+0180 (control characters aside) and
without very long words or blanks are encoded by tiktoken from the file's own
ranks, which gives the same ids in a third of the time.  All others go
through the tokenizer itself:

A text is cut before every space that follows a character that is surely not
white space.  The tokenizer's own pattern always starts a piece there, so the
ids of the cuts, one after another, are the ids of the text.  Each distinct
cut of a batch is encoded once; a bounded table per worker keeps them.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa

from .textops import RangeHash, runs_of, slices, sub_batches

END_OF_DOCUMENT = 1
STEP = 1 << 20
KEEP = 1 << 20            # distinct cuts remembered per worker
LONG_RUN = 2048           # bytes of a word or a blank beyond which a text is left to the tokenizer
#: The pattern by which byte-level BPE splits a text (fixed value).
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def public_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def cut_points(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Starts of the cuts, document starts included."""
    n = len(buf)
    space = np.flatnonzero(buf == 0x20)
    space = space[space > 0]
    one = buf[space - 1]
    two = buf[np.maximum(space - 2, 0)]
    three = buf[np.maximum(space - 3, 0)]
    # an ASCII mark, or the end of a letter of two or three bytes outside the blocks that hold white space
    safe = ((one > 0x20) & (one < 0x7F)) | ((one >= 0x80) & (one < 0xC0) & (
        ((two >= 0xC3) & (two < 0xE0)) | ((two >= 0x80) & (two < 0xC0) & (three >= 0xE4) & (three < 0xF0))))
    first = off[:-1][np.diff(off) > 0]
    cut = np.zeros(n, bool)
    cut[space[safe]] = True
    cut[first] = True
    return np.flatnonzero(cut)


def ranked_tokens(path: str):
    """tiktoken encoding with the ranks of a tokenizer file, or None if the file is not plain ranked byte-level BPE."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model, split = file["model"], file.get("pre_tokenizer") or {}
    plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    if model.get("type") != "BPE" or file.get("normalizer") or {k: split.get(k) for k in plain} != plain or any(
            model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
        return None
    if any(t.get(k) for t in file["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")):
        return None
    vocab, added = model["vocab"], {t["content"]: t["id"] for t in file["added_tokens"]}
    merged = [vocab["".join(m) if isinstance(m, list) else m.replace(" ", "", 1)] for m in model["merges"]]
    # printable bytes stand for themselves, the others for the code points from 256 on
    shown = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 173 or b >= 174]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    tokens = {t: i for t, i in vocab.items() if t not in added}
    if any(a >= b for a, b in zip(merged, merged[1:])) or len(merged) + 256 != len(tokens) or not all(
            c in byte for t in tokens for c in t):
        return None
    import tiktoken
    return tiktoken.Encoding("file", pat_str=PIECES, special_tokens=added,
                             mergeable_ranks={bytes(byte[c] for c in t): i for t, i in tokens.items()})


def plain_texts(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Which documents have only characters below U+0180, no separators of files or records, and no long runs."""
    odd = (buf >= 0xC6) | ((buf >= 0x1C) & (buf <= 0x1F))
    odd[1:] |= (buf[1:] == 0x85) & (buf[:-1] == 0xC2)
    blank = (buf == 0x20) | ((buf >= 0x09) & (buf <= 0x0D))
    for mask in (blank, ~blank):
        a, b = runs_of(mask)
        long = b - a > LONG_RUN
        odd[slices(a[long], (b - a)[long])] = True
    count = np.concatenate(([0], np.cumsum(odd)))
    return count[off[1:]] == count[off[:-1]]


class Encoder:
    """ids of texts; made once per worker and tokenizer file."""

    _made: dict[str, "Encoder"] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.ranked = ranked_tokens(path)
        self._forget()

    @classmethod
    def of(cls, path: str) -> "Encoder":
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def _forget(self):
        self.keys = np.zeros(0, np.uint64)
        self.start = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _learn(self, keys: np.ndarray, texts: list[str]):
        made = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        size = np.fromiter(map(len, made), np.int64, len(made))
        flat = np.fromiter((i for ids in made for i in ids), np.uint32, int(size.sum()))
        start = len(self.pool) + np.cumsum(size) - size
        keys = np.concatenate((self.keys, keys))
        order = np.argsort(keys)
        self.keys = keys[order]
        self.start = np.concatenate((self.start, start))[order]
        self.size = np.concatenate((self.size, size))[order]
        self.pool = np.concatenate((self.pool, flat))

    def encode(self, buf: np.ndarray, off: np.ndarray):
        """(ids, offsets) of the documents of a buffer."""
        if self.ranked is None:
            return self.by_cuts(buf, off)
        size = np.diff(off)
        plain = plain_texts(buf, off)
        made: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(size)
        for i in np.flatnonzero(plain & (size > 0)).tolist():
            made[i] = self.ranked.encode_to_numpy(buf[off[i]:off[i + 1]].tobytes().decode(), allowed_special="all")
        rest = np.flatnonzero(~plain)
        if len(rest):
            ids, at = self.by_cuts(buf[slices(off[rest], size[rest])], np.concatenate(([0], np.cumsum(size[rest]))))
            for k, i in enumerate(rest.tolist()):
                made[i] = ids[at[k]:at[k + 1]]
        counts = np.fromiter(map(len, made), np.int64, len(made))
        return (np.concatenate(made).astype(np.uint32, copy=False) if made else np.zeros(0, np.uint32),
                np.concatenate(([0], np.cumsum(counts))))

    def by_cuts(self, buf: np.ndarray, off: np.ndarray):
        """The same through the tokenizer, each distinct cut of the batch once."""
        cuts = cut_points(buf, off)
        ends = np.append(cuts[1:], len(buf)) if len(cuts) else cuts
        keys, first, which = np.unique(RangeHash(buf).of(cuts, ends), return_index=True, return_inverse=True)
        if len(self.keys) > KEEP:
            self._forget()
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        new = np.flatnonzero(self.keys[at] != keys) if len(self.keys) else np.arange(len(keys))
        if len(new):
            f = first[new]
            size = ends[f] - cuts[f]
            data = buf[slices(cuts[f], size)]
            o = np.concatenate(([0], np.cumsum(size)))
            texts = pa.Array.from_buffers(pa.large_string(), len(f), [
                None, pa.py_buffer(o.tobytes()), pa.py_buffer(data.tobytes())]).to_pylist()
            self._learn(keys[new], texts)
            at = np.searchsorted(self.keys, keys)
        count = self.size[at][which]
        ids = self.pool[slices(self.start[at][which], count)]
        ends_at = np.concatenate(([0], np.cumsum(count)))
        return ids, ends_at[np.searchsorted(cuts, off)]

    def documents(self, buf: np.ndarray, off: np.ndarray, end_id: int = END_OF_DOCUMENT):
        """Yields (first, last, ids, offsets) for ranges of documents, each closed by ``end_id``."""
        for i, j in sub_batches(off, STEP):
            ids, at = self.encode(buf[off[i]:off[j]], off[i:j + 1] - off[i])
            n = np.diff(at)
            o = np.concatenate(([0], np.cumsum(n + 1)))
            out = np.full(int(o[-1]), end_id, np.uint32)
            out[slices(o[:-1], n)] = ids
            yield i, j, out, o
