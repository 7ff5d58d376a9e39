"""Token counts by rank-synchronous array merging.

The distinct pre-tokens of a block of texts are held as one ragged numpy array
of symbols.  In each step every sequence applies its own lowest-rank pair at
all its places at once, the arrays are compacted, and sequences without a
mergeable pair drop out with their number of surviving symbols.  Steps are as
many as the longest chain of merges in a sequence, not as its length times
that of the block.

Counts equal those of merging the leftmost lowest pair again and again: a
merge can be applied everywhere at once unless its result is part of a pair of
lower rank; such merges are found when the file is loaded and applied at one
place a step.

Normalisation and splitting follow the file: special tokens are cut out
first and count as one; the rest is composed (NFC), lower-cased code point by
code point and split into contractions, letters, single digits and runs of
other characters.

Defined results: null and empty texts have no tokens and zero bytes; null ids
and repeated rows are counted each by their text; a text of any length is
counted whole; extra columns are ignored.
"""

from __future__ import annotations

import json
import unicodedata
from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from routelytics.llm.blocks import map_texts

BLOCK_CHARS = 8 << 20
_SHIFT = 20
#: Lower case where str.lower() differs from code point by code
#: point (sigma at a word's end) or lags behind the library's Unicode version.
_LOWER = [("\u03a3", "\u03c3"), ("\ua7cb", "\u0264"), ("\ua7dc", "\u019b")]


def _byte_letters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary:
    itself where it is printable, else the next free one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, free = [], 256
    for b in range(256):
        if b in shown:
            out.append(chr(b))
        else:
            out.append(chr(free))
            free += 1
    return out


@dataclass
class Merges:
    """Tables of a tokenizer file of kind BPE with byte letters and a word end."""
    specials: list[str]
    split: str
    inner: np.ndarray    # byte to symbol
    last: np.ndarray     # byte to symbol at a word's end
    pair_key: np.ndarray
    pair_rank: np.ndarray
    result: np.ndarray   # rank to symbol
    one_by_one: np.ndarray

    @classmethod
    def read(cls, path: str) -> Merges:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        letters = _byte_letters()
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or model["type"] != "BPE":
            raise ValueError(f"not a tokenizer of the expected kind: {kinds}, {model['type']}")
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"]
        a, b, c = [], [], []
        for m in model["merges"]:
            x, y = m if isinstance(m, list) else m.split(" ")
            a.append(vocab[x])
            b.append(vocab[y])
            c.append(vocab[x + y])
        a, b, c = np.array(a, np.int64), np.array(b, np.int64), np.array(c, np.int64)
        key = a << _SHIFT | b
        order = np.argsort(key, kind="stable")
        # a merge is safe at many places at once if every pair with its result comes later
        least = np.full(max(vocab.values()) + 1, len(c))
        np.minimum.at(least, a, np.arange(len(c)))
        np.minimum.at(least, b, np.arange(len(c)))
        return cls([t["content"] for t in spec["added_tokens"]], split,
                   np.array([vocab[x] for x in letters], np.int32), np.array([vocab[x + end] for x in letters], np.int32),
                   key[order], order.astype(np.int32), c.astype(np.int32), least[c] < np.arange(len(c)))

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, or the number of merges where it has none."""
        key = a.astype(np.int64) << _SHIFT | b
        k = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where(self.pair_key[k] == key, self.pair_rank[k], len(self.result)).astype(np.int32)


def surviving(words: list[bytes], m: Merges) -> np.ndarray:
    """Symbols that are left of each (non-empty) word after all its merges."""
    out = np.ones(len(words), np.int64)
    if not words:
        return out
    none = len(m.result)
    size = np.fromiter(map(len, words), np.int64, len(words))
    raw = np.frombuffer(b"".join(words), np.uint8)
    sym = m.inner[raw]
    ends = np.cumsum(size) - 1
    sym[ends] = m.last[raw[ends]]
    seq = np.arange(len(words))
    rank = np.full(len(sym), none, np.int32)  # of the pair that begins here
    rank[:-1] = m.ranks(sym[:-1], sym[1:])
    rank[ends] = none
    while len(sym):
        start = np.concatenate([[0], np.cumsum(size)[:-1]])
        low = np.minimum.reduceat(rank, start)
        # sequences that are done leave with their length
        live = low < none
        if not live.all():
            out[seq[~live]] = size[~live]
            keep = np.repeat(live, size)
            sym, rank, size, seq, low = sym[keep], rank[keep], size[live], seq[live], low[live]
            if not len(sym):
                break
            start = np.concatenate([[0], np.cumsum(size)[:-1]])
        here = rank == np.repeat(low, size)
        # of places that share a symbol every other one, from the left
        at = np.flatnonzero(here)
        near = np.concatenate([[False], at[1:] == at[:-1] + 1])
        if near.any():
            run = np.arange(len(at))
            run -= np.maximum.accumulate(np.where(near, 0, run))
            at = at[run % 2 == 0]
        single = m.one_by_one[rank[at]]
        if single.any():  # only the first place of the sequence
            of = np.searchsorted(start, at, side="right")
            first = np.concatenate([[True], of[1:] != of[:-1]])
            at = at[~single | first]
        sym[at] = m.result[rank[at]]
        size = size - np.add.reduceat(np.bincount(at, minlength=len(sym)), start)
        alive = np.ones(len(sym), bool)
        alive[at + 1] = False
        place = np.cumsum(alive)[at] - 1
        sym, rank = sym[alive], rank[alive]
        touched = np.unique(np.concatenate([place, place[place > 0] - 1]))
        nxt = np.minimum(touched + 1, len(sym) - 1)
        rank[touched] = m.ranks(sym[touched], sym[nxt])
        rank[np.cumsum(size) - 1] = none
    return out


class Counter:
    """Token counts of a block of texts."""

    def __init__(self, m: Merges):
        self.m = m
        self.find = regex.compile(m.split).findall
        self.specials = regex.compile("|".join(map(regex.escape, m.specials))) if m.specials else None

    def _words(self, text: str) -> tuple[int, list[str]]:
        special, parts = 0, [text]
        if self.specials and any(s in text for s in self.m.specials):
            special, parts = len(self.specials.findall(text)), self.specials.split(text)
        words: list[str] = []
        for t in parts:
            if not t.isascii():
                t = unicodedata.normalize("NFC", t)
                for upper, lower in _LOWER:
                    t = t.replace(upper, lower)
            words += self.find(t.lower())
        return special, words

    def __call__(self, texts: list[str]) -> list[int]:
        seen: dict[str, int] = {}
        rows, extra = [], []
        for t in texts:
            special, words = self._words(t)
            extra.append(special)
            rows.append(np.fromiter([seen.setdefault(w, len(seen)) for w in words], np.int32, len(words)))
        count = surviving([w.encode("utf-8", "surrogatepass") for w in seen], self.m)
        return [n + int(count[r].sum()) for n, r in zip(extra, rows)]


_COUNTS = StructType([StructField("n_bytes", LongType()), StructField("n_tokens", LongType()),
                      StructField("over_limit", BooleanType())])


def token_counts(docs: DataFrame, path: str, limit: int = 2048, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default doc_id), n_bytes, n_tokens and over_limit of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(Merges.read(path))

    def make():
        counter = Counter(shared.value)

        def f(texts):
            n = counter(texts)
            return [[len(t.encode("utf-8", "surrogatepass")) for t in texts], n, [x > limit for x in n]]
        return f
    return map_texts(docs, make, _COUNTS, keep or ["doc_id"], block_chars=BLOCK_CHARS)
