"""Importance resampling towards a target distribution, by an Aho-Corasick dictionary.

Words (runs of digits, letters and all non-ASCII characters, A-Z in lower case)
and pairs of neighbouring words are features; a feature's bucket is the crc32
of its bytes modulo ``buckets``.  Bucket counts of all documents and of the target texts
give each bucket a gain, a document weighs the mean gain of its features, and
the highest weights plus Gumbel noise are drawn.

* A task keeps a dictionary of distinct words, each between two delimiters, with
  the crc32 and length of the word as payload.  One automaton scan over a block
  of texts emits the payloads in order; words that the automaton does not know
  yet are found as the stretches it left uncovered and join it later, so no word
  is lost.  Beyond ``most_words`` words the dictionary begins anew.
* A pair's crc32 is composed from the payloads of its words: crc32 is linear, so
  crc(a + " " + b) = shift(crc(a + " "), length(b)) xor crc(b), where the shift by
  a length is a table look-up.  No pair is ever built as text.
* Both passes (counting, scoring) are narrow; ``buckets`` sums reach the driver.
  The draw ranks (score, id) rows by range partitions, not in one task.

Defined results: null, empty and wordless texts have no features and weight 0;
a null id has no score and is never drawn; rows that repeat an id count and are
drawn each by their own text (equal ones in any order); empty documents or
benchmarks are counts of 0; extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from routelytics.llm.blocks import map_texts, text_blocks
from routelytics.llm.sums import summed
from routelytics.operators.airports import dense_index
from routelytics.session import RoundTables


@dataclass(frozen=True)
class ResampleParams:
    buckets: int = 10_000
    least_words: int = 20
    percent: int = 25
    seed: int = 7
    most_words: int = 200_000


#: bytes of words as they are (A-Z in lower case), all others the delimiter
_CLEAN = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


class CrcShift:
    """crc32 of a text with as many bytes appended, before they are xored in."""

    def __init__(self, short: int = 64):
        poly, table = 0xEDB88320, []
        for b in range(256):
            for _ in range(8):
                b = (b >> 1) ^ (poly if b & 1 else 0)
            table.append(b)
        table = np.array(table, np.uint32)
        basis = np.uint32(1) << np.arange(32, dtype=np.uint32)  # images of the 32 bits
        self.bases = [basis]
        for _ in range(short):
            basis = (basis >> np.uint32(8)) ^ table[basis & np.uint32(255)]
            self.bases.append(basis)
        self.short = short
        self.tables = np.stack([self._bytes(b) for b in self.bases])

    @staticmethod
    def _bytes(basis: np.ndarray) -> np.ndarray:
        """(4, 256) images of each value of each byte."""
        out = np.zeros((4, 256), np.uint32)
        for k in range(4):
            for bit in range(8):
                on = (np.arange(256) >> bit & 1).astype(bool)
                out[k, on] ^= basis[8 * k + bit]
        return out

    @staticmethod
    def _apply(t: np.ndarray, crc: np.ndarray) -> np.ndarray:
        out = t[0][crc & np.uint32(255)]
        for k in (1, 2, 3):
            out = out ^ t[k][crc >> np.uint32(8 * k) & np.uint32(255)]
        return out

    def _long(self, length: int) -> np.ndarray:
        """Tables of a long length, by repeated squaring."""
        basis, power = self.bases[0], self.bases[1]
        while length:
            if length & 1:
                basis = self._apply(self._bytes(power), basis)
            power = self._apply(self._bytes(power), power)
            length >>= 1
        return self._bytes(basis)

    def __call__(self, crc: np.ndarray, length: np.ndarray) -> np.ndarray:
        at = np.minimum(length, self.short)
        out = np.zeros(len(crc), np.uint32)
        for k in range(4):
            out ^= self.tables[at, k, crc >> np.uint32(8 * k) & np.uint32(255)]
        for n in np.unique(length[length > self.short]):
            mine = length == n
            out[mine] = self._apply(self._long(int(n)), crc[mine])
        return out


class WordDictionary:
    """Distinct words with payloads, most of them in an automaton."""

    def __init__(self, most_words: int):
        self.most = most_words
        self._clear()

    def _clear(self):
        import ahocorasick
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        self.late: dict[bytes, int] = {}  # words that are not in the automaton yet
        self.crc, self.length = np.zeros(1024, np.uint32), np.zeros(1024, np.int64)
        self.size = 0

    def _new(self, word: bytes) -> int:
        if self.size == len(self.crc):
            self.crc, self.length = (np.concatenate([a, np.zeros_like(a)]) for a in (self.crc, self.length))
        at = self.late[word] = self.size
        self.crc[at], self.length[at] = zlib.crc32(word), len(word)
        self.size += 1
        return at

    def payloads(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(crc, length) of all words of the texts in order, and the number of words of each text."""
        if self.size > self.most:
            self._clear()
        clean = [t.encode("utf-8", "surrogatepass").translate(_CLEAN) for t in texts]
        block = b" " + b" ".join(clean) + b" "
        inside = np.frombuffer(block, np.uint8) != 32
        starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
        ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
        edges = np.cumsum([1] + [len(c) + 1 for c in clean])
        words = np.diff(np.searchsorted(starts, edges))
        known = np.full(len(starts), -1, np.int64)
        if len(self.automaton):
            hits = np.fromiter(chain.from_iterable(self.automaton.iter(block.decode("latin-1"))), np.int64).reshape(-1, 2)
            known[np.searchsorted(starts, hits[:, 0] - self.length[hits[:, 1]])] = hits[:, 1]
        for i in np.flatnonzero(known < 0):
            w = block[starts[i]:ends[i]]
            at = self.late.get(w)
            known[i] = self._new(w) if at is None else at
        crc, length = self.crc[known], self.length[known]
        if len(self.late) > 500 + len(self.automaton) // 8:
            for w, at in self.late.items():
                self.automaton.add_word(f" {w.decode('latin-1')} ", at)
            self.automaton.make_automaton()
            self.late = {}
        return crc, length, words


class BucketsOf:
    """Buckets of the features of texts; lives as long as its task."""

    def __init__(self, p: ResampleParams):
        self.p, self.words = p, None

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(buckets, text number of each, words per text)."""
        if self.words is None:
            self.words, self.shift = WordDictionary(self.p.most_words), CrcShift()
            self.blank = np.uint32(zlib.crc32(b" "))
        crc, length, n = self.words.payloads(texts)
        owner = np.repeat(np.arange(len(texts)), n)
        pairs = np.flatnonzero(owner[1:] == owner[:-1])
        # a word, then the space, then the next word
        spaced = self.shift(crc[pairs], np.ones(len(pairs), np.int64)) ^ self.blank
        two = self.shift(spaced, length[pairs + 1]) ^ crc[pairs + 1]
        return (np.concatenate([crc, two]) % np.uint32(self.p.buckets)).astype(np.int64), np.concatenate([owner, owner[pairs]]), n


def bucket_counts(texts: DataFrame, p: ResampleParams, text_col: str = "text") -> np.ndarray:
    """Features of all texts in each bucket."""
    buckets_of = BucketsOf(p)

    def add(batch):
        total = np.zeros(p.buckets)
        for _, block in text_blocks(iter([batch]), 3 << 20):
            total += np.bincount(buckets_of(block)[0], minlength=p.buckets)
        return total

    return summed(texts.select(F.col(f"`{text_col}`").cast("string").alias("text")), p.buckets, add)


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(share in the target / share in the corpus)) of each bucket, shares smoothed by one."""
    n, s, t = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((b + 1) * (s + n) / ((a + 1) * (t + n))))
                     for a, b in zip(corpus.tolist(), target.tolist())], np.int64)


_WEIGHTS = StructType([StructField(c, LongType()) for c in ("n_words", "n_features", "weight")])


def weights(docs: DataFrame, gain: np.ndarray, p: ResampleParams, id_col: str = "doc_id") -> DataFrame:
    """(id, n_words, n_features, weight) of every row."""
    def make():
        buckets_of = BucketsOf(p)

        def f(texts):
            buckets, owner, n = buckets_of(texts)
            features = np.bincount(owner, minlength=len(texts))
            total = np.zeros(len(texts), np.int64)
            np.add.at(total, owner, gain[buckets])
            return [n.tolist(), features.tolist(), (total // np.maximum(features, 1)).tolist()]
        return f
    return map_texts(docs, make, _WEIGHTS, [id_col])


def resample(docs: DataFrame, target: DataFrame, p: ResampleParams = ResampleParams(), id_col: str = "doc_id") -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row; rank is null for rows not drawn."""
    gain = gains(bucket_counts(docs, p), bucket_counts(target, p))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{p.seed}:"), F.col("doc_id").cast("string")), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = weights(docs, gain, p, id_col).withColumnRenamed(id_col, "doc_id").withColumn("score", F.col("weight") + noise)
    may = F.col("doc_id").isNotNull() & (F.col("n_words") >= p.least_words)
    scored, seen = RoundTables(docs.sparkSession, "resample").write(scored, n=F.count_if(may))
    drawn = p.percent * seen["n"] // 100
    order = F.struct((-F.col("score")).alias("s"), F.col("doc_id"), F.col("n_features"))
    ranked = dense_index(scored.filter(may).withColumn("order", order), "order", "at").drop("order")
    rank = F.when(F.col("at") < drawn, F.col("at") + 1).cast("long").alias("rank")
    rest = scored.filter(~may).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*scored.columns, rank).unionByName(rest)


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Columns of the op11 contract."""
    return resample(docs, benchmark).select("doc_id", "n_features", "weight", "score", "rank", "n_words")
