"""Quality classifier: ridge regression on random Fourier features, isotonic calibration.

Statistics of each whole text (shares of symbols, capitals, repeated lines and
words, lengths, ...) are standardised and mapped to random Fourier features,
whose inner products approximate a Gaussian kernel.  The normal equations of
the ridge fit are sums over partitions of the labelled rows, kept for two
folds: each fold's rows are scored by the other fold's fit, and these
out-of-fold scores calibrate the final fit by isotonic regression over a fixed
grid of score bins (again sums; pool-adjacent-violators on the grid).

Labels of other rows, language, source and id never enter a score.  The fit
takes a bounded, evenly thinned sample of the training labels
(``most_labelled``); scoring covers every row, in one pass over the texts.

Defined results: null and empty texts have all statistics 0 and are scored;
null ids are scored and count as not held out; repeated rows get equal scores;
of several labels of an id the larger counts; without training rows of both
labels every score is the share of label 1 (0 without rows); extra columns
are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from routelytics.llm.blocks import map_texts
from routelytics.llm.sums import bounded_labels, by_crc32, summed, vectors
from routelytics.session import RoundTables


@dataclass(frozen=True)
class ClassifierParams:
    most_labelled: int = 60_000
    features: int = 256
    #: width of the Gaussian kernel in standard deviations
    width: float = 3.0
    ridge: float = 1.0
    bins: int = 2000
    seed: int = 11
    threshold: float = 0.3


STATS = ["log_words", "log_lines", "word_length", "word_length_sd", "longest_word", "symbols", "pipes", "bangs", "upper_words",
         "upper_letters", "digits", "commas", "stops", "short_words", "distinct_words", "repeated_lines", "repeated_pairs",
         "line_words", "non_ascii"]
_D = len(STATS)
_X = StructType([StructField("x", ArrayType(DoubleType()))])


def statistics(text: str) -> tuple:
    """The numbers of STATS; all 0 for a text without words."""
    words = text.split()
    n = len(words)
    if not n:
        return (0.0,) * _D
    chars = len(text)
    lens = np.fromiter(map(len, words), np.float64, n)
    seen: dict[str, int] = {}
    ids = np.fromiter([seen.setdefault(w, len(seen)) for w in words], np.int64, n)
    pairs = ids[:-1] * len(seen) + ids[1:]
    upper = sum(map(str.isupper, words))
    letters = sum(text.count(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    digits = sum(text.count(c) for c in "0123456789")
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    plain = len(text.encode("utf-8", "surrogatepass")) - chars
    return (np.log1p(n), np.log1p(len(lines)), lens.mean(), lens.std(), np.log1p(lens.max()),
            np.log1p(20 * sum(text.count(c) for c in "#*$%&<>") / n), np.log1p(20 * text.count("|") / n),
            np.log1p(20 * text.count("!") / n), upper / n, letters / chars, np.log1p(20 * digits / n),
            text.count(",") / n, text.count(".") / n, float((lens <= 3).mean()), len(seen) / n / (1 + 0.1 * np.log(n)),
            1 - len(set(lines)) / max(len(lines), 1), 1 - len(np.unique(pairs)) / len(pairs) if len(pairs) else 0.0,
            np.log1p(n / max(len(lines), 1)), plain / chars)


def _statistics():
    def f(texts):
        flat = np.array([statistics(t) for t in texts], np.float64).reshape(len(texts), _D).ravel()
        return [pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * _D), pa.array(flat))]
    return f


@dataclass
class Fourier:
    """Standardised statistics to random Fourier features and a constant."""
    mean: np.ndarray
    sd: np.ndarray
    freq: np.ndarray
    phase: np.ndarray

    @classmethod
    def draw(cls, mean, sd, p: ClassifierParams) -> Fourier:
        rng = np.random.default_rng(p.seed)
        return cls(mean, sd, rng.normal(0, 1 / p.width, (len(mean), p.features)), rng.uniform(0, 2 * np.pi, p.features))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.sd, -6, 6)
        return np.hstack([np.sqrt(2 / self.freq.shape[1]) * np.cos(z @ self.freq + self.phase), np.ones((len(x), 1))])


def isotonic(y: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Non-decreasing values for cells with label sums ``y`` and sizes ``n``, least
    squares; cells without rows take the value of the block on their left (or the first)."""
    blocks: list[list] = []  # [sum, size, cells]
    for a, b in zip(y, n):
        if b == 0:
            if blocks:
                blocks[-1][2] += 1
            else:
                blocks.append([0.0, 0.0, 1])
            continue
        blocks.append([float(a), float(b), 1])
        while len(blocks) > 1 and (blocks[-2][1] == 0 or blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]):
            last = blocks.pop()
            for k in range(3):
                blocks[-1][k] += last[k]
    return np.concatenate([np.full(c, a / b if b else 0.0) for a, b, c in blocks]) if blocks else np.zeros(0)


def _bin(raw: np.ndarray, bins: int) -> np.ndarray:
    return np.clip(((raw + 0.5) / 2 * bins).astype(np.int64), 0, bins - 1)


def score(docs: DataFrame, labels: DataFrame, params: ClassifierParams = ClassifierParams()) -> DataFrame:
    """(doc_id, held_out, score, predicted, raw) per row of ``docs``."""
    p = params
    tables = RoundTables(docs.sparkSession, "quality-classifier")
    sample, _ = tables.write(bounded_labels(labels, "quality", by_crc32("doc_id", 5) != 0, p.most_labelled))
    shares = sample.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("n1")).first()
    held_out = F.coalesce(by_crc32("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    n1 = int(shares.n1 or 0)
    if n1 in (0, shares.n):
        base = n1 / max(shares.n, 1)
        return docs.select("doc_id", held_out, F.lit(base).alias("score"), F.lit(int(base >= p.threshold)).alias("predicted"),
                           F.lit(base).alias("raw"))
    table, _ = tables.write(map_texts(docs, _statistics, _X, ["doc_id"]))
    # the sample is bounded: it is broadcast, and its rows, once found, fit a few partitions
    train, _ = tables.write(table.join(F.broadcast(sample), "doc_id").select(
        "x", F.col("y").cast("double").alias("y"), F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(2)).cast("int").alias("fold")).repartition(8))

    def moments(b):
        x = vectors(b.column(0))
        return np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)])
    s = summed(train.select("x"), 1 + 2 * _D, moments)
    if not s[0]:  # labelled ids without a document
        base = n1 / shares.n
        return table.select("doc_id", held_out, F.lit(base).alias("score"), F.lit(int(base >= p.threshold)).alias("predicted"),
                            F.lit(base).alias("raw"))
    mean = s[1:1 + _D] / s[0]
    fourier = Fourier.draw(mean, np.sqrt(np.maximum(s[1 + _D:] / s[0] - mean ** 2, 0)) + 1e-3, p)
    d = p.features + 1

    def normal(b):
        z, y, fold = fourier(vectors(b.column(0))), b.column(1).to_numpy(zero_copy_only=False), b.column(2).to_numpy(zero_copy_only=False)
        return np.concatenate([np.concatenate([(z[fold == k].T @ z[fold == k]).ravel(), z[fold == k].T @ y[fold == k]]) for k in (0, 1)])
    s = summed(train, 2 * (d * d + d), normal).reshape(2, -1)
    penalty = np.diag(np.append(np.full(p.features, p.ridge), 1e-6))

    def solve(t):
        return np.linalg.solve(t[:d * d].reshape(d, d) + penalty, t[d * d:])
    by_fold, w = np.stack([solve(s[1]), solve(s[0])]), solve(s[0] + s[1])

    def binned(b):
        z, y, fold = fourier(vectors(b.column(0))), b.column(1).to_numpy(zero_copy_only=False), b.column(2).to_numpy(zero_copy_only=False)
        at = _bin((z * by_fold[fold]).sum(1), p.bins)
        return np.concatenate([np.bincount(at, y, p.bins), np.bincount(at, minlength=p.bins)])
    s = summed(train, 2 * p.bins, binned)
    level = isotonic(s[:p.bins], s[p.bins:])

    def scored(batches):
        for b in batches:
            raw = fourier(vectors(b.column(1))) @ w
            # a trace of the raw score keeps the order inside a calibrated step
            final = 0.998 * level[_bin(raw, p.bins)] + 0.002 * np.clip((raw + 0.5) / 2, 0, 1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(final), pa.array(raw)], names=["doc_id", "score", "raw"])
    kind = table.schema["doc_id"].dataType.simpleString()
    out = table.select("doc_id", "x").mapInArrow(scored, f"doc_id {kind}, score double, raw double")
    return out.select("doc_id", held_out, "score", (F.col("score") >= p.threshold).cast("int").alias("predicted"), "raw")
