"""Toxicity by weak supervision.

1. Lexicon.  In a bounded sample of the labelled training rows, words and word
   beginnings (``stem*``, so that inflected forms are met) are counted by
   label; the strongest become lexicon voters, beside pattern voters
   (several hits, dense hits, hits close together, shouting, exclamations),
   which vote alone where no term is strong enough.
2. Votes.  One pass over all whole texts counts the hits of every voter.
3. Label model.  A two-class generative model gives each voter a rate of
   voting in toxic and in clean documents (its accuracy), and pairs of voters
   a correlation inside the classes; a voter's evidence counts less the more
   others repeat it.  It is fitted by expectation maximisation over the
   distinct vote patterns of all documents, training rows held at their label.
4. Classifier.  A logistic regression on the hits and on statistics of the
   text is trained on the posterior labels of all documents, by Newton
   steps whose sums are taken per partition.

Labels of other rows, language, source and id never enter a score.

Defined results: null and empty texts are scored like a text without words;
null ids are scored and count as not held out; repeated rows get equal scores;
of several labels of an id the larger counts; without any training row of
label 1, every score is 0; where no document has one, every score is the
share of label 1 among the training rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from routelytics.llm.blocks import map_texts
from routelytics.llm.sums import bounded_labels, by_crc32, sigmoid, summed, vectors
from routelytics.session import RoundTables


@dataclass(frozen=True)
class ToxicityParams:
    #: labelled training rows that the lexicon and the held labels come from
    most_labelled: int = 40_000
    #: toxic documents a term needs
    least_toxic: int = 4
    voters: int = 96
    #: least ratio of a term's shares among toxic and clean documents
    least_ratio: float = 8.0
    #: least number of toxic documents times the log of that ratio
    least_evidence: float = 16.0
    stems: tuple = (4, 5, 6, 7)
    em_steps: int = 12
    newton_steps: int = 10
    ridge: float = 1.0
    threshold: float = 0.3


_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
#: Digits and signs written for letters.
_PLAIN = str.maketrans("013457@$", "oieastas")


def _fold(word: str) -> str:
    """A lower-case word without punctuation around it; letters for look-alikes in it."""
    w = _EDGE.sub("", word)
    return w.translate(_PLAIN) if w and not w.isdigit() and not w.isalpha() else w


def _terms(word: str, stems: tuple) -> list[str]:
    w = _fold(word)
    return [w, *(w[:k] + "*" for k in stems if len(w) > k)] if len(w) > 2 else []


def _count_terms(sample: DataFrame, stems: tuple) -> DataFrame:
    """(term, n1, n0): documents of ``sample`` (text, y) with label 1 and 0 that have each term."""
    def table(total):
        return pa.RecordBatch.from_arrays([pa.array([*total[1], *total[0]], pa.string()),
                                           pa.array([*total[1].values(), *[0] * len(total[0])], pa.int64()),
                                           pa.array([*[0] * len(total[1]), *total[0].values()], pa.int64())],
                                          names=["term", "n1", "n0"])

    def run(batches):
        total = {1: Counter(), 0: Counter()}
        cache: dict[str, list[str]] = {}
        for b in batches:
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = set()
                for w in set((t or "").lower().split()):
                    terms = cache.get(w)
                    if terms is None:
                        terms = _terms(w, stems)
                        if len(cache) > 100_000:
                            cache.clear()
                        cache[w] = terms
                    found.update(terms)
                total[int(y == 1)].update(found)
                if len(total[0]) + len(total[1]) > 300_000:
                    yield table(total)
                    total = {1: Counter(), 0: Counter()}
        yield table(total)
    rows = sample.select("text", "y").mapInArrow(run, "term string, n1 long, n0 long")
    return rows.groupBy("term").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))


def lexicon(docs: DataFrame, sample: DataFrame, p: ToxicityParams) -> list[str]:
    """Terms that speak for label 1, strongest first, none a longer form of another.

    ``sample`` (doc_id, y) has about ``most_labelled`` rows at most, so it is broadcast.
    Every term is counted under both labels and scored on Spark; the driver takes
    scored terms in falling order until ``voters`` are chosen.
    """
    n1, n0 = [sample.filter(F.col("y") == y).count() for y in (1, 0)]
    if not n1:
        return []
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(sample), "doc_id")
    ratio = (F.col("n1") / F.lit(float(n1))) / ((F.col("n0") + 0.5) / F.lit(n0 + 1.0))
    tables = RoundTables(docs.sparkSession, "toxicity-terms")
    scored, _ = tables.write(_count_terms(rows, p.stems).filter(F.col("n1") >= p.least_toxic).filter(ratio >= p.least_ratio)
                             .select("term", (F.col("n1") * F.log(ratio)).alias("evidence"))
                             .filter(F.col("evidence") >= p.least_evidence))
    chosen: list[str] = []
    for r in scored.orderBy(F.desc("evidence"), F.desc(F.length("term")), F.desc("term")).toLocalIterator():
        term = r.term
        stem = term.rstrip("*")
        if not any(stem.startswith(c[:-1]) if c.endswith("*") else (term.endswith("*") and c.startswith(stem)) or c == term
                   for c in chosen):
            chosen.append(term)
            if len(chosen) == p.voters:
                break
    tables.clear()
    return chosen


_STATS = ["log_words", "shout", "bang", "mean_length", "share_hits"]
_PATTERNS = ["repeated", "dense", "close", "shouting", "exclaiming"]
_VOTES = StructType([StructField("hits", ArrayType(IntegerType())), StructField("stats", ArrayType(DoubleType())),
                     StructField("patterns", ArrayType(IntegerType()))])


def _voter(terms: list[str], p: ToxicityParams):
    def make():
        index = {t: i for i, t in enumerate(terms)}
        m = len(terms)
        seen: dict[str, int] = {}  # word to voter, -1 for none

        def voter(w: str) -> int:
            k = next((index[x] for x in _terms(w, p.stems) if x in index), -1)
            if len(seen) > 300_000:
                seen.clear()
            seen[w] = k
            return k

        def one(t: str):
            words = t.lower().split()
            n = len(words)
            which = np.fromiter([seen[w] if w in seen else voter(w) for w in words], np.int32, n)
            at = np.flatnonzero(which >= 0)
            hits = np.bincount(which[at], minlength=m).astype(np.int32) if m else np.zeros(0, np.int32)
            shout = sum(len(w) > 2 and w.isupper() for w in t.split()) / n if n else 0.0
            bang = t.count("!") / n if n else 0.0
            stats = (np.log1p(n), shout, min(bang, 5.0), min(len(t) / n, 50.0) if n else 0.0, len(at) / n if n else 0.0)
            patterns = (int((hits > 1).any()), int(n > 0 and len(at) >= 0.01 * n and len(at) > 1),
                        int(len(at) > 1 and (np.diff(at) <= 12).any()), int(shout > 0.3), int(bang > 0.2))
            return hits, stats, patterns

        def f(texts):
            rows = [one(t) for t in texts]

            def lists(k, kind, d):
                flat = np.array([r[k] for r in rows]).reshape(len(rows), d).ravel()
                return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * d), pa.array(flat, kind))
            return [lists(0, pa.int32(), m), lists(1, pa.float64(), len(_STATS)), lists(2, pa.int32(), len(_PATTERNS))]
        return f
    return make


@dataclass
class LabelModel:
    prior: float
    rate: np.ndarray     # (2, m): share of documents of class 0 and 1 that a voter votes in
    weight: np.ndarray   # (m,): what is left of a voter's evidence beside those that repeat it

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        on = np.log(self.rate[1] / self.rate[0]) * self.weight
        off = np.log((1 - self.rate[1]) / (1 - self.rate[0])) * self.weight
        return sigmoid(np.log(self.prior / (1 - self.prior)) + votes @ (on - off) + off.sum())


def fit_label_model(patterns: DataFrame, m: int, start: LabelModel, steps: int) -> LabelModel:
    """Expectation maximisation over (votes, y, n): distinct vote patterns, their
    label where held (else null) and how many documents have them."""
    model = start
    for _ in range(steps):
        def expected(b, model=model):
            v, n = vectors(b.column(0)), b.column(2).to_numpy(zero_copy_only=False).astype(float)
            y = b.column(1).to_numpy(zero_copy_only=False).astype(float)
            g = np.where(np.isnan(y), model.posterior(v), y)
            out = [[(n * g).sum(), n.sum()]]
            for w in (n * (1 - g), n * g):
                out += [w @ v, ((v * w[:, None]).T @ v).ravel()]
            return np.concatenate(out)

        s = summed(patterns.select("votes", "y", "n"), 2 + 2 * (m + m * m), expected)
        mass = np.array([s[1] - s[0], s[0]])
        rate, corr = np.zeros((2, m)), []
        for c in range(2):
            at = 2 + c * (m + m * m)
            first, second = s[at:at + m], s[at + m:at + m + m * m].reshape(m, m)
            rate[c] = (first + 0.5 * (c + 0.05)) / (mass[c] + 1)
            mean = first / max(mass[c], 1e-9)
            cov = second / max(mass[c], 1e-9) - np.outer(mean, mean)
            sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            corr.append(np.clip(cov / np.outer(sd, sd), 0, 1))
        together = np.maximum(*corr)
        np.fill_diagonal(together, 0)
        # correlations below a tenth are noise of rare votes
        weight = 1 / (1 + np.where(together > 0.1, together, 0).sum(axis=1))
        model = LabelModel(float(np.clip(mass[1] / mass.sum(), 1e-4, 1 - 1e-4)), np.clip(rate, 1e-6, 1 - 1e-6), weight)
    return model


def fit_logistic(rows: DataFrame, d: int, steps: int, ridge: float) -> np.ndarray:
    """Weights (last: intercept) from (x: array<double> of d, y: double in 0..1)."""
    w = np.zeros(d + 1)
    for _ in range(steps):
        def newton(b, w=w):
            x = np.hstack([vectors(b.column(0)), np.ones((b.num_rows, 1))])
            y = b.column(1).to_numpy(zero_copy_only=False)
            q = sigmoid(x @ w)
            return np.concatenate([x.T @ (y - q), ((x * (q * (1 - q))[:, None]).T @ x).ravel()])

        s = summed(rows.select("x", "y"), (d + 1) + (d + 1) ** 2, newton)
        penalty = np.full(d + 1, ridge)
        penalty[-1] = 1e-6
        step = np.linalg.solve(s[d + 1:].reshape(d + 1, d + 1) + np.diag(penalty), s[:d + 1] - penalty * w)
        w = w + step * min(1.0, 4 / max(np.abs(step).max(), 1e-9))  # shortened as a whole: its direction descends
        if np.abs(step).max() < 1e-3:
            break
    return w


def _inputs(hits: np.ndarray, stats: np.ndarray, patterns: np.ndarray) -> np.ndarray:
    total = hits.sum(axis=1, keepdims=True)
    return np.hstack([np.log1p(hits), np.log1p(total), total > 0, stats, patterns])


def score(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> DataFrame:
    """(doc_id, held_out, score, predicted, posterior, n_hits) per row of ``docs``."""
    p = params
    tables = RoundTables(docs.sparkSession, "toxicity")
    sample, _ = tables.write(bounded_labels(labels, "toxic", by_crc32("doc_id", 4) != 2, p.most_labelled))
    shares = sample.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("n1")).first()
    held_out = F.coalesce(by_crc32("doc_id", 4) == 2, F.lit(False)).alias("held_out")

    def constant():
        base = float(shares.n1 or 0) / max(shares.n, 1)
        return docs.select("doc_id", held_out, F.lit(base).alias("score"), F.lit(int(base >= p.threshold)).alias("predicted"),
                           F.lit(base).alias("posterior"), F.lit(0).cast("long").alias("n_hits"))
    if not shares.n1:
        return constant()
    terms = lexicon(docs, sample, p)
    m = len(terms) + len(_PATTERNS)
    votes = map_texts(docs, _voter(terms, p), _VOTES, ["doc_id"])
    table, _ = tables.write(votes)
    held = F.broadcast(sample)  # bounded by most_labelled
    flags = F.concat(F.transform("hits", lambda h: F.least(h, F.lit(1))), "patterns")
    joined = table.join(held, "doc_id", "left").withColumn("votes", flags)
    patterns, _ = tables.write(joined.groupBy("votes", F.col("y").cast("double").alias("y")).agg(F.count(F.lit(1)).alias("n")))

    # start from the label shares of the training rows alone
    def counted(b):
        v, n = vectors(b.column(0)), b.column(2).to_numpy(zero_copy_only=False).astype(float)
        y = b.column(1).to_numpy(zero_copy_only=False).astype(float)
        return np.concatenate([[n[y == c].sum(), *(n[y == c] @ v[y == c])] for c in (0, 1)])
    s = summed(patterns.filter("y is not null").select("votes", "y", "n"), 2 * (m + 1), counted).reshape(2, m + 1)
    if not s[1, 0]:
        return constant()
    rate = (s[:, 1:] + np.array([[0.02], [0.5]])) / (s[:, :1] + 1)
    start = LabelModel(float(np.clip(shares.n1 / shares.n, 1e-4, 1 - 1e-4)), np.clip(rate, 1e-6, 1 - 1e-6), np.full(m, 0.5))
    model = fit_label_model(patterns, m, start, p.em_steps)

    d = len(terms) + 2 + len(_STATS) + len(_PATTERNS)

    def labelled(batches):
        for b in batches:
            v, y = vectors(b.column(0)), b.column(4).to_numpy(zero_copy_only=False).astype(float)
            g = np.where(np.isnan(y), model.posterior(v), y)
            x = _inputs(*(vectors(b.column(k)) for k in (1, 2, 3)))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * d), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([lists, pa.array(g)], names=["x", "y"])
    train, _ = tables.write(joined.select("votes", "hits", "stats", "patterns", F.col("y").cast("double"))
                            .mapInArrow(labelled, "x array<double>, y double"))
    w = fit_logistic(train, d, p.newton_steps, p.ridge)

    def scored(batches):
        for b in batches:
            h, st, pt = (vectors(b.column(k)) for k in (1, 2, 3))
            x = _inputs(h, st, pt)
            s = sigmoid(x @ w[:-1] + w[-1])
            g = model.posterior(np.hstack([h > 0, pt]).astype(float))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s), pa.array(g), pa.array(h.sum(axis=1).astype(np.int64))],
                                             names=["doc_id", "score", "posterior", "n_hits"])
    kind = table.schema["doc_id"].dataType.simpleString()
    out = table.select("doc_id", "hits", "stats", "patterns").mapInArrow(
        scored, f"doc_id {kind}, score double, posterior double, n_hits long")
    return out.select("doc_id", held_out, "score", (F.col("score") >= p.threshold).cast("int").alias("predicted"),
                      "posterior", "n_hits")
