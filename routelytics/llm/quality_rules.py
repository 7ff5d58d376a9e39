"""Quality rules: fixed base rules and robust multivariate outliers.

Every document gets counts (words, symbols, repeated lines and windows, ...);
shrunk and transformed ratios of them form a vector.  Per (language, source)
a minimum-covariance-determinant estimate gives location and scatter of the
half of the documents that lie closest together, and a document whose
Mahalanobis distance from it is beyond the cutoff is rejected.

Fitting covers every row.  One concentration step is two grouped aggregations
over the small statistics table (a quantile of the distances, then moments of
the rows below it), both with map-side partials, so a source with a third of
all rows sends one partial row per task.  The start is the coordinatewise
median and quartile range, so the result does not depend on a random draw.

Defined results: null text counts as no words (base_failed); null language or
source is a group of its own (""); repeated rows get the same verdict; groups
below ``min_group`` rows of 10 or more words are pooled by language, then over
all languages left over, and pools still below it reject nothing beyond the
base rules; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from routelytics.llm.blocks import WORD, map_texts
from routelytics.session import RoundTables

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_upper_words", "n_bangs", "n_short_words"]
BASE = COUNTS[1:5]
_COUNT_TYPE = StructType([StructField(c, LongType(), False) for c in COUNTS])


@dataclass(frozen=True)
class QualityParams:
    #: share of a group's rows in the concentrated subset
    subset: float = 0.5
    #: concentration steps after the median start
    steps: int = 4
    #: rows of 10 or more words a group needs for an estimate of its own
    min_group: int = 200
    #: words of prior added to every ratio, so that short texts do not look extreme
    prior_words: float = 40.0
    #: least standard deviation of a transformed statistic
    least_sd: float = 0.08
    #: squared Mahalanobis distance beyond which a document is rejected
    cutoff: float = 150.0


def repeated_window_words(ids: np.ndarray, n_distinct: int, width: int = 5) -> int:
    """Words that lie in a ``width``-word window found twice or more."""
    m = len(ids) - width + 1
    if m < 2:
        return 0
    key, span = ids[:m].astype(np.int64), n_distinct
    for k in range(1, width):
        if span * n_distinct >= 1 << 62:  # keep the combination exact
            _, key = np.unique(key, return_inverse=True)
            span = int(key.max()) + 1
        key = key * n_distinct + ids[k:k + m]
        span *= n_distinct
    order = np.argsort(key, kind="stable")
    s = key[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return 0
    hit = np.zeros(m, bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    cover = np.zeros(len(ids) + 1, np.int64)
    at = np.flatnonzero(hit)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + width, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def _counter():
    word = re.compile(WORD)
    has_word = word.search

    def one(t: str) -> tuple:
        words = word.findall(t)
        if not words:
            return (0,) * len(COUNTS)
        seen: dict[str, int] = {}
        ids = np.fromiter([seen.setdefault(w, len(seen)) for w in words], np.int64, len(words))
        lines = [x for x in t.split("\n") if has_word(x)]
        lens = list(map(len, words))
        return (len(words), sum(lens), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
                repeated_window_words(ids, len(seen)), len(lines),
                sum(w.isupper() for w in words), t.count("!"), sum(n <= 3 for n in lens))

    def f(texts):
        return [list(c) for c in zip(*map(one, texts))]
    return f


def document_counts(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns and the counts of every whole text."""
    return map_texts(docs, _counter, _COUNT_TYPE, keep, text_col)


def _vector(p: QualityParams) -> list:
    """Transformed statistics: logs of shrunk ratios."""
    n = F.col("n_words").cast("double")
    k = p.prior_words

    def shrunk(count, per, prior):
        return F.log((F.col(count) + k * prior) / (per + k))

    return [shrunk("n_symbols", n, 0.05), shrunk("n_upper_words", n, 0.05), shrunk("n_bangs", n, 0.05),
            shrunk("word_chars", n, 5.0), shrunk("n_short_words", n, 0.35)]


def _fine():
    return F.to_json(F.array(F.coalesce(F.col("lang").cast("string"), F.lit("")),
                             F.coalesce(F.col("source").cast("string"), F.lit(""))))


def group_names(counts: DataFrame, p: QualityParams) -> DataFrame:
    """(fine, grp): a (lang, source) keeps its own group if enough of its rows can
    be fitted, else joins its language's pool, else the pool of the rest."""
    sizes = (counts.groupBy(F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("g_lang"), _fine().alias("fine"))
             .agg(F.count_if(F.col("n_words") >= 10).alias("n")).withColumn("small", F.col("n") < p.min_group))
    pools = sizes.filter("small").groupBy("g_lang").agg(F.sum("n").alias("pool"))
    return (sizes.join(pools, "g_lang", "left")
            .select("fine", F.when(~F.col("small"), F.col("fine"))
                    .when(F.col("pool") >= p.min_group, F.to_json(F.array("g_lang"))).otherwise(F.lit("[]")).alias("grp")))


def _with_vector(counts: DataFrame, names: DataFrame, p: QualityParams) -> DataFrame:
    """``counts`` with ``grp`` and the transformed statistics x0.."""
    out = counts.withColumn("fine", _fine()).join(names, "fine").drop("fine")
    return out.withColumns({f"x{i}": c for i, c in enumerate(_vector(p))})


def _invert(d: int, p: QualityParams):
    """Moments of a group's subset to location and precision, with the scatter
    made consistent for a normal core and floored along every axis."""
    pairs = [(i, j) for i in range(d) for j in range(i, d)]

    def run(frames):
        for pdf in frames:
            rows = []
            for r in pdf.itertuples(index=False):
                n = max(r.n_sub, 1)
                mean = np.array([getattr(r, f"s{i}") for i in range(d)], float) / n
                cov = np.zeros((d, d))
                for i, j in pairs:
                    cov[i, j] = cov[j, i] = getattr(r, f"s{i}_{j}") / n - mean[i] * mean[j]
                cov = cov / p.subset + np.eye(d) * p.least_sd ** 2
                rows.append((r.grp, int(r.n_all), *mean, *np.linalg.inv(cov).ravel()))
            yield pd.DataFrame(rows, columns=["grp", "n_grp"] + [f"m{i}" for i in range(d)]
                               + [f"p{i}_{j}" for i in range(d) for j in range(d)])
    schema = "grp string, n_grp long, " + ", ".join([f"m{i} double" for i in range(d)]
                                                    + [f"p{i}_{j} double" for i in range(d) for j in range(d)])
    return run, schema


def _distance(d: int):
    """Squared Mahalanobis distance of x0.. from the joined estimate."""
    diff = [F.col(f"x{i}") - F.col(f"m{i}") for i in range(d)]
    out = F.lit(0.0)
    for i in range(d):
        out = out + diff[i] * diff[i] * F.col(f"p{i}_{i}")
        for j in range(i + 1, d):
            out = out + F.lit(2.0) * diff[i] * diff[j] * F.col(f"p{i}_{j}")
    return out


_SALTS = 16


def _salted(x: DataFrame) -> DataFrame:
    return x.withColumn("salt", F.pmod(F.xxhash64("x0", "x1"), F.lit(_SALTS)).cast("int"))


def _by_salt(small: DataFrame) -> DataFrame:
    """One copy per salt: where the estimates are too many to be broadcast, a
    hot group's rows still meet them in several tasks and are summed in two steps."""
    return small.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))


def fit_mcd(x: DataFrame, d: int, p: QualityParams) -> DataFrame:
    """One estimate per ``grp`` of ``x`` (grp, x0..): location m*, precision p*, size."""
    rounds = RoundTables(x.sparkSession, "mcd")
    median = [F.percentile_approx(f"x{i}", [0.25, 0.5, 0.75], 1000).alias(f"q{i}") for i in range(d)]
    start = x.groupBy("grp").agg(F.count(F.lit(1)).alias("n_grp"), *median)
    cols = [F.col(f"q{i}")[1].alias(f"m{i}") for i in range(d)]
    for i in range(d):
        sd = (F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349
        for j in range(d):
            cols.append((1 / (sd * sd + p.least_sd ** 2) if i == j else F.lit(0.0)).alias(f"p{i}_{j}"))
    est, _ = rounds.write(start.select("grp", "n_grp", *cols))
    invert, schema = _invert(d, p)
    for _ in range(p.steps):
        dist = _salted(x).join(_by_salt(est), ["grp", "salt"]).select("grp", _distance(d).alias("dist"))
        cut = dist.groupBy("grp").agg(F.percentile_approx("dist", p.subset, 1000).alias("cut"))
        cut, _ = rounds.write(est.join(cut, "grp"))
        low = _distance(d) <= F.col("cut")
        sums = [F.sum(F.when(low, F.col(f"x{i}")).otherwise(0.0)).alias(f"s{i}") for i in range(d)]
        sums += [F.sum(F.when(low, F.col(f"x{i}") * F.col(f"x{j}")).otherwise(0.0)).alias(f"s{i}_{j}")
                 for i in range(d) for j in range(i, d)]
        moments = _salted(x).join(_by_salt(cut), ["grp", "salt"]).groupBy("grp").agg(
            F.count(F.lit(1)).alias("n_all"), F.sum(low.cast("long")).alias("n_sub"), *sums)
        est, _ = rounds.write(moments.mapInPandas(invert, schema))
    return est


def fit(counts: DataFrame, p: QualityParams = QualityParams()) -> tuple[DataFrame, DataFrame]:
    """(group names, estimates) from a written table of counts."""
    rounds = RoundTables(counts.sparkSession, "quality-fit")
    names, _ = rounds.write(group_names(counts, p))
    d = len(_vector(p))
    # texts below the base rules say nothing about the core of a source
    x = _with_vector(counts.filter("n_words >= 10"), names, p).select("grp", *[f"x{i}" for i in range(d)])
    x, _ = rounds.write(x)
    return names, fit_mcd(x, d, p)


def judge(counts: DataFrame, names: DataFrame, est: DataFrame, p: QualityParams = QualityParams()) -> DataFrame:
    """``counts`` plus grp, distance, base_failed and kept."""
    d = len(_vector(p))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    far = (F.col("n_grp") >= p.min_group) & (F.col("distance") > p.cutoff)
    salted = _salted(_with_vector(counts, names, p))
    return (salted.join(_by_salt(est), ["grp", "salt"], "left").withColumn("distance", _distance(d))
            .withColumn("base_failed", failed)
            .withColumn("kept", ~failed & ~F.coalesce(far, F.lit(False)))
            .select(*counts.columns, "grp", "distance", "base_failed", "kept"))


def quality_rules(docs: DataFrame, params: QualityParams = QualityParams(), id_col: str = "doc_id") -> DataFrame:
    """Counts and verdict per row of ``docs`` (id, lang, source, text)."""
    counts = document_counts(docs, [id_col, "lang", "source"])
    counts, _ = RoundTables(docs.sparkSession, "quality-counts").write(counts)
    return judge(counts, *fit(counts, params), params)


def keep_good(docs: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """Rows of ``docs``, with their own columns, that pass the rules.

    Two passes over the texts: one gathers counts to fit the estimates, the
    other recounts next to each row, so a row meets its verdict by group and
    not by id (ids may be null or repeat).
    """
    counts, _ = RoundTables(docs.sparkSession, "quality-counts").write(document_counts(docs, ["lang", "source"]))
    names, est = fit(counts, params)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "lang", "source", "text")
    again = document_counts(rows, ["row", "lang", "source"])
    return judge(again, names, est, params).filter("kept").select("row.*")


def digest(docs: DataFrame) -> DataFrame:
    """Columns of the op4 contract."""
    return quality_rules(docs).select("doc_id", "n_words", *BASE, "base_failed", "kept", "distance", "grp")
