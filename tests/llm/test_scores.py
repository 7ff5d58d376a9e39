import random
import zlib

import numpy as np
import pytest

from routelytics.llm import quality_classifier as qc
from routelytics.llm import toxicity as tx

from conftest import SF_SMALL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"


def auc(y, s):
    y, s = np.array(y), np.array(s)
    order = np.argsort(s, kind="stable")
    rank = np.empty(len(s))
    rank[order] = np.arange(1, len(s) + 1)
    for v in np.unique(s):
        rank[s == v] = rank[s == v].mean()
    pos = y == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


# this small table has about forty toxic training rows, of which other languages have one or two
@pytest.mark.parametrize("op, label, mod, rest, least", [(tx, "toxic", 4, 2, 0.75), (qc, "quality", 5, 0, 0.95)])
def test_held_out_accuracy(spark, op, label, mod, rest, least):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    rows = op.score(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % mod == rest) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    truth = {r.doc_id: r[label] for r in labels.collect()}
    held = [(truth[r.doc_id], r.score) for r in rows if r.held_out and r.doc_id in truth]
    assert auc(*zip(*held)) > least


def test_labels_of_held_out_rows_change_nothing(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    for op, col, mod, rest in ((tx, "toxic", 4, 2), (qc, "quality", 5, 0)):
        flipped = labels.selectExpr(
            "doc_id", *[f"if(crc32(cast(doc_id as string)) % {mod} = {rest}, 1 - {c}, {c}) AS {c}" if c == col else c
                        for c in ("quality", "toxic")])
        a = {r.doc_id: r.score for r in op.score(docs, labels).collect()}
        b = {r.doc_id: r.score for r in op.score(docs, flipped).collect()}
        assert max(abs(a[i] - b[i]) for i in a) < 1e-9


def corpus(seed=2):
    rng = random.Random(seed)
    words = [f"word{i}" for i in range(500)]
    docs, labels = [], []
    for i in range(400):
        t = [rng.choice(words) for _ in range(60)]
        bad = i % 4 == 0
        if bad:
            for _ in range(3):
                t[rng.randrange(60)] = rng.choice(["grumbling", "zzorkly", "zzorked", "zzorkish", "zzorkin"])
        docs.append((i, " ".join(t), None, "s", 1))
        labels.append((i, 1, int(bad)))
    return docs, labels


def test_inflected_words_are_met_by_their_stem(spark):
    docs, labels = corpus()
    docs.append((9999, "plain text with zzorkment in it " + "word1 " * 20, None, None, None))
    d, lab = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, LABELS)
    sample = lab.selectExpr("doc_id", "toxic AS y")
    terms = tx.lexicon(d, sample, tx.ToxicityParams())
    assert "grumbling" in terms and any(t.startswith("zzork") and t.endswith("*") for t in terms)
    rows = {r.doc_id: r for r in tx.score(d, lab).collect()}
    assert all((rows[i].predicted == 1) == (i % 4 == 0) for i in range(400)) and rows[9999].n_hits == 1


def test_lexicon_scores_every_term(spark):
    """Counts, ratio and evidence of every term, written down with a dictionary."""
    docs, labels = corpus(5)
    y = {i: t for i, _, t in labels}
    counts = {}
    for i, t, *_ in docs:
        for term in {x for w in t.lower().split() for x in tx._terms(w, (4, 5, 6, 7))}:
            counts.setdefault(term, [0, 0])[y[i]] += 1
    n0, n1 = sum(v == 0 for v in y.values()), sum(y.values())
    p, strong = tx.ToxicityParams(least_ratio=1.05, least_evidence=0.5, voters=10_000), []
    for term, (c, t) in counts.items():
        ratio = (t / n1) / ((c + 0.5) / (n0 + 1))
        if t >= p.least_toxic and ratio >= p.least_ratio and t * np.log(ratio) >= p.least_evidence:
            strong.append((t * np.log(ratio), len(term), term))
    want = []
    for _, _, term in sorted(strong, reverse=True):
        stem = term.rstrip("*")
        longer = any(c.endswith("*") and stem.startswith(c[:-1]) for c in want)
        if not longer and not (term.endswith("*") and any(c.startswith(stem) for c in want if not c.endswith("*"))):
            want.append(term)
    d = spark.createDataFrame(docs, SCHEMA).repartition(7)
    sample = spark.createDataFrame(labels, LABELS).selectExpr("doc_id", "toxic AS y")
    assert tx.lexicon(d, sample, p) == want and len(want) > 20
    assert tx.lexicon(d, sample, tx.ToxicityParams(least_ratio=1.05, least_evidence=0.5, voters=5)) == want[:5]


def test_patterns_vote_alone_without_a_lexicon(spark):
    rng = random.Random(3)
    docs, labels = [], []
    for i in range(300):
        t = " ".join("".join(rng.choices("abcdefghijklmnopqrst", k=9)) for _ in range(30))  # no word twice
        docs.append((i, t.upper() + "!!!" * 20 if i % 3 == 0 else t, None, None, None))
        labels.append((i, 1, int(i % 3 == 0)))
    rows = tx.score(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, LABELS)).collect()
    assert {r.n_hits for r in rows} == {0} and all(r.predicted == (r.doc_id % 3 == 0) for r in rows)


def test_toxic_labels_without_a_document(spark):
    docs, _ = corpus()
    got = tx.score(spark.createDataFrame(docs[:9], SCHEMA), spark.createDataFrame([(90001, 1, 1), (90003, 1, 1), (1, 1, 0)], LABELS))
    assert len({r.score for r in got.collect()}) == 1


def test_small_training_table_is_spread(spark):
    """The documents are scanned by their own partitions, not by as few tasks as the training rows need."""
    docs, labels = corpus()
    d = spark.createDataFrame(docs, SCHEMA).repartition(24)
    a = {r.doc_id: r.score for r in qc.score(d, spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(400)], LABELS)).collect()}
    assert len(a) == 400 and len(set(a.values())) > 50


def test_classifier_matches_plain_numpy(spark):
    docs, _ = corpus(8)
    docs = [(i, t.upper() if i % 3 == 0 and i % 7 else t + " !" * (i % 5), *r) for i, t, *r in docs]
    labels = [(i, int(i % 3 > 0), 0) for i in range(400)]
    p = qc.ClassifierParams(features=40, bins=50)
    d = spark.createDataFrame(docs, SCHEMA)
    got = {r.doc_id: r for r in qc.score(d, spark.createDataFrame(labels, LABELS), p).collect()}
    fold = {r.doc_id: r.f for r in d.selectExpr("doc_id", "cast(pmod(xxhash64(doc_id, 5), 2) AS int) AS f").collect()}
    train = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5]
    x = np.array([qc.statistics(t) for _, t, *_ in docs])
    mean, sd = x[train].mean(0), x[train].std(0) + 1e-3
    rng = np.random.default_rng(p.seed)
    freq, phase = rng.normal(0, 1 / p.width, (x.shape[1], 40)), rng.uniform(0, 2 * np.pi, 40)
    z = np.hstack([np.sqrt(2 / 40) * np.cos(np.clip((x - mean) / sd, -6, 6) @ freq + phase), np.ones((400, 1))])
    y, f = np.array([q for _, q, _ in labels], float), np.array([fold[i] for i in range(400)])
    ridge = np.diag([1.0] * 40 + [1e-6])

    def fit(rows):
        return np.linalg.solve(z[rows].T @ z[rows] + ridge, z[rows].T @ y[rows])
    t = np.array(train)
    w, other = fit(t), [fit(t[f[t] == 1]), fit(t[f[t] == 0])]

    def cell(v):
        return np.clip(((v + 0.5) / 2 * 50).astype(int), 0, 49)
    at = cell(np.array([z[i] @ other[f[i]] for i in t]))
    sums, sizes = np.bincount(at, y[t], 50), np.bincount(at, minlength=50)
    # least squares under order: the least over ends of the greatest over starts of block means
    full = [k for k in range(50) if sizes[k]]
    level = np.full(50, np.nan)
    for k in full:
        level[k] = min(max(sums[a:b + 1].sum() / sizes[a:b + 1].sum() for a in full if a <= k) for b in full if b >= k)
    known = np.where(np.isnan(level), -1, np.arange(50))
    level = level[np.maximum(np.maximum.accumulate(known), full[0])]
    raw = z @ w
    want = 0.998 * level[cell(raw)] + 0.002 * np.clip((raw + 0.5) / 2, 0, 1)
    assert max(abs(got[i].score - want[i]) for i in range(400)) < 1e-6


def test_repeated_evidence_counts_less():
    """Two voters that always agree weigh about as much as one."""
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.3
    a = np.where(y, rng.random(4000) < 0.8, rng.random(4000) < 0.1)
    b = np.where(y, rng.random(4000) < 0.7, rng.random(4000) < 0.1)
    votes = np.stack([a, a, b], 1).astype(int)

    class Rows:  # fit on one in-memory batch
        pass
    import pyarrow as pa
    real = tx.summed
    batch = pa.RecordBatch.from_arrays([pa.array(votes.tolist(), pa.list_(pa.int32())), pa.array([None] * 4000, pa.float64()),
                                        pa.array([1] * 4000, pa.int64())], names=["votes", "y", "n"])
    rows = Rows()
    rows.select = lambda *_: rows
    tx.summed = lambda df, size, add: add(batch)
    try:
        start = tx.LabelModel(0.3, np.array([[.1] * 3, [.7] * 3]), np.full(3, .5))
        m = tx.fit_label_model(rows, 3, start, 30)
    finally:
        tx.summed = real
    assert m.weight[0] == m.weight[1] < m.weight[2] and abs(m.weight[0] - 0.5) < 0.12
    assert 0.15 < m.prior < 0.45 and (m.rate[1] > m.rate[0] + 0.3).all()


@pytest.mark.parametrize("op", [tx, qc])
def test_edge_rows(spark, op):
    docs, labels = corpus()
    labels = [(i, int(x % 3 > 0) if op is qc else q, t) for (i, q, t), x in zip(labels, range(len(labels)))]
    rows = docs + [(None, "an unnamed text", "en", "s", 1), (700, None, "en", None, None), (701, "", "en", "s", 0),
                   (702, "grumbling " * 50_000, "en", "s", 1), docs[4]]
    d = spark.createDataFrame([(*r, "clash", 3) for r in rows], SCHEMA + ", score string, y int")
    lab = spark.createDataFrame(labels + labels[:9] + [(None, 1, 1), (3, None, None), (98765, 0, 1)], LABELS)
    got = op.score(d, lab).collect()
    assert len(got) == len(rows) and all(r.score is not None and 0 <= r.score <= 1 for r in got)
    assert next(r for r in got if r.doc_id is None).held_out is False
    assert len({r.score for r in got if r.doc_id == 4}) == 1
    assert len({r.score for r in got if r.doc_id in (700, 701)}) == 1


@pytest.mark.parametrize("op", [tx, qc])
def test_empty_tables(spark, op):
    docs, labels = corpus()
    none, d = spark.createDataFrame([], LABELS), spark.createDataFrame(docs[:20], SCHEMA)
    assert {r.score for r in op.score(d, none).collect()} == {0.0}
    empty = spark.createDataFrame([], SCHEMA)
    assert op.score(empty, none).collect() == []
    assert op.score(empty, spark.createDataFrame(labels, LABELS)).collect() == []


def test_isotonic_is_least_squares_and_monotone():
    y, n = np.array([0, 3, 1, 0, 0, 4, 2]), np.array([2, 4, 2, 0, 3, 4, 2])
    got = qc.isotonic(y, n)
    assert (np.diff(got) >= 0).all() and got[0] == 0 and got[-1] == 1
    assert np.allclose(got[1:5], 4 / 9)
    assert qc.isotonic(np.zeros(3), np.zeros(3)).tolist() == [0, 0, 0]


def test_fourier_features_approach_the_gaussian_kernel():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(30, 6))
    p = qc.ClassifierParams(features=20_000)
    z = qc.Fourier.draw(np.zeros(6), np.ones(6), p)(x)[:, :-1]
    want = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * p.width ** 2))
    assert np.abs(z @ z.T - want).max() < 0.05
