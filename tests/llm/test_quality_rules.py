from collections import Counter

import numpy as np
import pytest

from routelytics.llm import quality_rules as q


def brute_repeat(words):
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    n = Counter(grams)
    return len({i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(5)})


@pytest.mark.parametrize("seed", range(6))
def test_repeated_windows_match_brute_force(seed):
    rng = np.random.default_rng(seed)
    words = [str(x) for x in rng.integers(0, 4 if seed < 4 else 5000, 300)] + ["a b c d e f g"] * (seed % 3)
    ids = {}
    arr = np.array([ids.setdefault(w, len(ids)) for w in words])
    assert q.repeated_window_words(arr, len(ids)) == brute_repeat(words)


def test_many_distinct_words_stay_exact():
    words = [str(i) for i in range(9000)] + [str(i) for i in range(6)]
    ids = {}
    arr = np.array([ids.setdefault(w, len(ids)) for w in words])
    assert q.repeated_window_words(arr, len(ids)) == 12


def docs(spark, rows, extra=""):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long" + extra)


def corpus():
    rng = np.random.default_rng(1)
    vocab = ["w%s" % ("x" * int(k % 7)) + str(k) for k in range(3000)]
    rows = [(i, " ".join(rng.choice(vocab, 60)), "en", "hot" if i % 3 else "s", 1) for i in range(900)]
    rows += [(1000 + i, "### " .join(rng.choice(vocab, 60)), "en", "hot", 1) for i in range(40)]
    return rows


def test_symbol_texts_go_and_clean_ones_stay(spark):
    got = {r.doc_id: r for r in q.digest(docs(spark, corpus())).collect()}
    assert all(got[i].kept for i in range(900))
    assert not any(got[1000 + i].kept for i in range(40))
    assert got[1000].n_symbols == 3 * 59 and got[0].n_words == 60


@pytest.mark.parametrize("share", [0.3, 0.45])
def test_a_source_with_much_junk_loses_all_of_it(spark, share):
    rng = np.random.default_rng(5)
    vocab = ["w%s" % ("x" * int(k % 7)) + str(k) for k in range(3000)]
    n = int(1000 * share)
    rows = [(i, ("### " if i < n else " ").join(rng.choice(vocab, 60)), "en", "hot", 1) for i in range(1000)]
    got = {r.doc_id: r.kept for r in q.digest(docs(spark, rows)).collect()}
    assert not any(got[i] for i in range(n)) and all(got[i] for i in range(n, 1000))


def test_short_texts_do_not_make_a_group_large(spark):
    rng = np.random.default_rng(6)
    vocab = ["w%s" % ("x" * int(k % 7)) + str(k) for k in range(3000)]
    rows = [(i, " ".join(rng.choice(vocab, 60 if i < 350 else 5)), "en", "mixed" if i % 2 else "s", 1) for i in range(700)]
    rows += [(1000 + i, "### " .join(rng.choice(vocab, 60)), "en", "mixed", 1) for i in range(20)]
    got = {r.doc_id: r for r in q.digest(docs(spark, rows)).collect()}
    assert len(got) == 720 and all(got[i].kept == (i < 350) for i in range(700))
    assert not any(got[1000 + i].kept for i in range(20))


def test_edge_rows(spark):
    rows = corpus() + [(None, "too short", None, None, None), (5000, None, "en", "hot", None), (5001, "", None, "hot", 0),
                       (5002, " \n\t ", "en", None, 0), (1, corpus()[1][1], "en", "hot", 1),
                       (5003, "same words come again here " * 5, "en", "hot", 1), (5004, "word " * 200_000, "en", "hot", 1),
                       (5005, "a b c d e f g h i j k\nq r\nq r\n\n\n", "xx", "tiny", 1)]
    table = docs(spark, [(*r, "clash") for r in rows], ", grp string")
    got = q.digest(table).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[5000].n_words == by[5001].n_words == by[5002].n_words == 0 and by[5000].base_failed
    assert by[5003].n_repeat_words == 25 and by[5003].base_failed and not by[5003].kept
    assert by[5004].n_repeat_words == 200_000
    assert by[5005].n_dup_lines == 1 and by[5005].kept
    assert sum(r.doc_id == 1 for r in got) == 2
    kept = q.keep_good(table)
    assert kept.columns == table.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in got if r.kept)


def test_empty_table(spark):
    empty = docs(spark, [])
    assert q.digest(empty).collect() == [] and q.keep_good(empty).collect() == []


def test_estimate_matches_a_plain_concentration(spark):
    """The distributed steps equal the same steps on one array."""
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(0, 1, (700, 2)) @ np.array([[1, .5], [0, 1]]), rng.normal(9, 1, (100, 2))])
    p = q.QualityParams(least_sd=0.1)
    table = spark.createDataFrame([("g", float(a), float(b)) for a, b in x], "grp string, x0 double, x1 double")
    r = q.fit_mcd(table, 2, p).first()
    quant = lambda v, f: np.sort(v)[int(np.ceil(f * len(v))) - 1]
    m = np.array([quant(x[:, i], .5) for i in range(2)])
    prec = np.diag([1 / (((quant(x[:, i], .75) - quant(x[:, i], .25)) / 1.349) ** 2 + .01) for i in range(2)])
    for _ in range(p.steps):
        d = np.einsum("ni,ij,nj->n", x - m, prec, x - m)
        sub = x[d <= quant(d, p.subset)]
        m, prec = sub.mean(0), np.linalg.inv(np.cov(sub.T, bias=True) / p.subset + .01 * np.eye(2))
    assert np.allclose([r.m0, r.m1], m, atol=.02) and np.allclose([r.p0_0, r.p0_1], prec[0], rtol=.05, atol=.02)
