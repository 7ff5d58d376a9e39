import random

import duckdb
import pytest

from routelytics.llm import near_dedup as q
from routelytics.llm.components import components
from routelytics.llm.queries import ORACLE_SQL

from llm_brute import components_by_all_pairs, shingles

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", 1) for i, t in texts], SCHEMA)


def brute(texts, width=4, percent=80):
    """Set size and component of every id by comparing all pairs."""
    comp = components_by_all_pairs(texts, width, percent)
    return {i: (len(shingles(t, width)), comp[i]) for i, t in texts}


def near_copies(rng, n, words=60, edits=6):
    base = [f"w{rng.randrange(4000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits)):
            w[rng.randrange(words)] = f"z{rng.randrange(4000)}"
        out.append(" ".join(w))
    return out


def corpus(seed):
    rng = random.Random(seed)
    texts = [t for _ in range(12) for t in near_copies(rng, rng.randrange(1, 5), rng.randrange(3, 90))]
    texts += near_copies(rng, 90, 70, 5)  # a dense group in which many pairs are below the bound
    texts += [rng.choice(texts) for _ in range(30)] + ["", None, "  \n\t", "One", "one", "one two", "a a a a a a", "A A A A"]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_all_pairs(spark, seed):
    texts = corpus(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in q.digest(docs(spark, texts)).collect()}
    assert got == brute(texts)


def test_five_word_stage_keeps_one_row_of_each_group(spark):
    texts = corpus(3)
    table = docs(spark, texts).selectExpr("*", "'x' AS rep", "1 AS sig").unionByName(
        docs(spark, [texts[0], texts[0], (None, "no id"), (None, texts[5][1])]).selectExpr("*", "'x' AS rep", "1 AS sig"))
    kept = q.keep_one(table)
    assert kept.columns == table.columns
    ids = [r.doc_id for r in kept.collect()]
    want = [i for i, (_, c) in brute(texts, 5).items() if c == i]
    assert sorted(i for i in ids if i is not None) == sorted(want) and ids.count(None) == 2


def test_texts_that_share_an_id_are_classed_each(spark):
    a = " ".join(f"a{i}" for i in range(30))
    b = " ".join(f"b{i}" for i in range(30))
    c = " ".join(f"c{i}" for i in range(30))
    rows = [(1, a), (5, a + " x"), (5, b), (5, b), (1, c), (2, c + " y"), (3, a + " z"), (9, ""), (9, None), (None, a)]
    got = sorted((r.doc_id, r.component_id, r.kept) for r in q.digest(docs(spark, rows)).collect() if r.doc_id)
    assert got == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (5, 1, False), (5, 5, True), (5, 5, True),
                   (9, 9, True), (9, 9, True)]
    kept = sorted((r.doc_id, r.text) for r in q.keep_one(docs(spark, rows)).collect() if r.doc_id and r.text)
    assert kept == [(1, a), (1, c), (5, b)]


def test_repeated_rows_make_one_set(spark, monkeypatch):
    """One link between two texts that are repeated 100 times each is one pair."""
    sizes = []
    confirm = q._confirm
    monkeypatch.setattr(q, "_confirm", lambda pairs, sets, p: sizes.append((pairs.count(), sets.count())) or confirm(pairs, sets, p))
    a = " ".join(f"a{i}" for i in range(40))
    got = q.digest(docs(spark, [(1, a)] * 100 + [(2, a + " b")] * 100 + [(3, a)] * 50)).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(1, 1), (2, 1), (3, 1)} and sizes[0] == (1, 2)


@pytest.mark.parametrize("edits", [0.035, 0.05, 0.065])
def test_few_late_pairs_in_a_family(spark, monkeypatch, edits):
    """Texts that are each a bit too far apart: similarity 0.6 to 0.8 between most pairs."""
    rng = random.Random(7)
    base = [f"w{rng.randrange(9000)}" for _ in range(300)]

    def family(n):
        return [(i, " ".join(w if rng.random() > edits else f"z{rng.randrange(10 ** 9)}" for w in base)) for i in range(n)]
    late = []
    pairs = q._apart_pairs
    monkeypatch.setattr(q, "_apart_pairs", lambda *a: late.append(pairs(*a).count()) or pairs(*a))
    for n in (60, 120):
        texts = family(n)
        got = {r.doc_id: r.component_id for r in q.digest(docs(spark, texts)).collect()}
        assert got == {i: c for i, (_, c) in brute(texts).items()}
    assert not late or late[-1] <= 120 * 119 / 2 / 10  # a tenth of all pairs at most


def test_empty_table_and_long_text(spark):
    assert q.digest(docs(spark, [])).collect() == []
    long = " ".join(f"w{i}" for i in range(120_000))
    got = {r.doc_id: r for r in q.digest(docs(spark, [(1, long), (2, long + " tail"), (3, "short one")])).collect()}
    assert got[2].component_id == 1 and got[1].n_shingles == 119_997 and got[3].kept


def test_long_chain_is_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(500, 501), (7, 7)], "a long, b long")
    got = dict(components(links).collect())
    assert all(got[i] == 0 for i in range(301)) and got[501] == got[500] == 500 and len(got) == 303


def test_sql_twin_matches_all_pairs():
    con = duckdb.connect()
    texts = corpus(4)
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", texts)
    rows = con.execute(ORACLE_SQL["op9_near_dedup"]).fetchall()
    assert {i: (n, c) for i, n, c, _ in rows} == brute(texts)
