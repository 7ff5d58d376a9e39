import random

import numpy as np
import pytest

from routelytics.llm import decontaminate as q

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def least_edits(pattern, text):
    """Edit distance of ``pattern`` to its best place in ``text``."""
    d = np.zeros(len(text) + 1, int)
    for ch in pattern:
        new = np.empty_like(d)
        new[0] = d[0] + 1
        for i, c in enumerate(text):
            new[i + 1] = min(d[i] + (c != ch), d[i + 1] + 1, new[i] + 1)
        d = new
    return int(d.min())


def brute(text, items, p):
    out = []
    t = "".join(map(chr, q.Normaliser()(text or "")[0]))
    for item, body in items:
        b = "".join(map(chr, q.Normaliser()(body or "")[0]))
        n = min(p.window, len(b))
        if len(b) < p.q:
            continue
        e = min(int(n * p.edit_rate), (n - p.q) // p.q)
        offs = {*range(0, len(b) - n + 1, p.step), len(b) - n}
        if any(least_edits(b[o:o + n], t) <= e for o in offs):
            out.append(item)
    return sorted(out)


def spoil(rng, s, edits):
    s = list(s)
    for _ in range(edits):
        i = rng.randrange(len(s))
        rng.choice([lambda: s.__setitem__(i, "z"), lambda: s.insert(i, "q"), lambda: s.pop(i)])()
    return "".join(s)


@pytest.mark.parametrize("most_hits", [8_000_000, 300])
def test_matches_full_alignment(spark, most_hits):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcde") for _ in range(rng.randrange(2, 8)))
    body = lambda n: " ".join(word() for _ in range(n))
    items = [(i, body(rng.choice([2, 8, 14, 30]))) for i in range(8)] + [(50, None), (51, "abc"), (52, ""), (1, body(20))]
    texts = [body(60) for _ in range(4)]
    for i, s in items:
        if s and len(s) > 20:
            for edits in (0, 3, 6, 9, 14):
                texts.append(body(10) + " " + spoil(rng, s.upper().replace(" ", " \n "), edits) + " " + body(10))
            half = len(s) // 2
            texts.append(body(5) + s[:half] + body(5))
    texts += ["", None, items[1][1], "x" * 30]
    p = q.LeakParams(most_hits=most_hits)
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], DOCS)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: sorted({h.item_id for h in r.hits}) for r in q.report(docs, bench, p).collect()}
    want = {i: sorted(set(brute(t, items, p))) for i, t in enumerate(texts)}
    assert got == want and sum(map(bool, want.values())) > 10


def test_spans_blocks_and_filter(spark):
    rng = random.Random(9)
    items = [(i, " ".join(f"term{rng.randrange(9999)}" for _ in range(25))) for i in range(30)]
    leak = "Été: " + items[3][1].upper() + " — end"
    rows = [(1, "clean text of its own"), (2, leak), (None, items[7][1]), (2, leak), (4, None), (5, "w " * 60_000 + items[9][1])]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, hits string, row string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for p in (q.LeakParams(), q.LeakParams(block_chars=900)):
        got = q.report(docs, bench, p).collect()
        assert sorted((r.doc_id or 0, r.contaminated, r.item_ids) for r in got) == sorted(
            [(1, False, []), (2, True, [3]), (2, True, [3]), (0, True, [7]), (4, False, []), (5, True, [9])])
        h = next(r.hits[0] for r in got if r.doc_id == 2)
        assert leak[h.start:h.end].lower() == items[3][1] and h.edits == 0
        kept = q.keep_clean(docs, bench, p)
        assert kept.columns == docs.columns
        assert sorted(r.doc_id for r in kept.collect()) == [1, 4]


def test_no_budget_changes_a_result():
    """Many near-copies of one item, each an entry of its own, and an item that repeats one q-gram."""
    rng = random.Random(4)
    base = " ".join(f"term{rng.randrange(9999)}" for _ in range(30))
    items = [([i], spoil(rng, base, 2)) for i in range(150)] + [([900], "ab" * 400), ([901], base), ([902, 903], base.upper())]
    text = "begin " + spoil(rng, base, 5) + " " + "ab" * 300 + " end " + spoil(rng, base, 3) + " x" * 500
    codes = q.Normaliser()(text)[0]
    want = q.search(codes, q.Index(items, q.LeakParams(most_hits=10**9)))
    assert len({i for i, *_ in want}) > 100
    for most in (200_000, 5_000, 100):
        assert q.search(codes, q.Index(items, q.LeakParams(most_hits=most))) == want


def test_copies_of_an_item_add_no_hits(spark):
    base = " ".join(f"term{i * i % 997}" for i in range(30))
    index = q.Index([([i], base if i % 2 else base.upper()) for i in range(400)], q.LeakParams())
    assert len(index.codes) == 1 and int(index.count.max()) < 5 and len(index.ids[0]) == 400
    docs = spark.createDataFrame([(1, "so " + base)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, base) for i in range(400)] + [(None, base)], "item_id long, text string")
    got = q.report(docs, bench, q.LeakParams(most_hits=2000)).first()
    assert sorted(h.item_id for h in got.hits if h.item_id is not None) == list(range(400)) and len(got.hits) == 401


def test_several_blocks_are_one_pass(spark, monkeypatch):
    rng = random.Random(2)
    items = [(i, " ".join(f"term{rng.randrange(9999)}" for _ in range(25))) for i in range(40)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(k, "before " * (k % 5) + items[k][1] + " " + items[-k][1]) for k in range(1, 30)] + [(50, "clean " * 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    p = q.LeakParams(block_chars=1200)
    blocks = q._blocks(bench, p)
    assert len(blocks.numbers) >= 5
    found = q.report(docs, bench, p)
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    want = {k: sorted({k, 40 - k}) for k in range(1, 30)} | {50: []}
    assert {r.doc_id: r.item_ids for r in found.collect()} == want
    monkeypatch.setattr(q, "STRING_CHARS", 300)  # texts of several strings
    [hits] = q._finder(blocks)()([t for _, t in rows])
    assert {i: [h[0] for h in x] for (i, _), x in zip(rows, hits)} == want


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    bench = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a text", "en", "s", 1)], DOCS)
    assert q.report(docs, bench).collect() == [] and q.keep_clean(docs, bench).collect() == []
    r = q.report(some, bench).first()
    assert not r.contaminated and r.hits == [] and q.keep_clean(some, bench).count() == 1
