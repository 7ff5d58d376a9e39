import hashlib
import random

import duckdb
import pytest

from routelytics.llm import line_dedup as q
from routelytics.llm.queries import ORACLE_SQL

SCHEMA = "doc_id long, text string, dropped string"


def brute(rows, least_chars=40, least_docs=5):
    """(n_lines, n_dropped, kept text) of every (id, text) row."""
    lower = {c: c + 32 for c in range(65, 91)}
    held = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            held.setdefault(line.strip(" \t\n\x0b\x0c\r").translate(lower), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = []
        for line in lines:
            k = line.strip(" \t\n\x0b\x0c\r").translate(lower)
            ids = held[k] - {None}
            if i is None or len(k) < least_chars or len(ids) < least_docs or max(ids) == i:
                keep.append(line)
        out.append((i, len(lines), len(lines) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed, n=150):
    rng = random.Random(seed)
    pool = [" ".join(rng.choice(["Ab", "é", "𝒳", "foo", "BAR", "x"]) for _ in range(rng.randrange(1, 40))) for _ in range(40)]
    pool += ["q" * 39, "q" * 40, "Q" * 40, " \t" + "q" * 40 + "\r\x0b\x0c", "é" * 39 + "A", "É" * 40, "", "   ", "\x85" + "q" * 40]
    out = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(12)))) for i in range(n)]
    hot = "the line that a third of all documents hold, whatever they say"
    return [(i, t + "\n" + hot if i % 3 == 0 else t) for i, t in out] + [(n, None), (n + 1, ""), (n + 2, "\n\n")]


def digest(spark, rows, p=None):
    table = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)
    if p:
        old, q.LineDedupParams = q.LineDedupParams, lambda: p
    try:
        return sorted([tuple(r) for r in q.digest(table).collect()], key=repr)
    finally:
        if p:
            q.LineDedupParams = old


def test_matches_brute_force_with_repeated_and_null_ids(spark):
    rows = corpus(1)
    rows += [rows[3], rows[3], (7, "another text of id seven\n" + rows[0][1]), (None, rows[0][1]), (None, None)]
    assert digest(spark, rows) == brute(rows)


@pytest.mark.parametrize("batches,fan", [(1, 2), (2, 2), (9, 2)])
def test_any_batches_give_the_same(spark, batches, fan):
    rows = corpus(2, 80)
    assert digest(spark, rows, q.LineDedupParams(batches=batches, fan=fan)) == brute(rows)


def test_empty_table_and_long_text(spark):
    assert digest(spark, []) == []
    lines = [f"line number {i} is long enough to take part in this" for i in range(20_000)]
    rows = [(i, "\n".join(lines)) for i in range(5)]
    got = {i: (n, d) for i, n, d, _ in digest(spark, rows)}
    assert got == {i: (20_000, 0 if i == 4 else 20_000) for i in range(5)}


def test_drop_repeated_keeps_columns(spark):
    rows = [(i, f"a line of this document alone, number {i}, and\n" + "S" * 50) for i in range(6)]
    got = q.drop_repeated(spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA))
    assert got.columns == ["doc_id", "text", "dropped"]
    assert {r.doc_id: r.text.count("S") for r in got.collect()} == {i: 50 if i == 5 else 0 for i in range(6)}


def test_runs_are_levelled_and_their_joins_shuffle_nothing(spark):
    runs = q.LineRuns(spark, fan=2)
    keys = lambda lo, hi: spark.range(lo, hi).selectExpr("id AS hi", "id * 7 AS lo", "1L AS docs", "id AS last")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        sizes, shapes = [], []
        for b in range(5):
            fresh = runs.add(keys(b * 50, b * 50 + 100))
            sizes.append(fresh.count())
            plan = fresh._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and (b == 0 or "Bucketed: true" in plan)
            runs.compact()
            shapes.append([len(level) for level in runs.levels])
        assert sizes == [100, 50, 50, 50, 50] and shapes == [[1], [0, 1], [1, 1], [0, 0, 1], [1, 0, 1]]
        totals = {r.hi: r.docs for r in runs.totals().collect()}
        assert totals == {i: 1 if i < 50 or i >= 250 else 2 for i in range(300)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        runs.drop()


def test_main_path_has_no_python(spark):
    plan = q.digest(spark.createDataFrame([(1, "a", "x")], SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_sql_twin():
    con = duckdb.connect()
    rows = corpus(5)
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    assert sorted(con.execute(ORACLE_SQL["op12_line_dedup"]).fetchall(), key=repr) == brute(rows)
