"""Shortest paths: hand-made graphs, brute force on generated graphs, invariants."""

import random

import pytest
from pyspark.sql import functions as F

from routelytics.operators.edges import route_edges
from routelytics.plans.paths import reconstruct, route_queries
from routelytics.plans.repair import repair_paths
from routelytics.plans.sssp import SCALE, EdgeBlocks, LabelRuns, relaxed, shortest_paths
from routelytics.sources.synthetic import grid_nodes, synthetic_flights


def edges_df(spark, triples):
    return spark.createDataFrame([(int(a), int(b), float(w)) for a, b, w in triples],
                                 "src long, dst long, weight double")


def brute_labels(triples, source):
    """Label-correcting fixpoint with lexicographic (dist, hops, pred) labels over whole-number distances."""
    triples = [(a, b, round(w * SCALE)) for a, b, w in triples]
    lab = {source: (0, 0, -1)}
    changed = True
    while changed:
        changed = False
        for a, b, w in triples:
            if a in lab:
                c = (lab[a][0] + w, lab[a][1] + 1, a)
                if b not in lab or c < lab[b]:
                    lab[b] = c
                    changed = True
    return {k: (d / SCALE, h, p) for k, (d, h, p) in lab.items()}


def labels(spark, triples, sources, **kw):
    src = spark.createDataFrame([(s,) for s in sources], "source long")
    st = shortest_paths(edges_df(spark, triples), src, **kw).collect()
    return {(r.source, r.node): (r.dist, r.hops, -1 if r.pred is None else r.pred) for r in st}


CASES = {
    "tie": ([(0, 1, 1), (0, 2, 1), (1, 3, 1), (2, 3, 1)], {3: (2.0, 2, 1)}),
    "zero": ([(0, 1, 0), (1, 2, 0), (2, 1, 0), (2, 3, 5)], {1: (0.0, 1, 0), 2: (0.0, 2, 1), 3: (5.0, 3, 2)}),
    "unreachable": ([(0, 1, 2), (2, 3, 1), (3, 2, 1)], {1: (2.0, 1, 0), 2: None, 3: None}),
    "selfloop": ([(0, 0, 4), (0, 1, 1)], {0: (0.0, 0, -1), 1: (1.0, 1, 0)}),
    "cheaper_longer": ([(0, 3, 10), (0, 1, 2), (1, 2, 2), (2, 3, 2)], {3: (6.0, 3, 2)}),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_hand_made(spark, name):
    triples, expect = CASES[name]
    got = labels(spark, triples, [0])
    for node, lab in expect.items():
        assert got.get((0, node)) == lab, (name, node)
    assert got == {(0, k): v for k, v in brute_labels(triples, 0).items()}


def test_paths_on_hand_made(spark):
    triples, _ = CASES["cheaper_longer"]
    q = spark.createDataFrame([(0, 3), (0, 0), (3, 0)], "source long, destination long")
    rows = {(r.source, r.destination): r for r in route_queries(edges_df(spark, triples), q).collect()}
    assert rows[(0, 3)].path == ["0", "1", "2", "3"] and rows[(0, 3)].path_text == "0 -> 1 -> 2 -> 3"
    assert rows[(0, 3)].weight == 6.0
    assert rows[(0, 0)].path == ["0"] and rows[(0, 0)].weight == 0.0
    assert rows[(3, 0)].weight is None and rows[(3, 0)].path is None


def test_negative_weight_rejected(spark):
    with pytest.raises(ValueError):
        labels(spark, [(0, 1, -1)], [0])


def synth_edges(spark, n, pct, seed):
    e = route_edges(synthetic_flights(grid_nodes(spark, n, seed), pct, seed)).collect()
    return [(r.src, r.dst, r.weight) for r in e]


@pytest.mark.parametrize("n,pct,seed", [(30, 10, 1), (25, 4, 3)])
def test_against_brute_force(spark, n, pct, seed):
    triples = synth_edges(spark, n, pct, seed)
    sources = [0, 5, 17]
    got = labels(spark, triples, sources)
    want = {}
    for s in sources:
        want.update({(s, k): v for k, v in brute_labels(triples, s).items()})
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][1:] == want[k][1:] and got[k][0] == pytest.approx(want[k][0], rel=1e-12), k


def test_blocks_and_widths_give_same_labels(spark):
    """How edges are cut and how far a window reaches must not change a label."""
    triples = synth_edges(spark, 20, 30, 9)
    plain = labels(spark, triples, [0, 1])
    assert plain == labels(spark, triples, [0, 1], block=1, width=1.0) == labels(spark, triples, [0, 1], block=5, width=1e9)


def test_relaxation_invariants(spark):
    triples = synth_edges(spark, 40, 8, 5)
    lab = labels(spark, triples, [2])
    for a, b, w in triples:
        if (2, a) in lab:
            assert lab[(2, b)][0] <= lab[(2, a)][0] + w + 1e-9      # no edge can still improve
    by_edge = {(a, b): w for a, b, w in triples}
    for (s, v), (d, h, p) in lab.items():
        if p != -1:
            assert d == pytest.approx(lab[(s, p)][0] + by_edge[(p, v)])  # predecessor edge is tight
            assert h == lab[(s, p)][1] + 1


def test_reconstruct_walks_back_to_source(spark):
    triples = synth_edges(spark, 30, 5, 2)
    e = edges_df(spark, triples)
    st = shortest_paths(e, spark.createDataFrame([(0,)], "source long"))
    pairs = st.select("source", F.col("node").alias("destination"))
    out = reconstruct(st, pairs).collect()
    for r in out:
        assert r.path[0] == "0" and r.path[-1] == str(r.destination) and len(r.path) == r.hops + 1


def test_labels_do_not_depend_on_rounding(spark):
    """Weights whose floating-point sums differ in the last place tie exactly."""
    triples = [(0, 1, 1.0000000000000002), (0, 2, 0.5), (2, 1, 0.5), (1, 3, 1000.0)]
    lab = labels(spark, triples, [0])
    assert lab[(0, 1)] == (1.0, 1, 0) and lab[(0, 3)] == (1001.0, 2, 1)
    pairs = spark.createDataFrame([(0, i) for i in range(4)], "source long, destination long")
    for r in route_queries(edges_df(spark, triples), pairs).collect():
        assert r.hops == len(r.path) - 1


def test_targets_give_the_same_answers(spark):
    triples = synth_edges(spark, 40, 8, 6)
    e = edges_df(spark, triples)
    pairs = spark.createDataFrame([(0, 5), (0, 9), (3, 3), (7, 39), (11, 999)], "source long, destination long")
    full = shortest_paths(e, pairs)
    want = {(r.source, r.destination): (r.weight, r.hops, r.path_text) for r in reconstruct(full, pairs).collect()}
    got = {(r.source, r.destination): (r.weight, r.hops, r.path_text) for r in route_queries(e, pairs).collect()}
    assert got == want and got[(11, 999)] == (None, None, None)


def test_edges_hold_for_their_time(spark):
    """Queries with different moments over one graph see different weights."""
    e = spark.createDataFrame([(0, 1, 5.0, 0, 10), (0, 1, 1.0, 10, 99), (0, 2, 3.0, 0, 99), (2, 1, 1.0, 0, 99)],
                              "src long, dst long, weight double, since long, until long")
    q = spark.createDataFrame([(100, 0, 5, 1), (101, 0, 10, 1)], "source long, start long, asof long, destination long")
    got = {r.source: (r.weight, r.path) for r in route_queries(e, q).collect()}
    assert got == {100: (4.0, ["0", "2", "1"]), 101: (1.0, ["0", "1"])}


def test_repair_equals_a_full_solve_and_touches_less(spark):
    rng = random.Random(11)
    n = 90
    triples = [(a, rng.randrange(n), rng.randrange(1, 60)) for a in range(n) for _ in range(5)]
    triples = [(a, b, float(w)) for (a, b), w in {(a, b): w for a, b, w in triples}.items()]
    src = spark.createDataFrame([(0,), (7,)], "source long")
    before = shortest_paths(edges_df(spark, triples), src)
    routes = [t[:2] for t in triples]
    # one route up, one down, one gone, one new
    new = {(a, b): w for a, b, w in triples}
    new[routes[3]], new[routes[50]] = 500.0, 0.0
    del new[routes[200]]
    new[(88, 3)] = 1.5
    changed = [routes[3], routes[50], routes[200], (88, 3)]
    after = [(a, b, w) for (a, b), w in new.items()]
    stats: dict = {}
    got = repair_paths(before, edges_df(spark, after), spark.createDataFrame(changed, "src long, dst long"), stats).collect()
    want = {(s, v): lab for s in (0, 7) for v, lab in brute_labels(after, s).items()}
    assert {(r.source, r.node): (r.dist, r.hops, -1 if r.pred is None else r.pred) for r in got} == want
    assert stats["reset"] + stats["changed"] < len(want) / 2


def test_repair_leaves_heavy_edges_alone(spark):
    """A complete graph whose labels nearly all move: only the light edges of a label are relaxed."""
    draw = random.Random(5)
    before = [(a, b, float(draw.randint(200, 2400))) for a in range(60) for b in range(60) if a != b]
    changed = [(0, b) for b in range(1, 8)]
    after = [(a, b, 1.0 + b if (a, b) in changed else w) for a, b, w in before]
    old = spark.createDataFrame([(0, v, float(d), h, None if p < 0 else p) for v, (d, h, p) in brute_labels(before, 0).items()],
                                "source long, node long, dist double, hops long, pred long")
    stats: dict = {}
    got = repair_paths(old, edges_df(spark, after), spark.createDataFrame(changed, "src long, dst long"), stats).collect()
    assert {r.node: (r.dist, r.hops, -1 if r.pred is None else r.pred) for r in got} == brute_labels(after, 0)
    assert stats["changed"] > 50 and stats["relaxed"] < 30 * stats["changed"]



SEED = "source long, node long, l struct<dist:long,hops:long,pred:long>, asof long"


def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    return lambda: spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_no_round_shuffles_the_edges_or_old_labels(spark):
    """Only the frontier and its candidates move; edge blocks and label runs are read in place."""
    blocks, runs = EdgeBlocks(edges_df(spark, synth_edges(spark, 60, 40, 2))), LabelRuns(spark)
    undo = no_broadcast(spark)
    try:
        run, _ = runs.add(spark.createDataFrame([(0, i, (0, 0, None), 0) for i in range(60)], SEED))
        cand = relaxed(run, blocks, -1, 10 ** 12)
        best = runs.better(cand)
        plan = best._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Bucketed: true") >= 2
        moved = [x for x in plan.splitlines() if "Exchange" in x]
        assert len(moved) == 4 and not any("e_src" in x for x in moved), plan  # frontier by node, fences, frontier by block, candidates
    finally:
        undo()
        runs.drop()
        blocks.drop()


def test_hub_is_dealt_evenly(spark):
    """A hub of 20,000 edges asked by 200 sources: the join by block gives no task twice the median."""
    blocks = EdgeBlocks(edges_df(spark, [(0, i, 1 + i % 7) for i in range(20_000)]))
    undo = no_broadcast(spark)
    try:
        assert blocks.df.agg(F.max(F.size("edges"))).first()[0] == 64
        frontier = spark.createDataFrame([(s, 0, (0, 0, None), 0) for s in range(200)], SEED)
        cand = relaxed(frontier, blocks, -1, 10 ** 12)
        sizes = sorted(r["count"] for r in cand.groupBy(F.spark_partition_id()).count().collect())
        assert sum(sizes) == 4_000_000 and len(sizes) == 8
        assert sizes[-1] <= 2 * sizes[4] and sizes[0] >= sizes[4] / 2
        few = relaxed(frontier, blocks, 2 * SCALE, 4 * SCALE)  # only weights 3 and 4, and only their blocks
        assert few.count() == 200 * sum(1 for i in range(20_000) if 1 + i % 7 in (3, 4))
    finally:
        undo()
        blocks.drop()


def test_rounds_write_what_they_change(spark):
    """A long path from one source: a round writes its new labels, not all labels."""
    n = 9
    stats = []
    triples = [(i, i + 1, 1.0) for i in range(n)] + [(0, 100 + i, 5.0 + i) for i in range(300)]
    got = labels(spark, triples, [0], stats=stats, width=1000.0)
    assert len(got) == n + 301
    assert stats[0]["changed"] == 301 and all(s["changed"] == 1 for s in stats[1:n]) and stats[-1]["changed"] == 0
    runs = LabelRuns(spark)
    big = spark.range(20_000).selectExpr("0L AS source", "id AS node", "struct(id AS dist, 1L AS hops, 0L AS pred) AS l", "0L AS asof")
    runs.add(big)
    better = big.where("node < 10").selectExpr("source", "node", "struct(l.dist - 1 AS dist, l.hops, l.pred) AS l", "asof")
    run, m = runs.add(better.unionByName(big))
    size = lambda r: spark.read.parquet(runs.tables.path(r)).count()
    assert m["n"] == 10 and [size(r) for r in runs.runs] == [20_000, 10]
    merged, m = runs.merge()
    assert m["n"] == 20_000 and merged.where("l.dist = node - 1").count() == 10
    runs.drop()


def test_windows_relax_few_edges(spark):
    """Dense random graph: a fifth of the relaxations of one window without a limit, at most; same labels."""
    rng = random.Random(4)
    triples = [(a, b, rng.randrange(1, 2400)) for a in range(100) for b in range(100) if a != b]
    few, all_ = [], []
    assert labels(spark, triples, [0], stats=few) == labels(spark, triples, [0], stats=all_, width=1e9)
    assert 5 * sum(s["relaxed"] for s in few) <= sum(s["relaxed"] for s in all_)


def test_unreachable_part_and_no_sources(spark):
    triples = [(0, 1, 1.0), (1, 2, 900.0), (5, 6, 0.001), (6, 5, 0.001)]
    assert labels(spark, triples, [0, 5, 9]) == {(0, 0): (0.0, 0, -1), (0, 1): (1.0, 1, 0), (0, 2): (901.0, 2, 1),
                                                  (5, 5): (0.0, 0, -1), (5, 6): (0.001, 1, 5), (9, 9): (0.0, 0, -1)}
    assert labels(spark, triples, []) == {} and labels(spark, [], [3]) == {(3, 3): (0.0, 0, -1)}


def test_long_chain_needs_no_long_plan(spark):
    """2,000 hops: eleven doubling joins, one scan in the final plan."""
    n = 2000
    state = spark.range(n + 1).select(F.lit(0).cast("long").alias("source"), F.col("id").alias("node"), F.col("id").cast("double").alias("dist"),
                                      F.col("id").alias("hops"), F.when(F.col("id") > 0, F.col("id") - 1).alias("pred"))
    out = reconstruct(state, spark.createDataFrame([(0, n), (0, 1234), (0, 0)], "source long, destination long"))
    by = {r.destination: r.path for r in out.collect()}
    assert by[n] == [str(i) for i in range(n + 1)] and by[1234][-1] == "1234" and by[0] == ["0"]
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def tied_graph(n, out, seed):
    """Edges with small whole weights, zero too: many ties of distance and hops."""
    r = random.Random(seed)
    return sorted({(a, b): r.choice([0, 1, 1, 2, 3, 9]) for a in range(n) for b in r.sample(range(n), out)}.items())


@pytest.mark.parametrize("want", [None, 1])
def test_search_from_both_ends_gives_the_least_paths(spark, want):
    """Ties are broken as by the labels of a whole search, at every moment of a changing graph."""
    rows = [(a, b, float(w), *at) for (a, b), w in tied_graph(60, 3, 4) for at in [(0, 5), (5, 10)] if (a + b + at[0]) % 4]
    e = spark.createDataFrame(rows, "src long, dst long, weight double, since long, until long")
    asked = [(100 * asof + s, s, asof, d) for asof in (3, 7) for s in range(0, 60, 15) for d in range(0, 64, 3)]
    q = spark.createDataFrame(asked + [(None, None, 3, 1), (900, 2, 3, None)], "source long, start long, asof long, destination long")
    full = reconstruct(shortest_paths(e, q.where("start is not null")), q).collect()
    got = route_queries(e, q, want=want).collect()
    plain = [{(r.source, r.destination): (r.origin, r.dest, r.weight, r.hops, r.path_text) for r in x} for x in (full, got)]
    assert len(full) == len(got) and plain[0] == plain[1]
    assert sum(v[2] is not None for v in plain[1].values()) > 50


def test_pairs_do_not_label_the_whole_graph(spark):
    """Few labels for each end of a pair, and fewer rounds than hops."""
    r = random.Random(3)
    triples = [(a, b, r.randint(1, 1000)) for a in range(400) for b in r.sample(range(400), 40)]
    q = spark.createDataFrame([(a, (7 * a + 3) % 400) for a in range(0, 400, 10)], "source long, destination long")
    stats = []
    rows = route_queries(edges_df(spark, triples), q, stats=stats).collect()
    assert all(x.weight is not None for x in rows)
    assert stats[-1]["labels"] < 40 * 400 / 2  # one search from each start labels 40 x 400
    assert stats[0]["rounds"] <= 6
