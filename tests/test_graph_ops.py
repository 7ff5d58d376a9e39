from pyspark.sql import functions as F

from routelytics.operators.airports import airport_count, airports
from routelytics.operators.edges import adjacency_get, edge_weight, incoming_adjacency, route_edges
from routelytics.operators.overrides import (apply_overrides, latest_overrides, override_rows, parse_override_commands,
                                             rejected_override_commands)
from routelytics.sources.synthetic import connections, grid_nodes, synthetic_flights


def test_overrides_latest_wins_and_adds(spark):
    edges = spark.createDataFrame([(0, 1, 5.0, 3), (1, 2, 7.0, 1)], "src long, dst long, weight double, n_flights long")
    ov = spark.createDataFrame([(1, 0, 1, 9.0), (2, 0, 1, 4.0), (3, 2, 0, 1.0)],
                               "seq long, src long, dst long, weight double")
    got = {(r.src, r.dst): (r.weight, r.overridden) for r in apply_overrides(edges, ov).collect()}
    assert got == {(0, 1): (4.0, True), (1, 2): (7.0, False), (2, 0): (1.0, True)}
    assert latest_overrides(ov).count() == 2


def test_parse_override_commands(spark):
    dim = spark.createDataFrame([(10, "A"), (20, "B")], "airport_id long, name string")
    cmds = spark.createDataFrame([(1, "time A B 7"), (2, "time A C 7"), (3, "time B A -1"), (4, "info A B")],
                                 "seq long, value string")
    got = [(r.seq, r.src, r.dst, r.weight) for r in parse_override_commands(cmds, dim).collect()]
    assert got == [(1, 10, 20, 7.0)]


def test_names_shared_by_airports_mean_the_least_id(spark):
    dim = spark.createDataFrame([(30, "A"), (10, "A"), (20, "B")], "airport_id long, name string")
    cmds = spark.createDataFrame([(1, "time A B 7"), (2, "time A")], "seq long, value string")
    got = [(r.seq, r.src, r.dst, r.weight) for r in parse_override_commands(cmds, dim).collect()]
    assert got == [(1, 10, 20, 7.0)]
    assert [r.seq for r in rejected_override_commands(cmds, dim).collect()] == [2]


def test_override_rows_keep_their_order(spark):
    got = override_rows(spark, [(0, 1, 5), (0, 1, 3)])
    assert [(r.src, r.dst, r.weight) for r in latest_overrides(got).collect()] == [(0, 1, 3.0)]
    assert override_rows(spark, []).count() == 0


def test_generator_over_a_table(spark):
    nodes = spark.createDataFrame([(70, "x", 0, 0), (10, "y", 3, 4), (40, "z", 9, 0)], "id long, name string, x long, y long")
    fl = synthetic_flights(nodes, 100, 1).collect()
    assert len(fl) == 3 * (1 + 3) and {r.org_id for r in fl} == {10, 40, 70}
    place = {10: (3, 4), 40: (9, 0), 70: (0, 0)}
    for r in fl:
        (a, b), (c, d) = place[r.org_id], place[r.dest_id]
        assert r.distance == int(((a - c) ** 2 + (b - d) ** 2) ** 0.5) and r.origin == {70: "x", 10: "y", 40: "z"}[r.org_id]
    assert synthetic_flights(nodes.limit(0), 100, 1).count() == 0


def test_adjacency_blocks_and_lookup(spark):
    e = spark.createDataFrame([(s, 7, float(s)) for s in range(10)] + [(7, 3, 1.5)],
                              "src long, dst long, weight double")
    adj = incoming_adjacency(e, block_size=4)
    rows = adj.where("dst = 7").collect()
    assert sorted(r.block for r in rows) == [0, 1, 2]
    assert max(len(r.incoming) for r in rows) <= 4
    pairs = spark.createDataFrame([(5, 7), (3, 7), (7, 3), (3, 5)], "src long, dst long")
    got = {(r.src, r.dst): r.weight for r in adjacency_get(adj, pairs, 4).collect()}
    assert got == {(5, 7): 5.0, (3, 7): 3.0, (7, 3): 1.5, (3, 5): None}
    got2 = {(r.src, r.dst): r.weight for r in edge_weight(e, pairs).collect()}
    assert got == got2


def test_airports_dense_ids(spark):
    fl = synthetic_flights(grid_nodes(spark, 50, 1), 4, 1).withColumn("org_id", F.col("org_id") * 3 + 1000) \
        .withColumn("dest_id", F.col("dest_id") * 3 + 1000)
    a = airports(fl).orderBy("airport_id").collect()
    assert [r.node_id for r in a] == list(range(50))
    assert airport_count(fl).first().n_airports == 50


def test_synthetic_shape(spark):
    n, pct = 40, 10
    fl = synthetic_flights(grid_nodes(spark, n, 3), pct, 3)
    assert fl.count() == n * (1 + connections(n, pct))
    ring = fl.where(F.col("dest_id") == (F.col("org_id") + 1) % n).select("org_id").distinct().count()
    assert ring == n
    bad = fl.where((F.col("distance") < 0) | (F.col("distance") >= 2400)
                   | (F.col("arr_time") - F.col("dep_time") != F.col("distance"))).count()
    assert bad == 0
    assert connections(10, 150) == 10 and connections(10, -5) == 0


def test_generated_flights_are_not_shuffled(spark, monkeypatch):
    """Only airports move: an origin's flights lie in one task, also for a grouping by route; any sizes give the same rows."""
    from routelytics.sources import synthetic

    nodes = grid_nodes(spark, 60, 3).withColumn("id", F.when(F.col("id") > 50, F.col("id") - 3).otherwise(F.col("id")))  # repeated ids
    want = synthetic_flights(nodes, 50, 3).collect()
    edges = route_edges(synthetic_flights(nodes, 50, 3))
    shuffles = [x for x in edges._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange" in x and "Broadcast" not in x]
    assert len(shuffles) == 1 and "REPARTITION_BY_NUM" in shuffles[0]
    assert sum(r.n_flights for r in edges.collect()) == len(want) == 60 * 31
    monkeypatch.setattr(synthetic, "FLIGHTS_A_TASK", 100)
    assert sorted(synthetic_flights(nodes, 50, 3).collect()) == sorted(want)
    monkeypatch.setattr(synthetic, "BROADCAST_AIRPORTS", 0)
    assert sorted(synthetic_flights(nodes, 50, 3).collect()) == sorted(want)
