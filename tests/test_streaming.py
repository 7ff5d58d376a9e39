import os

import pytest

from routelytics.operators.edges import route_edges
from routelytics.streaming.commands import command_stream, last_before, override_log, timed_edges
from routelytics.streaming.edges import current_edges, edge_log, edge_stream


@pytest.fixture
def shell(spark, tmp_path):
    base = spark.createDataFrame([(1, 2, 10.0), (2, 3, 10.0), (1, 3, 50.0)], "src long, dst long, weight double")
    dim = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C"), (9, "C")], "airport_id long, name string")
    root = str(tmp_path)
    os.makedirs(f"{root}/in")

    def run(every=8, per_batch=None, **files):
        for at, (name, text) in enumerate(files.items()):
            with open(f"{root}/in/{name}.txt", "w") as f:
                f.write(text)
            os.utime(f.name, (1_700_000_000 + at, 1_700_000_000 + at))  # batches follow the files' times
        q = command_stream(spark, f"{root}/in", base, dim, f"{root}/out", f"{root}/state", f"{root}/ckpt",
                           files_per_batch=per_batch, snapshot_every=every)
        q.awaitTermination(300)
        answers = {(r.seq, r.origin, r.dest): (r.weight, r.path_text) for r in spark.read.parquet(f"{root}/out/answers").collect()}
        rejected = {(r.line, r.reason) for r in spark.read.parquet(f"{root}/out/rejected").collect()}
        return answers, rejected
    return run


def test_answers_follow_the_sequence_numbers(shell):
    """Queries see only overrides before them, whatever file and line they are in."""
    answers, rejected = shell(
        a="5 info A C\n40 info A C\n41 info C A\n" + "0 info A B\n" * 200,
        b="30 time A C 30\n",
        c="10 time A C 5\n20 info A C\nbogus line\n21 time A Z 1\n22 info A Z\n23 time A B x\n24 fly A B\ninfo A B\n25 time A B -1\n")
    assert answers[(5, "A", "C")] == (20.0, "A -> B -> C")
    assert answers[(20, "A", "C")] == (5.0, "A -> C")
    assert answers[(40, "A", "C")] == (20.0, "A -> B -> C")
    assert answers[(41, "C", "A")] == (None, None)
    assert answers[(0, "A", "B")] == (10.0, "A -> B") and len(answers) == 5
    assert rejected == {("bogus line", "no sequence number"), ("21 time A Z 1", "unknown airport"), ("22 info A Z", "unknown airport"),
                        ("23 time A B x", "bad weight"), ("24 fly A B", "unknown command"), ("info A B", "no sequence number"),
                        ("25 time A B -1", "bad weight")}


def test_a_later_run_keeps_the_overrides(shell):
    shell(a="1 time A C 5\n2 info A C\n")
    answers, _ = shell(b="9 info A C\n")
    assert answers == {(2, "A", "C"): (5.0, "A -> C"), (9, "A", "C"): (5.0, "A -> C")}


def test_many_batches_read_few_folders(spark, shell, tmp_path):
    """Every batch holds one override; the last one's answers see all, from a snapshot and a few deltas."""
    files = {f"f{i:02}": f"{i} time A C {100 - i}\n" for i in range(1, 13)}
    answers, _ = shell(every=4, per_batch=1, **files, f90="5 info A C\n99 info A C\n", f91="98 time A C 3\n", f92="100 info A C\n")
    assert answers[(99, "A", "C")] == (20.0, "A -> B -> C") and answers[(100, "A", "C")] == (3.0, "A -> C")
    log = override_log(spark, f"{tmp_path}/state", 4)
    assert log.read(14).count() == 13 and log.read(5).count() == 6
    assert max(len(log.folders(b)) for b in range(1000)) == 5 and len(log.folders(14)) == 4
    assert sorted(os.listdir(f"{tmp_path}/state/snapshots")) == ["up_to=11", "up_to=3", "up_to=7"]


def test_intervals_of_one_hot_route(spark):
    """2,000 overrides of one route, in many partitions, and one of another."""
    ov = spark.range(2000).selectExpr("id * 3 AS seq", "1L AS src", "2L AS dst", "double(id) AS weight").unionByName(
        spark.createDataFrame([(7, 2, 2, 9.0)], "seq long, src long, dst long, weight double"))
    edges = spark.createDataFrame([(1, 2, 0.5), (5, 6, 1.5)], "src long, dst long, weight double")
    got = {(r.src, r.dst, r.since): (r.weight, r.until) for r in timed_edges(edges, ov).collect()}
    assert len(got) == 2003 and got[(2, 2, 7)] == (9.0, 1 << 62) and got[(1, 2, -(1 << 62))] == (0.5, 0)
    assert all(got[(1, 2, 3 * i)] == (float(i), 3 * i + 3 if i < 1999 else 1 << 62) for i in range(2000))
    asked = spark.createDataFrame([(4, "x")] * 500 + [(-1, "y"), (9999, "z"), (3, "w")], "seq long, cmd string")
    seen = last_before(asked, ov).groupBy("cmd").agg({"asof": "min", "*": "count"}).collect()
    assert {r.cmd: (r["min(asof)"], r["count(1)"]) for r in seen} == {"x": (3, 500), "y": (-(1 << 62), 1), "z": (5997, 1), "w": (3, 1)}


def test_edges_follow_the_flight_files(spark, tmp_path):
    """After each batch the streamed graph is that of all files so far; a second run goes on."""
    rows = [(i % 3, i % 4, 100.0 * (i % 7), 100.0 * (i % 5)) for i in range(60)]
    schema = "org_id long, dest_id long, dep_time double, arr_time double"
    flights = spark.createDataFrame(rows, schema)
    key = lambda r: (r.src, r.dst)
    log = edge_log(spark, f"{tmp_path}/log", every=2)
    for run, part in enumerate((flights.limit(20), flights.offset(20))):
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        q = edge_stream(spark, f"{tmp_path}/in", flights.schema, log, f"{tmp_path}/ckpt", files_per_batch=1)
        q.awaitTermination(200)
        want = sorted(route_edges(flights.limit(20) if run == 0 else flights).collect(), key=key)
        got = sorted(current_edges(log, run).collect(), key=key)
        assert [(r.src, r.dst, r.n_flights) for r in got] == [(r.src, r.dst, r.n_flights) for r in want]
        assert all(abs(a.weight - b.weight) < 1e-9 for a, b in zip(got, want))


def test_the_edge_stream_holds_no_state(spark, tmp_path):
    """Sums lie in the log alone: deltas hold a batch's own routes, and adding them up gives the graph."""
    rows = [(i % 3, i % 4, 100.0 * (i % 7), 100.0 * (i % 5)) for i in range(60)] + [(None, 1, 0.0, 3.0)]
    flights = spark.createDataFrame(rows, "org_id long, dest_id long, dep_time double, arr_time double")
    flights.repartition(3).write.parquet(f"{tmp_path}/in")
    log = edge_log(spark, f"{tmp_path}/log", every=2)
    q = edge_stream(spark, f"{tmp_path}/in", flights.schema, log, f"{tmp_path}/ckpt", files_per_batch=1)
    q.awaitTermination(200)
    assert not q.lastProgress["stateOperators"] and not os.path.exists(f"{tmp_path}/ckpt/state")
    deltas = spark.read.schema(log.schema).parquet(*[f"{tmp_path}/log/deltas/batch={b}" for b in range(3)])
    assert deltas.agg({"n_flights": "sum"}).collect()[0][0] == 61
    key = lambda r: (r.src is None, r.src or 0, r.dst)
    assert sorted(current_edges(log, 2).collect(), key=key) == sorted(route_edges(flights).collect(), key=key)
