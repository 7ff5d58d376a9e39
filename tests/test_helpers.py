import os
import tempfile

from pyspark.sql import functions as F

from routelytics.functions.durations import clock_minutes, raw_duration, wrapped_duration
from routelytics.operators.airports import ambiguous_airports
from routelytics.operators.edges import transpose
from routelytics.plans.sssp import distance_to, shortest_paths
from routelytics.sources.derived import derived_flights
from routelytics.sources.flights import flights_to_lines, read_flights, write_table

from conftest import SF_TINY


def test_durations(spark):
    df = spark.createDataFrame([(959.0, 1001.0), (2330.0, 15.0), (100.0, 100.0)], "dep_time double, arr_time double")
    got = df.select(raw_duration().alias("r"), wrapped_duration().alias("w"), clock_minutes().alias("m")).collect()
    assert [(r.r, r.w, r.m) for r in got] == [(42.0, 42.0, 2.0), (-2315.0, 85.0, 45.0), (0.0, 0.0, 0.0)]


def test_transpose_and_distance_to(spark):
    e = spark.createDataFrame([(0, 1, 2.0), (1, 2, 3.0)], "src long, dst long, weight double")
    assert {(r.src, r.dst) for r in transpose(e).collect()} == {(1, 0), (2, 1)}
    st = shortest_paths(e, spark.createDataFrame([(0,)], "source long"))
    assert [(r.source, r.dist) for r in distance_to(st, 2).collect()] == [(0, 5.0)]
    assert distance_to(st, 9).count() == 0


def test_ambiguous_airports(spark):
    fl = spark.createDataFrame([(1, "A", 2, "B"), (1, "X", 3, "B")],
                               "org_id long, origin string, dest_id long, dest string")
    got = {(r.airport_id, r.kind) for r in ambiguous_airports(fl).collect()}
    assert got == {(1, "id"), (2, "name"), (3, "name")}


def test_write_then_read_flights(spark):
    fl = derived_flights(spark, SF_TINY)
    out = os.path.join(tempfile.mkdtemp(prefix="routelytics-csv-"), "flights")
    write_table(flights_to_lines(fl), out, fmt="text")
    back = read_flights(spark, out, mode="strict")
    assert back.count() == fl.count() and back.exceptAll(fl).count() == 0
    assert back.agg(F.sum("distance")).first()[0] == fl.agg(F.sum("distance")).first()[0]
