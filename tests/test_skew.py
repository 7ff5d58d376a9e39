"""Heavy keys, salted joins and durable ids."""

import pytest
from pyspark.sql import functions as F

from routelytics.operators.airports import IdTable
from routelytics.operators.edges import direct_weights
from routelytics.operators.skew import heavy_keys, salted_join


@pytest.fixture
def no_broadcast(spark):
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"]
    old = {n: spark.conf.get(n) for n in names}
    for n, v in zip(names, ("-1", "false")):
        spark.conf.set(n, v)
    yield
    for n, v in old.items():
        spark.conf.set(n, v)


def test_heavy_keys(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, 9).otherwise(F.col("id")).alias("k"))
    assert sorted(heavy_keys(df, "k")) == [7, 9]
    assert heavy_keys(spark.range(5000).withColumnRenamed("id", "k"), "k") == []
    assert heavy_keys(spark.range(0).withColumnRenamed("id", "k"), "k") == []
    assert heavy_keys(spark.range(9).select(F.lit(None).cast("long").alias("k")), "k") == []


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_salted_join_equals_the_plain_one(spark, how):
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 7 == 0, None).otherwise(F.col("id")).alias("k"), "id")
    right = spark.createDataFrame([(1, "a"), (1, "b"), (5, "c"), (None, "d"), (9999, "e")], "k long, v string")
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(salted_join(left, right, "k", how)) == rows(left.join(right, "k", how))


def test_direct_weights_with_a_hot_destination(spark, no_broadcast):
    """A third of the flights go to one airport: every task of the join gets about as many."""
    flights = spark.range(60_000).select((F.col("id") % 50).alias("org_id"),
                                         F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 997).alias("dest_id"))
    edges = spark.createDataFrame([(0, 5, 2.5), (0, 6, 1.0), (1, 7, 9.0)], "src long, dst long, weight double")
    got = direct_weights(flights, edges, 0)
    assert "SortMergeJoin" in got._jdf.queryExecution().executedPlan().toString()
    sizes = sorted(r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect())
    assert sum(sizes) == 60_000 and len(sizes) == 8 and sizes[-1] <= 1.5 * sizes[4]
    by = {r.weight: r["count"] for r in got.groupBy("weight").count().collect()}
    assert by[2.5] >= 20_000 and by[2.5] + by[1.0] + by[None] == 60_000


def test_ids_stay_over_loads(spark, tmp_path):
    ids = IdTable(spark, str(tmp_path))
    frame = lambda *a: spark.createDataFrame([(i, f"n{i}") for i in a], "airport_id long, name string")
    table = lambda df: {r.airport_id: r.node_id for r in df.collect()}
    assert table(ids.add(0, frame(30, 10, 20))) == {10: 0, 20: 1, 30: 2}
    assert table(ids.add(1, frame(5, 10, 40, 30))) == {10: 0, 20: 1, 30: 2, 5: 3, 40: 4}
    assert table(ids.add(1, frame(5, 10, 40, 30))) == {10: 0, 20: 1, 30: 2, 5: 3, 40: 4}  # repeated after a failure
    assert table(ids.add(2, frame(10))) == {10: 0, 20: 1, 30: 2, 5: 3, 40: 4}
