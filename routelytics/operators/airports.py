"""The airport dimension (G10 J3 A10, Decision D1).

An airport is an ``airport_id`` (org_id / dest_id of a flight) with a name.
``node_id`` is the rank of ``airport_id`` from 0, so it is the same on every
executor and every run.  The numbering never moves the table into one
task: rows are range-partitioned and sorted by id, each task numbers its own
rows, and a table of one row per partition turns those numbers into global
offsets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from routelytics.session import cut_lineage


def _endpoints(flights: DataFrame) -> DataFrame:
    """Both ends of every flight, from one scan: ``(airport_id, name)``."""
    ends = F.array(F.struct(F.col("org_id").alias("airport_id"), F.col("origin").alias("name")),
                   F.struct(F.col("dest_id").alias("airport_id"), F.col("dest").alias("name")))
    return flights.select(F.inline(ends))


def airport_names(flights: DataFrame) -> DataFrame:
    """``(airport_id, name, n_names)``: one name per id (the least), and how many were seen."""
    return (_endpoints(flights).groupBy("airport_id")
            .agg(F.min("name").alias("name"), F.count_distinct("name").alias("n_names")))


def ambiguous_airports(flights: DataFrame) -> DataFrame:
    """Ids seen with more than one name, or names used by more than one id."""
    e = _endpoints(flights).distinct()
    by_id = (e.groupBy("airport_id").agg(F.count("*").alias("n"))
             .where("n > 1").select("airport_id", F.lit("id").alias("kind")))
    by_name = (e.groupBy("name").agg(F.count("*").alias("n")).where("n > 1")
               .join(e, "name").select("airport_id", F.lit("name").alias("kind")))
    return by_id.unionByName(by_name).distinct()


def dense_index(df: DataFrame, key: str, out: str = "node_id") -> DataFrame:
    """Add ``out`` = 0-based rank of the unique column ``key``, computed distributedly."""
    ordered = (df.repartitionByRange(key).sortWithinPartitions(key)
               .withColumn("_pid", F.spark_partition_id())
               .withColumn("_mid", F.monotonically_increasing_id()))
    ordered = cut_lineage(ordered)
    counts = ordered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: bounded by the partition count, safe to broadcast
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (ordered.join(F.broadcast(offsets), "_pid")
            .withColumn(out, F.col("_off") + local)
            .drop("_pid", "_mid", "_off"))


def airports(flights: DataFrame) -> DataFrame:
    """``(airport_id, name, node_id)`` for every origin or destination."""
    return dense_index(airport_names(flights).drop("n_names"), "airport_id", "node_id")


class IdTable:
    """Append-only ids of airports: an airport keeps the id of the load that brought it.

    A load's new airports (anti-join) are numbered in order of ``airport_id`` from the
    number of airports so far, and appended as a folder; ids are dense over all loads.
    A load that is repeated after a failure rewrites its own folder.
    """

    SCHEMA = "airport_id long, name string, node_id long"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _folder(self, load: int) -> str:
        return f"{self.path.rstrip('/')}/load={load}"

    def read(self, load: int) -> DataFrame:
        """``(airport_id, name, node_id)`` after the loads 0 to ``load``."""
        return self.spark.read.schema(self.SCHEMA).parquet(*[self._folder(i) for i in range(load + 1)])

    def add(self, load: int, names: DataFrame) -> DataFrame:
        """Number the airports of ``names`` (airport_id, name) that no earlier load holds; the table after it."""
        new, first = names.select("airport_id", "name"), 0
        if load:
            old = self.read(load - 1)
            first = old.count()
            new = new.join(old.select("airport_id"), "airport_id", "left_anti")
        numbered = dense_index(new, "airport_id", "at")
        numbered.select(F.col("airport_id").cast("long").alias("airport_id"), "name", (F.col("at") + first).alias("node_id")
                        ).write.mode("overwrite").parquet(self._folder(load))
        return self.read(load)


def airport_count(flights: DataFrame) -> DataFrame:
    """Number of distinct airports (origins and destinations): ``(n_airports)``."""
    return _endpoints(flights).select("airport_id").distinct().agg(
        F.count(F.lit(1)).alias("n_airports"))


def ids_by_name(airport_dim: DataFrame) -> DataFrame:
    """``(name, airport_id)``: one row per name; of several airports the least id."""
    return airport_dim.groupBy("name").agg(F.min("airport_id").alias("airport_id"))


def names_to_ids(df: DataFrame, name_col: str, out: str, airport_dim: DataFrame) -> DataFrame:
    """Left join that maps an airport name column to its ``airport_id`` (null if unknown).

    A name that several airports share means the one with the least id (see
    :func:`ambiguous_airports`), so a row never multiplies.
    """
    a = ids_by_name(airport_dim).select(F.col("name").alias(name_col), F.col("airport_id").alias(out))
    return df.join(a, name_col, "left")
