"""The route graph kept up to date while flight files arrive (A3-A5).

The partial state of an average is its (sum, count), which merges by adding.  Each
batch reduces its own files to one row per route and writes them; readers add up the
rows of the last snapshot and of the batches since.  The stream itself holds no state,
so nothing grows with the routes in an executor's memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from routelytics.functions.durations import wrapped_duration
from routelytics.streaming.log import DeltaLog


def edge_log(spark: SparkSession, root: str, every: int = 8) -> DeltaLog:
    """(sum, count) per route, a batch's own ones in its delta."""
    def merged(rows):
        return rows.groupBy("src", "dst").agg(F.sum("total").alias("total"), F.sum("n_flights").alias("n_flights"))
    return DeltaLog(spark, root, "src long, dst long, total double, n_flights long", merged, every)


def edge_stream(spark: SparkSession, flights_path: str, schema: StructType, log: DeltaLog, checkpoint_location: str,
                files_per_batch: int | None = None):
    """Start the stream over the Parquet files of ``flights_path``: all that are there, then stop.

    Returns the ``StreamingQuery``; a later run with the same folders goes on
    with the sums of the earlier one.
    """
    files = spark.readStream.schema(schema)
    if files_per_batch:
        files = files.option("maxFilesPerTrigger", files_per_batch)

    def run(batch, batch_id):
        log.write(batch_id, batch.groupBy(F.col("org_id").alias("src"), F.col("dest_id").alias("dst")).agg(
            F.sum(wrapped_duration()).alias("total"), F.count(F.lit(1)).alias("n_flights")))

    return (files.parquet(flights_path).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint_location)
            .trigger(availableNow=True).start())


def current_edges(log: DeltaLog, batch_id: int) -> DataFrame:
    """``(src, dst, weight, n_flights)`` after a batch, as :func:`route_edges` over all files so far."""
    return log.read(batch_id).select("src", "dst", (F.col("total") / F.col("n_flights")).alias("weight"), "n_flights")
