"""The interactive route shell as a Structured Streaming job.

The original program reads commands one by one from stdin:

* ``time A B w`` — set the weight of route A -> B to w (add it if missing);
* ``info A B``   — print the shortest route from A to B.

Here commands arrive as text lines in files dropped into a folder (any
``readStream`` text source works), and as files and lines of a stream have no
order of their own, each line begins with its sequence number:
``17 time A B 5``.  An ``info`` is answered over the overrides whose number is
not above its own, from its own and all earlier batches, whatever file they
came in; lines without a number, with an unknown command or airport, or with a
weight that is not a whole number from 0 on go to the rejected output.

All answers of a batch come from one shortest-path job: every edge carries the
interval of sequence numbers in which it holds, and every query the number of
the last override it sees, so queries of one start and one state of the graph
share their labels.

Overrides, answers and rejects are written with ``overwrite`` into a
``batch_id=<n>`` folder each, so a batch that Spark replays after a failure
rewrites the same files instead of appending twice.  A snapshot of all overrides
every few batches bounds what a later batch reads.  The caller names the
folders of input, output, state and stream checkpoint; a later run with the
same folders goes on with the overrides of the earlier one.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from routelytics.operators.airports import dense_index, names_to_ids
from routelytics.plans.paths import route_queries
from routelytics.session import cut_lineage
from routelytics.streaming.log import DeltaLog

_FIRST, _LAST = -(1 << 62), 1 << 62


def parse_commands(lines: DataFrame, airport_dim: DataFrame) -> DataFrame:
    """``(line, seq, cmd, a, b, src, dst, weight, reason)``; a null reason means a good command."""
    parts = F.split(F.trim(F.col("value")), " +", -1)
    number = F.get(parts, 0)
    c = lines.select(F.col("value").alias("line"), F.when(number.rlike("^[0-9]{1,18}$"), number.try_cast("long")).alias("seq"),
                     F.get(parts, 1).alias("cmd"), F.get(parts, 2).alias("a"), F.get(parts, 3).alias("b"),
                     F.get(parts, 4).try_cast("int").cast("double").alias("weight"))
    c = names_to_ids(names_to_ids(c, "a", "src", airport_dim), "b", "dst", airport_dim)
    known = F.coalesce(F.col("cmd").isin("time", "info"), F.lit(False))
    reason = (F.when(F.col("seq").isNull(), "no sequence number").when(~known, "unknown command")
              .when(F.col("src").isNull() | F.col("dst").isNull(), "unknown airport")
              .when((F.col("cmd") == "time") & ~F.coalesce(F.col("weight") >= 0, F.lit(False)), "bad weight"))
    return c.select("line", "seq", "cmd", "a", "b", "src", "dst", "weight", reason.alias("reason"))


def _ordered(df: DataFrame, *order: str) -> tuple[DataFrame, DataFrame]:
    """``df`` dealt in order over range partitions (``_p``), and one row per partition: its least row ``head``."""
    rows = cut_lineage(df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()))
    return rows, rows.groupBy("_p").agg(F.min(F.struct(*order)).alias("head"))


def timed_edges(edges: DataFrame, overrides: DataFrame) -> DataFrame:
    """``(src, dst, weight, since, until)``: when each weight of a route holds.

    A base edge holds until the first override of its route, an override from
    its own number until the next one.  Overrides are scanned in order of route
    and number, and a partition's last one is followed by the first of the
    next, so many overrides of one route are spread over tasks.
    """
    last = overrides.groupBy("src", "dst", "seq").agg(F.max("weight").alias("weight"))
    rows, heads = _ordered(last, "src", "dst", "seq")
    after = heads.select("_p", F.lead("head").over(Window.orderBy("_p")).alias("after"))
    here = F.lead(F.struct("src", "dst", "seq")).over(Window.partitionBy("_p").orderBy("src", "dst", "seq"))
    nxt = F.coalesce("here", "after")
    same = (nxt["src"] == F.col("src")) & (nxt["dst"] == F.col("dst"))
    ov = (rows.withColumn("here", here).join(F.broadcast(after), "_p")  # one row per partition
          .select("src", "dst", "weight", F.col("seq").alias("since"),
                  F.coalesce(F.when(same, nxt["seq"]), F.lit(_LAST)).alias("until")))
    first = overrides.groupBy("src", "dst").agg(F.min("seq").alias("first"))
    base = edges.select("src", "dst", F.col("weight").cast("double").alias("weight")).join(first, ["src", "dst"], "left")
    return base.select("src", "dst", "weight", F.lit(_FIRST).alias("since"),
                       F.coalesce("first", F.lit(_LAST)).alias("until")).unionByName(ov)


def last_before(asked: DataFrame, overrides: DataFrame) -> DataFrame:
    """``asked`` (with seq) and ``asof``: the largest override number up to its own.

    The distinct numbers, of queries and overrides, are range-partitioned and scanned
    in order; one row per partition carries the largest override number on to the
    next, so neither one task nor a number that many queries share sees all.
    """
    numbers = asked.select("seq", F.lit(None).cast("long").alias("mark")).unionByName(
        overrides.select("seq", F.col("seq").alias("mark")))
    numbers = numbers.groupBy("seq").agg(F.max("mark").alias("mark"))
    rows, _ = _ordered(numbers, "seq")
    ends = rows.groupBy("_p").agg(F.max("mark").alias("end"))
    before = ends.select("_p", F.max("end").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)).alias("old"))
    here = F.max("mark").over(Window.partitionBy("_p").orderBy("seq"))
    found = (rows.join(F.broadcast(before), "_p")  # one row per partition
             .select("seq", F.coalesce(here, "old", F.lit(_FIRST)).alias("asof")))
    return asked.join(found, "seq")


def override_log(spark: SparkSession, root: str, every: int = 8) -> DeltaLog:
    """The overrides of all batches, one row per route and number."""
    def merged(rows):
        return rows.groupBy("src", "dst", "seq").agg(F.max("weight").alias("weight")).select("seq", "src", "dst", "weight")
    return DeltaLog(spark, root, "seq long, src long, dst long, weight double", merged, every)


def answer(edges: DataFrame, infos: DataFrame, overrides: DataFrame, airport_dim: DataFrame) -> DataFrame:
    """One row per ``infos`` row (seq, cmd, src, dst): seq, names, weight, hops and path."""
    asked = cut_lineage(last_before(infos.select("seq", "cmd", "src", "dst"), overrides))
    groups = asked.select(F.struct("src", "asof").alias("k")).distinct()
    groups = cut_lineage(dense_index(groups, "k", "source").select("source", F.col("k.src").alias("start"), F.col("k.asof").alias("asof")))
    asked = asked.withColumnRenamed("src", "start").join(groups, ["start", "asof"])
    got = route_queries(timed_edges(edges, overrides), asked.select("source", "start", "asof", F.col("dst").alias("destination")),
                        airport_dim)
    return asked.select("seq", "source", F.col("dst").alias("destination")).join(got, ["source", "destination"]).select(
        "seq", "origin", "dest", "weight", "hops", "path_text")


def process_batch(spark: SparkSession, batch: DataFrame, batch_id: int, base_edges: DataFrame,
                  airport_dim: DataFrame, output_path: str, log: DeltaLog) -> None:
    """Apply one micro-batch of commands (see module docstring)."""
    part = f"batch_id={batch_id}"
    cmds = cut_lineage(parse_commands(batch, airport_dim))
    (cmds.where("reason is not null").select("line", "reason")
     .write.mode("overwrite").parquet(os.path.join(output_path, "rejected", part)))
    good = cmds.where("reason is null")
    log.write(batch_id, good.where("cmd = 'time'").select("seq", "src", "dst", "weight"))
    infos = good.where("cmd = 'info'")
    if infos.isEmpty():
        return
    (answer(base_edges, infos, log.read(batch_id), airport_dim)
     .write.mode("overwrite").parquet(os.path.join(output_path, "answers", part)))


def command_stream(spark: SparkSession, commands_path: str, base_edges: DataFrame, airport_dim: DataFrame,
                   output_path: str, state_path: str, checkpoint_location: str, available_now: bool = True,
                   files_per_batch: int | None = None, snapshot_every: int = 8):
    """Start the command stream; returns the ``StreamingQuery``.

    ``base_edges``: ``(src, dst, weight)`` route graph; ``airport_dim``:
    ``(airport_id, name)``.  Answers go to ``output_path``/answers, refused
    lines to ``output_path``/rejected.  With ``available_now`` the query
    processes what is in ``commands_path`` and stops (``awaitTermination`` to wait),
    in batches of ``files_per_batch`` files where given.
    """
    edges = cut_lineage(base_edges.select("src", "dst", "weight"))
    dim = cut_lineage(airport_dim.select("airport_id", "name"))

    log = override_log(spark, state_path, snapshot_every)

    def run(batch, batch_id):
        process_batch(spark, batch, batch_id, edges, dim, output_path, log)

    lines = spark.readStream
    if files_per_batch:
        lines = lines.option("maxFilesPerTrigger", files_per_batch)
    writer = (lines.text(commands_path).writeStream
              .foreachBatch(run).option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="5 seconds")
    return writer.start()
