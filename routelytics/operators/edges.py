"""The weighted route graph.

Edges are keyed by airport ids: ``(src, dst, weight, n_flights)``, one row
per route, weight = mean wrapped duration of its flights.  Flights are
aggregated before anything is joined, so the 100 TB side is reduced to one
row per route by map-side partial aggregation and nothing else touches it.

The original kept the graph as an MLlib coordinate matrix, transposed it
and turned it into one sparse row per destination.  Here the coordinate
form is the edge DataFrame itself and the row form is a *block-sparse*
incoming adjacency: one row per (destination, block of ``block_size``
source ids), so a hub with millions of incoming routes is spread over many
bounded rows instead of one giant vector.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routelytics.functions.durations import raw_duration, wrapped_duration
from routelytics.operators.skew import salted_join

DEFAULT_BLOCK = 1024


def route_edges(flights: DataFrame) -> DataFrame:
    """Directed route graph ``(src, dst, weight, n_flights)`` by airport id."""
    return flights.groupBy(F.col("org_id").alias("src"), F.col("dest_id").alias("dst")).agg(
        F.avg(wrapped_duration()).alias("weight"),
        F.count(F.lit(1)).alias("n_flights"),
    )


def route_sums(flights: DataFrame) -> DataFrame:
    """The flight table reduced once: ``(org_id, origin, dest_id, dest, total, n)``.

    Names, airports, the busiest airport and the route graph all follow from
    it (:func:`edges_from_sums`), so a plan that needs several of them scans
    the flights a single time.
    """
    return flights.groupBy("org_id", "origin", "dest_id", "dest").agg(
        F.sum(wrapped_duration()).alias("total"), F.count(F.lit(1)).alias("n"))


def edges_from_sums(sums: DataFrame) -> DataFrame:
    """:func:`route_edges` from :func:`route_sums`."""
    return sums.groupBy(F.col("org_id").alias("src"), F.col("dest_id").alias("dst")).agg(
        (F.sum("total") / F.sum("n")).alias("weight"), F.sum("n").alias("n_flights"))


def raw_edges_transposed(flights: DataFrame) -> DataFrame:
    """Mean raw (unwrapped) duration per route, destination first: ``(dst, src, weight)``."""
    return flights.groupBy(F.col("dest_id").alias("dst"), F.col("org_id").alias("src")).agg(
        F.avg(raw_duration()).alias("weight"))


def transpose(edges: DataFrame) -> DataFrame:
    """Swap the roles of ``src`` and ``dst`` (M2)."""
    return edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"),
                        *[c for c in edges.columns if c not in ("src", "dst")])


def incoming_adjacency(edges: DataFrame, block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """``(dst, block, incoming map<src, weight>)`` with ``block = floor(src / block_size)`` (M3 M4).

    Each map holds at most ``block_size`` entries, whatever the in-degree.
    """
    return (edges.withColumn("block", F.floor(F.col("src") / block_size))
            .groupBy("dst", "block")
            .agg(F.map_from_entries(F.sort_array(F.collect_list(
                F.struct(F.col("src"), F.col("weight").cast("double"))))).alias("incoming")))


def adjacency_get(adjacency: DataFrame, pairs: DataFrame, block_size: int = DEFAULT_BLOCK,
                  src_col: str = "src", dst_col: str = "dst") -> DataFrame:
    """Weight of edge ``src -> dst`` for each pair, read from the adjacency rows (M5).

    Adds ``weight``; null when there is no such edge (Decision D5).
    """
    p = pairs.withColumn("_block", F.floor(F.col(src_col) / block_size))
    a = adjacency.select(F.col("dst").alias("_adst"), F.col("block").alias("_ablock"), "incoming")
    j = p.join(a, (F.col(dst_col) == F.col("_adst")) & (F.col("_block") == F.col("_ablock")), "left")
    return j.select(*[F.col(c) for c in pairs.columns],
                    F.try_element_at(F.col("incoming"), F.col(src_col)).alias("weight"))


def edge_weight(edges: DataFrame, pairs: DataFrame, src_col: str = "src",
                dst_col: str = "dst") -> DataFrame:
    """Edge lookup for many pairs at once (F3 F4): pairs plus ``weight`` (null if absent)."""
    e = edges.select(F.col("src").alias("_esrc"), F.col("dst").alias("_edst"), F.col("weight"))
    j = pairs.join(e, (F.col(src_col) == F.col("_esrc")) & (F.col(dst_col) == F.col("_edst")), "left")
    return j.select(*[F.col(c) for c in pairs.columns], "weight")


def direct_weights(flights: DataFrame, edges: DataFrame, source: int) -> DataFrame:
    """For every flight, the weight of the direct edge ``source -> flight destination``.

    ``(dst, weight)`` per flight, weight null when ``source`` has no such edge.
    Only the source's out-edges take part in the join; destinations that hold a
    large part of the flights are salted.
    """
    out = edges.where(F.col("src") == F.lit(source)).select("dst", "weight")
    return salted_join(flights.select(F.col("dest_id").alias("dst")), out, "dst")
