"""Paths from shortest-path labels.

Only the requested paths are expanded.  A path of h hops has h + 1 steps, each
the ancestor of its destination at a known distance, and that distance is a sum
of powers of two: tables of the 1st, 2nd, 4th, ... ancestor of every label
(pointer doubling) resolve all steps of all paths in about log2(h) joins.  Every
level is written, so plans do not grow with the paths, and a hot
(source, node) is split by the skew join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routelytics.plans.meet import pair_paths
from routelytics.plans.sssp import SCALE
from routelytics.session import RoundTables, trace

ARROW = " -> "


def path_text(path) -> "F.Column":
    """Airport names joined with `` -> ``."""
    return F.array_join(path, ARROW)


def path_steps(state: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(source, destination, back, cur)``: the nodes of each wanted path.

    ``wanted``: ``(source, destination, hops)`` of labels in ``state``;
    ``back`` counts from the destination (0) to the start (hops).
    """
    tables = RoundTables(state.sparkSession, "routelytics-steps")
    rows, m = tables.write(wanted.select("source", "destination", "hops",
                                         F.explode(F.sequence(F.lit(0).cast("long"), F.col("hops"))).alias("back"),
                                         F.col("destination").alias("cur")),
                           longest=F.max("hops"))
    longest = m["longest"] or 0
    up, _ = tables.write(state.where(F.col("pred").isNotNull()).select("source", "node", F.col("pred").alias("up")))
    power = 1
    while power <= longest:
        jump = up.select("source", F.col("node").alias("cur"), "up")
        needs = F.col("back").bitwiseAND(F.lit(power)) != 0
        moved = rows.where(needs).join(jump, ["source", "cur"]).select(
            "source", "destination", "hops", "back", F.col("up").alias("cur"))
        rows, _ = tables.write(moved.unionByName(rows.where(~needs).select("source", "destination", "hops", "back", "cur")))
        power *= 2
        if power <= longest:
            nxt = up.select("source", F.col("node").alias("up"), F.col("up").alias("far"))
            up, _ = tables.write(up.join(nxt, ["source", "up"]).select("source", "node", F.col("far").alias("up")))
        trace(f"paths: ancestors at {power}")
    return rows.select("source", "destination", "back", "cur")


def reconstruct(state: DataFrame, pairs: DataFrame, airport_dim: DataFrame | None = None) -> DataFrame:
    """``(source, destination, origin, dest, weight, hops, path, path_text)`` per distinct pair.

    ``state`` is the output of :func:`shortest_paths`.  Unreachable pairs keep
    a row with null weight, hops and path (Decision D5b); a pair with source =
    destination has weight 0 and a one-name path.  Without ``airport_dim``
    the path lists node ids as text.  ``pairs`` may name the start of a source
    (``start``) where that is not the source id itself.
    """
    st = state.select("source", "node", "dist", "hops", "pred")
    begin = F.col("start") if "start" in pairs.columns else F.col("source")
    q = pairs.select(F.col("source").cast("long").alias("source"), begin.cast("long").alias("start"),
                     F.col("destination").cast("long").alias("destination")).distinct()
    tables = RoundTables(state.sparkSession, "routelytics-paths")
    found, _ = tables.write(q.join(st.select("source", F.col("node").alias("destination"), "dist", "hops"),
                                   ["source", "destination"], "left"))
    return _with_names(found, path_steps(st, found.where(F.col("dist").isNotNull())), airport_dim, tables)


def _with_names(found: DataFrame, steps: DataFrame, airport_dim: DataFrame | None, tables: RoundTables) -> DataFrame:
    """The rows of :func:`reconstruct` from ``(source, start, destination, dist, hops)`` and the steps of the paths."""
    if airport_dim is not None:
        names, _ = tables.write(airport_dim.select("airport_id", "name"))
        steps = steps.join(names.select(F.col("airport_id").alias("cur"), "name"), "cur", "left")
    else:
        steps = steps.withColumn("name", F.col("cur").cast("string"))
    paths = steps.groupBy("source", "destination").agg(
        F.sort_array(F.collect_list(F.struct("back", "name")), asc=False).alias("_walk"))
    paths = paths.select("source", "destination", F.transform("_walk", lambda x: x["name"]).alias("path"))
    out = found.join(paths, ["source", "destination"], "left")
    if airport_dim is not None:
        a = names.select(F.col("airport_id").alias("start"), F.col("name").alias("origin"))
        b = names.select(F.col("airport_id").alias("destination"), F.col("name").alias("dest"))
        out = out.join(a, "start", "left").join(b, "destination", "left")
    else:
        out = (out.withColumn("origin", F.col("start").cast("string"))
               .withColumn("dest", F.col("destination").cast("string")))
    result, _ = tables.write(out.select(
        "source", "destination", "origin", "dest", F.col("dist").alias("weight"),
        "hops", "path", path_text(F.col("path")).alias("path_text")))
    return result


def route_queries(edges: DataFrame, queries: DataFrame, airport_dim: DataFrame | None = None,
                  **kwargs) -> DataFrame:
    """Answer a table of ``(source, destination)`` route queries in one job.

    Every pair is searched from both its ends (:func:`pair_paths`).  Rows are as
    those of :func:`reconstruct`; ``start`` and ``asof`` are as in :func:`shortest_paths`.
    """
    start = F.col("start") if "start" in queries.columns else F.col("source")
    asof = F.col("asof") if "asof" in queries.columns else F.lit(0)
    tables = RoundTables(edges.sparkSession, "routelytics-paths")
    search = RoundTables(edges.sparkSession, "routelytics-balls")
    q, _ = tables.write(queries.select(
        F.col("source").cast("long").alias("source"), start.cast("long").alias("start"),
        F.col("destination").cast("long").alias("destination"), asof.cast("long").alias("asof")).distinct())
    try:
        got = pair_paths(edges, q.select("start", "destination", "asof"), search, **kwargs)
        found, _ = tables.write(q.join(got, ["start", "destination", "asof"], "left").select(
            "source", "start", "destination", (F.col("dist") / F.lit(float(SCALE))).alias("dist"), "hops", F.col("path").alias("back")))
    finally:
        search.clear()
    steps = found.select("source", "destination", F.posexplode("back").alias("back", "cur"))
    return _with_names(found.drop("back"), steps, airport_dim, tables)
