"""Shortest paths after a change of some edges (G7, U2 with G1).

Labels whose path uses a changed route are reset, found by following the
predecessor tree from the changed routes.  The others are still lengths of real
paths, so only two kinds of edges can improve anything: those that lead into a
reset node, and the changed routes.  From their candidates the usual rounds go on
until no label changes.  Work follows the labels that the change touches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routelytics.plans.sssp import GROWTH, KEY, SCALE, EdgeBlocks, LabelRuns, _label, _open_sources, scaled, settle
from routelytics.session import RoundTables, trace


def reset_labels(old: DataFrame, changed: DataFrame, tables: RoundTables) -> tuple[DataFrame, int]:
    """``(source, node)`` of labels whose path uses a changed route ``(src, dst)``, and how many."""
    first = old.join(changed, (F.col("l.pred") == F.col("src")) & (F.col("node") == F.col("dst")), "left_semi")
    lost, m = tables.write(first.select(*KEY), n=F.count(F.lit(1)))
    behind, total = lost, m["n"]
    while m["n"]:
        up = behind.select("source", F.col("node").alias("up"))
        nxt = (old.withColumn("up", F.col("l.pred")).join(up, ["source", "up"], "left_semi")
               .select(*KEY).join(lost, KEY, "left_anti"))
        behind, m = tables.write(nxt, n=F.count(F.lit(1)))
        if m["n"]:
            lost, total = lost.unionByName(behind), total + m["n"]
    return lost, total


def repair_paths(labels: DataFrame, edges: DataFrame, changed: DataFrame, stats: dict | None = None) -> DataFrame:
    """Labels as :func:`shortest_paths` over ``edges`` would give them.

    ``labels``: the labels of all reachable nodes over the graph before;
    ``edges``: the graph after; ``changed``: the routes ``(src, dst)`` whose
    weight differs, that are new, or that are gone (others do no harm).
    ``stats`` gets the number of labels reset and changed.
    """
    spark = labels.sparkSession
    tables, runs = RoundTables(spark, "routelytics-repair"), LabelRuns(spark)
    old, _ = tables.write(labels.select(*KEY, _label(scaled(F.col("dist")), F.col("hops"), F.col("pred")).alias("l"),
                                        F.lit(0).cast("long").alias("asof")))
    changed, _ = tables.write(changed.select(F.col("src").cast("long"), F.col("dst").cast("long")).distinct())
    edges, _ = tables.write(edges.select("src", "dst", "weight"))  # read several times below
    blocks = EdgeBlocks(edges)
    try:
        lost, n_lost = reset_labels(old, changed, tables)
        same = old.join(lost, KEY, "left_anti")
        kept, _ = runs.add(same)
        e = edges.where("weight is not null").select(F.col("src").cast("long").alias("src"), F.col("dst").cast("long").alias("dst"),
                                                     scaled(F.col("weight")).alias("w"))
        into = lost.join(e, lost.node == e.dst).select("source", "src", "dst", "w").join(
            kept.select("source", F.col("node").alias("src"), "l", "asof"), ["source", "src"])
        over = e.join(changed, ["src", "dst"]).join(kept.select("source", F.col("node").alias("src"), "l", "asof"), "src")
        cand = into.select("source", "src", "dst", "w", "l", "asof").unionByName(over.select("source", "src", "dst", "w", "l", "asof"))
        run, m = runs.add(cand.select("source", F.col("dst").alias("node"),
                                      _label(F.col("l.dist") + F.col("w"), F.col("l.hops") + 1, F.col("src")).alias("l"), "asof"))
        rounds: list = []
        frontier, before, limit = run.where("moved"), -1, blocks.width
        was = same.select(*KEY, F.col("l").alias("was"))
        while m["n"]:
            settle(runs, frontier, blocks, before, limit, tables, rounds)
            merged, end = runs.merge()
            # labels up to the limit are final
            if limit >= (end["far"] or 0) + blocks.heaviest or (
                    limit >= (end["far"] or 0) and _open_sources(merged, blocks, None).isEmpty()):
                break
            # of the others only those that are new since the change have edges to relax
            frontier = merged.join(was, KEY, "left").where("NOT l <=> was").select(*merged.columns)
            before, limit = limit, limit * GROWTH
        trace(f"repair: {n_lost} labels reset, {m['n']} changed at once")
        if stats is not None:
            stats |= {"reset": n_lost, "changed": m["n"] + sum(r["changed"] for r in rounds), "relaxed": sum(r["relaxed"] for r in rounds)}
        if len(runs.runs) > 1:
            runs.merge()
        state = runs.close()
    except BaseException:
        runs.drop()
        raise
    finally:
        blocks.drop()
        tables.clear()
    return state.select("source", "node", (F.col("l.dist") / F.lit(float(SCALE))).alias("dist"),
                        F.col("l.hops").alias("hops"), F.col("l.pred").alias("pred"))
