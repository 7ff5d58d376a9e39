"""Connected components of a link table by alternating large and small stars.

Each half step is a grouped minimum (map-side partials) joined back to the
links, written as a table under the checkpoint folder; a node with very many
links is split by the skew join, never gathered.  Rounds grow with the
logarithm of a component's size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from routelytics.session import RoundTables


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links (u, v) with v < u; every node points to the least id it can see."""
    both = links
    if large:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    got = both.join(least, "u")
    if large:
        out = got.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = got.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return out.filter("u > v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); the component is its least node.

    Self links are ignored; an empty table gives an empty result.
    """
    tables = RoundTables(links.sparkSession, "components", keep=2)
    state = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    mark = {"n": F.count(F.lit(1)), "h": F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))}
    state, before = tables.write(state, **mark)
    while before["n"]:
        state, now = tables.write(_star(_star(state, True), False), **mark)
        if now == before:
            break
        before = now
    roots = state.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return state.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
