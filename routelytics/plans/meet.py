"""Shortest paths of many single pairs by a search from both ends.

Pairs are searched within tasks (:mod:`light`).  What that leaves open, or all where
the nodes are too many for a task's memory, is searched in rounds over the cluster:

A pair's path is found where the *ball* around its start, over the edges, meets
the ball around its destination, over the edges turned round.  A ball holds the
exact labels of all nodes up to its own limit.  Balls of about the square root of
the nodes meet for most pairs, so a source does not label the whole graph
for a destination far away.

Both kinds of balls grow in one loop: node ``v`` is ``2 v`` in the graph as it is
and ``2 v + 1`` in the graph turned round.  A ball that is too small, or whose pair is
still open, gets a larger limit, guessed from its growth so far; no guess
changes a result, since a pair is closed only if

* its best meeting is not longer than both limits together, or
* one of its balls has no edge left that leads out of it.

Paths of up to four light edges are made steps before, so a round goes four hops.

Labels are ``l = struct(dist, hops, path)`` and compare lexicographically.  ``path``
runs from the end nearer to the destination, so the least label of a start is the
one with the smallest predecessors (Decision D5d).  A shortest path leaves the first
ball by exactly one edge, and the node behind it lies in the second ball:
the least of all such compositions is the least path.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routelytics.plans.light import HELD, light_paths
from routelytics.plans.sssp import scaled
from routelytics.session import RoundTables, trace

#: Balls are first grown to so many times the square root of the nodes ...
FIRST = 1.5
#: ... and those of open pairs to so many times what the smaller one holds, then to the square of it times, and so on.
MORE = 6
#: The first limit lets an average node relax so many times the logarithm of that in edges (ties make balls larger).
START = 0.6
#: A last share of balls that are too small does not hold up the others.
FEW = 0.05
#: Paths of a few light edges are made steps if there are at most so many for an edge.
MOST = 8


def whole_weights(edges: DataFrame, plain: RoundTables) -> tuple[DataFrame, dict]:
    """Edges ``(src, dst, w)`` with weights in units of 1/SCALE, written once; how many, of how many nodes, and their light weights."""
    bad = F.raise_error(F.lit("shortest_paths needs non-negative edge weights")).cast("long")
    when = [F.col(c).cast("long").alias(c) for c in ("since", "until") if c in edges.columns]
    e = edges.where("src IS NOT NULL AND dst IS NOT NULL AND weight IS NOT NULL").select(
        F.col("src").cast("long").alias("src"), F.col("dst").cast("long").alias("dst"),
        F.when(F.col("weight") < 0, bad).otherwise(scaled(F.col("weight"))).alias("w"), *when)
    try:
        return plain.write(e, n=F.count(F.lit(1)), heads=F.approx_count_distinct("src"), tails=F.approx_count_distinct("dst"),
                           shares=F.percentile_approx("w", [2.0 ** -i for i in range(16)], 10_000))
    except Exception as err:
        if "non-negative" in str(err):
            raise ValueError("shortest_paths needs non-negative edge weights") from err
        raise


def two_way(edges: DataFrame) -> DataFrame:
    """Edges between nodes ``2 v``, and turned round between nodes ``2 v + 1``."""
    a, b = F.col("src") * 2, F.col("dst") * 2
    rest = [c for c in ("w", "since", "until") if c in edges.columns]
    ways = F.array(F.struct(a.alias("src"), b.alias("dst")), F.struct((b + 1).alias("src"), (a + 1).alias("dst")))
    return edges.select(F.explode(ways).alias("way"), *rest).select("way.*", *rest)


class Balls:
    """Labels up to a limit around each key ``(source, root, way, asof)``."""

    def __init__(self, edges: DataFrame, plain: RoundTables, keys: DataFrame, want: int | None, stats: list | None):
        self.plain, self.timed, self.stats = plain, "since" in edges.columns, [] if stats is None else stats
        self.edges, _ = plain.write(two_way(edges))
        self.tops, got = plain.write(self.edges.groupBy(F.col("src").alias("node")).agg(F.max("w").alias("top"), F.count(F.lit(1)).alias("n")),
                                     nodes=F.count(F.lit(1)), edges=F.sum("n"), top=F.coalesce(F.max("top"), F.lit(0)))
        nodes, n = max(got["nodes"] / 2, 1), max(got["edges"] or 0, 1)
        self.want = want or max(8, math.ceil(FIRST * math.sqrt(nodes)))
        # in a graph where edges lead anywhere, a ball is about e to the number of edges of a node below its limit
        limit = self.edges.agg(F.percentile_approx("w", min(1.0, START * math.log(self.want) * 2 * nodes / n), 100_000)).first()[0] or 0
        self.first, self.mean, self.n = limit, 0.0, 0
        self.step = max(1, limit >> 3 if limit else got["top"] >> 8)
        self.hops = self._jumps(self._light(limit), limit, MOST * n)
        self.keys, _ = plain.write(keys.select("source", "root", "way", "asof", F.lit(limit).cast("long").alias("limit"),
                                               F.lit(-1).cast("long").alias("before")))
        zero = F.struct(F.lit(0).cast("long").alias("dist"), F.lit(0).cast("long").alias("hops"), F.array("root").alias("path"))
        self.state = None
        self.work, _ = plain.write(self.keys.select("source", (F.col("root") * 2 + F.col("way")).alias("node"), zero.alias("l"),
                                                    "asof", F.lit(True).alias("fresh")))

    def _light(self, limit: int) -> DataFrame:
        """Edges up to ``limit`` as steps ``(src, dst, s)``, ``s`` a label whose path leaves out the start."""
        when = ["since", "until"] * self.timed
        return self.edges.where(F.col("w") <= limit).select("src", "dst", F.struct(
            F.col("w").alias("dist"), F.lit(1).cast("long").alias("hops"), F.array(F.shiftright("dst", 1)).alias("path")).alias("s"), *when)

    def _jumps(self, steps: DataFrame, limit: int, most: int) -> DataFrame:
        """Steps of up to four edges and up to ``limit``, or of fewer where there would be more than ``most``.

        They save rounds and change no label: a part of a least path is a least path.
        """
        ends = ["src", "dst"] + ["since", "until"] * self.timed
        steps, m = self.plain.write(steps.groupBy(*ends).agg(F.min("s").alias("s")), n=F.count(F.lit(1)))
        for _ in range(2):
            many = steps.groupBy(F.col("dst").alias("src")).agg(F.count(F.lit(1)).alias("i")).join(
                steps.groupBy("src").agg(F.count(F.lit(1)).alias("o")), "src").agg(F.sum(F.col("i") * F.col("o"))).first()[0] or 0
            trace(f"balls: {m['n']} steps, {many} pairs of them")
            if many > most:
                break
            first = steps.select(F.col("src").alias("a"), F.col("dst").alias("src"), F.col("s").alias("s1"),
                                 *[F.col(c).alias(f"{c}1") for c in ends[2:]])
            two = first.join(steps, "src").where(f"s1.dist + s.dist <= {limit}L AND a <> dst")
            path = "CASE WHEN dst & 1 = 0 THEN concat(s.path, s1.path) ELSE concat(s1.path, s.path) END"
            when = ["greatest(since, since1) AS since", "least(until, until1) AS until"] * self.timed
            two = two.selectExpr("a AS src", "dst", *when,
                                 f"named_struct('dist', s1.dist + s.dist, 'hops', s1.hops + s.hops, 'path', {path}) AS s")
            if self.timed:
                two = two.where("since < until")
            steps, m = self.plain.write(steps.select(*ends, "s").unionByName(two).groupBy(*ends).agg(F.min("s").alias("s")), n=F.count(F.lit(1)))
        return steps

    def settle(self) -> None:
        """Relax from ``work`` until no label within the limits changes; then ``keys`` know their balls."""
        k = self.keys.select("source", "limit", "before")
        far = k.agg(F.max("limit")).first()[0] or 0
        when = ["since", "until"] * self.timed
        steps, _ = self.plain.write(self.hops.select("src", "dst", "s", *when).unionByName(self._light(far)))
        on = "s.dist <= high AND s.dist > low" + " AND since <= asof AND asof < until" * self.timed
        rounds = 0
        while True:
            rounds += 1
            f = self.work.where("fresh").join(k, "source").selectExpr(
                "source", "node AS src", "asof", "l", "limit - l.dist AS high", "CASE WHEN l.dist <= before THEN before - l.dist ELSE -1L END AS low")
            cand = f.join(steps, "src").where(on).selectExpr(
                "source", "dst AS node", "named_struct('dist', l.dist + s.dist, 'hops', l.hops + s.hops, 'path', "
                "CASE WHEN dst & 1 = 0 THEN concat(s.path, l.path) ELSE concat(l.path, s.path) END) AS l", "asof", "NULL AS was")
            best = self.work.selectExpr("source", "node", "l", "asof", "l AS was").unionByName(cand).groupBy("source", "node").agg(
                F.min("l").alias("l"), F.max("asof").alias("asof"), F.min("was").alias("was"))
            self.work, m = self.plain.write(best.selectExpr("source", "node", "l", "asof", "was IS NULL OR l < was AS fresh"),
                                            n=F.count_if("fresh"))
            trace(f"balls: round {rounds}: {m['n']} labels changed")
            if not m["n"]:
                break
        state = self.work.drop("fresh")
        if self.state is not None:
            state = self.state.join(self.keys.where("small").select("source"), "source", "left_anti").unionByName(state)
        self.state, _ = self.plain.write(state)
        size = self.state.join(self.tops.select("node", "top"), "node", "left").groupBy("source").agg(
            F.count(F.lit(1)).alias("held"), F.max(F.col("l.dist") + F.col("top")).alias("rest"))
        self.keys, m = self.plain.write(self.keys.select("source", "root", "way", "asof", "limit", "before").join(size, "source")
                                        .withColumn("whole", F.expr("rest IS NULL OR rest <= limit")),
                                        held=F.sum("held"), whole=F.count_if("whole"), n=F.count(F.lit(1)))
        self.n = m["n"]
        self.mean = self.mean or (m["held"] or 0) / max(self.n, 1)  # at the first limit
        self.stats.append({"rounds": rounds, "labels": m["held"]})
        trace(f"balls: {m['n']} of {m['held']} labels, {m['whole']} whole")

    def widen(self, wanted: DataFrame, few: float = 0.0, times: int = 1) -> bool:
        """Larger limits for the balls that hold fewer labels than ``wanted`` ``(source, want)``.

        False, and nothing done, if these are not more than the share ``few`` of all balls.
        """
        k = self.keys.join(wanted, "source", "left").withColumn("small", F.expr("NOT whole AND coalesce(held < want, false)"))
        # the ball of an average key is about e to its limit
        grow = F.expr(f"{self.first * times} * ln(1.3 * want / held) / {math.log(max(self.mean, 2.0))}")
        far = F.least("rest", F.col("limit") + F.greatest(F.ceil(grow).cast("long"), F.lit(self.step * times)))
        keys, m = self.plain.write(k.select(
            "source", "root", "way", "asof", F.when(F.col("small"), far).otherwise(F.col("limit")).alias("limit"),
            F.col("limit").alias("before"), "held", "rest", "whole", "small"), n=F.count_if("small"))
        trace(f"balls: {m['n']} small ones")
        if m["n"] <= few * self.n:
            return False
        self.keys = keys
        self.work = self.state.join(self.keys.where("small").select("source"), "source", "left_semi").withColumn("fresh", F.lit(True))
        return True

    def meet(self, pairs: DataFrame) -> tuple[DataFrame, DataFrame, int]:
        """Answers ``(a, b, dist, hops, path)``, the pairs ``(a, b)`` still open, and how many these are."""
        k = self.keys.select("source", "limit", "whole", "held")
        both, _ = self.plain.write(
            pairs.join(k.toDF("a", "limit_a", "whole_a", "held_a"), "a").join(k.toDF("b", "limit_b", "whole_b", "held_b"), "b"))
        # a whole second ball holds the start itself: no edge has to be crossed
        reach = both.where("NOT whole_a").groupBy(F.col("a").alias("source"), "limit_a").agg(
            F.max(F.expr("CASE WHEN whole_b THEN 0L ELSE limit_b END")).alias("more"))
        first = self.state.join(both.select(F.col("a").alias("source")).distinct(), "source", "left_semi")
        out = self.state.join(reach, "source").selectExpr(
            "source", "node", "asof", "l.dist AS dist", "l.hops AS hops", "limit_a + more - l.dist AS high", "limit_a - l.dist AS low")
        far = both.agg(F.expr("max(limit_a + limit_b)")).first()[0] or 0
        cross = self.edges.where(F.col("w") <= far).withColumnRenamed("src", "node")
        over = out.join(cross, "node").where("w <= high AND w > low" + " AND since <= asof AND asof < until" * self.timed).selectExpr(
            "source AS a", "shiftright(dst, 1) AS y", "dist + w AS dist_a", "hops + 1 AS hops_a", "node AS x")
        front = first.selectExpr("source AS a", "shiftright(node, 1) AS y", "l.dist AS dist_a", "l.hops AS hops_a",
                                 "node AS x").unionByName(over)
        back = both.join(self.state.selectExpr("source AS b", "shiftright(node, 1) AS y", "l.dist AS dist_b", "l.hops AS hops_b"), "b")
        met = back.join(front, ["a", "y"]).selectExpr(
            "a", "b", "y", "x", "dist_a + dist_b AS dist", "hops_a + hops_b AS hops",
            "whole_a OR whole_b OR dist_a + dist_b <= limit_a + limit_b AS sure").where("sure").drop("sure")
        met, _ = self.plain.write(met)
        near = met.groupBy("a", "b").agg(F.min("dist").alias("dist")).join(met, ["a", "b", "dist"])
        best = near.groupBy("a", "b", "dist").agg(F.min("hops").alias("hops")).join(near, ["a", "b", "dist", "hops"])
        ends = self.state.selectExpr("source AS a", "node AS x", "l.path AS path_a")
        starts = self.state.selectExpr("source AS b", "shiftright(node, 1) AS y", "l.path AS path_b")
        whole = best.join(ends, ["a", "x"]).join(starts, ["b", "y"]).selectExpr(
            "a", "b", "dist", "hops", "concat(path_b, CASE WHEN x = 2 * y THEN slice(path_a, 2, size(path_a)) ELSE path_a END) AS path")
        found, _ = self.plain.write(whole.groupBy("a", "b", "dist", "hops").agg(F.min("path").alias("path")))
        left, m = self.plain.write(both.where("NOT whole_a AND NOT whole_b").select("a", "b", "held_a", "held_b").join(
            found.select("a", "b"), ["a", "b"], "left_anti"), n=F.count(F.lit(1)))
        trace(f"balls: {m['n']} pairs open")
        return found, left, m["n"]


def pair_paths(edges: DataFrame, pairs: DataFrame, plain: RoundTables, want: int | None = None, held: int = HELD,
               stats: list | None = None) -> DataFrame:
    """``(start, destination, asof, dist, hops, path)`` of each reachable pair ``(start, destination, asof)``.

    ``dist`` is in units of 1/SCALE, ``path`` runs from the destination back to the start.
    ``edges`` may carry ``since`` and ``until`` (see ``shortest_paths``).  Pairs are searched within tasks over
    at most ``held`` light edges (:func:`light_paths`), what that leaves open in rounds (:class:`Balls`).  ``want`` is
    the number of labels that balls are first grown to (any gives the same paths).  Node ids lie
    below 2^62.  ``stats`` gets a dict for the search within tasks and for each growth of the balls: rounds, labels held.
    The tables of the result are those of ``plain``.
    """
    pairs, _ = plain.write(pairs.where("start IS NOT NULL AND destination IS NOT NULL").distinct())
    e, m = whole_weights(edges, plain)
    answers, left, n = light_paths(e, m, pairs, plain, want, held, stats)
    if not n:
        return answers
    rest = ball_paths(e, left, plain, want, stats)
    return rest if answers is None else answers.unionByName(rest)


def ball_paths(edges: DataFrame, pairs: DataFrame, plain: RoundTables, want: int | None = None, stats: list | None = None) -> DataFrame:
    """:func:`pair_paths` by rounds over the cluster, over edges with whole weights ``w``."""
    ends = pairs.select(F.col("start").alias("root"), F.lit(0).alias("way"), "asof").unionByName(
        pairs.select(F.col("destination").alias("root"), F.lit(1).alias("way"), "asof")).distinct()
    keys, _ = plain.write(ends.withColumn("source", F.monotonically_increasing_id()))
    left, _ = plain.write(pairs.join(keys.where("way = 0").select(F.col("source").alias("a"), F.col("root").alias("start"), "asof"), ["start", "asof"])
                          .join(keys.where("way = 1").select(F.col("source").alias("b"), F.col("root").alias("destination"), "asof"),
                                ["destination", "asof"]))
    ab, left = left, left.select("a", "b")
    balls, answers = Balls(edges, plain, keys, want, stats), []
    wanted, times, more = keys.select("source", F.lit(balls.want).alias("want")), 1, MORE
    balls.settle()
    while balls.widen(wanted, FEW, times):
        balls.settle()
        times *= 2
    while True:
        found, left, n = balls.meet(left)
        answers.append(found)
        if not n:
            break
        # of two balls the smaller one grows; the other one follows if that was not enough
        least = F.ceil(F.least("held_a", "held_b") * F.lit(float(more))).cast("long")
        wanted, _ = plain.write(left.select(F.explode(F.array("a", "b")).alias("source"), least.alias("want")).groupBy("source").agg(
            F.max("want").alias("want")))
        left = left.select("a", "b")
        if not balls.widen(wanted):
            raise AssertionError("an open pair has a ball that can grow")
        balls.settle()
        more *= MORE
    got = answers[0]
    for more in answers[1:]:
        got = got.unionByName(more)
    return ab.join(got, ["a", "b"]).select("start", "destination", "asof", "dist", "hops", "path")
