"""Shortest paths from many sources in one distributed job.

Distances are whole numbers inside the loop: weights are scaled by
``SCALE`` and rounded once, so sums are exact, equal paths compare equal
and the labels do not depend on the order in which edges are relaxed.

A label is ``l = struct(dist, hops, pred)`` per (source, node) reached.  Labels
compare lexicographically, so the kept label is the cheapest path, then the
one with fewest hops, then the smallest predecessor id (Decision D5d); a
zero-weight cycle can never improve a label because it adds hops.

**Edges in blocks** (:class:`EdgeBlocks`).  Edges are sorted by (src, weight)
over range partitions, numbered, and cut into blocks of ``block`` edges keyed
(src, block), written once as a bucketed table.  A node has one row of *fences*,
the least weight of each of its blocks.  A frontier row meets its node's fences and
visits only the blocks that hold weights it needs, so a hub's edges are many
small keys dealt evenly over the tasks, and heavy edges are not read.

**Distance windows.**  The loop settles distances up to a limit, then up to
``GROWTH`` times that limit, and so on (delta-stepping with growing buckets).
The first limit is a quantile of the weights: about ``EDGES_A_NODE`` edges of an
average node are lighter.  Within a window only edges with dist + weight in the
window are relaxed, rounds repeat until no label changes, and then all labels
up to the limit are final.  Edges of settled labels that lead beyond the limit
wait for the next window.  A source is done when all its targets are settled,
or when it has labels for all nodes that have in-edges; the loop ends when all
sources are done or no edge is left.  No size or budget changes a result.

**Labels as runs** (:class:`LabelRuns`).  A round writes the labels that it changed,
and nothing else, as a run: a table bucketed by (source, node).  Candidates are
shuffled and reduced once per round and meet the runs in place; runs are merged
at the end of a window or when there are more than ``RUNS`` of them.  Where a label
up to the limit fits into one number (:class:`Packing`), candidates are reduced by
a hash aggregation of numbers instead of a sorted one of structs.

All tables lie under the session's checkpoint folder, so a lost executor re-reads
files; they are deleted when nothing reads them any more.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from routelytics.operators.airports import dense_index
from routelytics.session import RoundTables, checkpoint_dir, delete_path, trace

#: Units of the loop's whole-number distances per unit of weight.
SCALE = 1_000_000
#: Out-edges per block.
BLOCK = 64
#: The first limit lets an average node relax about so many edges.
EDGES_A_NODE = 16
#: Each limit is so many times the one before.
GROWTH = 4
#: Runs that a window may add before they are merged.
RUNS = 6
KEY = ["source", "node"]


def scaled(weight):
    """Weight column as a whole number of 1/SCALE units."""
    return F.round(weight.cast("double") * SCALE).cast("long")


def _label(dist, hops, pred) -> Column:
    return F.struct(dist.cast("long").alias("dist"), hops.cast("long").alias("hops"), pred.cast("long").alias("pred"))


class BucketedTables:
    """Tables of the session's catalog whose files lie under the checkpoint folder."""

    def __init__(self, spark: SparkSession, prefix: str):
        self.spark, self.name = spark, f"{prefix}_{uuid.uuid4().hex}"
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/{self.name}"
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.made = 0

    def write(self, df: DataFrame, *key: str, **metrics) -> tuple[str, dict]:
        """Write ``df`` bucketed by ``key``; its name and the metrics observed."""
        self.made += 1
        name, obs = f"{self.name}_{self.made}", None
        df = df.repartition(self.buckets, *key)
        if metrics:
            obs = Observation(name)
            df = df.observe(obs, *[c.alias(k) for k, c in metrics.items()])
        df.write.bucketBy(self.buckets, *key).sortBy(*key).option("path", self.path(name)).saveAsTable(name)
        return name, obs.get if obs else {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name.rsplit('_', 1)[1]}"

    def drop(self, name: str, files: bool = True) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        if files:
            delete_path(self.spark, self.path(name))


@dataclass(frozen=True)
class Packing:
    """A label as one whole number in the order of labels: a minimum of numbers needs no sort."""

    lo: int
    preds: int
    hops: int

    @property
    def pack(self) -> str:
        return f"(l.dist * {self.hops}L + l.hops) * {self.preds}L + (l.pred - ({self.lo}L))"

    @property
    def unpack(self) -> str:
        rest = f"(k div {self.preds}L)"
        return (f"named_struct('dist', {rest} div {self.hops}L, 'hops', {rest} % {self.hops}L, "
                f"'pred', k % {self.preds}L + ({self.lo}L))")


class EdgeBlocks:
    """Out-edges in blocks keyed (e_src, e_block), lightest first; ``drop`` removes them.

    ``since`` and ``until`` columns, where present, say for which moments an
    edge holds (see ``shortest_paths``).
    """

    def __init__(self, edges: DataFrame, block: int = BLOCK):
        spark = edges.sparkSession
        self.spark = spark
        self.timed = "since" in edges.columns
        when = [F.col("since").cast("long").alias("since"), F.col("until").cast("long").alias("until")] if self.timed else []
        weight = F.when(F.col("weight") < 0, F.raise_error(F.lit("shortest_paths needs non-negative edge weights")).cast("long"))
        e = edges.where(F.col("weight").isNotNull()).select(
            F.struct(F.col("src").cast("long").alias("src"), weight.otherwise(scaled(F.col("weight"))).alias("w"),
                     F.col("dst").cast("long").alias("dst"), *when).alias("e"))
        self.tables, self.plain = BucketedTables(spark, "routelytics_edges"), RoundTables(spark, "routelytics-fences")
        try:
            ranked = dense_index(e, "e", "at")
        except Exception as err:
            if "non-negative" in str(err):
                raise ValueError("shortest_paths needs non-negative edge weights") from err
            raise
        one = F.struct(*[f"e.{c}" for c in ["w", "dst"] + ["since", "until"] * self.timed])
        blocks = ranked.groupBy(F.col("e.src").alias("e_src"), F.floor(F.col("at") / block).alias("e_block")).agg(
            F.collect_list(one).alias("edges"), F.min("e.w").alias("fence"))  # ``block`` edges at most
        self.blocks, got = self.tables.write(blocks, "e_src", "e_block", blocks=F.count(F.lit(1)))
        self.df = spark.table(self.blocks)
        fences = self.df.groupBy(F.col("e_src").alias("node")).agg(
            F.sort_array(F.collect_list(F.struct("e_block", "fence"))).alias("fences"))
        self.fences, nodes = self.plain.write(fences, n=F.count(F.lit(1)))
        shares = [2.0 ** -k for k in range(20)]
        m = self.df.select("e_src", F.explode("edges.w").alias("w")).agg(
            F.count(F.lit(1)).alias("n"), F.max("w").alias("most"), F.min("e_src").alias("lo"), F.max("e_src").alias("hi"),
            F.percentile_approx("w", shares).alias("q")).first()
        self.heaviest, self.ids, self.hops = m["most"] or 0, (m["lo"] or 0, m["hi"] or 0), nodes["n"] + 1
        wanted = EDGES_A_NODE * max(nodes["n"], 1) / max(m["n"], 1)  # share of the edges
        light = [q for q, s in zip(m["q"] or [1], shares) if s <= wanted or s == shares[-1]]
        self.width = max(light[0], self.heaviest >> 20, 1)
        trace(f"sssp: {m['n']} edges of {nodes['n']} nodes in {got['blocks']} blocks, first limit {self.width / SCALE}")

    def packing(self, limit: int) -> "Packing | None":
        """Labels up to ``limit`` as one number, if they fit: a path leaves each node once."""
        lo, hi = self.ids
        return Packing(lo, hi - lo + 1, self.hops) if (limit + 1) * self.hops * (hi - lo + 1) < 1 << 63 else None

    def heads(self) -> DataFrame:
        """Nodes with in-edges."""
        return self.df.select(F.explode("edges.dst").alias("node")).distinct()

    def drop(self) -> None:
        self.tables.drop(self.blocks)
        self.plain.clear()


_PART = ["node", "source", "l", "asof", "high", "low"]


def relaxed(frontier: DataFrame, blocks: EdgeBlocks, before: int, limit: int) -> DataFrame:
    """Candidates ``(source, node, l, asof)`` that the frontier's edges give with a distance in the window.

    Labels up to ``before`` have relaxed what leads up to ``before`` already.
    """
    # expressions as text: a round is small work for the cluster, so the driver's part counts
    f = frontier.selectExpr("source", "node", "l", "asof", f"{limit}L - l.dist AS high",
                            f"CASE WHEN l.dist <= {before}L THEN {before}L - l.dist ELSE -1L END AS low")
    # blocks whose lightest edge is not too heavy and which end above ``low``
    f = f.join(blocks.fences, "node").selectExpr(*_PART, "filter(fences, x -> x.fence <= high) AS light")
    f = f.selectExpr(*_PART, "explode(slice(light, greatest(size(filter(light, x -> x.fence <= low)), 1), size(light)).e_block) AS block")
    got = f.join(blocks.df, F.expr("node = e_src AND block = e_block")).selectExpr(*_PART[1:], "e_src", "inline(edges)")
    on = "w <= high AND w > low" + " AND since <= asof AND asof < until" * blocks.timed
    return got.where(on).selectExpr("source", "dst AS node", "named_struct('dist', l.dist + w, 'hops', l.hops + 1, 'pred', e_src) AS l", "asof")


class LabelRuns:
    """Labels as runs ``(source, node, l, asof, moved)``, the least label of a key counts."""

    def __init__(self, spark: SparkSession):
        self.spark, self.tables = spark, BucketedTables(spark, "routelytics_labels")
        self.runs: list[str] = []
        self._olds: dict[str, DataFrame] = {}  # runs as the joins see them

    def better(self, cand: DataFrame, packing: Packing | None = None) -> DataFrame:
        """Candidates reduced to one per key, if better than all runs: ``(source, node, l, asof, moved)``.

        ``moved`` marks labels with a new distance or number of hops; a new
        predecessor alone changes nothing for the nodes behind.
        """
        if packing:
            best = (cand.groupBy(*KEY).agg(F.expr(f"min({packing.pack}) AS k"), F.expr("max(asof) AS asof"))
                    .selectExpr(*KEY, f"{packing.unpack} AS l", "asof"))
        else:
            best = cand.groupBy(*KEY).agg(F.expr("min(l) AS l"), F.expr("max(asof) AS asof"))
        if not self.runs:
            return best.selectExpr(*KEY, "l", "asof", "true AS moved")
        for name in self.runs:
            best = best.join(self._olds[name], KEY, "left")
        olds = ", ".join(f"old_{name}" for name in self.runs)
        best = best.selectExpr(*KEY, "l", "asof", f"{f'least({olds})' if len(self.runs) > 1 else olds} AS old")
        return best.where("old IS NULL OR l < old").selectExpr(
            *KEY, "l", "asof", "old IS NULL OR l.dist < old.dist OR l.hops < old.hops AS moved")

    def add(self, cand: DataFrame, packing: Packing | None = None) -> tuple[DataFrame, dict]:
        """Write the better ones of the candidates as a run: the run and how many there are."""
        name, m = self.tables.write(self.better(cand, packing), *KEY, n=F.count(F.lit(1)), moved=F.count_if("moved"))
        return self._opened(name), m

    def _opened(self, name: str) -> DataFrame:
        self.runs.append(name)
        run = self.spark.table(name)
        self._olds[name] = run.select(*KEY, F.col("l").alias(f"old_{name}"))
        return run

    def merge(self) -> tuple[DataFrame, dict]:
        """All runs as one: its rows, how many, and the largest distance."""
        # read as plain files: Spark 4.1 takes a union of bucketed tables for bucketed
        # itself, though its partitions only follow each other
        schema = self.spark.table(self.runs[0]).schema
        rows = self.spark.read.schema(schema).parquet(*[self.tables.path(r) for r in self.runs])
        rows = rows.groupBy(*KEY).agg(F.min("l").alias("l"), F.max("asof").alias("asof")).withColumn("moved", F.lit(True))
        name, m = self.tables.write(rows, *KEY, n=F.count(F.lit(1)), far=F.max("l.dist"))
        for run in self.runs:
            self.tables.drop(run)
        self.runs = []
        return self._opened(name), m

    def close(self) -> DataFrame:
        """The files of the one run that is left; the catalog forgets it."""
        schema, path = self.spark.table(self.runs[0]).schema, self.tables.path(self.runs[0])
        self.tables.drop(self.runs[0], files=False)
        return self.spark.read.schema(schema).parquet(path)

    def drop(self) -> None:
        for run in self.runs:
            self.tables.drop(run)


def _open_sources(labels: DataFrame, blocks: EdgeBlocks, targets: DataFrame | None) -> DataFrame:
    """Sources that still have a target without label, or without targets a node with in-edges."""
    if targets is not None:
        return targets.join(labels.select(*KEY), KEY, "left_anti").select("source").distinct()
    # a source has labels for itself and all nodes with in-edges at most
    heads = blocks.heads()
    found = labels.groupBy("source").agg(F.count(F.lit(1)).alias("found"))
    room = labels.where("l.pred IS NULL").join(heads.withColumn("head", F.lit(1)), "node", "left").select(
        "source", F.coalesce("head", F.lit(0)).alias("head"))
    n_heads = heads.agg(F.count(F.lit(1))).scalar()
    return found.join(room, "source").where(F.col("found") < n_heads + 1 - F.col("head")).select("source")


def _observed(seen: Observation, name: str) -> int:
    try:
        return seen.get[name]
    except Py4JJavaError:  # a join that turns out empty at run time drops what it would observe
        return 0


def settle(labels: LabelRuns, frontier: DataFrame, blocks: EdgeBlocks, before: int, limit: int, plain: RoundTables,
           stats: list | None = None, most: int | None = None) -> int:
    """Relax from ``frontier`` until no label in the window changes; the number of rounds."""
    rounds = 0
    while True:
        rounds += 1
        if most is not None and rounds > most:
            raise RuntimeError("shortest_paths did not settle in max_rounds rounds")
        cand = relaxed(frontier, blocks, before, limit)
        if stats is not None:
            seen = Observation(f"relaxed-{uuid.uuid4().hex}")
            cand = cand.observe(seen, F.count(F.lit(1)).alias("n"))
        run, m = labels.add(cand, blocks.packing(limit))
        if stats is not None:
            stats.append({"limit": limit / SCALE, "relaxed": _observed(seen, "n"), "changed": m["n"]})
        trace(f"sssp: round {rounds} up to {limit / SCALE}: {m['n']} labels changed")
        if not m["moved"]:
            return rounds
        frontier = run.where("moved")
        if len(labels.runs) > RUNS:
            frontier, _ = plain.write(frontier)  # its run is merged away
            labels.merge()


def shortest_paths(edges: DataFrame, sources: DataFrame, source_col: str = "source", block: int = BLOCK,
                   targets: DataFrame | None = None, max_rounds: int | None = None, width: float | None = None,
                   stats: list | None = None) -> DataFrame:
    """Labels ``(source, node, dist, hops, pred)`` for every node reachable from each source.

    ``edges``: ``(src, dst, weight)`` with weight >= 0; ``sources``: a column
    ``source_col`` of node ids (duplicates are fine).  A source is reached
    by itself with dist 0, hops 0 and a null pred; unreachable nodes have
    no row.  ``targets`` ``(source, node)`` limits the answer to labels on the
    way to these nodes (other rows may be missing or not final).

    Many views of one changing graph: edges may carry ``since`` and ``until``,
    and sources ``start`` (the node) and ``asof``; a source then names a query,
    and walks from ``start`` over the edges with since <= asof < until.

    ``width`` is the first limit, by default taken from the weights (any gives
    the same labels).  ``stats`` gets a dict per round: limit, candidates
    relaxed, labels changed.

    The loop runs eagerly; the returned DataFrame reads the last table's files.
    """
    spark = edges.sparkSession
    start = F.col("start") if "start" in sources.columns else F.col(source_col)
    asof = F.col("asof") if "asof" in sources.columns else F.lit(0)
    plain = RoundTables(spark, "routelytics-sssp")
    seeds = sources.select(F.col(source_col).cast("long").alias("source"), start.cast("long").alias("node"),
                           asof.cast("long").alias("asof")).distinct()
    blocks = EdgeBlocks(edges, block)
    labels = LabelRuns(spark)
    try:
        if targets is not None:
            targets, _ = plain.write(targets.select(F.col("source").cast("long"), F.col("node").cast("long")).distinct())
        zero = _label(F.lit(0), F.lit(0), F.lit(None))
        frontier, _ = labels.add(seeds.select("source", "node", zero.alias("l"), "asof"))
        limit = max(1, round(width * SCALE)) if width is not None else blocks.width
        before, rounds = -1, 0
        while True:
            rounds += settle(labels, frontier, blocks, before, limit, plain, stats,
                             None if max_rounds is None else max_rounds - rounds)
            merged, m = labels.merge()
            if limit >= (m["far"] or 0) + blocks.heaviest:
                break
            active, left = plain.write(_open_sources(merged, blocks, targets), n=F.count(F.lit(1)))
            if not left["n"]:
                break
            frontier = merged.join(active, "source", "left_semi")
            before, limit = limit, limit * GROWTH
        state = labels.close()
    except BaseException:
        labels.drop()
        raise
    finally:
        blocks.drop()
        plain.clear()
    return state.select("source", "node", (F.col("l.dist") / F.lit(float(SCALE))).alias("dist"),
                        F.col("l.hops").alias("hops"), F.col("l.pred").alias("pred"))


def distance_to(state: DataFrame, node: int) -> DataFrame:
    """``(source, dist)`` of one node in a label table (F2); no row if unreachable."""
    return state.where(F.col("node") == F.lit(node)).select("source", "dist")
