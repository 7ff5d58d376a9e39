"""Pairs searched within tasks over light edges: brute force, left-out edges, what is left to the rounds."""

import heapq
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from routelytics.plans import light
from routelytics.plans.paths import route_queries


def brute(edges, start, end, asof):
    """Least (dist, hops, path from the destination back)."""
    heap, done = [(0, 0, (start,))], set()
    while heap:
        dist, hops, path = heapq.heappop(heap)
        if path[0] == end:
            return dist, hops, list(path)
        if path[0] not in done:
            done.add(path[0])
            for a, b, w, since, until in edges:
                if a == path[0] and since <= asof < until:
                    heapq.heappush(heap, (dist + w, hops + 1, (b, *path)))
    return None, None, None


def graph_of(edges, keep):
    """The ``keep`` lightest edges of every node, and its next one as left out."""
    g = light.Graph.__new__(light.Graph)
    rows = np.array(edges, np.int64)
    g.ids, g.moments = np.unique(rows[:, :2]), np.unique(rows[:, 3:])
    g.n, g.bits = len(g.ids), len(g.ids).bit_length()

    def way(a, b):
        out = []
        for v in g.ids.tolist():
            mine = sorted((e[2], e[b], e[3], e[4]) for e in edges if e[a] == v)
            out += [(v, x, w, s, u) for w, x, s, u in mine[:keep]] + [(v, None, w, s, u) for w, x, s, u in mine[keep:keep + 1]]
        find = lambda i, ids: np.searchsorted(ids, np.array([r[i] for r in out]))
        other = np.array([-1 if r[1] is None else np.searchsorted(g.ids, r[1]) for r in out])
        return light.Ways(g.n, g.bits, find(0, g.ids), other, np.array([r[2] for r in out]), [find(3, g.moments), find(4, g.moments)])

    g.out, g.into = way(0, 1), way(1, 0)
    return g


@pytest.mark.parametrize("keep", [2, 9, 1000])
@pytest.mark.parametrize("weights", [[0, 1, 1, 2, 9], [0], range(1, 2400)])
def test_least_paths_with_edges_left_out(keep, weights):
    """What is answered is the least path; with all edges everything is answered."""
    r, answered = random.Random(keep), 0
    for n, out, want in [(5, 1, None), (40, 3, None), (40, 12, None), (60, 2, 1), (40, 4, 3)]:
        edges = [(7 * a + 3, 7 * r.randrange(n) + 3, r.choice(weights), *r.choice([(0, 9), (0, 5), (5, 9)])) for a in range(n) for _ in range(out)]
        asked = [(7 * r.randrange(n) + 3, 7 * r.randrange(n + 1) + 3, r.randrange(10)) for _ in range(25)]
        rows = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*asked)], names=["start", "destination", "asof"])
        for (a, b, t), got in zip(asked, light._answered(graph_of(edges, keep), rows, want).to_pylist()):
            answered += got["sure"]
            assert got["sure"] or keep < 1000
            if got["sure"]:
                assert (got["dist"], got["hops"], got["path"]) == brute(edges, a, b, t)
    assert answered == 125 or keep < 1000 and answered > 5


def test_pairs_take_one_round_and_no_labels_are_written(spark, tmp_path, monkeypatch):
    """A pair's path needs one pass over the cluster; what is written grows with pairs and light edges, not with labels."""
    r = random.Random(8)
    rows = [(a, b, float(r.randint(1, 2000))) for a in range(300) for b in r.sample(range(300), 60)]
    e = spark.createDataFrame(rows, "src long, dst long, weight double")
    q = spark.createDataFrame([(a, (7 * a + k) % 300) for a in range(0, 300, 5) for k in range(1, 5)], "source long, destination long")
    wrote, write = [], light.RoundTables.write
    monkeypatch.setattr(light.RoundTables, "write", lambda self, df, *a, **b: wrote.append(df) or write(self, df, *a, **b))
    stats: list = []
    whole = sorted(route_queries(e, q, stats=stats).collect())
    assert len(stats) == 1 and stats[0]["rounds"] == 1 and len(wrote) < 12
    monkeypatch.setattr(light, "LEAST_EDGES", 6)
    few: list = []
    # a bounded part of the edges; rounds over the cluster where it is not enough, or where none fit
    assert sorted(route_queries(e, q, stats=few, held=8000).collect()) == whole
    assert sorted(route_queries(e, q.limit(3), stats=few, held=0).collect()) == [x for x in whole if (x.source, x.destination) in
                                                                                 {(y.source, y.destination) for y in q.limit(3).collect()}]
    assert few[-1]["rounds"] > 1


def test_kept_edges_are_bounded(spark, tmp_path):
    """Heavy and light nodes keep their lightest edges, and a row for the next one."""
    rows = [(0, b, b) for b in range(1, 400)] + [(a, 0, 5000 + a) for a in range(1, 400)]
    e = spark.createDataFrame(rows, "src long, dst long, w long")
    m = {"n": len(rows), "heads": 400, "tails": 400, "shares": [5399, 399, 199, 99, 49]}
    kept = light._kept(e, light.RoundTables(spark, "t"), m, 400 * 4 * 2).where("way = 0").withColumn("cut", F.col("other") == light._NONE)
    got = {(x.node, x.cut): (x["count"], x["max(w)"]) for x in kept.groupBy("node", "cut").agg(F.count("*").alias("count"), F.max("w")).collect()}
    assert got[(0, False)][0] == 399 and all(got[(a, False)] == (1, 5000 + a) for a in range(1, 400)) and (0, True) not in got
    small = light._kept(e, light.RoundTables(spark, "t"), m | {"n": 3000}, 1600).where("way = 0 AND node = 0").collect()
    cut = [x.w for x in small if x.other == light._NONE]
    assert len(cut) == 1 and sorted(x.w for x in small if x.other != light._NONE) == list(range(1, len(small)))
    assert cut[0] >= len(small) - 1 and len(small) < 300
