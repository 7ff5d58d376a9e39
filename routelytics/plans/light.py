"""Paths of many single pairs, searched within tasks over the lightest edges of every node.

A shortest path takes few edges of a node, and light ones.  So the lightest edges of the graph and of
each node, out and in, are written once, and every Python worker reads
them into arrays of bounded size (``HELD`` edges).  Pairs are dealt evenly over the tasks in order
of their starts; a task searches some starts at a time, each with all its pairs.  No label is
written or shuffled: a task returns the paths alone.

A label is one whole number, the *key* ``dist << bits | hops``: an edge adds ``weight << bits | 1``.
A :class:`Reach` holds the labels around each of its roots.  They are exact up to a limit, and the
limit grows until enough of them are.  Edges that were left out bound it: no label is
taken for exact beyond the least key at which such an edge could end.

A pair with the start's limit ``la`` and the destination's ``lb`` is answered if its best path
is not longer than ``la + lb`` and no left-out edge of the destination's side ends below that, or if one of
the sides holds the other end or all there is.  Of a shortest path the first node within ``lb``
has one edge into it, from a node within ``la``: the least of all such compositions, read
from the destination, is the least path (Decision D5d).
Whatever stays open is for the caller.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from routelytics.session import RoundTables, trace

#: Edges that are kept for an average node at most, those kept for every node at least, and for any one at most.
MOST_EDGES, LEAST_EDGES, MOST_RANK = 96, 64, 2000
#: Edges that a worker holds at most in each direction (8 bytes each; with times, half of them at 16 bytes).
#: A graph whose nodes would get fewer than a block is not searched within tasks.
HELD = 12_000_000
#: Labels that a task aims at for its starts of one time, and beyond which it takes fewer starts.
LABELS, MOST_LABELS = 300_000, 3_000_000
#: Pairs of a task.
PAIRS = 8192
#: The product of the two sides' first sizes is so many times the number of nodes ...
MEET = 1.0
#: ... and a label of the destination's side costs so many of the other one's, as its edges are looked up.
DEAR = 3
#: Edges of a block.
WIDE = 8
#: Key of what is not there, and the largest one that is followed.
NEVER, FAR = 1 << 62, 1 << 61


def first_of(*sorted_keys: np.ndarray) -> np.ndarray:
    """Marks the first row of every run of equal keys."""
    out = np.ones(len(sorted_keys[0]), bool)
    if len(out):
        out[1:] = False
        for k in sorted_keys:
            out[1:] |= k[1:] != k[:-1]
    return out


def spread(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of the given sizes: the run of each element, and its place in the run."""
    run = np.repeat(np.arange(len(sizes)), sizes)
    return run, np.arange(len(run)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


class Ways:
    """Edges of one direction in blocks of ``WIDE``, lightest first: those of node i are blocks first[i] to first[i + 1] - 1."""

    def __init__(self, n: int, bits: int, node, other, w, when=()):
        gone = (other < 0) | (w >= FAR >> bits)
        self.n, self.bits = n, bits
        self.cut = np.full(n, NEVER)  # key that left-out edges of a node add at least
        np.minimum.at(self.cut, node[gone], np.minimum(w[gone], FAR >> bits) << bits)
        self.cuts = bool(gone.any())
        node, other, w, when = node[~gone], other[~gone], w[~gone], [t[~gone] for t in when]
        order = np.lexsort((w, node))
        node, w = node[order], w[order]
        degree = np.bincount(node, minlength=n)
        self.first = np.concatenate([[0], np.cumsum(-(-degree // WIDE))])
        slot = self.first[node] * WIDE + np.arange(len(node)) - (np.cumsum(degree) - degree)[node]
        size = (int(self.first[-1]) + 1) * WIDE  # the last block is empty

        def blocks(values, fill, kind):
            out = np.full(size, fill, kind)
            out[slot] = values
            return out.reshape(-1, WIDE)

        self.to = blocks(other[order], -1, np.int32)
        self.w = blocks(w, 0, np.uint32 if not len(w) or w.max() < 1 << 32 else np.int64)
        self.when = [blocks(t[order], 0, np.int32) for t in when]

    def ahead(self, node: np.ndarray, block: np.ndarray, key: np.ndarray) -> np.ndarray:
        """The key at which a label's lightest edge of ``block`` and those behind it ends."""
        return np.where(block < self.first[node + 1], key + (self.w[block, 0].astype(np.int64) << self.bits) + 1, NEVER)


class Graph:
    """The light edges of both directions, as a worker holds them."""

    #: the last graph of this Python worker, which Spark uses for many tasks
    last: tuple | None = None

    def __init__(self, path: str, timed: bool):
        store, root = fs.FileSystem.from_uri(path)
        cols = ["node", "other", "w"] + ["since", "until"] * timed
        have = [store.get_file_info(f"{root}/way={i}").type == fs.FileType.Directory for i in (0, 1)]

        def read(i, col):
            """One column at a time, so that a worker does not hold the table beside the arrays made of it."""
            if not have[i]:
                return np.zeros(0, np.int64)
            types = pa.schema([(col, pa.int64())])
            return ds.dataset(f"{root}/way={i}", types, filesystem=store, format="parquet").to_table(use_threads=False).column(col).to_numpy()

        def values(some):
            return np.unique(np.concatenate([np.unique(read(i, c)) for i in (0, 1) for c in some]))

        self.ids = values(cols[:1])
        self.moments = values(cols[3:]) if timed else None
        self.n, self.bits = len(self.ids), max(len(self.ids), 1).bit_length()

        def way(i):
            other = read(i, "other")
            to = np.searchsorted(self.ids, other).astype(np.int32)
            to[other == _NONE] = -1
            node = np.searchsorted(self.ids, read(i, "node")).astype(np.int32)
            when = [np.searchsorted(self.moments, read(i, c)).astype(np.int32) for c in cols[3:]]
            return Ways(self.n, self.bits, node, to, read(i, "w"), when)

        self.out, self.into = way(0), way(1)
        pa.default_memory_pool().release_unused()

    @classmethod
    def of(cls, path: str, timed: bool) -> "Graph":
        if Graph.last is None or Graph.last[0] != path:
            Graph.last = None  # frees it before the next one is built
            Graph.last = path, cls(path, timed)
        return Graph.last[1]

    def index(self, ids: np.ndarray) -> np.ndarray:
        """Numbers of nodes; -1 for those without edges."""
        at = np.searchsorted(self.ids, ids)
        at[at == self.n] = 0
        return np.where(self.ids[at] == ids, at, -1) if self.n else np.full(len(ids), -1)

    def moment(self, asof: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.moments, asof, side="right") - 1 if self.moments is not None else asof


#: ``other`` of the row that stands for a node's left-out edges, with the least of their weights.
_NONE = -(1 << 63)


class Reach:
    """Labels around each root, sorted by ``flat`` = (number of the root, node)."""

    def __init__(self, ways: Ways, roots: np.ndarray, moments: np.ndarray):
        n = len(roots)
        self.ways, self.roots, self.moments = ways, roots, moments
        self.bits, self.low = ways.bits, (1 << ways.bits) - 1
        self.flat = (np.arange(n) << self.bits) | roots
        self.key = np.zeros(n, np.int64)
        self.near = np.full(n, -1)  # the node before this one, the least of equal ones
        self.block = ways.first[roots]  # edges before it are relaxed
        self.next = ways.ahead(roots, self.block, self.key)  # key of the next candidate
        self.limit, self.step = np.zeros(n, np.int64), np.ones(n, np.int64)
        self.exact, self.whole, self.stuck = np.full(n, FAR), np.zeros(n, bool), np.zeros(n, bool)
        self.held = np.ones(n, np.int64)

    def bounds(self) -> np.ndarray:
        return np.searchsorted(self.flat, np.arange(len(self.roots) + 1) << self.bits)

    def at(self, root: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of labels, and whether they are there."""
        flat = (root << self.bits) | node
        at = np.minimum(np.searchsorted(self.flat, flat), len(self.flat) - 1)
        return at, self.flat[at] == flat

    def relax(self, at: np.ndarray) -> None:
        """Follow the next block of edges of the labels ``at``, as far as the limit of their root."""
        ways, key, block = self.ways, self.key[at], self.block[at]
        root, node = self.flat[at] >> self.bits, self.flat[at] & self.low
        to = ways.to[block]
        new = key[:, None] + (ways.w[block].astype(np.int64) << self.bits) + 1
        new[to < 0] = NEVER
        fits = new <= self.limit[root][:, None]
        done = fits.all(1)
        self.block[at] = np.where(done, block + 1, block)
        self.next[at] = np.where(done, ways.ahead(node, block + done, key), np.where(fits, NEVER, new).min(1))
        if ways.when:
            now = self.moments[root][:, None]
            fits &= (ways.when[0][block] <= now) & (now < ways.when[1][block])
        i, j = np.nonzero(fits)
        flat, new, by = (root[i] << self.bits) | to[i, j], new[i, j], node[i]
        old = np.minimum(np.searchsorted(self.flat, flat), len(self.flat) - 1)
        known = self.flat[old] == flat
        good = ~known | (new < self.key[old]) | ((new == self.key[old]) & (by < self.near[old]))
        flat, new, by = flat[good], new[good], by[good]
        order = np.lexsort((by, new, flat))
        order = order[first_of(flat[order])]
        flat, new, by = flat[order], new[order], by[order]
        old, known = np.searchsorted(self.flat, flat), known[good][order]
        p = old[known]
        less = new[known] < self.key[p]
        self.near[p] = by[known]
        p, key = p[less], new[known][less]
        node = self.flat[p] & self.low
        self.key[p], self.block[p], self.next[p] = key, ways.first[node], ways.ahead(node, ways.first[node], key)
        fresh = ~known
        if fresh.any():
            node, key = flat[fresh] & self.low, new[fresh]
            place = old[fresh] + np.arange(len(node))
            kept = np.ones(len(self.flat) + len(node), bool)
            kept[place] = False
            for name, values in (("flat", flat[fresh]), ("key", key), ("near", by[fresh]), ("block", ways.first[node]),
                                 ("next", ways.ahead(node, ways.first[node], key))):
                out = np.empty(len(kept), np.int64)
                out[kept], out[place] = getattr(self, name), values
                setattr(self, name, out)

    def grow(self, want: np.ndarray) -> None:
        """Until every root holds ``want`` exact labels, or no more can be had."""
        while True:
            while True:
                root, starts = self.flat >> self.bits, self.bounds()[:-1]
                inside = self.key <= self.limit[root]
                over = np.add.reduceat(inside.astype(np.int64), starts) > 2 * self.held + 8
                if over.any():  # more labels lay behind the known ones than thought: a smaller limit
                    at = np.flatnonzero(inside & over[root])
                    at = at[np.lexsort((self.key[at], root[at]))]
                    of = np.flatnonzero(first_of(root[at]))
                    self.limit[over] = self.key[at[of + (self.held + self.held // 2 + 4)[over]]]
                    inside = self.key <= self.limit[root]
                open_ = np.flatnonzero(inside & (self.next <= self.limit[root]))
                if not len(open_):
                    break
                self.relax(open_)
            ahead = np.where(inside, self.next, self.key)
            event = np.minimum.reduceat(ahead, starts)
            exact = np.full(len(starts), NEVER)
            if self.ways.cuts:
                exact = np.minimum.reduceat(np.where(inside, self.key + self.ways.cut[self.flat & self.low], NEVER), starts)
            self.whole = (event >= NEVER) & (exact >= NEVER)
            self.exact = np.minimum(exact, FAR)
            self.limit = np.minimum(self.limit, self.exact)
            self.held = np.add.reduceat((self.key <= self.limit[root]).astype(np.int64), starts)
            self.stuck = (event >= NEVER) | (self.limit >= self.exact)
            small = (self.held < want) & ~self.stuck
            if not small.any():
                return
            # the next limit lets in half as many labels again, of those known: there are more behind them
            to = np.where(small, np.maximum(np.minimum(self.limit + 2 * self.step, FAR), event), -1)
            at = np.flatnonzero(ahead <= to[root])
            at = at[np.lexsort((ahead[at], root[at]))]
            counts = np.bincount(root[at], minlength=len(starts))
            more = np.minimum(np.maximum(np.minimum(self.held // 2, want - self.held), 1), counts)
            limit = np.minimum(ahead[at[(np.cumsum(counts) - counts + more - 1)[small]]], self.exact[small])
            self.step[small] = np.maximum(limit - self.limit[small], 1)
            self.limit[small] = limit

    def edges(self, at: np.ndarray, above: np.ndarray, top: np.ndarray):
        """Edges of the labels ``at`` that end above one key and up to another of their root: ``(label, node, key)``."""
        root, node = self.flat[at] >> self.bits, self.flat[at] & self.low
        block, ends, out = self.ways.first[node], self.ways.first[node + 1], []
        while len(at):
            some = (block < ends) & (self.ways.ahead(node, block, self.key[at]) <= top[root])
            at, root, node, block, ends = at[some], root[some], node[some], block[some], ends[some]
            to = self.ways.to[block]
            new = self.key[at][:, None] + (self.ways.w[block].astype(np.int64) << self.bits) + 1
            ok = (to >= 0) & (new <= top[root][:, None]) & (new > above[root][:, None])
            if self.ways.when:
                now = self.moments[root][:, None]
                ok &= (self.ways.when[0][block] <= now) & (now < self.ways.when[1][block])
            i, j = np.nonzero(ok)
            out.append((at[i], to[i, j].astype(np.int64), new[i, j]))
            block = block + 1
        return [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3

    def exactly(self, roots: np.ndarray) -> np.ndarray:
        """Places of the exact labels of some roots."""
        mine = np.zeros(len(self.roots), bool)
        mine[roots] = True
        root = self.flat >> self.bits
        return np.flatnonzero(mine[root] & (self.key <= self.limit[root]))

    def parents(self, roots: np.ndarray) -> np.ndarray:
        """For the exact labels of some roots: the place of the one before them on the least path from the root."""
        parent, node, key = self.edges(self.exactly(roots), np.full(len(self.roots), -1), self.limit)
        root = self.flat >> self.bits
        child, there = self.at(root[parent], node)
        tight = there & (self.key[child] == key)
        child, parent = child[tight], parent[tight]
        # paths of equal key have as many hops: those of a level are ranked by the rank of their parent, then by node
        out, rank, hops = np.full(len(self.flat), -1), np.zeros(len(self.flat), np.int64), self.key[child] & self.low
        order = np.argsort(hops, kind="stable")
        child, parent, hops = child[order], parent[order], hops[order]
        edges = np.flatnonzero(first_of(hops))
        for lo, hi in zip(edges, [*edges[1:], len(hops)]):
            c, p = child[lo:hi], parent[lo:hi]
            order = np.lexsort((rank[p], c))
            c, p = c[order], p[order]
            once = first_of(c)
            c, p = c[once], p[once]
            out[c] = p
            order = np.lexsort((self.flat[c] & self.low, rank[p], root[c]))
            rank[c[order]] = np.arange(len(order))
        return out


def meetings(fore: Reach, back: Reach, a: np.ndarray, b: np.ndarray):
    """Pairs (a, b) of roots: the key of the best path found of each, which ones are answered, and their least paths.

    Paths are given as ``(pair, nodes)``, runs of key & low + 1 nodes from the destination back to the start.
    """
    low, n = back.low, len(a)
    la, lb = np.where(fore.whole[a], FAR, fore.limit[a]), np.where(back.whole[b], FAR, back.limit[b])
    # an end that lies on the other side
    goal, there = fore.at(a, back.roots[b])
    key_a = np.where(there & (fore.key[goal] <= la), fore.key[goal], NEVER)
    home, there = back.at(b, fore.roots[a])
    key_b = np.where(there & (back.key[home] <= lb), back.key[home], NEVER)
    best = np.minimum(key_a, key_b)
    # or an edge from the start's side to the destination's one, from a node beyond the limit of the latter
    far = np.full(len(back.roots), -1)
    ask = best >= NEVER
    np.maximum.at(far, b[ask], fore.limit[a][ask])
    label, node, key = back.edges(back.exactly(b[ask]), back.limit, np.where(far < 0, -1, back.limit + far))
    order = np.argsort(back.flat[label] >> back.bits, kind="stable")
    label, node, key = label[order], node[order], key[order]
    ends = np.searchsorted(back.flat[label] >> back.bits, np.arange(len(back.roots) + 1))
    pair, place = spread(np.where(ask, ends[b + 1] - ends[b], 0))
    edge = ends[b][pair] + place
    to, there = fore.at(a[pair], node[edge])
    some = there & (fore.key[to] <= la[pair])
    pair, edge, to = pair[some], edge[some], to[some]
    total = fore.key[to] + key[edge]
    np.minimum.at(best, pair, total)
    found = np.where(ask, best <= np.minimum(fore.limit[a] + back.limit[b], back.exact[b]), True)
    sure = found | fore.whole[a] | back.whole[b]
    # a row a path: the last label on the destination's side, the first one on the start's side, and whether that is a node of its own
    pick = found[pair] & (total == best[pair])
    in_a, in_b = np.flatnonzero(key_a < NEVER), np.flatnonzero((key_b < NEVER) & (key_a >= NEVER))
    pair = np.concatenate([in_a, in_b, pair[pick]])
    at = np.concatenate([back.at(b[in_a], back.roots[b[in_a]])[0], home[in_b], label[edge[pick]]])
    to = np.concatenate([goal[in_a], fore.at(a[in_b], fore.roots[a[in_b]])[0], to[pick]])
    own = np.arange(len(pair)) >= len(in_a) + len(in_b)
    size = (best[pair] & low) + 1
    starts = np.cumsum(size) - size
    nodes = np.full(int(size.sum()), -1)
    i, up = starts + (back.key[at] & low), back.parents(b[pair])
    rows, at, j = np.arange(len(pair)), at.copy(), i.copy()
    while len(rows):  # on to the destination
        nodes[j[rows]] = back.flat[at[rows]] & low
        rows = rows[j[rows] > starts[rows]]
        at[rows] = up[at[rows]]
        j[rows] -= 1
    rows, j = np.arange(len(pair)), i + own
    nodes[j[own]] = fore.flat[to[own]] & low
    while len(rows):  # back to the start
        rows = rows[fore.key[to[rows]] > 0]
        j[rows] += 1
        nodes[j[rows]] = fore.near[to[rows]]
        to[rows], _ = fore.at(a[pair[rows]], fore.near[to[rows]])
    order = np.argsort(pair, kind="stable")
    pair, starts, size = pair[order], starts[order], size[order]
    take = first_of(pair)
    for p in np.unique(pair[~take]):  # several least keys: the least path counts
        same = np.flatnonzero(pair == p)
        take[same] = False
        take[min(same, key=lambda r: nodes[starts[r]:starts[r] + size[r]].tolist())] = True
    pair, starts, size = pair[take], starts[take], size[take]
    if len(pair) != found.sum() or (nodes < 0).any():
        raise AssertionError("an answered pair has one path")
    run, place = spread(size)
    return best, sure, pair, nodes[starts[run] + place]


def search(graph: Graph, start: np.ndarray, moment: np.ndarray, end: np.ndarray, want: int | None = None):
    """Answers of pairs of node numbers: ``(sure, key, path sizes, path nodes, labels held)``; a size 0 where there is no path."""
    n, low = len(start), (1 << graph.bits) - 1
    sure, key, paths, labels = np.zeros(n, bool), np.full(n, NEVER), [None] * n, 0
    jobs = [np.arange(n)]
    while jobs:
        rows = jobs.pop()
        roots, a = np.unique(np.stack([start[rows], moment[rows]]), axis=1, return_inverse=True)
        goals, b = np.unique(np.stack([end[rows], moment[rows]]), axis=1, return_inverse=True)
        a, b = a.ravel(), b.ravel()
        fore, back = Reach(graph.out, *roots), Reach(graph.into, *goals)
        most_b = want or math.ceil(math.sqrt(MEET * graph.n * roots.shape[1] / len(rows) / DEAR))
        want_a = np.full(len(fore.roots), want or max(1, math.ceil(MEET * graph.n / most_b)))
        want_b = np.full(len(back.roots), most_b)
        while len(rows):
            here, there = np.zeros(len(want_a), np.int64), np.zeros(len(want_b), np.int64)
            here[a], there[b] = want_a[a], want_b[b]
            fore.grow(here)
            back.grow(there)
            best, ok, pair, nodes = meetings(fore, back, a, b)
            sure[rows[ok]], key[rows[ok]] = True, best[ok]
            for r, path in zip(rows[pair].tolist(), np.split(nodes, np.cumsum((best[pair] & low) + 1)[:-1]) if len(pair) else []):
                paths[r] = path
            # what is longer than left-out edges allow stays open, however far the sides grow
            left = ~ok & (fore.limit[a] + back.limit[b] < back.exact[b]) & ~(fore.stuck[a] & back.stuck[b])
            rows, a, b = rows[left], a[left], b[left]
            if len(rows) > 1 and len(fore.flat) + len(back.flat) > MOST_LABELS:
                jobs += [rows[:len(rows) // 2], rows[len(rows) // 2:]]
                break
            # the side that costs less grows
            cheap = np.bincount(a, back.held[b], len(want_a)) * DEAR < fore.held
            other = fore.stuck[a] | (cheap[a] & ~back.stuck[b])
            want_b[b[other]] = 2 * back.held[b[other]]
            want_a[a[~other]] = 2 * fore.held[a[~other]]
        labels += len(fore.flat) + len(back.flat)
    return sure, key, paths, labels


def _kept(e: DataFrame, plain: RoundTables, m: dict, held: int) -> DataFrame:
    """``(way, node, other, w)``, way 1 with the ends exchanged: all edges, or the lightest ones of every node
    and then one row without ``other`` for the next one."""
    when = [c for c in ("since", "until") if c in e.columns]
    ends = F.array(F.struct(F.lit(0).alias("way"), F.col("src").alias("node"), F.col("dst").alias("other")),
                   F.struct(F.lit(1).alias("way"), F.col("dst").alias("node"), F.col("src").alias("other")))
    both = e.select(F.explode(ends).alias("end"), "w", *when).select("end.*", "w", *when)
    nodes, most = max(m["heads"], m["tails"], 1), held >> bool(when)
    k = min(LEAST_EDGES, most // (4 * nodes))
    if m["n"] <= most:
        return both
    # edges up to a bound, more where a node's lightest is heavy, the k lightest ones and MOST_RANK of a node at most
    bound = max((q for i, q in enumerate(m["shares"]) if m["n"] * 2.0 ** -i <= min(MOST_EDGES * nodes, most // 2)), default=-1)
    counts, got = plain.write(both.groupBy("way", "node").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("w") <= bound).alias("light"), F.min("w").alias("least"))
                              .where("n > light").select("way", "node", ((F.col("light") <= k) | (F.col("least") > bound // 2)).alias("few")),
                              few=F.count_if("few"))
    rows = both.where(F.col("w") <= bound)
    if got["few"]:
        rows = rows.unionByName(both.where(F.col("w") > bound).join(counts.where("few").select("way", "node"), ["way", "node"], "left_semi"))
    trace(f"light: up to {bound}, and all of {got['few']} nodes")
    by = Window.partitionBy("way", "node").orderBy("w", "other")
    least = F.first("w").over(by)
    top = F.when(least > bound // 2, least + bound).otherwise(F.lit(bound))
    rows = rows.withColumn("rank", F.row_number().over(by)).withColumn("top", top)
    rows = rows.withColumn("kept", ((F.col("rank") <= k) | (F.col("w") <= F.col("top"))) & (F.col("rank") <= MOST_RANK))
    rows = rows.withColumn("last", F.lag("kept").over(by)).where("kept OR last")
    rows = rows.select("way", "node", F.when(F.col("kept"), F.col("other")).otherwise(F.lit(_NONE)).alias("other"), "w", *when)
    rest = counts.where("NOT few").select("way", "node", F.lit(_NONE).alias("other"), F.lit(bound + 1).cast("long").alias("w"),
                                          *[F.lit(0).cast("long").alias(c) for c in when])
    return rows.unionByName(rest)


def light_paths(e: DataFrame, m: dict, pairs: DataFrame, plain: RoundTables, want: int | None = None, held: int = HELD,
                stats: list | None = None) -> tuple[DataFrame | None, DataFrame, int]:
    """Answers ``(start, destination, asof, dist, hops, path)``, the pairs still open, and how many these are.

    Without answers, and -1, where the nodes are too many for a task.

    ``e``: ``(src, dst, w)`` and maybe ``since`` and ``until``, w a whole number; ``m`` what is known
    of it (:func:`known`).  ``path`` runs from the destination to the start.
    """
    timed = "since" in e.columns
    if max(m["heads"], m["tails"], 1) * WIDE > held >> timed:
        return None, pairs, -1
    kept, _ = plain.write(_kept(e, plain, m, held), by=["way"])
    path = plain.path(kept)
    cores = e.sparkSession.sparkContext.defaultParallelism
    dealt, got = plain.write(pairs.select("start", "destination", "asof"), n=F.count(F.lit(1)))
    dealt = dealt.repartitionByRange(max(2 * cores, got["n"] // PAIRS), "start", "asof", "destination").sortWithinPartitions(
        "start", "asof", "destination")

    def run(batches):
        for batch in batches:
            graph = Graph.of(path, timed)
            ends, asof = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            groups = max(1, int(first_of(ends, asof).sum()))
            # of a start's side and those of its pairs, as many as fit
            each = math.sqrt(MEET * max(graph.n, 1) / DEAR * groups / max(batch.num_rows, 1)) * (1 + DEAR)
            step = max(1, int(LABELS / max(each, 1)))
            for lo in range(0, batch.num_rows, step):
                yield _answered(graph, batch.slice(lo, step), want)

    out = dealt.mapInArrow(run, "start long, destination long, asof long, sure boolean, dist long, hops long, path array<long>, labels long")
    out, got = plain.write(out, labels=F.coalesce(F.sum("labels"), F.lit(0)), left=F.count_if(~F.col("sure")), n=F.count(F.lit(1)))
    if stats is not None:
        stats.append({"rounds": 1, "labels": got["labels"]})
    trace(f"light: {got['n']} pairs, {got['labels']} labels, {got['left']} open")
    return (out.where("sure AND dist IS NOT NULL").select("start", "destination", "asof", "dist", "hops", "path"),
            out.where("NOT sure").select("start", "destination", "asof"), got["left"])


def _answered(graph: Graph, rows: pa.RecordBatch, want: int | None) -> pa.RecordBatch:
    start, end, asof = (rows.column(i).to_numpy() for i in range(3))
    a, b = graph.index(start), graph.index(end)
    n, same = len(start), start == end
    sure, dist, hops = np.ones(n, bool), np.where(same, 0, -1), np.zeros(n, np.int64)
    paths, labels = [[s] if x else None for s, x in zip(start.tolist(), same.tolist())], np.zeros(n, np.int64)
    asked = np.flatnonzero((a >= 0) & (b >= 0) & ~same)  # a node without edges is reached by itself alone
    if len(asked):
        ok, key, got, held = search(graph, a[asked], graph.moment(asof[asked]), b[asked], want)
        sure[asked], there = ok, ok & (key < NEVER)
        dist[asked[there]], hops[asked[there]] = key[there] >> graph.bits, key[there] & ((1 << graph.bits) - 1)
        for r, nodes in zip(asked.tolist(), got):
            paths[r] = None if nodes is None else graph.ids[nodes].tolist()
        labels[0] = held
    none = dist < 0
    return pa.RecordBatch.from_arrays(
        [rows.column(0), rows.column(1), rows.column(2), pa.array(sure), pa.array(dist, mask=none), pa.array(hops, mask=none),
         pa.array(paths, pa.list_(pa.int64())), pa.array(labels)],
        names=["start", "destination", "asof", "sure", "dist", "hops", "path", "labels"])
