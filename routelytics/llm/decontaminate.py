"""Benchmark decontamination by q-gram lemma filtering.

Texts are compared in lower case with white space collapsed.  Every benchmark
item is cut into overlapping windows; a document is contaminated if some
region of it is within the edit budget of a window (of the whole item, where
that is shorter).

For a window of n characters and a budget of e edits, a matching region
shares at least n + 1 - q - q*e character q-grams with it, and these lie on
neighbouring diagonals (position in the text minus position in the item).  So
the shared q-grams are counted in diagonal bands, two adjacent bands at a
time so that the bands overlap; regions below the bound are dropped, first
for whole items, then for single windows, and the rest is verified by a banded
alignment.

The benchmark is the stated query set.  Spark reduces it to distinct texts with
their ids and writes them in blocks of bounded size (``block_chars``) under the
checkpoint folder; the driver sees none of them.  Tasks index a block when they
need it and hold one index at a time; the documents pass all blocks in one
narrow pass: no shuffle, one row per document.

Hits are held in bounded stretches (``most_hits``): the text is cut where its
stretches overlap by the reach of a match, and where one such stretch already has
more hits, the benchmark's q-grams are cut in ranges that overlap by a
window.  Every window lies whole in one of them, so that no size changes a result.

Defined results: null or empty texts have no hits; null ids and repeated rows
are judged each by their text; null items, and items of fewer than q
characters, are never found; repeated items are reported each; a text of any
length is searched whole; extra columns are ignored by the report and kept by
the filter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructField, StructType

from routelytics.llm.blocks import map_texts
from routelytics.session import RoundTables


@dataclass(frozen=True)
class LeakParams:
    q: int = 8
    #: characters of a window and steps between windows
    window: int = 64
    step: int = 16
    #: edits per character of a window
    edit_rate: float = 0.095
    #: benchmark characters that one index holds
    block_chars: int = 4 << 20
    #: shared q-grams held at a time in a task
    most_hits: int = 2_000_000


#: Characters of text a task compares at a time; arrays take about 60 bytes for each.
STRING_CHARS = 1 << 20
#: Characters that pass all blocks of a benchmark of several, whose indexes are built anew for each such
#: stretch of texts; they take 8 bytes each.
PASS_CHARS = 16 << 20
_SEPARATOR = np.uint32(0x110000)


def _fold_table() -> np.ndarray:
    """Lower case of the basic plane; white space becomes a space."""
    t = np.arange(1 << 16, dtype=np.uint32)
    for i in range(1 << 16):
        c = chr(i)
        if c.isspace():
            t[i] = 32
        elif c.isupper():
            low = c.lower()
            t[i] = ord(low) if len(low) == 1 else i
    return t


class Normaliser:
    """Code points of a text in lower case with single spaces, and where they come from."""

    def __init__(self):
        self.table = _fold_table()

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        low = np.where(raw < 1 << 16, self.table[raw & 0xFFFF], raw)
        space = low == 32
        keep = np.ones(len(low), bool)
        keep[1:] = ~(space[1:] & space[:-1])
        at = np.flatnonzero(keep)
        return low[at], at


_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _grams(codes: np.ndarray, q: int) -> np.ndarray:
    """64-bit hash of every q-gram, built from grams of half its length."""
    if len(codes) < q:
        return np.empty(0, np.uint64)

    def build(n: int) -> np.ndarray:
        if n == 1:
            return (codes.astype(np.uint64) + np.uint64(1)) * _ODD[0]
        half = n // 2
        a = build(half)
        b = a if n == 2 * half else build(n - half)
        m = len(codes) - n + 1
        out = a[:m] * _ODD[1]
        out ^= out >> np.uint64(29)
        out += b[half:half + m]
        out *= _ODD[2]
        return out
    h = build(q)
    return h ^ (h >> np.uint64(32))


class Index:
    """q-gram index of a block of items, (ids, text) each; texts that are equal once
    they are normalised share an entry."""

    def __init__(self, items: list[tuple[list[int], str]], p: LeakParams):
        norm = Normaliser()
        self.p = p
        self.ids, codes, self.windows = [], [], []
        entry: dict[bytes, int] = {}
        for ids, text in items:
            c = norm(text or "")[0]
            if len(c) < p.q:
                continue
            if entry.setdefault(c.tobytes(), len(codes)) < len(codes):
                self.ids[entry[c.tobytes()]] += ids
                continue
            n = min(p.window, len(c))
            offs = sorted({*range(0, len(c) - n + 1, p.step), len(c) - n})
            self.ids.append(list(ids))
            codes.append(c)
            self.windows.append((n, np.array(offs)))
        self.codes = codes
        # (edits, least shared q-grams) by window length; the bound must stay positive
        self.budget = {}
        for n, _ in self.windows:
            e = min(int(n * p.edit_rate), (n - p.q) // p.q)
            self.budget[n] = (e, n + 1 - p.q - p.q * e)
        self.most_edits = max([e for e, _ in self.budget.values()], default=0)
        self.band = self.most_edits + 1
        self.longest = max(map(len, codes), default=0)
        grams = [_grams(c, p.q) for c in codes]
        flat = np.concatenate(grams) if grams else np.empty(0, np.uint64)
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams]) if grams else np.empty(0, np.int64)
        off = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.empty(0, np.int64)
        order = np.argsort(flat, kind="stable")
        self.hash, self.first, self.count = np.unique(flat[order], return_index=True, return_counts=True)
        self.item, self.off = item[order].astype(np.int64), off[order].astype(np.int64)
        # q-grams by (hash, place among all q-grams of the block): a range of places is a range of each hash
        self.places = len(flat)
        self.key = np.repeat(np.arange(len(self.hash)), self.count) * self.places + order
        self.bits = max(16, min(24, int(np.ceil(np.log2(max(1, len(self.hash)))) + 5)))
        self.maybe = np.zeros(1 << self.bits, bool)
        self.maybe[self.hash & np.uint64((1 << self.bits) - 1)] = True
        self.least = np.array([self.budget[n][1] for n, _ in self.windows], np.int64)

    def lookup(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, entry in self.hash) of the q-grams of ``codes`` that items have."""
        h = _grams(codes, self.p.q)
        if not len(h) or not len(self.hash):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.flatnonzero(self.maybe[h & np.uint64((1 << self.bits) - 1)])
        found = h[at]
        k = np.minimum(np.searchsorted(self.hash, found), len(self.hash) - 1)
        ok = self.hash[k] == found
        return at[ok], k[ok]


def align(pattern: np.ndarray, text: np.ndarray, lo: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Banded edit distance of patterns within texts.

    ``pattern`` is (c, n); a row may start in ``text`` at lo .. lo + width - 1
    and stays within those diagonals.  Returns the least edits and the end.
    """
    c, n = pattern.shape
    col = np.arange(width)
    d = np.zeros((c, width), np.int32)
    big = np.int32(1 << 20)
    for j in range(n):
        at = lo[:, None] + j + col
        ch = text[np.clip(at, 0, len(text) - 1)]
        same = (ch == pattern[:, j, None]) & (at >= 0) & (at < len(text))
        up = np.full_like(d, big)
        up[:, :-1] = d[:, 1:] + 1
        new = np.minimum(d + ~same, up)
        d = np.minimum.accumulate(new - col, axis=1) + col  # skipped text characters
    best = d.argmin(axis=1)
    return d[np.arange(c), best], lo + n + best


def _runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order and their counts."""
    key = np.sort(key)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
    return key[first], np.diff(np.append(first, len(key)))


def _within(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _overlapping(key: np.ndarray, least) -> np.ndarray:
    """Keys b, in order, for which bands b and b + 1 together hold ``least(b)`` hits."""
    k, n = _runs(key)
    nxt = np.append(k[1:] == k[:-1] + 1, False)  # the upper band is there
    total = n + np.where(nxt, np.append(n[1:], 0), 0)
    lone = np.concatenate([[True], ~nxt[:-1]])  # a band without a lower neighbour is also an upper half
    keys = np.concatenate([k, k[lone] - 1])
    total = np.concatenate([total, n[lone]])
    return np.sort(keys[total >= least(keys)])


def search(codes: np.ndarray, index: Index) -> list[tuple[int, int, int, int]]:
    """(item entry, start, end, edits) of the confirmed windows in ``codes``."""
    p, band = index.p, index.band
    at, entry = index.lookup(codes)
    if not len(at):
        return []
    load = np.cumsum(index.count[entry])
    out, lo = set(), 0
    reach = 2 * (p.window + 4 * band)
    while lo < len(at):
        base = load[lo - 1] if lo else 0
        # two reaches at least, so that the next stretch begins later and overlaps by one
        hi = max(int(np.searchsorted(load, base + p.most_hits)), int(np.searchsorted(at, at[lo] + 2 * reach, side="right")))
        ranges = [(0, index.places)]
        while ranges:
            a, z = ranges.pop()
            first, n = _places(index, entry[lo:hi], a, z)
            if n.sum() > p.most_hits and z - a > 4 * p.window:
                mid = (a + z) // 2
                ranges += [(a, mid + p.window), (mid, z)]
            else:
                out.update(_search_part(codes, index, at[lo:hi], first, n))
        if hi >= len(at):
            break
        lo = int(np.searchsorted(at, at[hi] - reach))
    return sorted(out)


def _places(index: Index, entry: np.ndarray, a: int, z: int) -> tuple[np.ndarray, np.ndarray]:
    """First of the q-grams of each entry that lie in places a .. z - 1, and how many do."""
    if a <= 0 and z >= index.places:
        return index.first[entry], index.count[entry]
    first = np.searchsorted(index.key, entry * index.places + a)
    return first, np.searchsorted(index.key, entry * index.places + min(z, index.places)) - first


def _search_part(codes, index: Index, at: np.ndarray, first: np.ndarray, n: np.ndarray):
    p, band = index.p, index.band
    total = int(n.sum())
    if not total:
        return []
    pos = np.repeat(at, n)
    k = np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(total)
    item, off = index.item[k], index.off[k]
    bin_ = (pos - off + index.longest) // band + 1
    stride = (len(codes) + index.longest) // band + 4
    key = item * stride + bin_
    keep = _overlapping(key, lambda keys: index.least[np.clip(keys // stride, 0, len(index.least) - 1)])
    if not len(keep):
        return []
    near = _within(key, keep) | _within(key, keep + 1)
    pos, off, item, bin_ = pos[near], off[near], item[near], bin_[near]
    cands: dict[int, list] = {}  # by window length: (item, window, band)
    order = np.argsort(item, kind="stable")
    pos, off, item, bin_ = pos[order], off[order], item[order], bin_[order]
    present, first = np.unique(item, return_index=True)
    for i, lo, hi in zip(present.tolist(), first, np.append(first[1:], len(item))):
        size, offs = index.windows[i]
        least = index.budget[size][1]
        o, b = off[lo:hi], bin_[lo:hi]
        for w, start in enumerate(offs):
            inside = b[(o >= start) & (o <= start + size - p.q)]
            if len(inside) >= least:
                cands.setdefault(size, []).extend((i, w, x) for x in _overlapping(inside, lambda keys: least).tolist())
    found = []
    for size, rows in cands.items():
        edits = index.budget[size][0]
        for s in range(0, len(rows), 20_000):
            part = rows[s:s + 20_000]
            i, w, b = np.array(part, np.int64).reshape(-1, 3).T
            start = np.array([index.windows[x][1][y] for x, y, _ in part], np.int64)
            pattern = np.stack([index.codes[x][o:o + size] for x, o in zip(i, start)])
            # text positions where the window may start, with room for the budget
            lo, width = (b - 1) * band - index.longest + start - edits, 2 * band + 2 * edits
            d, end = align(pattern, codes, lo, width)
            ok = d <= edits
            if ok.any():
                # the same band seen from the end gives the start
                _, rev = align(pattern[ok][:, ::-1], codes[::-1], len(codes) - end[ok] - edits, 2 * edits + 1)
                found += zip(i[ok].tolist(), (len(codes) - rev).tolist(), end[ok].tolist(), d[ok].tolist())
    return found


_HITS = StructType([StructField("hits", ArrayType(StructType([
    StructField("item_id", LongType()), StructField("start", LongType()), StructField("end", LongType()),
    StructField("edits", IntegerType())])))])


class Blocks:
    """Blocks of the benchmark in Parquet folders, indexed in a task one at a time."""

    #: the last index of this Python worker, which Spark uses for many tasks
    last: tuple | None = None

    def __init__(self, path: str, numbers: list[int], p: LeakParams):
        self.path, self.numbers, self.p = path, numbers, p

    def text_chars(self) -> int:
        return STRING_CHARS if len(self.numbers) < 2 else PASS_CHARS

    def index(self, number: int) -> Index:
        key = self.path, number
        if Blocks.last is None or Blocks.last[0] != key:
            Blocks.last = None  # frees it before the next one is built
            store, root = fs.FileSystem.from_uri(self.path)
            rows = ds.dataset(f"{root}/block={number}", filesystem=store, format="parquet").to_table(["ids", "text"])
            rows = sorted(zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()), key=lambda r: r[1])
            Blocks.last = key, Index(rows, self.p)
        return Blocks.last[1]


def _finder(blocks: Blocks):
    """Per text: one hit per item, over all its confirmed windows, in the text's own code points."""
    def make():
        norm = Normaliser()

        def f(texts):
            strings, where = [], []  # strings: (first text, start of each text, code points with separators)
            parts, starts, held = [], [], 0
            for k, t in enumerate(texts):
                c, at = norm(t)
                starts.append(held)
                parts += [c, np.array([_SEPARATOR])]
                where.append(at.astype(np.int32))
                held += len(c) + 1
                if held >= STRING_CHARS or k == len(texts) - 1:
                    strings.append((k + 1 - len(starts), np.array(starts), np.concatenate(parts)))
                    parts, starts, held = [], [], 0
            hits: list[list] = [[] for _ in texts]
            for number in blocks.numbers:
                index = blocks.index(number)
                best: dict[tuple[int, int], tuple] = {}  # by text and entry
                for first, edges, codes in strings:
                    for item, a, z, edits in search(codes, index):
                        k = int(np.searchsorted(edges, a, side="right")) - 1
                        d, start = first + k, int(edges[k])
                        src = where[d]
                        if not len(src):
                            continue
                        a, z = max(0, a - start), min(z - start, len(src))
                        lo, hi = int(src[min(a, len(src) - 1)]), int(src[max(0, z - 1)]) + 1
                        old = best.get((d, item))
                        best[d, item] = (min(lo, old[0]), max(hi, old[1]), min(edits, old[2])) if old else (lo, hi, edits)
                for (d, item), h in best.items():
                    hits[d] += [(i, *h) for i in index.ids[item]]
            return [[sorted(x, key=lambda h: (h[0] is None, h[0] or 0, h[1:])) for x in hits]]
        return f
    return make


def _blocks(benchmark: DataFrame, p: LeakParams) -> Blocks:
    """The benchmark's distinct texts with their ids, in blocks of about ``block_chars``."""
    items = (benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).filter("text is not null")
             .groupBy("text").agg(F.collect_list("item_id").alias("ids"), F.count(F.lit(1)).alias("n")))
    # collect_list leaves out null ids, which are reported as null
    nulls = F.array_repeat(F.lit(None).cast("long"), (F.col("n") - F.size("ids")).cast("int"))
    tables = RoundTables(benchmark.sparkSession, "benchmark-blocks")
    items, _ = tables.write(items.select("text", F.concat("ids", nulls).alias("ids")))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-total // p.block_chars)
    placed = items.withColumn("block", F.pmod(F.xxhash64("text"), F.lit(max(1, blocks))).cast("int"))
    out, _ = tables.write(placed.repartition(max(1, blocks), "block"), by=["block"])
    return Blocks(tables.path(out), sorted(r.block for r in out.select("block").distinct().collect()), p)


def report(docs: DataFrame, benchmark: DataFrame, params: LeakParams = LeakParams()) -> DataFrame:
    """(doc_id, contaminated, item_ids, hits) per row of ``docs``; hits are
    (item_id, start, end, edits) with code-point spans of the document."""
    blocks = _blocks(benchmark, params)
    out = map_texts(docs, _finder(blocks), _HITS, ["doc_id"], block_chars=blocks.text_chars())
    return out.select("doc_id", (F.size("hits") > 0).alias("contaminated"),
                      F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["item_id"]))).alias("item_ids"), "hits")


def keep_clean(docs: DataFrame, benchmark: DataFrame, params: LeakParams = LeakParams()) -> DataFrame:
    """Rows of ``docs``, with their own columns, that no benchmark item is found in."""
    blocks = _blocks(benchmark, params)

    def make():
        f = _finder(blocks)()
        return lambda texts: [[not h for h in f(texts)[0]]]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    return (map_texts(rows, make, StructType([StructField("clean", BooleanType())]), ["row"], block_chars=blocks.text_chars())
            .filter("clean").select("row.*"))
