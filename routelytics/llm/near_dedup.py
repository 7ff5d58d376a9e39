"""MinHash near-duplicates with tensored banding.

A text's set is its distinct ``width``-word shingles (64-bit hashes, A-Z in
lower case; a shorter text is one shingle; no words: the empty set, linked
with nothing).  Two small collections of ``groups`` groups of ``rows``
minhashes stand in for groups x groups tables: table (i, j) is keyed by group
i of the first collection and group j of the second.  2 * 14 * 3 = 84 minhashes
give 196 tables of six, which untensored would take 1176.  At similarity 0.8 a
pair shares no table with probability 1e-4.

Steps, all on representatives of equal sets (exact copies cost one row):

1. A group hash that no other text has cannot take part in any table, so
   table keys are formed only from groups that collide.
2. Each table's members are paired with its least member (a star).  A text
   tries the star that shares most tables with it, then its next ones where
   they lie in another component; confirmed on the full sets, they join
   components.
3. Texts of tables that still hold several components are compared by an exact
   prefix filter: a text's shingles are ordered by their frequency among these
   texts, rarest first.  For two sets of sizes m >= n to reach the similarity, their
   overlap must be at least ``need`` = percent * (m + n) / (100 + percent), so their
   first common shingle lies among the first m - need + 1 and n - need + 1.  Texts of
   different components that share such a shingle are confirmed; all others
   cannot reach the similarity.  In a family of texts that are each a bit too far
   apart, the rarest shingles are each text's own, so no pairs come up.

Joins are on table keys, shingles or ids with the shuffle on both sides, so the skew
join splits a hot one; nothing is gathered per key, collected or broadcast by hand.

Defined results: null or blank texts have n_shingles 0 and stand alone; rows
that repeat an id are each classed by their text, and a component's id is the
least id among its rows; a null id takes no part (component_id null, kept);
extra columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from routelytics.llm.blocks import map_texts
from routelytics.llm.components import components
from routelytics.session import RoundTables


@dataclass(frozen=True)
class NearDupParams:
    width: int = 5
    percent: int = 80
    groups: int = 14
    rows: int = 3
    seed: int = 20240607
    #: stars a text tries before the prefix filter covers the rest
    star_pairs: int = 8


_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


class _WordHashes(dict):
    """64-bit hashes of words; forgets all when large."""

    def __missing__(self, w: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        h = self[w] = xxhash.xxh64_intdigest(w)
        return h


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _multipliers(n: int, seed: int) -> np.ndarray:
    return _mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def shingler(p: NearDupParams):
    """Function from a text to the sorted distinct 64-bit hashes of its shingles."""
    words_of, mult = _WordHashes(), _multipliers(p.width, p.seed + 1)

    def f(text: str) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()  # splits at 09-0D and 20 only
        n = len(words)
        if not n:
            return np.empty(0, np.uint64)
        h = np.fromiter(map(words_of.__getitem__, words), np.uint64, n)
        k = min(n, p.width)
        s = h[:n - k + 1] * mult[0]
        for i in range(1, k):
            s = _mix(s) + h[i:n - k + 1 + i] * mult[i]
        return np.unique(_mix(s + np.uint64(k)))
    return f


def _minhashes(sets: list[np.ndarray], mult: np.ndarray) -> np.ndarray:
    """(sets, hashes) least 32-bit hash of each set under each function; 0 for empty sets."""
    sizes = np.array([len(s) for s in sets], np.int64)
    full = np.flatnonzero(sizes)
    out = np.zeros((len(sets), len(mult)), np.uint32)
    if len(full):
        flat = np.concatenate([sets[i] for i in full])
        starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
        for k, m in enumerate(mult):
            out[full, k] = np.minimum.reduceat(flat * m, starts) >> np.uint64(32)
    return out


def _lists(a: np.ndarray, kind: pa.DataType, dtype) -> pa.Array:
    offsets = np.arange(len(a) + 1, dtype=np.int32) * a.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(a).view(dtype).ravel(), kind))


def _signatures(p: NearDupParams):
    def make():
        sets_of = shingler(p)
        n_hash = 2 * p.groups * p.rows
        mult = _multipliers(n_hash, p.seed)

        def f(texts):
            sets = [sets_of(t) for t in texts]
            sizes = np.array([len(s) for s in sets], np.int64)
            sig = _minhashes(sets, mult)
            grouped = sig.reshape(len(texts), 2 * p.groups, p.rows).astype(np.uint64)
            g = np.broadcast_to(np.arange(1, 2 * p.groups + 1, dtype=np.uint64), grouped.shape[:2]).copy()
            for r in range(p.rows):
                g = _mix(g * np.uint64(0x9E3779B97F4A7C15) + grouped[:, :, r])
            keys = [_key(s) for s in sets]
            return [pa.array(sizes), keys, _lists(g, pa.int64(), np.int64)]
        return f
    return make


_SIGNATURE = StructType([StructField("n_shingles", LongType()), StructField("set_key", BinaryType()),
                         StructField("grp", ArrayType(LongType()))])


def _key(hashes: np.ndarray) -> bytes | None:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else None


def _full_sets(p: NearDupParams):
    def make():
        sets_of = shingler(p)
        return lambda texts: [[x.tobytes() for x in map(sets_of, texts)]]
    return make


_FULL_SET = StructType([StructField("hashes", BinaryType())])


def _buckets(reps: DataFrame, p: NearDupParams) -> DataFrame:
    """(key, ti, tj, rep): tables that a representative shares with another one, or may."""
    bands = reps.select("rep", F.posexplode("grp").alias("g", "h"))
    hot = bands.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h")
    live = bands.join(hot, "h").groupBy("rep").agg(F.collect_list(F.struct("g", "h")).alias("live"))  # at most 2 * groups
    first = F.filter("live", lambda x: x["g"] < p.groups)
    second = F.filter("live", lambda x: x["g"] >= p.groups)
    pairs = F.flatten(F.transform(first, lambda a: F.transform(second, lambda b: F.struct(
        F.xxhash64(a["h"], b["h"]).alias("key"), a["g"].alias("ti"), (b["g"] - p.groups).alias("tj")))))
    return live.select("rep", F.explode(pairs).alias("t")).select("t.key", "t.ti", "t.tj", "rep")


def _confirm(pairs: DataFrame, sets: DataFrame, p: NearDupParams) -> DataFrame:
    """Pairs (a, b) whose full sets reach the similarity."""
    both = (pairs.join(sets.select(F.col("rep").alias("a"), F.col("hashes").alias("x")), "a")
            .join(sets.select(F.col("rep").alias("b"), F.col("hashes").alias("y")), "b").select("a", "b", "x", "y"))

    def run(batches):
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if 100 * min(len(x), len(y)) < p.percent * max(len(x), len(y)):
                    ok.append(False)
                    continue
                m = np.sort(np.concatenate([x, y]), kind="stable")
                shared = int((m[1:] == m[:-1]).sum())
                ok.append(100 * shared >= p.percent * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def _apart(stars: DataFrame, joined: DataFrame, tried: DataFrame) -> DataFrame:
    """Untried star pairs whose ends are in different components."""
    pairs = stars.select("a", "b").withColumn("ca", F.col("a")).withColumn("cb", F.col("b"))
    for end in "ab":
        of = joined.select(F.col("node").alias(end), F.col("component").alias("comp"))
        pairs = pairs.join(of, end, "left").withColumn(f"c{end}", F.coalesce("comp", end)).drop("comp")
    return pairs.filter("ca <> cb").select("a", "b").join(tried.select("a", "b"), ["a", "b"], "left_anti")


def _shingles(sets: DataFrame) -> DataFrame:
    """(rep, comp, n, h): one row per shingle of each set."""
    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                sets = [np.frombuffer(x.as_buffer(), np.int64) for x in part.column(2)]
                at = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
                sizes = np.array([len(x) for x in sets], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(at)), part.column(1).take(pa.array(at)), pa.array(sizes[at]),
                     pa.array(np.concatenate(sets) if sets else np.empty(0, np.int64))], names=["rep", "comp", "n", "h"])
    return sets.select("rep", "comp", "hashes").mapInArrow(run, "rep long, comp long, n long, h long")


def _need(m, n, percent: int):
    """Least overlap of sets of these sizes at the similarity."""
    return F.ceil(F.lit(percent) * (m + n) / F.lit(100 + percent))


def _prefixes(sets: DataFrame, p: NearDupParams) -> DataFrame:
    """(h, rep, comp, n, pos): shingles of each set, rarest first, that may be its first
    common one with a set of another component."""
    rows = _shingles(sets)
    freq = rows.groupBy("h").agg(F.count(F.lit(1)).alias("f"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    # shingles of one component alone count as positions, but join with nothing
    freq = freq.select("h", "f", (F.col("lo") < F.col("hi")).alias("live"))
    rank = F.row_number().over(Window.partitionBy("rep").orderBy("f", "h")) - 1  # one text's set
    ordered = rows.join(freq, "h").withColumn("pos", rank)
    # the partner is smaller by ``percent`` at most
    most = F.col("n") - _need(F.col("n"), F.ceil(F.col("n") * p.percent / 100), p.percent) + 1
    return ordered.filter(F.col("live") & (F.col("pos") < most)).select("h", "rep", "comp", "n", "pos")


def _apart_pairs(prefixes: DataFrame, p: NearDupParams) -> DataFrame:
    """Pairs (a, b), a > b, of different components that the prefix filter leaves; each once.

    The smaller set of a pair has its first common shingle among its first n - need(n, n) + 1.
    Per shingle, the component with most rows is compared with the others only.
    """
    n = F.col("n")
    rows = prefixes.withColumn("short", F.col("pos") <= n - _need(n, n, p.percent))
    sizes = rows.groupBy("h", "comp").agg(F.count(F.lit(1)).alias("k"))
    main = sizes.groupBy("h").agg(F.max(F.struct("k", "comp")).alias("m"), F.count(F.lit(1)).alias("comps"))
    rows = rows.join(main.filter("comps > 1").select("h", F.col("m.comp").alias("main")), "h")
    x, y = rows.filter("comp <> main").alias("x"), rows.alias("y")

    def meet(small, large, once):
        s, g = (lambda c: F.col(f"{small}.{c}")), (lambda c: F.col(f"{large}.{c}"))
        need = _need(s("n"), g("n"), p.percent)
        on = ((F.col("x.h") == F.col("y.h")) & (F.col("x.comp") != F.col("y.comp")) & once
              & ((g("n") > s("n")) | ((g("n") == s("n")) & (g("rep") > s("rep"))))
              & (100 * s("n") >= p.percent * g("n")) & (s("n") - s("pos") >= need) & (g("n") - g("pos") >= need))
        left, right = (x.filter("short"), y) if small == "x" else (x, y.filter("short"))
        return left.join(right, on).select(F.greatest("x.rep", "y.rep").alias("a"), F.least("x.rep", "y.rep").alias("b"))

    # two rows outside the main component meet in the first join
    return meet("x", "y", F.lit(True)).unionByName(meet("y", "x", F.col("y.comp") == F.col("y.main"))).distinct()


def _text_hash(text_col: str = "text"):
    return F.xxhash64(F.col(f"`{text_col}`").cast("string"))


def _classed(docs: DataFrame, p: NearDupParams, id_col: str) -> DataFrame:
    """(doc_id, text_hash, n_shingles, class, component_id) of every row; no class without words or id."""
    tables = RoundTables(docs.sparkSession, "near-dedup")
    hashed = docs.select(F.col(f"`{id_col}`").alias("doc_id"), _text_hash().alias("text_hash"), F.col("text"))
    rows, _ = tables.write(map_texts(hashed, _signatures(p), _SIGNATURE, ["doc_id", "text_hash"]))
    some = rows.filter("set_key is not null and doc_id is not null")
    # one row per distinct set: its least id, with the signature
    own = some.groupBy("set_key").agg(F.min(F.struct("doc_id", "text_hash")).alias("own"))
    sets_of, _ = tables.write(own.select("set_key", "own.*"))
    # a set is known by its least id; where texts of one id are least in several sets, the others get a number of their own
    clash, several = tables.write(sets_of.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.min("set_key").alias("first"))
                                  .filter("n > 1").select("doc_id", "first"), n=F.count(F.lit(1)))
    if several["n"]:
        other = -1 - F.xxhash64("set_key").bitwiseAND(F.lit((1 << 62) - 1))
        named = sets_of.join(clash, "doc_id", "left").withColumn(
            "rep", F.when(F.coalesce(F.col("first") != F.col("set_key"), F.lit(False)), other).otherwise(F.col("doc_id"))).drop("first")
    else:
        named = sets_of.withColumn("rep", F.col("doc_id"))
    grp = some.join(named, ["set_key", "doc_id", "text_hash"]).groupBy("rep", "set_key", "doc_id", "text_hash").agg(
        F.first("grp").alias("grp"), F.count(F.lit(1)).alias("copies"))
    reps, same = tables.write(grp, copies=F.max("copies"))

    buckets, _ = tables.write(_buckets(reps, p))
    shared = buckets.groupBy("key").agg(F.min("rep").alias("pivot"), F.max("rep").alias("last")).filter("pivot < last")
    stars = (buckets.join(shared.select("key", "pivot"), "key").filter("rep <> pivot")
             .groupBy(F.col("rep").alias("a"), F.col("pivot").alias("b")).agg(F.count(F.lit(1)).alias("n")))
    # the stars that share most tables with a text, which has one in each table at most;
    # pairs left out here are compared at the end, if their ends are not connected by then
    nearest = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "b"))), 1, p.star_pairs)
    stars = stars.groupBy("a").agg(nearest.alias("s")).select("a", F.posexplode("s").alias("turn", "s")).select(
        "a", "s.b", "turn")
    stars, _ = tables.write(stars)

    # full sets of the texts that share a table with another one, one row per set
    wanted = (buckets.join(shared.select("key"), "key", "left_semi").select("rep").distinct()
              .join(reps.select("rep", "doc_id", "text_hash"), "rep"))
    texts = hashed.join(wanted.hint("shuffle_hash"), ["doc_id", "text_hash"]).select("rep", "text")
    if (same["copies"] or 0) > 1:  # repeated rows: one of them
        turn = F.row_number().over(Window.partitionBy("rep").orderBy("rep"))
        texts = texts.withColumn("turn", turn).filter("turn = 1").select("rep", "text")
    sets, _ = tables.write(map_texts(texts, _full_sets(p), _FULL_SET, ["rep"]))

    # each text tries its nearest star, then its others that lead to another component
    tried, picked = tables.write(stars.filter("turn = 0").select("a", "b"), n=F.count(F.lit(1)))
    joined = docs.sparkSession.createDataFrame([], "node long, component long")
    if picked["n"]:
        links, _ = tables.write(_confirm(tried, sets, p))
        joined, _ = tables.write(components(links))
        pairs, picked = tables.write(_apart(stars, joined, tried), n=F.count(F.lit(1)))
        if picked["n"]:
            tried = tried.unionByName(pairs)
            found, new = tables.write(_confirm(pairs, sets, p), n=F.count(F.lit(1)))
            if new["n"]:
                links = links.unionByName(found)
                joined, _ = tables.write(components(links))
        # texts of tables that still hold several components
        of = (buckets.join(shared.select("key"), "key", "left_semi").join(joined, buckets.rep == joined.node, "left")
              .select("key", "rep", F.coalesce("component", "rep").alias("comp")))
        mixed = of.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("key")
        open_, more = tables.write(of.join(mixed, "key", "left_semi").select("rep", "comp").distinct(), n=F.count(F.lit(1)))
        if more["n"]:
            prefixes, _ = tables.write(_prefixes(open_.join(sets, "rep"), p))
            pairs, _ = tables.write(_apart_pairs(prefixes, p).join(tried.select("a", "b"), ["a", "b"], "left_anti"))
            late, found = tables.write(_confirm(pairs, sets, p), n=F.count(F.lit(1)))
            if found["n"]:
                joined, _ = tables.write(components(links.unionByName(late)))
            tables.drop(prefixes, pairs)
    tables.drop(reps, buckets, stars, sets)
    by_set = (named.join(joined, named.rep == joined.node, "left")
              .select("set_key", F.col("doc_id").alias("least"), F.coalesce("component", "rep").alias("class")))
    if several["n"]:
        by_set = by_set.join(by_set.groupBy("class").agg(F.min("least").alias("component_id")), "class")
    else:
        by_set = by_set.withColumn("component_id", F.col("class"))
    out = rows.join(by_set.select("set_key", "class", "component_id"), "set_key", "left")
    none = F.col("doc_id").isNull()
    return out.select("doc_id", "text_hash", "n_shingles", F.when(~none, F.col("class")).alias("class"),
                      F.when(~none, F.coalesce("component_id", "doc_id")).alias("component_id"))


def classes(docs: DataFrame, params: NearDupParams = NearDupParams(), id_col: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``."""
    return _classed(docs, params, id_col).select(
        "doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, params: NearDupParams = NearDupParams()) -> DataFrame:
    """One row of ``docs`` per class, with its own columns: the least id's.

    Texts without words are a class of their own for each id.  Of rows of one
    class and id, the one with the least text hash stays; rows with a null id all stay.
    """
    rows = _classed(docs, params, "doc_id").filter("doc_id is not null")
    least = F.min(F.struct("doc_id", "text_hash")).alias("k")
    verdict = (rows.filter("class is not null").groupBy("class").agg(least).select("k.*")
               .unionByName(rows.filter("class is null").select("doc_id", "text_hash").distinct())
               .select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__h")))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(F.col("doc_id").alias("__id"), _text_hash().alias("__h"), row)
    # a repeated row is dropped before the shuffle already (window group limit)
    turn = F.row_number().over(Window.partitionBy("__id", "__h").orderBy("__h"))
    once = rows.join(verdict, ["__id", "__h"]).withColumn("__n", turn).filter("__n = 1").select("row.*")
    return once.unionByName(rows.filter("__id is null").select("row.*"))


def digest(docs: DataFrame) -> DataFrame:
    """Columns of the op9 contract: four-word shingles, similarity 0.8."""
    return classes(docs, NearDupParams(width=4))
