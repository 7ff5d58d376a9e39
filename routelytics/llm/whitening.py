"""Embedding whitening from a covariance weighted by multiplicity.

1. Entries become whole numbers x = floor(1024 * c) + 100000, and rows with the
   same x vector are grouped: one row per distinct vector with its number of
   copies (map-side partials: a vector that a third of the rows hold is one row
   per task).
2. Weights are the copies, or one per distinct vector.  Weighted sums S per
   dimension are exact whole numbers; the covariance is the weighted product of
   the centred vectors (n x - S) / n, summed over tasks: d * d numbers reach the
   driver, whatever the number of rows.
3. Each distinct vector is whitened once: projected on the unit eigenvectors of
   the covariance, over the root of their eigenvalues.  The covariance of the
   whitened values is measured by a second weighted product.
4. The results are joined back to the rows by the 128-bit hash of the vector
   (two hashes collide with a probability of about 1e-38 a pair); the distinct
   side has one row per key, so the skew join splits a hot vector.

Defined results: rows drop out whose vector is null, empty, holds a null or
non-finite entry or one beyond 2**42 (x would not be exact), or has another
length than most of the rest (ties: the longer one).  A null id stays with its
vector; rows that repeat an id each count.  Components without variance (an
eigenvalue below 1e-12 of the trace) are left out, so a single row or equal
rows give no rows; an empty table gives an empty result.  A deviation that does not
fit in a long is null.  Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from routelytics.llm.sums import summed
from routelytics.session import RoundTables

KEY = ["hi", "lo"]
#: entries beyond it would give an x that a double does not hold exactly
MOST = float(1 << 42)


@dataclass(frozen=True)
class WhitenParams:
    components: int = 8
    #: "copies": every row counts; "one": every distinct vector counts once
    weights: str = "copies"
    scale: int = 1024
    shift: int = 100_000


def whole_vectors(df: DataFrame, p: WhitenParams, vec_col: str, *more) -> DataFrame:
    """(x, hi, lo, ...): whole-number vectors of the rows that remain, of any length."""
    v = F.col(f"`{vec_col}`").cast("array<double>")
    fine = (F.size(v) > 0) & F.forall(v, lambda c: F.coalesce(F.abs(c) <= MOST, F.lit(False)))  # NaN is above all
    x = F.transform(v, lambda c: F.floor(c * p.scale) + p.shift)
    rows = df.filter(fine).select(x.alias("x"), *more)
    return rows.select("x", F.xxhash64("x").alias("hi"), F.xxhash64(F.lit(1), "x").alias("lo"),
                       *[c for c in rows.columns if c != "x"])


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def _exact_sums(distinct: DataFrame, d: int) -> tuple[int, list[int]]:
    """Sum of weights, and weighted sum of each dimension, as whole numbers."""
    def run(batches):
        total = [0] * (d + 1)
        for b in batches:
            if b.num_rows:
                x, w = _matrix(b.column(0)), b.column(1).to_numpy().astype(np.int64)
                if float(np.abs(x).max()) * float(w.sum()) < 2.0**62:
                    part = [int(v) for v in w @ x]
                else:
                    part = [sum(int(a) * int(c) for a, c in zip(col, w)) for col in x.T]
                total = [a + b for a, b in zip(total, part + [int(w.sum())])]
        yield pa.RecordBatch.from_arrays([pa.array(range(d + 1), pa.int32()), pa.array([str(t) for t in total])], names=["at", "v"])

    rows = (distinct.select("x", "weight").mapInArrow(run, "at int, v string")
            .groupBy("at").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect())
    sums = {r["at"]: int(r["v"]) for r in rows}
    return sums[d], [sums[i] for i in range(d)]


def _centred(x: np.ndarray, n: int, s: list[int]):
    """n * x - S as whole numbers: an int64 array, or one of Python integers."""
    if float(np.abs(x).max(initial=0)) * n < 2.0**61:
        return x * np.int64(n) - np.array(s, np.int64)
    return x.astype(object) * n - np.array(s, object)


def _deviation(z: np.ndarray) -> list:
    if z.dtype != object and z.shape[1] * float(np.abs(z).max(initial=0)) ** 2 < 2.0**62:
        return (z * z).sum(axis=1).tolist()
    exact = [sum(int(v) ** 2 for v in row) for row in z]
    return [e if e < 1 << 63 else None for e in exact]


def whiten(df: DataFrame, p: WhitenParams = WhitenParams(), id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    """(vec_id, n, deviation, whitened, explained, identity_error) of every remaining row.

    ``whitened`` and ``explained`` list the components by falling eigenvalue.
    """
    tables = RoundTables(df.sparkSession, "whitening")
    weight = F.col("copies") if p.weights == "copies" else F.lit(1).cast("long")
    distinct, _ = tables.write(whole_vectors(df, p, vec_col).groupBy(*KEY, "x").agg(F.count(F.lit(1)).alias("copies"))
                               .withColumn("weight", weight))
    lengths = (distinct.groupBy(F.size("x").alias("d")).agg(F.sum("copies").alias("n"))
               .orderBy(F.desc("n"), F.desc("d")).limit(1).collect())
    if not lengths:
        return _rows(df, distinct.select(*KEY, F.lit(None).cast("long").alias("deviation"),
                                         F.array().cast("array<double>").alias("whitened")), p, id_col, vec_col, 0, [], 0.0)
    d = lengths[0]["d"]
    same = distinct.filter(F.size("x") == d)
    n, s = _exact_sums(same, d)

    def product(b):
        z, w = _centred(_matrix(b.column(0)), n, s).astype(np.float64) / n, b.column(1).to_numpy().astype(np.float64)
        return (z.T @ (z * w[:, None])).ravel()

    cov = summed(same.select("x", "weight"), d * d, product).reshape(d, d) / n
    values, vectors = np.linalg.eigh((cov + cov.T) / 2)
    order = np.argsort(values)[::-1]
    trace = float(np.trace(cov))
    used = [i for i in order if values[i] > max(trace, 0) * 1e-12][:p.components]
    project = vectors[:, used] / np.sqrt(values[used])

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            z = _centred(_matrix(b.column(2)), n, s)
            y = z.astype(np.float64) / n @ project
            at = np.arange(len(y) + 1, dtype=np.int32) * y.shape[1]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(_deviation(z), pa.int64()),
                 pa.ListArray.from_arrays(pa.array(at), pa.array(y.ravel())), b.column(3)],
                names=[*KEY, "deviation", "whitened", "weight"])

    white, _ = tables.write(same.select(*KEY, "x", "weight").mapInArrow(
        run, "hi long, lo long, deviation long, whitened array<double>, weight long"))
    tables.drop(distinct)
    k = len(used)

    def second(b):
        y, w = np.asarray(b.column(0).flatten().to_numpy(zero_copy_only=False)).reshape(b.num_rows, -1), b.column(1).to_numpy()
        return np.concatenate([(y * w[:, None]).sum(axis=0), (y.T @ (y * w[:, None])).ravel()])

    error = 0.0
    if k:
        got = summed(white.select("whitened", "weight"), k + k * k, second) / n
        error = float(np.abs(got[k:].reshape(k, k) - np.outer(got[:k], got[:k]) - np.eye(k)).max())
    return _rows(df, white.drop("weight"), p, id_col, vec_col, n, [float(values[i]) / trace for i in used], error)


def _rows(df, white, p, id_col, vec_col, n, explained, error) -> DataFrame:
    rows = whole_vectors(df, p, vec_col, F.col(f"`{id_col}`").alias("vec_id")).select("vec_id", *KEY)
    shares = F.array(*[F.lit(e) for e in explained]).cast("array<double>")
    return rows.join(white, KEY).select("vec_id", F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                                        shares.alias("explained"), F.lit(error).alias("identity_error"))


def digest(df: DataFrame) -> DataFrame:
    """Columns of the op13 contract: one row per remaining row and component."""
    got = whiten(df)
    return got.select("vec_id", "n", "deviation", "identity_error",
                      F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation",
        F.col("c.whitened").alias("whitened"), F.col("c.explained").alias("explained"), "identity_error")
