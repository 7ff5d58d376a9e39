"""Sums of fixed-size numpy arrays over the partitions of a table."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


def summed(df: DataFrame, size: int, add: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """Sum of ``add(batch)``, an array of ``size`` numbers, over all batches of ``df``.

    Each task sends one row per non-zero entry, these are summed by a grouped
    aggregation, and at most ``size`` numbers reach the driver.
    """
    def run(batches):
        total = np.zeros(size)
        for b in batches:
            if b.num_rows:
                total += add(b)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(total[at])], names=["at", "v"])

    rows = df.mapInArrow(run, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(size)
    for r in rows:
        out[r["at"]] = r["v"]
    return out


def vectors(column) -> np.ndarray:
    """(rows, d) array of a list column whose lists are all of one length."""
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def by_crc32(id_col: str, mod: int):
    """crc32 of the id as text modulo ``mod``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string")) % mod


def bounded_labels(labels: DataFrame, value: str, train, most: int) -> DataFrame:
    """(doc_id, y) of training rows, one per id (of several labels the larger),
    thinned evenly by a hash of the id to about ``most`` rows."""
    rows = (labels.filter(F.col("doc_id").isNotNull() & F.col(value).isNotNull()).filter(train)
            .groupBy("doc_id").agg(F.max(value).cast("int").alias("y")))
    n = rows.count()
    if n > most:
        rows = rows.filter(F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1_000_000)) < int(1_000_000 * most / n))
    return rows
