"""State of a stream as one delta per batch and a snapshot every few batches."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class DeltaLog:
    """Rows of all batches of a stream, merged by ``merged(rows)``.

    ``read`` names the folders it needs by batch number: the last snapshot and at
    most ``every`` deltas, however many batches there were.  A replayed batch
    rewrites its own delta and snapshot.  Batch numbers of a stream follow each other.
    """

    def __init__(self, spark: SparkSession, root: str, schema: str, merged: Callable[[DataFrame], DataFrame], every: int = 8):
        self.spark, self.root, self.schema, self.merged, self.every = spark, root, schema, merged, every

    def _delta(self, batch_id: int) -> str:
        return os.path.join(self.root, "deltas", f"batch={batch_id}")

    def _snapshot(self, batch_id: int) -> str:
        return os.path.join(self.root, "snapshots", f"up_to={batch_id}")

    def write(self, batch_id: int, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(self._delta(batch_id))
        if (batch_id + 1) % self.every == 0:
            self.read(batch_id).write.mode("overwrite").parquet(self._snapshot(batch_id))

    def folders(self, batch_id: int) -> list[str]:
        """What holds the rows up to a batch."""
        done = batch_id // self.every * self.every - 1
        old = [self._snapshot(done)] if done >= 0 else []
        return old + [self._delta(b) for b in range(done + 1, batch_id + 1)]

    def read(self, batch_id: int) -> DataFrame:
        """The merged rows of all batches up to this one."""
        return self.merged(self.spark.read.schema(self.schema).parquet(*self.folders(batch_id)))
