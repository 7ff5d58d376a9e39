"""Session-level helpers: checkpoint folder, lineage cuts, per-round tables, tracing."""

from __future__ import annotations

import os
import sys
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession


_TRACE = bool(os.environ.get("ROUTELYTICS_TRACE"))
_T0 = time.perf_counter()


def trace(msg: str) -> None:
    """Timing line on stderr when ROUTELYTICS_TRACE is set (iterative operators)."""
    if _TRACE:
        print(f"[routelytics {time.perf_counter() - _T0:8.2f}s] {msg}", file=sys.stderr, flush=True)


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of this session.

    The folder named by ``spark.checkpoint.dir`` (or already set on the
    SparkContext) is used as is.  Only a ``local`` master with nothing set
    gets a scratch folder of its own, as in tests; on a cluster an unset
    folder is an error, since a machine-local folder would not survive the
    loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="routelytics-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set: iterative operators need a shared "
        "folder (HDFS/S3/...) to cut lineage")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once under the checkpoint folder and read it back.

    The returned DataFrame reads shared files, so a lost executor re-reads them
    instead of replaying what came before, and nothing is kept in executor
    memory or on local disks.
    """
    return RoundTables(df.sparkSession, "routelytics-cut").write(df)[0]


def spread_small_scan(df: DataFrame) -> DataFrame:
    """Round-robin a scan of fewer files than there are cores.

    One or a handful of files would leave most cores idle in a CPU-heavy
    stage such as tokenising.  Only the file listing is looked at (no job
    runs), and an input of many files, as any large one, is returned unchanged,
    so it never pays for an extra shuffle.  Rows are the same either way.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 0 < len(df.inputFiles()) < cores else df


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of any store Spark can write to."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


class RoundTables:
    """Per-round tables of an iterative operator, written under the checkpoint folder.

    ``write(df, **metrics)`` writes one round in a single job, returns the
    table read back from its files (no lineage, survives executor loss)
    and the metrics observed while writing (e.g. how many rows changed),
    so no extra job is needed to count them.  With ``keep`` only that many
    latest rounds stay on disk.
    """

    def __init__(self, spark: SparkSession, prefix: str, keep: int | None = None):
        self.spark, self.keep = spark, keep
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/{prefix}-{uuid.uuid4().hex}"
        self.n = 0
        self._paths: dict[int, tuple[DataFrame, str]] = {}

    def write(self, df: DataFrame, by: list[str] | None = None, **metrics) -> tuple[DataFrame, dict]:
        """Write ``df`` (in folders by the columns ``by``) and read it back."""
        self.n += 1
        path = f"{self.root}/round={self.n}"
        if metrics:
            obs = Observation(f"{self.root.rsplit('/', 1)[-1]}-{self.n}")
            df = df.observe(obs, *[c.alias(k) for k, c in metrics.items()])
            df.write.partitionBy(*by or []).mode("overwrite").parquet(path)
            got = obs.get
        else:
            df.write.partitionBy(*by or []).mode("overwrite").parquet(path)
            got = {}
        if self.keep and self.n > self.keep:
            delete_path(self.spark, f"{self.root}/round={self.n - self.keep}")
        # an empty table in folders has no file to take the schema from
        out = (self.spark.read.schema(df.schema) if by else self.spark.read).parquet(path)
        self._paths[id(out)] = out, path
        return out, got

    def path(self, table: DataFrame) -> str:
        """Folder of a table of this set."""
        return self._paths[id(table)][1]

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables of this set that nothing reads any more."""
        for t in tables:
            delete_path(self.spark, self._paths.pop(id(t))[1])

    def clear(self) -> None:
        """Delete all tables of this set."""
        self._paths.clear()
        delete_path(self.spark, self.root)
