"""Line dedup with levelled sorted runs of line hashes.

A line's key is the line without blanks at both ends and with A-Z in lower
case; keys of ``least_chars`` code points or more take part.  A key found in
``least_docs`` documents or more loses all its lines except those of the largest
id that holds it.  Only DataFrame functions run here, no Python on executors.

``LineRuns`` is a log-structured set of keys (128-bit hashes):

* A batch of documents is reduced to one row per key and written as a run: a
  table bucketed and sorted by the key.
* The run is merge-anti-joined with all older runs.  What is left are the keys
  that this batch is the first to hold; no older run is shuffled or sorted again.
* Runs of a level are merged into one run of the next level when there are
  ``fan`` of them, so a batch meets at most about fan * log(batches) runs.

Batches are ranges of ids in falling order (cut points are approximate quantiles;
any cut points give the same result), so the first batch to hold a key holds its
largest id.  The runs' totals say which keys are frequent.  Lines meet those
keys in a join by key that the skew join can split, since a frequent key is one
row there; the positions to drop are gathered per text and meet the texts again.

Defined results: a null or empty text is one empty line; a document is a distinct
id, so rows that repeat an id count once, each row loses the lines of its own
text, and all rows of the largest id keep theirs; rows with a null id take no
part and keep all lines; two different keys share a hash with a probability of
about 1e-38 a pair; an empty table gives an empty result; extra columns pass
through ``drop_repeated`` and are ignored elsewhere.
"""

from __future__ import annotations

import string
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from routelytics.session import RoundTables, checkpoint_dir, delete_path

BLANKS = " \t\n\x0b\x0c\r"
KEY = ["hi", "lo"]


@dataclass(frozen=True)
class LineDedupParams:
    least_chars: int = 40
    least_docs: int = 5
    batches: int = 6
    fan: int = 3


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z in lower case."""
    bare = F.btrim(line, F.lit(BLANKS))
    ascii_only = F.octet_length(bare) == F.length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, string.ascii_uppercase, string.ascii_lowercase))


class LineRuns:
    """Levelled runs of keys ``(hi, lo, docs)``; see the module's docstring."""

    def __init__(self, spark: SparkSession, fan: int = 3):
        self.spark, self.fan = spark, fan
        self.name = f"line_runs_{uuid.uuid4().hex}"
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/{self.name}"
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.made = 0

    def _run(self, rows: DataFrame) -> str:
        self.made += 1
        name = f"{self.name}_{self.made}"
        (rows.repartition(self.buckets, *KEY).write.bucketBy(self.buckets, *KEY).sortBy(*KEY)
         .option("path", f"{self.root}/{self.made}").saveAsTable(name))
        return name

    def _path(self, name: str) -> str:
        return f"{self.root}/{name.rsplit('_', 1)[1]}"

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        delete_path(self.spark, self._path(name))

    @property
    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def add(self, keys: DataFrame) -> DataFrame:
        """Add a batch of distinct keys ``(hi, lo, docs, ...)``: those that no earlier batch held.

        The result reads the batch's run and the older ones: use it before
        the next ``compact``.
        """
        run = self._run(keys)
        fresh = self.spark.table(run)
        for older in self.runs:
            fresh = fresh.join(self.spark.table(older).select(*KEY), KEY, "left_anti")
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(run)
        return fresh

    def compact(self) -> None:
        """Merge each level that holds ``fan`` runs into one run of the next level."""
        for at, level in enumerate(self.levels):
            if len(level) < self.fan:
                continue
            if at + 1 == len(self.levels):
                self.levels.append([])
            self.levels[at + 1].append(self._run(self._merged(level)))
            self.levels[at] = []
            for name in level:
                self._drop(name)

    def _merged(self, names: list[str]) -> DataFrame:
        # read as plain files: Spark 4.1 takes a union of bucketed tables for bucketed
        # itself, though its partitions only follow each other, and sums keys apart
        rows = self.spark.read.schema("hi long, lo long, docs long").parquet(*[self._path(name) for name in names])
        return rows.groupBy(*KEY).agg(F.sum("docs").alias("docs"))

    def totals(self) -> DataFrame:
        """``(hi, lo, docs)`` over all batches."""
        return self._merged(self.runs)

    def drop(self) -> None:
        for name in self.runs:
            self._drop(name)
        self.levels = []


def _split(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """(doc_id, text_hash, lines, ...): a text is known by its id and hash."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                       F.split(text, "\n", -1).alias("lines"), *more)


def keyed_lines(docs: DataFrame, p: LineDedupParams, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text_hash, pos, hi, lo)``: one row per line that takes part."""
    lines = _split(docs, id_col, text_col).filter("doc_id is not null").select(
        "doc_id", "text_hash", F.posexplode("lines").alias("pos", "line"))
    long = lines.filter(F.octet_length("line") >= p.least_chars)
    keyed = long.select("doc_id", "text_hash", "pos", line_key(F.col("line")).alias("key")).filter(
        F.length("key") >= p.least_chars)
    return keyed.select("doc_id", "text_hash", "pos", F.xxhash64("key").alias("hi"), F.xxhash64(F.lit(1), "key").alias("lo"))


def _batch(cuts: list) -> Column:
    """0 for the largest ids, then up."""
    at = F.lit(0)
    for c in cuts:
        at = at + (F.col("doc_id") < F.lit(c)).cast("int")
    return at


def _cuts(docs: DataFrame, id_col: str, batches: int) -> list:
    if batches < 2:
        return []
    shares = [i / batches for i in range(1, batches)]
    return docs.agg(F.percentile_approx(F.col(f"`{id_col}`"), shares).alias("cuts")).first()["cuts"] or []


def repeated_lines(docs: DataFrame, p: LineDedupParams = LineDedupParams(), id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``(doc_id, text_hash, dropped)``: positions (from 0) of the lines that go, for texts that lose any."""
    spark = docs.sparkSession
    tables = RoundTables(spark, "line-dedup")
    lines, _ = tables.write(keyed_lines(docs, p, id_col, text_col)
                            .withColumn("batch", _batch(_cuts(docs, id_col, p.batches))), by=["batch"])
    runs, firsts, pieces = LineRuns(spark, p.fan), None, []
    try:
        for b in range(p.batches):
            # once per document, then one row per key
            held = lines.filter(F.col("batch") == b).select(*KEY, "doc_id").distinct()
            fresh = runs.add(held.groupBy(*KEY).agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("last")))
            piece, _ = tables.write(fresh.select(*KEY, "last"))
            pieces.append(piece)
            firsts = piece if firsts is None else firsts.unionByName(piece)
            runs.compact()
        frequent, _ = tables.write(runs.totals().filter(F.col("docs") >= p.least_docs).join(firsts, KEY).select(*KEY, "last"))
    finally:
        runs.drop()
    gone = lines.join(frequent, KEY).filter("doc_id <> last")
    out, _ = tables.write(gone.groupBy("doc_id", "text_hash").agg(F.collect_set("pos").alias("dropped")))
    tables.drop(lines, frequent, *pieces)
    return out


def _rest(docs: DataFrame, p: LineDedupParams, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """(doc_id, lines, dropped, kept, ...) of every row."""
    got = _split(docs, id_col, text_col, *more).join(repeated_lines(docs, p, id_col, text_col), ["doc_id", "text_hash"], "left")
    every = F.sequence(F.lit(0), F.size("lines") - 1)
    stay = F.transform(F.array_except(every, F.col("dropped")), lambda i: F.get("lines", i))
    return got.withColumn("kept", F.array_join(F.when(F.col("dropped").isNull(), F.col("lines")).otherwise(stay), "\n"))


def drop_repeated(docs: DataFrame, p: LineDedupParams = LineDedupParams(), id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``docs`` with its own columns, the text without the lines that go."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col], F.lit(0).alias("__")).alias("row")
    got = _rest(docs, p, id_col, text_col, row)
    return got.select(*[F.col("kept").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns])


def digest(docs: DataFrame) -> DataFrame:
    """Columns of the op12 contract."""
    return _rest(docs, LineDedupParams(), "doc_id", "text").select(
        "doc_id", F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"), F.sha2("kept", 256).alias("kept_sha256"))
