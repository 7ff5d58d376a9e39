"""User edge-weight overrides (P17 G7 G8 A9 U1 U2 F5, Decisions D7 D7b).

An override ``time A B w`` sets the weight of the route A -> B to w, or adds
that route.  A later override of the same route replaces an earlier one
(largest ``seq`` wins); any override beats the averaged base edge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routelytics.operators.airports import names_to_ids
from routelytics.sources.schema import OVERRIDE_SCHEMA


def override_rows(spark: SparkSession, rows: list[tuple[int, int, float]]) -> DataFrame:
    """Overrides from driver values ``(src, dst, weight)`` in their order."""
    return spark.createDataFrame([(i, int(a), int(b), float(w)) for i, (a, b, w) in enumerate(rows)], OVERRIDE_SCHEMA)


def parse_override_commands(commands: DataFrame, airport_dim: DataFrame,
                            value_col: str = "value", seq_col: str = "seq") -> DataFrame:
    """``time A B w`` lines → ``(seq, src, dst, weight)``.

    Names map to airport ids through ``airport_dim``.  Lines that are not a
    ``time`` command, name an unknown airport or carry a negative or
    non-integer weight are left out (see :func:`rejected_override_commands`).
    ``seq_col`` carries the order of the commands: rows of a table have none of their own.
    """
    parsed = _parse(commands, airport_dim, value_col, seq_col)
    return parsed.where("_ok").select("seq", "src", "dst", "weight")


def rejected_override_commands(commands: DataFrame, airport_dim: DataFrame,
                               value_col: str = "value", seq_col: str = "seq") -> DataFrame:
    """Lines left out by :func:`parse_override_commands`: ``(seq, value)``."""
    return _parse(commands, airport_dim, value_col, seq_col).where(~F.col("_ok")).select(
        "seq", F.col("_line").alias(value_col))


def _parse(commands, airport_dim, value_col, seq_col):
    seq = F.col(seq_col).cast("long")
    parts = F.split(F.col(value_col), " ", -1)
    c = commands.select(
        seq.alias("seq"), F.col(value_col).alias("_line"),
        F.get(parts, 0).alias("_cmd"), F.get(parts, 1).alias("_a"), F.get(parts, 2).alias("_b"),
        F.get(parts, 3).try_cast("int").alias("_w"),
    )
    c = names_to_ids(c, "_a", "src", airport_dim)
    c = names_to_ids(c, "_b", "dst", airport_dim)
    ok = ((F.col("_cmd") == "time") & F.col("src").isNotNull() & F.col("dst").isNotNull()
          & F.col("_w").isNotNull() & (F.col("_w") >= 0))
    return c.select("seq", "_line", "src", "dst", F.col("_w").cast("double").alias("weight"),
                    F.coalesce(ok, F.lit(False)).alias("_ok"))


def latest_overrides(overrides: DataFrame) -> DataFrame:
    """One override per route, the one with the largest ``seq``: ``(src, dst, weight)``."""
    return overrides.groupBy("src", "dst").agg(F.max_by("weight", "seq").alias("weight"))


def apply_overrides(edges: DataFrame, overrides: DataFrame) -> DataFrame:
    """Edges with overrides applied: ``(src, dst, weight, overridden)``.

    Base edges with an override are replaced (anti join), overrides of
    missing routes add edges.  ``overrides`` may hold several rows per route.
    """
    ov = latest_overrides(overrides)
    kept = (edges.join(ov.select("src", "dst"), ["src", "dst"], "left_anti")
            .select("src", "dst", F.col("weight").cast("double"), F.lit(False).alias("overridden")))
    return kept.unionByName(ov.select("src", "dst", "weight", F.lit(True).alias("overridden")))
