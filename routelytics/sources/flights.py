"""Flight CSV parsing and writing.

A flight line is 17 comma-separated fields, no quoting and no header.
Fields past the 17th are ignored.  Parsing is all built-in expressions
(split + try_cast), so it stays in whole-stage codegen and Catalyst can
prune the columns a later operator does not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from routelytics.sources.schema import BLANK_AS_ZERO, FLIGHT_SCHEMA


#: whole numbers as the original reads them: a sign and digits, no blanks around
_WHOLE = r"^[+-]?[0-9]+$"


def _typed(parts: Column, i: int, field: T.StructField) -> Column:
    raw = F.get(parts, i)
    if isinstance(field.dataType, T.StringType):
        return raw
    # casts ignore blanks around a number: right for doubles, not for whole numbers
    typed = raw.try_cast(field.dataType)
    if isinstance(field.dataType, (T.IntegerType, T.LongType)):
        typed = F.when(raw.rlike(_WHOLE), typed)
    if field.name in BLANK_AS_ZERO:
        # only an empty field is zero; blanks are malformed
        typed = F.when(raw == "", F.lit(0).cast(field.dataType)).otherwise(typed)
    return typed


def _with_parse(lines: DataFrame, value_col: str) -> DataFrame:
    # The split array comes out of a Generate (explode of a one-element
    # array): the validity filter reads the generated column and Catalyst
    # cannot push it below the Generate, so each line is split exactly once
    # instead of once per field inside pushed-down predicates.
    split = lines.select(F.col(value_col).alias("_line"),
                         F.explode(F.array(F.split(F.col(value_col), ",", -1))).alias("_parts"))
    typed = split.select(*[_typed(F.col("_parts"), i, f).alias(f.name)
                           for i, f in enumerate(FLIGHT_SCHEMA.fields)], "_line")
    ok = F.lit(True)
    for f in FLIGHT_SCHEMA.fields:
        ok = ok & F.col(f.name).isNotNull()
    return typed.select("*", ok.alias("_ok"))


def parse_flights(lines: DataFrame, mode: str = "lenient", value_col: str = "value") -> DataFrame:
    """Typed flights from text lines.

    ``mode="lenient"`` drops malformed lines (see :func:`rejected_flights`);
    ``mode="strict"`` fails on a malformed line, like the original program,
    when and where that line is read: there is no extra pass.
    """
    parsed = _with_parse(lines, value_col)
    cols = [F.col(f.name).cast(f.dataType) for f in FLIGHT_SCHEMA.fields]
    if mode == "strict":
        bad = F.raise_error(F.concat(F.lit("malformed flight line: "), F.col("_line")))
        # the check sits in the row's own filter, so column pruning cannot drop it
        return parsed.where(F.when(F.col("_ok"), F.lit(True)).otherwise(bad.cast("boolean"))).select(*cols)
    if mode != "lenient":
        raise ValueError(f"unknown mode {mode!r}")
    return parsed.where(F.col("_ok")).select(*cols)


def rejected_flights(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Lines that do not parse into the 17 typed fields: ``value string``."""
    return _with_parse(lines, value_col).where(~F.col("_ok")).select(F.col("_line").alias("value"))


def read_flights(spark: SparkSession, path: str, mode: str = "lenient") -> DataFrame:
    """Text file(s) at ``path`` → typed flights."""
    return parse_flights(spark.read.text(path), mode=mode)


def _number_text(c: Column) -> Column:
    # whole numbers print without ".0", as they appear in the on-time files
    return F.when(c == F.floor(c), c.cast("long").cast("string")).otherwise(c.cast("string"))


def flights_to_lines(flights: DataFrame, blank_zero_arrivals: bool = True) -> DataFrame:
    """Render typed flights as CSV lines (``value``), the inverse of parsing.

    With ``blank_zero_arrivals`` an arrival time/delay of 0 is written as a
    blank field, the way diverted flights appear in the source files.
    """
    parts = []
    for f in FLIGHT_SCHEMA.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DoubleType):
            text = _number_text(c)
            if blank_zero_arrivals and f.name in BLANK_AS_ZERO:
                text = F.when(c == 0, F.lit("")).otherwise(text)
        else:
            text = c.cast("string")
        parts.append(text)
    return flights.select(F.concat_ws(",", *parts).alias("value"))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Full-table sink (S6): write ``df`` instead of collecting it."""
    df.write.format(fmt).mode(mode).save(path)
