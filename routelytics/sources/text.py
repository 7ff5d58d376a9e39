"""Text-line sources."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line of the text file(s) at ``path``: ``value string``."""
    return spark.read.text(path)


def document_lines(documents: DataFrame, text_col: str = "text") -> DataFrame:
    """Split each document on newline into ``value`` rows (whole texts).

    The split keeps empty lines, including the one after a trailing
    newline, so every character of every text lands in exactly one line.
    """
    return documents.select(F.explode(F.split(F.col(text_col), "\n", -1)).alias("value"))
