"""Word count and top words.

Counting is a hash aggregation with map-side partials: a word that makes
up a third of the text costs one partial row per task, not a hot group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from routelytics.functions.tokens import TOKENIZERS
from routelytics.session import spread_small_scan


def words(lines: DataFrame, mode: str = "whitespace", value_col: str = "value") -> DataFrame:
    """One row per token: ``word``."""
    tok = TOKENIZERS[mode]
    lines = spread_small_scan(lines.select(value_col))
    return lines.select(F.explode(tok(F.col(value_col))).alias("word"))


def word_count(lines: DataFrame, mode: str = "whitespace", value_col: str = "value") -> DataFrame:
    """``(word, count)`` over all lines.  ``mode`` is ``whitespace`` (runs of \\s) or ``space``."""
    return words(lines, mode, value_col).groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def top_words(lines: DataFrame, n: int = 20, mode: str = "space", value_col: str = "value") -> DataFrame:
    """The ``n`` most frequent words ``(rank, word, count)``, ties by word.

    The top n is a TakeOrderedAndProject (per-task top n, then merged); the
    rank is numbered over those n rows only.
    """
    top = (word_count(lines, mode, value_col)
           .orderBy(F.desc("count"), F.asc("word")).limit(n))
    w = Window.orderBy(F.desc("count"), F.asc("word"))
    return top.select(F.row_number().over(w).alias("rank"), "word", "count")
