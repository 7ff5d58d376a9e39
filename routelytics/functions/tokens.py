"""Word tokenisers (P7 P8, Decision D6).

Java's ``String.split`` drops trailing empty tokens, keeps a leading one,
turns an empty line into one empty token and a separator-only line into no
token.  Spark's ``split`` keeps trailing empties, so trailing separators are
trimmed first (linear in the line, however long the run of blanks) and lines
made only of separators yield nothing.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

#: what ``\s`` matches
BLANKS = " \t\n\x0b\x0c\r"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _tokens(line, blanks: str, pattern: str) -> Column:
    v = _c(line)
    bare = F.rtrim(F.lower(v), F.lit(blanks))
    return F.when((bare != "") | (v == ""), F.split(bare, pattern, -1)).otherwise(F.array().cast("array<string>"))


def tokens_whitespace(line="value") -> Column:
    """Lower-cased tokens split on runs of whitespace: array<string>."""
    return _tokens(line, BLANKS, r"\s+")


def tokens_space(line="value") -> Column:
    """Lower-cased tokens split on each single space: array<string>."""
    return _tokens(line, " ", " ")


TOKENIZERS = {"whitespace": tokens_whitespace, "space": tokens_space}
