import itertools
import re
import time

from pyspark.sql import functions as F

from routelytics.functions.tokens import tokens_space, tokens_whitespace
from routelytics.operators.words import top_words, word_count

JAVA_WS = "[ \t\n\x0b\f\r]+"


def java_split(s, pattern):
    """String.split(regex) of Java: leading empty kept, trailing empties dropped."""
    if s == "":
        return [""]
    parts = re.split(pattern, s)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def all_strings(alphabet, n):
    out = [""]
    for k in range(1, n + 1):
        out += ["".join(p) for p in itertools.product(alphabet, repeat=k)]
    return out


def test_tokenisers_match_java_split(spark):
    strings = all_strings(["a", "B", " ", "\t"], 5)
    df = spark.createDataFrame([(i, s) for i, s in enumerate(strings)], "i int, value string")
    got = {r.i: (r.ws, r.sp) for r in df.select("i", tokens_whitespace("value").alias("ws"),
                                                 tokens_space("value").alias("sp")).collect()}
    for i, s in enumerate(strings):
        assert got[i][0] == java_split(s.lower(), JAVA_WS), repr(s)
        assert got[i][1] == java_split(s.lower(), " "), repr(s)


def test_word_count_and_top(spark):
    lines = spark.createDataFrame([("The cat the",), ("", ), ("  ",), ("cat  dog",)], "value string")
    ws = {r.word: r["count"] for r in word_count(lines, "whitespace").collect()}
    assert ws == {"the": 2, "cat": 2, "": 1, "dog": 1}
    sp = {r.word: r["count"] for r in word_count(lines, "space").collect()}
    assert sp == {"the": 2, "cat": 2, "": 2, "dog": 1}
    top = top_words(lines, 2, mode="whitespace").collect()
    assert [(r["rank"], r.word, r["count"]) for r in top] == [(1, "cat", 2), (2, "the", 2)]


def test_long_runs_of_blanks_take_linear_time(spark):
    """A million blanks between two letters, and at the end of a line."""
    n = 1_000_000
    df = spark.createDataFrame([("a" + " " * n + "b",), ("c" + "\t " * (n // 2),)], "value string")
    df.select(tokens_whitespace("value")).collect()
    # the second line ends with a space, and each tab stands between two of them
    for f, sizes in ((tokens_whitespace, [2, 1]), (tokens_space, [n + 1, n // 2])):
        t = time.perf_counter()
        assert [r.n for r in df.select(F.size(f("value")).alias("n")).collect()] == sizes
        assert time.perf_counter() - t < 4  # both lines; quadratic code takes minutes
