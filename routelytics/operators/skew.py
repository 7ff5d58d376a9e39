"""Joins on raw keys of which a few may hold a large part of all rows.

``heavy_keys`` finds them in one pass with a frequent-items sketch; only they
are salted.  Nothing relies on a broadcast or on re-planning at run time, and
rows of all other keys move as in a plain join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with a larger share of the rows is heavy; there are 1 / SHARE of them at most.
SHARE = 0.01
#: Items the sketch tracks: its counts are off by less than SHARE / 8 of the rows.
TRACKED = 4096


def heavy_keys(df: DataFrame, key: str, share: float = SHARE) -> list:
    """Keys that hold about ``share`` of the rows of ``df`` or more, in one pass.

    At most 1.2 / ``share`` values reach the driver.  The sketch may call a key
    heavy that falls a little short of it, which costs nothing but salts.
    """
    k = int(1.2 / share) + 1
    got = df.select(F.col(key).alias("k")).where("k is not null").agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(k, {k}, {TRACKED})").alias("top")).first()
    return [x["item"] for x in got["top"] or [] if x["count"] >= share * got["n"] * 0.9]


def salted_join(left: DataFrame, right: DataFrame, key: str, how: str = "left", salts: int | None = None,
                share: float = SHARE) -> DataFrame:
    """``left.join(right, key, how)`` for a ``left`` with heavy keys; ``how`` is left, inner or left_semi.

    Rows of a heavy key are dealt over ``salts`` parts, and the rows of ``right`` with
    that key are sent to each part.  The default, eight parts per shuffle partition,
    evens out where the hashes of the parts fall.
    """
    if how not in ("left", "inner", "left_semi"):
        raise ValueError(f"cannot salt a {how} join")
    heavy = heavy_keys(left, key, share)
    if not heavy:
        return left.join(right, key, how)
    salts = salts or 8 * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    is_heavy = F.coalesce(F.col(key).isin(heavy), F.lit(False))
    dealt = F.pmod(F.monotonically_increasing_id(), F.lit(salts))
    a = left.withColumn("_salt", F.when(is_heavy, dealt).otherwise(F.lit(0)))
    copies = F.when(is_heavy, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    b = right.withColumn("_salt", F.explode(copies.cast("array<bigint>")))
    return a.join(b, [key, "_salt"], how).drop("_salt")
