"""Inputs derived from the shared test tables.

The original program reads an on-time flight CSV and a text file that are
not available, so its inputs are derived from the TPC-H-like tables:

* a supplier is an airport; a line item is a flight from its supplier to
  supplier ``l_partkey mod n`` (n = number of suppliers);
* ``events`` of type ``purchase`` are edge-weight overrides and events of
  type ``view`` are route queries;
* document texts split on newline are the text lines of the word count.

All of it is plain DataFrame code over the whole tables; the supplier count
is a scalar subquery, not a driver round trip.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from routelytics.sources.schema import FLIGHT_COLUMNS
from routelytics.sources.text import document_lines


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _supplier_count(spark: SparkSession, sf_dir: str) -> Column:
    return table(spark, sf_dir, "supplier").select(F.count(F.lit(1))).scalar()


def derived_flights(spark: SparkSession, sf_dir: str, shipped_before: str | None = None,
                    keep_shipdate: bool = False) -> DataFrame:
    """The ``flights`` fixture: one typed flight per line item (17 columns).

    Clock fields are HHMM values made from integer mixing of the line-item
    keys; every 50th flight is diverted (arrival time and delay 0).
    """
    li = table(spark, sf_dir, "lineitem")
    if shipped_before is not None:
        li = li.where(F.col("l_shipdate") < F.lit(shipped_before).cast("timestamp"))
    sup = table(spark, sf_dir, "supplier")
    n = _supplier_count(spark, sf_dir)
    ok, pk, sk, ln = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    x = li.select(
        "*",
        ((ok * 7 + ln * 131) % 24).alias("_dh"),
        ((ok * 13 + pk) % 60).alias("_dm"),
        ((ok * 11 + sk * 3) % 24).alias("_ah"),
        ((pk * 17 + ln) % 60).alias("_am"),
        ((ok + ln) % 50 == 0).alias("_diverted"),
        (pk % n).alias("_dest_key"),
    )
    so = sup.select(F.col("s_suppkey").alias("org_id"), F.col("s_name").alias("origin"))
    sd = sup.select(F.col("s_suppkey").alias("dest_id"), F.col("s_name").alias("dest"))
    j = x.join(so, x.l_suppkey == so.org_id).join(sd, x._dest_key == sd.dest_id)
    dh, dm, ah, am, diverted = (F.col(c) for c in ("_dh", "_dm", "_ah", "_am", "_diverted"))
    cols = [
        F.dayofmonth("l_shipdate").cast("string").alias("day_of_month"),
        (F.weekday("l_shipdate") + 1).cast("string").alias("day_of_week"),
        F.concat("l_returnflag", "l_linestatus").alias("carrier"),
        F.concat(F.lit("N"), F.col("l_partkey").cast("string")).alias("tailnum"),
        F.col("l_linenumber").cast("int").alias("flnum"),
        F.col("org_id"), F.col("origin"), F.col("dest_id"), F.col("dest"),
        (dh * 100).cast("double").alias("sched_dep"),
        (dh * 100 + dm).cast("double").alias("dep_time"),
        dm.cast("double").alias("dep_delay"),
        (ah * 100).cast("double").alias("sched_arr"),
        F.when(diverted, F.lit(0.0)).otherwise((ah * 100 + am).cast("double")).alias("arr_time"),
        F.when(diverted, F.lit(0.0)).otherwise(am.cast("double")).alias("arr_delay"),
        ((ah - dh + 24) % 24 * 60).cast("double").alias("sched_elapsed"),
        F.abs(F.col("org_id") - F.col("dest_id")).cast("int").alias("distance"),
    ]
    if keep_shipdate:
        cols.append(F.col("l_shipdate"))
    return j.select(*cols)


def derived_override_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edge overrides ``(seq, src, dst, weight)`` from ``purchase`` events."""
    ev = table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    n = _supplier_count(spark, sf_dir)
    return ev.select(
        F.col("event_id").alias("seq"),
        (F.col("user_id") % n).alias("src"),
        (F.col("event_id") % n).alias("dst"),
        (F.floor("value") + 1).cast("double").alias("weight"),
    )


def derived_override_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same overrides as command text ``time A B w`` with airport names."""
    ov = derived_override_events(spark, sf_dir)
    sup = table(spark, sf_dir, "supplier")
    a = sup.select(F.col("s_suppkey").alias("src"), F.col("s_name").alias("a"))
    b = sup.select(F.col("s_suppkey").alias("dst"), F.col("s_name").alias("b"))
    return ov.join(a, "src").join(b, "dst").select(
        "seq",
        F.concat_ws(" ", F.lit("time"), "a", "b",
                    F.col("weight").cast("long").cast("string")).alias("value"))


#: When a route query is asked: half way through the overrides or after them.
INFO_SEQ_SQL = "case when (source + destination) % 2 = 0 then (select max(event_id) // 2 from events) else (select max(event_id) + 1 from events) end"


def derived_info_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The route queries as numbered command text ``info A B`` with airport names."""
    q = derived_route_queries(spark, sf_dir)
    top = table(spark, sf_dir, "events").agg(F.max("event_id").alias("top")).scalar()
    sup = table(spark, sf_dir, "supplier")
    a = sup.select(F.col("s_suppkey").alias("source"), F.col("s_name").alias("a"))
    b = sup.select(F.col("s_suppkey").alias("destination"), F.col("s_name").alias("b"))
    half = (F.col("source") + F.col("destination")) % 2 == 0
    return q.withColumn("seq", F.when(half, F.floor(top / 2)).otherwise(top + 1).cast("long")).join(a, "source").join(
        b, "destination").select("seq", F.concat_ws(" ", F.lit("info"), "a", "b").alias("value"))


def derived_route_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Route queries ``(source, destination)`` from ``view`` events, deduplicated."""
    ev = table(spark, sf_dir, "events").where(F.col("event_type") == "view")
    n = _supplier_count(spark, sf_dir)
    return ev.select(
        (F.col("user_id") % n).alias("source"),
        (F.col("event_id") % n).alias("destination"),
    ).distinct()


def derived_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines (``value``) of all documents."""
    return document_lines(table(spark, sf_dir, "documents"))


__all__ = ["derived_flights", "derived_override_events", "derived_override_commands",
           "derived_route_queries", "derived_lines", "table", "FLIGHT_COLUMNS"]
