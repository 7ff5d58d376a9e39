"""Declared schemas (S3).  Positional order of FLIGHT_SCHEMA is the CSV order."""

from pyspark.sql import types as T

FLIGHT_SCHEMA = T.StructType([
    T.StructField("day_of_month", T.StringType(), False),
    T.StructField("day_of_week", T.StringType(), False),
    T.StructField("carrier", T.StringType(), False),
    T.StructField("tailnum", T.StringType(), False),
    T.StructField("flnum", T.IntegerType(), False),
    T.StructField("org_id", T.LongType(), False),
    T.StructField("origin", T.StringType(), False),
    T.StructField("dest_id", T.LongType(), False),
    T.StructField("dest", T.StringType(), False),
    T.StructField("sched_dep", T.DoubleType(), False),
    T.StructField("dep_time", T.DoubleType(), False),
    T.StructField("dep_delay", T.DoubleType(), False),
    T.StructField("sched_arr", T.DoubleType(), False),
    T.StructField("arr_time", T.DoubleType(), False),
    T.StructField("arr_delay", T.DoubleType(), False),
    T.StructField("sched_elapsed", T.DoubleType(), False),
    T.StructField("distance", T.IntegerType(), False),
])

FLIGHT_COLUMNS = [f.name for f in FLIGHT_SCHEMA.fields]

# Fields 13 and 14 (arrival time and delay) may be blank; blank reads as 0.
BLANK_AS_ZERO = ("arr_time", "arr_delay")

OVERRIDE_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType(), False),
    T.StructField("src", T.LongType(), False),
    T.StructField("dst", T.LongType(), False),
    T.StructField("weight", T.DoubleType(), False),
])
