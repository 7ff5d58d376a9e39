import pytest
from pyspark.sql import functions as F

from routelytics.sources.derived import derived_flights
from routelytics.sources.flights import flights_to_lines, parse_flights, rejected_flights
from routelytics.sources.schema import FLIGHT_COLUMNS, FLIGHT_SCHEMA

from conftest import SF_TINY

GOOD = "1,3,AA,N1,12,100,SFO,200,LAX,600,605,5,700,,,60,337"


def lines(spark, *vals):
    return spark.createDataFrame([(v,) for v in vals], "value string")


def test_parse_one_line(spark):
    row = parse_flights(lines(spark, GOOD)).collect()[0]
    assert row.origin == "SFO" and row.dest == "LAX"
    assert row.flnum == 12 and row.org_id == 100 and row.dest_id == 200
    assert row.arr_time == 0.0 and row.arr_delay == 0.0      # blank 13/14 -> 0
    assert row.dep_time == 605.0 and row.distance == 337
    assert parse_flights(lines(spark, GOOD)).schema == FLIGHT_SCHEMA or \
        [f.name for f in parse_flights(lines(spark, GOOD)).schema] == FLIGHT_COLUMNS


def test_extra_fields_ignored(spark):
    assert parse_flights(lines(spark, GOOD + ",extra,x")).count() == 1


@pytest.mark.parametrize("bad", [
    "1,3,AA,N1,x12,100,SFO,200,LAX,600,605,5,700,,,60,337",     # bad int
    "1,3,AA,N1,12,100,SFO,200,LAX,,605,5,700,,,60,337",          # blank that is not 13/14
    "1,3,AA,N1, 12,100,SFO,200,LAX,600,605,5,700,,,60,337",     # blank before a whole number
    "1,3,AA,N1,12,100,SFO,200,LAX,600,605,5,700,  ,,60,337",     # blanks are not an empty field
    "1,3,AA,N1,12,100,SFO",                                      # short line
    "",
])
def test_rejects(spark, bad):
    df = lines(spark, GOOD, bad)
    assert parse_flights(df).count() == 1
    assert [r.value for r in rejected_flights(df).collect()] == [bad]
    strict = parse_flights(df, mode="strict")  # fails where the line is read, not while the query is built
    with pytest.raises(Exception, match="malformed flight line"):
        strict.collect()


def test_strict_mode_scans_once(spark):
    df = parse_flights(derived_lines(spark), mode="strict").select("origin")
    assert df._jdf.queryExecution().executedPlan().toString().count("lineitem.parquet") == 1


def derived_lines(spark):
    return flights_to_lines(derived_flights(spark, SF_TINY))


def test_roundtrip_fixture(spark):
    fl = derived_flights(spark, SF_TINY)
    back = parse_flights(flights_to_lines(fl), mode="strict")
    assert back.exceptAll(fl).count() == 0 and fl.exceptAll(back).count() == 0


def test_scan_prunes_columns(spark):
    plan = derived_flights(spark, SF_TINY).groupBy("origin").count()._jdf.queryExecution().executedPlan().toString()
    # only the keys needed for the two supplier joins are read from lineitem
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint>" in plan
