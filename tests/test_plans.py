"""Plan shapes that the scale design relies on."""

from routelytics.operators.aggregates import busiest_route, flights_per_airport
from routelytics.operators.airports import airport_count, airport_names
from routelytics.operators.edges import edges_from_sums, route_edges, route_sums
from routelytics.operators.words import top_words, word_count
from routelytics.sources.derived import derived_flights, derived_lines

from conftest import SF_TINY


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_counts_use_partial_aggregation(spark):
    fl = derived_flights(spark, SF_TINY)
    for df in (flights_per_airport(fl), route_edges(fl), word_count(derived_lines(spark, SF_TINY))):
        p = plan(df)
        assert "partial_count" in p or "partial_avg" in p, p


def test_top_k_is_take_ordered(spark):
    fl = derived_flights(spark, SF_TINY)
    p = plan(busiest_route(fl, 3))
    assert "TakeOrderedAndProject" in p and "Sort [" not in p.split("TakeOrderedAndProject")[1].split("Exchange")[0]
    assert "TakeOrderedAndProject" in plan(top_words(derived_lines(spark, SF_TINY), 20))


def test_route_edges_reads_only_needed_columns(spark):
    p = plan(route_edges(derived_flights(spark, SF_TINY)))
    lineitem_scan = [line for line in p.splitlines() if "lineitem.parquet" in line and "ReadSchema" in line][0]
    schema = lineitem_scan.split("ReadSchema: ")[1]
    assert "l_quantity" not in schema and "l_extendedprice" not in schema and "l_shipdate" not in schema


def test_airports_need_one_scan_of_the_flights(spark):
    fl = derived_flights(spark, SF_TINY)
    for df in (airport_names(fl), airport_count(fl)):
        assert plan(df).count("lineitem.parquet") == 1


def test_one_reduction_serves_names_edges_and_counts(spark):
    fl = derived_flights(spark, SF_TINY)
    sums = route_sums(fl)
    assert plan(sums).count("lineitem.parquet") == 1 and "partial_sum" in plan(sums)
    key = lambda r: (r.src, r.dst)
    assert sorted(edges_from_sums(sums).collect(), key=key) == sorted(route_edges(fl).collect(), key=key)
    assert sorted(airport_names(sums).collect()) == sorted(airport_names(fl).collect())
