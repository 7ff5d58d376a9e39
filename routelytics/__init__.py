"""Flight-route analytics as Spark DataFrame operators.

Every public function takes and returns DataFrames (or Columns); the
caller owns the SparkSession.  See README.md for the module map.
"""

from routelytics.sources.schema import FLIGHT_SCHEMA, OVERRIDE_SCHEMA
from routelytics.sources.flights import (
    parse_flights, rejected_flights, read_flights, flights_to_lines, write_table,
)
from routelytics.sources.text import read_lines, document_lines
from routelytics.sources.synthetic import grid_nodes, synthetic_flights
from routelytics.functions.durations import wrapped_duration, raw_duration, clock_minutes
from routelytics.operators.aggregates import (
    flights_per_airport, flights_per_route, busiest_route, route_durations,
)
from routelytics.operators.airports import airports, airport_count
from routelytics.operators.edges import (
    route_edges, raw_edges_transposed, incoming_adjacency, adjacency_get,
    edge_weight, direct_weights,
)
from routelytics.operators.overrides import (
    parse_override_commands, latest_overrides, apply_overrides,
)
from routelytics.operators.words import word_count, top_words
from routelytics.plans.sssp import shortest_paths, distance_to
from routelytics.plans.paths import reconstruct, route_queries

__all__ = [name for name in dir() if not name.startswith("_")]
