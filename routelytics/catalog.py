"""Registered queries and their DuckDB oracles.

Every query reads whole test tables (or data Spark derives from them);
nothing is subset, capped or sampled.  Each query has an ANSI/DuckDB SQL
twin over the same tables with the same column names; doubles are rounded
to 6 places on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routelytics.functions import mixing as M
from routelytics.operators import aggregates as A
from routelytics.operators import airports as AP
from routelytics.operators import edges as E
from routelytics.operators import overrides as O
from routelytics.operators import words as W
from routelytics.plans.paths import reconstruct, route_queries
from routelytics.plans.repair import repair_paths
from routelytics.plans.sssp import SCALE, distance_to, shortest_paths
from routelytics.sources import derived as D
from routelytics.sources.flights import flights_to_lines, parse_flights, read_flights, rejected_flights, write_table
from routelytics.sources.schema import FLIGHT_COLUMNS
from routelytics.streaming.commands import command_stream
from routelytics.streaming.edges import current_edges, edge_log, edge_stream
from routelytics.session import checkpoint_dir, cut_lineage
from routelytics.sources.synthetic import node_name, synthetic_flights

# Parameters of the registered queries (fixed values shared with the oracles).
DIRECT_SOURCE = 0          # J2: source node of the direct-weight lookup
TOP_WORDS = 20             # S7: the original prints the first 20 words
SYNTH_PCT = 25             # S5: connections per airport in percent of n
SYNTH_SEED = 7             # S5: seed of the integer mixing
BLOCK = E.DEFAULT_BLOCK    # M3: source ids per adjacency block
FIRST_LOAD = "1992-01-10"  # G10: flights shipped before it are the first load
STREAM_FILES = 5           # A3-A5: files that the stream of flights takes one by one
LOOKUP_NODE = 1            # F2: node whose distance is looked up
OVERRIDE_ROWS = [(0, 1, 5.0), (2, 2, 0.0), (0, 1, 7.0)]  # S4: overrides from driver values, in order


def _r6(c):
    return F.round(c, 6)


# ---------------------------------------------------------------- Spark side

def _flights(spark, sf):
    return D.derived_flights(spark, sf)


def q_parse_flights(spark, sf):
    return parse_flights(flights_to_lines(_flights(spark, sf)), mode="lenient")


def q_parse_flights_strict(spark, sf):
    """Strict parsing: a malformed line would fail the job; all lines are good."""
    return parse_flights(flights_to_lines(_flights(spark, sf)), mode="strict")


def q_flights_per_airport(spark, sf):
    return A.flights_per_airport(_flights(spark, sf))


def q_flights_per_route(spark, sf):
    return A.flights_per_route(_flights(spark, sf))


def q_busiest_route(spark, sf):
    return A.busiest_route(_flights(spark, sf))


def q_route_durations(spark, sf):
    r = A.route_durations(_flights(spark, sf))
    return r.select("origin", "dest", "n_flights", _r6(F.col("total_duration")).alias("total_duration"),
                    _r6(F.col("avg_duration")).alias("avg_duration"))


def q_route_durations_raw(spark, sf):
    r = E.raw_edges_transposed(_flights(spark, sf))
    return r.select("dst", "src", _r6(F.col("weight")).alias("weight"))


def q_airports(spark, sf):
    return AP.airports(_flights(spark, sf))


def q_durable_airport_ids(spark, sf):
    """Airports numbered in two loads, the flights of the first days and then all: old ids stay."""
    ids = AP.IdTable(spark, _new_folder(spark, "routelytics-ids"))
    ids.add(0, AP.airport_names(D.derived_flights(spark, sf, shipped_before=FIRST_LOAD)))
    return ids.add(1, AP.airport_names(_flights(spark, sf)))


def q_streamed_route_edges(spark, sf):
    """The route graph kept by a stream that takes the flights file by file."""
    root = _new_folder(spark, "routelytics-edge-stream")
    fl = _flights(spark, sf).select("org_id", "dest_id", "dep_time", "arr_time")
    fl.repartition(STREAM_FILES).write.parquet(f"{root}/flights")
    log = edge_log(spark, f"{root}/log", every=2)
    q = edge_stream(spark, f"{root}/flights", fl.schema, log, f"{root}/stream", files_per_batch=1)
    q.awaitTermination()
    e = current_edges(log, q.lastProgress["batchId"])
    return e.select("src", "dst", _r6(F.col("weight")).alias("weight"), "n_flights")


def q_airport_count(spark, sf):
    return AP.airport_count(_flights(spark, sf))


def q_route_edges(spark, sf):
    e = E.route_edges(_flights(spark, sf))
    return e.select("src", "dst", _r6(F.col("weight")).alias("weight"), "n_flights")


def q_incoming_adjacency(spark, sf):
    adj = E.incoming_adjacency(E.route_edges(_flights(spark, sf)), BLOCK)
    return adj.select("dst", "block", F.explode("incoming").alias("src", "weight")).select(
        "dst", "block", "src", _r6(F.col("weight")).alias("weight"))


def q_adjacency_lookup(spark, sf):
    edges = E.edges_from_sums(_sums(spark, sf))
    adj = E.incoming_adjacency(edges, BLOCK)
    pairs = edges.select("src", "dst", F.col("weight").alias("forward"))
    # reverse route of each edge: dst -> src, read from the adjacency rows
    got = E.adjacency_get(adj, pairs, BLOCK, src_col="dst", dst_col="src")
    return got.select("src", "dst", _r6(F.col("forward")).alias("weight"),
                      _r6(F.col("weight")).alias("reverse_weight"))


def q_direct_weights(spark, sf):
    fl = cut_lineage(_flights(spark, sf).select("org_id", "dest_id", "dep_time", "arr_time"))  # one scan for both uses
    d = E.direct_weights(fl, E.route_edges(fl), DIRECT_SOURCE)
    return d.select("dst", _r6(F.col("weight")).alias("weight"))


def _sums(spark, sf):
    """Flights reduced once and stored: routes, names and the hub come from it."""
    return cut_lineage(E.route_sums(_flights(spark, sf)))


def busiest_airport(sums: DataFrame) -> DataFrame:
    """One row ``(source)``: the origin with most departing flights, ties by smallest id."""
    return (sums.groupBy("org_id").agg(F.sum("n").alias("_n")).orderBy(F.desc("_n"), F.asc("org_id")).limit(1)
            .select(F.col("org_id").alias("source")))


def _hub_labels(spark, sf, with_overrides=False):
    """Labels of every airport from the busiest one (the original solves one source at a time)."""
    sums = _sums(spark, sf)
    edges = E.edges_from_sums(sums)
    if with_overrides:
        edges = O.apply_overrides(edges, D.derived_override_events(spark, sf))
    return shortest_paths(edges, busiest_airport(sums)), sums


def q_sssp_distances(spark, sf):
    st, _ = _hub_labels(spark, sf)
    return st.select("source", "node", _r6(F.col("dist")).alias("dist"), "hops")


def q_sssp_predecessors(spark, sf):
    st, _ = _hub_labels(spark, sf)
    return st.select("source", "node", "pred")


def q_distance_lookup(spark, sf):
    """One distance: the search ends when the wanted node is settled."""
    sums = _sums(spark, sf)
    hub = cut_lineage(busiest_airport(sums))
    st = shortest_paths(E.edges_from_sums(sums), hub, targets=hub.withColumn("node", F.lit(LOOKUP_NODE)))
    return distance_to(st, LOOKUP_NODE).select("source", _r6(F.col("dist")).alias("dist"))


def q_route_queries(spark, sf):
    sums = _sums(spark, sf)
    r = route_queries(E.edges_from_sums(sums), D.derived_route_queries(spark, sf), AP.airport_names(sums))
    return r.select("source", "destination", "origin", "dest", _r6(F.col("weight")).alias("weight"),
                    "hops", "path_text")


def q_hub_routes(spark, sf):
    """Shortest route from the busiest airport to every airport (the `info A B` query, all B)."""
    st, sums = _hub_labels(spark, sf)
    names = AP.airport_names(sums)
    pairs = names.select(busiest_airport(sums).scalar().alias("source"), F.col("airport_id").alias("destination"))
    r = reconstruct(st, pairs, names)
    return r.select("source", "destination", "origin", "dest", _r6(F.col("weight")).alias("weight"),
                    "hops", "path_text")


def _new_folder(spark, name):
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def q_route_shell(spark, sf):
    """The interactive shell end to end: numbered ``time`` and ``info`` lines
    (from purchase and view events), dealt over several files in no order,
    run through the Structured Streaming command job.  Half of the queries
    are asked half way through the overrides, half at their end."""
    root = _new_folder(spark, "routelytics-shell")
    cmds = D.derived_override_commands(spark, sf).select("seq", "value").unionByName(D.derived_info_commands(spark, sf))
    lines = cmds.select(F.concat_ws(" ", F.col("seq").cast("string"), "value").alias("value"))
    lines.repartition(3).write.text(f"{root}/in")
    sums = _sums(spark, sf)
    q = command_stream(spark, f"{root}/in", E.edges_from_sums(sums), AP.airport_names(sums),
                       f"{root}/out", f"{root}/state", f"{root}/stream")
    q.awaitTermination()
    out = spark.read.parquet(f"{root}/out/answers")
    return out.select("seq", "origin", "dest", _r6(F.col("weight")).alias("weight"), "hops", "path_text")


def q_flights_from_text(spark, sf):
    """Flight lines written as text files, scanned and parsed, stored as a table and read back."""
    root = _new_folder(spark, "routelytics-flights")
    flights_to_lines(_flights(spark, sf)).write.text(f"{root}/lines")
    write_table(read_flights(spark, f"{root}/lines"), f"{root}/table")
    return spark.read.parquet(f"{root}/table")


def q_rejected_flights(spark, sf):
    """Good flight lines mixed with lines that are no flights: the latter."""
    ev = D.table(spark, sf, "events")
    bad = ev.select(F.concat_ws(",", F.col("event_id").cast("string"), "event_type").alias("value"))
    return rejected_flights(flights_to_lines(_flights(spark, sf)).unionByName(bad))


def q_rejected_override_commands(spark, sf):
    """Override commands mixed with other commands: the latter."""
    cmds = D.derived_override_commands(spark, sf).select("seq", "value").unionByName(D.derived_info_commands(spark, sf))
    return O.rejected_override_commands(cmds, AP.airport_names(_flights(spark, sf)))


def q_ambiguous_airports(spark, sf):
    """Origins named by zone, so ids have two names and zones several ids."""
    fl = _flights(spark, sf).withColumn("origin", F.concat(F.lit("Zone"), (F.col("org_id") % 10).cast("string")))
    return AP.ambiguous_airports(fl)


def q_edge_lookup(spark, sf):
    edges = E.edges_from_sums(_sums(spark, sf))
    got = E.edge_weight(edges, D.derived_route_queries(spark, sf), "source", "destination")
    return got.select("source", "destination", _r6(F.col("weight")).alias("weight"))


def q_transposed_edges(spark, sf):
    e = E.transpose(E.route_edges(_flights(spark, sf)))
    return e.select("src", "dst", _r6(F.col("weight")).alias("weight"), "n_flights")


def q_edges_with_override_rows(spark, sf):
    """The route graph with overrides given as driver values."""
    e = O.apply_overrides(E.route_edges(_flights(spark, sf)), O.override_rows(spark, OVERRIDE_ROWS))
    return e.select("src", "dst", _r6(F.col("weight")).alias("weight"), "overridden")


def q_latest_overrides(spark, sf):
    return O.latest_overrides(D.derived_override_events(spark, sf))


def q_override_commands(spark, sf):
    names = AP.airport_names(_flights(spark, sf))
    return O.parse_override_commands(D.derived_override_commands(spark, sf), names)


def q_edges_with_overrides(spark, sf):
    e = O.apply_overrides(E.route_edges(_flights(spark, sf)), D.derived_override_events(spark, sf))
    return e.select("src", "dst", _r6(F.col("weight")).alias("weight"), "overridden")


def q_sssp_with_overrides(spark, sf):
    st, _ = _hub_labels(spark, sf, with_overrides=True)
    return st.select("source", "node", _r6(F.col("dist")).alias("dist"), "hops", "pred")


def q_sssp_repaired(spark, sf):
    """Labels of the graph without overrides, repaired after them: as a full solve with them."""
    st, sums = _hub_labels(spark, sf)
    overrides = D.derived_override_events(spark, sf)
    st = repair_paths(st, O.apply_overrides(E.edges_from_sums(sums), overrides), overrides.select("src", "dst"))
    return st.select("source", "node", _r6(F.col("dist")).alias("dist"), "hops", "pred")


def q_word_count_ws(spark, sf):
    return W.word_count(D.derived_lines(spark, sf), mode="whitespace")


def q_word_count_space(spark, sf):
    return W.word_count(D.derived_lines(spark, sf), mode="space")


def q_top_words(spark, sf):
    t = W.top_words(D.derived_lines(spark, sf), TOP_WORDS, mode="space")
    return t.select(F.col("rank").cast("long").alias("rank"), "word", "count")


def q_top_words_ws(spark, sf):
    t = W.top_words(D.derived_lines(spark, sf), TOP_WORDS, mode="whitespace")
    return t.select(F.col("rank").cast("long").alias("rank"), "word", "count")


def _supplier_nodes(spark, sf):
    """Airports of the generated graph: suppliers, placed by their balance and nation."""
    sup = D.table(spark, sf, "supplier")
    return sup.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                      (F.floor(F.col("s_acctbal")) + 1000).alias("x"), (F.col("s_nationkey") * 100).alias("y"))


def q_synthetic_nodes(spark, sf):
    """Labels and places of the generator's airports, one per supplier."""
    ranked = AP.dense_index(_supplier_nodes(spark, sf), "id", "i")
    return ranked.select(F.col("i").alias("node"), node_name("i").alias("label"), "x", "y")


def q_synthetic_flights(spark, sf):
    return synthetic_flights(_supplier_nodes(spark, sf), SYNTH_PCT, SYNTH_SEED)


def q_synthetic_route_edges(spark, sf):
    e = E.route_edges(synthetic_flights(_supplier_nodes(spark, sf), SYNTH_PCT, SYNTH_SEED))
    return e.select("src", "dst", _r6(F.col("weight")).alias("weight"), "n_flights")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "parse_flights": q_parse_flights,
    "parse_flights_strict": q_parse_flights_strict,
    "flights_per_airport": q_flights_per_airport,
    "flights_per_route": q_flights_per_route,
    "busiest_route": q_busiest_route,
    "route_durations": q_route_durations,
    "route_durations_raw": q_route_durations_raw,
    "airports": q_airports,
    "durable_airport_ids": q_durable_airport_ids,
    "streamed_route_edges": q_streamed_route_edges,
    "airport_count": q_airport_count,
    "route_edges": q_route_edges,
    "incoming_adjacency": q_incoming_adjacency,
    "adjacency_lookup": q_adjacency_lookup,
    "direct_weights": q_direct_weights,
    "sssp_distances": q_sssp_distances,
    "sssp_predecessors": q_sssp_predecessors,
    "route_queries": q_route_queries,
    "hub_routes": q_hub_routes,
    "route_shell": q_route_shell,
    "flights_from_text": q_flights_from_text,
    "rejected_flights": q_rejected_flights,
    "rejected_override_commands": q_rejected_override_commands,
    "ambiguous_airports": q_ambiguous_airports,
    "distance_lookup": q_distance_lookup,
    "edge_lookup": q_edge_lookup,
    "transposed_edges": q_transposed_edges,
    "edges_with_override_rows": q_edges_with_override_rows,
    "latest_overrides": q_latest_overrides,
    "override_commands": q_override_commands,
    "edges_with_overrides": q_edges_with_overrides,
    "sssp_with_overrides": q_sssp_with_overrides,
    "sssp_repaired": q_sssp_repaired,
    "word_count_ws": q_word_count_ws,
    "word_count_space": q_word_count_space,
    "top_words": q_top_words,
    "top_words_ws": q_top_words_ws,
    "synthetic_nodes": q_synthetic_nodes,
    "synthetic_flights": q_synthetic_flights,
    "synthetic_route_edges": q_synthetic_route_edges,
}


# ---------------------------------------------------------------- SQL side

_N = "(select count(*) from supplier)"

_FLIGHTS = f"""
x as (select l.*, (l_orderkey*7 + l_linenumber*131) % 24 dh, (l_orderkey*13 + l_partkey) % 60 dm,
             (l_orderkey*11 + l_suppkey*3) % 24 ah, (l_partkey*17 + l_linenumber) % 60 am,
             (l_orderkey + l_linenumber) % 50 = 0 diverted from lineitem l),
flights as (
select cast(day(l_shipdate) as varchar) day_of_month,
       cast(isodow(l_shipdate) as varchar) day_of_week,
       l_returnflag || l_linestatus carrier, 'N' || l_partkey tailnum, l_linenumber flnum,
       so.s_suppkey org_id, so.s_name origin, sd.s_suppkey dest_id, sd.s_name dest,
       (dh*100)::double sched_dep, (dh*100 + dm)::double dep_time, dm::double dep_delay,
       (ah*100)::double sched_arr,
       case when diverted then 0.0 else (ah*100 + am)::double end arr_time,
       case when diverted then 0.0 else am::double end arr_delay,
       ((ah - dh + 24) % 24 * 60)::double sched_elapsed,
       cast(abs(so.s_suppkey - sd.s_suppkey) as int) distance
from x
join supplier so on so.s_suppkey = l_suppkey
join supplier sd on sd.s_suppkey = l_partkey % {_N}),
fw as (select *, case when arr_time - dep_time < 0 then arr_time - dep_time + 2400
                      else arr_time - dep_time end wd from flights),
edges as (select org_id src, dest_id dst, avg(wd) weight, count(*) n_flights from fw group by 1, 2),
names as (select airport_id, min(name) name from (
            select org_id airport_id, origin name from flights
            union all select dest_id, dest from flights) t group by 1),
ov as (select event_id seq, user_id % {_N} src, event_id % {_N} dst, (floor(value) + 1)::double weight
       from events where event_type = 'purchase'),
lo as (select src, dst, arg_max(weight, seq) weight from ov group by 1, 2),
oedges as (select src, dst, weight from edges e
           where not exists (select 1 from lo where lo.src = e.src and lo.dst = e.dst)
           union all select src, dst, weight from lo),
qs as (select distinct user_id % {_N} source, event_id % {_N} destination
       from events where event_type = 'view')"""


def _with(body: str, extra: str = "", recursive: bool = False) -> str:
    head = "with recursive" if recursive else "with"
    return f"{head} {_FLIGHTS}{(',' + extra) if extra else ''}\n{body}"


def _labels_sql(edge_table: str, queries: str = "qs", r: str = "r", st: str = "st") -> str:
    # whole-number distances, as in the Spark loop
    step = f"{{'dist': {r}.l.dist + e.w, 'hops': {r}.l.hops + 1, 'pred': e.src}}"
    return f"""
{r}_e as (select src, dst, cast(round(weight * {SCALE}) as bigint) w from {edge_table}),
{r}(source, node, l) using key (source, node) as (
  select source, source, {{'dist': 0::bigint, 'hops': 0::bigint, 'pred': -1::bigint}}
  from (select distinct source from {queries}) s
  union
  select {r}.source, e.dst, min({step})
  from {r} join {r}_e e on {r}.node = e.src
  left join recurring.{r} k on k.source = {r}.source and k.node = e.dst
  where k.node is null or {step} < k.l
  group by {r}.source, e.dst),
{st} as (select source, node, l.dist / {SCALE}.0::double dist, l.hops hops, nullif(l.pred, -1) pred from {r})"""


_LINES = "lines as (select unnest(string_split(text, chr(10))) v from documents)"
_WC_WS = (_LINES + r""",
wc as (select w word, count(*) count from (
  select unnest(string_split_regex(regexp_replace(lower(v), '\s+\z', ''), '\s+')) w from lines
  where v = '' or regexp_replace(v, '\s', '', 'g') <> '') t group by w)""")
_WC_SP = (_LINES + r""",
wc as (select w word, count(*) count from (
  select unnest(string_split(regexp_replace(lower(v), ' +\z', ''), ' ')) w from lines
  where v = '' or replace(v, ' ', '') <> '') t group by w)""")


def _synth_sql() -> str:
    d = lambda ident, slot, ch: M.draw_sql(ident, slot, ch, SYNTH_SEED)
    return f"""with p as (select n, n * {min(100, max(0, SYNTH_PCT))} // 100 m from (select count(*) n from supplier) c),
coords as (select row_number() over (order by s_suppkey) - 1 node, s_suppkey id, s_name name,
                  cast(floor(s_acctbal) as bigint) + 1000 x, s_nationkey::bigint * 100 y from supplier),
ids as (select node i from coords),
slots as (select i, unnest(generate_series(0, (select m from p))) b from ids),
legs as (select i oi,
                case when b = 0 then (i + 1) % (select n from p)
                     else {d('i', 'b', M.CHANNEL_DEST)} % (select n from p) end di,
                {d('i', 'b', M.CHANNEL_DEPARTURE)} % 2400 dep,
                ({d('i', 'b', M.CHANNEL_FLIGHT_NUMBER)})::int flnum from slots),
g as (select l.*, o.id org_id, o.name origin, t.id dest_id, t.name dest, (floor(sqrt(((o.x - t.x) * (o.x - t.x) + (o.y - t.y) * (o.y - t.y))::double)) % 2400)::int w
      from legs l join coords o on o.node = l.oi join coords t on t.node = l.di),
sflights as (select 'dofm' day_of_month, 'dofW' day_of_week, 'carrier' carrier, 'tailnum' tailnum, flnum,
       org_id, origin, dest_id, dest,
       dep::double sched_dep, dep::double dep_time, 0.0::double dep_delay,
       (dep + w)::double sched_arr, (dep + w)::double arr_time, 0.0::double arr_delay,
       w::double sched_elapsed, w distance from g)"""


_ROUTES_BODY = """select q.source, q.destination, a.name origin, b.name dest, round(st.dist, 6) weight,
       st.hops, p.path_text
from {q} q left join st on st.source = q.source and st.node = q.destination
left join paths p on p.source = q.source and p.destination = q.destination
left join names a on a.airport_id = q.source
left join names b on b.airport_id = q.destination"""

_HUB = """
hub as (select org_id source from flights group by org_id order by count(*) desc, org_id limit 1),
hq as (select (select source from hub) source, airport_id destination from names)"""


def _walk_sql(queries: str, st: str = "st", paths: str = "paths") -> str:
    return f""",
{paths}_walk(source, d, cur, step) as (
  select s.source, s.node, s.node, 0 from {st} s
  join (select distinct source, destination from {queries}) q
    on q.source = s.source and q.destination = s.node
  union all
  select w.source, w.d, s.pred, w.step + 1 from {paths}_walk w
  join {st} s on s.source = w.source and s.node = w.cur where s.pred is not null),
{paths} as (select w.source, w.d destination, string_agg(n.name, ' -> ' order by w.step desc) path_text
          from {paths}_walk w left join names n on n.airport_id = w.cur group by 1, 2)"""


_MID = "(select max(event_id) // 2 from events)"
_SHELL = f"""
asked as (select {D.INFO_SEQ_SQL} seq, source, destination from qs),
early as (select * from asked where seq <= {_MID}), late as (select * from asked where seq > {_MID}),
lo_mid as (select src, dst, arg_max(weight, seq) weight from ov where seq <= {_MID} group by 1, 2),
oedges_mid as (select src, dst, weight from edges e
           where not exists (select 1 from lo_mid lo where lo.src = e.src and lo.dst = e.dst)
           union all select src, dst, weight from lo_mid)"""


def oracle_sql() -> dict[str, str]:
    cols = ", ".join(FLIGHT_COLUMNS)
    wd_round = "round(avg(wd), 6)"
    q = {
        "parse_flights": _with(f"select {cols} from flights"),
        "parse_flights_strict": _with(f"select {cols} from flights"),
        "flights_per_airport": _with("select origin, count(*) as count from flights group by origin"),
        "flights_per_route": _with("select origin, dest, count(*) as count from flights group by origin, dest"),
        "busiest_route": _with("select origin, dest, count(*) as count from flights group by origin, dest "
                               "order by count desc, origin, dest limit 1"),
        "route_durations": _with("select origin, dest, count(*) n_flights, round(sum(wd), 6) total_duration, "
                                 f"{wd_round} avg_duration from fw group by origin, dest"),
        "route_durations_raw": _with("select dest_id dst, org_id src, round(avg(arr_time - dep_time), 6) weight "
                                     "from flights group by 1, 2"),
        "airports": _with("select airport_id, name, row_number() over (order by airport_id) - 1 node_id "
                          "from names"),
        "durable_airport_ids": _with(
            """select airport_id, name, row_number() over (order by airport_id not in (select id from early), airport_id) - 1 node_id
               from names""",
            f"""early as (select l_suppkey id from lineitem where l_shipdate < timestamp '{FIRST_LOAD}'
               union select l_partkey % {_N} from lineitem where l_shipdate < timestamp '{FIRST_LOAD}')"""),
        "streamed_route_edges": _with("select src, dst, round(weight, 6) weight, n_flights from edges"),
        "airport_count": _with("select count(*) n_airports from names"),
        "route_edges": _with("select src, dst, round(weight, 6) weight, n_flights from edges"),
        "incoming_adjacency": _with(f"select dst, cast(floor(src / {BLOCK}) as bigint) block, src, "
                                    "round(weight, 6) weight from edges"),
        "adjacency_lookup": _with("select e.src, e.dst, round(e.weight, 6) weight, "
                                  "round(r.weight, 6) reverse_weight from edges e "
                                  "left join edges r on r.src = e.dst and r.dst = e.src"),
        "direct_weights": _with("select f.dest_id dst, round(e.weight, 6) weight from flights f "
                                f"left join edges e on e.src = {DIRECT_SOURCE} and e.dst = f.dest_id"),
        "sssp_distances": _with("select source, node, round(dist, 6) dist, hops from st",
                                _HUB + "," + _labels_sql("edges", "hub"), recursive=True),
        "sssp_predecessors": _with("select source, node, pred from st", _HUB + "," + _labels_sql("edges", "hub"), recursive=True),
        "route_queries": _with(_ROUTES_BODY.format(q="qs"), _labels_sql("edges") + _walk_sql("qs"),
                               recursive=True),
        "hub_routes": _with(_ROUTES_BODY.format(q="hq"),
                            _HUB + "," + _labels_sql("edges", "hq") + _walk_sql("hq"), recursive=True),
        "route_shell": _with(
            " union all ".join(
                f"""select q.seq, a.name origin, b.name dest, round(st.dist, 6) weight, st.hops, p.path_text
               from {when} q left join {st} st on st.source = q.source and st.node = q.destination
               left join {paths} p on p.source = q.source and p.destination = q.destination
               join names a on a.airport_id = q.source
               join names b on b.airport_id = q.destination"""
                for when, st, paths in (("early", "st_mid", "paths_mid"), ("late", "st", "paths"))),
            _SHELL + "," + _labels_sql("oedges_mid", "early", "r_mid", "st_mid") + _walk_sql("early", "st_mid", "paths_mid")
            + "," + _labels_sql("oedges", "late") + _walk_sql("late"), recursive=True),
        "flights_from_text": _with(f"select {cols} from flights"),
        "rejected_flights": "select event_id || ',' || event_type as value from events",
        "rejected_override_commands": _with(
            f"""select {D.INFO_SEQ_SQL} seq, 'info ' || a.s_name || ' ' || b.s_name as value from qs
                join supplier a on a.s_suppkey = source join supplier b on b.s_suppkey = destination"""),
        "ambiguous_airports": _with(
            """select * from (with e as (select distinct airport_id, name from (
                 select org_id airport_id, 'Zone' || (org_id % 10) name from flights
                 union all select dest_id, dest from flights) t)
               select airport_id, 'id' kind from e group by 1 having count(*) > 1
               union select airport_id, 'name' from e where name in (select name from e group by 1 having count(*) > 1)) t"""),
        "distance_lookup": _with(f"select source, round(dist, 6) dist from st where node = {LOOKUP_NODE}",
                                 _HUB + "," + _labels_sql("edges", "hub"), recursive=True),
        "edge_lookup": _with("select q.source, q.destination, round(e.weight, 6) weight from qs q "
                             "left join edges e on e.src = q.source and e.dst = q.destination"),
        "transposed_edges": _with("select dst src, src dst, round(weight, 6) weight, n_flights from edges"),
        "edges_with_override_rows": _with(
            "select src, dst, round(weight, 6) weight, false overridden from edges e "
            "where not exists (select 1 from given g where g.src = e.src and g.dst = e.dst) "
            "union all select src, dst, weight, true from given",
            "given as (select src, dst, arg_max(weight, seq) weight from (values "
            + ", ".join(f"({i}, {a}::bigint, {b}::bigint, {w}::double)" for i, (a, b, w) in enumerate(OVERRIDE_ROWS))
            + ") v(seq, src, dst, weight) group by 1, 2)"),
        "latest_overrides": _with("select src, dst, weight from lo"),
        "override_commands": _with("select seq, src, dst, weight from ov"),
        "edges_with_overrides": _with(
            "select src, dst, round(weight, 6) weight, false overridden from edges e "
            "where not exists (select 1 from lo where lo.src = e.src and lo.dst = e.dst) "
            "union all select src, dst, round(weight, 6) weight, true overridden from lo"),
        "sssp_with_overrides": _with("select source, node, round(dist, 6) dist, hops, pred from st",
                                     _HUB + "," + _labels_sql("oedges", "hub"), recursive=True),
        "sssp_repaired": _with("select source, node, round(dist, 6) dist, hops, pred from st",
                               _HUB + "," + _labels_sql("oedges", "hub"), recursive=True),
        "word_count_ws": f"with {_WC_WS} select word, count from wc",
        "word_count_space": f"with {_WC_SP} select word, count from wc",
        "top_words": (f"with {_WC_SP} select row_number() over (order by count desc, word) rank, word, count "
                      f"from wc order by count desc, word limit {TOP_WORDS}"),
        "top_words_ws": (f"with {_WC_WS} select row_number() over (order by count desc, word) rank, word, count "
                         f"from wc order by count desc, word limit {TOP_WORDS}"),
        "synthetic_nodes": """select row_number() over (order by s_suppkey) - 1 node,
            'Node' || (row_number() over (order by s_suppkey) - 1) label,
            cast(floor(s_acctbal) as bigint) + 1000 x, s_nationkey::bigint * 100 y from supplier""",
        "synthetic_flights": _synth_sql() + f"\nselect {cols} from sflights",
        "synthetic_route_edges": _synth_sql() + """,
sw as (select *, case when arr_time - dep_time < 0 then arr_time - dep_time + 2400
                      else arr_time - dep_time end wd from sflights)
select org_id src, dest_id dst, round(avg(wd), 6) weight, count(*) n_flights from sw group by 1, 2""",
    }
    return q


def entry(spark: SparkSession, sf_dir: str = "/root/testdata/sf0.001") -> DataFrame:
    """Flagship: answer the route queries of ``sf_dir`` with paths and names."""
    return q_route_queries(spark, sf_dir)
