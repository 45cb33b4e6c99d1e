"""Mart and trend queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from flightlake import schema
from flightlake.operators import marts
from flightlake.plans import bitmaps
from flightlake.queries import standins as s
from flightlake.queries.registry import ORACLES, query
from flightlake.session import cut_lineage

_YEARS = "".join(f"count(*) FILTER (WHERE yr = {y}) AS {{what}}_{y}, " for y in marts.MART_YEARS)


def _mode(value: str, group: str, source: str) -> str:
    """Checker SQL for the most frequent value, smallest on a tie."""
    keys = ", ".join(group.split())
    return (
        f"SELECT {keys}, v FROM (SELECT {keys}, {value} AS v, row_number() OVER (PARTITION BY {keys} "
        f"ORDER BY count(*) DESC, {value}) AS rn FROM {source} WHERE {value} IS NOT NULL GROUP BY {keys}, {value}) WHERE rn = 1"
    )


def _join_on(group: str, left: str, right: str) -> str:
    return " AND ".join(f"{left}.{k} IS NOT DISTINCT FROM {right}.{k}" for k in group.split())


_ROUTE = "origin_iata destination_iata origin_country destination_country"


def _route_sql(joined: str) -> dict[str, str]:
    """CTEs of the route mart over a ``joined`` view with one row per joined flight."""
    group = ", ".join(_ROUTE.split())
    return {
        "joined": joined,
        "m1": _mode("airline_name", _ROUTE, "joined"),
        "m2": _mode("airline_iata", _ROUTE, "joined"),
        "agg": f"""
            SELECT {group}, coalesce(origin_country <> destination_country, false) AS is_international,
                   count(*) AS total_flights, {_YEARS.format(what='flights')}
                   {s.half_up('sum(us)', 'count(us) * 60000000', 1)} AS avg_duration_min,
                   {s.half_up('min(us)', '60000000', 1)} AS min_duration_min,
                   {s.half_up('max(us)', '60000000', 1)} AS max_duration_min,
                   CAST(min(event_date) AS VARCHAR) AS first_seen_date, CAST(max(event_date) AS VARCHAR) AS last_seen_date,
                   origin_iata || ' → ' || destination_iata AS route_label
            FROM joined GROUP BY {group} HAVING count(*) >= 2""",
        "mart": f"""
            SELECT agg.*, m1.v AS primary_airline, m2.v AS primary_airline_iata,
                   rank() OVER (ORDER BY total_flights DESC) AS route_rank
            FROM agg LEFT JOIN m1 ON {_join_on(_ROUTE, 'agg', 'm1')} LEFT JOIN m2 ON {_join_on(_ROUTE, 'agg', 'm2')}""",
    }


_JOINED_ROUTES = """
    SELECT d.origin_iata, d.destination_iata, o.iso_country AS origin_country, t.iso_country AS destination_country,
           a.airline_name, a.airline_iata, d.event_date, year(d.event_date) AS yr,
           epoch_us(l.event_timestamp) - epoch_us(d.event_timestamp) AS us
    FROM hist_events d LEFT JOIN aircraft a ON a.icao24 = d.icao24
    LEFT JOIN hist_events l ON l.icao24 = d.icao24 AND l.event_type = 'LANDED' AND l.event_date = d.event_date
         AND l.source = 'opensky_historical'
    LEFT JOIN airports o ON o.airport_iata_code = d.origin_iata
    LEFT JOIN airports t ON t.airport_iata_code = d.destination_iata
    WHERE d.event_type = 'DEPARTED' AND d.origin_iata IS NOT NULL AND d.destination_iata IS NOT NULL"""

_ROUTE_VIEWS = ("hist_events", "aircraft", "airports")
_ROUTE_CTES = _route_sql(_JOINED_ROUTES)


def _routes(spark, sf):
    return marts.route_mart(s.hist_events(spark, sf), s.aircraft(spark, sf), s.airports(spark, sf))


@query("route_mart", s.with_views("SELECT * FROM mart", *_ROUTE_VIEWS, **_ROUTE_CTES))
def route_mart(spark, sf):
    return _routes(spark, sf)


@query("mart_incremental", s.with_views("SELECT * FROM mart", *_ROUTE_VIEWS, **_ROUTE_CTES))
def mart_incremental(spark, sf):
    """The route mart out of folded days, where a later load touches some dates and only these are folded anew."""
    events = s.hist_events(spark, sf)
    fold = lambda h: marts.departures_with_landings(h, schema.HISTORY_SOURCE)
    name = f"route_days_{uuid.uuid4().hex}"
    late = (F.dayofmonth("event_date") <= 3) & (F.col("event_id") % 2 == 0)
    touched = [r[0] for r in events.filter(late).select("event_date").distinct().collect()]
    marts.refresh_days(spark, name, fold, events.filter(~late), "event_date", [])
    days = marts.refresh_days(spark, name, fold, events, "event_date", touched)
    mart = marts.route_mart_of(cut_lineage(days), s.aircraft(spark, sf), s.airports(spark, sf))
    spark.sql(f"DROP TABLE {name}")
    return mart


@query("ordered_mart", s.with_views("SELECT * FROM mart WHERE route_rank <= 40", *_ROUTE_VIEWS, **_ROUTE_CTES))
def ordered_mart(spark, sf):
    """The first ranks of the route mart, read from the table that was written in their order."""
    name = f"ordered_{uuid.uuid4().hex}"
    marts.write_ordered(_routes(spark, sf), name, ["route_rank", "route_label"])
    first = cut_lineage(spark.table(name).filter("route_rank <= 40"))
    spark.sql(f"DROP TABLE {name}")
    return first


@query("top_routes", s.with_views(
    "SELECT route_label, total_flights, primary_airline, avg_duration_min FROM mart "
    "ORDER BY total_flights DESC, route_label, origin_country, destination_country LIMIT 20", *_ROUTE_VIEWS, **_ROUTE_CTES))
def top_routes(spark, sf):
    return marts.top_routes(_routes(spark, sf))


_TERRITORY = "territory_type territory_id territory_name"
_TERRITORY_JOINED = """
    SELECT c.territory_type, c.territory_id, c.territory_name, c.crossing_role, c.entered_date, c.duration_minutes, c.icao24,
           year(c.entered_date) AS yr, a.airline_iata, a.airline_name, a.country_iso2
    FROM crossings c LEFT JOIN aircraft a ON a.icao24 = c.icao24 WHERE c.duration_minutes > 0"""


def _territory_ctes(joined: str) -> dict[str, str]:
    group = ", ".join(_TERRITORY.split())
    return {
        "joined": joined,
        "m1": _mode("country_iso2", _TERRITORY, "joined"),
        "m2": _mode("airline_name", _TERRITORY, "joined"),
        "agg": f"""
            SELECT {group}, count(*) AS total_crossings, count(DISTINCT icao24) AS unique_aircraft,
                   count(DISTINCT airline_iata) AS unique_airlines, {_YEARS.format(what='crossings')}
                   {s.half_up('CAST(sum(duration_minutes) * 100 AS HUGEINT)', 'count(*) * 100', 1)} AS avg_duration_min,
                   CAST(round(sum(duration_minutes), 1) AS DOUBLE) AS total_duration_min,
                   CAST(round(max(duration_minutes), 1) AS DOUBLE) AS max_duration_min,
                   count(*) FILTER (WHERE crossing_role = 'START') AS start_crossings,
                   count(*) FILTER (WHERE crossing_role = 'ROUTE') AS route_crossings,
                   count(*) FILTER (WHERE crossing_role = 'END') AS end_crossings,
                   CAST(min(entered_date) AS VARCHAR) AS first_crossing_date, CAST(max(entered_date) AS VARCHAR) AS last_crossing_date
            FROM joined GROUP BY {group}""",
        "mart": f"""
            SELECT agg.*, m1.v AS top_aircraft_country, m2.v AS top_airline,
                   rank() OVER (PARTITION BY agg.territory_type ORDER BY total_crossings DESC) AS rank_within_type
            FROM agg LEFT JOIN m1 ON {_join_on(_TERRITORY, 'agg', 'm1')} LEFT JOIN m2 ON {_join_on(_TERRITORY, 'agg', 'm2')}""",
    }


_TERRITORY_CTES = _territory_ctes(_TERRITORY_JOINED)


@query("territory_mart", s.with_views("SELECT * FROM mart", "crossings", "aircraft", **_TERRITORY_CTES))
def territory_mart(spark, sf):
    return marts.territory_mart(s.crossings(spark, sf), s.aircraft(spark, sf))


@query("top_territories", s.with_views(
    "SELECT territory_name, total_crossings, unique_aircraft FROM mart WHERE territory_type = 'COUNTRY' "
    "ORDER BY total_crossings DESC, territory_name LIMIT 10", "crossings", "aircraft", **_TERRITORY_CTES))
def top_territories(spark, sf):
    return marts.top_territories(marts.territory_mart(s.crossings(spark, sf), s.aircraft(spark, sf)))


@query("yearly_trend", s.with_views(
    "SELECT year(event_date) AS year, count(*) AS total_flights, count(DISTINCT icao24) AS unique_aircraft FROM hist_events GROUP BY 1",
    "hist_events"))
def yearly_trend(spark, sf):
    return marts.yearly_trend(s.hist_events(spark, sf))


def _folded(spark, rows, by, late, date):
    """Folded groups of rows that came in two loads: keys numbered twice, and only the dates of the second load folded anew."""
    numbers, name = f"numbers_{uuid.uuid4().hex}", f"folded_{uuid.uuid4().hex}"
    first = bitmaps.number_keys(spark, rows.filter(~late), "icao24", numbers)
    marts.refresh_days(spark, name, lambda h: bitmaps.fold(h, by, "icao24", first), rows.filter(~late), date, [])
    every = bitmaps.number_keys(spark, rows, "icao24", numbers)
    touched = [r[0] for r in rows.filter(late).select(date).distinct().collect()]
    days = cut_lineage(marts.refresh_days(spark, name, lambda h: bitmaps.fold(h, by, "icao24", every), rows, date, touched))
    spark.sql(f"DROP TABLE {name}")
    spark.sql(f"DROP TABLE {numbers}")
    return days


@query("trend_incremental", ORACLES["yearly_trend"])
def trend_incremental(spark, sf):
    """The yearly trend out of bitmaps stored per date."""
    late = (F.dayofmonth("event_date") <= 3) & (F.col("event_id") % 2 == 0)
    return marts.trend_of(_folded(spark, s.hist_events(spark, sf), ["event_date"], late, "event_date"))


@query("territory_visitors", s.with_views(
    "SELECT territory_type, territory_id, count(*) AS crossings, count(DISTINCT icao24) AS aircraft FROM crossings GROUP BY 1, 2", "crossings"))
def territory_visitors(spark, sf):
    """Distinct aircraft over each territory, out of bitmaps stored per territory and date."""
    by = ["territory_type", "territory_id"]
    late = (F.dayofmonth("entered_date") <= 3) & (F.col("crossing_id") % 2 == 0)
    days = _folded(spark, s.crossings(spark, sf), [*by, "entered_date"], late, "entered_date")
    return bitmaps.distinct_of(days, by, "aircraft").withColumnRenamed("rows", "crossings")


# The marts over the largest tables: order lines as flights -----------------------------------

_SCALE_YEARS = (1996, 1997, 1998, 1999)
_SHIPPED = """
    SELECT 'N' || s.s_nationkey AS origin_iata, 'N' || c.c_nationkey AS destination_iata, CAST(o.o_custkey AS VARCHAR) AS icao24,
           o.o_orderdate AS departed_at, l.l_shipdate AS landed_at
    FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
    JOIN supplier s ON s.s_suppkey = l.l_suppkey"""


def shipments(spark, sf):
    """Order lines as flights from the supplier's nation to the customer's, flown by the customer."""
    line = s.table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_shipdate")
    order = s.table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    buyer = s.table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    seller = s.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    nation = lambda c: F.concat(F.lit("N"), F.col(c).cast("string"))
    return line.join(order.join(buyer, "o_custkey"), "l_orderkey").join(seller, "l_suppkey").select(
        nation("s_nationkey").alias("origin_iata"), nation("c_nationkey").alias("destination_iata"),
        F.col("o_custkey").cast("string").alias("icao24"),
        F.col("o_orderdate").cast("timestamp").alias("departed_at"), F.col("l_shipdate").cast("timestamp").alias("landed_at"),
    )


_SCALE_EVENTS = """
    SELECT icao24, 'DEPARTED' AS event_type, departed_at AS event_timestamp, CAST(departed_at AS DATE) AS event_date, origin_iata, destination_iata FROM shipped
    UNION ALL SELECT icao24, 'LANDED', landed_at, CAST(landed_at AS DATE), origin_iata, destination_iata FROM shipped"""
_SCALE_AIRPORTS = "SELECT 'N' || n_nationkey AS airport_iata_code, 'R' || n_regionkey AS iso_country FROM nation"
_SCALE_JOINED = """
    SELECT d.origin_iata, d.destination_iata, o.iso_country AS origin_country, t.iso_country AS destination_country,
           a.airline_name, a.airline_iata, d.event_date, year(d.event_date) AS yr, epoch_us(l.event_timestamp) - epoch_us(d.event_timestamp) AS us
    FROM flown d LEFT JOIN aircraft a ON a.icao24 = d.icao24
    LEFT JOIN flown l ON l.icao24 = d.icao24 AND l.event_type = 'LANDED' AND l.event_date = d.event_date
    LEFT JOIN ports o ON o.airport_iata_code = d.origin_iata LEFT JOIN ports t ON t.airport_iata_code = d.destination_iata
    WHERE d.event_type = 'DEPARTED'"""
_SCALE_CTES = {"shipped": _SHIPPED, "flown": _SCALE_EVENTS, "ports": _SCALE_AIRPORTS}
_SCALE_YEAR_SQL = "".join(f"count(*) FILTER (WHERE yr = {y}) AS flights_{y}, " for y in _SCALE_YEARS)
_SCALE_ROUTE = {
    **_SCALE_CTES,
    **{k: v.replace(_YEARS.format(what="flights"), _SCALE_YEAR_SQL) for k, v in _route_sql(_SCALE_JOINED).items()},
}


@query("route_mart_scale", s.with_views("SELECT * FROM mart", "aircraft", **_SCALE_ROUTE))
def route_mart_scale(spark, sf):
    ends = F.explode(F.array(
        F.struct(F.lit("DEPARTED").alias("event_type"), F.col("departed_at").alias("event_timestamp")),
        F.struct(F.lit("LANDED").alias("event_type"), F.col("landed_at").alias("event_timestamp")),
    ))
    # Departures and landings are read apart; staged, the shipments are joined once for both.
    flown = cut_lineage(shipments(spark, sf)).select("icao24", "origin_iata", "destination_iata", ends.alias("e")).select(
        "icao24", "origin_iata", "destination_iata", "e.*", F.to_date("e.event_timestamp").alias("event_date"), F.lit("x").alias("source"))
    ports = s.table(spark, sf, "nation").select(
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("airport_iata_code"),
        F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("iso_country"))
    return marts.route_mart(flown, s.aircraft(spark, sf), ports, landed_source="x", years=_SCALE_YEARS)


_SCALE_STAYS = """
    SELECT 'COUNTRY' AS territory_type, CAST(substr(destination_iata, 2) AS INTEGER) AS territory_id, destination_iata AS territory_name,
           CASE WHEN origin_iata = destination_iata THEN 'START' ELSE 'ROUTE' END AS crossing_role, CAST(departed_at AS DATE) AS entered_date,
           CAST(date_diff('day', departed_at, landed_at) + 0.25 AS DECIMAL(8,2)) AS duration_minutes, icao24,
           year(departed_at) AS yr, a.airline_iata, a.airline_name, a.country_iso2
    FROM shipped LEFT JOIN aircraft a USING (icao24) WHERE date_diff('day', departed_at, landed_at) + 0.25 > 0"""
_SCALE_TERRITORY = {
    "shipped": _SHIPPED,
    **{k: v.replace(_YEARS.format(what="crossings"), _SCALE_YEAR_SQL.replace("flights_", "crossings_")) for k, v in _territory_ctes(_SCALE_STAYS).items()},
}


@query("territory_mart_scale", s.with_views("SELECT * FROM mart", "aircraft", **_SCALE_TERRITORY))
def territory_mart_scale(spark, sf):
    d = F.col("destination_iata")
    stays = shipments(spark, sf).select(
        F.lit("COUNTRY").alias("territory_type"), F.substring(d, 2, 9).cast("int").alias("territory_id"), d.alias("territory_name"),
        F.when(F.col("origin_iata") == d, "START").otherwise("ROUTE").alias("crossing_role"), F.to_date("departed_at").alias("entered_date"),
        (F.date_diff("landed_at", "departed_at") + F.lit(0.25)).cast("decimal(8,2)").alias("duration_minutes"), "icao24")
    return marts.territory_mart(stays, s.aircraft(spark, sf), years=_SCALE_YEARS)
