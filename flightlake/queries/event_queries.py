"""Event, territory and crossing queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from flightlake.functions import geometry
from flightlake.operators import crossings, events, geo
from flightlake.plans.sequence import DAY
from flightlake.queries import standins as s
from flightlake.queries.registry import query

CELL = 12.0
_ORDER = ("timestamp", "event_id")

# Checker SQL shared by the queries below -------------------------------------------------

_EDGES = """
    SELECT 'COUNTRY' AS level, id AS tid, name, unnest([
        {'x1': x0, 'y1': y0, 'x2': x0 + 60, 'y2': y0}, {'x1': x0 + 60, 'y1': y0, 'x2': x0 + 60, 'y2': y0 + 30},
        {'x1': x0 + 60, 'y1': y0 + 30, 'x2': x0, 'y2': y0 + 30}, {'x1': x0, 'y1': y0 + 30, 'x2': x0, 'y2': y0}]) AS e FROM boxes
    UNION ALL
    SELECT 'STATE', id + 1000, 'STATE_' || id, unnest([
        {'x1': x0 + 30, 'y1': y0, 'x2': x0 + 60, 'y2': y0 + 15}, {'x1': x0 + 60, 'y1': y0 + 15, 'x2': x0 + 30, 'y2': y0 + 30},
        {'x1': x0 + 30, 'y1': y0 + 30, 'x2': x0, 'y2': y0 + 15}, {'x1': x0, 'y1': y0 + 15, 'x2': x0 + 30, 'y2': y0}]) FROM boxes"""


def _containing(points: str, key: str) -> str:
    return f"""
        SELECT p.{key}, level, min(struct_pack(id := tid, name := name)) AS t FROM (
            SELECT p.{key}, level, tid, name FROM {points} p JOIN edges
              ON ((e.y1 > p.latitude) <> (e.y2 > p.latitude))
             AND p.longitude < (e.x2 - e.x1) * CAST(p.latitude - e.y1 AS DOUBLE) / (e.y2 - e.y1) + e.x1
            GROUP BY p.{key}, level, tid, name HAVING count(*) % 2 = 1) p GROUP BY p.{key}, level"""


_LOCATED = """
    SELECT p.*, CASE WHEN c.t IS NULL THEN NULL WHEN z.t IS NULL THEN 'COUNTRY' ELSE 'STATE' END AS territory_type,
           CASE WHEN c.t IS NOT NULL THEN coalesce(z.t.id, c.t.id) END AS territory_id,
           CASE WHEN c.t IS NOT NULL THEN coalesce(z.t.name, c.t.name) END AS territory_name,
           c.t.id AS country_id, c.t.name AS country_name
    FROM pings p LEFT JOIN hits c ON c.event_id = p.event_id AND c.level = 'COUNTRY'
    LEFT JOIN hits z ON z.event_id = p.event_id AND z.level = 'STATE'"""
_SPATIAL = {"edges": _EDGES, "hits": _containing("pings", "event_id"), "located": _LOCATED}

_DETECTED = """
    SELECT *, CASE WHEN g0 IS NULL THEN NULL WHEN NOT g0 AND on_ground THEN 'LANDED' WHEN g0 AND NOT on_ground THEN 'DEPARTED'
                   WHEN g0 OR on_ground THEN NULL WHEN vertical_rate_fpm > 200 THEN 'CLIMBING'
                   WHEN vertical_rate_fpm < -200 THEN 'DESCENDING'
                   WHEN altitude_ft > 10000 AND abs(r0) > 200 THEN 'CRUISING' END AS event_type
    FROM (SELECT *, lag(on_ground) OVER w AS g0, lag(vertical_rate_fpm) OVER w AS r0 FROM {src}
          WINDOW w AS (PARTITION BY icao24 ORDER BY ts, event_id))"""

_SESSIONS = {
    **_SPATIAL,
    "detected": _DETECTED.format(src="located"),
    "filled": """
        SELECT *, last_value(CASE WHEN event_type IS NOT NULL THEN event_type END IGNORE NULLS) OVER w AS last_kind,
                  last_value(CASE WHEN event_type IS NOT NULL THEN ts END IGNORE NULLS) OVER w AS last_at
        FROM detected WINDOW w AS (PARTITION BY icao24 ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "steps": """
        SELECT *, coalesce(event_type = 'LANDED', false) AS landing FROM filled WHERE last_at IS NOT NULL
           AND ((NOT on_ground AND territory_id IS NOT NULL) OR event_type = 'LANDED')""",
    "marked": """
        SELECT *, lag(landing) OVER w AS l0, lag(territory_type) OVER w AS tt0, lag(territory_id) OVER w AS t0, lag(country_id) OVER w AS c0
        FROM steps WINDOW w AS (PARTITION BY icao24 ORDER BY ts, event_id)""",
    "borders": """
        SELECT * FROM marked WHERE landing OR l0 IS NULL OR l0 OR tt0 <> territory_type OR t0 <> territory_id OR c0 <> country_id""",
    "framed": """
        SELECT *, lag(landing) OVER w AS before_landing, lead(landing) OVER w AS after_landing, lead(ts) OVER w AS exit_ts
        FROM borders WINDOW w AS (PARTITION BY icao24 ORDER BY ts, event_id)""",
    "sessions": f"""
        SELECT icao24, callsign, last_at, last_kind AS event_type, territory_type, territory_id, territory_name,
               CASE WHEN coalesce(before_landing, true) THEN 'START' ELSE 'ROUTE' END AS crossing_role,
               CASE WHEN coalesce(after_landing, false) THEN 'COMPLETED' ELSE 'IN_PROGRESS' END AS flight_status,
               ts AS entered_at, CAST(ts AS DATE) AS entered_date, exit_ts AS exited_at, CAST(exit_ts AS DATE) AS exited_date,
               CASE WHEN exit_ts IS NOT NULL THEN {s.half_up('(epoch_us(exit_ts) - epoch_us(ts))', '60000000', 2)} END AS duration_minutes
        FROM framed WHERE NOT landing""",
}


_STORED: dict[tuple, geo.TerritoryCells | geo.AirportGrids] = {}


def once(spark, sf, name, build):
    """An index built and stored once per application and table folder."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _STORED:
        _STORED[key] = geo.stored(build())
    return _STORED[key]


def _index(spark, sf):
    return once(spark, sf, "territories", lambda: geo.build_cells(geo.boundary_edges(s.boundaries(spark, sf)), CELL))


def _grids(spark, sf):
    return once(spark, sf, "airports", lambda: geo.build_airport_grids(s.airports(spark, sf)))


# Events ------------------------------------------------------------------------------------

_EVENT_COLS = f"event_id, icao24, callsign, event_type, {s.ts_text('ts')} AS timestamp, latitude, longitude, altitude_ft"


@query("detect_events", s.with_views(
    f"SELECT {_EVENT_COLS} FROM detected WHERE event_type IS NOT NULL", "pings", detected=_DETECTED.format(src="pings")))
def detect_events(spark, sf):
    found = events.detect_events(s.pings(spark, sf), _ORDER, width=DAY)
    return found.select("event_id", "icao24", "callsign", "event_type", "timestamp", "latitude", "longitude", "altitude_ft")


@query("known_aircraft_semi", s.with_views(
    "SELECT event_id, icao24, event_type, TRUE AS accepted FROM flight_events WHERE icao24 IN (SELECT icao24 FROM aircraft) "
    "UNION ALL SELECT event_id, icao24, event_type, FALSE FROM flight_events WHERE icao24 NOT IN (SELECT icao24 FROM aircraft)",
    "flight_events", "aircraft"))
def known_aircraft_semi(spark, sf):
    all_, master = s.flight_events(spark, sf).select("event_id", "icao24", "event_type"), s.aircraft(spark, sf)
    good = events.known_aircraft(all_, master).withColumn("accepted", F.lit(True))
    bad = events.unknown_aircraft(all_, master).withColumn("accepted", F.lit(False))
    return good.unionByName(bad)


@query("last_event_fill", s.with_views(f"""
    SELECT event_id, icao24, {s.ts_text("last_value(CASE WHEN event_type IN ('DEPARTED', 'LANDED') THEN event_timestamp END IGNORE NULLS) OVER (PARTITION BY icao24 ORDER BY event_timestamp, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")} AS last_end
    FROM flight_events""", "flight_events"))
def last_event_fill(spark, sf):
    rows = s.flight_events(spark, sf).withColumn(
        "_end", F.when(F.col("event_type").isin("DEPARTED", "LANDED"), F.col("event_timestamp")))
    return events.with_last_event(rows, ("event_timestamp", "event_id"), "_end", DAY, "last_end").select("event_id", "icao24", "last_end")


# Territories -------------------------------------------------------------------------------

@query("point_country", s.with_views(
    "SELECT event_id, t.id AS territory_id, t.name AS territory_name FROM hits WHERE level = 'COUNTRY'", "pings", "boxes",
    edges=_EDGES, hits=_containing("pings", "event_id")))
def point_country(spark, sf):
    found = geo.locate(s.pings(spark, sf).select("event_id", "longitude", "latitude"), _index(spark, sf))
    return found.filter(F.col("country").isNotNull()).select(
        "event_id", F.col("country.id").alias("territory_id"), F.col("country.name").alias("territory_name"))


@query("point_state_priority", s.with_views(
    "SELECT event_id, territory_type, territory_id, territory_name, country_id, country_name FROM located", "pings", "boxes", **_SPATIAL))
def point_state_priority(spark, sf):
    found = geo.with_territory(s.pings(spark, sf).select("event_id", "longitude", "latitude"), _index(spark, sf))
    return found.select("event_id", "territory_type", "territory_id", "territory_name", "country_id", "country_name")


@query("ocean_points", s.with_views(
    "SELECT CAST(floor(latitude / 30) AS BIGINT) AS band, count(*) AS points, count(*) FILTER (WHERE territory_id IS NULL) AS ocean "
    "FROM located GROUP BY 1", "pings", "boxes", **_SPATIAL))
def ocean_points(spark, sf):
    found = geo.with_territory(s.pings(spark, sf).select("longitude", "latitude"), _index(spark, sf))
    return found.groupBy(F.floor(F.col("latitude") / 30).alias("band")).agg(
        F.count(F.lit(1)).alias("points"), F.count_if(F.col("territory_id").isNull()).alias("ocean"))


# Every event as a triangle with a hole, written as WKT.
_SHAPES = """
    SELECT event_id, unnest([{'x1': x, 'y1': y, 'x2': x + 8, 'y2': y}, {'x1': x + 8, 'y1': y, 'x2': x, 'y2': y + 6}, {'x1': x, 'y1': y + 6, 'x2': x, 'y2': y},
        {'x1': x + 1, 'y1': y + 1, 'x2': x + 1, 'y2': y + 2}, {'x1': x + 1, 'y1': y + 2, 'x2': x + 2, 'y2': y + 1}, {'x1': x + 2, 'y1': y + 1, 'x2': x + 1, 'y2': y + 1}]) AS e
    FROM (SELECT event_id, CAST((event_id * 37) % 360 - 180 AS DOUBLE) AS x, CAST((event_id * 53) % 180 - 90 AS DOUBLE) AS y FROM events)"""


@query("wkt_shapes", f"""
    WITH sh AS ({_SHAPES})
    SELECT event_id, count(*) AS edges, sum(e.x1 * e.y2 - e.x2 * e.y1) / 2 AS area,
           round(sum((e.x1 + e.x2) * (e.x1 * e.y2 - e.x2 * e.y1)) / (3 * sum(e.x1 * e.y2 - e.x2 * e.y1)), 6) AS centre_lon,
           round(sum((e.y1 + e.y2) * (e.x1 * e.y2 - e.x2 * e.y1)) / (3 * sum(e.x1 * e.y2 - e.x2 * e.y1)), 6) AS centre_lat
    FROM sh GROUP BY event_id""")
def wkt_shapes(spark, sf):
    n = F.col("event_id")
    placed = s.table(spark, sf, "events").select(n, ((n * 37) % 360 - 180).alias("x"), ((n * 53) % 180 - 90).alias("y"))
    at = lambda dx, dy: F.concat((F.col("x") + dx).cast("string"), F.lit(" "), (F.col("y") + dy).cast("string"))
    ring = lambda *cs: F.concat(F.lit("("), F.concat_ws(", ", *cs, cs[0]), F.lit(")"))
    wkt = F.concat(F.lit("POLYGON ("), ring(at(0, 0), at(8, 0), at(0, 6)), F.lit(", "), ring(at(1, 1), at(1, 2), at(2, 1)), F.lit(")"))
    shapes = geo.boundary_edges(placed.select("event_id", wkt.alias("wkt"))).withColumn("c", geometry.centroid(F.col("edges")))
    twice = F.aggregate(F.transform("edges", lambda e: e["x1"] * e["y2"] - e["x2"] * e["y1"]), F.lit(0.0), lambda a, v: a + v)
    return shapes.select("event_id", F.size("edges").alias("edges"), (twice / 2).alias("area"),
                         F.round("c.lon", 6).alias("centre_lon"), F.round("c.lat", 6).alias("centre_lat"))


_DISC = """
    SELECT DISTINCT ident, level, territory_id FROM (
        SELECT a.ident, level, tid AS territory_id, count(*) FILTER (WHERE ((e.y1 > ay) <> (e.y2 > ay))
                   AND ax < (e.x2 - e.x1) * (ay - e.y1) / (e.y2 - e.y1) + e.x1) AS hits,
               min(sqrt(power(ax - (e.x1 + u * (e.x2 - e.x1)), 2) + power(ay - (e.y1 + u * (e.y2 - e.y1)), 2))) AS dist
        FROM (SELECT ident, ax, ay, level, tid, e, greatest(0, least(1, ((ax - e.x1) * (e.x2 - e.x1) + (ay - e.y1) * (e.y2 - e.y1))
                   / CAST(power(e.x2 - e.x1, 2) + power(e.y2 - e.y1, 2) AS DOUBLE))) AS u
              FROM (SELECT ident, longitude_deg + 0.25 AS ax, latitude_deg + 0.25 AS ay FROM airports), edges) a
        GROUP BY a.ident, level, tid) WHERE hits % 2 = 1 OR dist <= 3.1"""


@query("disc_territories", s.with_views(_DISC, "airports", "boxes", edges=_EDGES))
def disc_territories(spark, sf):
    spots = s.airports(spark, sf).select(
        "ident", (F.col("longitude_deg") + 0.25).alias("lon"), (F.col("latitude_deg") + 0.25).alias("lat"))
    index = once(spark, sf, "discs", lambda: geo.build_cells(geo.boundary_edges(s.boundaries(spark, sf)), CELL, reach=3.1))
    near = geo.near_territories(spots, index, 3.1, "lon", "lat")
    return near.select("ident", "level", "territory_id")


@query("nearest_airport", s.with_views("""
    SELECT event_id, airport_iata_code AS origin_iata FROM (
        SELECT e.event_id, a.airport_iata_code, row_number() OVER (PARTITION BY e.event_id ORDER BY
               sqrt((e.longitude - a.longitude_deg) * (e.longitude - a.longitude_deg) + (e.latitude - a.latitude_deg) * (e.latitude - a.latitude_deg)), a.ident) AS rn
        FROM flight_events e, airports a WHERE e.event_type = 'DEPARTED' AND a.is_commercial AND a.airport_iata_code IS NOT NULL) WHERE rn = 1""",
    "flight_events", "airports"))
def nearest_airport(spark, sf):
    departed = s.flight_events(spark, sf).filter(F.col("event_type") == "DEPARTED").drop("origin_iata")
    return events.with_origin(departed, _grids(spark, sf)).select("event_id", "origin_iata")


# Live sessions -----------------------------------------------------------------------------

_SESSION_COLS = f"""icao24, callsign, {s.ts_text('last_at')} AS event_timestamp, event_type, territory_type, territory_id, territory_name,
    crossing_role, flight_status, {s.ts_text('entered_at')} AS entered_at, CAST(entered_date AS VARCHAR) AS entered_date,
    {s.ts_text('exited_at')} AS exited_at, CAST(exited_date AS VARCHAR) AS exited_date, duration_minutes"""


def sessions(spark, sf):
    return crossings.territory_sessions(s.pings(spark, sf), _index(spark, sf), order=_ORDER, width=DAY)


@query("crossings_batch", s.with_views(f"SELECT {_SESSION_COLS} FROM sessions", "pings", "boxes", **_SESSIONS))
def crossings_batch(spark, sf):
    return sessions(spark, sf)


@query("open_crossings", s.with_views(
    "SELECT territory_type, territory_id, count(*) AS open FROM sessions WHERE flight_status = 'IN_PROGRESS' AND exited_at IS NULL "
    "GROUP BY territory_type, territory_id", "pings", "boxes", **_SESSIONS))
def open_crossings(spark, sf):
    open_ = sessions(spark, sf).filter((F.col("flight_status") == "IN_PROGRESS") & F.col("exited_at").isNull())
    return open_.groupBy("territory_type", "territory_id").agg(F.count(F.lit(1)).alias("open"))


# Flights and routes ------------------------------------------------------------------------

_PAIRS = """
    SELECT event_id AS departed_event_id, icao24, callsign, source, event_date, event_timestamp AS firstseen, latitude AS lat1,
           longitude AS lon1, e2 AS landed_event_id, t2 AS lastseen, y2 AS lat2, x2 AS lon2
    FROM (SELECT *, lead(event_type) OVER w AS k2, lead(event_id) OVER w AS e2, lead(event_timestamp) OVER w AS t2,
                 lead(event_date) OVER w AS d2, lead(latitude) OVER w AS y2, lead(longitude) OVER w AS x2
          FROM hist_events WHERE event_type IN ('DEPARTED', 'LANDED') AND source = 'opensky_historical'
          WINDOW w AS (PARTITION BY icao24, source ORDER BY event_timestamp, event_id))
    WHERE event_type = 'DEPARTED' AND k2 = 'LANDED' AND d2 = event_date"""


def flight_pairs(spark, sf):
    return events.flight_pairs(s.hist_events(spark, sf), order=("event_timestamp", "event_id"))


@query("flight_pairs", s.with_views(
    f"SELECT * REPLACE (CAST(event_date AS VARCHAR) AS event_date, {s.ts_text('firstseen')} AS firstseen, {s.ts_text('lastseen')} AS lastseen) FROM pairs",
    "hist_events", pairs=_PAIRS))
def flight_pairs_query(spark, sf):
    return flight_pairs(spark, sf)


@query("count_flights", s.with_views(
    "SELECT count(*) AS flights FROM hist_events d JOIN hist_events l ON l.icao24 = d.icao24 AND l.event_type = 'LANDED' "
    "AND l.source = d.source AND l.event_date = d.event_date WHERE d.event_type = 'DEPARTED' AND d.source = 'opensky_historical' "
    "AND year(d.event_date) = 2021", "hist_events"))
def count_flights(spark, sf):
    return events.count_flights(s.hist_events(spark, sf), year=2021)


@query("never_landed", s.with_views("""
    SELECT event_id, icao24 FROM (SELECT *, lead(event_type) OVER (PARTITION BY icao24 ORDER BY event_timestamp, event_id) AS k2
        FROM flight_events WHERE event_type IN ('DEPARTED', 'LANDED')) WHERE event_type = 'DEPARTED' AND (k2 IS NULL OR k2 <> 'LANDED')""",
    "flight_events"))
def never_landed(spark, sf):
    return events.departed_never_landed(s.flight_events(spark, sf), ("event_timestamp", "event_id")).select("event_id", "icao24")


_SAMPLES = """
    SELECT departed_event_id, step, step / 10.0::DOUBLE AS fraction, lat1 + step / 10.0::DOUBLE * (lat2 - lat1) AS latitude,
           lon1 + step / 10.0::DOUBLE * (lon2 - lon1) AS longitude, departed_event_id * 100 + step AS pid
    FROM pairs, (SELECT unnest(generate_series(0, 10)) AS step)"""


@query("route_samples", s.with_views(
    "SELECT departed_event_id, step, fraction, latitude, longitude FROM samples", "hist_events", pairs=_PAIRS, samples=_SAMPLES))
def route_samples(spark, sf):
    return crossings.route_samples(flight_pairs(spark, sf)).select("departed_event_id", "step", "fraction", "latitude", "longitude")


_STAYS = {
    "pairs": _PAIRS, "samples": _SAMPLES, "edges": _EDGES, "hits": _containing("samples", "pid"),
    "seen": """SELECT departed_event_id, step, t.id AS tid, t.name AS name, lag(t.id) OVER w AS t0
               FROM samples JOIN hits USING (pid) WHERE level = 'COUNTRY' WINDOW w AS (PARTITION BY departed_event_id ORDER BY step)""",
    "stays": """SELECT departed_event_id, tid, name, step AS entry_step, coalesce(lead(step) OVER w, 10) AS exit_step,
                       row_number() OVER w - 1 AS place, count(*) OVER (PARTITION BY departed_event_id) AS countries
                FROM seen WHERE t0 IS NULL OR t0 <> tid WINDOW w AS (PARTITION BY departed_event_id ORDER BY step)""",
}


@query("route_stays", s.with_views(
    "SELECT departed_event_id, tid AS territory_id, name AS territory_name, place, countries, entry_step, exit_step FROM stays",
    "hist_events", "boxes", **_STAYS))
def route_stays(spark, sf):
    return crossings.route_stays(flight_pairs(spark, sf), _index(spark, sf))


_ROUTE_CROSSINGS = f"""
    SELECT CASE WHEN place > 0 AND place = countries - 1 THEN landed_event_id ELSE departed_event_id END AS flight_event_id, icao24, callsign,
           'COUNTRY' AS territory_type, tid AS territory_id, name AS territory_name,
           CASE WHEN place = 0 THEN 'START' WHEN place = countries - 1 THEN 'END' ELSE 'ROUTE' END AS crossing_role,
           'COMPLETED' AS flight_status,
           CASE WHEN us > 0 THEN make_timestamp(epoch_us(firstseen) + (2 * entry_step * us + 10) // 20) ELSE firstseen END AS entered_at,
           CASE WHEN us > 0 THEN make_timestamp(epoch_us(firstseen) + (2 * exit_step * us + 10) // 20) ELSE lastseen END AS exited_at,
           CASE WHEN us > 0 THEN {s.half_up('((exit_step - entry_step) * us)', '600000000', 2)} END AS duration_minutes
    FROM (SELECT *, epoch_us(lastseen) - epoch_us(firstseen) AS us FROM pairs JOIN stays USING (departed_event_id))"""


@query("route_crossings", s.with_views(
    f"SELECT * REPLACE ({s.ts_text('entered_at')} AS entered_at, {s.ts_text('exited_at')} AS exited_at), "
    "CAST(CAST(entered_at AS DATE) AS VARCHAR) AS entered_date FROM rc", "hist_events", "boxes", **_STAYS, rc=_ROUTE_CROSSINGS))
def route_crossings(spark, sf):
    run = F.lit("2024-02-01 00:00:00").cast("timestamp")
    return crossings.route_crossings(flight_pairs(spark, sf), _index(spark, sf), run).select(
        "flight_event_id", "icao24", "callsign", "territory_type", "territory_id", "territory_name", "crossing_role",
        "flight_status", "entered_at", "entered_date", "exited_at", "duration_minutes")
