"""Serving, dimension and feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from flightlake import schema
from flightlake.functions import geometry, measure
from flightlake.operators import dims, features, serve
from flightlake.queries import standins as s
from flightlake.queries.event_queries import once
from flightlake.queries.registry import query
from flightlake.sources import messages, positions

DAY = s.LAST_DAY
_LATEST = f"""
    SELECT icao24, coalesce(nullif(callsign, ''), icao24) AS callsign, latitude, longitude, altitude_ft, event_type,
           event_timestamp AS updated_at, 'batch' AS source
    FROM flight_events WHERE NOT on_ground AND {{day}}
    QUALIFY row_number() OVER (PARTITION BY icao24 ORDER BY event_timestamp DESC, event_id DESC) = 1"""
_ALL, _TODAY = _LATEST.format(day="true"), _LATEST.format(day=f"event_date = DATE '{DAY}'")


def _positions(spark, sf, day=None):
    wide = s.flight_events(spark, sf).withColumns({"velocity_kmh": F.lit(None).cast("double"), "heading_deg": F.lit(None).cast("double")})
    return serve.latest_positions(wide, day, order=("event_timestamp", "event_id")).drop("velocity_kmh", "heading_deg")


@query("latest_position", s.with_views(f"SELECT * REPLACE ({s.ts_text('updated_at')} AS updated_at) FROM p", "flight_events", p=_TODAY))
def latest_position(spark, sf):
    return _positions(spark, sf, DAY)


@query("live_board", s.with_views(
    "SELECT icao24, callsign, CASE WHEN altitude_ft IS NULL OR altitude_ft = 0 THEN '—' ELSE CAST(floor(altitude_ft / 100 + 0.5) * 100 AS BIGINT) || ' ft' END AS altitude_shown, "
    "row_number() OVER (ORDER BY coalesce(altitude_ft, 0) DESC, icao24) AS place FROM p ORDER BY place LIMIT 25", "flight_events", p=_ALL))
def live_board(spark, sf):
    top = serve.live_board(_positions(spark, sf)).limit(25)
    ordered = F.struct((-F.coalesce("altitude_ft", F.lit(0.0))).alias("a"), F.col("icao24").alias("i"))
    listed = top.agg(F.array_sort(F.collect_list(F.struct(ordered.alias("o"), "callsign", "altitude_shown"))).alias("l"))
    return listed.select(F.posexplode("l").alias("at", "c")).select(
        F.col("c.o.i").alias("icao24"), "c.callsign", "c.altitude_shown", (F.col("at") + 1).alias("place"))


@query("flight_search", s.with_views(
    "SELECT event_id, icao24, callsign FROM flight_events WHERE contains(lower(coalesce(callsign, '')), 'l7') OR contains(lower(icao24), 'l7')", "flight_events"))
def flight_search(spark, sf):
    return serve.search(s.flight_events(spark, sf), "L7").select("event_id", "icao24", "callsign")


@query("stale_keys", s.with_views(
    f"SELECT DISTINCT icao24 FROM flight_events WHERE event_date < DATE '{DAY}' AND icao24 NOT IN (SELECT icao24 FROM flight_events WHERE event_date = DATE '{DAY}')", "flight_events"))
def stale_keys(spark, sf):
    events, day = s.flight_events(spark, sf), F.lit(DAY).cast("date")
    return serve.gone_keys(events.filter(F.col("event_date") < day), events.filter(F.col("event_date") == day))


@query("daily_stats", s.with_views(f"""
    SELECT count(DISTINCT icao24) AS unique_aircraft, count(*) AS total_events, count(*) FILTER (WHERE event_type = 'DEPARTED') AS departures,
           count(*) FILTER (WHERE event_type = 'LANDED') AS landings, count(*) FILTER (WHERE event_type = 'CRUISING') AS cruising,
           coalesce({s.half_up('(count(origin_iata) * 100)', 'count(*)', 1)}, 0) AS enrichment_pct
    FROM flight_events WHERE event_date = DATE '{DAY}'""", "flight_events"))
def daily_stats(spark, sf):
    return serve.daily_stats(s.flight_events(spark, sf), DAY)


_DIMENSION = """
    SELECT 'COUNTRY' AS territory_type, id AS territory_id, CAST(y0 + 15 AS DOUBLE) AS lat, CAST(x0 + 30 AS DOUBLE) AS lon FROM boxes
    UNION ALL SELECT 'STATE', id + 1000, CAST(y0 + 15 AS DOUBLE), CAST(x0 + 30 AS DOUBLE) FROM boxes"""


def _territories(spark, sf):
    b = s.boundaries(spark, sf).withColumn("c", geometry.centroid(geometry.wkt_edges("wkt"))).withColumns(
        {"centroid_lat": F.col("c.lat"), "centroid_lon": F.col("c.lon")})
    side = lambda kind, key, name: b.filter(F.col("level") == kind).select(
        F.col("territory_id").alias(key), F.col("territory_name").alias(name), "centroid_lat", "centroid_lon")
    return serve.territories(side("COUNTRY", "country_id", "country_name"), side("STATE", "state_id", "state_name"))


def _located(spark, sf):
    return serve.located_crossings(s.crossings(spark, sf), _territories(spark, sf))


@query("territory_lookup_poly", s.with_views(
    "SELECT crossing_id, c.territory_type, c.territory_id, round(lat, 6) AS entered_lat, round(lon, 6) AS entered_lon FROM crossings c "
    "LEFT JOIN d ON d.territory_type = c.territory_type AND d.territory_id = c.territory_id", "crossings", "boxes", d=_DIMENSION))
def territory_lookup_poly(spark, sf):
    return _located(spark, sf).select("crossing_id", "territory_type", "territory_id",
                                      F.round("entered_lat", 6).alias("entered_lat"), F.round("entered_lon", 6).alias("entered_lon"))


@query("crossings_nested", s.with_views(
    "SELECT c.icao24, any_value(coalesce(h.callsign, h.icao24)) AS callsign, CAST(c.entered_date AS VARCHAR) AS entered_date, hour(entered_at) AS page, count(*) AS crossing_count, "
    "string_agg(crossing_id || ':' || territory_name || ':' || crossing_role, ',' ORDER BY entered_at, crossing_id) AS crossings FROM crossings c "
    "JOIN heads h ON h.icao24 = c.icao24 AND h.entered_date = c.entered_date GROUP BY c.icao24, c.entered_date, hour(entered_at)", "crossings",
    heads="SELECT DISTINCT ON (icao24, entered_date) icao24, entered_date, callsign FROM crossings ORDER BY icao24, entered_date, entered_at, crossing_id"))
def crossings_nested(spark, sf):
    doc = serve.flight_documents(_located(spark, sf))
    return doc.withColumn("crossings", F.array_join(F.transform("crossings", lambda c: F.concat_ws(":", c["crossing_id"].cast("string"), c["territory_name"], c["crossing_role"])), ","))


@query("crossings_flat", s.with_views(
    f"SELECT icao24, crossing_id, territory_name, {s.ts_text('entered_at')} AS entered_at, CAST(duration_minutes AS DOUBLE) AS duration_minutes FROM crossings", "crossings"))
def crossings_flat(spark, sf):
    return serve.flat_crossings(serve.flight_documents(_located(spark, sf))).select("icao24", "crossing_id", "territory_name", "entered_at", "duration_minutes")


@query("crossings_json", s.with_views(
    "SELECT crossing_id, icao24, strftime(entered_at, '%Y-%m-%dT%H:%M:%S.%f') AS entered_at, strftime(exited_at, '%Y-%m-%dT%H:%M:%S.%f') AS exited_at, "
    "CAST(duration_minutes AS DOUBLE) AS duration_minutes FROM crossings", "crossings"))
def crossings_json(spark, sf):
    """JSON documents, read back."""
    body = "struct<icao24:string,callsign:string,crossings:array<struct<crossing_id:bigint,entered_at:string,exited_at:string,duration_minutes:double>>>"
    read = serve.documents_json(serve.flight_documents(_located(spark, sf))).select(F.from_json("document", body).alias("d"))
    return read.select("d.icao24", F.explode("d.crossings").alias("c")).select("c.crossing_id", "icao24", "c.entered_at", "c.exited_at", "c.duration_minutes")


@query("trail_stats", s.with_views(
    "SELECT count(DISTINCT icao24) AS flights, count(*) AS total_crossings, count(DISTINCT territory_name) FILTER (WHERE territory_type = 'COUNTRY') AS countries, "
    "count(DISTINCT territory_name) FILTER (WHERE territory_type = 'STATE') AS states FROM crossings", "crossings"))
def trail_stats(spark, sf):
    return serve.trail_stats(s.crossings(spark, sf))


@query("trail_view", s.with_views("""
    SELECT crossing_id, CASE WHEN crossing_role = 'START' THEN 'DEP' WHEN crossing_role = 'END' THEN 'ARR' WHEN territory_type = 'STATE' THEN 'ST' ELSE 'CO' END AS pin,
           CASE WHEN m IS NULL OR m = 0 THEN '—' WHEN floor(m / 60) > 0 THEN CAST(floor(m / 60) AS BIGINT) || 'h ' || CAST(floor(m - floor(m / 60) * 60 + 0.5) AS BIGINT) || 'm'
                ELSE CAST(floor(m - floor(m / 60) * 60 + 0.5) AS BIGINT) || 'm' END AS duration_shown,
           flight_status = 'IN_PROGRESS' AND exited_at IS NULL AS is_current
    FROM (SELECT *, CAST(duration_minutes AS DOUBLE) AS m FROM crossings)""", "crossings"))
def trail_view(spark, sf):
    return serve.trail_view(s.crossings(spark, sf)).select("crossing_id", "pin", "duration_shown", "is_current")


@query("route_trail", s.with_views(
    f"SELECT territory_name, territory_type, crossing_role, CAST(duration_minutes AS DOUBLE) AS duration_minutes, {s.ts_text('entered_at')} AS entered_at "
    "FROM crossings c JOIN hist_events e ON e.event_id = c.flight_event_id WHERE e.origin_iata = 'I21' AND e.destination_iata = 'I3'", "crossings"))
def route_trail(spark, sf):
    return serve.route_trail(s.crossings(spark, sf), s.hist_events(spark, sf), "I21", "I3")


@query("live_trail", s.with_views(
    "SELECT crossing_id, c.icao24, p.latitude AS live_lat, p.longitude AS live_lon, p.altitude_ft AS live_altitude_ft, p.event_type AS live_event_type, "
    "p.icao24 IS NOT NULL AS is_live FROM crossings c LEFT JOIN p ON p.icao24 = c.icao24", "crossings", p=_TODAY))
def live_trail(spark, sf):
    return serve.live_trail(s.crossings(spark, sf).select("crossing_id", "icao24"), _positions(spark, sf, DAY))


# Dimensions --------------------------------------------------------------------------------

_PREFIXES = """
    SELECT chr(65 + n_nationkey) AS key, chr(65 + n_nationkey) || chr(65 + n_nationkey % 7) AS value FROM nation
    UNION ALL SELECT chr(65 + n_nationkey) || chr(66 + n_nationkey % 5), chr(65 + (n_nationkey + 1) % 25) || chr(65 + ((n_nationkey + 1) % 25) % 7) FROM nation
    UNION ALL SELECT chr(65 + n_nationkey) || 'XY', 'ZZZ' FROM nation"""
_ISO_NAMES = "SELECT chr(65 + n_nationkey) || chr(65 + n_nationkey % 7) AS key, n_name AS value FROM nation WHERE n_regionkey <> 4"
_REGISTERED = """
    SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL WHEN c_mktsegment = 'MACHINERY' THEN chr(CAST(65 + c_custkey % 25 AS INTEGER)) || '-' || c_custkey
        WHEN c_mktsegment = 'FURNITURE' THEN chr(CAST(65 + c_custkey % 25 AS INTEGER)) || 'XY' || c_custkey
        ELSE ' ' || chr(CAST(65 + c_custkey % 25 AS INTEGER)) || chr(CAST(65 + (c_custkey // 25) % 25 AS INTEGER)) || c_custkey || ' ' END AS registration FROM customer"""


def _letter(n):
    return F.char(F.lit(65) + n)


@query("prefix_country", s.with_views("""
    SELECT c_custkey, CASE WHEN length(iso) <= 2 THEN iso END AS country_iso2, n.value AS country_of_reg FROM (
        SELECT c_custkey, CASE WHEN contains(r, '-') THEN (SELECT value FROM pre WHERE key = split_part(r, '-', 1))
            ELSE coalesce((SELECT value FROM pre WHERE key = substr(r, 1, 3)), (SELECT value FROM pre WHERE key = substr(r, 1, 2)), (SELECT value FROM pre WHERE key = substr(r, 1, 1))) END AS iso
        FROM (SELECT c_custkey, trim(registration) AS r FROM reg)) x LEFT JOIN nm n ON n.key = CASE WHEN length(iso) <= 2 THEN iso END""",
    pre=_PREFIXES, nm=_ISO_NAMES, reg=_REGISTERED))
def prefix_country(spark, sf):
    n, k = s.table(spark, sf, "nation"), F.col("n_nationkey")
    iso = lambda c: F.concat(_letter(c), _letter(c % 7))
    prefixes = (
        n.select(_letter(k).alias("key"), iso(k).alias("value"))
        .unionByName(n.select(F.concat(_letter(k), _letter(k % 5 + 1)).alias("key"), iso((k + 1) % 25).alias("value")))
        .unionByName(n.select(F.concat(_letter(k), F.lit("XY")).alias("key"), F.lit("ZZZ").alias("value")))
    )
    names = n.filter(F.col("n_regionkey") != 4).select(iso(k).alias("key"), F.col("n_name").alias("value"))
    c, seg = F.col("c_custkey"), F.col("c_mktsegment")
    first, number = _letter(c % 25), c.cast("string")
    registered = s.table(spark, sf, "customer").select("c_custkey", F.when(seg == "BUILDING", F.lit(None)).when(
        seg == "MACHINERY", F.concat(first, F.lit("-"), number)).when(seg == "FURNITURE", F.concat(first, F.lit("XY"), number)).otherwise(
        F.concat(F.lit(" "), first, _letter(F.floor(c / 25) % 25), number, F.lit(" "))).alias("registration"))
    found = dims.with_country_of_registration(registered, dims.lookup(prefixes, "key", "value"), dims.lookup(names, "key", "value"))
    return found.select("c_custkey", "country_iso2", "country_of_reg")


@query("lookup_codes", s.with_views(
    "SELECT last_seen, r.icao24, o.iata AS origin_iata, d.iata AS destination_iata FROM records r LEFT JOIN codes o ON o.icao = r.dep LEFT JOIN codes d ON d.icao = r.arr",
    "airports", "records", "codes"))
def lookup_codes(spark, sf):
    from flightlake.operators.events import with_route_codes

    coded = with_route_codes(s.flight_records(spark, sf), s.airports(spark, sf), "estDepartureAirport", "estArrivalAirport")
    return coded.select(F.col("lastSeen").alias("last_seen"), "icao24", "origin_iata", "destination_iata")


_STATE_CODES = """
    SELECT s_suppkey, CASE s_nationkey % 6 WHEN 0 THEN 'ABW' WHEN 1 THEN 'HKG' WHEN 2 THEN 'NGA' WHEN 3 THEN 'XXX' WHEN 4 THEN 'GUM' END AS code FROM supplier"""
_COUNTRY_CODES = "SELECT n_nationkey, CASE n_regionkey WHEN 0 THEN 'ANT' WHEN 1 THEN 'CHN' WHEN 2 THEN 'NGA' WHEN 3 THEN 'KEN' END AS iso3 FROM nation"


def _codes(spark, sf):
    n = F.col("s_nationkey") % 6
    states = s.table(spark, sf, "supplier").select("s_suppkey", F.when(n == 0, "ABW").when(n == 1, "HKG").when(n == 2, "NGA").when(n == 3, "XXX").when(n == 4, "GUM").alias("code"))
    r = F.col("n_regionkey")
    countries = s.table(spark, sf, "nation").select(F.when(r == 0, "ANT").when(r == 1, "CHN").when(r == 2, "NGA").when(r == 3, "KEN").alias("iso3"))
    return states, countries


@query("iso3_remap", s.with_views(
    "SELECT s_suppkey, CASE WHEN m IN (SELECT iso3 FROM cc WHERE iso3 IS NOT NULL) THEN m END AS code FROM "
    "(SELECT s_suppkey, CASE code WHEN 'ABW' THEN 'ANT' WHEN 'HKG' THEN 'CHN' WHEN 'GUM' THEN 'USA' ELSE code END AS m FROM sc)", sc=_STATE_CODES, cc=_COUNTRY_CODES))
def iso3_remap(spark, sf):
    states, countries = _codes(spark, sf)
    return dims.with_known_iso3(states, dims.iso3_table(spark), countries, "code").select("s_suppkey", "code")


@query("iso3_missing", s.with_views(
    "SELECT DISTINCT code FROM sc WHERE code IS NOT NULL EXCEPT SELECT iso3 FROM cc", sc=_STATE_CODES, cc=_COUNTRY_CODES))
def iso3_missing(spark, sf):
    states, countries = _codes(spark, sf)
    return dims.missing_iso3(states, countries, "code")


@query("first_wins", s.with_views(
    "SELECT icao24, event_id, event_type FROM flight_events QUALIFY row_number() OVER (PARTITION BY icao24 ORDER BY event_timestamp, event_id) = 1", "flight_events"))
def first_wins(spark, sf):
    rows = s.flight_events(spark, sf).select("icao24", "event_id", "event_type", "event_timestamp")
    return dims.first_wins(rows, ("icao24",), ("event_timestamp", "event_id")).drop("event_timestamp")


@query("load_counts", s.with_views(
    "SELECT count(*) AS total, count(airport_iata_code) AS with_iata, count(*) FILTER (WHERE is_commercial) AS commercial, "
    "count(airport_iata_code) - count(DISTINCT airport_iata_code) AS repeated_iata FROM airports", "airports"))
def load_counts(spark, sf):
    return dims.airport_load_counts(s.airports(spark, sf))


@query("airport_sample", s.with_views(
    "SELECT airport_iata_code, airport_name, iso_country FROM airports WHERE iso_country IN ('N1', 'N4', 'N9') AND is_commercial ORDER BY iso_country, airport_name LIMIT 10", "airports"))
def airport_sample(spark, sf):
    listed = dims.sample_listing(s.airports(spark, sf).filter("is_commercial"), "iso_country", ["N1", "N4", "N9"], ["iso_country", "airport_name"])
    return listed.select("airport_iata_code", "airport_name", "iso_country")


@query("distinct_keys", "SELECT count(DISTINCT user_id) AS distinct_keys FROM events")
def distinct_keys(spark, sf):
    return dims.distinct_keys(s.flight_events(spark, sf), "icao24")


# Messages and positions --------------------------------------------------------------------

@query("messages_round_trip", s.with_views(
    f"SELECT icao24, callsign, event_type, {s.ts_text('event_timestamp')} AS event_timestamp, latitude, longitude, altitude_ft, on_ground FROM flight_events", "flight_events"))
def messages_round_trip(spark, sf):
    wide = s.flight_events(spark, sf).withColumns({"velocity_kmh": F.lit(None).cast("double"), "heading_deg": F.lit(None).cast("double")})
    back = messages.from_messages(messages.to_messages(wide))
    return back.select("icao24", "callsign", "event_type", "event_timestamp", "latitude", "longitude", "altitude_ft", "on_ground")


_M = "CAST(value * 100 AS DECIMAL(18,6))"


@query("parse_positions", f"""
    SELECT CAST(user_id AS VARCHAR) AS icao24, CASE WHEN event_type <> 'click' THEN 'FL' || user_id END AS callsign,
           CAST((event_id * 37) % 360 - 180 + 0.5 AS DOUBLE) AS longitude, CAST((event_id * 53) % 180 - 90 + 0.5 AS DOUBLE) AS latitude,
           CASE WHEN event_type <> 'view' THEN CAST(round({_M} * 3.28084, 1) AS DOUBLE) END AS altitude_ft, event_type IN ('signup', 'error') AS on_ground,
           CAST(round({_M} * 3.6, 1) AS DOUBLE) AS velocity_kmh, CAST(round({_M} * 196.85, 1) AS DOUBLE) AS vertical_rate_fpm,
           CAST(90 AS DOUBLE) AS heading_deg, {s.ts_text("date_trunc('second', ts)")} AS "timestamp"
    FROM events WHERE event_type <> 'purchase'
      AND (event_id * 53) % 180 - 90 + 0.5 BETWEEN -35 AND 37 AND (event_id * 37) % 360 - 180 + 0.5 BETWEEN -17 AND 60""")
def parse_positions(spark, sf):
    """Events packed into position documents and read back; purchases give slot lists that are too short."""
    e, n, kind = s.table(spark, sf, "events"), F.col("event_id"), F.col("event_type")
    metres = (F.col("value") * 100).cast("string")
    text = lambda v: F.lit(v).cast("string")
    slots = F.array(
        F.col("user_id").cast("string"), F.when(kind != "click", F.concat(F.lit("FL"), F.col("user_id").cast("string"), F.lit("  "))).otherwise("  "),
        text("X"), text(None), text(None), ((n * 37) % 360 - 180 + 0.5).cast("string"), ((n * 53) % 180 - 90 + 0.5).cast("string"),
        F.when(kind != "view", metres), kind.isin("signup", "error").cast("string"), metres, text("90"), metres, text(None))
    states = F.array(F.when(kind == "purchase", F.slice(slots, 1, 5)).otherwise(slots))
    docs = e.select(F.to_json(F.struct(F.unix_timestamp(F.col("ts").cast("timestamp")).alias("time"), states.alias("states")), {"ignoreNullFields": "false"}).alias("value"))
    return positions.parse_positions(docs, box=geometry.COVERAGE)


@query("hostile_numbers", f"""
    SELECT event_id, CASE WHEN event_id % 4 = 1 OR event_id % 4 = 2 THEN NULL ELSE CAST(round({_M} * 3.28084, 1) AS DOUBLE) END AS altitude_ft,
           CASE WHEN event_id % 4 = 1 THEN NULL ELSE CAST(round({_M} * 3.6, 1) AS DOUBLE) END AS velocity_kmh,
           CASE WHEN event_id % 5 = 0 THEN NULL ELSE 90.0 END AS stay_minutes
    FROM events""")
def hostile_numbers(spark, sf):
    """Numbers beyond any range, texts that are none, and stays of years are unknown, and no row is lost over them."""
    n, ts, metres = F.col("event_id"), F.col("ts").cast("timestamp"), (F.col("value") * 100).cast("string")
    height = F.when(n % 4 == 1, "1e30").when(n % 4 == 2, "12,5 m").otherwise(metres)
    speed = F.when(n % 4 == 1, "-9e13").otherwise(metres)
    over = F.when(n % 5 == 0, ts + F.make_ym_interval(years=F.lit(9))).otherwise(ts + F.make_dt_interval(mins=F.lit(90)))
    return s.table(spark, sf, "events").select(
        n, measure.feet(height.try_cast("double")).alias("altitude_ft"), measure.kmh(speed.try_cast("double")).alias("velocity_kmh"),
        measure.stay_minutes(ts, over).alias("stay_minutes"))


# Features ----------------------------------------------------------------------------------

_ONE_AIRPORT = "SELECT airport_iata_code, iso_country, longitude_deg AS lon, latitude_deg AS lat FROM airports WHERE airport_iata_code IS NOT NULL QUALIFY row_number() OVER (PARTITION BY airport_iata_code ORDER BY CASE WHEN is_commercial THEN 0 ELSE 1 END, ident) = 1"


@query("features_basic", s.with_views("""
    SELECT event_id, f.icao24, callsign, CAST(event_date AS VARCHAR) AS flight_date, origin_iata, destination_iata, airline_iata, weight_category, icao_aircraft_type,
           hour(event_timestamp) AS departure_hour, isodow(event_timestamp) AS departure_day_of_week,
           coalesce(o.iso_country <> d.iso_country, false) AS is_international,
           CAST(round(CAST((year(event_date) - year(first_flight_date)) * 12 + month(event_date) - month(first_flight_date)
             + CASE WHEN day(event_date) = day(first_flight_date) OR (event_date = last_day(event_date) AND first_flight_date = last_day(first_flight_date)) THEN 0
                    ELSE (day(event_date) - day(first_flight_date)) / 31.0 END AS DECIMAL(12,6)) / 12, 1) AS DOUBLE) AS aircraft_age_years
    FROM hist_events f LEFT JOIN aircraft a ON a.icao24 = f.icao24 LEFT JOIN one o ON o.airport_iata_code = f.origin_iata
    LEFT JOIN one d ON d.airport_iata_code = f.destination_iata WHERE event_type = 'DEPARTED'""", "hist_events", "aircraft", "airports", one=_ONE_AIRPORT))
def features_basic(spark, sf):
    return features.flight_features(s.hist_events(spark, sf), s.aircraft(spark, sf), s.airports(spark, sf))


@query("congestion", s.with_views(f"""
    SELECT d.event_id, d.origin_iata, CAST(count(DISTINCT p.icao24) AS DOUBLE) AS origin_congestion_score
    FROM (SELECT *, CAST(event_timestamp AS DATE) AS poll FROM flight_events WHERE event_type = 'DEPARTED') d
    LEFT JOIN (SELECT a.airport_iata_code, x.icao24, CAST(x.event_timestamp AS DATE) AS poll FROM flight_events x, one a
        WHERE {2 * geometry.EARTH_RADIUS_KM} * asin(sqrt(least(1.0, power(sin(radians(a.lat - x.latitude) / 2), 2)
              + cos(radians(x.latitude)) * cos(radians(a.lat)) * power(sin(radians(a.lon - x.longitude) / 2), 2)))) <= 600) p
      ON p.poll = d.poll AND p.airport_iata_code = d.origin_iata GROUP BY d.event_id, d.origin_iata""", "flight_events", "airports", one=_ONE_AIRPORT))
def congestion(spark, sf):
    """Aircraft within 600 km on the same day: the test positions are too sparse for one poll."""
    events = s.flight_events(spark, sf).withColumn("poll", F.col("event_date"))
    departed = events.filter(F.col("event_type") == "DEPARTED").select("event_id", "origin_iata", "poll")
    discs = once(spark, sf, "congestion", lambda: features.build_discs(s.airports(spark, sf), near_km=600.0))
    return features.congestion(departed, events, discs).drop("poll")


@query("delay_class", """
    SELECT event_id, CASE WHEN p < 0.30 THEN 'ON_TIME' WHEN p < 0.65 THEN 'MINOR_DELAY' WHEN p >= 0.65 THEN 'MAJOR_DELAY' END AS predicted_delay_class
    FROM (SELECT event_id, (event_id % 100) / 100.0::DOUBLE AS p FROM events)""")
def delay_class(spark, sf):
    scored = s.flight_events(spark, sf).select("event_id", (F.col("event_id") % 100 / 100).alias("delay_probability"))
    return features.with_delay_class(scored).drop("delay_probability")


_DELAYS = """
    SELECT CAST(l_shipdate AS DATE) AS flight_date, l_returnflag AS airline_iata, 'S' || l_suppkey % 10 AS origin_iata, 'P' || l_partkey % 10 AS destination_iata,
           CAST(l_quantity - 10 AS DECIMAL(6,1)) AS departure_delay_min, CAST(l_quantity - 8 AS DECIMAL(6,1)) AS arrival_delay_min,
           CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS DECIMAL(6,1)) END AS carrier, CAST(l_discount * 100 AS DECIMAL(6,1)) AS weather,
           CAST(l_tax * 100 AS DECIMAL(6,1)) AS nas, CASE WHEN l_linenumber = 1 THEN CAST(1 AS DECIMAL(6,1)) END AS security, CAST(l_linenumber AS DECIMAL(6,1)) AS late
    FROM lineitem"""


def delays(spark, sf):
    """Order lines as delay records."""
    tenth = lambda c: c.cast("decimal(6,1)")
    q = F.col("l_quantity")
    return s.table(spark, sf, "lineitem").select(
        F.to_date("l_shipdate").alias("flight_date"), F.col("l_returnflag").alias("airline_iata"),
        F.concat(F.lit("S"), (F.col("l_suppkey") % 10).cast("string")).alias("origin_iata"),
        F.concat(F.lit("P"), (F.col("l_partkey") % 10).cast("string")).alias("destination_iata"),
        tenth(q - 10).alias("departure_delay_min"), tenth(q - 8).alias("arrival_delay_min"),
        F.when(F.col("l_linestatus") == "O", tenth(q)).alias("delay_carrier_min"), tenth(F.col("l_discount") * 100).alias("delay_weather_min"),
        tenth(F.col("l_tax") * 100).alias("delay_nas_min"), F.when(F.col("l_linenumber") == 1, tenth(F.lit(1))).alias("delay_security_min"),
        tenth(F.col("l_linenumber")).alias("delay_late_aircraft_min"))


_SHARE = lambda c: s.half_up(f"CAST(sum(coalesce({c}, 0)) * 10 AS BIGINT)", "CAST(sum(coalesce(carrier, 0) + coalesce(weather, 0) + coalesce(nas, 0) + coalesce(security, 0) + coalesce(late, 0)) * 10 AS BIGINT)", 4)


@query("delay_causes", s.with_views(
    f"SELECT airline_iata, origin_iata, destination_iata, count(*) AS flights, count(*) FILTER (WHERE arrival_delay_min > 15) AS late_flights, {_SHARE('carrier')} AS carrier_share, "
    f"{_SHARE('weather')} AS weather_share, {_SHARE('nas')} AS nas_share, {_SHARE('security')} AS security_share, {_SHARE('late')} AS late_aircraft_share "
    "FROM dl GROUP BY 1, 2, 3", dl=_DELAYS))
def delay_causes(spark, sf):
    return features.delay_causes(delays(spark, sf), ["airline_iata", "origin_iata", "destination_iata"])


@query("delay_attach", s.with_views(f"""
    SELECT o_orderkey, airline_iata, origin_iata, destination_iata, CAST(flight_date AS VARCHAR) AS flight_date, f.d AS departure_delay_min FROM (
        SELECT o_orderkey, substr('ANR', CAST(o_custkey % 3 + 1 AS BIGINT), 1) AS airline_iata, 'S' || o_custkey % 10 AS origin_iata, 'P' || o_orderkey % 10 AS destination_iata,
               CAST(o_orderdate AS DATE) AS flight_date FROM orders) o
    LEFT JOIN (SELECT airline_iata, origin_iata, destination_iata, flight_date, {s.half_up('CAST(sum(departure_delay_min) * 10 AS BIGINT)', '(count(*) * 10)', 1)} AS d FROM dl GROUP BY 1, 2, 3, 4) f
    USING (airline_iata, origin_iata, destination_iata, flight_date)""", dl=_DELAYS))
def delay_attach(spark, sf):
    cust, n = F.col("o_custkey"), F.col("o_orderkey")
    flown = s.table(spark, sf, "orders").select(
        "o_orderkey", F.when(cust % 3 == 0, "A").when(cust % 3 == 1, "N").otherwise("R").alias("airline_iata"),
        F.concat(F.lit("S"), (cust % 10).cast("string")).alias("origin_iata"), F.concat(F.lit("P"), (n % 10).cast("string")).alias("destination_iata"),
        F.to_date("o_orderdate").alias("flight_date"))
    return features.with_us_delay(flown, delays(spark, sf))


@query("delay_typing", """
    SELECT l_orderkey, l_linenumber, l_returnflag = 'R' AS is_cancelled, l_linestatus = 'F' AS is_diverted,
           CASE WHEN l_partkey % 60 < 60 THEN (l_suppkey % 24) * 60 + l_partkey % 60 END AS dep_minutes, CAST(l_quantity AS BIGINT) AS distance_miles
    FROM lineitem""")
def delay_typing(spark, sf):
    """Order lines as on-time performance texts, typed."""
    line = s.table(spark, sf, "lineitem")
    text = {f.name: F.lit(None).cast("string") for f in schema.US_DELAY}
    text.update(
        is_cancelled=F.when(F.col("l_returnflag") == "R", "1.00").otherwise("0.00"), is_diverted=F.when(F.col("l_linestatus") == "F", "1").otherwise("0"),
        scheduled_dep_time=((F.col("l_suppkey") % 24) * 100 + F.col("l_partkey") % 60).cast("string"), distance_miles=F.col("l_quantity").cast("string"),
        flight_number=F.col("l_orderkey").cast("string"), air_time_min=F.col("l_linenumber").cast("string"))
    typed = features.typed_us_delays(line.select(*[c.alias(n) for n, c in text.items()]))
    return typed.select(
        F.col("flight_number").alias("l_orderkey"), F.col("air_time_min").alias("l_linenumber"), "is_cancelled", "is_diverted",
        measure.hhmm_to_minutes("scheduled_dep_time").alias("dep_minutes"), "distance_miles")
