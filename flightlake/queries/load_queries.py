"""Files to reference tables, loads under their real rules, and the dual write. Files are written from the given tables and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from flightlake import schema
from flightlake.operators import dims, geo, quality, serve, silver
from flightlake.queries import standins as s
from flightlake.queries.registry import query
from flightlake.queries.stream_queries import _finish, _streamed
from flightlake.session import cut_lineage, prepare, workdir
from flightlake.sources import files, messages, tables
from flightlake.streaming import jobs, outbox


def _written(df, folder, name):
    path = f"{folder}/{name}"
    df.write.option("header", True).option("emptyValue", "").csv(path)
    return path


# Master files: customers as an aircraft list, suppliers as an airport list, nations as lookups --------

_PREFIXES = "SELECT n_nationkey AS k, chr(65 + n_nationkey) AS prefix, 'N' || chr(65 + n_nationkey) AS iso2, n_name AS name FROM nation"


def _lookups(spark, sf, folder):
    nations = s.table(spark, sf, "nation")
    letter = F.char(65 + F.col("n_nationkey"))
    prefixes = _written(nations.select(F.concat(F.lit(" "), letter).alias("Prefix"), F.concat(F.lit("N"), letter).alias("CountryISO2")), folder, "prefixes")
    names = _written(nations.select(F.concat(F.lit("N"), letter).alias("ISO"), F.concat("n_name", F.lit("  ")).alias("Name")), folder, "names")
    read = lambda path, columns: dims.lookup(files.lookup_file(spark, path, columns), *columns)
    return read(prefixes, files.PREFIX_FILE), read(names, files.COUNTRY_NAME_FILE)


@query("aircraft_load", s.with_views("""
    SELECT 'x' || c_custkey AS icao24, CASE WHEN c_custkey % 4 <> 3 THEN prefix || '-' || c_custkey ELSE prefix || '9' || c_custkey END AS registration,
           CASE WHEN c_custkey % 5 <> 0 THEN c_name END AS manufacturername,
           CASE WHEN c_custkey % 3 = 0 THEN 'B738' ELSE 'T' || c_custkey % 9 END AS icao_aircraft_type, c_mktsegment AS airline_name,
           CASE WHEN c_custkey % 6 = 0 THEN 'WN' ELSE 'C' || c_custkey % 7 END AS airline_iata,
           CASE WHEN c_custkey % 8 <> 0 THEN CAST(DATE '1990-01-01' + CAST((c_custkey * 37) % 9000 AS INTEGER) AS VARCHAR) END AS first_flight_date,
           iso2 AS country_iso2, name AS country_of_reg, true AS is_active
    FROM customer JOIN prefixes ON k = c_nationkey WHERE c_custkey % 11 <> 0""", prefixes=_PREFIXES))
def aircraft_load(spark, sf):
    """Aircraft list: ids in capitals, repeated rows, missing texts, over-long codes and dates in three formats."""
    folder = workdir(prepare(spark), "aircraft")
    k, n = F.col("c_custkey"), F.char(65 + F.col("c_nationkey"))
    day = F.date_add(F.lit("1990-01-01").cast("date"), ((k * 37) % 9000).cast("int"))
    first = F.when(k % 8 == 0, "nan").when((k % 3 == 0) | (F.dayofmonth(day) <= 12), F.date_format(day, "M/d/yyyy")).when(k % 3 == 1, F.date_format(day, "yyyy-MM-dd")).otherwise(F.date_format(day, "d/M/yyyy"))
    rows = s.table(spark, sf, "customer").select(
        F.when(k % 11 != 0, F.concat(F.lit(" X"), k.cast("string"))).alias(" ICAO24 "),
        F.when(k % 4 != 3, F.concat(n, F.lit("-"), k.cast("string"))).otherwise(F.concat(n, F.lit("9"), k.cast("string"))).alias("Registration"),
        F.when(k % 5 != 0, F.concat("c_name", F.lit(" "))).otherwise("None").alias("manufacturername"), F.lit("m").alias("model"), F.lit(None).cast("string").alias("typecode"),
        F.when(k % 3 == 0, "BOEING ICAO Manufacturer Code (BOEING) (B738)").otherwise(F.concat(F.lit("T"), (k % 9).cast("string"))).alias("icaoaircrafttype"),
        F.lit("NaN").alias("categorydescription"), F.col("c_mktsegment").alias("operator"), F.lit("").alias("operatorcallsign"), F.lit("AX").alias("operatoricao"),
        F.when(k % 6 == 0, "SWA\t Airline IATA Code WN").otherwise(F.concat(F.lit("C"), (k % 7).cast("string"))).alias("operatoriata"), F.lit("2").alias("engines"), first.alias("firstflightdate"),
    )
    again = rows.withColumns({"Registration": F.lit("ZZZZ"), "operator": F.lit("second")})
    # One file, as the place of a row in it decides which of a key is the first.
    path = _written(rows.unionByName(again).coalesce(1), folder, "list")
    loaded = dims.first_wins(dims.aircraft_rows(files.aircraft_file(spark, path), *_lookups(spark, sf, folder)), schema.AIRCRAFT_KEY)
    return loaded.select("icao24", "registration", "manufacturername", "icao_aircraft_type", "airline_name", "airline_iata", "first_flight_date", "country_iso2", "country_of_reg", "is_active")


@query("airport_load", s.with_views("""
    SELECT 'S' || s_suppkey AS ident, CASE WHEN s_suppkey % 8 <> 7 THEN 'I' || s_suppkey // 2 END AS airport_iata_code, s_name AS airport_name,
           'N' || chr(65 + s_nationkey) AS iso_country, 'NA' AS continent, CASE WHEN s_suppkey % 5 <> 0 THEN name END AS region_name, s_suppkey % 3 <> 0 AS is_commercial,
           CASE WHEN s_suppkey % 7 <> 0 THEN CAST(CAST(((s_suppkey * 29) % 180 - 90) + 0.25 AS DECIMAL(9,6)) AS DOUBLE) END AS latitude_deg,
           CAST(CAST((s_suppkey * 47) % 360 - 180 AS DECIMAL(9,6)) AS DOUBLE) AS longitude_deg
    FROM supplier JOIN prefixes ON k = s_nationkey""", prefixes=_PREFIXES))
def airport_load(spark, sf):
    """Airport list with the region names it looks up; 'NA' is a code, a latitude in words is unknown, the first of an ident counts."""
    folder = workdir(prepare(spark), "airports")
    k, letter = F.col("s_suppkey"), F.char(65 + F.col("s_nationkey"))
    cells = {
        "ident": F.concat(F.lit("S"), k.cast("string")), "type": F.lit("small_airport"), "name": F.col("s_name"),
        "latitude_deg": F.when(k % 7 != 0, ((k * 29) % 180 - 90 + 0.25).cast("string")).otherwise("north"), "longitude_deg": ((k * 47) % 360 - 180).cast("string"),
        "continent": F.lit("NA"), "iso_country": F.concat(F.lit("N"), letter), "iso_region": F.when(k % 5 != 0, F.concat(F.lit("R-"), letter)).otherwise("R-?"),
        "municipality": F.lit("a, \"b\""), "scheduled_service": F.when(k % 3 != 0, "Yes").otherwise("no"), "iata_code": F.when(k % 8 != 7, F.concat(F.lit("I"), F.floor(k / 2).cast("string"))),
    }
    rows = s.table(spark, sf, "supplier").select(*[cells.get(c, F.lit(None).cast("string")).alias(c) for c in files.AIRPORT_FILE])
    again = rows.withColumns({"name": F.lit("second"), "iata_code": F.lit("ZZZ")})
    path = _written(rows.unionByName(again).unionByName(again.withColumn("ident", F.lit(" "))).coalesce(1), folder, "list")
    regions = s.table(spark, sf, "nation").select(*[
        {"code": F.concat(F.lit("R-"), F.char(65 + F.col("n_nationkey"))), "name": F.col("n_name")}.get(c, F.lit(None).cast("string")).alias(c) for c in files.REGION_FILE])
    names = dims.lookup(files.lookup_file(spark, _written(regions, folder, "regions"), files.REGION_FILE), "code", "name")
    loaded = dims.first_wins(dims.airport_rows(files.airport_file(spark, path), names), schema.AIRPORT_KEY)
    return loaded.select("ident", "airport_iata_code", "airport_name", "iso_country", "continent", "region_name", "is_commercial", "latitude_deg", "longitude_deg")


# Boundaries: each nation is two boxes with a hole in the first, as one MULTIPOLYGON ------------------

def _shapes(spark, sf):
    k = F.col("n_nationkey")
    x, y = F.lit(-180) + (k % 5) * 72, F.lit(-90) + F.floor(k / 5).cast("int") * 36

    def ring(x0, y0, x1, y1):
        corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
        pairs = [F.concat((x + a).cast("string"), F.lit(" "), (y + b).cast("string")) for a, b in corners]
        return F.concat(F.lit("("), F.concat_ws(", ", *pairs), F.lit(")"))

    wkt = F.concat(F.lit("MULTIPOLYGON (("), ring(0, 0, 40, 30), F.lit(", "), ring(10, 10, 20, 20), F.lit("), ("), ring(50, 5, 60, 25), F.lit("))"))
    return s.table(spark, sf, "nation").select("n_nationkey", "n_name", wkt.alias("wkt"))


_COUNTRY_COLUMNS = ("ISO_A2", "ISO_A3", "NAME", "FORMAL_EN", "CONTINENT", "SUBREGION", "LABEL_X", "LABEL_Y", "POP_EST", "wkt")


def _boundary_files(spark, sf):
    folder = workdir(prepare(spark), "boundaries")
    k = F.col("n_nationkey")
    _shapes(spark, sf).select(
        F.when(k % 6 == 0, "-99").otherwise(F.concat(F.lit("N"), F.char(65 + k))).alias("ISO_A2"), F.concat(F.lit("N"), F.char(65 + k), F.lit("X")).alias("ISO_A3"),
        F.when(k % 9 != 8, F.col("n_name")).alias("NAME"), F.when(k % 2 == 0, F.concat(F.lit("Realm of "), "n_name")).otherwise(" ").alias("FORMAL_EN"),
        F.lit("nan").alias("CONTINENT"), F.lit("S").alias("SUBREGION"), k.cast("double").alias("LABEL_X"), (k * 2).cast("double").alias("LABEL_Y"),
        ((k - 3) * 1000.5).alias("POP_EST"), "wkt", F.lit("extra").alias("NOTE"),
    ).write.parquet(f"{folder}/countries")
    return files.boundary_table(spark, f"{folder}/countries", _COUNTRY_COLUMNS)


@query("boundary_load", """
    SELECT CASE WHEN n_nationkey % 6 <> 0 THEN 'N' || chr(65 + n_nationkey) END AS iso2, 'N' || chr(65 + n_nationkey) || 'X' AS iso3, n_name AS country_name,
           CASE WHEN n_nationkey % 2 = 0 THEN 'Realm of ' || n_name ELSE n_name END AS formal_name, CAST(NULL AS VARCHAR) AS continent,
           n_nationkey::DOUBLE AS centroid_lon, CASE WHEN n_nationkey > 3 THEN CAST(floor((n_nationkey - 3) * 1000.5) AS BIGINT) END AS population
    FROM nation WHERE n_nationkey % 9 <> 8""")
def boundary_load(spark, sf):
    """Countries out of a boundary file: placeholder codes, formal names, head counts; nameless rows go."""
    return dims.country_rows(_boundary_files(spark, sf)).select("iso2", "iso3", "country_name", "formal_name", "continent", "centroid_lon", "population")


@query("state_load", """
    SELECT 'A' || n_nationkey AS adm1_code, n_name AS state_name, CASE WHEN n_nationkey % 9 <> 8 THEN 'N' || chr(65 + n_nationkey) || 'X' END AS country_iso3
    FROM nation WHERE n_nationkey % 4 <> 3""")
def state_load(spark, sf):
    """First-level states with a known country; other features and empty outlines go."""
    countries = dims.country_rows(_boundary_files(spark, sf))
    k = F.col("n_nationkey")
    raw = _shapes(spark, sf).select(
        F.when(k % 8 == 3, "Admin-1 minor").otherwise(dims.STATE_FEATURE).alias("featurecla"), F.concat(F.lit("A"), k.cast("string")).alias("adm1_code"), F.lit("X-1").alias("iso_3166_2"),
        F.when(k % 5 != 0, F.col("n_name")).alias("name"), F.lit("State").alias("type_en"), F.concat(F.lit("N"), F.char(65 + k), F.lit("X")).alias("adm0_a3"), F.lit("NA").alias("iso_a2"),
        F.col("n_name").alias("admin"), F.lit(1.5).alias("longitude"), F.lit(2.5).alias("latitude"), F.when(k % 8 != 7, F.col("wkt")).otherwise("POLYGON EMPTY").alias("wkt"))
    return dims.state_rows(raw, dims.iso3_table(spark), countries).select("adm1_code", "state_name", "country_iso3")


_IN_SHAPE = "((p.longitude - x0 BETWEEN 0 AND 40 AND p.latitude - y0 BETWEEN 0 AND 30 AND NOT (p.longitude - x0 BETWEEN 10 AND 20 AND p.latitude - y0 BETWEEN 10 AND 20)) OR (p.longitude - x0 BETWEEN 50 AND 60 AND p.latitude - y0 BETWEEN 5 AND 25))"


@query("multipolygon_country", s.with_views(
    f"SELECT event_id, min(id) AS country_id FROM pings p LEFT JOIN boxes ON {_IN_SHAPE} GROUP BY event_id", "pings", "boxes"))
def multipolygon_country(spark, sf):
    """Positions in countries of two parts, one with a hole, whose outlines come from a file and cells hold few edges."""
    drawn = _boundary_files(spark, sf).select(F.lit("COUNTRY").alias("level"), (F.ascii(F.substring("ISO_A3", 2, 1)) - 65).alias("territory_id"), F.col("ISO_A3").alias("territory_name"), "wkt")
    index = geo.build_cells(geo.boundary_edges(drawn), 10.0)
    return geo.locate(s.pings(spark, sf).select("event_id", "longitude", "latitude"), index).select("event_id", F.col("country.id").alias("country_id"))


# Catalog, choice of source, changed rows -----------------------------------------------------------

@query("catalog_tables", s.with_views(
    "SELECT 'daily_flight_events' AS name, count(*) AS rows FROM flight_events WHERE event_date = DATE '2024-01-30' UNION ALL SELECT 'dim_aircraft', count(*) FROM aircraft "
    "UNION ALL SELECT unnest(['daily_territory_crossings', 'dim_airport', 'dim_country', 'dim_state', 'hist_flight_events', 'hist_territory_crossings']), 0", "flight_events", "aircraft"))
def catalog_tables(spark, sf):
    """The declared tables in a database of their own, two of them filled."""
    base = f"declared_{uuid.uuid4().hex}"
    prepare(spark).sql(f"CREATE DATABASE {base}")
    tables.create_catalog_tables(spark, database=base)
    shape = lambda df, struct: df.select(*[(F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in struct])
    day = s.flight_events(spark, sf).filter(F.col("event_date") == F.lit(s.LAST_DAY).cast("date"))
    shape(day, schema.DAILY_EVENT).write.mode("append").format("parquet").partitionBy("event_date").saveAsTable(f"{base}.daily_flight_events")
    shape(s.aircraft(spark, sf), schema.AIRCRAFT).write.mode("append").format("parquet").saveAsTable(f"{base}.dim_aircraft")
    counts = [spark.table(f"{base}.{n}").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("name"), "rows") for n in tables.SOURCES]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    out = cut_lineage(out)
    spark.sql(f"DROP DATABASE {base} CASCADE")
    return out


@query("position_source", s.with_views(
    "SELECT icao24, 'cache' AS source FROM flight_events WHERE NOT on_ground GROUP BY icao24 HAVING count(*) > 3 UNION ALL "
    "SELECT icao24, 'batch' FROM flight_events WHERE NOT on_ground AND latitude IS NOT NULL GROUP BY icao24", "flight_events"))
def position_source(spark, sf):
    """The cache where it has rows, the batch result where there is none or an empty one."""
    events = s.flight_events(spark, sf).withColumns({"velocity_kmh": F.lit(1.0), "heading_deg": F.lit(1.0)})
    batch = serve.latest_positions(events, order=("event_timestamp", "event_id"))
    busy = events.filter(~F.col("on_ground")).groupBy("icao24").count().filter("count > 3").select("icao24")
    cache = batch.join(busy, "icao24", "left_semi").withColumn("source", F.lit("cache"))
    chosen = [serve.choose_positions(c, batch) for c in (cache, cache.filter("false"))]
    return chosen[0].select("icao24", "source").unionByName(chosen[1].select("icao24", "source"))


@query("changed_rows", s.with_views(
    "SELECT count(*) FILTER (WHERE event_id % 3 = 0) AS changed, count(*) FILTER (WHERE event_id % 2 = 0) AS updated FROM flight_events", "flight_events"))
def changed_rows(spark, sf):
    n = F.col("event_id")
    return silver.changed_rows(s.flight_events(spark, sf).withColumns({"changed": n % 3 == 0, "touched": n % 2 == 0}))


# Real rules: one pass writes good and rejected rows and counts what was broken -------------------------

def _broken(load, table, key, **rules):
    """Checker: load, key and rule of every row a rule's condition holds for."""
    return " UNION ALL ".join(f"SELECT '{load}' AS load, {key} AS key, '{name}' AS rule FROM {table} WHERE {when}" for name, when in rules.items())


@query("checked_loads", " UNION ALL ".join([
    _broken("crossings", "events", "event_id", **{
        "territory_id is missing": "event_id % 13 = 0", "crossing_role is not an allowed value": "event_id % 5 = 2", "flight_status is not an allowed value": "event_id % 17 = 0"}),
    _broken("events", "events", "event_id", **{
        "event_type is missing": "event_id % 10 = 3", "event_type is not an allowed value": "event_id % 4 = 1 AND event_id % 10 <> 3", "callsign is longer than 20": "event_id % 9 = 0"}),
    _broken("predictions", "events", "event_id", **{
        "predicted_delay_class is not an allowed value": "event_id % 7 = 0", "delay_probability is out of range": "event_id % 50 > 40", "departure_hour is out of range": "event_id % 26 > 23"}),
    _broken("airports", "supplier", "s_suppkey", **{
        "airport_iata_code is longer than 3": "s_suppkey % 8 <> 7 AND length('I' || s_suppkey // 2) > 3", "iso_country is longer than 2": "length('N' || s_nationkey) > 2"})]))
def checked_loads(spark, sf):
    """Crossings, events, predictions and airports under their declared rules; what the reject table says of each broken row."""
    path = workdir(prepare(spark), "checked")
    events, n = s.flight_events(spark, sf), F.col("event_id")
    none = F.lit(None).cast("string")
    crossings = events.select(n, "icao24", F.lit("COUNTRY").alias("territory_type"), F.when(n % 13 != 0, 1).alias("territory_id"), F.when(n % 5 == 2, "MIDDLE").otherwise("ROUTE").alias("crossing_role"),
                              F.when(n % 17 == 0, "LOST").otherwise("COMPLETED").alias("flight_status"), F.col("event_timestamp").alias("entered_at"))
    flown = events.withColumns({"event_type": F.when(n % 10 == 3, none).when(n % 4 == 1, "HOVERING").otherwise(F.col("event_type")), "callsign": F.when(n % 9 == 0, F.lit("C" * 21)).otherwise(F.col("callsign"))})
    flown = flown.select(n, "icao24", "callsign", "event_type", "event_timestamp", "event_date", "origin_iata", "destination_iata", "source")
    predicted = events.select(n, F.when(n % 7 == 0, "LATE").when(n % 7 == 1, none).otherwise("ON_TIME").alias("predicted_delay_class"), (n % 50 / 40).alias("delay_probability"),
                              (n % 26).cast("int").alias("departure_hour"), (n % 7 + 1).cast("int").alias("departure_day_of_week"))
    airports = s.airports(spark, sf).withColumns({c: none for c in schema.TEXT_LIMITS["airport"] if c not in s.airports(spark, sf).columns}).withColumn("key", F.substring("ident", 2, 9).cast("bigint"))
    loads = {
        "crossings": (crossings, quality.crossing_rules(), "event_id"), "events": (flown, quality.event_rules(), "event_id"),
        "predictions": (predicted, quality.prediction_rules(), "event_id"), "airports": (airports, quality.airport_rules(), "key"),
    }
    out = None
    for load, (rows, rules, key) in loads.items():
        keyed = rows.withColumn("key", F.col(key).cast("bigint"))
        entry = quality.load_checked(keyed, rules, f"{path}/{load}", load).first()
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keyed.schema)
        bad = quality.loaded(spark, f"{path}/{load}", fields, True)
        counted = bad.select(F.explode("reasons").alias("rule")).groupBy("rule").count()
        if {r["rule"]: r["count"] for r in counted.collect()} != entry["broken"] or quality.loaded(spark, f"{path}/{load}", fields, False).count() != entry["total"] - entry["rejects"]:
            raise RuntimeError(f"the ledger of {load} does not tell what was written")
        part = bad.select("load", "key", F.explode("reasons").alias("rule"))
        out = part if out is None else out.unionByName(part)
    return out


# Dual write: the topic fails on one micro-batch ---------------------------------------------------------

@query("dual_write_replay", s.with_views(
    f"SELECT icao24, event_type, {s.ts_text('event_timestamp')} AS event_timestamp, count(*) AS in_table, count(*) AS in_topic FROM flight_events GROUP BY ALL", "flight_events"))
def dual_write_replay(spark, sf):
    """All events streamed into a table and a topic that fails twice; both hold every row in the end."""
    base = workdir(prepare(spark), "dual")
    failures = [RuntimeError("no broker")] * 2

    def to_table(batch, number):
        batch.write.mode("overwrite").parquet(f"{base}/table/batch={number}")
        return batch

    def to_topic(rows, number):
        if number >= 1 and failures:
            raise failures.pop()
        wide = rows.withColumns({c: F.lit(None).cast("double") for c in ("velocity_kmh", "heading_deg")})
        messages.to_messages(wide).write.mode("overwrite").parquet(f"{base}/topic/batch={number}")

    box = outbox.Outbox(f"{base}/outbox", to_topic)
    _finish(jobs.start(s.flight_events(spark, sf, _streamed(spark, sf)), f"{base}/checkpoint", each=outbox.outbox_write(to_table, box), replay=True))
    box.flush(spark)
    if box.waiting(spark):
        raise RuntimeError("the outbox still has batches")
    key = list(schema.EVENT_KEY)
    kept = spark.read.parquet(f"{base}/table/*").select(*key).withColumns({"t": F.lit(1), "m": F.lit(0)})
    sent = messages.from_messages(spark.read.parquet(f"{base}/topic/*")).select(*key).withColumns({"t": F.lit(0), "m": F.lit(1)})
    return kept.unionByName(sent).groupBy("icao24", "event_type", "event_timestamp").agg(F.sum("t").alias("in_table"), F.sum("m").alias("in_topic"))
