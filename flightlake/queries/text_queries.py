"""Cleaning, parsing and presentation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from flightlake.functions import clean, geometry, measure, text
from flightlake.queries import standins as s
from flightlake.queries.registry import query

# Raw texts made from the events: every kind of blank, code and number.
_RAW = """
    SELECT event_id, CASE event_id % 8 WHEN 0 THEN '  nan ' WHEN 1 THEN 'None' WHEN 2 THEN '' WHEN 3 THEN ' -99' WHEN 4 THEN 'CN-TW' WHEN 5 THEN '  ' || event_type || ' '
               WHEN 6 THEN CAST(event_id * 7 AS VARCHAR) || '.25' ELSE ' -' || event_id END AS raw,
           CASE event_id % 4 WHEN 0 THEN 'yes' WHEN 1 THEN ' YES ' WHEN 2 THEN 'no' END AS answer FROM events"""


def _raw(spark, sf):
    n, m = F.col("event_id"), F.col("event_id") % 8
    raw = (
        F.when(m == 0, "  nan ").when(m == 1, "None").when(m == 2, "").when(m == 3, " -99").when(m == 4, "CN-TW")
        .when(m == 5, F.concat(F.lit("  "), F.col("event_type"), F.lit(" "))).when(m == 6, F.concat((n * 7).cast("string"), F.lit(".25")))
        .otherwise(F.concat(F.lit(" -"), n.cast("string")))
    )
    a = n % 4
    return s.table(spark, sf, "events").select("event_id", raw.alias("raw"), F.when(a == 0, "yes").when(a == 1, " YES ").when(a == 2, "no").alias("answer"))


@query("clean_text", s.with_views("""
    SELECT event_id, CASE WHEN lower(trim(raw)) NOT IN ('', 'nan', 'none') THEN trim(raw) END AS cleaned,
           CASE WHEN lower(trim(raw)) NOT IN ('nan', 'none') THEN try_cast(trim(raw) AS DOUBLE) END AS number,
           CASE WHEN trim(raw) = 'CN-TW' THEN 'TW' WHEN trim(raw) <> '-99' AND lower(trim(raw)) NOT IN ('', 'nan', 'none') THEN trim(raw) END AS iso,
           coalesce(lower(trim(answer)) = 'yes', false) AS answered,
           CASE WHEN try_cast(trim(raw) AS DOUBLE) >= 1 AND lower(trim(raw)) <> 'nan' THEN CAST(floor(try_cast(trim(raw) AS DOUBLE)) AS BIGINT) END AS people
    FROM r""", r=_RAW))
def clean_text(spark, sf):
    return _raw(spark, sf).select(
        "event_id", clean.clean_text("raw").alias("cleaned"), clean.to_double("raw").alias("number"), clean.iso_code("raw").alias("iso"),
        clean.yes("answer").alias("answered"), clean.population("raw").alias("people"))


@query("parse_times", f"""
    SELECT event_id, CASE WHEN event_id % 7 >= 5 THEN NULL WHEN event_id % 7 = 4 THEN {s.ts_text("date_trunc('second', ts) - INTERVAL 2 HOUR")}
               ELSE {s.ts_text("date_trunc('second', ts)")} END AS at,
           CASE WHEN event_id % 4 < 3 THEN CAST(CAST(ts AS DATE) AS VARCHAR) END AS day
    FROM events""")
def parse_times(spark, sf):
    ts, n = F.col("ts").cast("timestamp"), F.col("event_id")
    m, d = n % 7, n % 4
    fmt = lambda f: F.date_format(ts, f)
    at = (
        F.when(m == 0, F.unix_timestamp(ts).cast("string")).when(m == 1, fmt("yyyy-MM-dd HH:mm:ss")).when(m == 2, fmt("yyyy-MM-dd'T'HH:mm:ss"))
        .when(m == 3, F.concat(fmt("yyyy-MM-dd HH:mm:ss"), F.lit("+0000"))).when(m == 4, F.concat(fmt("yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")))
        .when(m == 5, F.lit(" NaN ")).otherwise(fmt("yyyy/MM/dd"))
    )
    # Month first wins; day first is used only where the month would be impossible.
    day_first = F.when(F.dayofmonth(ts) > 12, fmt("dd/MM/yyyy")).otherwise(fmt("yyyy-MM-dd"))
    day = F.when(d == 0, fmt("M/d/yyyy")).when(d == 1, fmt("yyyy-MM-dd")).when(d == 2, day_first).otherwise("none")
    texts = s.table(spark, sf, "events").select("event_id", at.alias("at"), day.alias("day"))
    return texts.select("event_id", clean.to_time("at").alias("at"), clean.to_day("day").alias("day"))


@query("patch_codes", """
    SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_brand ELSE p_type END AS type_code,
           CASE WHEN p_size % 3 = 0 THEN 'WN' ELSE p_type END AS operator_code FROM part""")
def patch_codes(spark, sf):
    """Parts as aircraft types; a third carry the over-long texts."""
    long = F.col("p_size") % 3 == 0
    raw = s.table(spark, sf, "part").select(
        "p_partkey",
        F.when(long, F.concat(F.lit("BOEING ICAO Manufacturer Code (x) ("), F.col("p_brand"), F.lit(") ok"))).otherwise(F.col("p_type")).alias("t"),
        F.when(long, F.concat(F.lit("SWA\t Airline IATA "), F.col("p_name"))).otherwise(F.col("p_type")).alias("o"))
    return raw.select("p_partkey", clean.type_code_patch("t").alias("type_code"), clean.operator_code_patch("o").alias("operator_code"))


@query("unit_conversion", """
    SELECT event_id, CAST(round(CAST(value AS DECIMAL(18,6)) * 3.28084, 1) AS DOUBLE) AS feet, CAST(round(CAST(value AS DECIMAL(18,6)) * 3.6, 1) AS DOUBLE) AS kmh,
           CAST(round(CAST(value - 50 AS DECIMAL(18,6)) * 196.85, 1) AS DOUBLE) AS fpm FROM events""")
def unit_conversion(spark, sf):
    return s.table(spark, sf, "events").select(
        "event_id", measure.feet("value").alias("feet"), measure.kmh("value").alias("kmh"), measure.feet_per_minute(F.col("value") - 50).alias("fpm"))


@query("coverage_filter", s.with_views(
    "SELECT event_id, latitude, longitude FROM pings WHERE latitude BETWEEN -35 AND 37 AND longitude BETWEEN -17 AND 60", "pings"))
def coverage_filter(spark, sf):
    return s.pings(spark, sf).filter(geometry.in_box("longitude", "latitude", geometry.COVERAGE)).select("event_id", "latitude", "longitude")


@query("monitor_lines", s.with_views(
    "SELECT event_id, rpad(event_type, 12, ' ') || ' | ' || icao24 || ' | ' || lpad(coalesce(callsign, 'unknown'), 8, ' ') || ' | alt=' "
    "|| lpad(format('{:,}', CAST(round(coalesce(altitude_ft, 0)) AS BIGINT)), 8, ' ') || 'ft' AS line FROM flight_events", "flight_events"))
def monitor_lines(spark, sf):
    return s.flight_events(spark, sf).select("event_id", text.monitor_line().alias("line"))


@query("airport_distance", s.with_views("""
    SELECT ident, round(sqrt((longitude_deg - 10) * (longitude_deg - 10) + (latitude_deg - 5) * (latitude_deg - 5)), 6) AS degrees,
           round(12742.0176 * asin(sqrt(power(sin(radians(5 - latitude_deg) / 2), 2) + cos(radians(latitude_deg)) * cos(radians(5)) * power(sin(radians(10 - longitude_deg) / 2), 2))), 3) AS km
    FROM airports""", "airports"))
def airport_distance(spark, sf):
    x, y = F.col("longitude_deg"), F.col("latitude_deg")
    return s.airports(spark, sf).select(
        "ident", F.round(geometry.planar_distance(x, y, F.lit(10.0), F.lit(5.0)), 6).alias("degrees"),
        F.round(geometry.haversine_km(x, y, F.lit(10.0), F.lit(5.0)), 3).alias("km"))
