"""Aviation-shaped views over the generic test tables.

Each view exists twice: as a DataFrame for Spark and as SQL text for the
checker. Both use the same exact arithmetic over whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.session import prepare

LAST_DAY = "2024-01-30"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf}/{name}.parquet")


def _iata(n: Column, codes: int) -> Column:
    return F.concat(F.lit("I"), F.pmod(n, F.lit(codes)).cast("string"))


def flight_events(spark: SparkSession, sf: str, source: DataFrame | None = None) -> DataFrame:
    """signup departs, error lands; the rest are airborne events of user ``user_id`` as aircraft.

    ``source`` replaces the events table, by a stream of it for one.
    """
    e, kind = table(spark, sf, "events") if source is None else source, F.col("event_type")
    ts = F.col("ts").cast("timestamp")
    n, u = F.col("event_id"), F.col("user_id")
    return e.select(
        n,
        u.cast("string").alias("icao24"),
        F.when(n % 7 != 0, F.concat(F.lit("FL"), u.cast("string"))).alias("callsign"),
        F.when(kind == "signup", "DEPARTED").when(kind == "error", "LANDED").when(kind == "view", "CLIMBING")
        .when(kind == "click", "CRUISING").otherwise("DESCENDING").alias("event_type"),
        ts.alias("event_timestamp"),
        F.to_date(ts).alias("event_date"),
        (((n * 53) % 180) - 90 + 0.5).cast("double").alias("latitude"),
        (((n * 37) % 360) - 180 + 0.5).cast("double").alias("longitude"),
        (F.col("value") * 250).alias("altitude_ft"),
        ((F.col("value") - 50) * 10).alias("vertical_rate_fpm"),
        kind.isin("signup", "error").alias("on_ground"),
        F.when(n % 10 != 3, _iata(u * 7, 60)).alias("origin_iata"),
        F.when(n % 10 != 4, _iata(n * 11, 12)).alias("destination_iata"),
        F.when(n % 5 != 0, "opensky_historical").otherwise("opensky").alias("source"),
    )


def hist_events(spark: SparkSession, sf: str) -> DataFrame:
    """The same events moved back two to five years, by aircraft."""
    years = F.make_ym_interval((F.lit(2) + F.pmod(F.col("icao24").cast("bigint"), F.lit(4))).cast("int"))
    moved = F.col("event_timestamp") - years
    return flight_events(spark, sf).withColumn("event_timestamp", moved).withColumn("event_date", F.to_date("event_timestamp"))


def pings(spark: SparkSession, sf: str, source: DataFrame | None = None) -> DataFrame:
    """Positions; ``event_id`` breaks ties."""
    return flight_events(spark, sf, source).select(
        "event_id", "icao24", "callsign", "longitude", "latitude", "altitude_ft", "on_ground", "vertical_rate_fpm",
        F.lit(800.0).alias("velocity_kmh"), F.lit(90.0).alias("heading_deg"), F.col("event_timestamp").alias("timestamp"),
    )


def aircraft(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with some credit as aircraft, the rest are unknown; some have no airline."""
    k = F.col("c_custkey")
    return table(spark, sf, "customer").filter(F.col("c_acctbal") >= 500).select(
        k.cast("string").alias("icao24"),
        F.when(k % 13 != 0, F.col("c_mktsegment")).alias("airline_name"),
        F.when(k % 9 != 0, F.concat(F.substring("c_mktsegment", 1, 1), (k % 3).cast("string"))).alias("airline_iata"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("country_iso2"),
        F.date_add(F.lit("1990-01-01").cast("date"), ((k * 37) % 9000).cast("int")).alias("first_flight_date"),
        F.when(k % 4 == 0, "HEAVY").otherwise("MEDIUM").alias("weight_category"),
        F.concat(F.lit("T"), (k % 17).cast("string")).alias("icao_aircraft_type"),
    )


def airports(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as airports; two share each IATA code, some have none."""
    k = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(
        F.concat(F.lit("S"), k.cast("string")).alias("ident"),
        F.when(k % 8 != 7, F.concat(F.lit("I"), F.floor(k / 2).cast("string"))).alias("airport_iata_code"),
        F.when(k % 6 != 5, F.concat(F.lit("K"), (k % 90).cast("string"))).alias("airport_icao_code"),
        F.col("s_name").alias("airport_name"),
        (k % 3 != 0).alias("is_commercial"),
        F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("iso_country"),
        ((k * 47) % 360 - 180).cast("double").alias("longitude_deg"),
        ((k * 29) % 180 - 90).cast("double").alias("latitude_deg"),
    )


def boundaries(spark: SparkSession, sf: str) -> DataFrame:
    """Nations as boxed countries, and one diamond-shaped state inside each, as WKT."""
    k = F.col("n_nationkey")
    box = table(spark, sf, "nation").select(
        k.alias("id"), F.col("n_name").alias("name"),
        (F.lit(-180) + (k % 5) * 72).alias("x0"), (F.lit(-90) + F.floor(k / 5).cast("int") * 36).alias("y0"),
    )
    corner = lambda dx, dy: F.concat((F.col("x0") + dx).cast("string"), F.lit(" "), (F.col("y0") + dy).cast("string"))
    ring = lambda *cs: F.concat(F.lit("POLYGON (("), F.concat_ws(", ", *cs, cs[0]), F.lit("))"))
    country = box.select(
        F.lit("COUNTRY").alias("level"), F.col("id").alias("territory_id"), F.col("name").alias("territory_name"),
        ring(corner(0, 0), corner(60, 0), corner(60, 30), corner(0, 30)).alias("wkt"),
    )
    state = box.select(
        F.lit("STATE").alias("level"), (F.col("id") + 1000).alias("territory_id"),
        F.concat(F.lit("STATE_"), F.col("id").cast("string")).alias("territory_name"),
        ring(corner(30, 0), corner(60, 15), corner(30, 30), corner(0, 15)).alias("wkt"),
    )
    return country.unionByName(state)


def crossings(spark: SparkSession, sf: str) -> DataFrame:
    """Events as settled crossings, some still open, some of no duration."""
    n = F.col("event_id")
    role = F.pmod(n, F.lit(5))
    minutes = F.when(n % 11 != 0, (F.col("altitude_ft") / 250 - 5).cast("decimal(8,2)"))
    tid = F.pmod(n * 7, F.lit(25)).cast("int")
    return hist_events(spark, sf).select(
        n.alias("crossing_id"), n.alias("flight_event_id"), "icao24", "callsign",
        F.when(n % 3 != 0, "COUNTRY").otherwise("STATE").alias("territory_type"),
        F.when(n % 3 != 0, tid).otherwise(tid + 1000).alias("territory_id"),
        F.concat(F.when(n % 3 != 0, "NATION_").otherwise("STATE_"), tid.cast("string")).alias("territory_name"),
        F.when(role == 0, "START").when(role == 1, "END").otherwise("ROUTE").alias("crossing_role"),
        F.when(n % 11 != 0, "COMPLETED").otherwise("IN_PROGRESS").alias("flight_status"),
        F.col("event_timestamp").alias("entered_at"), F.col("event_date").alias("entered_date"),
        F.when(n % 11 != 0, F.col("event_timestamp") + F.make_dt_interval(mins=F.lit(30))).alias("exited_at"),
        minutes.alias("duration_minutes"), "source",
    )


def flight_records(spark: SparkSession, sf: str) -> DataFrame:
    """Flight records of the provider; some ends are unknown."""
    n = F.col("event_id")
    code = lambda k: F.concat(F.lit("K"), F.pmod(n * k, F.lit(100)).cast("string"))
    return table(spark, sf, "events").filter(F.col("event_type") != "view").select(
        F.col("user_id").cast("string").alias("icao24"),
        F.when(n % 5 != 0, code(3)).alias("estDepartureAirport"), F.when(n % 7 != 0, code(5)).alias("estArrivalAirport"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("lastSeen"),
    )


# The same views for the checker.
VIEWS = {
    "flight_events": """
        SELECT event_id, CAST(user_id AS VARCHAR) AS icao24,
               CASE WHEN event_id % 7 <> 0 THEN 'FL' || user_id END AS callsign,
               CASE event_type WHEN 'signup' THEN 'DEPARTED' WHEN 'error' THEN 'LANDED' WHEN 'view' THEN 'CLIMBING'
                               WHEN 'click' THEN 'CRUISING' ELSE 'DESCENDING' END AS event_type,
               ts AS event_timestamp, CAST(ts AS DATE) AS event_date,
               CAST((event_id * 53) % 180 - 90 + 0.5 AS DOUBLE) AS latitude,
               CAST((event_id * 37) % 360 - 180 + 0.5 AS DOUBLE) AS longitude,
               value * 250 AS altitude_ft, (value - 50) * 10 AS vertical_rate_fpm,
               event_type IN ('signup', 'error') AS on_ground,
               CASE WHEN event_id % 10 <> 3 THEN 'I' || (user_id * 7) % 60 END AS origin_iata,
               CASE WHEN event_id % 10 <> 4 THEN 'I' || (event_id * 11) % 12 END AS destination_iata,
               CASE WHEN event_id % 5 <> 0 THEN 'opensky_historical' ELSE 'opensky' END AS source
        FROM events""",
    "hist_events": """
        SELECT * REPLACE (event_timestamp - to_years(CAST(2 + CAST(icao24 AS BIGINT) % 4 AS INTEGER)) AS event_timestamp,
                          CAST(event_timestamp - to_years(CAST(2 + CAST(icao24 AS BIGINT) % 4 AS INTEGER)) AS DATE) AS event_date)
        FROM flight_events""",
    "pings": """
        SELECT event_id, icao24, callsign, longitude, latitude, altitude_ft, on_ground, vertical_rate_fpm,
               event_timestamp AS ts FROM flight_events""",
    "aircraft": """
        SELECT CAST(c_custkey AS VARCHAR) AS icao24,
               CASE WHEN c_custkey % 13 <> 0 THEN c_mktsegment END AS airline_name,
               CASE WHEN c_custkey % 9 <> 0 THEN substr(c_mktsegment, 1, 1) || c_custkey % 3 END AS airline_iata,
               'N' || c_nationkey AS country_iso2,
               DATE '1990-01-01' + CAST((c_custkey * 37) % 9000 AS INTEGER) AS first_flight_date,
               CASE WHEN c_custkey % 4 = 0 THEN 'HEAVY' ELSE 'MEDIUM' END AS weight_category,
               'T' || c_custkey % 17 AS icao_aircraft_type
        FROM customer WHERE c_acctbal >= 500""",
    "airports": """
        SELECT 'S' || s_suppkey AS ident, CASE WHEN s_suppkey % 8 <> 7 THEN 'I' || s_suppkey // 2 END AS airport_iata_code,
               CASE WHEN s_suppkey % 6 <> 5 THEN 'K' || s_suppkey % 90 END AS airport_icao_code,
               s_name AS airport_name, s_suppkey % 3 <> 0 AS is_commercial, 'N' || s_nationkey AS iso_country,
               CAST((s_suppkey * 47) % 360 - 180 AS DOUBLE) AS longitude_deg,
               CAST((s_suppkey * 29) % 180 - 90 AS DOUBLE) AS latitude_deg
        FROM supplier""",
    "boxes": """
        SELECT n_nationkey AS id, n_name AS name, -180 + 72 * (n_nationkey % 5) AS x0, -90 + 36 * (n_nationkey // 5) AS y0
        FROM nation""",
    "records": """
        SELECT CAST(user_id AS VARCHAR) AS icao24, CASE WHEN event_id % 5 <> 0 THEN 'K' || (event_id * 3) % 100 END AS dep,
               CASE WHEN event_id % 7 <> 0 THEN 'K' || (event_id * 5) % 100 END AS arr, epoch_us(ts) AS last_seen
        FROM events WHERE event_type <> 'view'""",
    "codes": """
        SELECT airport_icao_code AS icao, max_by(airport_iata_code, ident) AS iata FROM airports
        WHERE airport_icao_code IS NOT NULL AND airport_iata_code IS NOT NULL GROUP BY 1""",
    "crossings": """
        SELECT event_id AS crossing_id, event_id AS flight_event_id, icao24, callsign,
               CASE WHEN event_id % 3 <> 0 THEN 'COUNTRY' ELSE 'STATE' END AS territory_type,
               CASE WHEN event_id % 3 <> 0 THEN (event_id * 7) % 25 ELSE (event_id * 7) % 25 + 1000 END AS territory_id,
               CASE WHEN event_id % 3 <> 0 THEN 'NATION_' ELSE 'STATE_' END || (event_id * 7) % 25 AS territory_name,
               CASE event_id % 5 WHEN 0 THEN 'START' WHEN 1 THEN 'END' ELSE 'ROUTE' END AS crossing_role,
               CASE WHEN event_id % 11 <> 0 THEN 'COMPLETED' ELSE 'IN_PROGRESS' END AS flight_status,
               event_timestamp AS entered_at, event_date AS entered_date,
               CASE WHEN event_id % 11 <> 0 THEN event_timestamp + INTERVAL 30 MINUTE END AS exited_at,
               CASE WHEN event_id % 11 <> 0 THEN CAST(altitude_ft / 250 - 5 AS DECIMAL(8,2)) END AS duration_minutes, source
        FROM hist_events""",
}
_NEEDS = {"codes": ["airports"], "hist_events": ["flight_events"], "pings": ["flight_events"], "crossings": ["hist_events"]}


def with_views(sql: str, *names: str, **extra: str) -> str:
    """SQL with the named views, and what they need, as leading CTEs."""
    chosen: dict[str, str] = {}

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        chosen.setdefault(name, VIEWS[name])

    for name in names:
        add(name)
    chosen.update(extra)
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in chosen.items()) + "\n" + sql


def half_up(part: str, whole: str, digits: int) -> str:
    """Checker SQL: exact whole-number ratio rounded half away from zero, as DOUBLE."""
    scale = 10**digits
    return (
        f"CAST(sign({part}) * ((2 * {scale} * abs(CAST({part} AS HUGEINT)) + CAST({whole} AS HUGEINT)) "
        f"// (2 * CAST({whole} AS HUGEINT))) AS DOUBLE) / {scale}"
    )


def ts_text(column: str) -> str:
    """Checker SQL: timestamp as text with microseconds."""
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


def tidy(df: DataFrame) -> DataFrame:
    """Plain output types: text dates and times, doubles for decimals, one integer type."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif kind == "date":
            c = c.cast("string")
        elif kind.startswith("decimal"):
            c = c.cast("double")
        elif kind in ("int", "smallint", "tinyint"):
            c = c.cast("bigint")
        out.append(c.alias(name))
    return df.select(*out)
