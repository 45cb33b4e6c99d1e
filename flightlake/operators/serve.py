"""Read-side results: positions, day statistics, crossings per flight, trails."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightlake.functions import measure, text
from flightlake.functions.clean import shown_callsign
from flightlake.operators.events import has_position
from flightlake.plans.sequence import latest_per_key

_POSITION = ["icao24", "callsign", "latitude", "longitude", "altitude_ft", "velocity_kmh", "heading_deg", "event_type", "event_timestamp"]


def _on(column: str, day: str | None) -> Column:
    return F.lit(True) if day is None else F.col(column) == F.lit(day).cast("date")


def latest_positions(events: DataFrame, day: str | None = None, source: str = "batch", order: tuple[str, ...] = ("event_timestamp",)) -> DataFrame:
    """Last airborne position of each aircraft."""
    flying = events.filter(_on("event_date", day) & has_position() & ~F.col("on_ground"))
    chosen = flying.select(*dict.fromkeys([*_POSITION, *order]))
    return latest_per_key(chosen, ["icao24"], list(order)).select(
        "icao24", shown_callsign("callsign", "icao24").alias("callsign"), *_POSITION[2:8],
        F.col("event_timestamp").alias("updated_at"), F.lit(source).alias("source"),
    )


def choose_positions(cache: DataFrame | None, fallback: DataFrame) -> DataFrame:
    """The stream's cache if there is one with rows, else the batch result."""
    if cache is None or cache.isEmpty():
        return fallback
    return cache.filter(has_position())


def live_board(positions: DataFrame) -> DataFrame:
    """Positions highest first, unknown altitude last, with display altitude."""
    return positions.withColumn("altitude_shown", text.altitude_text("altitude_ft")).orderBy(
        F.coalesce("altitude_ft", F.lit(0)).desc(), "icao24"
    )


def search(df: DataFrame, needle: str) -> DataFrame:
    """Aircraft whose callsign or id holds a text, in any case."""
    return df.filter(text.holds_text(needle, "callsign", "icao24"))


def gone_keys(before: DataFrame, now: DataFrame, key: str = "icao24") -> DataFrame:
    """Keys shown before that are no longer active."""
    return before.select(key).distinct().join(now.select(key), key, "left_anti")


def daily_stats(events: DataFrame, day: str) -> DataFrame:
    """One row of the day's figures; an empty day gives zeros."""
    kind = lambda k: F.count_if(F.col("event_type") == k)
    every = F.count(F.lit(1))
    share = measure.ratio(F.count("origin_iata") * 100, every, 1)
    return events.filter(_on("event_date", day)).agg(
        F.countDistinct("icao24").alias("unique_aircraft"), every.alias("total_events"),
        kind("DEPARTED").alias("departures"), kind("LANDED").alias("landings"), kind("CRUISING").alias("cruising"),
        F.coalesce(share, F.lit(0)).alias("enrichment_pct"),
    )


def territories(countries: DataFrame, states: DataFrame) -> DataFrame:
    """Countries and states as one dimension keyed by type and id."""
    shape = lambda kind, key, name: [
        F.lit(kind).alias("territory_type"), F.col(key).alias("territory_id"), F.col(name).alias("name"), "centroid_lat", "centroid_lon",
    ]
    return countries.select(*shape("COUNTRY", "country_id", "country_name")).unionByName(
        states.select(*shape("STATE", "state_id", "state_name"))
    )


def located_crossings(crossings: DataFrame, dimension: DataFrame, day: str | None = None) -> DataFrame:
    """Crossings with the centre of their territory; other territory types have none."""
    centre = dimension.select(
        "territory_type", "territory_id", F.col("centroid_lat").alias("entered_lat"), F.col("centroid_lon").alias("entered_lon")
    )
    return crossings.filter(_on("entered_date", day)).join(centre, ["territory_type", "territory_id"], "left")


_CROSSING_DOC = [
    "crossing_id", "territory_type", "territory_id", "territory_name", "crossing_role", "flight_status",
    "entered_at", "exited_at", "duration_minutes", "entered_lat", "entered_lon",
]


def flight_documents(located: DataFrame) -> DataFrame:
    """Crossings as nested lists in entry order: per aircraft, date and hour of entry.

    The hour pages the list, so a document is bounded by one hour of one
    aircraft. Pages of one aircraft and date, in page order, make up its full list. All show the callsign of the first entry of the date.
    """
    item = F.struct("entered_at", *[c for c in _CROSSING_DOC if c != "entered_at"])
    pages = located.groupBy("icao24", "entered_date", F.hour("entered_at").alias("page")).agg(
        F.min_by(F.struct("callsign"), F.struct("entered_at", "crossing_id")).alias("_first"), F.array_sort(F.collect_list(item)).alias("crossings")
    )
    # A day has at most 24 pages; its header is that of the first one.
    day = Window.partitionBy("icao24", "entered_date").orderBy("page")
    return pages.withColumn("_first", F.first("_first").over(day)).select(
        "icao24", shown_callsign("_first.callsign", "icao24").alias("callsign"), "entered_date", "page",
        F.size("crossings").alias("crossing_count"), "crossings",
    )


def documents_json(documents: DataFrame) -> DataFrame:
    """Nested documents as JSON text with ISO times."""
    doc = F.struct("icao24", "callsign", F.transform("crossings", lambda c: F.struct(
        c["crossing_id"].alias("crossing_id"), c["territory_type"].alias("territory_type"), c["territory_name"].alias("territory_name"),
        c["crossing_role"].alias("crossing_role"), measure.iso_text(c["entered_at"]).alias("entered_at"),
        measure.iso_text(c["exited_at"]).alias("exited_at"), c["duration_minutes"].cast("double").alias("duration_minutes"),
    )).alias("crossings"))
    return documents.select("icao24", "entered_date", "page", F.to_json(doc).alias("document"))


def flat_crossings(documents: DataFrame) -> DataFrame:
    """Documents taken apart again, one row per crossing."""
    return documents.select("icao24", "callsign", "entered_date", F.explode("crossings").alias("c")).select(
        "icao24", "callsign", "entered_date", "c.*"
    )


def trail_stats(crossings: DataFrame) -> DataFrame:
    """Flights, crossings, and distinct countries and states among them.

    Two foldings: to (aircraft, territory) and then to marked distinct values, so no step
    needs several distinct counts over the raw rows.
    """
    shown = crossings.select("icao24", "territory_type", "territory_name")
    per_pair = shown.groupBy("icao24", "territory_type", "territory_name").agg(F.count(F.lit(1)).alias("n"))
    marks = F.explode(F.array(
        F.struct(F.lit("flight").alias("kind"), F.col("icao24").alias("value"), F.col("n")),
        F.struct(F.col("territory_type").alias("kind"), F.col("territory_name").alias("value"), F.lit(0).cast("bigint").alias("n")),
    ))
    distinct = per_pair.select(marks.alias("m")).groupBy("m.kind", "m.value").agg(F.sum("m.n").alias("n"))
    has = lambda k: F.count(F.when(F.col("kind") == k, F.col("value")))
    return distinct.agg(
        has("flight").alias("flights"), F.coalesce(F.sum("n"), F.lit(0)).alias("total_crossings"),
        has("COUNTRY").alias("countries"), has("STATE").alias("states"),
    )


def trail_view(crossings: DataFrame) -> DataFrame:
    """Crossings with their display label, duration text and whether the aircraft is inside now."""
    return crossings.withColumns({
        "pin": text.pin_label("crossing_role", "territory_type"),
        "duration_shown": text.duration_text("duration_minutes"),
        "is_current": text.currently_inside("flight_status", "exited_at"),
    })


def route_trail(crossings: DataFrame, events: DataFrame, origin: str, destination: str) -> DataFrame:
    """Territories crossed by all flights of one route, in entry order."""
    flown = events.filter((F.col("origin_iata") == origin) & (F.col("destination_iata") == destination))
    return (
        crossings.join(flown.select(F.col("event_id").alias("flight_event_id")), "flight_event_id")
        .select("territory_name", "territory_type", "crossing_role", "duration_minutes", "entered_at")
        .orderBy("entered_at")
    )


def live_trail(crossings: DataFrame, positions: DataFrame) -> DataFrame:
    """Crossings with the latest position of their aircraft, if it has one."""
    now = positions.select(
        "icao24", F.col("latitude").alias("live_lat"), F.col("longitude").alias("live_lon"),
        F.col("altitude_ft").alias("live_altitude_ft"), F.col("event_type").alias("live_event_type"),
    )
    return crossings.join(now, "icao24", "left").withColumn("is_live", F.col("live_lat").isNotNull())
