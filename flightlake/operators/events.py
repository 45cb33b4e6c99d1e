"""Flight events from positions and from monthly flight lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake import schema
from flightlake.functions import clean, measure
from flightlake.operators.geo import AirportGrids, with_nearest_airport
from flightlake.plans.sequence import CROWDED, DAY, HOUR, with_last_known, with_neighbours

_MEASURES = ("callsign", "latitude", "longitude", "altitude_ft", "velocity_kmh", "heading_deg", "vertical_rate_fpm", "on_ground")


def event_type(before_ground: Column, before_rate: Column, ground: Column, rate: Column, altitude: Column) -> Column:
    """Event a position means, given the position before; NULL for none.

    Climbing and descending fire on every position that qualifies, cruising
    only on levelling off. Unknown rates and altitudes count as 0.
    """
    now, was, height = (F.coalesce(c, F.lit(0.0)) for c in (rate, before_rate, altitude))
    airborne = ~before_ground & ~ground
    return (
        F.when(before_ground.isNull(), F.lit(None))
        .when(~before_ground & ground, "LANDED")
        .when(before_ground & ~ground, "DEPARTED")
        .when(airborne & (now > measure.CLIMB_FPM), "CLIMBING")
        .when(airborne & (now < -measure.CLIMB_FPM), "DESCENDING")
        .when(airborne & (height > measure.CRUISE_ALTITUDE_FT) & (F.abs(was) > measure.CLIMB_FPM), "CRUISING")
    )


def with_event_type(pings: DataFrame, order: tuple[str, ...] = ("timestamp",), carry: tuple[str, ...] = (), width: int = HOUR, calm: int = CROWDED, last: str | None = None) -> DataFrame:
    """Positions with ``event_type`` and the previous position ``before``.

    ``carry`` names further columns of the previous position to keep; ``calm`` is as in ``with_neighbours``. ``last`` names a column that tells the last position of each aircraft.
    """
    fields = ["on_ground", "vertical_rate_fpm", *carry]
    near = with_neighbours(pings, ["icao24"], order, fields, width, "before", "after", calm)
    return (near.withColumn(last, F.col("after").isNull()) if last else near).drop("after").withColumn(
        "event_type",
        event_type(
            F.col("before.on_ground"), F.col("before.vertical_rate_fpm"),
            F.col("on_ground"), F.col("vertical_rate_fpm"), F.col("altitude_ft"),
        ),
    )


def detect_events(pings: DataFrame, order: tuple[str, ...] = ("timestamp",), width: int = HOUR) -> DataFrame:
    """State changes only."""
    return with_event_type(pings, order, width=width).drop("before").filter(F.col("event_type").isNotNull())


def known_aircraft(events: DataFrame, aircraft: DataFrame) -> DataFrame:
    """Events of aircraft in the master table; the rest are not accepted."""
    return events.join(aircraft.select("icao24"), "icao24", "left_semi")


def unknown_aircraft(events: DataFrame, aircraft: DataFrame) -> DataFrame:
    return events.join(aircraft.select("icao24"), "icao24", "left_anti")


def has_position(lat: str = "latitude", lon: str = "longitude", exact: bool = False) -> Column:
    """Both coordinates known. ``exact`` also treats 0.0 as missing."""
    known = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    return known & (F.col(lat) != 0) & (F.col(lon) != 0) if exact else known


def with_origin(events: DataFrame, grids: AirportGrids) -> DataFrame:
    """Departures get the nearest commercial airport as origin; the rest keep NULL."""
    departed = F.col("event_type") == "DEPARTED"
    located = (
        events.withColumn("_x", F.when(departed & has_position(), F.col("longitude")))
        .withColumn("_y", F.when(departed & has_position(), F.col("latitude")))
    )
    return with_nearest_airport(located, grids, "origin_iata", "_x", "_y").drop("_x", "_y")


def event_rows(events: DataFrame, run_ts: Column, source: str = schema.LIVE_SOURCE) -> DataFrame:
    """Detected events in the shape of the daily event table."""
    shaped = events.select(
        F.xxhash64("icao24", "timestamp", "event_type").alias("event_id"),
        "icao24", "event_type",
        F.col("timestamp").alias("event_timestamp"),
        F.to_date("timestamp").alias("event_date"),
        *_MEASURES,
        F.col("origin_iata") if "origin_iata" in events.columns else F.lit(None).cast("string").alias("origin_iata"),
        F.lit(None).cast("string").alias("destination_iata"),
        F.lit(source).alias("source"),
        run_ts.alias("created_at"),
    )
    return shaped.select(*[F.col(f.name).try_cast(f.dataType) for f in schema.DAILY_EVENT])


def with_last_event(rows: DataFrame, order: tuple[str, ...], event: str, width: int = HOUR, out: str = "last_event", calm: int = CROWDED) -> DataFrame:
    """Last accepted event of the aircraft at or before each row."""
    return with_last_known(rows, ["icao24"], order, event, width, out, calm)


def airport_codes(airports: DataFrame) -> DataFrame:
    """ICAO to IATA; where an ICAO code repeats the row with the largest ident wins."""
    both = airports.filter(F.col("airport_icao_code").isNotNull() & F.col("airport_iata_code").isNotNull())
    return both.groupBy(F.col("airport_icao_code").alias("icao")).agg(F.max_by("airport_iata_code", "ident").alias("iata"))


def with_route_codes(flights: DataFrame, airports: DataFrame, origin: str = "origin", destination: str = "destination") -> DataFrame:
    """Origin and destination ICAO codes turned into IATA codes."""
    codes = airport_codes(airports)
    start = codes.select(F.col("icao").alias(origin), F.col("iata").alias("origin_iata"))
    end = codes.select(F.col("icao").alias(destination), F.col("iata").alias("destination_iata"))
    return flights.join(start, origin, "left").join(end, destination, "left")


def typed_flights(lists: DataFrame) -> DataFrame:
    """Monthly flight list texts as typed flights, with ``accepted`` for the mandatory fields."""
    texts = {c: clean.clean_text(c) for c in ("icao24", "callsign", "origin", "destination")}
    numbers = {c: clean.to_double(c) for c in ("latitude_1", "longitude_1", "altitude_1", "latitude_2", "longitude_2", "altitude_2")}
    times = {c: clean.to_time(c) for c in ("firstseen", "lastseen")}
    kept = [c for c in lists.columns if c not in schema.FLIGHT_LIST_COLUMNS]
    # As a generator the parse stays below the filter on its outcome and runs once per flight.
    typed = F.inline(F.array(F.struct(*[c.alias(n) for n, c in {**texts, **numbers, **times}.items()])))
    return lists.select(*kept, typed).withColumn(
        "accepted", F.col("icao24").isNotNull() & F.col("firstseen").isNotNull() & F.col("lastseen").isNotNull()
    )


def flights_to_events(flights: DataFrame, airports: DataFrame, run_ts: Column, exact: bool = False) -> DataFrame:
    """One accepted flight becomes a DEPARTED and a LANDED history row, in one scan.

    ``exact`` reads an altitude of 0 as unknown.
    """
    coded = with_route_codes(flights.filter("accepted"), airports)

    def side(kind: str, when: str, n: int) -> Column:
        metres = F.col(f"altitude_{n}")
        height = F.when(metres != 0, metres) if exact else metres
        return F.struct(
            F.lit(kind).alias("event_type"), F.col(when).alias("event_timestamp"),
            F.col(f"latitude_{n}").alias("latitude"), F.col(f"longitude_{n}").alias("longitude"),
            measure.feet(height).alias("altitude_ft"),
        )

    ends = F.explode(F.array(side("DEPARTED", "firstseen", 1), side("LANDED", "lastseen", 2)))
    rows = coded.select("icao24", "callsign", "origin_iata", "destination_iata", ends.alias("e")).select(
        "icao24", "callsign", "origin_iata", "destination_iata", "e.*"
    )
    absent = {"velocity_kmh": "double", "heading_deg": "double", "vertical_rate_fpm": "double", "on_ground": "boolean"}
    full = (
        rows.withColumn("event_id", F.xxhash64("icao24", "event_timestamp", "event_type"))
        .withColumn("event_date", F.to_date("event_timestamp"))
        .withColumn("source", F.lit(schema.HISTORY_SOURCE))
        .withColumns({name: F.lit(None).cast(kind) for name, kind in absent.items()})
        .withColumns({"created_at": run_ts, "inserted_at": run_ts, "batch_date": F.to_date(run_ts)})
    )
    return full.select(*[F.col(f.name).try_cast(f.dataType) for f in schema.HIST_EVENT])


def pair_next_landing(events: DataFrame, order: tuple[str, ...] = ("event_timestamp",), same_day: bool = False, width: int = DAY) -> DataFrame:
    """Each departure with the next landing of the same aircraft and source, if one comes before its next departure.

    Linear in the events, unlike pairing every departure of a day with every
    landing of that day; the two agree wherever an aircraft flies one leg a day.
    ``same_day`` keeps only pairs whose landing falls on the departure's date.
    """
    ends = events.filter(F.col("event_type").isin("DEPARTED", "LANDED"))
    fields = ["event_id", "event_type", "event_timestamp", "event_date", "latitude", "longitude"]
    linked = with_neighbours(ends, ["icao24", "source"], order, fields, width, "before", "after")
    kept = linked.filter((F.col("event_type") == "DEPARTED") & (F.col("after.event_type") == "LANDED"))
    if same_day:
        kept = kept.filter(F.col("after.event_date") == F.col("event_date"))
    return kept.select(
        F.col("event_id").alias("departed_event_id"), "icao24", "callsign", "source", "event_date",
        F.col("event_timestamp").alias("firstseen"), F.col("latitude").alias("lat1"), F.col("longitude").alias("lon1"),
        F.col("after.event_id").alias("landed_event_id"), F.col("after.event_timestamp").alias("lastseen"),
        F.col("after.latitude").alias("lat2"), F.col("after.longitude").alias("lon2"),
    )


def flight_pairs(events: DataFrame, source: str | None = schema.HISTORY_SOURCE, year: int | None = None, order: tuple[str, ...] = ("event_timestamp",)) -> DataFrame:
    """Departures and their same-day landings with known positions at both ends."""
    chosen = events if source is None else events.filter(F.col("source") == source)
    if year is not None:
        chosen = chosen.filter(F.col("event_date").between(F.lit(f"{year}-01-01").cast("date"), F.lit(f"{year}-12-31").cast("date")))
    both = has_position("lat1", "lon1") & has_position("lat2", "lon2")
    return pair_next_landing(chosen, order, same_day=True).filter(both)


def count_flights(events: DataFrame, source: str = schema.HISTORY_SOURCE, year: int | None = None) -> DataFrame:
    """Number of departure and landing combinations per aircraft and date, without forming them."""
    chosen = events.filter((F.col("source") == source) & has_position())
    if year is not None:
        chosen = chosen.filter(F.col("event_date").between(F.lit(f"{year}-01-01").cast("date"), F.lit(f"{year}-12-31").cast("date")))
    count = lambda kind: F.count(F.when(F.col("event_type") == kind, F.lit(1)))
    per_day = chosen.groupBy("icao24", "event_date").agg(count("DEPARTED").alias("d"), count("LANDED").alias("l"))
    return per_day.agg(F.coalesce(F.sum(F.col("d") * F.col("l")), F.lit(0)).alias("flights"))


def departed_never_landed(events: DataFrame, order: tuple[str, ...] = ("event_timestamp",), width: int = DAY) -> DataFrame:
    """Departures that no landing follows before the next departure, or at all."""
    ends = events.filter(F.col("event_type").isin("DEPARTED", "LANDED"))
    linked = with_neighbours(ends, ["icao24"], order, ["event_type"], width, "before", "after")
    unpaired = (F.col("event_type") == "DEPARTED") & ~F.coalesce(F.col("after.event_type") == "LANDED", F.lit(False))
    return linked.filter(unpaired).drop("before", "after")
