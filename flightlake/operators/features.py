"""Delay-model features. Times are UTC: the airport table has no time zone."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake import schema
from flightlake.functions import geometry as g
from flightlake.functions import measure
from flightlake.operators.marts import is_international

NEAR_KM = 50.0
# Slightly less than the length of a degree of latitude, so that cells are never too narrow.
_KM_PER_DEGREE = 110.0


def _one_airport_per_code(airports: DataFrame) -> DataFrame:
    """One row per IATA code: the commercial airport first, then the smallest ident."""
    best = F.struct((~F.col("is_commercial")).cast("int"), "ident")
    return airports.filter(F.col("airport_iata_code").isNotNull()).groupBy("airport_iata_code").agg(
        F.min_by(F.struct("iso_country", F.col("longitude_deg").cast("double").alias("lon"), F.col("latitude_deg").cast("double").alias("lat")), best).alias("a")
    ).select("airport_iata_code", "a.*")


def flight_features(events: DataFrame, aircraft: DataFrame, airports: DataFrame) -> DataFrame:
    """Age, clock, aircraft and route features of each departure."""
    codes = _one_airport_per_code(airports).select("airport_iata_code", "iso_country")
    origin = codes.select(F.col("airport_iata_code").alias("origin_iata"), F.col("iso_country").alias("_oc"))
    destination = codes.select(F.col("airport_iata_code").alias("destination_iata"), F.col("iso_country").alias("_dc"))
    master = aircraft.select("icao24", "airline_iata", "first_flight_date", "weight_category", "icao_aircraft_type")
    return (
        events.filter(F.col("event_type") == "DEPARTED")
        .select("event_id", "icao24", "callsign", "event_timestamp", F.col("event_date").alias("flight_date"), "origin_iata", "destination_iata")
        .join(master, "icao24", "left").join(origin, "origin_iata", "left").join(destination, "destination_iata", "left")
        .select(
            "event_id", "icao24", "callsign", "flight_date", "origin_iata", "destination_iata", "airline_iata",
            measure.age_years("first_flight_date", "flight_date").alias("aircraft_age_years"),
            "weight_category", "icao_aircraft_type",
            F.hour("event_timestamp").alias("departure_hour"),
            (F.weekday("event_timestamp") + 1).alias("departure_day_of_week"),
            is_international(F.col("_oc"), F.col("_dc")).alias("is_international"),
        )
    )


@dataclass(frozen=True)
class AirportDiscs:
    """One row per airport and grid cell its disc of ``near_km`` may meet; ``columns`` cells go round the earth."""

    cells: DataFrame
    columns: int
    near_km: float
    stored_bytes: int | None = None


def _cell(c: Column, columns: int) -> Column:
    return F.floor(c / F.lit(360 / columns)).cast("int")


def build_discs(airports: DataFrame, near_km: float = NEAR_KM) -> AirportDiscs:
    """Cell table of the airports, one per IATA code.

    Cells are at least as wide as the radius at the equator. A degree of longitude shrinks with
    the cosine of the latitude, so an airport reaches farther in x, at most all the way round.
    """
    columns = max(int(360 * _KM_PER_DEGREE / max(near_km, 1.0)), 1)
    top = F.least(F.abs("lat") + near_km / _KM_PER_DEGREE + 0.01, F.lit(90.0))
    reach = F.least(F.lit(float(columns)), F.ceil(F.lit(1.0) / F.greatest(F.cos(F.radians(top)), F.lit(1e-9)))).cast("int") + 1
    entered = (
        _one_airport_per_code(airports).select("airport_iata_code", "lon", "lat")
        .withColumn("_dx", F.explode(F.sequence(-reach, reach)))
        .withColumn("_dy", F.explode(F.sequence(F.lit(-2), F.lit(2))))
    )
    cell_x = F.pmod(_cell(F.col("lon"), columns) + F.col("_dx"), F.lit(columns)).alias("cell_x")
    cell_y = (_cell(F.col("lat"), columns) + F.col("_dy")).alias("cell_y")
    return AirportDiscs(entered.select(cell_x, cell_y, "airport_iata_code", "lon", "lat").distinct(), columns, near_km)


def congestion(departures: DataFrame, pings: DataFrame, discs: AirportDiscs, poll: str = "poll") -> DataFrame:
    """Aircraft near the origin in the poll that saw the departure.

    ``poll`` identifies one position snapshot in both inputs. Only airports with a departure
    in a poll are entered into the cells of that poll, so a position is measured against the airports near it that its own poll
    asks for, however many others there are. Positions are never paired with each other, and the count per (poll,
    airport) is folded before it meets the departures.
    """
    x, y = F.col("longitude").cast("double"), F.col("latitude").cast("double")
    placed = pings.select(
        poll, "icao24", x.alias("longitude"), y.alias("latitude"),
        F.pmod(_cell(x, discs.columns), F.lit(discs.columns)).alias("cell_x"), _cell(y, discs.columns).alias("cell_y"),
    )
    asked = (
        departures.select(poll, "origin_iata").distinct()
        .join(discs.cells.withColumnRenamed("airport_iata_code", "origin_iata"), "origin_iata")
        .groupBy(poll, "cell_x", "cell_y").agg(F.collect_list(F.struct("origin_iata", "lon", "lat")).alias("near"))
    )
    close = F.filter("near", lambda a: g.haversine_km(F.col("longitude"), F.col("latitude"), a["lon"], a["lat"]) <= discs.near_km)
    around = (
        placed.join(asked, [poll, "cell_x", "cell_y"])
        .select(poll, "icao24", F.explode(F.transform(close, lambda a: a["origin_iata"])).alias("origin_iata"))
        .distinct()
        .groupBy(poll, "origin_iata").agg(F.count(F.lit(1)).alias("origin_congestion_score"))
    )
    return departures.join(around, [poll, "origin_iata"], "left").withColumn(
        "origin_congestion_score", F.coalesce("origin_congestion_score", F.lit(0)).cast("decimal(10,2)")
    )


def with_us_delay(features: DataFrame, delays: DataFrame) -> DataFrame:
    """Departure delay of the airline's flight on that route and date; several flights are averaged.

    Averaging keeps one row per departure.
    """
    key = ["airline_iata", "origin_iata", "destination_iata", "flight_date"]
    folded = delays.groupBy(*key).agg(F.round(F.avg(F.col("departure_delay_min").cast("decimal(10,1)")), 1).cast("decimal(6,1)").alias("departure_delay_min"))
    return features.join(folded, key, "left")


def with_delay_class(df: DataFrame, probability: str = "delay_probability") -> DataFrame:
    return df.withColumn("predicted_delay_class", measure.delay_class(probability))


_CAUSES = ("carrier", "weather", "nas", "security", "late_aircraft")


def delay_causes(delays: DataFrame, by: list[str]) -> DataFrame:
    """Share of each delay cause in all cause minutes per group, an absent cause counting 0, and late arrivals."""
    minutes = {c: F.sum(F.coalesce(F.col(f"delay_{c}_min"), F.lit(0)).cast("decimal(12,1)")) for c in _CAUSES}
    total = sum(F.col(f"{c}_min") for c in _CAUSES)
    folded = delays.groupBy(*by).agg(
        *[m.alias(f"{c}_min") for c, m in minutes.items()],
        F.count(F.lit(1)).alias("flights"), F.count_if(measure.is_late("arrival_delay_min")).alias("late_flights"),
    )
    return folded.select(*by, "flights", "late_flights", *[
        measure.ratio(F.col(f"{c}_min") * 10, total * 10, 4).alias(f"{c}_share") for c in _CAUSES
    ])


def typed_us_delays(raw: DataFrame) -> DataFrame:
    """On-time performance texts as typed rows: 0/1 flags, HHMM clock numbers, minutes."""
    def typed(field):
        c = F.col(field.name)
        if field.name.startswith("is_"):
            return F.coalesce(measure.flag(c), F.lit(False))
        if field.dataType.simpleString() == "int":
            return c.cast("string").try_cast("double").try_cast("int")
        return c.try_cast(field.dataType)

    return raw.select(*[typed(f).alias(f.name) for f in schema.US_DELAY])
