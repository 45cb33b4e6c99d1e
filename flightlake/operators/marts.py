"""Gold marts: route frequency and territory heat map, and the trend reports.

Both marts aggregate before they join. A crossing is folded into its
(aircraft, group) partial first, and landings into one row per aircraft and
date, which each departure joins. Hot territories shrink on the map side,
and no join ever emits the pairs it only needs counted. The aggregated mart,
which ranking reads twice, is written to the shared folder before it is ranked.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake import schema
from flightlake.functions.measure import ratio
from flightlake.functions.text import route_label
from flightlake.plans import bitmaps
from flightlake.plans.ranking import smallest_mode, with_rank
from flightlake.session import cut_lineage
from flightlake.sources import versions

# The years the marts break their counts down by.
MART_YEARS = (2019, 2020, 2021, 2022)


def is_international(origin_country: Column, destination_country: Column) -> Column:
    """Countries differ; FALSE when either is unknown."""
    return F.coalesce(origin_country != destination_country, F.lit(False))


def departures_with_landings(events: DataFrame, landed_source: str) -> DataFrame:
    """Departures left-joined to all same-day landings of the aircraft, as weights.

    One row per (aircraft, route, date). ``flights`` is the number of rows the
    plain join would produce, ``timed`` those with a landing, and the duration
    columns are the sum and extremes over them, all computed from per-side
    counts, sums and extremes. Unpaired departures count once and carry no duration.
    """
    departures, landings = _sides(events, landed_source)
    return _weighed(_folded(departures, "d", *_DAY, "icao24", "event_date", "origin_iata", "destination_iata"), landings)


def _sides(events: DataFrame, landed_source: str) -> tuple[DataFrame, DataFrame]:
    """Departures as they are, and landings folded by aircraft and date.

    Times count from the start of the date.
    """
    after = F.unix_micros("event_timestamp") - F.unix_micros(F.col("event_date").cast("timestamp"))
    departs = (F.col("event_type") == "DEPARTED") & F.col("origin_iata").isNotNull() & F.col("destination_iata").isNotNull()
    lands = (F.col("event_type") == "LANDED") & (F.col("source") == landed_source)
    day = ["icao24", "event_date", *[key().alias(k) for k, key in _DAY.items()]]
    departures = events.filter(departs).select(*day, "origin_iata", "destination_iata", after.alias("after"))
    landings = events.filter(lands).select(*day, after.alias("after"))
    return departures, _folded(landings, "l", *_DAY)


#: Aircraft and date as keys that are never null: an unknown one meets its like, and the join reads the landings as they were dealt out to be folded.
_DAY = {
    "_aircraft": lambda: F.coalesce("icao24", F.lit("")), "_unknown": lambda: F.col("icao24").isNull(),
    "_date": lambda: F.coalesce("event_date", F.lit("1970-01-01").cast("date")), "_undated": lambda: F.col("event_date").isNull(),
}


def _parts() -> tuple[Column, Column]:
    """``after`` as whole seconds and microseconds, whose sums cannot overflow."""
    rest = F.pmod("after", F.lit(1_000_000))
    return F.floor((F.col("after") - rest) / 1_000_000), rest


def _folded(times: DataFrame, side: str, *by: str) -> DataFrame:
    seconds, rest = _parts()
    return times.groupBy(*by).agg(
        F.count(F.lit(1)).alias(f"{side}_n"), F.sum(seconds).alias(f"{side}_s"), F.sum(rest).alias(f"{side}_u"),
        F.min("after").alias(f"{side}_min"), F.max("after").alias(f"{side}_max"),
    )


def _single(departures: DataFrame) -> DataFrame:
    """Each departure as a fold of its own, for callers who add up the results anyway."""
    seconds, rest = _parts()
    after = F.col("after")
    return departures.select(
        *_DAY, "icao24", "event_date", "origin_iata", "destination_iata",
        F.lit(1).cast("bigint").alias("d_n"), seconds.alias("d_s"), rest.alias("d_u"), after.alias("d_min"), after.alias("d_max"),
    )


def _weighed(departures: DataFrame, landings: DataFrame) -> DataFrame:
    """Folded departures with the weights that the landings of their aircraft and date give them.

    A departure meets one row at most, so no pairs are formed, and Spark can split a busy aircraft-day.
    """
    total = lambda side: (F.col(f"{side}_s").cast("decimal(20,0)") * 1_000_000 + F.col(f"{side}_u")).cast("decimal(26,0)")
    return departures.join(landings, list(_DAY), "left").select(
        "icao24", "event_date", "origin_iata", "destination_iata",
        (F.col("d_n") * F.coalesce("l_n", F.lit(1))).alias("flights"),
        (F.col("d_n") * F.coalesce("l_n", F.lit(0))).alias("timed"),
        (F.col("d_n") * total("l") - F.col("l_n") * total("d")).cast("decimal(30,0)").alias("micros_sum"),
        (F.col("l_min") - F.col("d_max")).alias("micros_min"),
        (F.col("l_max") - F.col("d_min")).alias("micros_max"),
    )


def route_mart(
    events: DataFrame,
    aircraft: DataFrame,
    airports: DataFrame,
    landed_source: str = schema.HISTORY_SOURCE,
    years: Sequence[int] = MART_YEARS,
    min_flights: int = 2,
    ordered: bool = False,
) -> DataFrame:
    """Flights per route with durations, usual airline and rank.

    Departures pair with every same-day landing of the aircraft, and airport
    codes shared by several airports multiply the counts, as in the declared
    SQL mart; both are applied as weights. Departures of one aircraft-day are not folded before
    they are added up by airline: they are nearly all different.
    """
    departures, landings = _sides(events, landed_source)
    return route_mart_of(_weighed(_single(departures), landings), aircraft, airports, years, min_flights, ordered)


def route_mart_of(
    days: DataFrame, aircraft: DataFrame, airports: DataFrame, years: Sequence[int] = MART_YEARS, min_flights: int = 2, ordered: bool = False
) -> DataFrame:
    """``route_mart`` out of the days of ``departures_with_landings``, folded or one departure each."""
    airline = aircraft.select("icao24", "airline_name", "airline_iata")
    by_airline = (
        days.join(airline, "icao24", "left")
        .groupBy("origin_iata", "destination_iata", "airline_name", "airline_iata", F.year("event_date").alias("flight_year"))
        .agg(
            F.sum("flights").alias("flights"),
            F.sum("timed").alias("timed"),
            F.sum("micros_sum").alias("micros_sum"),
            F.min("micros_min").alias("micros_min"),
            F.max("micros_max").alias("micros_max"),
            F.min("event_date").alias("first_date"),
            F.max("event_date").alias("last_date"),
        )
    )
    codes = (
        airports.filter(F.col("airport_iata_code").isNotNull())
        .groupBy("airport_iata_code", "iso_country")
        .agg(F.count(F.lit(1)).alias("same"))
    )
    origin = codes.select(
        F.col("airport_iata_code").alias("origin_iata"), F.col("iso_country").alias("origin_country"), F.col("same").alias("o_same")
    )
    destination = codes.select(
        F.col("airport_iata_code").alias("destination_iata"),
        F.col("iso_country").alias("destination_country"),
        F.col("same").alias("d_same"),
    )
    weight = F.coalesce("o_same", F.lit(1)) * F.coalesce("d_same", F.lit(1))
    weighted = by_airline.join(origin, "origin_iata", "left").join(destination, "destination_iata", "left").select(
        "origin_iata", "destination_iata", "origin_country", "destination_country", "flight_year",
        "airline_name", "airline_iata", "first_date", "last_date", "micros_min", "micros_max",
        (F.col("flights") * weight).alias("flights"),
        (F.col("timed") * weight).alias("timed"),
        (F.col("micros_sum") * weight).cast("decimal(30,0)").alias("micros_sum"),
    )
    route = ["origin_iata", "destination_iata", "origin_country", "destination_country"]
    # Each row is counted once under the airline's name and once under its code;
    # the route measures ride on the name rows only.
    sided = weighted.withColumn(
        "side",
        F.explode(F.array(
            F.struct(F.lit("name").alias("kind"), F.col("airline_name").alias("value")),
            F.struct(F.lit("code").alias("kind"), F.col("airline_iata").alias("value")),
        )),
    )
    per_value = sided.groupBy(*route, "side.kind", "side.value").agg(
        F.sum("flights").alias("flights"),
        *[F.sum(F.when(F.col("flight_year") == y, F.col("flights")).otherwise(0)).alias(f"y_{y}") for y in years],
        F.sum("timed").alias("timed"),
        F.sum("micros_sum").alias("micros_sum"),
        F.min("micros_min").alias("micros_min"),
        F.max("micros_max").alias("micros_max"),
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
    )
    named = F.col("kind") == "name"
    minute = F.lit(60_000_000)
    routes = (
        per_value.groupBy(*route)
        .agg(
            F.sum(F.when(named, F.col("flights"))).alias("total_flights"),
            *[F.sum(F.when(named, F.col(f"y_{y}"))).alias(f"flights_{y}") for y in years],
            F.sum(F.when(named, F.col("timed"))).alias("timed"),
            F.sum(F.when(named, F.col("micros_sum"))).alias("micros_sum"),
            F.min("micros_min").alias("micros_min"),
            F.max("micros_max").alias("micros_max"),
            smallest_mode(F.when(named, F.col("value")), F.col("flights")).alias("primary_airline"),
            smallest_mode(F.when(~named, F.col("value")), F.col("flights")).alias("primary_airline_iata"),
            F.min("first_date").alias("first_seen_date"),
            F.max("last_date").alias("last_seen_date"),
        )
        .filter(F.col("total_flights") >= min_flights)
        .select(
            *route,
            is_international(F.col("origin_country"), F.col("destination_country")).alias("is_international"),
            "total_flights",
            *[f"flights_{y}" for y in years],
            ratio(F.col("micros_sum"), F.col("timed") * minute, 1).alias("avg_duration_min"),
            ratio(F.col("micros_min"), minute, 1).alias("min_duration_min"),
            ratio(F.col("micros_max"), minute, 1).alias("max_duration_min"),
            "primary_airline",
            "primary_airline_iata",
            "first_seen_date",
            "last_seen_date",
            route_label("origin_iata", "destination_iata").alias("route_label"),
        )
    )
    ranked = with_rank(cut_lineage(routes), "total_flights", "route_rank")
    return ranked.orderBy("route_rank") if ordered else ranked


def territory_mart(
    crossings: DataFrame,
    aircraft: DataFrame,
    years: Sequence[int] = MART_YEARS,
    ordered: bool = False,
) -> DataFrame:
    """Crossings per territory with durations, roles, usual airline and rank within its type."""
    return territory_mart_of(territory_days(crossings), aircraft, years, ordered)


_TERRITORY = ("territory_type", "territory_id", "territory_name")
_ROLES = tuple(f"{r.lower()}_crossings" for r in schema.CROSSING_ROLES)


def territory_days(crossings: DataFrame) -> DataFrame:
    """Crossings of positive length per territory, aircraft and date of entry: what the mart adds up."""
    roles = [F.count(F.when(F.col("crossing_role") == r, F.lit(1))).alias(name) for r, name in zip(schema.CROSSING_ROLES, _ROLES)]
    return (
        crossings.filter(F.col("duration_minutes") > 0)
        .groupBy(*_TERRITORY, "icao24", "entered_date")
        .agg(F.count(F.lit(1)).alias("total_crossings"), *roles, F.sum("duration_minutes").alias("minutes_sum"), F.max("duration_minutes").alias("minutes_max"))
    )


def territory_mart_of(days: DataFrame, aircraft: DataFrame, years: Sequence[int] = MART_YEARS, ordered: bool = False) -> DataFrame:
    """``territory_mart`` out of the folded days of ``territory_days``."""
    territory = list(_TERRITORY)
    counts = {
        "total_crossings": F.col("total_crossings"),
        **{f"crossings_{y}": F.when(F.year("entered_date") == y, F.col("total_crossings")).otherwise(0) for y in years},
        **{name: F.col(name) for name in _ROLES},
    }
    per_aircraft = days.groupBy(*territory, "icao24").agg(
        *[F.sum(c).alias(name) for name, c in counts.items()],
        F.sum("minutes_sum").alias("minutes_sum"),
        F.max("minutes_max").alias("minutes_max"),
        F.min("entered_date").alias("first_date"),
        F.max("entered_date").alias("last_date"),
    )
    owner = aircraft.select("icao24", "airline_iata", "airline_name", "country_iso2")
    sided = per_aircraft.join(owner, "icao24", "left").withColumn(
        "side",
        F.explode(F.array(
            F.struct(F.lit("name").alias("kind"), F.col("airline_name").alias("value")),
            F.struct(F.lit("code").alias("kind"), F.col("airline_iata").alias("value")),
            F.struct(F.lit("country").alias("kind"), F.col("country_iso2").alias("value")),
        )),
    )
    per_value = sided.groupBy(*territory, "side.kind", "side.value").agg(
        F.count("icao24").alias("aircraft"),
        *[F.sum(name).alias(name) for name in counts],
        F.sum("minutes_sum").cast("decimal(28,2)").alias("minutes_sum"),
        F.max("minutes_max").alias("minutes_max"),
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
    )
    kind = F.col("kind")
    once = lambda c: F.sum(F.when(kind == "name", F.col(c)))
    stats = (
        per_value.groupBy(*territory)
        .agg(
            *[once(name).alias(name) for name in counts],
            once("aircraft").alias("unique_aircraft"),
            F.count(F.when(kind == "code", F.col("value"))).alias("unique_airlines"),
            once("minutes_sum").alias("minutes_sum"),
            F.max("minutes_max").alias("minutes_max"),
            smallest_mode(F.when(kind == "country", F.col("value")), F.col("total_crossings")).alias("top_aircraft_country"),
            smallest_mode(F.when(kind == "name", F.col("value")), F.col("total_crossings")).alias("top_airline"),
            F.min("first_date").alias("first_crossing_date"),
            F.max("last_date").alias("last_crossing_date"),
        )
        .select(
            *territory, "total_crossings", "unique_aircraft", "unique_airlines",
            *[f"crossings_{y}" for y in years],
            ratio(F.col("minutes_sum") * 100, F.col("total_crossings") * 100, 1).alias("avg_duration_min"),
            F.round("minutes_sum", 1).alias("total_duration_min"),
            F.round("minutes_max", 1).alias("max_duration_min"),
            *[f"{r.lower()}_crossings" for r in schema.CROSSING_ROLES],
            "top_aircraft_country", "top_airline", "first_crossing_date", "last_crossing_date",
        )
    )
    ranked = with_rank(cut_lineage(stats), "total_crossings", "rank_within_type", by=["territory_type"])
    return ranked.orderBy("territory_type", "rank_within_type") if ordered else ranked


def refresh_days(spark: SparkSession, table: str, days: Callable[[DataFrame], DataFrame], history: DataFrame, date: str, touched: Sequence[datetime.date]) -> DataFrame:
    """The table of folded days after folding the touched dates anew; the first time, all dates.

    Only the history partitions of those dates are read and only their partitions of the table are
    written, so a night costs what it brings. Whoever else changes history names its dates here too.
    """
    if not spark.catalog.tableExists(table):
        days(history).write.partitionBy(date).format("parquet").saveAsTable(table)
    elif touched:
        versions.replace(spark, table, days(history.filter(F.col(date).isin(list(touched)))), date, touched)
    return spark.table(table)


def top_routes(mart: DataFrame, k: int = 20) -> DataFrame:
    """Busiest routes of the mart; ties by label and countries."""
    first = mart.orderBy(F.desc("total_flights"), "route_label", "origin_country", "destination_country").limit(k)
    return first.select("route_label", "total_flights", "primary_airline", "avg_duration_min")


def top_territories(mart: DataFrame, territory_type: str = "COUNTRY", k: int = 10) -> DataFrame:
    """Busiest territories of one type."""
    return (
        mart.filter(F.col("territory_type") == territory_type)
        .select("territory_name", "total_crossings", "unique_aircraft")
        .orderBy(F.desc("total_crossings"), "territory_name")
        .limit(k)
    )


def yearly_trend(events: DataFrame) -> DataFrame:
    """Events and distinct aircraft per year.

    Folding to one row per (year, aircraft) first keeps the distinct count a plain count.
    """
    return (
        events.groupBy(F.year("event_date").alias("year"), "icao24")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("year")
        .agg(F.sum("n").alias("total_flights"), F.count("icao24").alias("unique_aircraft"))
    )


def trend_of(days: DataFrame) -> DataFrame:
    """``yearly_trend`` out of stored days that ``bitmaps.fold`` made by ``event_date``; the events are not read."""
    yearly = bitmaps.distinct_of(days.withColumn("year", F.year("event_date")), ["year"], "unique_aircraft")
    return yearly.select("year", F.col("rows").alias("total_flights"), "unique_aircraft")


def write_ordered(mart: DataFrame, table: str, by: Sequence[str], rows_per_file: int = 1_000_000) -> None:
    """Full rebuild of a mart table in the order of ``by``: files and row groups hold ranges, so a reader of the first ranks skips the others."""
    ranged = mart.repartitionByRange(*by).sortWithinPartitions(*by)
    ranged.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).saveAsTable(table)


def write_mart(mart: DataFrame, table: str) -> None:
    """Full rebuild of a mart table."""
    mart.write.mode("overwrite").saveAsTable(table)
