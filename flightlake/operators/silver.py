"""Enrichment of the day's events with airports from flight records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.operators.events import with_route_codes
from flightlake.plans.sequence import latest_per_key
from flightlake.sources import versions


def _of_day(events: DataFrame, day: str) -> DataFrame:
    return events.filter(F.col("event_date") == F.lit(day).cast("date"))


def worklist(events: DataFrame, day: str) -> DataFrame:
    """Aircraft with a departure or landing of the day that lacks an airport, in order."""
    lacking = F.col("origin_iata").isNull() | F.col("destination_iata").isNull()
    return _of_day(events, day).filter(F.col("event_type").isin("DEPARTED", "LANDED") & lacking).select("icao24").distinct().orderBy("icao24")


def resolved_routes(work: DataFrame, records: DataFrame, airports: DataFrame) -> DataFrame:
    """Work list with the airports of each aircraft's latest flight record.

    ``records`` holds ``icao24, estDepartureAirport, estArrivalAirport, lastSeen``.
    ``found`` tells whether there was any record.
    """
    wanted = records.join(work, "icao24", "left_semi")
    order = ["lastSeen", "estDepartureAirport", "estArrivalAirport"]
    latest = latest_per_key(wanted.select("icao24", *order), ["icao24"], order)
    coded = with_route_codes(latest, airports, "estDepartureAirport", "estArrivalAirport")
    return work.join(
        coded.select("icao24", F.col("origin_iata").alias("new_origin"), F.col("destination_iata").alias("new_destination"), F.lit(True).alias("_hit")),
        "icao24", "left",
    ).withColumn("found", F.coalesce("_hit", F.lit(False))).drop("_hit")


def enrich(events: DataFrame, routes: DataFrame, day: str, fill_only: bool = False) -> DataFrame:
    """Events with airports filled in, and ``changed``.

    Both ends known: both are set on rows lacking either, which may replace a
    known end; ``fill_only`` never replaces. One end known: it fills gaps of
    that column. Nothing known, or another day: unchanged.
    """
    o, d = F.col("origin_iata"), F.col("destination_iata")
    new_o, new_d = F.col("new_origin"), F.col("new_destination")
    today = F.col("event_date") == F.lit(day).cast("date")
    both = new_o.isNotNull() & new_d.isNotNull() & (o.isNull() | d.isNull())
    set_both = today & both & F.lit(not fill_only)
    joined = events.join(routes.select("icao24", "new_origin", "new_destination"), "icao24", "left")
    origin = F.when(set_both, new_o).when(today & o.isNull(), new_o).otherwise(o)
    destination = F.when(set_both, new_d).when(today & d.isNull(), new_d).otherwise(d)
    return (
        joined.withColumn("_o", origin).withColumn("_d", destination)
        .withColumn("changed", ~F.col("_o").eqNullSafe(o) | ~F.col("_d").eqNullSafe(d))
        .withColumn("touched", F.coalesce(today & (
            both | (new_o.isNotNull() & new_d.isNull() & o.isNull()) | (new_d.isNotNull() & new_o.isNull() & d.isNull())
        ), F.lit(False)))
        .withColumn("origin_iata", F.col("_o")).withColumn("destination_iata", F.col("_d"))
        .select(*events.columns, "changed", "touched")
    )


def changed_rows(enriched: DataFrame) -> DataFrame:
    return enriched.agg(F.count_if("changed").alias("changed"), F.count_if("touched").alias("updated"))


def enrich_summary(routes: DataFrame, enriched: DataFrame) -> DataFrame:
    """One row: aircraft processed, with and without a record, and rows updated."""
    work = routes.select(F.lit(1).alias("processed"), F.col("found").cast("int").alias("enriched"), F.lit(0).alias("rows_updated"))
    rows = enriched.filter("touched").select(F.lit(0).alias("processed"), F.lit(0).alias("enriched"), F.lit(1).alias("rows_updated"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return work.unionByName(rows).agg(total("processed"), total("enriched"), total("rows_updated")).withColumn(
        "no_data", F.col("processed") - F.col("enriched")
    )


def completeness(events: DataFrame, day: str | None = None) -> DataFrame:
    """How many events have each airport."""
    chosen = events if day is None else _of_day(events, day)
    every = F.count(F.lit(1))
    return chosen.agg(
        every.alias("total"),
        F.count("origin_iata").alias("has_origin"),
        F.count("destination_iata").alias("has_destination"),
        (every - F.count("origin_iata")).alias("missing_origin"),
        (every - F.count("destination_iata")).alias("missing_destination"),
    )


def rewrite_day(enriched: DataFrame, table: str, day: str) -> None:
    """Replace the partition of a day with the enriched rows; other days are not touched."""
    versions.replace(enriched.sparkSession, table, _of_day(enriched, day).drop("changed", "touched"), "event_date", [day])
