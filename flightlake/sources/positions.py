"""Position documents: one JSON text per poll, one array of slots per aircraft."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.functions import measure
from flightlake.functions.clean import stripped
from flightlake.functions.geometry import in_box

_DOCUMENT = "time bigint, states array<array<string>>"
# Place of each field in an aircraft's slots, and slots needed.
SLOTS = {"icao24": 0, "callsign": 1, "longitude": 5, "latitude": 6, "altitude_m": 7, "on_ground": 8, "velocity_ms": 9, "heading_deg": 10, "vertical_rate_ms": 11}
_LEAST_SLOTS = 12


def parse_positions(documents: DataFrame, body: str = "value", polled_at: Column | None = None, box: tuple | None = None) -> DataFrame:
    """One row per aircraft in the unit system of the event tables.

    Short slot lists are skipped, a document without states gives no rows.
    The poll time is ``polled_at`` or the document's own ``time``. With a ``box``, such as ``geometry.COVERAGE``,
    positions outside it are left out. Numbers out of any range are NULL.
    """
    doc = documents.withColumn("_doc", F.from_json(F.col(body).cast("string"), _DOCUMENT))
    at = polled_at if polled_at is not None else F.timestamp_seconds("_doc.time")
    rows = doc.withColumn("timestamp", at).withColumn("_s", F.explode("_doc.states")).filter(F.size("_s") >= _LEAST_SLOTS)
    slot = lambda name: F.get(F.col("_s"), F.lit(SLOTS[name]))
    number = lambda name: slot(name).try_cast("double")
    call = stripped(slot("callsign"))
    out = rows.select(
        slot("icao24").alias("icao24"),
        F.nullif(call, F.lit("")).alias("callsign"),
        number("longitude").alias("longitude"),
        number("latitude").alias("latitude"),
        measure.feet(number("altitude_m")).alias("altitude_ft"),
        F.coalesce(slot("on_ground").try_cast("boolean"), F.lit(False)).alias("on_ground"),
        measure.kmh(number("velocity_ms")).alias("velocity_kmh"),
        number("heading_deg").alias("heading_deg"),
        measure.feet_per_minute(number("vertical_rate_ms")).alias("vertical_rate_fpm"),
        "timestamp",
    )
    return out if box is None else out.filter(in_box("longitude", "latitude", box))
