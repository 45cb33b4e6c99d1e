"""Presentation text: labels, durations, monitor lines, JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ROUTE_ARROW = " → "


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def route_label(origin: Column | str, destination: Column | str) -> Column:
    """'A → B'; NULL when either end is unknown."""
    return F.concat(_col(origin), F.lit(ROUTE_ARROW), _col(destination))


def duration_text(minutes: Column | str) -> Column:
    """'2h 5m' or '45m'; '—' for nothing."""
    m = _col(minutes).cast("double")
    hours = F.floor(m / 60)
    rest = F.floor(m - hours * 60 + 0.5)
    shown = F.when(hours > 0, F.concat(hours.cast("string"), F.lit("h "), rest.cast("string"), F.lit("m")))
    return F.when(m.isNull() | (m == 0), "—").otherwise(
        shown.otherwise(F.concat(rest.cast("string"), F.lit("m")))
    )


def altitude_text(feet: Column | str) -> Column:
    """Altitude to the nearest 100 ft; '—' for nothing."""
    a = _col(feet).cast("double")
    return F.when(a.isNull() | (a == 0), "—").otherwise(
        F.concat((F.floor(a / 100 + 0.5) * 100).cast("string"), F.lit(" ft"))
    )


def pin_label(role: Column | str, territory_type: Column | str) -> Column:
    """Map labels of a crossing."""
    r, t = _col(role), _col(territory_type)
    return F.when(r == "START", "DEP").when(r == "END", "ARR").when(t == "STATE", "ST").otherwise("CO")


def currently_inside(status: Column | str, exited_at: Column | str) -> Column:
    return F.coalesce((_col(status) == "IN_PROGRESS") & _col(exited_at).isNull(), F.lit(False))


def holds_text(needle: str, *columns: Column | str) -> Column:
    """Case-insensitive substring search over several columns."""
    low = needle.lower()
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.lower(_col(c)).contains(low), F.lit(False))
    return hit


def monitor_line() -> Column:
    """One readable line per event message."""
    return F.format_string(
        "%-12s | %s | %8s | alt=%,8.0fft",
        F.col("event_type"),
        F.col("icao24"),
        F.coalesce(F.col("callsign"), F.lit("unknown")),
        F.coalesce(F.col("altitude_ft").cast("double"), F.lit(0.0)),
    )
