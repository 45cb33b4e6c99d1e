"""Units, durations, rounding and clock expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit factors and live thresholds.
FEET_PER_METRE = "3.28084"
KMH_PER_MS = "3.6"
FPM_PER_MS = "196.85"
CLIMB_FPM = 200
CRUISE_ALTITUDE_FT = 10_000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def scaled(c: Column | str, factor: str) -> Column:
    """``c * factor`` to one decimal, half away from zero; NULL stays NULL.

    The product is exact: both sides are decimals. A value of 10^12 or more is no measurement: NULL.
    """
    exact = F.lit(factor).cast("decimal(9,5)")
    return F.round(_col(c).try_cast("decimal(18,6)") * exact, 1).cast("double")


def feet(metres: Column | str) -> Column:
    return scaled(metres, FEET_PER_METRE)


def kmh(ms: Column | str) -> Column:
    return scaled(ms, KMH_PER_MS)


def feet_per_minute(ms: Column | str) -> Column:
    return scaled(ms, FPM_PER_MS)


def micros_between(start: Column | str, end: Column | str) -> Column:
    return F.unix_micros(_col(end)) - F.unix_micros(_col(start))


def ratio(part: Column, whole: Column, digits: int) -> Column:
    """``part / whole`` of two whole numbers, rounded half away from zero; NULL when ``whole`` is 0."""
    quotient = part.cast("decimal(24,0)") / F.nullif(whole.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.round(quotient, digits)


def minutes(micros: Column, digits: int = 2) -> Column:
    """Microseconds as decimal minutes."""
    return ratio(micros, F.lit(60_000_000), digits)


def stay_minutes(start: Column | str, end: Column | str) -> Column:
    """Minutes of a stay; one too long for the tables (694 days) has none."""
    return minutes(micros_between(start, end), 2).try_cast("decimal(8,2)")


def moment_between(start: Column | str, end: Column | str, part: Column, parts: Column | int) -> Column:
    """Moment ``part / parts`` of the way from ``start`` to ``end``, in whole microseconds."""
    whole = parts if isinstance(parts, Column) else F.lit(parts)
    step = F.round(part.cast("decimal(10,0)") * micros_between(start, end).cast("decimal(20,0)") / whole.cast("decimal(10,0)"), 0)
    return F.timestamp_micros(F.unix_micros(_col(start)) + step.cast("bigint"))


def hhmm_to_minutes(c: Column | str) -> Column:
    """Clock number HHMM as minutes after midnight; impossible times are NULL (2400 is midnight)."""
    n = _col(c)
    hour, minute = F.floor(n / 100), F.pmod(n, F.lit(100))
    return F.when((hour >= 0) & (hour <= 24) & (minute < 60), F.pmod((hour * 60 + minute).cast("int"), F.lit(1440)))


def flag(c: Column | str) -> Column:
    """0/1 text or number as boolean."""
    return _col(c).cast("string").try_cast("double") == 1.0


def iso_text(ts: Column | str) -> Column:
    """ISO-8601 text of a UTC timestamp."""
    return F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def age_years(born: Column | str, at: Column | str) -> Column:
    """Years between two dates to one decimal."""
    return F.round(F.months_between(_col(at), _col(born), False).cast("decimal(12,6)") / 12, 1).cast("decimal(5,1)")


def delay_class(probability: Column | str) -> Column:
    """Label of a delay probability. Thresholds 0.30 and 0.65."""
    p = _col(probability)
    return F.when(p < 0.30, "ON_TIME").when(p < 0.65, "MINOR_DELAY").when(p >= 0.65, "MAJOR_DELAY")


def is_late(arrival_delay_min: Column | str) -> Column:
    """More than 15 minutes late on arrival."""
    return _col(arrival_delay_min) > 15
