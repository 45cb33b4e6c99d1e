"""Column expressions that clean and type text. No Python runs per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLANKS = " \t\n\r\f\v"
# Texts that stand for a missing value.
_MISSING = ("", "nan", "none")
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
# Accepted formats. A time is a date and a clock time with a blank or T between them and
# an optional zone; a date is m/d/y, y-m-d or d/m/y, tried in this order.
_TIME_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{1,2}:\d{1,2}([+-]\d{2}:?\d{2}|Z)?$"
_TIME_FORMAT = "yyyy-M-d H:m:s[XXX][XX]"
_SLASHED = r"^\d{1,2}/\d{1,2}/\d{4}$"
_DASHED = r"^\d{4}-\d{1,2}-\d{1,2}$"
# Codes meaning "no official ISO code", and one ISO patch.
_NO_ISO = ("-99", "-9")
_ISO_PATCH = {"CN-TW": "TW"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def stripped(c: Column | str) -> Column:
    """Text without leading and trailing white space."""
    return F.btrim(_col(c), F.lit(_BLANKS))


def clean_text(c: Column | str) -> Column:
    """Trimmed text; blank, 'nan' and 'none' in any case become NULL."""
    t = stripped(c)
    return F.when(~F.lower(t).isin(*_MISSING), t)


def to_double(c: Column | str) -> Column:
    """Number in a text, or NULL. 'nan' and infinities are NULL too."""
    t = stripped(c)
    return F.when(t.rlike(_NUMBER), t).try_cast("double")


def to_time(c: Column | str) -> Column:
    """Unix seconds, else a date and clock time; zone-less text is UTC (the session zone).

    The shape is tested first, so texts of another kind never reach the parser.
    """
    t = stripped(c)
    seconds = F.round(F.when(t.rlike(_NUMBER), t).try_cast("double") * F.lit(1e6)).try_cast("bigint")
    written = F.try_to_timestamp(F.when(t.rlike(_TIME_SHAPE), F.translate(t, "T", " ")), F.lit(_TIME_FORMAT))
    return F.coalesce(F.timestamp_micros(seconds), written)


def to_day(c: Column | str) -> Column:
    """Date written m/d/y, y-m-d or d/m/y, else NULL. Day first is read only where month first cannot be."""
    t = stripped(c)
    slashed = F.when(t.rlike(_SLASHED), t)
    month_first = F.substring_index(slashed, "/", 1).cast("int") <= 12
    return F.coalesce(
        F.try_to_date(F.when(month_first, slashed), "M/d/yyyy"),
        F.try_to_date(F.when(~month_first, slashed), "d/M/yyyy"),
        F.try_to_date(F.when(t.rlike(_DASHED), t), "yyyy-M-d"),
    )


def yes(c: Column | str) -> Column:
    """TRUE only for the text 'yes'; missing text is FALSE."""
    return F.coalesce(F.lower(stripped(c)) == "yes", F.lit(False))


def iso_code(c: Column | str) -> Column:
    """ISO code with its placeholder codes removed and patches applied."""
    t = clean_text(c)
    out = F.when(t.isin(*_NO_ISO), F.lit(None).cast("string"))
    for wrong, right in _ISO_PATCH.items():
        out = out.when(t == wrong, F.lit(right))
    return out.otherwise(t)


def population(c: Column | str) -> Column:
    """Whole positive head count, else NULL."""
    n = F.floor(to_double(_col(c).cast("string"))).cast("bigint")
    return F.when(n > 0, n)


def first_text(*cs: Column | str) -> Column:
    """First of several texts that is not missing."""
    return F.coalesce(*[clean_text(c) for c in cs])


def shown_callsign(callsign: Column | str, icao24: Column | str) -> Column:
    """Callsign, or the aircraft id where it has none."""
    return F.coalesce(F.nullif(_col(callsign), F.lit("")), _col(icao24))


def type_code_patch(c: Column | str) -> Column:
    """Over-long aircraft type text reduced to the code in its last parentheses.

    Fixed values: the marker text and the length limit 10.
    """
    t = stripped(c)
    hit = (F.length(t) > 10) & t.contains("BOEING ICAO Manufacturer Code") & t.rlike(r"\([^()]*\)")
    return clean_text(F.when(hit, F.regexp_extract(t, r"\(([^()]*)\)[^()]*$", 1)).otherwise(t))


def operator_code_patch(c: Column | str) -> Column:
    """Over-long operator text replaced by its code.

    Fixed values: the marker text (with a tab), the code WN and the length limit 10.
    """
    t = stripped(c)
    hit = (F.length(t) > 10) & t.contains("SWA\t Airline IATA")
    return clean_text(F.when(hit, F.lit("WN")).otherwise(t))
