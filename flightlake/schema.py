"""Table contracts: schemas, natural keys, enumerations and text limits."""

from __future__ import annotations

from pyspark.sql import types as T

# Event, crossing and prediction vocabularies of the data model.
EVENT_TYPES = ("DEPARTED", "CLIMBING", "CRUISING", "DESCENDING", "LANDED")
CROSSING_ROLES = ("START", "ROUTE", "END")
FLIGHT_STATUSES = ("IN_PROGRESS", "COMPLETED")
TERRITORY_TYPES = ("COUNTRY", "STATE", "LANDMARK", "BODY_OF_WATER")
DELAY_CLASSES = ("ON_TIME", "MINOR_DELAY", "MAJOR_DELAY")
LIVE_SOURCE = "opensky"
HISTORY_SOURCE = "opensky_historical"

EVENT_KEY = ("icao24", "event_timestamp", "event_type")
CROSSING_KEY = ("icao24", "entered_at", "territory_id")
AIRCRAFT_KEY = ("icao24",)
AIRPORT_KEY = ("ident",)
STATE_KEY = ("adm1_code",)


_PLAIN = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
    "boolean": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampType(),
}


def _kind(text: str) -> T.DataType:
    if text.startswith("decimal("):
        precision, scale = text[len("decimal("):-1].split(",")
        return T.DecimalType(int(precision), int(scale))
    return _PLAIN[text]


def _struct(spec: str) -> T.StructType:
    """Schema from ``name type`` pairs; a trailing ``!`` marks a required column."""
    out = T.StructType()
    for line in filter(None, (part.strip() for part in spec.strip().splitlines())):
        name, kind = line.split(None, 1)
        required = kind.endswith("!")
        out.add(name, _kind(kind.rstrip("!").strip()), not required)
    return out


_MOVEMENT = """
    icao24 string !
    callsign string
    event_type string !
    event_timestamp timestamp !
    event_date date !
    latitude decimal(9,6)
    longitude decimal(9,6)
    altitude_ft decimal(10,2)
    velocity_kmh decimal(8,2)
    heading_deg decimal(6,2)
    vertical_rate_fpm decimal(8,2)
    on_ground boolean
    origin_iata string
    destination_iata string
    source string
    created_at timestamp
"""
_STAY = """
    flight_event_id bigint !
    icao24 string !
    callsign string
    territory_type string !
    territory_id int !
    territory_name string !
    crossing_role string !
    flight_status string !
    entered_at timestamp !
    entered_date date !
    exited_at timestamp
    exited_date date
    duration_minutes decimal(8,2)
    created_at timestamp
"""
_ROLLED = """
    inserted_at timestamp
    batch_date date
"""

DAILY_EVENT = _struct("event_id bigint\n" + _MOVEMENT)
HIST_EVENT = _struct("event_id bigint\n" + _MOVEMENT + _ROLLED)
DAILY_CROSSING = _struct("crossing_id bigint\n" + _STAY)
HIST_CROSSING = _struct("crossing_id bigint\n" + _STAY + "source string !\n" + _ROLLED + "updated_at timestamp")

PING = _struct(
    """
    icao24 string
    callsign string
    longitude double
    latitude double
    altitude_ft double
    on_ground boolean
    velocity_kmh double
    heading_deg double
    vertical_rate_fpm double
    timestamp timestamp
    """
)
MESSAGE = _struct(
    """
    icao24 string
    callsign string
    event_type string
    event_timestamp string
    latitude double
    longitude double
    altitude_ft double
    velocity_kmh double
    heading_deg double
    vertical_rate_fpm double
    on_ground boolean
    source string
    """
)
AIRCRAFT = _struct(
    """
    icao24 string !
    registration string
    manufacturername string
    model string
    type_code string
    icao_aircraft_type string
    weight_category string
    airline_name string
    operatorcallsign string
    airline_icao string
    airline_iata string
    country_iso2 string
    country_of_reg string
    engines string
    first_flight_date date
    is_active boolean
    """
)
AIRPORT = _struct(
    """
    ident string !
    airport_iata_code string
    airport_icao_code string
    airport_name string
    airport_type string
    is_commercial boolean
    municipality string
    iso_country string
    continent string
    iso_region string
    region_name string
    latitude_deg decimal(9,6)
    longitude_deg decimal(9,6)
    """
)
COUNTRY = _struct(
    """
    country_id int !
    iso2 string
    iso3 string
    country_name string !
    formal_name string
    continent string
    subregion string
    centroid_lon decimal(9,6)
    centroid_lat decimal(9,6)
    population bigint
    boundary string
    """
)
STATE = _struct(
    """
    state_id int !
    adm1_code string !
    iso_3166_2 string
    state_name string !
    state_type string
    country_iso3 string
    country_iso2 string
    country_name string !
    centroid_lon decimal(9,6)
    centroid_lat decimal(9,6)
    boundary string
    """
)
US_DELAY = _struct(
    """
    flight_date date !
    airline_name string
    airline_iata string
    flight_number int
    origin_iata string
    destination_iata string
    distance_miles int
    scheduled_dep_time int
    scheduled_arr_time int
    scheduled_elapsed_min int
    actual_dep_time int
    actual_arr_time int
    actual_elapsed_min int
    air_time_min int
    taxi_out_min int
    taxi_in_min int
    departure_delay_min decimal(6,1)
    arrival_delay_min decimal(6,1)
    is_cancelled boolean
    cancellation_code string
    is_diverted boolean
    delay_carrier_min decimal(6,1)
    delay_weather_min decimal(6,1)
    delay_nas_min decimal(6,1)
    delay_security_min decimal(6,1)
    delay_late_aircraft_min decimal(6,1)
    """
)
DELAY_PREDICTION = _struct(
    """
    icao24 string !
    callsign string
    flight_date date !
    origin_iata string
    destination_iata string
    airline_iata string
    aircraft_age_years decimal(5,1)
    weight_category string
    icao_aircraft_type string
    departure_hour int
    departure_day_of_week int
    origin_congestion_score decimal(10,2)
    is_international boolean
    departure_delay_min decimal(6,1)
    delay_probability decimal(5,4)
    predicted_delay_class string
    model_version string
    predicted_at timestamp
    """
)

# Column names of the monthly flight list, in file order.
FLIGHT_LIST_COLUMNS = (
    "callsign", "number", "icao24", "registration", "typecode", "origin", "destination",
    "firstseen", "lastseen", "day", "latitude_1", "longitude_1", "altitude_1",
    "latitude_2", "longitude_2", "altitude_2",
)
FLIGHT_LIST = T.StructType([T.StructField(c, T.StringType()) for c in FLIGHT_LIST_COLUMNS])

# Longest text each limited column may hold.
TEXT_LIMITS = {
    "airport": {
        "ident": 10, "airport_iata_code": 3, "airport_icao_code": 4, "airport_type": 20,
        "iso_country": 2, "continent": 2, "iso_region": 10,
    },
    "aircraft": {
        "icao24": 10, "registration": 20, "icao_aircraft_type": 10, "airline_iata": 10, "country_iso2": 2,
    },
    "country": {"iso2": 2, "iso3": 3},
    "state": {"adm1_code": 10, "iso_3166_2": 10, "state_type": 36, "country_iso3": 3, "country_iso2": 2},
    "event": {
        "icao24": 10, "callsign": 20, "event_type": 30, "origin_iata": 10, "destination_iata": 10, "source": 20,
    },
}
