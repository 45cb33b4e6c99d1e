from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from flightlake import schema
from flightlake.operators import crossings, events, geo

T0 = datetime(2026, 4, 22, 12, 0, 0)
PING = "icao24 string, timestamp timestamp, on_ground boolean, vertical_rate_fpm double, altitude_ft double, longitude double, latitude double, callsign string, velocity_kmh double, heading_deg double"


def pings(spark, tracks):
    """``tracks``: aircraft -> [(minute, on_ground, rate, altitude, lon, lat)]."""
    data = [(k, T0 + timedelta(minutes=m), g, r, a, x, y, f"F{k}", 800.0, 90.0) for k, t in tracks.items() for m, g, r, a, x, y in t]
    return spark.createDataFrame(data, PING)


@pytest.mark.parametrize("before,now,event", [
    ((False, 0.0), (True, 0.0, 0.0), "LANDED"),
    ((True, 0.0), (False, 900.0, 500.0), "DEPARTED"),
    ((False, 0.0), (False, 201.0, 500.0), "CLIMBING"),
    ((False, 900.0), (False, 300.0, 500.0), "CLIMBING"),
    ((False, 0.0), (False, -201.0, 20000.0), "DESCENDING"),
    ((False, 900.0), (False, 200.0, 10001.0), "CRUISING"),
    ((False, -900.0), (False, -200.0, 10001.0), "CRUISING"),
    ((False, 900.0), (False, 100.0, 10000.0), None),
    ((False, 200.0), (False, 0.0, 30000.0), None),
    ((False, None), (False, None, None), None),
    ((False, 900.0), (False, None, 30000.0), "CRUISING"),
    ((True, 0.0), (True, 900.0, 0.0), None),
])
def test_event_rule(spark, before, now, event):
    df = pings(spark, {"a": [(0, before[0], before[1], 0.0, 1.0, 1.0), (1, *now, 1.0, 1.0)]})
    got = events.with_event_type(df).orderBy("timestamp").select("event_type").collect()
    assert [r[0] for r in got] == [None, event]


def test_every_event_has_a_predecessor(spark):
    df = pings(spark, {"a": [(0, False, 500.0, 0.0, 1.0, 1.0)], "b": [(0, True, 0.0, 0.0, 1.0, 1.0), (200, False, 500.0, 0.0, 1.0, 1.0)]})
    got = events.detect_events(df).collect()
    assert [(r["icao24"], r["event_type"]) for r in got] == [("b", "DEPARTED")]


@pytest.fixture(scope="module")
def index(spark):
    box = lambda x0, x1: f"POLYGON (({x0} 0, {x1} 0, {x1} 10, {x0} 10, {x0} 0))"
    shapes = [("COUNTRY", 1, "A", box(0, 10)), ("COUNTRY", 2, "B", box(20, 30)), ("STATE", 51, "A1", box(5, 10))]
    return geo.build_cells(geo.boundary_edges(spark.createDataFrame(shapes, "level string, territory_id int, territory_name string, wkt string")), 5.0)


FLIGHT = [
    (0, False, 0.0, 20000.0, 1.0, 5.0),       # airborne when first seen: no event yet, not tracked
    (1, False, 0.0, 20000.0, 2.0, 5.0),
    (2, True, 0.0, 0.0, 3.0, 5.0),            # LANDED
    (60, False, 900.0, 500.0, 3.0, 5.0),      # DEPARTED, in A
    (61, False, 900.0, 5000.0, 4.0, 5.0),
    (62, False, 900.0, 9000.0, 6.0, 5.0),     # state A1
    (63, False, 0.0, 20000.0, 15.0, 5.0),     # water
    (150, False, 0.0, 20000.0, 9.0, 5.0),     # back in A1: same stay
    (151, False, 0.0, 20000.0, 25.0, 5.0),    # B
    (152, False, -900.0, 9000.0, 26.0, 5.0),
    (153, True, 0.0, 0.0, 26.0, 5.0),         # LANDED
    (154, True, 0.0, 0.0, 26.0, 5.0),
    (300, False, 900.0, 500.0, 26.0, 5.0),    # next leg, in B, never closed
]


def stays(df):
    return sorted(
        (r["icao24"], int((r["entered_at"] - T0).total_seconds() / 60), r["territory_name"], r["crossing_role"], r["flight_status"],
         None if r["exited_at"] is None else int((r["exited_at"] - T0).total_seconds() / 60), r["event_type"])
        for r in df.collect()
    )


WANT = [
    ("x", 60, "A", "START", "IN_PROGRESS", 62, "DEPARTED"),
    ("x", 62, "A1", "ROUTE", "IN_PROGRESS", 151, "CLIMBING"),
    ("x", 151, "B", "ROUTE", "COMPLETED", 153, "CRUISING"),
    ("x", 300, "B", "START", "IN_PROGRESS", None, "DEPARTED"),
]


@pytest.mark.parametrize("width", [600, 3600, 10**7])
def test_sessions(spark, index, width):
    got = stays(crossings.territory_sessions(pings(spark, {"x": FLIGHT}), index, width=width))
    want = list(WANT)
    # Level flight after the climb at minute 63 is CRUISING and is the last event when B is entered.
    assert got == sorted(want)


def test_sessions_mark_end_and_unknown_aircraft(spark, index):
    known = spark.createDataFrame([("x",)], "icao24 string")
    df = pings(spark, {"x": FLIGHT, "y": FLIGHT})
    got = stays(crossings.territory_sessions(df, index, aircraft=known, mark_end=True))
    assert {g[0] for g in got} == {"x"}
    assert [g[3] for g in sorted(got, key=lambda g: g[1])] == ["START", "ROUTE", "END", "START"]


def test_sessions_never_overlap(spark, index):
    tracks = {f"p{i}": [(j * 7, (i * j) % 5 == 0, float((i * 31 + j * 17) % 900 - 450), 12000.0, float((i * 13 + j * 7) % 34), 5.0) for j in range(40)] for i in range(6)}
    got = crossings.territory_sessions(pings(spark, tracks), index).collect()
    by = {}
    for r in sorted(got, key=lambda r: r["entered_at"]):
        last = by.get(r["icao24"])
        assert last is None or (last["exited_at"] is not None and last["exited_at"] <= r["entered_at"])
        by[r["icao24"]] = r
    assert len(got) > 10


def test_crossing_rows_have_the_table_shape(spark, index):
    rows = crossings.crossing_rows(crossings.territory_sessions(pings(spark, {"x": FLIGHT}), index), F.lit("2026-04-22").cast("timestamp"))
    assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in schema.DAILY_CROSSING]
    assert rows.filter("exited_at is not null").agg(F.min("duration_minutes")).first()[0] == Decimal("2.00")
    detected = events.event_rows(events.detect_events(pings(spark, {"x": FLIGHT})), F.lit("2026-04-22").cast("timestamp"))
    orphans = rows.join(detected.select(F.col("event_id").alias("flight_event_id")), "flight_event_id", "left_anti")
    assert orphans.count() == 0


def test_zero_coordinates(spark, index):
    track = {"z": [(0, True, 0.0, 0.0, 1.0, 5.0), (1, False, 900.0, 500.0, 0.0, 5.0)]}
    assert len(stays(crossings.territory_sessions(pings(spark, track), index, exact_zero=True))) == 0
    grown = geo.boundary_edges(spark.createDataFrame([("COUNTRY", 1, "A", "POLYGON ((-5 0, 5 0, 5 10, -5 10, -5 0))")], "level string, territory_id int, territory_name string, wkt string"))
    assert len(stays(crossings.territory_sessions(pings(spark, track), geo.build_cells(grown, 5.0)))) == 1


def flight(spark, lon1, lon2, minutes=100):
    return spark.createDataFrame(
        [(7, 8, "x", "Fx", T0, T0 + timedelta(minutes=minutes), 5.0, lon1, 5.0, lon2)],
        "departed_event_id long, landed_event_id long, icao24 string, callsign string, firstseen timestamp, lastseen timestamp, lat1 double, lon1 double, lat2 double, lon2 double")


def test_route_samples(spark):
    got = [(r["step"], round(r["longitude"], 6), r["fraction"]) for r in crossings.route_samples(flight(spark, 0.0, 30.0)).orderBy("step").collect()]
    assert got == [(i, 3.0 * i, i / 10) for i in range(11)]


def test_route_crossings(spark, index):
    run = F.lit("2026-05-01").cast("timestamp")
    got = crossings.route_crossings(flight(spark, 0.5, 29.5), index, run).orderBy("entered_at").collect()
    minutes = lambda t: (t - T0).total_seconds() / 60
    # Water between the countries belongs to the first stay.
    assert [(r["territory_name"], r["crossing_role"], r["flight_event_id"], minutes(r["entered_at"]), minutes(r["exited_at"]), r["duration_minutes"]) for r in got] == [
        ("A", "START", 7, 0.0, 70.0, Decimal("70.00")), ("B", "END", 8, 70.0, 100.0, Decimal("30.00"))]
    assert got[0]["flight_status"] == "COMPLETED" and got[0]["batch_date"] == date(2026, 5, 1)
    one = crossings.route_crossings(flight(spark, 1.0, 9.0), index, run).collect()
    assert [r["crossing_role"] for r in one] == ["START"]
    assert crossings.route_crossings(flight(spark, 12.0, 18.0), index, run).count() == 0
    odd = crossings.route_crossings(flight(spark, 0.5, 29.5, minutes=-5), index, run).collect()
    assert all(r["duration_minutes"] is None and r["entered_at"] == T0 for r in odd)


EVENT = "event_id long, icao24 string, callsign string, event_type string, event_timestamp timestamp, event_date date, latitude double, longitude double, source string"


def legs(spark, data):
    rows = [(i, k, None, e, T0 + timedelta(hours=h), (T0 + timedelta(hours=h)).date(), 1.0, 2.0, "s") for i, (k, e, h) in enumerate(data)]
    return spark.createDataFrame(rows, EVENT)


def test_pairs(spark):
    df = legs(spark, [("a", "DEPARTED", 0), ("a", "LANDED", 2), ("a", "DEPARTED", 4), ("a", "LANDED", 6), ("b", "DEPARTED", 1), ("c", "DEPARTED", 10), ("c", "LANDED", 15)])
    got = sorted((r["departed_event_id"], r["landed_event_id"]) for r in events.pair_next_landing(df).collect())
    assert got == [(0, 1), (2, 3), (5, 6)]
    same_day = sorted(r["departed_event_id"] for r in events.flight_pairs(df, source="s").collect())
    assert same_day == [0, 2]
    assert [r["event_id"] for r in events.departed_never_landed(df).collect()] == [4]
    # All combinations are counted without being formed: 2 x 2 for a, none for b and c.
    assert events.count_flights(df, source="s").first()["flights"] == 4


def test_flight_list(spark):
    columns = {c: None for c in schema.FLIGHT_LIST_COLUMNS}
    base = {**columns, "icao24": " ab12 ", "callsign": "nan", "origin": "DNMM", "destination": "XXXX", "firstseen": "1577836800", "lastseen": "2020-01-01 02:00:00",
            "latitude_1": "6.5", "longitude_1": "3.3", "altitude_1": "100", "latitude_2": "nan", "longitude_2": "4", "altitude_2": "0"}
    data = [base, {**base, "lastseen": "None"}, {**base, "icao24": "  "}]
    df = spark.createDataFrame([tuple(d[c] for c in schema.FLIGHT_LIST_COLUMNS) for d in data], schema.FLIGHT_LIST)
    airports = spark.createDataFrame([("1", "DNMM", "XXX"), ("2", "DNMM", "LOS")], "ident string, airport_icao_code string, airport_iata_code string")
    typed = events.typed_flights(df)
    assert typed.filter("accepted").count() == 1
    run = F.lit("2026-01-01").cast("timestamp")
    out = {r["event_type"]: r for r in events.flights_to_events(typed, airports, run).collect()}
    assert set(out) == {"DEPARTED", "LANDED"}
    assert out["DEPARTED"]["origin_iata"] == "LOS" and out["DEPARTED"]["destination_iata"] is None
    assert out["DEPARTED"]["altitude_ft"] == Decimal("328.10") and out["LANDED"]["altitude_ft"] == Decimal("0.00")
    assert out["LANDED"]["latitude"] is None and out["LANDED"]["event_timestamp"] == datetime(2020, 1, 1, 2)
    assert out["DEPARTED"]["icao24"] == "ab12" and out["DEPARTED"]["callsign"] is None and out["DEPARTED"]["velocity_kmh"] is None
    exact = {r["event_type"]: r for r in events.flights_to_events(typed, airports, run, exact=True).collect()}
    assert exact["LANDED"]["altitude_ft"] is None


def test_complete_flights(spark):
    day = T0.date()
    rows = [(k, T0 + timedelta(minutes=m), day, r, s) for k, m, r, s in [
        ("a", 0, "START", "IN_PROGRESS"), ("a", 5, "ROUTE", "IN_PROGRESS"), ("a", 9, "ROUTE", "COMPLETED"), ("a", 60, "START", "IN_PROGRESS"), ("a", 70, "ROUTE", "IN_PROGRESS"),
        ("b", 0, "START", "IN_PROGRESS")]]
    df = spark.createDataFrame(rows, "icao24 string, entered_at timestamp, entered_date date, crossing_role string, flight_status string")
    got = sorted((r["icao24"], (r["entered_at"] - T0).seconds // 60, r["flight_status"]) for r in crossings.complete_flights(df).collect())
    assert [g[2] for g in got] == ["COMPLETED"] * 3 + ["IN_PROGRESS"] * 3


def test_close_carried(spark):
    row = lambda k, m, status, out: (k, T0 + timedelta(minutes=m), status, out, out and out.date(), None)
    hist = spark.createDataFrame([row("a", 0, "IN_PROGRESS", None), row("a", -60, "COMPLETED", T0), row("b", 0, "IN_PROGRESS", None), row("c", 0, "IN_PROGRESS", None), row("d", 500, "IN_PROGRESS", None)],
                                 "icao24 string, entered_at timestamp, flight_status string, exited_at timestamp, exited_date date, duration_minutes decimal(8,2)")
    later = T0 + timedelta(minutes=90)
    today = spark.createDataFrame([("a", later, True), ("b", later, False), ("d", later, True)], "icao24 string, closed_at timestamp, landed boolean")
    got = {(r["icao24"], r["entered_at"]): (r["flight_status"], r["exited_at"], r["duration_minutes"]) for r in crossings.close_carried(hist, today).collect()}
    assert got[("a", T0)] == ("COMPLETED", later, Decimal("90.00"))
    assert got[("a", T0 - timedelta(minutes=60))] == ("COMPLETED", T0, None)
    assert got[("b", T0)] == ("IN_PROGRESS", later, Decimal("90.00"))
    assert got[("c", T0)][1] is None and got[("d", T0 + timedelta(minutes=500))][1] is None
