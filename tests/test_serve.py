from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from flightlake.operators import features, marts, serve

NOON = datetime(2026, 4, 22, 12)
EVENT = "event_id long, icao24 string, callsign string, event_type string, event_timestamp timestamp, event_date date, latitude double, longitude double, altitude_ft double, velocity_kmh double, heading_deg double, on_ground boolean, origin_iata string"


def events(spark):
    row = lambda i, k, e, m, g, alt=None, origin=None, call=None: (i, k, call, e, NOON + timedelta(minutes=m), NOON.date(), 1.0, 2.0, alt, None, None, g, origin)
    return spark.createDataFrame([
        row(1, "a", "DEPARTED", 0, False, 100.0, "LOS"), row(2, "a", "CRUISING", 9, False, 30000.0, "LOS"), row(3, "b", "CLIMBING", 1, False, None, call="KQ1"),
        row(4, "c", "LANDED", 3, True), (5, "d", None, "CRUISING", NOON, date(2026, 4, 21), 1.0, 2.0, 5.0, None, None, False, None)], EVENT)


def test_latest_positions(spark):
    got = serve.live_board(serve.latest_positions(events(spark), "2026-04-22")).collect()
    assert [(r["icao24"], r["callsign"], r["event_type"], r["altitude_shown"], r["source"]) for r in got] == [
        ("a", "a", "CRUISING", "30000 ft", "batch"), ("b", "KQ1", "CLIMBING", "—", "batch")]
    assert [r["icao24"] for r in serve.search(serve.latest_positions(events(spark)), "kq").collect()] == ["b"]


def test_source_choice(spark):
    batch = serve.latest_positions(events(spark), "2026-04-22")
    empty = batch.filter("false")
    assert serve.choose_positions(None, batch) is batch and serve.choose_positions(empty, batch) is batch
    cache = batch.withColumn("source", F.lit("stream"))
    assert {r["source"] for r in serve.choose_positions(cache, batch).collect()} == {"stream"}
    # On the equator is a position, as in the batch result.
    level = cache.withColumn("latitude", F.lit(0.0))
    assert serve.choose_positions(level, batch).count() == cache.count()


def test_daily_stats(spark):
    got = serve.daily_stats(events(spark), "2026-04-22").first().asDict()
    assert got == {"unique_aircraft": 3, "total_events": 4, "departures": 1, "landings": 1, "cruising": 1, "enrichment_pct": Decimal("50.0")}
    none = serve.daily_stats(events(spark), "2020-01-01").first().asDict()
    assert set(none.values()) == {0, Decimal("0")} or all(v == 0 for v in none.values())


def test_gone_keys(spark):
    now = spark.createDataFrame([("a",)], "icao24 string")
    assert sorted(r[0] for r in serve.gone_keys(events(spark), now).collect()) == ["b", "c", "d"]


CROSSING = "crossing_id long, flight_event_id long, icao24 string, callsign string, territory_type string, territory_id int, territory_name string, crossing_role string, flight_status string, entered_at timestamp, entered_date date, exited_at timestamp, duration_minutes decimal(8,2)"


def crossings(spark):
    row = lambda i, k, t, tid, role, m, status="COMPLETED": (
        i, i, k, None, t, tid, f"{t[0]}{tid}", role, status, NOON + timedelta(minutes=m), NOON.date(), None if status == "IN_PROGRESS" else NOON + timedelta(minutes=m + 5), Decimal("5.00") if status == "COMPLETED" else None)
    return spark.createDataFrame([
        row(1, "a", "COUNTRY", 1, "START", 0), row(2, "a", "STATE", 1, "ROUTE", 10), row(3, "a", "COUNTRY", 2, "END", 70), row(4, "b", "COUNTRY", 1, "START", 5, "IN_PROGRESS"),
        row(5, "b", "LANDMARK", 1, "ROUTE", 6)], CROSSING)


def territory(spark):
    c = spark.createDataFrame([(1, "One", 1.0, 2.0), (2, "Two", 3.0, 4.0)], "country_id int, country_name string, centroid_lat double, centroid_lon double")
    s = spark.createDataFrame([(1, "S", 5.0, 6.0)], "state_id int, state_name string, centroid_lat double, centroid_lon double")
    return serve.territories(c, s)


def test_crossings_per_flight(spark):
    located = serve.located_crossings(crossings(spark), territory(spark), "2026-04-22")
    assert {r["crossing_id"]: r["entered_lat"] for r in located.collect()} == {1: 1.0, 2: 5.0, 3: 3.0, 4: 1.0, 5: None}
    docs = serve.flight_documents(located)
    pages = {(r["icao24"], r["page"]): [c["crossing_id"] for c in r["crossings"]] for r in docs.collect()}
    assert pages == {("a", 12): [1, 2], ("a", 13): [3], ("b", 12): [4, 5]}
    assert serve.flat_crossings(docs).count() == 5
    assert '"entered_at":"2026-04-22T12:00:00.000000"' in serve.documents_json(docs).filter("icao24 = 'a' and page = 12").first()["document"]


def test_trails(spark):
    got = serve.trail_stats(crossings(spark)).first()
    assert (got["flights"], got["total_crossings"], got["countries"], got["states"]) == (2, 5, 2, 1)
    view = {r["crossing_id"]: (r["pin"], r["duration_shown"], r["is_current"]) for r in serve.trail_view(crossings(spark)).collect()}
    assert view == {1: ("DEP", "5m", False), 2: ("ST", "5m", False), 3: ("ARR", "5m", False), 4: ("DEP", "—", True), 5: ("CO", "5m", False)}
    live = serve.live_trail(crossings(spark), serve.latest_positions(events(spark), "2026-04-22").filter("icao24 = 'a'"))
    assert {(r["icao24"], r["is_live"]) for r in live.collect()} == {("a", True), ("b", False)}
    flown = spark.createDataFrame([(1, "LOS", "CAI"), (3, "LOS", "CAI"), (4, "X", "Y")], "event_id long, origin_iata string, destination_iata string")
    assert [r["territory_name"] for r in serve.route_trail(crossings(spark), flown, "LOS", "CAI").collect()] == ["C1", "C2"]


def test_territory_mart_ties(spark):
    stays = crossings(spark).withColumn("duration_minutes", F.lit("5.00").cast("decimal(8,2)"))
    aircraft = spark.createDataFrame([("a", "Zed", "Z", "NG"), ("b", "Ace", "A", "GH")], "icao24 string, airline_name string, airline_iata string, country_iso2 string")
    got = {(r["territory_type"], r["territory_id"]): r for r in marts.territory_mart(stays, aircraft, years=(2026,)).collect()}
    one = got[("COUNTRY", 1)]
    assert (one["total_crossings"], one["unique_aircraft"], one["unique_airlines"], one["top_airline"], one["top_aircraft_country"], one["rank_within_type"], one["crossings_2026"]) == (2, 2, 2, "Ace", "GH", 1, 2)
    assert got[("COUNTRY", 2)]["rank_within_type"] == 2 and got[("COUNTRY", 2)]["end_crossings"] == 1


def test_congestion_across_the_date_line_and_pole(spark):
    airports = spark.createDataFrame([("1", "DL", "X", 179.95, 0.0, True), ("2", "PO", "X", 0.0, 89.9, True), ("3", "DL", "X", 0.0, 0.0, False)],
                                     "ident string, airport_iata_code string, iso_country string, longitude_deg double, latitude_deg double, is_commercial boolean")
    pings = spark.createDataFrame([(1, "a", -179.95, 0.0), (1, "b", 179.9, 0.2), (1, "c", -179.0, 0.0), (1, "d", 180.0 - 1e-9, 89.9), (2, "a", 179.95, 0.0), (1, "a", 179.96, 0.0)],
                                  "poll int, icao24 string, longitude double, latitude double")
    departures = spark.createDataFrame([(1, "DL"), (1, "PO"), (2, "DL"), (3, "DL")], "poll int, origin_iata string")
    got = {(r["poll"], r["origin_iata"]): int(r["origin_congestion_score"]) for r in features.congestion(departures, pings, features.build_discs(airports)).collect()}
    assert got == {(1, "DL"): 2, (1, "PO"): 1, (2, "DL"): 1, (3, "DL"): 0}


def test_congestion_measures_no_airport_that_is_not_asked_for(spark, monkeypatch):
    """One spot holds 400 airports and one of them has a departure: the distance to that one alone is taken."""
    airports = spark.range(400).selectExpr("cast(id as string) AS ident", "concat('A', id) AS airport_iata_code", "'X' AS iso_country", "0D AS longitude_deg", "0D AS latitude_deg", "true AS is_commercial")
    pings = spark.range(20).selectExpr("1 AS poll", "cast(id % 10 as string) AS icao24", "id / 1000D AS longitude", "0D AS latitude").unionByName(
        spark.createDataFrame([(1, "far", 9.0, 0.0), (2, "a", 0.0, 0.0), (1, "none", None, 0.0)], "poll int, icao24 string, longitude double, latitude double"))
    departures = spark.createDataFrame([(1, "A7"), (3, "A8"), (1, None), (None, "A7"), (1, "?")], "poll int, origin_iata string")
    met, length = spark.sparkContext.accumulator(0), F.udf(lambda n: met.add(n) or True, "boolean")
    plain = F.filter
    monkeypatch.setattr(features.F, "filter", lambda c, f: F.when(length(F.size(c)), plain(c, f)) if c == "near" else plain(c, f))
    got = {(r["poll"], r["origin_iata"]): int(r["origin_congestion_score"]) for r in features.congestion(departures, pings, features.build_discs(airports)).collect()}
    assert got == {(1, "A7"): 10, (3, "A8"): 0, (1, None): 0, (None, "A7"): 0, (1, "?"): 0}
    assert 20 <= met.value <= 100


def test_delay_attach_keeps_one_row(spark):
    f = spark.createDataFrame([("AA", "X", "Y", date(2026, 1, 1)), ("BB", "X", "Y", date(2026, 1, 1))], "airline_iata string, origin_iata string, destination_iata string, flight_date date")
    d = spark.createDataFrame([("AA", "X", "Y", date(2026, 1, 1), Decimal("10.0")), ("AA", "X", "Y", date(2026, 1, 1), Decimal("20.5"))],
                              "airline_iata string, origin_iata string, destination_iata string, flight_date date, departure_delay_min decimal(6,1)")
    assert {r["airline_iata"]: r["departure_delay_min"] for r in features.with_us_delay(f, d).collect()} == {"AA": Decimal("15.3"), "BB": None}
