import dataclasses
import glob
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from flightlake import schema
from flightlake.operators import marts, quality, settle, silver
from flightlake.sources import tables

NOON = datetime(2026, 4, 22, 12, 0, 0)
RUN = "2026-04-22 23:59:00"


def event(i, icao24="tstidm01", kind="CRUISING", at=NOON, origin=None, destination=None):
    return {
        "event_id": i, "icao24": icao24, "callsign": "TEST01", "event_type": kind, "event_timestamp": at, "event_date": at.date(),
        "on_ground": False, "origin_iata": origin, "destination_iata": destination, "source": "test", "created_at": at,
    }


def crossing(i, parent, icao24="tstidm01", at=NOON, status="COMPLETED", tid=1):
    done = at + timedelta(minutes=30) if status == "COMPLETED" else None
    return {
        "crossing_id": i, "flight_event_id": parent, "icao24": icao24, "territory_type": "COUNTRY", "territory_id": tid, "territory_name": f"T{tid}",
        "crossing_role": "START", "flight_status": status, "entered_at": at, "entered_date": at.date(), "exited_at": done,
        "exited_date": done and done.date(), "duration_minutes": None, "created_at": at,
    }


def frame(spark, struct, dicts):
    return spark.createDataFrame([tuple(d.get(f.name) for f in struct) for d in dicts], struct)


@pytest.mark.parametrize("runs", [1, 2, 10])
def test_rollups_leave_one_row(spark, runs):
    daily = frame(spark, schema.DAILY_EVENT, [event(1)])
    hist = frame(spark, schema.HIST_EVENT, [])
    at = F.lit(RUN).cast("timestamp")
    for _ in range(runs):
        hist = spark.createDataFrame(hist.unionByName(settle.rollup_events(daily, hist, at)).collect(), schema.HIST_EVENT)
    assert hist.count() == 1 and hist.first()["batch_date"] == date(2026, 4, 22)


def test_rollup_is_an_anti_join(spark):
    daily, hist = frame(spark, schema.DAILY_EVENT, [event(1)]), frame(spark, schema.HIST_EVENT, [])
    plan = settle.rollup_events(daily, hist, F.lit(RUN).cast("timestamp"))._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan


def test_duplicates_inside_the_day(spark):
    daily, hist = frame(spark, schema.DAILY_EVENT, [event(1), event(2)]), frame(spark, schema.HIST_EVENT, [])
    at = F.lit(RUN).cast("timestamp")
    assert settle.rollup_events(daily, hist, at).count() == 2
    assert [r["event_id"] for r in settle.rollup_events(daily, hist, at, distinct_keys=True).collect()] == [1]


def test_crossings_are_rekeyed(spark):
    daily_events = frame(spark, schema.DAILY_EVENT, [event(1), event(2, at=NOON + timedelta(hours=1))])
    hist_events = frame(spark, schema.HIST_EVENT, [event(501), event(502, at=NOON + timedelta(hours=1))])
    daily = frame(spark, schema.DAILY_CROSSING, [crossing(1, 1), crossing(2, 2, at=NOON + timedelta(hours=1)), crossing(3, 99, tid=9)])
    hist = frame(spark, schema.HIST_CROSSING, [{**crossing(7, 501), "source": "opensky"}])
    got = settle.rollup_crossings(daily, daily_events, hist_events, hist, F.lit(RUN).cast("timestamp")).collect()
    assert [(r["crossing_id"], r["flight_event_id"], r["source"]) for r in got] == [(2, 502, "opensky")]
    assert [r["crossing_id"] for r in settle.orphan_crossings(daily, daily_events).collect()] == [3]


def test_warnings_and_checks(spark):
    daily, none = frame(spark, schema.DAILY_EVENT, [event(1)]), frame(spark, schema.DAILY_CROSSING, [])
    row = settle.with_warnings(settle.day_counts(daily, none, "2026-04-22")).first()
    assert row["event_count"] == 1 and row["crossing_count"] == 0
    assert row["warnings"] == ["Flight events (1) below minimum threshold (10).", "Territory crossings (0) below minimum threshold (5)."]
    hist = frame(spark, schema.HIST_EVENT, [event(501)])
    rolled = settle.rollup_events(daily, hist, F.lit(RUN).cast("timestamp"))
    # A rerun rolls nothing: the exact check fails, the coverage check sees that nothing is missing.
    assert settle.reconcile_counts("events", daily, rolled).first()["ok"] is False
    assert settle.reconcile_coverage("events", daily, hist, schema.EVENT_KEY).first()["ok"] is True


MODE = "spark.sql.sources.partitionOverwriteMode"


@pytest.fixture
def catalog(spark, request):
    """Empty tables, under the mode in which the session overwrites partitions: Spark's default, or what the test asks for."""
    spark.sql("CREATE DATABASE IF NOT EXISTS night")
    spark.sql("USE night")
    for field in dataclasses.fields(settle.Tables):
        spark.sql(f"DROP TABLE IF EXISTS {field.default}")
    for name in tables.SOURCES:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    tables.create_catalog_tables(spark)
    before = spark.conf.get(MODE)
    mode = getattr(request, "param", "static")
    spark.conf.set(MODE, mode)
    yield spark
    assert spark.conf.get(MODE) == mode
    spark.conf.set(MODE, before)
    spark.sql("USE default")


def append(spark, name, dicts):
    struct = tables.SOURCES[name].schema
    frame(spark, struct, dicts).write.mode("append").format("parquet").partitionBy(*filter(None, [tables.SOURCES[name].partition])).saveAsTable(name)


def test_settlement(catalog):
    spark = catalog
    flown = [event(1, kind="DEPARTED", origin="LOS", destination="CAI"), event(2, kind="DEPARTED", at=NOON + timedelta(hours=2), origin="LOS", destination="CAI")]
    append(spark, "daily_flight_events", flown)
    append(spark, "daily_territory_crossings", [crossing(1, 1), crossing(2, 2, at=NOON + timedelta(hours=2), status="IN_PROGRESS")])
    out = settle.settle(spark, RUN)
    assert out["error"] is None, out["error"]
    assert (out["events_rolled"], out["crossings_rolled"], out["in_flight"], out["orphans"]) == (2, 2, 1, 0)
    assert out["status"] == "COMPLETED WITH WARNINGS"
    assert spark.table("daily_flight_events").count() == 0 and spark.table("daily_territory_crossings").count() == 0
    assert spark.table("hist_flight_events").count() == 2
    assert spark.table("gold_route_frequency").first()["total_flights"] == 2
    # Late re-delivery of the same day: nothing is added twice.
    append(spark, "daily_flight_events", flown)
    again = settle.settle(spark, RUN, build_marts=False)
    assert again["error"] is None and again["events_rolled"] == 0 and spark.table("hist_flight_events").count() == 2


def test_failed_settlement_clears_nothing(catalog, monkeypatch):
    spark = catalog
    append(spark, "daily_flight_events", [event(1)])
    append(spark, "daily_territory_crossings", [crossing(1, 77)])  # its event is unknown, so it cannot reach history
    out = settle.settle(spark, RUN, build_marts=False)
    assert out["status"] == "FAILED" and "ReconciliationError" in out["error"]
    assert spark.table("daily_flight_events").count() == 1


def history(spark):
    return {r["crossing_id"]: r for r in spark.table("hist_territory_crossings").collect()}


@pytest.mark.parametrize("catalog", ["static", "dynamic"], indirect=True)
def test_stays_over_midnight(catalog):
    """Three nights: a stay is closed by its own row, one by a landing, and its event may be from the night before."""
    spark = catalog
    late, morning = NOON + timedelta(hours=11), NOON + timedelta(hours=20)
    append(spark, "daily_flight_events", [event(1, "a", at=late), event(2, "b", at=late)])
    append(spark, "daily_territory_crossings", [crossing(11, 1, "a", late, "IN_PROGRESS"), crossing(12, 2, "b", late, "IN_PROGRESS")])
    first = settle.settle(spark, RUN, build_marts=False)
    assert first["error"] is None and first["in_flight"] == 2
    # The day after: a's stay ends and it enters the next territory under yesterday's event; b lands without a row of its own.
    append(spark, "daily_flight_events", [event(3, "b", "LANDED", at=morning)])
    ended = {**crossing(13, 1, "a", late), "exited_at": morning, "exited_date": morning.date(), "flight_status": "COMPLETED"}
    append(spark, "daily_territory_crossings", [ended, crossing(14, 1, "a", morning, tid=2)])
    second = settle.settle(spark, "2026-04-23 23:59:00", build_marts=False)
    assert second["error"] is None and (second["closed"], second["crossings_rolled"], second["orphans"]) == (2, 1, 0)
    rows = history(spark)
    assert sorted(rows) == [11, 12, 14]
    assert (rows[11]["flight_status"], rows[11]["exited_at"]) == ("COMPLETED", morning)
    assert (rows[12]["flight_status"], rows[12]["exited_at"], float(rows[12]["duration_minutes"])) == ("COMPLETED", morning, 540.0)
    assert rows[14]["flight_event_id"] == 1
    assert spark.table("daily_territory_crossings").count() == 0
    third = settle.settle(spark, "2026-04-24 23:59:00", build_marts=False)
    assert third["error"] is None and history(spark) == rows


def test_rows_that_come_after_the_check_survive(catalog, monkeypatch):
    spark = catalog
    append(spark, "daily_flight_events", [event(1)])
    check = settle.reconcile_coverage

    def late(*args):
        append(spark, "daily_flight_events", [event(2, "late")])
        return check(*args)

    monkeypatch.setattr(settle, "reconcile_coverage", late)
    assert settle.settle(spark, RUN, build_marts=False)["error"] is None
    assert [r["icao24"] for r in spark.table("daily_flight_events").collect()] == ["late"]


def test_stays_open_for_longer_than_three_days(catalog):
    """Of two stays that history has open, one ends by a landing ten days later and one by the next entry; an entry that day hangs on an old event."""
    spark = catalog
    late, back = NOON + timedelta(hours=11), NOON + timedelta(days=10)
    append(spark, "daily_flight_events", [event(1, "a", at=late), event(2, "b", at=late), event(3, "c", at=late)])
    append(spark, "daily_territory_crossings", [crossing(11, 1, "a", late, "IN_PROGRESS"), crossing(12, 2, "b", late, "IN_PROGRESS")])
    assert settle.settle(spark, RUN, build_marts=False)["in_flight"] == 2
    append(spark, "daily_flight_events", [event(4, "b", "LANDED", at=back)])
    append(spark, "daily_territory_crossings", [crossing(13, 1, "a", back, tid=2), crossing(14, 3, "c", back, tid=2)])
    out = settle.settle(spark, "2026-05-02 23:59:00", build_marts=False)
    assert out["error"] is None, out["error"]
    assert (out["closed"], out["orphans"], out["crossings_rolled"]) == (2, 0, 2)
    got = history(spark)
    assert got[11]["exited_at"] == back and got[12]["exited_at"] == back and got[14]["flight_event_id"] == 3


def test_a_night_reads_only_the_dates_it_touches(catalog):
    """Files of all other history dates are made unreadable between two nights; a stay of ten days is closed all the same."""
    spark = catalog
    late, back = NOON + timedelta(hours=11), NOON + timedelta(days=10)
    append(spark, "daily_flight_events", [event(1, "a", at=late)])
    append(spark, "daily_territory_crossings", [crossing(11, 1, "a", late, "IN_PROGRESS")])
    assert settle.settle(spark, RUN, build_marts=False)["error"] is None
    quiet = NOON + timedelta(days=1)
    append(spark, "daily_flight_events", [event(2, "q", at=quiet)])
    append(spark, "daily_territory_crossings", [crossing(12, 2, "q", quiet)])
    assert settle.settle(spark, "2026-04-23 23:59:00", build_marts=False)["error"] is None
    for table, part in (("hist_flight_events", "event_date"), ("hist_territory_crossings", "entered_date")):
        folder = settle.versions.location(spark, table, part, quiet.date()).removeprefix("file:")
        for file in glob.glob(f"{folder}/*.parquet"):
            with open(file, "wb") as f:
                f.write(b"unreadable")
        for crc in glob.glob(f"{folder}/.*.crc"):
            open(crc, "wb").close()
    append(spark, "daily_flight_events", [event(3, "a", "LANDED", at=back)])
    append(spark, "daily_territory_crossings", [crossing(13, 1, "a", back, tid=2)])
    out = settle.settle(spark, "2026-05-02 23:59:00", build_marts=False)
    assert out["error"] is None, out["error"]
    assert (out["closed"], out["orphans"], out["crossings_rolled"]) == (1, 0, 1)
    rows = spark.table("hist_territory_crossings").filter(F.col("entered_date").isin(late.date(), back.date()))
    assert {r["crossing_id"]: r["exited_at"] for r in rows.collect()}[11] == back
    assert spark.table("state_open_stays").count() == 0


def test_killed_between_write_and_swap(catalog, monkeypatch):
    """A job that ends before the new folders count leaves history as it was; the next run does it all."""
    spark = catalog
    late, morning = NOON + timedelta(hours=11), NOON + timedelta(hours=20)
    append(spark, "daily_flight_events", [event(1, "a", at=late)])
    append(spark, "daily_territory_crossings", [crossing(11, 1, "a", late, "IN_PROGRESS"), crossing(12, 1, "a", NOON, tid=5)])
    assert settle.settle(spark, RUN, build_marts=False)["error"] is None
    before = history(spark)
    append(spark, "daily_flight_events", [event(2, "a", "LANDED", at=morning)])
    append(spark, "daily_territory_crossings", [crossing(13, 1, "a", morning, tid=2)])

    def killed(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(settle.versions, "swap", killed)
        with pytest.raises(KeyboardInterrupt):
            settle.settle(spark, "2026-04-23 23:59:00", build_marts=False)
    spark.catalog.refreshTable("hist_territory_crossings")
    assert history(spark) == before and spark.table("daily_territory_crossings").count() == 1
    out = settle.settle(spark, "2026-04-23 23:59:00", build_marts=False)
    assert out["error"] is None and out["closed"] == 1
    after = history(spark)
    assert after[12] == before[12] and after[11]["exited_at"] == morning and sorted(after) == [11, 12, 13]
    # What the lost job wrote is not part of the table; only a vacuum looks for it.
    assert settle.versions.vacuum(spark, "hist_territory_crossings", "entered_date") >= 1
    assert history(spark) == after


@pytest.mark.parametrize("catalog", ["static", "dynamic"], indirect=True)
def test_folded_days_keep_other_dates(catalog):
    spark = catalog
    rows = [event(i, f"p{i}", "DEPARTED", NOON + timedelta(days=i), "LOS", "CAI") for i in range(5)]
    append(spark, "hist_flight_events", rows)
    fold = lambda h: h.groupBy("event_date").agg(F.count("*").alias("n"))
    marts.refresh_days(spark, "gold_route_days", fold, spark.table("hist_flight_events"), "event_date", [])
    append(spark, "hist_flight_events", [event(9, "p9", "DEPARTED", NOON, "LOS", "CAI"), event(10, "p9", "DEPARTED", NOON + timedelta(days=7), "LOS", "CAI")])
    touched = [NOON.date(), (NOON + timedelta(days=7)).date(), (NOON + timedelta(days=9)).date()]
    for _ in range(2):
        got = marts.refresh_days(spark, "gold_route_days", fold, spark.table("hist_flight_events"), "event_date", touched)
        assert sorted((r["event_date"].day, r["n"]) for r in got.collect()) == [(22, 2), (23, 1), (24, 1), (25, 1), (26, 1), (29, 1)]


def test_replaced_versions_go_with_the_next_replacement(catalog):
    spark = catalog
    append(spark, "hist_flight_events", [event(1), event(2, at=NOON + timedelta(days=1))])
    old = settle.versions.location(spark, "hist_flight_events", "event_date", NOON.date()).removeprefix("file:")
    for n in range(3):
        row = frame(spark, schema.HIST_EVENT, [event(100 + n)])
        settle.versions.replace(spark, "hist_flight_events", row, "event_date", [NOON.date()])
        assert sorted(r["event_id"] for r in spark.table("hist_flight_events").collect()) == [2, 100 + n]
        now = settle.versions.location(spark, "hist_flight_events", "event_date", NOON.date()).removeprefix("file:")
        assert bool(glob.glob(f"{old}/*.parquet")) == (n == 0)
        if n:
            assert glob.glob(f"{last}/*.parquet")  # noqa: F821 - of the turn before: readers may still be at work
        last = now
    append(spark, "hist_flight_events", [event(3)])
    assert sorted(r["event_id"] for r in spark.table("hist_flight_events").collect()) == [2, 3, 102]


def test_settlement_leaves_no_staging(catalog):
    spark = catalog
    base = spark.conf.get("spark.checkpoint.dir")
    before = set(glob.glob(f"{base}/stage-*"))
    append(spark, "daily_flight_events", [event(1)])
    settle.settle(spark, RUN)
    assert set(glob.glob(f"{base}/stage-*")) == before


def test_enrichment_branches(spark):
    day = frame(spark, schema.DAILY_EVENT, [
        event(1, "both", "DEPARTED", origin="OLD"), event(2, "both", "CLIMBING", origin="OLD", destination="OLD"),
        event(3, "orig", "DEPARTED"), event(4, "dest", "LANDED", origin="KEEP"), event(5, "none", "LANDED"), event(6, "lost", "LANDED"),
        event(7, "both", "DEPARTED", at=NOON - timedelta(days=1)), event(8, "full", "LANDED", origin="A", destination="B"),
    ])
    records = spark.createDataFrame([
        ("both", "KA", "KX", 1), ("both", "KA", "KB", 2), ("orig", "KA", None, 1), ("dest", None, "KB", 1), ("none", "KZ", None, 1), ("full", "KA", "KB", 1),
    ], "icao24 string, estDepartureAirport string, estArrivalAirport string, lastSeen long")
    airports = spark.createDataFrame([("1", "KA", "AAA"), ("2", "KB", "BBB")], "ident string, airport_icao_code string, airport_iata_code string")
    work = silver.worklist(day, "2026-04-22")
    assert sorted(r[0] for r in work.collect()) == ["both", "dest", "lost", "none", "orig"]
    routes = silver.resolved_routes(work, records, airports)
    got = {r["event_id"]: (r["origin_iata"], r["destination_iata"], r["changed"]) for r in silver.enrich(day, routes, "2026-04-22").collect()}
    assert got == {
        1: ("AAA", "BBB", True), 2: ("OLD", "OLD", False), 3: ("AAA", None, True), 4: ("KEEP", "BBB", True),
        5: (None, None, False), 6: (None, None, False), 7: (None, None, False), 8: ("A", "B", False),
    }
    gentle = {r["event_id"]: (r["origin_iata"], r["destination_iata"]) for r in silver.enrich(day, routes, "2026-04-22", fill_only=True).collect()}
    assert gentle[1] == ("OLD", "BBB")
    s = silver.enrich_summary(routes, silver.enrich(day, routes, "2026-04-22")).first()
    assert (s["processed"], s["enriched"], s["no_data"], s["rows_updated"]) == (5, 4, 1, 3)


@pytest.mark.parametrize("catalog", ["static", "dynamic"], indirect=True)
def test_rewrite_day(catalog):
    spark = catalog
    append(spark, "daily_flight_events", [event(1, "both", "DEPARTED"), event(2, "old", "DEPARTED", at=NOON - timedelta(days=1))])
    routes = spark.createDataFrame([("both", "AAA", "BBB", True)], "icao24 string, new_origin string, new_destination string, found boolean")
    silver.rewrite_day(silver.enrich(spark.table("daily_flight_events"), routes, "2026-04-22"), "daily_flight_events", "2026-04-22")
    got = {r["event_id"]: r["origin_iata"] for r in spark.table("daily_flight_events").collect()}
    assert got == {1: "AAA", 2: None}


def test_rules(spark):
    df = frame(spark, schema.DAILY_CROSSING, [crossing(1, 1), {**crossing(2, 1), "crossing_role": "MIDDLE"}])
    good, bad = quality.split(df, quality.crossing_rules())
    assert [r["crossing_id"] for r in good.collect()] == [1]
    assert [r["reasons"] for r in bad.collect()] == [["crossing_role is not an allowed value"]]
    scored = spark.createDataFrame([(0.5, "ON_TIME", 5, 7), (1.5, "LATE", 24, 0), (None, None, None, None)],
                                   "delay_probability double, predicted_delay_class string, departure_hour int, departure_day_of_week int")
    _, bad = quality.split(scored, quality.prediction_rules())
    assert [len(r["reasons"]) for r in bad.collect()] == [4]
    limits = quality.first_offenders(spark.createDataFrame([("LOSX", 2), ("CAIRO", 1)], "airport_iata_code string, i int"), quality.at_most({"airport_iata_code": 3}), "i")
    assert limits.first().asDict() == {"rule": "airport_iata_code is longer than 3", "rows": 2, "first_key": 1}


def test_route_mart_counts_without_pairing(spark):
    """A busy aircraft-day: counts and durations equal the plain join, which has quadratically many rows."""
    n = 60
    rows = [event(i, "hot", "DEPARTED" if i % 2 else "LANDED", NOON + timedelta(minutes=i), "LOS", "CAI") for i in range(n)]
    rows += [event(n + i, "cold", "DEPARTED", NOON + timedelta(minutes=i), "LOS", "CAI") for i in range(3)]
    df = frame(spark, schema.HIST_EVENT, rows)
    aircraft = spark.createDataFrame([("hot", "Air A", "AA"), ("cold", None, None)], "icao24 string, airline_name string, airline_iata string")
    airports = spark.createDataFrame([("LOS", "NG"), ("CAI", "EG"), ("CAI", "EG")], "airport_iata_code string, iso_country string")
    got = marts.route_mart(df, aircraft, airports, landed_source="test").first()
    d, l = df.filter("event_type = 'DEPARTED'").alias("d"), df.filter("event_type = 'LANDED'").alias("l")
    joined = d.join(l, (F.col("d.icao24") == F.col("l.icao24")) & (F.col("d.event_date") == F.col("l.event_date")), "left").join(airports.filter("airport_iata_code = 'CAI'"))
    minutes = (F.unix_timestamp("l.event_timestamp") - F.unix_timestamp("d.event_timestamp")) / 60
    want = joined.agg(F.count("*").alias("n"), F.round(F.avg(minutes), 1).alias("a"), F.min(minutes).alias("lo"), F.max(minutes).alias("hi")).first()
    assert got["total_flights"] == want["n"] == 2 * (30 * 30 + 3)
    assert (float(got["avg_duration_min"]), float(got["min_duration_min"]), float(got["max_duration_min"])) == (want["a"], want["lo"], want["hi"])
    assert got["primary_airline"] == "Air A" and got["route_label"] == "LOS → CAI" and got["is_international"] and got["route_rank"] == 1
