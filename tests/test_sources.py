import glob
import gzip
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from flightlake import schema
from flightlake.functions.geometry import COVERAGE
from flightlake.operators import events
from flightlake.sources import files, messages, positions, tables
from flightlake.streaming import jobs


def slots(icao24="abc", call=" FL1 ", lon=3.39, lat=6.45, alt=1000.0, ground=False, vel=250.0, rate=5.08):
    return [icao24, call, "X", 1, 1, lon, lat, alt, ground, vel, 90.0, rate, None, None, None, False, 0]


def test_position_documents(spark):
    states = [slots(), slots("b", "  ", alt=None, vel=None, rate=None, ground=True), slots("short")[:6], slots("far", lon=120.0), slots("nowhere", lon=None, lat=None)]
    docs = spark.createDataFrame([(json.dumps({"time": 1700000000, "states": states}),), (json.dumps({"time": 1, "states": None}),), ("broken",)], "value string")
    got = {r["icao24"]: r for r in positions.parse_positions(docs, box=COVERAGE).collect()}
    assert set(got) == {"abc", "b"}
    a = got["abc"]
    assert (a["callsign"], a["altitude_ft"], a["velocity_kmh"], a["vertical_rate_fpm"], a["heading_deg"]) == ("FL1", 3280.8, 900.0, 1000.0, 90.0)
    assert a["timestamp"] == datetime(2023, 11, 14, 22, 13, 20)
    assert got["b"]["callsign"] is None and got["b"]["altitude_ft"] is None and got["b"]["on_ground"] is True
    assert positions.parse_positions(docs).count() == 4
    wild = spark.createDataFrame([(json.dumps({"time": 1, "states": [slots(alt=1e13, vel=1e30)]}),)], "value string")
    assert positions.parse_positions(wild).first()["altitude_ft"] is None
    assert [(f.name, f.dataType) for f in positions.parse_positions(docs).schema] == [(f.name, f.dataType) for f in schema.PING]


def test_messages(spark):
    df = spark.createDataFrame([("abc", None, "LANDED", datetime(2026, 4, 22, 12, 0, 0, 5), 6.45, 3.39, 0.0, None, 90.0, 0.0, True, "opensky")], ", ".join(
        f"{f.name} {'timestamp' if f.name == 'event_timestamp' else f.dataType.simpleString()}" for f in schema.MESSAGE))
    sent = messages.to_messages(df)
    body = json.loads(sent.first()["value"])
    assert sent.first()["key"] == "abc" and body["callsign"] is None and body["event_timestamp"] == "2026-04-22T12:00:00.000005"
    assert list(body) == [f.name for f in schema.MESSAGE]
    assert messages.from_messages(sent).first() == df.first()
    blank = spark.createDataFrame([('{"icao24": ""}',), ("{}",), ("junk",)], "value string")
    assert messages.from_messages(blank).count() == 0


HEAD = ",".join(schema.FLIGHT_LIST_COLUMNS)


def write_list(path, lines):
    with gzip.open(path, "wt") as f:
        f.write("\n".join([HEAD, *lines]))


def line(icao24="ab", first="1577836800", last="1577840400"):
    return f"FL1,,{icao24},,,KA,KB,{first},{last},,1.5,2.5,100,3.5,4.5,0"


def no_airports(spark):
    return spark.createDataFrame([], "ident string, airport_icao_code string, airport_iata_code string")


def test_flight_list_files(spark, tmp_path):
    write_list(tmp_path / "a.csv.gz", [line(), line(last="nan"), line(icao24=" "), "short,row"])
    df = files.flight_lists(spark, str(tmp_path / "*.csv.gz"))
    assert df.count() == 2 and {r["file"] for r in df.collect()} == {"a.csv.gz"}
    summary = files.load_summary(events.typed_flights(df)).first()
    assert (summary["total_rows"], summary["events_inserted"], summary["rows_skipped"]) == (2, 2, 1)


def test_load_restarts_where_it_stopped(spark, tmp_path):
    source, base = tmp_path / "in", str(tmp_path / "job")
    source.mkdir()
    write_list(source / "a.csv.gz", [line(), line(last="nan")])
    load = lambda: jobs.load_flight_lists(spark, str(source), base, f"{base}/checkpoint", no_airports(spark), "2026-01-01 00:00:00")
    stored = lambda: tables.TableRegistry(spark, base).read("hist_flight_events").count()
    assert load().agg(F.sum("events_inserted"), F.sum("rows_skipped")).first()[:] == (2, 1)
    load()
    assert stored() == 2
    write_list(source / "b.csv.gz", [line("cd"), line("ef")])
    assert load().count() == 2 and stored() == 6


def test_columns_are_bound_by_name(spark, tmp_path):
    with gzip.open(tmp_path / "a.csv.gz", "wt") as f:
        f.write(' LastSeen,"icao24",extra,' + ",".join(c for c in schema.FLIGHT_LIST_COLUMNS if c not in ("lastseen", "icao24")) + "\n")
        f.write('2,ab,"x, y",FL1\n')
    write_list(tmp_path / "b.csv.gz", [line("cd")])
    got = {r["icao24"]: (r["callsign"], r["lastseen"]) for r in files.flight_lists(spark, str(tmp_path / "*.csv.gz")).collect()}
    assert got == {"ab": ("FL1", "2"), "cd": ("FL1", "1577840400")}
    with gzip.open(tmp_path / "c.csv.gz", "wt") as f:
        f.write("callsign,number,icao24\nFL2,1,ab\n")
    with pytest.raises(ValueError, match="c.csv.gz: the header lacks .*lastseen"):
        files.flight_lists(spark, str(tmp_path / "*.csv.gz"))


def test_numbers_out_of_range_are_unknown(spark, tmp_path):
    source, base = tmp_path / "in", str(tmp_path / "job")
    source.mkdir()
    write_list(source / "a.csv.gz", ["FL1,,ab,,,KA,KB,1577836800,1577840400,,1e30,2.5,1e30,3.5,4.5,1e13", "FL1,,ab,,,KA,KB,1577836800,1577840400,,1,2.5,1,3.5,4.5,1"])
    jobs.load_flight_lists(spark, str(source), base, f"{base}/checkpoint", no_airports(spark), "2026-01-01 00:00:00")
    rows = tables.TableRegistry(spark, base).read("hist_flight_events").collect()
    assert len(rows) == 2


def test_staging_of_a_load_is_gone(spark, tmp_path):
    source, base = tmp_path / "in", str(tmp_path / "job")
    source.mkdir()
    work = spark.conf.get("spark.checkpoint.dir")
    before = set(glob.glob(f"{work}/stage-*"))
    for n in "abc":
        write_list(source / f"{n}.csv.gz", [line(n)])
        jobs.load_flight_lists(spark, str(source), base, f"{base}/checkpoint", no_airports(spark), "2026-01-01 00:00:00")
    assert set(glob.glob(f"{work}/stage-*")) == before


def test_ledger(spark, tmp_path):
    source, ledger = tmp_path / "in", str(tmp_path / "ledger")
    source.mkdir()
    for n in ("a", "b", "c"):
        write_list(source / f"{n}.csv.gz", [line()])
    names = lambda: [p.rsplit("/", 1)[-1] for p in tables.pending_files(spark, str(source / "*.csv.gz"), ledger)]
    assert names() == ["a.csv.gz", "b.csv.gz", "c.csv.gz"]
    tables.mark_loaded(spark, ledger, ["a.csv.gz"])
    tables.mark_loaded(spark, ledger, ["/x/c.csv.gz"])
    assert names() == ["b.csv.gz"]


def test_registry(spark, tmp_path):
    reg = tables.TableRegistry(spark, str(tmp_path))
    at = datetime(2026, 4, 22, 12)
    row = lambda i, k: tuple({"event_id": i, "icao24": k, "event_type": "LANDED", "event_timestamp": at, "event_date": at.date()}.get(f.name) for f in schema.DAILY_EVENT)
    make = lambda *r: spark.createDataFrame(list(r), schema.DAILY_EVENT)
    assert reg.append_new("daily_flight_events", make(row(1, "a"), row(2, "a"), row(3, "b")), schema.EVENT_KEY).count() == 2
    assert [r["icao24"] for r in reg.append_new("daily_flight_events", make(row(4, "b"), row(5, "c")), schema.EVENT_KEY).collect()] == ["c"]
    assert reg.register() == ["daily_flight_events"]
    assert spark.sql("SELECT count(*) FROM daily_flight_events WHERE event_date = DATE '2026-04-22'").first()[0] == 3
    assert len(tables.SOURCES) == 8


def test_registry_reads_candidate_partitions_only(spark, tmp_path):
    """The files of a date whose filter has none of the keys are not opened, even if the batch has rows of that date."""
    reg = tables.TableRegistry(spark, str(tmp_path))
    at = lambda d: datetime(2026, 4, d, 12)
    row = lambda i, k, d: tuple({"event_id": i, "icao24": k, "event_type": "LANDED", "event_timestamp": at(d), "event_date": at(d).date()}.get(f.name) for f in schema.DAILY_EVENT)
    make = lambda *r: spark.createDataFrame(list(r), schema.DAILY_EVENT)
    reg.append_new("daily_flight_events", make(row(1, "a", 20), row(2, "b", 21)), schema.EVENT_KEY)
    for file in glob.glob(str(tmp_path / "daily_flight_events/event_date=2026-04-20/*")):
        open(file, "w").write("unreadable")
    got = reg.append_new("daily_flight_events", make(row(3, "new", 20), row(4, "b", 21), row(5, "c", 21)), schema.EVENT_KEY)
    assert sorted(r["icao24"] for r in got.collect()) == ["c", "new"]
    with pytest.raises(Exception):
        reg.append_new("daily_flight_events", make(row(6, "a", 20)), schema.EVENT_KEY).collect()


def test_registry_probes_no_date_it_reads_anyway(spark, tmp_path, monkeypatch):
    """A date that the batch has many keys of is read; only keys of other dates are looked for in filters. Every known key is found."""
    probed, plain = [], tables.bloom.candidates
    monkeypatch.setattr(tables, "PROBED", 3)
    monkeypatch.setattr(tables.bloom, "candidates", lambda keys, *a: probed.extend(r["icao24"] for r in keys.collect()) or plain(keys, *a))
    reg = tables.TableRegistry(spark, str(tmp_path))
    at = lambda d: datetime(2026, 4, d, 12)
    row = lambda i, k, d: tuple({"event_id": i, "icao24": k, "event_type": "LANDED", "event_timestamp": at(d), "event_date": at(d).date()}.get(f.name) for f in schema.DAILY_EVENT)
    # Of one key many times, each with another time, so that a date's filter is for 2,048 keys and the batch has one for 16 of them.
    many = spark.range(200).selectExpr("id AS event_id", "concat('m', id) AS icao24", "'LANDED' AS event_type", "timestamp'2026-04-20 12:00:00' AS event_timestamp", "date'2026-04-20' AS event_date")
    shaped = lambda df: df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.DAILY_EVENT])
    one = lambda k, d: spark.createDataFrame([row(900, k, d)], schema.DAILY_EVENT)
    reg.append_new("daily_flight_events", shaped(many).unionByName(one("b", 21)), schema.EVENT_KEY)
    got = reg.append_new("daily_flight_events", shaped(many.filter("id < 150")).unionByName(one("n", 20)).unionByName(one("b", 21)).unionByName(one("c", 21)).unionByName(one("d", 22)), schema.EVENT_KEY)
    assert sorted(r["icao24"] for r in got.collect()) == ["c", "d", "n"]
    assert sorted(set(probed)) == ["b", "c"]


def test_flight_list_lines_are_parsed_once(spark, tmp_path):
    """The filter on the aircraft id does not parse the line a second time; a header with blanks and quotes is found among data that names a callsign."""
    names = [c.upper() if c == "number" else c for c in schema.FLIGHT_LIST_COLUMNS]
    cells = lambda **v: ",".join(v.get(c, "") for c in schema.FLIGHT_LIST_COLUMNS)
    head = ",".join(f' "{c}"' if c == "callsign" else c for c in names)
    (tmp_path / "a.csv").write_text("\n".join([head.replace("icao24", "ica o24"), cells(callsign="Callsign", icao24="abc"), cells(icao24=" "), cells(callsign="X", icao24="def")]))
    df = files.flight_lists(spark, str(tmp_path / "a.csv"))
    assert sorted((r["icao24"], r["callsign"]) for r in df.collect()) == [("abc", "Callsign"), ("def", "X")]
    assert df._jdf.queryExecution().optimizedPlan().toString().count("from_csv") == 1


def test_registry_of_a_table_without_filters(spark, tmp_path):
    """Keys of rows that were written some other way are known too."""
    at = datetime(2026, 4, 22, 12)
    row = lambda i, k: tuple({"event_id": i, "icao24": k, "event_type": "LANDED", "event_timestamp": at, "event_date": at.date()}.get(f.name) for f in schema.DAILY_EVENT)
    make = lambda *r: spark.createDataFrame(list(r), schema.DAILY_EVENT)
    make(row(1, "a"), row(2, "b")).write.partitionBy("event_date").parquet(str(tmp_path / "daily_flight_events"))
    reg = tables.TableRegistry(spark, str(tmp_path))
    assert [r["icao24"] for r in reg.append_new("daily_flight_events", make(row(3, "a"), row(4, "z")), schema.EVENT_KEY).collect()] == ["z"]
    assert reg.append_new("daily_flight_events", make(row(5, "b"), row(6, "z")), schema.EVENT_KEY).count() == 0


def test_checked_load(spark, tmp_path):
    from flightlake.operators import quality

    path = str(tmp_path / "checked")
    rules = {**quality.required("a"), **quality.within("n", 0, 9)}
    rows = lambda *r: spark.createDataFrame(list(r), "a string, n int")
    quality.load_checked(rows(("x", 1), (None, 50)), rules, path, "one")
    entry = quality.load_checked(rows(("y", 2), (None, 3), ("z", -1)), rules, path, "two").first()
    assert (entry["total"], entry["rejects"], entry["broken"]) == (3, 2, {"a is missing": 1, "n is out of range": 1})
    quality.load_checked(rows(("x", 1), (None, 50)), rules, path, "one")  # the same load again
    assert sorted((r["a"], r["load"]) for r in quality.loaded(spark, path, "a string, n int", False).collect()) == [("x", "one"), ("y", "two")]
    assert sorted((r["n"], tuple(r["reasons"])) for r in quality.loaded(spark, path, "a string, n int", True).collect()) == [
        (-1, ("n is out of range",)), (3, ("a is missing",)), (50, ("a is missing", "n is out of range"))]
    assert {r["load"]: (r["total"], r["rejects"]) for r in quality.ledger(spark, path).collect()} == {"one": (2, 1), "two": (3, 2)}
    none = quality.load_checked(rows(("x", 1)).filter("false"), rules, path, "none").first()
    assert (none["total"], none["rejects"], none["broken"]) == (0, 0, {})
