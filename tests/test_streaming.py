import glob
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from flightlake import schema
from flightlake.operators import crossings, events, geo
from flightlake.plans import sequence
from flightlake.queries import settle_queries, standins
from flightlake.sources import messages
from flightlake.streaming import jobs, microbatch

from test_events import PING, T0, FLIGHT, pings


@pytest.fixture(scope="module")
def index(spark):
    box = lambda x0, x1: f"POLYGON (({x0} 0, {x1} 0, {x1} 10, {x0} 10, {x0} 0))"
    shapes = [("COUNTRY", 1, "A", box(0, 10)), ("COUNTRY", 2, "B", box(20, 30)), ("STATE", 51, "A1", box(5, 10))]
    return geo.stored(geo.build_cells(geo.boundary_edges(spark.createDataFrame(shapes, "level string, territory_id int, territory_name string, wkt string")), 5.0))


def busy():
    return {f"p{i}": [(j * 7 + i, (i * j) % 5 == 0, float((i * 31 + j * 17) % 900 - 450), 12000.0, float((i * 13 + j * 7) % 34), 5.0) for j in range(30)] for i in range(5)}


def test_micro_batches_equal_one_batch(spark, tmp_path, rows, index):
    df = spark.createDataFrame(pings(spark, {**busy(), "x": FLIGHT}).collect(), PING)
    source = str(tmp_path / "in")
    job = microbatch.Tracking(str(tmp_path / "out"), index)
    low = datetime(2000, 1, 1)
    for high in [T0 + timedelta(minutes=62), T0 + timedelta(minutes=152), T0 + timedelta(minutes=160), datetime(2100, 1, 1)]:
        part = df.filter((F.col("timestamp") >= F.lit(low)) & (F.col("timestamp") < F.lit(high)))
        # Each part is delivered with a copy of the part before it, which is late by then.
        old = df.filter(F.col("timestamp") < F.lit(low))
        part.unionByName(old).repartition(3).write.mode("append").parquet(source)
        q = jobs.start(spark.readStream.schema(df.schema).parquet(source), str(tmp_path / "check"), each=job.each, replay=True)
        q.awaitTermination()
        low = high
    cols = ["icao24", "event_type", "timestamp", "altitude_ft", "vertical_rate_fpm", "callsign"]
    assert rows(job.events(spark).select(*cols)) == rows(events.detect_events(df).select(*cols))
    batch = crossings.territory_sessions(df, index)
    assert rows(job.crossings(spark).select(*batch.columns)) == rows(batch)
    # What came late is kept apart, with its count: nothing is lost unseen.
    cuts = [T0 + timedelta(minutes=m) for m in (62, 152, 160)]
    assert job.late(spark).count() == sum(df.filter(F.col("timestamp") < F.lit(c)).count() for c in cuts)
    work = spark.conf.get("spark.checkpoint.dir")
    staged = set(glob.glob(f"{work}/stage-*"))
    job.each(df.limit(0), 4)
    assert set(glob.glob(f"{work}/stage-*")) == staged


def test_micro_batch_of_unknown_aircraft(spark, tmp_path, index):
    df = pings(spark, {"x": FLIGHT, "y": FLIGHT})
    job = microbatch.Tracking(str(tmp_path / "out"), index, aircraft=spark.createDataFrame([("x",)], "icao24 string"))
    job.each(df, 0)
    job.each(df.filter("false"), 1)
    assert {r["icao24"] for r in job.crossings(spark).collect()} == {"x"}
    # A retried micro-batch replaces its results.
    before = job.crossings(spark).count()
    job.each(df.filter("false"), 1)
    job.each(df, 0)
    assert job.crossings(spark).count() == before


def message_rows(spark, data):
    ddl = "icao24 string, event_type string, event_timestamp timestamp, latitude double, longitude double, altitude_ft double, on_ground boolean, callsign string"
    return spark.createDataFrame([(k, e, T0 + timedelta(minutes=m), 1.0, 2.0, float(m), g, None) for k, e, m, g in data], ddl)


def test_position_cache(spark, tmp_path):
    source = str(tmp_path / "in")
    feed = [[("a", "CLIMBING", 1, False), ("b", "CLIMBING", 1, False), ("", "CLIMBING", 1, False)], [("a", "CRUISING", 5, False), ("b", "LANDED", 6, True)], [("c", "DEPARTED", 7, False)]]
    for part in feed:
        df = message_rows(spark, part)
        df.coalesce(1).write.mode("append").parquet(source)
        q = jobs.start(jobs.latest_states(spark.readStream.schema(df.schema).parquet(source)), str(tmp_path / "check"), each=jobs.position_snapshot(str(tmp_path / "cache")), mode="update", replay=True)
        q.awaitTermination()
    got = {r["icao24"]: (r["event_type"], r["altitude_ft"], r["callsign"]) for r in jobs.read_cache(spark, str(tmp_path / "cache")).collect()}
    assert got == {"a": ("CRUISING", 5.0, "a"), "c": ("DEPARTED", 7.0, "c")}


def test_redelivery(spark, tmp_path):
    df = message_rows(spark, [("a", "LANDED", 1, True), ("a", "LANDED", 1, True), ("a", "DEPARTED", 1, False)])
    df.write.parquet(str(tmp_path / "in"))
    stream = jobs.without_repeats(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")))
    jobs.start(stream, str(tmp_path / "check"), path=str(tmp_path / "out"), replay=True).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_topic_failure_does_not_fail_the_table(spark, tmp_path):
    df = message_rows(spark, [("a", "LANDED", 1, True), ("b", "DEPARTED", 2, False)])
    df.write.parquet(str(tmp_path / "in"))
    table, topic = str(tmp_path / "table"), str(tmp_path / "topic")

    def to_table(batch, number):
        accepted = batch.filter("icao24 = 'a'")
        accepted.write.mode("overwrite").parquet(f"{table}/batch={number}")
        return accepted

    def to_topic(batch):
        wide = batch.withColumns({c: F.lit(None).cast("double") for c in ("velocity_kmh", "heading_deg", "vertical_rate_fpm")}).withColumn("source", F.lit("s"))
        messages.to_messages(wide).write.mode("append").parquet(topic)

    def broken(batch):
        raise RuntimeError("no broker")

    stream = lambda: spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    for n, (sink, only) in enumerate([(broken, False), (to_topic, False), (to_topic, True)]):
        q = jobs.start(stream(), str(tmp_path / f"check{n}"), each=jobs.dual_write(to_table, sink, only), replay=True)
        q.awaitTermination()
        assert q.exception() is None
    assert spark.read.parquet(table).count() == 1
    # Rejected events reach the topic unless only accepted ones are asked for.
    assert sorted(r["key"] for r in spark.read.parquet(topic).collect()) == ["a", "a", "b"]


def test_outbox_sends_what_failed(spark, tmp_path):
    """Two failing sends, a retried batch, and a start with nothing new: the topic ends with every batch once, in order."""
    from flightlake.streaming import outbox

    base, order, broken = str(tmp_path), [], [True, True]

    def send(rows, number):
        if number == 1 and broken:
            broken.pop()
            raise RuntimeError("no broker")
        order.append(number)
        rows.write.mode("overwrite").parquet(f"{base}/topic/batch={number}")

    def table(batch, number):
        batch.write.mode("overwrite").parquet(f"{base}/table/batch={number}")
        return batch.filter("icao24 <> 'b'")

    box = outbox.Outbox(f"{base}/box", send)
    each = outbox.outbox_write(table, box, accepted_only=True)
    parts = [message_rows(spark, [(k, "LANDED", i, True), ("b", "LANDED", i, True)]) for i, k in enumerate("acd")]
    each(parts[0], 0)
    each(parts[1], 1)
    assert box.waiting(spark) == [1] and order == [0]
    each(parts[2], 2)
    assert box.waiting(spark) == [1, 2] and order == [0]
    each(parts[2], 2)  # the stream retries its newest batch
    assert box.waiting(spark) == [] and order == [0, 1, 2]
    each(parts[2], 2)
    each(parts[0].filter("false"), 3)
    assert order == [0, 1, 2] and box.flush(spark) == 0
    assert sorted(r["icao24"] for r in spark.read.parquet(f"{base}/topic/*").collect()) == ["a", "c", "d"]
    assert spark.read.parquet(f"{base}/table/*").count() == 6


def test_output_names():
    assert set(schema.FLIGHT_STATUSES) == {"IN_PROGRESS", "COMPLETED"}


def _counted(spark, monkeypatch, folder):
    """A folder with 200 events of January 2024, four of them without a time, and a count of the rows the queries read from it."""
    rows = spark.range(200).selectExpr(
        "id AS event_id", "if(id % 50 = 7, NULL, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(id * 4 as int), 0, 0)) AS ts", "id % 9 AS user_id",
        "element_at(array('signup', 'click', 'view', 'error', 'purchase'), cast(id % 5 as int) + 1) AS event_type", "cast(id % 60 as double) AS value", "'{}' AS props")
    rows.write.parquet(f"{folder}/events.parquet")
    read, plain = spark.sparkContext.accumulator(0), standins.table
    seen = F.udf(lambda _: read.add(1) or True, "boolean")
    monkeypatch.setattr(standins, "table", lambda sp, sf, name: plain(sp, sf, name).filter(seen("event_id")))
    return read


def test_nights_read_the_table_once(spark, monkeypatch, tmp_path):
    read = _counted(spark, monkeypatch, str(tmp_path))
    settled = []
    monkeypatch.setattr(settle_queries.settle, "settle", lambda _, at, names, **k: settled.append(spark.table(names.daily_events).count()) or {"error": None})
    settle_queries.settle_nights(spark, str(tmp_path))
    assert len(settled) == len(settle_queries._NIGHTS) + 1 and settled[-1] > 0
    # Rows of other dates may be left out before they are counted.
    assert 0 < read.value <= 200 and read.value <= settled[-1]


def test_micro_batches_of_sparse_and_cut_aircraft_agree(spark, tmp_path, rows, index, monkeypatch):
    """Aircraft with few rows are ordered in one piece, with one staged table a step fewer; the results are those of time chunks."""
    df = spark.createDataFrame(pings(spark, {**busy(), "x": FLIGHT}).collect(), PING)
    cut = F.lit(T0 + timedelta(minutes=100))
    found, staged = [], []
    stage = microbatch.cut_lineage
    for few in (sequence.FEW, 2):
        monkeypatch.setattr(sequence, "FEW", few)
        count = []
        for module in (microbatch, crossings):
            monkeypatch.setattr(module, "cut_lineage", lambda d: count.append(1) or stage(d))
        job = microbatch.Tracking(str(tmp_path / f"few-{few}"), index)
        for number, part in enumerate((df.filter(F.col("timestamp") < cut), df.filter(F.col("timestamp") >= cut))):
            job.each(part, number)
        found.append((rows(job.events(spark)), rows(job.crossings(spark)), rows(spark.read.parquet(f"{job.base}/state/slot=1").select("icao24", "timestamp", "stay"))))
        staged.append(len(count))
    assert found[0] == found[1] and found[0][0] and found[0][1]
    assert staged == [4, 8]
