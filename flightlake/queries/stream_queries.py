"""Streaming and file-load queries. Each replays whole tables and returns what reached the sink."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import functions as F

from flightlake.operators import events as event_ops
from flightlake.plans.sequence import DAY
from flightlake.queries import event_queries as eq
from flightlake.queries import standins as s
from flightlake.queries.registry import query
from flightlake.session import prepare, workdir
from flightlake.sources import files
from flightlake.sources.tables import TableRegistry
from flightlake.streaming import jobs, microbatch

_EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


_PARTS = 4


def _streamed(spark, sf):
    """The events table as a stream of micro-batches in time order, of as many files each as the smallest one can fill; rows without a time come first."""
    base = workdir(prepare(spark), "stream")
    events = s.table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    cuts = events.agg(F.percentile_approx(at, [i / _PARTS for i in range(1, _PARTS)])).first()[0] or []
    part = reduce(add, [(at > F.lit(c)).cast("int") for c in cuts], F.lit(0))
    numbered = events.withColumn("part", F.coalesce(part, F.lit(0)))
    rows = dict(sorted(numbered.groupBy("part").count().collect()))
    files = max(1, min(rows.values(), default=0) // 100_000)
    for i in rows:
        numbered.filter(F.col("part") == i).drop("part").repartition(files).write.mode("append").parquet(base)
    if rows and len(spark.read.parquet(base).inputFiles()) != files * len(rows):
        raise RuntimeError("a micro-batch would not hold the files of one part")
    return spark.readStream.schema(_EVENT_SCHEMA).option("maxFilesPerTrigger", files).parquet(base)


def _finish(query_):
    query_.awaitTermination()
    if query_.exception() is not None:
        raise query_.exception()


def _stored(spark, stream, name):
    """Replay a stream into Parquet in the shared folder and read that back."""
    base = workdir(prepare(spark), name)
    _finish(jobs.start(stream, f"{base}/checkpoint", path=f"{base}/out", replay=True))
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


def _tracked(spark, sf):
    """All positions streamed through the micro-batch tracker."""
    base = workdir(prepare(spark), "tracking")
    job = microbatch.Tracking(base, eq._index(spark, sf), tie="event_id", width=DAY)
    _finish(jobs.start(s.pings(spark, sf, _streamed(spark, sf)), f"{base}/checkpoint", each=job.each, replay=True))
    return job


@query("stream_events", s.with_views(
    f"SELECT {eq._EVENT_COLS} FROM detected WHERE event_type IS NOT NULL", "pings", detected=eq._DETECTED.format(src="pings")))
def stream_events(spark, sf):
    return _tracked(spark, sf).events(spark).select("event_id", "icao24", "callsign", "event_type", "timestamp", "latitude", "longitude", "altitude_ft")


@query("stream_crossings", s.with_views(f"SELECT {eq._SESSION_COLS} FROM sessions", "pings", "boxes", **eq._SESSIONS))
def stream_crossings(spark, sf):
    return _tracked(spark, sf).crossings(spark)


@query("stream_latest", s.with_views(f"""
    SELECT icao24, coalesce(nullif(callsign, ''), icao24) AS callsign, latitude, longitude, altitude_ft, event_type, {s.ts_text('event_timestamp')} AS updated_at, 'stream' AS source
    FROM (SELECT * FROM flight_events QUALIFY row_number() OVER (PARTITION BY icao24 ORDER BY event_timestamp DESC, event_id DESC) = 1) WHERE NOT on_ground""", "flight_events"))
def stream_latest(spark, sf):
    base = workdir(prepare(spark), "cache")
    stream = jobs.latest_states(s.flight_events(spark, sf, _streamed(spark, sf)), tie="event_id")
    _finish(jobs.start(stream, f"{base}/checkpoint", each=jobs.position_snapshot(f"{base}/cache"), mode="update", replay=True))
    return jobs.read_cache(spark, f"{base}/cache")


@query("stream_dedup", s.with_views(
    f"SELECT icao24, event_type, {s.ts_text('event_timestamp')} AS event_timestamp, count(*) AS copies FROM flight_events GROUP BY ALL", "flight_events"))
def stream_dedup(spark, sf):
    """Every event delivered twice, kept once."""
    once = s.flight_events(spark, sf, _streamed(spark, sf)).select("icao24", "event_type", "event_timestamp")
    twice = once.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    kept = _stored(spark, jobs.without_repeats(twice), "dedup")
    return kept.groupBy("icao24", "event_type", "event_timestamp").agg(F.count(F.lit(1)).alias("copies"))


# Monthly flight lists ------------------------------------------------------------------------

_LIST = """
    SELECT event_id, CAST(user_id AS VARCHAR) AS icao24, ts, event_type, value, 'K' || (event_id * 3) % 100 AS dep, 'K' || (event_id * 5) % 100 AS arr,
           event_type <> 'view' AS accepted FROM events"""


def _flight_list(spark, sf):
    """Events as flight list texts: views lack their last sighting, clicks have text times."""
    ts, n, kind = F.col("ts").cast("timestamp"), F.col("event_id"), F.col("event_type")
    seconds = lambda c: F.unix_timestamp(c)
    end = ts + F.make_dt_interval(hours=F.lit(1))
    code = lambda k: F.concat(F.lit("K"), F.pmod(n * k, F.lit(100)).cast("string"))
    columns = {
        "callsign": F.when(kind != "error", F.concat(F.lit(" FL"), F.col("user_id").cast("string"))).otherwise("nan"),
        "number": n.cast("string"), "icao24": F.col("user_id").cast("string"), "origin": code(3), "destination": code(5),
        "firstseen": F.when(kind == "click", F.date_format(ts, "yyyy-MM-dd HH:mm:ss")).otherwise(seconds(ts).cast("string")),
        "lastseen": F.when(kind == "click", F.date_format(end, "yyyy-MM-dd'T'HH:mm:ss")).when(kind == "view", "None").otherwise(seconds(end).cast("string")),
        "latitude_1": F.lit("6.5"), "longitude_1": F.lit("3.25"), "altitude_1": (F.col("value") * 10).cast("string"),
        "latitude_2": F.lit("-1.25"), "longitude_2": F.lit("36.75"), "altitude_2": F.lit("nan"),
    }
    from flightlake.schema import FLIGHT_LIST_COLUMNS

    listed = [columns.get(c, F.lit(None).cast("string")).alias(c) for c in FLIGHT_LIST_COLUMNS]
    return s.table(spark, sf, "events").select(*listed)


_ALT = "round(CAST(value * 10 AS DECIMAL(18,6)) * 3.28084, 1)"
_LIST_EVENTS = f"""
    SELECT icao24, CASE WHEN event_type <> 'error' THEN 'FL' || icao24 END AS callsign, side AS event_type,
           {s.ts_text("date_trunc('second', ts) + CASE side WHEN 'LANDED' THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END")} AS event_timestamp,
           CASE side WHEN 'DEPARTED' THEN 6.5 ELSE -1.25 END::DOUBLE AS latitude, CASE side WHEN 'DEPARTED' THEN CAST({_ALT} AS DOUBLE) END AS altitude_ft,
           o.iata AS origin_iata, d.iata AS destination_iata
    FROM fl CROSS JOIN (SELECT unnest(['DEPARTED', 'LANDED']) AS side) LEFT JOIN codes o ON o.icao = dep LEFT JOIN codes d ON d.icao = arr WHERE accepted"""
_LIST_COLS = ["icao24", "callsign", "event_type", "event_timestamp", "latitude", "altitude_ft", "origin_iata", "destination_iata"]
_RUN_TS = "2024-02-01 00:00:00"


@query("flight_to_events", s.with_views(_LIST_EVENTS, "airports", "codes", fl=_LIST))
def flight_to_events(spark, sf):
    run = F.lit(_RUN_TS).cast("timestamp")
    return event_ops.flights_to_events(event_ops.typed_flights(_flight_list(spark, sf)), s.airports(spark, sf), run).select(*_LIST_COLS)


_TOTALS = ("total_rows", "events_inserted", "rows_skipped")
_LOADED = "SELECT accepted FROM fl UNION ALL SELECT accepted FROM fl WHERE event_id % 3 = 0"


def _load_lists(spark, sf):
    """Two compressed lists with their columns in different order, the second repeating a third of the flights; the load runs again after each."""
    base = workdir(prepare(spark), "lists")
    flights = _flight_list(spark, sf)
    put = lambda df: df.write.mode("append").option("header", True).option("compression", "gzip").csv(f"{base}/in")
    load = lambda: jobs.load_flight_lists(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint", s.airports(spark, sf), _RUN_TS)
    put(flights.select(*reversed(flights.columns)))
    load()
    put(flights.filter("cast(number AS bigint) % 3 = 0").select(*sorted(flights.columns), F.lit("x").alias("Note")))
    load()
    return load(), TableRegistry(spark, f"{base}/out").read("hist_flight_events")


@query("flight_list_load", s.with_views(f"""
    SELECT DISTINCT icao24, side AS event_type, {s.ts_text("date_trunc('second', ts) + CASE side WHEN 'LANDED' THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END")} AS event_timestamp,
           CASE side WHEN 'DEPARTED' THEN 6.5 ELSE -1.25 END::DOUBLE AS latitude, 'opensky_historical' AS source
    FROM fl CROSS JOIN (SELECT unnest(['DEPARTED', 'LANDED']) AS side) WHERE accepted""", fl=_LIST))
def flight_list_load(spark, sf):
    """History rows out of overlapping lists: each key once."""
    return _load_lists(spark, sf)[1].select("icao24", "event_type", "event_timestamp", "latitude", "source")


@query("flight_list_summary", s.with_views(
    "SELECT count(*) AS total_rows, 2 * count(*) FILTER (WHERE accepted) AS events_inserted, count(*) FILTER (WHERE NOT accepted) AS rows_skipped FROM loaded",
    fl=_LIST, loaded=_LOADED))
def flight_list_summary(spark, sf):
    return _load_lists(spark, sf)[0].agg(*[F.sum(c).alias(c) for c in _TOTALS])


@query("flight_list_scan", s.with_views(
    "SELECT event_id AS number, icao24, CASE WHEN event_type <> 'error' THEN 'FL' || icao24 END AS callsign, accepted FROM fl", fl=_LIST))
def flight_list_scan(spark, sf):
    """The same list through the batch reader, which keeps 'nan' and 'None' as text until they are cleaned."""
    base = workdir(prepare(spark), "scan")
    _flight_list(spark, sf).write.option("header", True).option("compression", "gzip").csv(f"{base}/in")
    typed = event_ops.typed_flights(files.flight_lists(spark, f"{base}/in").withColumn("list_no", F.col("number").cast("bigint")))
    return typed.select(F.col("list_no").alias("number"), "icao24", "callsign", "accepted")
