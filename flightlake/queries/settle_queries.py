"""Settlement, enrichment and data-quality queries."""

from __future__ import annotations

import dataclasses
import uuid

from pyspark.sql import functions as F

from flightlake import schema
from flightlake.functions import measure
from flightlake.operators import crossings, quality, settle, silver
from flightlake.queries import standins as s
from flightlake.queries.registry import query
from flightlake.session import cut_lineage
from flightlake.sources import tables

DAY = s.LAST_DAY


def _run():
    return F.lit(f"{DAY} 23:59:00").cast("timestamp")


def _rolled_before(events):
    """History so far: all earlier days, and of the last day what an interrupted run already rolled."""
    return events.filter((F.col("event_date") < F.lit(DAY).cast("date")) | (F.col("event_type") == "CRUISING"))


_OLD = f"SELECT * FROM flight_events WHERE event_date < DATE '{DAY}' OR event_type = 'CRUISING'"
_FRESH = "SELECT * FROM flight_events d WHERE NOT EXISTS (SELECT 1 FROM old h WHERE h.icao24 = d.icao24 AND h.event_timestamp = d.event_timestamp AND h.event_type = d.event_type)"


@query("rollup_events", s.with_views(
    f"SELECT event_id, icao24, event_type, {s.ts_text('event_timestamp')} AS event_timestamp, CAST(event_date AS VARCHAR) AS event_date, source, "
    f"'{DAY} 23:59:00.000000' AS inserted_at, '{DAY}' AS batch_date FROM fresh", "flight_events", old=_OLD, fresh=_FRESH))
def rollup_events(spark, sf):
    events = s.flight_events(spark, sf)
    return settle.rollup_events(events, _rolled_before(events), _run()).select(
        "event_id", "icao24", "event_type", "event_timestamp", "event_date", "source", "inserted_at", "batch_date")


@query("rollup_twice", s.with_views(
    "SELECT (SELECT count(*) FROM fresh) AS first_run, 0 AS second_run, (SELECT count(*) FROM flight_events) AS in_history",
    "flight_events", old=_OLD, fresh=_FRESH))
def rollup_twice(spark, sf):
    daily = s.flight_events(spark, sf)
    keyed = daily.select(*schema.EVENT_KEY, "event_date")
    old = _rolled_before(keyed)
    first = settle.rollup_events(keyed, old, _run())
    after = old.unionByName(first.select(*old.columns))
    second = settle.rollup_events(keyed, after, _run())
    count = lambda df, name: df.select(*[F.lit(int(n == name)).alias(n) for n in ("first_run", "second_run", "in_history")])
    every = count(first, "first_run").unionByName(count(second, "second_run")).unionByName(count(after, "in_history"))
    return every.agg(*[F.sum(n).alias(n) for n in ("first_run", "second_run", "in_history")])


_PARENTS = "SELECT event_id, icao24, event_timestamp, event_type FROM hist_events WHERE event_type <> 'CLIMBING'"
_SETTLED = "SELECT * FROM crossings WHERE crossing_role = 'START'"
# By sets of keys: what must be in history afterwards is every daily key that was not there, if its event is known.
# It hangs on the first history id that has the event's natural key.
_FIRST_IDS = "SELECT event_id, 5000000 + min(event_id) OVER (PARTITION BY icao24, event_timestamp, event_type) AS hist_id FROM hist_events"
_NEW_KEYS = "SELECT icao24, entered_at, territory_id FROM crossings EXCEPT SELECT icao24, entered_at, territory_id FROM settled"
_NEW_CROSSINGS = f"""
    SELECT hist_id AS flight_event_id, icao24, crossing_id, callsign, territory_type, territory_id, territory_name, crossing_role, flight_status,
           {s.ts_text('entered_at')} AS entered_at, CAST(entered_date AS VARCHAR) AS entered_date, {s.ts_text('exited_at')} AS exited_at,
           CAST(duration_minutes AS DOUBLE) AS duration_minutes, 'opensky' AS source,
           '{DAY} 23:59:00.000000' AS inserted_at, '{DAY} 23:59:00.000000' AS updated_at, '{DAY}' AS batch_date
    FROM crossings SEMI JOIN new_keys USING (icao24, entered_at, territory_id) JOIN first_ids ON event_id = flight_event_id
    WHERE flight_event_id IN (SELECT event_id FROM parents)"""


def _daily_parents(spark, sf):
    return s.hist_events(spark, sf).filter(F.col("event_type") != "CLIMBING")


@query("rollup_crossings", s.with_views(_NEW_CROSSINGS, "crossings", parents=_PARENTS, settled=_SETTLED, first_ids=_FIRST_IDS, new_keys=_NEW_KEYS))
def rollup_crossings(spark, sf):
    daily = s.crossings(spark, sf).drop("source")
    hist_events = s.hist_events(spark, sf).withColumn("event_id", F.col("event_id") + 5000000)
    old = daily.filter(F.col("crossing_role") == "START")
    return settle.rollup_crossings(daily, _daily_parents(spark, sf), hist_events, old, _run()).select(
        "flight_event_id", "icao24", "crossing_id", "callsign", "territory_type", "territory_id", "territory_name", "crossing_role", "flight_status",
        "entered_at", "entered_date", "exited_at", "duration_minutes", "source", "inserted_at", "updated_at", "batch_date")


@query("orphan_crossings", s.with_views(
    "SELECT count(*) AS orphans FROM crossings c WHERE NOT EXISTS (SELECT 1 FROM parents d WHERE d.event_id = c.flight_event_id)",
    "crossings", parents=_PARENTS))
def orphan_crossings(spark, sf):
    return settle.orphan_crossings(s.crossings(spark, sf), _daily_parents(spark, sf)).agg(F.count(F.lit(1)).alias("orphans"))


@query("validate_counts", s.with_views(
    f"""SELECT event_count, crossing_count, concat_ws('|',
            CASE WHEN event_count < 100000 THEN 'Flight events (' || event_count || ') below minimum threshold (100000).' END,
            CASE WHEN crossing_count < 5 THEN 'Territory crossings (' || crossing_count || ') below minimum threshold (5).' END) AS warnings
        FROM (SELECT (SELECT count(*) FROM flight_events WHERE event_date = DATE '{DAY}') AS event_count,
                     (SELECT count(*) FROM crossings WHERE entered_date = DATE '{DAY}') AS crossing_count)""", "crossings"))
def validate_counts(spark, sf):
    counts = settle.day_counts(s.flight_events(spark, sf), s.crossings(spark, sf), DAY)
    return settle.with_warnings(counts, min_events=100000).withColumn("warnings", F.concat_ws("|", "warnings"))


@query("type_counts", s.with_views(
    f"SELECT event_type, count(*) AS events FROM flight_events WHERE event_date = DATE '{DAY}' GROUP BY event_type", "flight_events"))
def type_counts(spark, sf):
    return settle.counts_by_type(s.flight_events(spark, sf), DAY)


@query("reconcile", s.with_views(
    "SELECT 'events' AS table_name, (SELECT count(*) FROM flight_events) AS expected, (SELECT count(*) FROM fresh) AS actual, "
    "(SELECT count(*) FROM fresh) >= (SELECT count(*) FROM flight_events) AS ok", "flight_events", old=_OLD, fresh=_FRESH))
def reconcile(spark, sf):
    events = s.flight_events(spark, sf)
    return settle.reconcile_counts("events", events, settle.rollup_events(events, _rolled_before(events), _run()))


@query("reconcile_coverage", s.with_views(
    "SELECT 'events' AS table_name, (SELECT count(*) FROM flight_events) AS expected, (SELECT count(*) FROM fresh) AS missing, "
    "(SELECT count(*) FROM fresh) = 0 AS ok", "flight_events", old=_OLD, fresh=_FRESH))
def reconcile_coverage(spark, sf):
    events = s.flight_events(spark, sf)
    return settle.reconcile_coverage("events", events, _rolled_before(events), schema.EVENT_KEY)


@query("in_flight", s.with_views("SELECT count(*) AS in_flight FROM crossings WHERE flight_status = 'IN_PROGRESS' AND exited_at IS NULL", "crossings"))
def in_flight(spark, sf):
    return settle.in_flight(s.crossings(spark, sf).withColumn("batch_date", F.lit(DAY).cast("date")), DAY)


@query("run_status", s.with_views("""
    SELECT territory_type, events_rolled, crossings_rolled, CASE WHEN events_rolled = 0 OR crossings_rolled = 0 THEN 'FAILED'
           WHEN events_rolled < 3000 THEN 'COMPLETED WITH WARNINGS' ELSE 'COMPLETED SUCCESSFULLY' END AS status
    FROM (SELECT territory_type, count(*) AS events_rolled, count(*) FILTER (WHERE crossing_role <> 'ROUTE' AND territory_type <> 'STATE') AS crossings_rolled
          FROM crossings GROUP BY territory_type)""", "crossings"))
def run_status(spark, sf):
    country = F.col("territory_type") != "STATE"
    runs = s.crossings(spark, sf).groupBy("territory_type").agg(
        F.count(F.lit(1)).alias("events_rolled"), F.count_if((F.col("crossing_role") != "ROUTE") & country).alias("crossings_rolled"))
    warned = runs.withColumn("warnings", F.array_compact(F.array(F.when(F.col("events_rolled") < 3000, F.lit("few events")))))
    return settle.run_status(warned).drop("warnings")


@query("one_history", s.with_views(
    "SELECT source, event_type, count(*) AS events, count(altitude_ft) AS with_altitude FROM "
    "(SELECT source, event_type, altitude_ft FROM flight_events UNION ALL SELECT 'backfill', event_type, NULL FROM hist_events) GROUP BY ALL", "hist_events"))
def one_history(spark, sf):
    backfill = s.hist_events(spark, sf).drop("altitude_ft").withColumn("source", F.lit("backfill"))
    return settle.one_history(s.flight_events(spark, sf), backfill).groupBy("source", "event_type").agg(
        F.count(F.lit(1)).alias("events"), F.count("altitude_ft").alias("with_altitude"))


# Carry-over: crossings open at a cut-off are closed by the aircraft's next event after it --------

_CLOSED = f"""
    SELECT c.crossing_id, CASE WHEN x.closed_at >= c.entered_at AND c.exited_at IS NULL THEN CASE WHEN x.landed THEN 'COMPLETED' ELSE flight_status END ELSE flight_status END AS flight_status,
           {s.ts_text("CASE WHEN c.exited_at IS NULL AND x.closed_at >= c.entered_at THEN x.closed_at ELSE c.exited_at END")} AS exited_at,
           CASE WHEN c.exited_at IS NULL AND x.closed_at >= c.entered_at THEN {s.half_up('(epoch_us(x.closed_at) - epoch_us(c.entered_at))', '60000000', 2)}
                ELSE CAST(c.duration_minutes AS DOUBLE) END AS duration_minutes
    FROM crossings c LEFT JOIN (SELECT icao24, max(event_timestamp) AS closed_at, arg_max(event_type = 'LANDED', event_timestamp) AS landed
        FROM hist_events GROUP BY icao24) x ON x.icao24 = c.icao24"""


@query("close_carried", s.with_views(_CLOSED, "crossings"))
def close_carried(spark, sf):
    last = s.hist_events(spark, sf).groupBy("icao24").agg(
        F.max("event_timestamp").alias("closed_at"), F.max_by(F.col("event_type") == "LANDED", "event_timestamp").alias("landed"))
    return crossings.close_carried(s.crossings(spark, sf).withColumn("exited_date", F.to_date("exited_at")), last).select(
        "crossing_id", "flight_status", "exited_at", "duration_minutes")


_REOPENED = "SELECT * FROM crossings WHERE flight_status = 'IN_PROGRESS' AND exited_at IS NULL"


@query("carried_closed", s.with_views(f"""
    SELECT crossing_id, CASE WHEN hit THEN 'COMPLETED' ELSE flight_status END AS flight_status,
           {s.ts_text("CASE WHEN hit THEN entered_at + INTERVAL 45 MINUTE ELSE exited_at END")} AS exited_at,
           CASE WHEN hit THEN 45.0 ELSE CAST(duration_minutes AS DOUBLE) END AS duration_minutes
    FROM (SELECT *, flight_status = 'IN_PROGRESS' AND exited_at IS NULL AND crossing_id % 2 = 0 AS hit FROM crossings)""", "crossings"))
def carried_closed(spark, sf):
    """History whose open crossings meet closing rows of the same key; a closing row of a closed one changes nothing."""
    hist = s.crossings(spark, sf).withColumns({"exited_date": F.to_date("exited_at"), "updated_at": F.lit(None).cast("timestamp")})
    over = F.col("entered_at") + F.make_dt_interval(mins=F.lit(45))
    daily = hist.filter("crossing_id % 2 = 0").withColumns({
        "flight_status": F.lit("COMPLETED"), "exited_at": over, "exited_date": F.to_date(over), "duration_minutes": F.lit(45).cast("decimal(8,2)")})
    return settle.with_endings(hist, settle.closings(daily, hist), _run()).select("crossing_id", "flight_status", "exited_at", "duration_minutes")


# Three nights: stays begin with cruising events and last half an hour to thirty hours. Every second one that goes on over
# midnight has a closing row on the day it ends; the others end with the aircraft's next landing or entry.
_NIGHTS = ("2024-01-28", "2024-01-29", "2024-01-30")
_STAYS = f"""
    SELECT *, CAST(x AS DATE) = d AS same_day, event_id % 2 = 0 AND CAST(x AS DATE) > d AND CAST(x AS DATE) <= DATE '{_NIGHTS[-1]}' AS own
    FROM (SELECT event_id, icao24, event_timestamp AS entered_at, event_date AS d, (event_id * 7) % 25 AS territory_id,
                 event_timestamp + to_minutes(30 * (1 + event_id % 60)) AS x
          FROM flight_events WHERE event_type = 'CRUISING' AND event_date BETWEEN DATE '{_NIGHTS[0]}' AND DATE '{_NIGHTS[-1]}')"""
_BATCH = """
    SELECT icao24, d AS night, entered_at AS t, 1 AS entry FROM stays UNION ALL SELECT icao24, CAST(x AS DATE), entered_at, 1 FROM stays WHERE own
    UNION ALL SELECT icao24, event_date, event_timestamp, 0 FROM flight_events WHERE event_type = 'LANDED'"""
_ENDS = f"""
    SELECT event_id, CAST(x AS DATE) AS night, 0 AS late, x AS t, 0 AS entry FROM stays WHERE own
    UNION ALL SELECT s.event_id, b.night, 1, b.t, b.entry FROM stays s JOIN batch b ON b.icao24 = s.icao24 AND b.t > s.entered_at AND b.night > s.d
        AND b.night <= DATE '{_NIGHTS[-1]}' WHERE NOT s.same_day AND NOT (s.own AND CAST(s.x AS DATE) = b.night)"""
_MIN = "(epoch_us(t) - epoch_us(entered_at))"


@query("settle_nights", s.with_views(f"""
    SELECT icao24, territory_id, {s.ts_text('entered_at')} AS entered_at, event_id AS flight_event_id,
           CASE WHEN same_day OR (t IS NOT NULL AND entry = 0) THEN 'COMPLETED' ELSE 'IN_PROGRESS' END AS flight_status,
           {s.ts_text('t')} AS exited_at, {s.half_up(_MIN, '60000000', 2)} AS duration_minutes
    FROM (SELECT s.icao24, s.territory_id, s.entered_at, s.event_id, s.same_day, CASE WHEN s.same_day THEN s.x ELSE e.t END AS t, e.entry
          FROM stays s LEFT JOIN first_end e ON e.event_id = s.event_id)""", "flight_events", stays=_STAYS, batch=_BATCH, ends=_ENDS,
    first_end="SELECT event_id, t, entry FROM ends QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY night, late, t, entry) = 1"))
def settle_nights(spark, sf):
    """Crossings in history after three settlements in a row, the last one run twice."""
    events = s.flight_events(spark, sf).filter(F.col("event_date").between(*[F.lit(n).cast("date") for n in (_NIGHTS[0], _NIGHTS[-1])]))
    # Staged, as every night reads them twice and they are a few dates of all.
    events = cut_lineage(events.select(*[(F.col(f.name).try_cast(f.dataType) if f.name in events.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.DAILY_EVENT]))
    n, entered = F.col("event_id"), F.col("event_timestamp")
    stays = events.filter("event_type = 'CRUISING'").withColumn("x", entered + F.make_dt_interval(mins=(30 * (1 + n % 60)).cast("int")))
    base = f"nights_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {base}")
    names = settle.Tables(**{f.name: f"{base}.{f.default}" for f in dataclasses.fields(settle.Tables)})
    tables.create_catalog_tables(spark, ("daily_flight_events", "daily_territory_crossings", "hist_flight_events", "hist_territory_crossings"), base)
    for night in _NIGHTS:
        day = F.lit(night).cast("date")
        own = (n % 2 == 0) & (F.col("event_date") < day) & (F.to_date("x") == day)
        known = stays.filter((F.col("event_date") == day) | own)
        over = F.to_date("x") == day
        rows = known.select(
            n.alias("crossing_id"), n.alias("flight_event_id"), "icao24", "callsign", F.lit("COUNTRY").alias("territory_type"),
            (n * 7 % 25).cast("int").alias("territory_id"), F.lit("N").alias("territory_name"), F.lit("ROUTE").alias("crossing_role"),
            F.when(over, "COMPLETED").otherwise("IN_PROGRESS").alias("flight_status"), entered.alias("entered_at"), F.col("event_date").alias("entered_date"),
            F.when(over, F.col("x")).alias("exited_at"), F.when(over, F.to_date("x")).alias("exited_date"),
            F.when(over, measure.stay_minutes("event_timestamp", "x")).alias("duration_minutes"), F.lit(None).cast("timestamp").alias("created_at"))
        for _ in range(2 if night == _NIGHTS[-1] else 1):
            tables.by_date(events.filter(F.col("event_date") == day), "event_date").write.mode("append").format("parquet").partitionBy("event_date").saveAsTable(names.daily_events)
            tables.by_date(rows, "entered_date").write.mode("append").format("parquet").partitionBy("entered_date").saveAsTable(names.daily_crossings)
            done = settle.settle(spark, f"{night} 23:59:00", names, build_marts=False)
            if done["error"]:
                raise RuntimeError(done["error"])
    out = cut_lineage(spark.table(names.hist_crossings).select(
        "icao24", "territory_id", "entered_at", "flight_event_id", "flight_status", "exited_at", "duration_minutes"))
    spark.sql(f"DROP DATABASE {base} CASCADE")
    return out


# Enrichment --------------------------------------------------------------------------------

_WORK = f"""
    SELECT DISTINCT icao24 FROM flight_events WHERE event_date = DATE '{DAY}' AND event_type IN ('DEPARTED', 'LANDED')
       AND (origin_iata IS NULL OR destination_iata IS NULL)"""
_ROUTES = """
    SELECT w.icao24, o.iata AS new_origin, d.iata AS new_destination, r.icao24 IS NOT NULL AS found FROM work w
    LEFT JOIN (SELECT icao24, dep, arr FROM records QUALIFY row_number() OVER (PARTITION BY icao24 ORDER BY last_seen DESC, dep DESC NULLS LAST, arr DESC NULLS LAST) = 1) r ON r.icao24 = w.icao24
    LEFT JOIN codes o ON o.icao = r.dep LEFT JOIN codes d ON d.icao = r.arr"""
_ENRICHED = f"""
    SELECT event_id, icao24, event_type,
           CASE WHEN today AND new_origin IS NOT NULL AND new_destination IS NOT NULL AND (origin_iata IS NULL OR destination_iata IS NULL) THEN new_origin
                WHEN today AND origin_iata IS NULL THEN new_origin ELSE origin_iata END AS origin_iata,
           CASE WHEN today AND new_origin IS NOT NULL AND new_destination IS NOT NULL AND (origin_iata IS NULL OR destination_iata IS NULL) THEN new_destination
                WHEN today AND destination_iata IS NULL THEN new_destination ELSE destination_iata END AS destination_iata,
           coalesce(today AND ((new_origin IS NOT NULL AND new_destination IS NOT NULL AND (origin_iata IS NULL OR destination_iata IS NULL))
                OR (new_origin IS NOT NULL AND new_destination IS NULL AND origin_iata IS NULL)
                OR (new_origin IS NULL AND new_destination IS NOT NULL AND destination_iata IS NULL)), false) AS touched
    FROM (SELECT f.*, r.new_origin, r.new_destination, event_date = DATE '{DAY}' AS today FROM flight_events f LEFT JOIN routes r ON r.icao24 = f.icao24)"""
_SILVER = {"work": _WORK, "routes": _ROUTES, "enriched": _ENRICHED}
_SILVER_VIEWS = ("flight_events", "airports", "records", "codes")


def _routes(spark, sf):
    work = silver.worklist(s.flight_events(spark, sf), DAY)
    return silver.resolved_routes(work, s.flight_records(spark, sf), s.airports(spark, sf))


@query("worklist", s.with_views("SELECT icao24 FROM work", "flight_events", work=_WORK))
def worklist(spark, sf):
    return silver.worklist(s.flight_events(spark, sf), DAY)


@query("resolved_routes", s.with_views("SELECT * FROM routes", *_SILVER_VIEWS, work=_WORK, routes=_ROUTES))
def resolved_routes(spark, sf):
    return _routes(spark, sf)


@query("enrich_update", s.with_views("SELECT * FROM enriched", *_SILVER_VIEWS, **_SILVER))
def enrich_update(spark, sf):
    return silver.enrich(s.flight_events(spark, sf), _routes(spark, sf), DAY).select(
        "event_id", "icao24", "event_type", "origin_iata", "destination_iata", "touched")


@query("enrich_summary", s.with_views(
    "SELECT (SELECT count(*) FROM routes) AS processed, (SELECT count(*) FILTER (WHERE found) FROM routes) AS enriched, "
    "(SELECT count(*) FILTER (WHERE NOT found) FROM routes) AS no_data, (SELECT count(*) FROM enriched WHERE touched) AS rows_updated",
    *_SILVER_VIEWS, **_SILVER))
def enrich_summary(spark, sf):
    routes = _routes(spark, sf)
    return silver.enrich_summary(routes, silver.enrich(s.flight_events(spark, sf), routes, DAY))


@query("completeness", s.with_views(
    "SELECT count(*) AS total, count(origin_iata) AS has_origin, count(destination_iata) AS has_destination, "
    "count(*) - count(origin_iata) AS missing_origin, count(*) - count(destination_iata) AS missing_destination FROM flight_events", "flight_events"))
def completeness(spark, sf):
    return silver.completeness(s.flight_events(spark, sf))


# Quality -----------------------------------------------------------------------------------

_REASONS = """
    SELECT event_id, concat_ws('|',
        CASE WHEN callsign IS NULL THEN 'callsign is missing' END,
        CASE WHEN event_type NOT IN ('DEPARTED', 'CLIMBING', 'DESCENDING', 'LANDED') THEN 'event_type is not an allowed value' END,
        CASE WHEN altitude_ft NOT BETWEEN 100 AND 40000 THEN 'altitude_ft is out of range' END,
        CASE WHEN length(origin_iata) > 2 THEN 'origin_iata is longer than 2' END) AS reasons FROM flight_events"""


def _rules():
    return {
        **quality.required("callsign"),
        **quality.one_of("event_type", ("DEPARTED", "CLIMBING", "DESCENDING", "LANDED")),
        **quality.within("altitude_ft", 100, 40000),
        **quality.at_most({"origin_iata": 2}),
    }


@query("constraint_rejects", s.with_views("SELECT * FROM r WHERE reasons <> ''", "flight_events", r=_REASONS))
def constraint_rejects(spark, sf):
    _, bad = quality.split(s.flight_events(spark, sf), _rules())
    return bad.select("event_id", F.concat_ws("|", "reasons").alias("reasons"))


@query("first_offenders", s.with_views(
    "SELECT rule, count(*) AS rows, min(event_id) AS first_key FROM (SELECT event_id, unnest(string_split(reasons, '|')) AS rule FROM r WHERE reasons <> '') GROUP BY rule",
    "flight_events", r=_REASONS))
def first_offenders(spark, sf):
    return quality.first_offenders(s.flight_events(spark, sf), _rules(), "event_id")


@query("repeated_keys", s.with_views(
    "SELECT airport_iata_code, count(*) AS rows FROM airports GROUP BY 1 HAVING count(*) > 1", "airports"))
def repeated_keys(spark, sf):
    return quality.repeated_keys(s.airports(spark, sf), ["airport_iata_code"])


@query("broken_references", s.with_views(
    "SELECT event_id, origin_iata FROM flight_events WHERE origin_iata IS NOT NULL AND origin_iata NOT IN "
    "(SELECT airport_iata_code FROM airports WHERE airport_iata_code IS NOT NULL)", "flight_events", "airports"))
def broken_references(spark, sf):
    return quality.broken_references(
        s.flight_events(spark, sf).select("event_id", "origin_iata"), "origin_iata", s.airports(spark, sf), "airport_iata_code")
