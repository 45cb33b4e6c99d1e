"""Nightly settlement: idempotent rollup of the day into history, checks, clearing, marts."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake import schema
from flightlake.operators import marts
from flightlake.operators.crossings import close_carried
from flightlake.plans import bloom
from flightlake.plans.sequence import first_per_key
from flightlake.session import cut_lineage, delete, scratch
from flightlake.sources import versions
from flightlake.sources.tables import by_date

# Counts under which a day looks suspicious.
MIN_EVENTS = 10
MIN_CROSSINGS = 5


class ReconciliationError(RuntimeError):
    """The day is not fully in history; nothing was cleared."""


def rollup_events(daily: DataFrame, hist: DataFrame, run_ts: Column, distinct_keys: bool = False) -> DataFrame:
    """Daily events history does not have yet, with audit columns.

    Absence is by natural key, so a second run finds nothing. Duplicates inside
    the day are kept unless ``distinct_keys``.
    """
    fresh = daily.join(hist.select(*schema.EVENT_KEY), list(schema.EVENT_KEY), "left_anti").select(*daily.columns)
    if distinct_keys:
        fresh = first_per_key(fresh, list(schema.EVENT_KEY), ["event_id"])
    return fresh.withColumn("inserted_at", run_ts).withColumn("batch_date", F.to_date(run_ts))


def with_parent(crossings: DataFrame, daily_events: DataFrame, hist_events: DataFrame) -> DataFrame:
    """Crossings with the natural key of their event as ``_icao24, _event_timestamp, _event_type``, NULL if it is nowhere.

    The event is one of the day or one that an earlier night moved to history. Ids
    count together with the aircraft only, and the latest event of an id that is used again.
    """

    def keys(events: DataFrame, name: str) -> DataFrame:
        newest = F.max(F.struct("event_timestamp", "event_type")).alias(name)
        return events.select(F.col("event_id").alias("flight_event_id"), *schema.EVENT_KEY).groupBy("flight_event_id", "icao24").agg(newest)

    known = crossings.join(keys(daily_events, "_day"), ["flight_event_id", "icao24"], "left").join(keys(hist_events, "_old"), ["flight_event_id", "icao24"], "left")
    found = F.coalesce("_day", "_old")
    return known.select(
        *[crossings[c] for c in crossings.columns], F.when(found.isNotNull(), F.col("icao24")).alias("_icao24"),
        found["event_timestamp"].alias("_event_timestamp"), found["event_type"].alias("_event_type"),
    )


EVENT_ID = ("icao24", "event_id")


def lost_events(crossings: DataFrame, daily_events: DataFrame, near: DataFrame) -> DataFrame:
    """``icao24, event_id`` of crossings whose event is neither of the day nor in ``near``."""
    lost = with_parent(crossings, daily_events, near).filter(F.col("_icao24").isNull())
    return lost.select("icao24", F.col("flight_event_id").alias("event_id")).distinct()


def event_dates_of(lost: DataFrame, before: DataFrame) -> list:
    """The dates on which ``before`` has the events of these ids."""
    named = before.select(*EVENT_ID, "event_date").join(lost, list(EVENT_ID), "left_semi")
    # Of an id that is used again the latest event counts.
    newest = named.groupBy(*EVENT_ID).agg(F.max("event_date").alias("event_date"))
    return [r[0] for r in newest.select("event_date").distinct().collect()]


def rollup_crossings(
    daily: DataFrame, daily_events: DataFrame, hist_events: DataFrame, hist: DataFrame, run_ts: Column
) -> DataFrame:
    """Daily crossings history does not have yet, re-keyed to the history event.

    The anti join runs first, so only new crossings are looked up. Their event may have been rolled over the night before.
    """
    fresh = daily.join(hist.select(*schema.CROSSING_KEY), list(schema.CROSSING_KEY), "left_anti").select(*daily.columns)
    key = [f"_{c}" for c in schema.EVENT_KEY]
    target = hist_events.groupBy(*[F.col(c).alias(f"_{c}") for c in schema.EVENT_KEY]).agg(F.min("event_id").alias("_hist_id"))
    return (
        with_parent(fresh, daily_events, hist_events)
        .join(target, key)
        .withColumn("flight_event_id", F.col("_hist_id"))
        .withColumn("source", F.lit(schema.LIVE_SOURCE))
        .withColumns({"inserted_at": run_ts, "batch_date": F.to_date(run_ts), "updated_at": run_ts})
        .select(*daily.columns, "source", "inserted_at", "batch_date", "updated_at")
    )


_ENDING = ("flight_status", "exited_at", "exited_date", "duration_minutes")


def still_open(crossings: DataFrame) -> DataFrame:
    """Crossings in progress without an exit."""
    return crossings.filter((F.col("flight_status") == "IN_PROGRESS") & F.col("exited_at").isNull())


def closings(daily: DataFrame, hist: DataFrame) -> DataFrame:
    """How crossings that history still has open have ended since, by the day's row of the same key: the key and the end."""
    ended = daily.filter(F.col("exited_at").isNotNull()).groupBy(*schema.CROSSING_KEY).agg(F.max_by(F.struct(*_ENDING), "exited_at").alias("end"))
    return ended.join(still_open(hist).select(*schema.CROSSING_KEY), list(schema.CROSSING_KEY), "left_semi").select(*schema.CROSSING_KEY, "end.*")


def carried_ends(open_: DataFrame, events: DataFrame, crossings: DataFrame) -> DataFrame:
    """When open stays ended that the day has no row for: their key, ``closed_at`` and ``landed``.

    That is the aircraft's next landing or entry into a territory, whichever came first. An
    aircraft has few open stays, so the join by aircraft stays about as large as the day.
    """
    landed = events.filter(F.col("event_type") == "LANDED").select("icao24", F.col("event_timestamp").alias("closed_at"), F.lit(0).alias("entry"))
    entered = crossings.select("icao24", F.col("entered_at").alias("closed_at"), F.lit(1).alias("entry"))
    later = open_.select(*schema.CROSSING_KEY).join(landed.unionByName(entered), "icao24").filter(F.col("closed_at") > F.col("entered_at"))
    first = later.groupBy(*schema.CROSSING_KEY).agg(F.min(F.struct("closed_at", "entry")).alias("first"))
    return first.select(*schema.CROSSING_KEY, F.col("first.closed_at").alias("closed_at"), (F.col("first.entry") == 0).alias("landed"))


def with_endings(hist: DataFrame, ends: DataFrame, run_ts: Column) -> DataFrame:
    """History with its open crossings ended as ``ends`` says; rows closed before stay as they are."""
    end = F.struct(*[F.col(c) for c in _ENDING]).alias("_end")
    out = hist.join(ends.select(*schema.CROSSING_KEY, end), list(schema.CROSSING_KEY), "left")
    closing = F.col("_end").isNotNull() & (F.col("flight_status") == "IN_PROGRESS") & F.col("exited_at").isNull()
    out = out.withColumn("_closing", closing)
    changed = {c: F.when(F.col("_closing"), F.col(f"_end.{c}")).otherwise(F.col(c)) for c in _ENDING}
    changed["updated_at"] = F.when(F.col("_closing"), run_ts).otherwise(F.col("updated_at"))
    return out.withColumns(changed).select(*hist.columns)


def orphan_crossings(crossings: DataFrame, events: DataFrame) -> DataFrame:
    """Crossings whose event is not there."""
    return crossings.join(events.select(F.col("event_id").alias("flight_event_id")), "flight_event_id", "left_anti").select(
        *crossings.columns
    )


def day_counts(events: DataFrame, crossings: DataFrame, day: str) -> DataFrame:
    """One row: events and crossings of a day."""
    run_day = F.lit(day).cast("date")
    e = events.filter(F.col("event_date") == run_day).agg(F.count(F.lit(1)).alias("event_count"))
    c = crossings.filter(F.col("entered_date") == run_day).agg(F.count(F.lit(1)).alias("crossing_count"))
    both = e.select("event_count", F.lit(0).cast("bigint").alias("crossing_count")).unionByName(
        c.select(F.lit(0).cast("bigint").alias("event_count"), "crossing_count")
    )
    return both.agg(F.sum("event_count").alias("event_count"), F.sum("crossing_count").alias("crossing_count"))


def counts_by_type(events: DataFrame, day: str) -> DataFrame:
    run_day = F.lit(day).cast("date")
    return events.filter(F.col("event_date") == run_day).groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))


def with_warnings(counts: DataFrame, min_events: int = MIN_EVENTS, min_crossings: int = MIN_CROSSINGS) -> DataFrame:
    """Texts for counts under their minimum; informational, never blocks. The wording of the texts."""

    def warn(label: str, column: str, least: int) -> Column:
        text = F.concat(F.lit(f"{label} ("), F.col(column).cast("string"), F.lit(f") below minimum threshold ({least})."))
        return F.when(F.col(column) < least, text)

    return counts.withColumn(
        "warnings",
        F.array_compact(F.array(warn("Flight events", "event_count", min_events), warn("Territory crossings", "crossing_count", min_crossings))),
    )


def reconcile_counts(name: str, daily: DataFrame, rolled: DataFrame) -> DataFrame:
    """Exact check: as many rows rolled over as the day holds. A rerun rolls none and fails it."""
    sides = daily.select(F.lit(1).alias("d"), F.lit(0).alias("r")).unionByName(rolled.select(F.lit(0).alias("d"), F.lit(1).alias("r")))
    totals = sides.agg(F.coalesce(F.sum("d"), F.lit(0)).alias("expected"), F.coalesce(F.sum("r"), F.lit(0)).alias("actual"))
    return totals.select(F.lit(name).alias("table_name"), "expected", "actual", (F.col("actual") >= F.col("expected")).alias("ok"))


def reconcile_coverage(name: str, daily: DataFrame, hist: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Coverage check: every daily key is in history, whoever put it there."""
    missing = daily.select(*key).join(hist.select(*key), list(key), "left_anti")
    sides = daily.select(F.lit(1).alias("d"), F.lit(0).alias("m")).unionByName(missing.select(F.lit(0).alias("d"), F.lit(1).alias("m")))
    totals = sides.agg(F.coalesce(F.sum("d"), F.lit(0)).alias("expected"), F.coalesce(F.sum("m"), F.lit(0)).alias("missing"))
    return totals.select(F.lit(name).alias("table_name"), "expected", "missing", (F.col("missing") == 0).alias("ok"))


def in_flight(hist_crossings: DataFrame, batch_day: str) -> DataFrame:
    """Crossings of the batch still open at the cut-off."""
    return still_open(hist_crossings).filter(F.col("batch_date") == F.lit(batch_day).cast("date")).agg(F.count(F.lit(1)).alias("in_flight"))


def run_status(metrics: DataFrame) -> DataFrame:
    """Status of a run from ``events_rolled``, ``crossings_rolled`` and ``warnings``.

    NULL says that the step failed. A run that rolled nothing counts as FAILED too, a rerun of a settled day among them.
    """
    failed = (F.coalesce("events_rolled", F.lit(0)) == 0) | (F.coalesce("crossings_rolled", F.lit(0)) == 0)
    return metrics.withColumn(
        "status",
        F.when(failed, "FAILED").when(F.size("warnings") > 0, "COMPLETED WITH WARNINGS").otherwise("COMPLETED SUCCESSFULLY"),
    )


def one_history(live: DataFrame, backfill: DataFrame) -> DataFrame:
    """Live and backfilled rows as one history; ``source`` tells them apart. Columns one side lacks are NULL."""
    return live.unionByName(backfill, allowMissingColumns=True)


@dataclass(frozen=True)
class Tables:
    """Catalog names of the tables settlement works on."""

    daily_events: str = "daily_flight_events"
    daily_crossings: str = "daily_territory_crossings"
    hist_events: str = "hist_flight_events"
    hist_crossings: str = "hist_territory_crossings"
    aircraft: str = "dim_aircraft"
    airports: str = "dim_airport"
    route_mart: str = "gold_route_frequency"
    territory_mart: str = "gold_territory_heatmap"
    route_days: str = "gold_route_days"
    territory_days: str = "gold_territory_days"
    open_stays: str = "state_open_stays"
    event_filters: str = "state_event_filters"


def _dates(df: DataFrame, column: str) -> tuple:
    return df.agg(F.min(column), F.max(column)).first()


def _within(df: DataFrame, column: str, bounds: tuple) -> DataFrame:
    """History limited to the dates of the batch, so only those partitions are read."""
    return df.filter(F.col(column).between(F.lit(bounds[0]), F.lit(bounds[1])))


@dataclass(frozen=True)
class Snapshot:
    """The rows of a table at one moment, and the files they are in; files never change."""

    rows: DataFrame
    files: tuple[str, ...]


def snapshot(spark: SparkSession, table: str) -> Snapshot:
    spark.catalog.refreshTable(table)
    source = spark.table(table)
    files = tuple(source.inputFiles())
    rows = spark.createDataFrame([], source.schema)
    # Partitions that were replaced lie in folders of their own; each has its own base.
    bases: dict[str, list[str]] = {}
    for file in files:
        bases.setdefault(file.rsplit("/", 2)[0], []).append(file)
    read = [spark.read.schema(source.schema).option("basePath", base).parquet(*own) for base, own in bases.items()]
    return Snapshot(reduce(DataFrame.unionByName, read) if read else rows, files)


def clear(spark: SparkSession, table: str, seen: Snapshot) -> None:
    """Remove what was read and verified from a daily table; rows that came later stay."""
    for file in seen.files:
        delete(spark, file)
    spark.catalog.refreshTable(table)


#: Partitions of the table of open stays.
STAY_BUCKETS = 64
_STAY = (*schema.CROSSING_KEY, *_ENDING, "entered_date", "batch_date")


def _stays(crossings: DataFrame) -> DataFrame:
    return still_open(crossings).select(*_STAY, F.pmod(F.xxhash64("icao24"), F.lit(STAY_BUCKETS)).cast("int").alias("bucket"))


def open_stays(spark: SparkSession, tables: Tables) -> DataFrame:
    """The stays that history has open, kept as a table by aircraft; it is made from history once, where it is missing.

    Whoever else changes the state of stays in history drops this table, so that the next settlement makes it anew.
    """
    if not spark.catalog.tableExists(tables.open_stays):
        found = _stays(spark.table(tables.hist_crossings))
        found.hint("rebalance", "bucket").write.format("parquet").partitionBy("bucket").saveAsTable(tables.open_stays)
    return spark.table(tables.open_stays)


def merge_stays(spark: SparkSession, tables: Tables, ended: DataFrame, opened: DataFrame) -> None:
    """Take ended stays out of the table of open ones and enter new ones; only the buckets that change are read and written."""
    key = list(schema.CROSSING_KEY)
    opened, ended = cut_lineage(_stays(opened)), cut_lineage(ended.select(*key, F.pmod(F.xxhash64("icao24"), F.lit(STAY_BUCKETS)).cast("int").alias("bucket")))
    buckets = [r[0] for r in opened.select("bucket").unionByName(ended.select("bucket")).distinct().collect()]
    if buckets:
        kept = spark.table(tables.open_stays).filter(F.col("bucket").isin(buckets))
        gone = ended.select(*key).unionByName(opened.select(*key))
        columns = spark.table(tables.open_stays).columns
        rows = kept.join(gone, key, "left_anti").select(*columns).unionByName(opened.dropDuplicates(key).select(*columns))
        versions.replace(spark, tables.open_stays, rows, "bucket", buckets)


def event_filters(spark: SparkSession, tables: Tables) -> DataFrame:
    """Filters of the event ids of each history date; made from all of history once, where they are missing."""
    if not spark.catalog.tableExists(tables.event_filters):
        every = bloom.filters(spark.table(tables.hist_events).select(*EVENT_ID, "event_date"), "event_date", EVENT_ID)
        every.write.format("parquet").saveAsTable(tables.event_filters)
    return spark.table(tables.event_filters)


def event_candidates(spark: SparkSession, tables: Tables, lost: DataFrame) -> list:
    """Dates on which history may have events of these ids: those whose filter may hold one, and those without a filter."""
    made = event_filters(spark, tables)
    have = {str(r[0]) for r in made.select("event_date").distinct().collect()}
    dates = {r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {tables.hist_events}").collect()}
    return [*[r[0] for r in bloom.candidates(lost, made, "event_date", EVENT_ID).collect()], *sorted(dates - have)]


def add_event_filters(spark: SparkSession, tables: Tables, events: DataFrame) -> None:
    """Enter events into the filters of their dates, before history has them; a run that is repeated only enters them again."""
    columns = event_filters(spark, tables).columns
    new = bloom.filters(events.select(*EVENT_ID, "event_date"), "event_date", EVENT_ID)
    new.select(*columns).write.mode("append").format("parquet").saveAsTable(tables.event_filters)


def _rewrite(spark: SparkSession, table: str, ends: DataFrame, run_ts: Column) -> tuple[int, list]:
    """End open history crossings, rewriting only the dates they were entered on; their number and these dates."""
    dates = [r[0] for r in ends.select(F.to_date("entered_at")).distinct().collect()]
    if dates:
        versions.replace(spark, table, with_endings(spark.table(table).filter(F.col("entered_date").isin(dates)), ends, run_ts), "entered_date", dates)
    return ends.count(), dates


def settle(spark: SparkSession, run_ts: str, tables: Tables = Tables(), build_marts: bool = True, carry_days: int = 3) -> dict:
    """Run one settlement. Steps stop at the first failure; the summary is always returned.

    Works on the files the daily tables have at its start, and clears just these. Keys
    contain their own timestamp, so a row of the batch can only repeat a history row of the same date: history is read
    for the batch's dates only, and ``carry_days`` before them for events that went on over midnight. Stays that are open, however
    long, stand in a table of their own. For crossings whose event is not there, filters of the event ids tell which older dates may have it.
    """
    with scratch(spark):
        return _settle(spark, run_ts, tables, build_marts, carry_days)


def _settle(spark: SparkSession, run_ts: str, tables: Tables, build_marts: bool, carry_days: int) -> dict:
    at, day = F.lit(run_ts).cast("timestamp"), run_ts[:10]
    out: dict = {"day": day, "events_rolled": 0, "crossings_rolled": 0, "closed": 0, "in_flight": None, "warnings": [], "error": None}
    try:
        seen_events, seen_crossings = snapshot(spark, tables.daily_events), snapshot(spark, tables.daily_crossings)
        events, crossings = seen_events.rows, seen_crossings.rows
        counts = with_warnings(day_counts(events, crossings, day)).first()
        out.update(event_count=counts["event_count"], crossing_count=counts["crossing_count"], warnings=list(counts["warnings"]))

        event_dates, crossing_dates = _dates(events, "event_date"), _dates(crossings, "entered_date")
        first = min([d for d in (event_dates[0], crossing_dates[0]) if d is not None], default=None)
        last = max([d for d in (event_dates[1], crossing_dates[1]) if d is not None], default=None)
        carried = (first - timedelta(days=carry_days), last) if first else None
        older_dates: list = []
        old_events = lambda: spark.table(tables.hist_events).filter(F.col("event_date").between(*map(F.lit, carried)) | F.col("event_date").isin(older_dates))
        old_crossings = lambda: _within(spark.table(tables.hist_crossings), "entered_date", carried)
        if event_dates[0] is not None:
            new = cut_lineage(rollup_events(events, _within(spark.table(tables.hist_events), "event_date", event_dates), at))
            add_event_filters(spark, tables, new)
            by_date(new, "event_date").write.mode("append").partitionBy("event_date").format("parquet").saveAsTable(tables.hist_events)
            out["events_rolled"] = new.count()
        if carried:
            stays = open_stays(spark, tables).filter(F.col("entered_date") <= F.lit(last))
            # Open stays of earlier days without a row of their own today end with the aircraft's next landing or entry.
            earlier = stays.join(crossings.select(*schema.CROSSING_KEY), list(schema.CROSSING_KEY), "left_anti")
            left = close_carried(earlier, carried_ends(earlier, events, crossings), schema.CROSSING_KEY).filter(F.col("exited_at").isNotNull())
            ends = cut_lineage(closings(crossings, stays).unionByName(left.select(*schema.CROSSING_KEY, *_ENDING)))
            out["closed"], closed_dates = _rewrite(spark, tables.hist_crossings, ends, at)
        if crossing_dates[0] is not None:
            lost = cut_lineage(lost_events(crossings, events, old_events()))
            if not lost.isEmpty():
                maybe = event_candidates(spark, tables, lost)
                before = spark.table(tables.hist_events).filter((F.col("event_date") < F.lit(carried[0])) & F.col("event_date").isin(maybe))
                older_dates += event_dates_of(lost, before)
            new = cut_lineage(rollup_crossings(crossings, events, old_events(), _within(spark.table(tables.hist_crossings), "entered_date", crossing_dates), at))
            by_date(new, "entered_date").write.mode("append").partitionBy("entered_date").format("parquet").saveAsTable(tables.hist_crossings)
            out["crossings_rolled"] = new.count()
            out["orphans"] = with_parent(crossings, events, old_events()).filter(F.col("_icao24").isNull()).count()
        checks = []
        if event_dates[0] is not None:
            checks.append(reconcile_coverage("events", events, old_events(), schema.EVENT_KEY).first())
        if crossing_dates[0] is not None:
            checks.append(reconcile_coverage("crossings", crossings, old_crossings(), schema.CROSSING_KEY).first())
        short = [f"{c['table_name']}: {c['missing']} of {c['expected']} rows are not in history" for c in checks if not c["ok"]]
        if short:
            raise ReconciliationError("; ".join(short))
        if carried:
            # From what history now has of the day's keys, so a run that was cut short enters the same stays again.
            known = old_crossings().join(crossings.select(*schema.CROSSING_KEY), list(schema.CROSSING_KEY), "left_semi")
            merge_stays(spark, tables, ends, known)
        out["in_flight"] = in_flight(open_stays(spark, tables), day).first()["in_flight"]
        days = lambda df, column: [r[0] for r in df.select(column).distinct().collect()]
        event_days, crossing_days = days(events, "event_date"), sorted({*days(crossings, "entered_date"), *(closed_dates if carried else [])})
        clear(spark, tables.daily_events, seen_events)
        clear(spark, tables.daily_crossings, seen_crossings)
        # The folded days follow every night, also one that builds no mart from them.
        routes = lambda h: marts.departures_with_landings(h, schema.HISTORY_SOURCE)
        if build_marts or spark.catalog.tableExists(tables.route_days):
            route_days = marts.refresh_days(spark, tables.route_days, routes, spark.table(tables.hist_events), "event_date", event_days)
        if build_marts or spark.catalog.tableExists(tables.territory_days):
            territory_days = marts.refresh_days(spark, tables.territory_days, marts.territory_days, spark.table(tables.hist_crossings), "entered_date", crossing_days)
        if build_marts:
            master = spark.table(tables.aircraft)
            marts.write_mart(marts.route_mart_of(route_days, master, spark.table(tables.airports)), tables.route_mart)
            marts.write_mart(marts.territory_mart_of(territory_days, master), tables.territory_mart)
    except Exception as e:  # the summary reports whatever stopped the run
        out["error"] = f"{type(e).__name__}: {e}"
    if out["error"]:
        out.update(events_rolled=None, crossings_rolled=None)
    metrics = spark.createDataFrame([(out["events_rolled"], out["crossings_rolled"], out["warnings"])], "events_rolled long, crossings_rolled long, warnings array<string>")
    out["status"] = run_status(metrics).first()["status"]
    return out
