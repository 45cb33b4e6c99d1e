"""Streaming jobs: running a query to its sink, dual writes, the position cache, deduplication."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flightlake import schema
from flightlake.functions.clean import shown_callsign
from flightlake.functions.text import monitor_line
from flightlake.operators.events import flights_to_events, typed_flights
from flightlake.session import cut_lineage, scratch
from flightlake.sources.files import flight_list_stream, load_summary, named_rows, with_aircraft
from flightlake.sources.tables import TableRegistry

log = logging.getLogger(__name__)
POLL = "60 seconds"
LATENESS = "10 minutes"


def start(
    stream: DataFrame,
    checkpoint: str,
    each: Callable[[DataFrame, int], None] | None = None,
    path: str | None = None,
    mode: str = "append",
    replay: bool = False,
) -> StreamingQuery:
    """Start a query into a batch function or a Parquet folder.

    ``replay`` works through what is there and stops; otherwise a micro-batch
    starts every minute. An empty micro-batch writes nothing.
    """
    writer = stream.writeStream.option("checkpointLocation", checkpoint).outputMode(mode)
    writer = writer.trigger(availableNow=True) if replay else writer.trigger(processingTime=POLL)
    if each is not None:
        return writer.foreachBatch(each).start()
    return writer.format("parquet").option("path", path).start()


def dual_write(write_table: Callable[[DataFrame, int], DataFrame | None], write_topic: Callable[[DataFrame], None], accepted_only: bool = False):
    """Batch function: table first, then topic. A topic failure is logged and does not fail the batch.

    ``write_table`` returns the accepted rows. All rows go to the topic unless ``accepted_only``.
    """

    def each(batch: DataFrame, number: int) -> None:
        if batch.isEmpty():
            return
        batch.persist()
        try:
            accepted = write_table(batch, number)
            try:
                write_topic(accepted if accepted_only and accepted is not None else batch)
            except Exception as e:
                log.warning("topic write of batch %s failed: %s", number, e)
        finally:
            batch.unpersist()

    return each


def position_snapshot(path: str) -> Callable[[DataFrame, int], None]:
    """Batch function for ``latest_states``: the newest message of every aircraft so far.

    The snapshot rotates over three folders: the one a retry starts from is never the one being
    written, and its size is that of the fleet, however long the job runs.
    """

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        now = batch.withColumn("number", F.lit(number).cast("bigint"))
        if number:
            before = spark.read.schema(now.schema).parquet(f"{path}/slot={(number - 1) % 3}").withColumn("number", F.lit(number).cast("bigint"))
            now = now.unionByName(before.join(batch.select("icao24"), "icao24", "left_anti"))
        now.write.mode("overwrite").parquet(f"{path}/slot={number % 3}")

    return each


def without_repeats(events: DataFrame, time: str = "event_timestamp", lateness: str = LATENESS) -> DataFrame:
    """Drop re-delivered events of the same natural key. State is kept for ``lateness`` of event time."""
    return events.withWatermark(time, lateness).dropDuplicatesWithinWatermark(list(schema.EVENT_KEY))


def latest_states(messages: DataFrame, time: str = "event_timestamp", tie: str | None = None) -> DataFrame:
    """Latest message of each aircraft as a running aggregate; state grows with the aircraft only."""
    rest = [c for c in messages.columns if c != "icao24"]
    order = F.struct(time, tie) if tie else F.struct(time)
    return messages.filter(F.col("icao24") != "").groupBy("icao24").agg(F.max_by(F.struct(*rest), order).alias("last"))


def read_cache(spark: SparkSession, path: str, source: str = "stream") -> DataFrame:
    """Current airborne positions out of the newest snapshot of ``position_snapshot``.

    A last message on the ground removes the aircraft.
    """
    slots = spark.read.parquet(f"{path}/slot=*")
    number = slots.agg(F.max("number")).first()[0]
    newest = slots.filter(F.col("number") == number).filter(~F.col("last.on_ground"))
    return newest.select(
        "icao24", shown_callsign("last.callsign", "icao24").alias("callsign"), "last.latitude", "last.longitude", "last.altitude_ft",
        "last.event_type", F.col("last.event_timestamp").alias("updated_at"), F.lit(source).alias("source"),
    )


def monitor(events: DataFrame, checkpoint: str) -> StreamingQuery:
    """Print one line per event."""
    return (
        events.select(monitor_line().alias("line")).writeStream.format("console").option("truncate", False)
        .option("checkpointLocation", checkpoint).start()
    )


def load_flight_lists(
    spark: SparkSession, source: str, target: str, checkpoint: str, airports: DataFrame, run_ts: str, files_per_trigger: int | None = None
) -> DataFrame:
    """Restartable history load into ``hist_flight_events`` below ``target``. Returns the per-file summary.

    Every file is read once: the checkpoint is the ledger of loaded files. Columns are bound by
    name. A list is parsed once, spread over the executors, and feeds events and summary. Events with a known
    key are skipped, so a retried micro-batch adds nothing.
    """
    at = F.lit(run_ts).cast("timestamp")
    registry = TableRegistry(spark, target)

    def each(batch: DataFrame, number: int) -> None:
        with scratch(spark):
            # A compressed file is one read task; what follows is not.
            typed = cut_lineage(typed_flights(with_aircraft(named_rows(batch))).hint("rebalance"))
            registry.append_new("hist_flight_events", flights_to_events(typed, airports, at), schema.EVENT_KEY)
            load_summary(typed).write.mode("overwrite").parquet(f"{target}/summary/batch={number}")

    query = start(flight_list_stream(spark, source, files_per_trigger), checkpoint, each=each, replay=True)
    query.awaitTermination()
    return spark.read.option("basePath", f"{target}/summary").parquet(f"{target}/summary/batch=*")
