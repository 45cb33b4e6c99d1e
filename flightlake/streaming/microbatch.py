"""Tracking in micro-batches with the batch operators.

Each micro-batch of positions runs the same plans as a batch: events and stays in
time chunks, on executors only. What a later batch needs is one row per aircraft: the
last position, the last accepted event and the stay still open. That row joins the next
micro-batch as its earliest position. A busy aircraft is split as in a batch, so a micro-batch may be
of any size. Results are numbered by micro-batch and overwritten on a retry. The state rotates over
three folders, so the one a retry starts from is never the one being written, and old states do not pile up.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.operators.crossings import framed_borders, located_pings, session_marks, stay_end, tracked_marks
from flightlake.operators.events import with_event_type
from flightlake.operators.geo import TerritoryCells
from flightlake.plans.sequence import HOUR, SPARSE, density
from flightlake.session import cut_lineage, scratch

_EVENT = "struct<at:timestamp,kind:string>"
_STAY = (
    "struct<country_id:int,territory_type:string,territory_id:int,territory_name:string,entered_at:timestamp,"
    f"callsign:string,role:string,event:{_EVENT}>"
)
_SAME = ("country_id", "territory_type", "territory_id")
_STATE = f"icao24 string, timestamp timestamp, tie bigint, on_ground boolean, vertical_rate_fpm double, carried_event {_EVENT}, stay {_STAY}"


@dataclass(frozen=True)
class Tracking:
    """Where a tracking job keeps its numbered results, and what it tracks with."""

    base: str
    index: TerritoryCells
    aircraft: DataFrame | None = None
    tie: str | None = None
    width: int = HOUR

    def each(self, batch: DataFrame, number: int) -> None:
        """Batch function for ``jobs.start``."""
        spark = batch.sparkSession
        before = spark.read.schema(_STATE).parquet(self._state(number - 1)) if number else spark.createDataFrame([], _STATE)
        with scratch(spark):
            events, closed, state, late = self.step(batch, before)
            outputs = [
                (events, f"{self.base}/events/batch={number}"), (closed, f"{self.base}/crossings/batch={number}"), (late, f"{self.base}/late/batch={number}"),
                (state.withColumn("number", F.lit(number).cast("bigint")), self._state(number)),
            ]
            # None reads another, so their small jobs run side by side; the first failure ends the micro-batch, and a retry replaces all four.
            write = inheritable_thread_target(spark)(lambda output: output[0].write.mode("overwrite").parquet(output[1]))
            with ThreadPoolExecutor(len(outputs)) as pool:
                list(pool.map(write, outputs))

    def _state(self, number: int) -> str:
        return f"{self.base}/state/slot={number % 3}"

    def step(self, batch: DataFrame, before: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
        """Events and ended stays of a micro-batch, the state after it, and the positions that came too late.

        Those not newer than the state of their aircraft are late: they change nothing here and go to an
        output of their own, from which the batch operators can replay their days.
        """
        order = ("timestamp", "tie")
        tied = batch.withColumn("tie", (F.col(self.tie) if self.tie else F.lit(0)).cast("bigint"))
        known = before.select("icao24", F.struct("timestamp", "tie").alias("_seen"))
        compared = tied.join(known, "icao24", "left").withColumn("_late", F.coalesce(F.struct("timestamp", "tie") <= F.col("_seen"), F.lit(False)))
        fresh, late = (compared.filter(c).drop("_seen", "_late") for c in (~F.col("_late"), F.col("_late")))
        located = located_pings(fresh, self.index).withColumns({
            "carried": F.lit(False), "carried_event": F.lit(None).cast(_EVENT), "stay": F.lit(None).cast(_STAY),
        })
        place = [F.col(f"stay.{c}").alias(c) for c in (*_SAME, "territory_name")]
        resumed = before.select("*", *place, F.lit(True).alias("carried"))
        rows = located.unionByName(resumed, allowMissingColumns=True)
        calm = density(tied, ["icao24"], order, self.width)
        seen = cut_lineage(with_event_type(rows, order, carry=_SAME, width=self.width, calm=calm, last="_last"))

        marks = session_marks(seen, order, self.aircraft, calm)
        framed = framed_borders(tracked_marks(marks, order, self.width, calm), order, self.width, calm, staged=calm != SPARSE)
        opened = F.when(F.col("before").isNull() | F.col("before.event_type").eqNullSafe("LANDED"), "START").otherwise("ROUTE")
        kept = lambda field, otherwise: F.when(F.col("carried"), F.col(f"stay.{field}")).otherwise(otherwise)
        stays = cut_lineage(framed.filter(F.col("territory_id").isNotNull()).select(
            "icao24", kept("callsign", F.col("callsign")).alias("callsign"),
            kept("event", F.col("last_event")).alias("event"), "country_id", "territory_type", "territory_id", "territory_name",
            kept("role", opened).alias("crossing_role"), *stay_end(kept("entered_at", F.col("timestamp")), "timestamp"),
        ))

        events = seen.filter(F.col("event_type").isNotNull()).drop("_last", "before", "carried", "carried_event", "stay", *_SAME, "territory_name", "country_name")
        last = seen.filter("_last").select("icao24", *order, "on_ground", "vertical_rate_fpm")
        heard = marks.filter(F.col("_event").isNotNull()).groupBy("icao24").agg(F.max_by("_event", F.struct(*order)).alias("carried_event"))
        open_ = stays.filter(F.col("exited_at").isNull()).select("icao24", F.struct(
            *_SAME, "territory_name", "entered_at", "callsign", F.col("crossing_role").alias("role"), "event",
        ).alias("stay"))
        state = last.join(heard, "icao24", "left").join(open_, "icao24", "left")
        return events, _crossing(stays.filter(F.col("exited_at").isNotNull())), state, late.select(*batch.columns)

    def late(self, spark: SparkSession) -> DataFrame:
        """Positions that came too late, with their micro-batch."""
        return spark.read.option("basePath", f"{self.base}/late").parquet(f"{self.base}/late/batch=*")

    def events(self, spark: SparkSession) -> DataFrame:
        return spark.read.option("basePath", f"{self.base}/events").parquet(f"{self.base}/events/batch=*").drop("batch")

    def crossings(self, spark: SparkSession) -> DataFrame:
        """Ended stays, and those the newest state still has open."""
        ended = spark.read.option("basePath", f"{self.base}/crossings").parquet(f"{self.base}/crossings/batch=*").drop("batch")
        states = spark.read.schema(f"{_STATE}, number bigint").parquet(f"{self.base}/state/slot=*")
        newest = states.agg(F.max("number")).first()[0]
        still = states.filter(F.col("number") == newest).filter(F.col("stay").isNotNull()).select("icao24", "stay.*").withColumns({
            "crossing_role": F.col("role"), "flight_status": F.lit("IN_PROGRESS"), "entered_date": F.to_date("entered_at"),
            "exited_at": F.lit(None).cast("timestamp"), "exited_date": F.lit(None).cast("date"), "duration_minutes": F.lit(None).cast("decimal(8,2)"),
        })
        return ended.unionByName(_crossing(still))


def _crossing(stays: DataFrame) -> DataFrame:
    return stays.select(
        "icao24", "callsign", F.col("event.at").alias("event_timestamp"), F.col("event.kind").alias("event_type"),
        "territory_type", "territory_id", "territory_name", "crossing_role", "flight_status",
        "entered_at", "entered_date", "exited_at", "exited_date", "duration_minutes",
    )
