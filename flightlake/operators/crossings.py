"""Territory crossings: live sessions from positions, estimated stays along routes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightlake import schema
from flightlake.functions import measure
from flightlake.operators.events import has_position, with_event_type, with_last_event
from flightlake.operators.geo import TerritoryCells, containing, with_cells, with_territory
from flightlake.plans.sequence import CROWDED, HOUR, SPARSE, density, with_neighbours
from flightlake.session import cut_lineage

# Fixed value: segments a route is cut into.
ROUTE_SEGMENTS = 10

_SAME = ("country_id", "territory_type", "territory_id")


def _differs(other: str) -> Column:
    """Territory of this row is not that of the neighbour struct ``other``."""
    return ~F.col("territory_id").eqNullSafe(F.col(f"{other}.territory_id")) | ~F.col("territory_type").eqNullSafe(
        F.col(f"{other}.territory_type")
    ) | ~F.col("country_id").eqNullSafe(F.col(f"{other}.country_id"))


def territory_sessions(
    pings: DataFrame,
    index: TerritoryCells,
    aircraft: DataFrame | None = None,
    order: tuple[str, ...] = ("timestamp",),
    width: int = HOUR,
    mark_end: bool = False,
    exact_zero: bool = False,
) -> DataFrame:
    """Stays of each aircraft over territories, from its positions.

    * Tracking starts at the aircraft's first accepted event. ``aircraft``
      limits acceptance to known aircraft.
    * A stay ends when another territory is entered; water in between belongs
      to the stay before it. Landing completes the open stay.
    * Roles: START when nothing was open, else ROUTE. ``mark_end`` labels the
      stay open at landing END, unless it is the START of its leg.
    * A stay still open has no exit and status IN_PROGRESS.

    Positions are located first (row-local), then one pass over each aircraft
    (in time chunks, where one has many) finds events and territory changes together. Only rows that
    can matter later go on: events, and positions whose territory differs from the
    position before. They (unless every aircraft has few rows) and the later stay borders are written to the shared
    folder, so neither a lost executor nor a later step repeats the scan.
    """
    calm = density(pings, ["icao24"], order, width)
    seen = with_event_type(located_pings(pings, index, exact_zero), order, carry=_SAME, width=width, calm=calm)
    tracked = tracked_marks(session_marks(seen, order, aircraft, calm), order, width, calm)
    framed = framed_borders(tracked, order, width, calm)
    first, landed = F.col("before").isNull() | F.col("before.event_type").eqNullSafe("LANDED"), F.col("after.event_type").eqNullSafe("LANDED")
    role = F.when(first, "START")
    if mark_end:
        role = role.when(landed, "END")
    return framed.filter(F.col("territory_id").isNotNull()).select(
        "icao24", "callsign",
        F.col("last_event.at").alias("event_timestamp"), F.col("last_event.kind").alias("event_type"),
        "territory_type", "territory_id", "territory_name",
        role.otherwise("ROUTE").alias("crossing_role"),
        *stay_end(F.col(order[0]), order[0]),
    )


def located_pings(pings: DataFrame, index: TerritoryCells, exact_zero: bool = False) -> DataFrame:
    """Positions with their territory; none on the ground or without coordinates."""
    flying = ~F.col("on_ground") & has_position(exact=exact_zero)
    placed = pings.withColumn("_x", F.when(flying, F.col("longitude"))).withColumn("_y", F.when(flying, F.col("latitude")))
    return with_territory(placed, index, "_x", "_y").drop("_x", "_y")


def session_marks(seen: DataFrame, order: tuple[str, ...], aircraft: DataFrame | None, calm: int = CROWDED) -> DataFrame:
    """Rows that can matter to sessions, each with its accepted event ``_event``; staged, unless every aircraft has few rows and one shuffle serves all steps.

    A ``carried`` column marks the row an earlier run ended with; it brings its own ``carried_event``.
    """
    resumed = "carried" in seen.columns
    is_event = F.col("event_type").isNotNull()
    keep = is_event | (F.col("territory_id").isNotNull() & _differs("before"))
    event = F.when(is_event, F.struct(F.col(order[0]).alias("at"), F.col("event_type").alias("kind")))
    if resumed:
        keep, event = keep | F.col("carried"), F.coalesce(event, F.col("carried_event"))
    marks = seen.filter(keep).drop("before")
    if aircraft is not None:
        marks = marks.join(aircraft.select("icao24"), "icao24", "left_semi")
    return (marks if calm == SPARSE else cut_lineage(marks)).withColumn("_event", event)


def tracked_marks(marks: DataFrame, order: tuple[str, ...], width: int, calm: int = CROWDED) -> DataFrame:
    """Marks with the last accepted event at or before each; none before the first event of an aircraft."""
    return with_last_event(marks, order, "_event", width, calm=calm).drop("_event").filter(F.col("last_event").isNotNull())


def framed_borders(tracked: DataFrame, order: tuple[str, ...], width: int, calm: int = CROWDED, staged: bool = True) -> DataFrame:
    """Landings and first rows of stays, each with the border before and after it; without ``staged`` the result is the caller's to stage."""
    landing = F.col("event_type").eqNullSafe("LANDED")
    steps = tracked.filter(F.col("territory_id").isNotNull() | landing)
    near = with_neighbours(steps, ["icao24"], order, ["event_type", *_SAME], width, "before", "after", calm).drop("after")
    border = landing | F.col("before.territory_id").isNull() | _differs("before")
    if "carried" in tracked.columns:
        border = border | F.col("carried")
    borders = near.filter(border).drop("before")
    borders = cut_lineage(borders) if staged else borders
    return with_neighbours(borders, ["icao24"], order, ["event_type", order[0]], width, "before", "after", calm)


def stay_end(entered: Column, ts: str) -> list[Column]:
    """Entry, exit, status and minutes of a stay from the border ``after`` it."""
    exit_ = F.col(f"after.{ts}")
    landed = F.col("after.event_type").eqNullSafe("LANDED")
    return [
        F.when(landed, "COMPLETED").otherwise("IN_PROGRESS").alias("flight_status"),
        entered.alias("entered_at"), F.to_date(entered).alias("entered_date"),
        exit_.alias("exited_at"), F.to_date(exit_).alias("exited_date"),
        measure.stay_minutes(entered, exit_).alias("duration_minutes"),
    ]


def crossing_rows(sessions: DataFrame, run_ts: Column) -> DataFrame:
    """Sessions in the shape of the daily crossing table, linked to their event by natural key."""
    out = (
        sessions.withColumn("flight_event_id", F.xxhash64("icao24", "event_timestamp", "event_type"))
        .withColumn("crossing_id", F.xxhash64("icao24", "entered_at", "territory_id"))
        .withColumn("created_at", run_ts)
    )
    return out.select(*[F.col(f.name).try_cast(f.dataType) for f in schema.DAILY_CROSSING])


def route_samples(flights: DataFrame, segments: int = ROUTE_SEGMENTS) -> DataFrame:
    """Evenly spaced points on the straight line between both ends, with their step number."""
    f = F.col("step") / F.lit(segments)
    between = lambda a, b: F.col(a) + f * (F.col(b) - F.col(a))
    return (
        flights.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(segments))))
        .withColumn("fraction", f)
        .withColumn("latitude", between("lat1", "lat2"))
        .withColumn("longitude", between("lon1", "lon2"))
    )


def _stays(flights: DataFrame, index: TerritoryCells, key: str, segments: int, carry: list[str]) -> DataFrame:
    """Stays along each flight with the ``carry`` columns of the flight.

    A flight has a fixed number of samples, which one task makes and folds back into
    one small array before the shuffle. Water is skipped, runs of one country merge, a run
    ends where the next begins, and the last ends at the last step.
    """
    flight = F.struct(*[F.col(c) for c in carry])
    points = route_samples(flights.select(key, "lat1", "lon1", "lat2", "lon2", flight.alias("flight")), segments)
    country = containing(F.col("entries"), "COUNTRY", F.col("longitude"), F.col("latitude"))
    visits = (
        with_cells(points, index, "longitude", "latitude")
        .select(key, "flight", "step", country.alias("country"))
        .filter(F.col("country").isNotNull())
        .groupBy(key)
        .agg(F.first("flight").alias("flight"), F.array_sort(F.collect_list(F.struct("step", "country"))).alias("seen"))
    )
    heads = F.filter("seen", lambda s, i: (i == 0) | (s["country"]["id"] != F.get(F.col("seen"), i - 1)["country"]["id"]))
    placed = visits.select(key, "flight", heads.alias("heads")).select("*", F.posexplode("heads").alias("place", "head"))
    return placed.select(
        key, "flight.*",
        F.col("head.country.id").alias("territory_id"),
        F.col("head.country.name").alias("territory_name"),
        "place", F.size("heads").alias("countries"),
        F.col("head.step").alias("entry_step"),
        F.coalesce(F.get(F.col("heads"), F.col("place") + 1)["step"], F.lit(segments)).alias("exit_step"),
    )


def route_stays(flights: DataFrame, index: TerritoryCells, flight_key: str = "departed_event_id", segments: int = ROUTE_SEGMENTS) -> DataFrame:
    """Countries along each flight with entry and exit steps."""
    return _stays(flights, index, flight_key, segments, ["icao24"]).drop("icao24")


def route_crossings(flights: DataFrame, index: TerritoryCells, run_ts: Column, segments: int = ROUTE_SEGMENTS) -> DataFrame:
    """History crossings estimated along each flight: roles, times in proportion, all completed.

    A flight over one country has only a START. Flights of no or negative
    length keep their end times and have no minutes.
    """
    key = "departed_event_id"
    stays = _stays(flights, index, key, segments, ["icao24", "callsign", "landed_event_id", "firstseen", "lastseen"])
    last = F.col("place") == F.col("countries") - 1
    role = F.when(F.col("place") == 0, "START").when(last, "END").otherwise("ROUTE")
    whole = measure.micros_between("firstseen", "lastseen")
    moved = whole > 0
    at = lambda step: measure.moment_between("firstseen", "lastseen", F.col(step), segments)
    steps = (F.col("exit_step") - F.col("entry_step")).cast("decimal(4,0)")
    out = (
        stays.withColumns({
            "crossing_role": role,
            "territory_type": F.lit("COUNTRY"),
            "flight_status": F.lit("COMPLETED"),
            "entered_at": F.when(moved, at("entry_step")).otherwise(F.col("firstseen")),
            "exited_at": F.when(moved, at("exit_step")).otherwise(F.col("lastseen")),
            "duration_minutes": F.when(moved, measure.ratio(steps * whole, F.lit(60_000_000 * segments), 2)),
            "source": F.lit(schema.HISTORY_SOURCE),
            "inserted_at": run_ts, "updated_at": run_ts, "created_at": run_ts, "batch_date": F.to_date(run_ts),
        })
        .withColumns({
            "flight_event_id": F.when(F.col("crossing_role") == "END", F.col("landed_event_id")).otherwise(F.col(key)),
            "entered_date": F.to_date("entered_at"),
            "exited_date": F.to_date("exited_at"),
            "crossing_id": F.xxhash64("icao24", "entered_at", "territory_id"),
        })
    )
    return out.select(*[F.col(f.name).try_cast(f.dataType) for f in schema.HIST_CROSSING])


def complete_flights(crossings: DataFrame, order: str = "entered_at") -> DataFrame:
    """Mark every crossing of a landed leg COMPLETED, not only its last one.

    Applied to one day of crossings; legs are told apart by their landing.
    """
    later = Window.partitionBy("icao24", "entered_date").orderBy(order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    done_at = F.min(F.when(F.col("flight_status") == "COMPLETED", F.col(order))).over(later)
    next_start = F.min(F.when(F.col("crossing_role") == "START", F.col(order))).over(
        later.rowsBetween(1, Window.unboundedFollowing)
    )
    leg_done = done_at.isNotNull() & (next_start.isNull() | (done_at < next_start))
    return crossings.withColumn("flight_status", F.when(leg_done, "COMPLETED").otherwise(F.col("flight_status")))


def close_carried(hist: DataFrame, today: DataFrame, on: tuple[str, ...] = ("icao24",)) -> DataFrame:
    """Open crossings of history closed where their aircraft left the territory or landed since.

    ``today`` holds per aircraft, or whatever key ``on`` names, the moment the carried crossing ended, as
    ``(*on, closed_at, landed)``. Matching is by aircraft and time, never by a reused id.
    Crossings closed before, and those entered later, stay as they are.
    """
    open_ = (F.col("flight_status") == "IN_PROGRESS") & F.col("exited_at").isNull()
    closing = open_ & F.col("closed_at").isNotNull() & (F.col("closed_at") >= F.col("entered_at"))
    out = hist.join(today.select(*on, "closed_at", "landed"), list(on), "left")
    return (
        out.withColumn("_closing", F.coalesce(closing, F.lit(False)))
        .withColumn("exited_at", F.when(F.col("_closing"), F.col("closed_at")).otherwise(F.col("exited_at")))
        .withColumn("exited_date", F.when(F.col("_closing"), F.to_date("closed_at")).otherwise(F.col("exited_date")))
        .withColumn("duration_minutes", F.when(F.col("_closing"), measure.stay_minutes("entered_at", "exited_at")).otherwise(F.col("duration_minutes")))
        .withColumn("flight_status", F.when(F.col("_closing") & F.col("landed"), "COMPLETED").otherwise(F.col("flight_status")))
        .select(*hist.columns)
    )
