"""The route mart's day weights: how they are planned, and what they are where aircraft or dates are unknown."""

import datetime as dt

from flightlake.operators import marts

DAY = dt.date(2021, 5, 4)
SCHEMA = "icao24 string, event_type string, event_timestamp timestamp, event_date date, origin_iata string, destination_iata string, source string"


def _events(spark):
    at = lambda h: dt.datetime(2021, 5, 4, h)
    row = lambda a, kind, h, day=DAY, o="A", d="B", source="x": (a, kind, at(h), day, o, d, source)
    return spark.createDataFrame([
        row("a", "DEPARTED", 1), row("a", "DEPARTED", 3), row("a", "DEPARTED", 4, o="C"), row("a", "LANDED", 6), row("a", "LANDED", 9),
        row("a", "LANDED", 7, source="y"), row("b", "DEPARTED", 2), row("b", "DEPARTED", 2, o=None), row("", "LANDED", 8),
        row(None, "DEPARTED", 1), row(None, "LANDED", 2), row("b", "DEPARTED", 5, day=None), row(None, "LANDED", 5, day=None),
    ], SCHEMA)


def _rows(days):
    cols = ("icao24", "event_date", "origin_iata", "flights", "timed", "micros_min", "micros_max")
    return sorted(((*(r[c] for c in cols[:5]), None if r["micros_sum"] is None else int(r["micros_sum"]), r["micros_min"], r["micros_max"]) for r in days.collect()), key=str)


def test_days_weigh_departures_by_the_landings_of_their_day(spark):
    h = 3_600_000_000
    assert _rows(marts.departures_with_landings(_events(spark), "x")) == sorted([
        ("a", DAY, "A", 4, 4, 22 * h, 3 * h, 8 * h), ("a", DAY, "C", 2, 2, 7 * h, 2 * h, 5 * h), ("b", DAY, "A", 1, 0, None, None, None),
        (None, DAY, "A", 1, 1, h, h, h), ("b", None, "A", 1, 0, None, None, None),
    ], key=str)


def test_mart_shuffles_each_side_once_before_they_meet(spark):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        departures, landings = marts._sides(_events(spark), "x")
        singles = marts._weighed(marts._single(departures), landings)
        plan = singles._jdf.queryExecution().executedPlan().toString()
        folded = marts.departures_with_landings(_events(spark), "x")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert plan.count("Exchange hashpartitioning") == 2 and "Window" not in plan + folded
