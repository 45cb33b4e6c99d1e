"""Every registered query against its checking SQL, on the small tables and on skewed ones."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from flightlake.queries import ORACLES, QUERIES
from tools import check

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are not here")
SKEW_PRONE = [
    "detect_events", "last_event_fill", "crossings_batch", "flight_pairs", "never_landed", "route_mart", "territory_mart", "latest_position",
    "known_aircraft_semi", "crossings_nested", "trail_stats", "enrich_update", "rollup_crossings", "point_state_priority", "stream_crossings",
]


@pytest.fixture(scope="module")
def small():
    return check.open_tables(SMALL)


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """The small tables with a third of all events on one aircraft."""
    folder = tmp_path_factory.mktemp("skewed")
    for t in check.TABLES:
        if t != "events":
            shutil.copy(f"{SMALL}/{t}.parquet", folder / f"{t}.parquet")
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    hot = F.when(F.col("event_id") % 3 == 0, F.lit(7)).otherwise(F.col("user_id")).cast("long")
    events.withColumn("user_id", hot).repartition(3).write.parquet(str(folder / "events.parquet"))
    return str(folder), check.open_tables(str(folder))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, name):
    out = check.compare(name, spark, small, SMALL)
    assert out.ok, out.detail


@pytest.mark.parametrize("name", SKEW_PRONE)
def test_query_on_a_hot_key(spark, skewed, name):
    folder, db = skewed
    out = check.compare(name, spark, db, folder)
    assert out.ok, out.detail


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(spark_entry.queries()) and set(ORACLES) <= set(spark_entry.oracle_sql())


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["point_country", "nearest_airport", "crossings_batch", "route_crossings", "detect_events", "rollup_events", "route_mart"])
def test_plans_have_no_nested_loops(spark, name):
    plan = spark_entry.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_scans_read_only_what_they_need(spark):
    plan = spark_entry.queries()["yearly_trend"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plan
    plan = spark_entry.queries()["daily_stats"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "value" not in plan.split("ReadSchema")[1].split("\n")[0]
