"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

os.environ.setdefault("PYSPARK_SUBMIT_ARGS", "--driver-memory 12g --conf spark.ui.showConsoleProgress=false pyspark-shell")
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from flightlake import session  # noqa: E402
from flightlake.queries import QUERIES  # noqa: E402

HEADLINE = [
    "route_mart", "route_mart_scale", "territory_mart", "territory_mart_scale", "yearly_trend",
    "detect_events", "point_state_priority", "nearest_airport", "crossings_batch", "flight_pairs", "route_crossings",
    "rollup_events", "rollup_crossings", "reconcile_coverage", "enrich_update",
    "latest_position", "daily_stats", "crossings_nested", "trail_stats",
    "flight_to_events", "parse_positions", "messages_round_trip", "prefix_country",
    "features_basic", "congestion", "delay_causes", "stream_crossings",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    out = sys.stdout
    sys.stdout = sys.stderr
    work = tempfile.mkdtemp(prefix="flightlake-bench-")
    spark = session.build("bench", f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8, work)
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("event_type").count().collect()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    result = {"metric": "headline_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}
    print(json.dumps(result), file=out, flush=True)


if __name__ == "__main__":
    main()
