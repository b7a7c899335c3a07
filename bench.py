"""Headline timings; prints one JSON line.

``BENCH_SF_DIR`` names the test-data folder and ``BENCH_CPUS`` the local cores.
``warehouse_build`` derives every stored table from the given tables, cold.
Each other figure is the better of two runs of the operator over stored
tables, from planning to the last row.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from linespan.session import build_session  # noqa: E402
from verification.queries import spark_queries  # noqa: E402
from verification.world import World  # noqa: E402

HEADLINE = (
    "scheduled_stop_event", "trip_source", "scd2_route", "scd2_stop", "service_calendar_dates",
    "fact_route_service_day", "fact_stop_service_day", "publication_changes", "dq_stop_times",
    "route_summary", "stop_summary", "network_daily_summary", "route_service_intelligence",
    "stop_service_intelligence", "stop_location_changes", "platform_summary", "dashboard_kpis",
    "q_overview", "q_network_trends", "q_modes", "q_routes", "q_map_stops", "q_pipelines", "q_data_quality",
)
RUNS = 2


def build(world: World) -> None:
    """Derive and store every warehouse table and the views other views read."""
    latest = world.latest
    for table in ("stop_days", "route_days", "shapes"):
        getattr(latest, table)
    _ = world.warehouse.changes, world.runs, world.quality


def run_to_end(rows) -> None:
    rows.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "linespan-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
        extra={"spark.ui.enabled": "false", "spark.driver.memory": "16g",
               "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings: dict[str, float] = {}
    started = time.perf_counter()
    build(World(spark, folder))
    timings["warehouse_build"] = time.perf_counter() - started
    queries = spark_queries()
    for name in HEADLINE:
        best = None
        for _ in range(RUNS):
            started = time.perf_counter()
            run_to_end(queries[name](spark, folder))
            taken = time.perf_counter() - started
            best = taken if best is None else min(best, taken)
        timings[name] = best
    rounded = {name: round(seconds, 3) for name, seconds in timings.items()}
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": rounded,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
