from __future__ import annotations

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry_points
from verification.compare import compare, connect
from verification.queries import checking_sql, spark_queries

ROOT = Path(entry_points.__file__).resolve().parent
RUNS = spark_queries()
CHECKS = checking_sql()

# The operator inventory: every name must be registered.
INVENTORY = (
    "feed_scan stage_lineage malformed_rows stage_replace snapshot_register snapshot_gate "
    "snapshot_status run_audit profile_structure profile_columns incremental_intake "
    "serving_export export_manifest date_bounds dim_date operator_source scd2_operator "
    "route_source scd2_route stop_source scd2_stop service_source dim_service "
    "service_calendar_dates service_added_dates bridge_sync version_asof trip_source dim_trip "
    "available_shapes shape_point gtfs_time_seconds scheduled_stop_event dq_core dq_network "
    "dq_calendar dq_trips dq_shapes dq_stop_times dq_daily_facts dq_changes dq_model "
    "reporting_window participating_service trip_event_metric trip_stop_metric "
    "service_route_metric service_route_stop service_stop_metric service_stop_route "
    "fact_route_service_day fact_stop_service_day fact_insert_if_absent previous_snapshot "
    "entity_state publication_changes publication_change_counts publication_bootstrap "
    "fact_publication_change latest_snapshot platform_summary route_service_daily route_summary "
    "stop_summary publication_changes_view publication_change_summary recent_pipeline_runs "
    "data_quality_results network_daily_summary operator_summary transport_mode_summary "
    "route_service_intelligence stop_service_intelligence location_summary "
    "stop_location_changes pipeline_health dashboard_kpis q_overview q_network_trends q_modes "
    "q_routes q_stops q_map_stops q_operators q_locations q_publication_changes q_pipelines "
    "q_data_quality q_accessibility_share"
).split()


@pytest.fixture(scope="module")
def connection(small):
    return connect(small)


def test_inventory_is_registered():
    assert sorted(INVENTORY) == sorted(RUNS)
    assert set(CHECKS) == set(RUNS)
    assert set(RUNS) <= set(entry_points.queries())
    assert set(CHECKS) <= set(entry_points.oracle_sql())


def test_entry_works_without_the_corpus_operators(tmp_path):
    """A copy without their folders imports and registers the rest."""
    for name in ("linespan", "verification"):
        shutil.copytree(ROOT / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True,
        env={**os.environ, "PYTHONPATH": ""},
    )
    assert done.stdout.split() == [str(len(RUNS)), str(len(CHECKS))], done.stderr


def test_flagship_runs(spark):
    rows = entry_points.entry(spark)
    assert {"route_key", "full_date", "scheduled_trip_count"} <= set(rows.columns)
    assert rows.count() > 0


@pytest.mark.parametrize("name", sorted(RUNS))
def test_query_equals_checking_sql(spark, connection, small, name):
    ok, note = compare(spark, connection, small, name, RUNS[name], CHECKS.get(name))
    assert ok, note
