"""Registered queries: Spark plan and checking SQL per operator."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linespan.functions.columns import call_seconds
from linespan.operators import calendar, changes, daily, history, schedule
from linespan.plans import dashboard, views
from linespan.session import run_folder
from linespan.sources.store import Store
from verification.oracle import STAGE_LIST, complete
from verification.projection import AS_OF, LATEST_SNAPSHOT, OLDER_SNAPSHOT
from verification.world import World, plain


@dataclass(frozen=True)
class Query:
    run: Callable[[World], DataFrame]
    check: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, check: str | None = None):
    """Register a function of the world under an operator name."""

    def add(run: Callable[[World], DataFrame]):
        REGISTRY[name] = Query(run, check)
        return run

    return add


# Warehouse build ---------------------------------------------------------

query(
    "date_bounds",
    "SELECT MIN(d) AS minimum_date, MAX(d) AS maximum_date FROM dates2 WHERE d IS NOT NULL",
)(lambda w: w.latest.date_bounds())

query("dim_date", "SELECT * FROM dim_date")(lambda w: w.older.dim_date.unionByName(w.latest.new_dates()))

query("operator_source", "SELECT * FROM op_src2")(lambda w: w.latest.operator_source())
query("scd2_operator", "SELECT * FROM dim_operator")(lambda w: w.latest.merged_operators())
query("route_source", "SELECT * FROM rt_src2")(lambda w: w.latest.route_source())
query("scd2_route", "SELECT * FROM dim_route")(lambda w: w.latest.merged_routes())
query("stop_source", "SELECT * FROM st_src2")(lambda w: w.latest.stop_source())
query("scd2_stop", "SELECT * FROM dim_stop")(lambda w: w.latest.merged_stops())
query("service_source", "SELECT * FROM sv_src2")(lambda w: w.latest.service_source())
query("dim_service", "SELECT * FROM dim_service")(lambda w: w.latest.merged_services())
query("service_calendar_dates", "SELECT * FROM cal2")(
    lambda w: calendar.service_calendar_dates(
        w.latest.services, w.latest.exceptions(), w.latest.dim_date
    )
)
query("service_added_dates", "SELECT * FROM add2")(
    lambda w: calendar.service_added_dates(
        w.latest.services, w.latest.exceptions(), w.latest.dim_date
    )
)


@query(
    "bridge_sync",
    """
    SELECT COALESCE(o.service_id, n.service_id) AS service_id,
           COALESCE(o.date_key, n.date_key) AS date_key,
           o.activation_source AS stored_source, n.activation_source AS desired_source,
           CASE WHEN o.service_id IS NULL THEN 'INSERT' WHEN n.service_id IS NULL THEN 'DELETE'
                WHEN o.activation_source <> n.activation_source THEN 'REPLACE' ELSE 'KEEP' END
               AS sync_action
    FROM bridge1 o FULL OUTER JOIN bridge2 n
      ON n.service_id = o.service_id AND n.date_key = o.date_key""",
)
def bridge_sync(w: World) -> DataFrame:
    """Stored rows are the older bridge relabelled as the latest publication's."""
    stored = w.older.bridge.select(
        F.lit(LATEST_SNAPSHOT).cast("bigint").alias("snapshot_key"),
        F.concat(F.lit(f"{LATEST_SNAPSHOT}:"), "service_id").alias("service_key"),
        "date_key",
        "activation_source",
    )
    return calendar.bridge_sync(stored, w.latest.bridge).select(
        F.substring_index("service_key", ":", -1).alias("service_id"),
        "date_key", "stored_source", "desired_source", "sync_action",
    )


@query(
    "version_asof",
    """
    SELECT 'ROUTE' AS entity_type, 1 AS at_snapshot, route_key AS version_key FROM route_at1
    UNION ALL SELECT 'ROUTE', 2, route_key FROM route_at2
    UNION ALL SELECT 'STOP', 1, stop_key FROM stop_at1
    UNION ALL SELECT 'STOP', 2, stop_key FROM stop_at2""",
)
def version_asof(w: World) -> DataFrame:
    def at(dimension: DataFrame, kind: str, key: str, snapshot_key: int) -> DataFrame:
        return history.versions_by_download(dimension, w.snapshots, snapshot_key).select(
            F.lit(kind).alias("entity_type"),
            F.lit(snapshot_key).alias("at_snapshot"),
            F.col(key).alias("version_key"),
        )

    b = w.latest
    parts = [
        at(dimension, kind, key, snapshot_key)
        for dimension, kind, key in (
            (b.dim_route, "ROUTE", "route_key"), (b.dim_stop, "STOP", "stop_key"),
        )
        for snapshot_key in (OLDER_SNAPSHOT, LATEST_SNAPSHOT)
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


query("trip_source", "SELECT * FROM trips2")(lambda w: w.latest.trip_source())
query("dim_trip", "SELECT * FROM trips1 UNION ALL SELECT * FROM trips2")(
    lambda w: history.insert_if_absent(w.older.trips, w.latest.trip_source(), schedule.TRIP_KEYS)
)
query(
    "available_shapes",
    "SELECT DISTINCT TRIM(shape_id) AS shape_id FROM s2_shapes WHERE TRIM(shape_id) <> ''",
)(lambda w: calendar.available_shapes(w.latest.staged("shapes")))
query("shape_point", "SELECT * FROM shape_point")(
    lambda w: schedule.shape_point(w.latest.staged("shapes"), LATEST_SNAPSHOT)
)


@query(
    "gtfs_time_seconds",
    """
    WITH texts AS (
        SELECT trip_id, stop_sequence, 'plain' AS variant, departure_time AS t FROM p2_stop_times
        UNION ALL SELECT trip_id, stop_sequence, 'spaced', CONCAT('  ', arrival_time, ' ')
        FROM p2_stop_times
        UNION ALL SELECT trip_id, stop_sequence, 'dotted', REPLACE(departure_time, ':', '.')
        FROM p2_stop_times
        UNION ALL SELECT trip_id, stop_sequence, 'extra', CONCAT(departure_time, ':00')
        FROM p2_stop_times
        UNION ALL SELECT trip_id, stop_sequence, 'late', CONCAT('1', departure_time)
        FROM p2_stop_times
        UNION ALL SELECT trip_id, stop_sequence, 'range', CONCAT(SUBSTR(departure_time, 1, 3), '60:00')
        FROM p2_stop_times)
    SELECT trip_id, stop_sequence, variant, t AS time_text,
           CASE WHEN regexp_full_match(TRIM(t), '[0-9]+:[0-5]?[0-9]:[0-5]?[0-9]')
                THEN CAST(split_part(TRIM(t), ':', 1) AS BIGINT) * 3600
                   + CAST(split_part(TRIM(t), ':', 2) AS BIGINT) * 60
                   + CAST(split_part(TRIM(t), ':', 3) AS BIGINT) END AS seconds
    FROM texts""",
)
def gtfs_time_seconds(w: World) -> DataFrame:
    calls = w.latest.staged("stop_times")
    departure = F.col("departure_time")
    variants = {
        "plain": departure,
        "spaced": F.concat(F.lit("  "), "arrival_time", F.lit(" ")),
        "dotted": F.replace(departure, F.lit(":"), F.lit(".")),
        "extra": F.concat(departure, F.lit(":00")),
        "late": F.concat(F.lit("1"), departure),
        "range": F.concat(F.substring(departure, 1, 3), F.lit("60:00")),
    }
    texts = F.array(
        *[F.struct(F.lit(n).alias("variant"), t.alias("time_text")) for n, t in variants.items()]
    )
    return calls.select("trip_id", "stop_sequence", F.inline(texts)).withColumn(
        "seconds", call_seconds("time_text")
    )


query("scheduled_stop_event", "SELECT * FROM ev")(lambda w: w.latest.event_source())

# Daily facts and publication changes ---------------------------------------

query("reporting_window", "SELECT * FROM win")(lambda w: w.latest.window_row())
query("participating_service", "SELECT * FROM part_sv")(
    lambda w: daily.participating_service(w.latest.bridge, w.latest.window, LATEST_SNAPSHOT)
)
query("trip_event_metric", "SELECT * FROM tem")(
    lambda w: daily.trip_event_metric(w.latest.window_events())
)
query("trip_stop_metric", "SELECT * FROM tsm")(
    lambda w: daily.trip_stop_metric(w.latest.window_events())
)
query("service_route_metric", "SELECT * FROM srm")(
    lambda w: daily.service_route_metric(daily.trip_event_metric(w.latest.window_events()))
)
query("service_route_stop", "SELECT * FROM srs")(
    lambda w: daily.service_route_stop(w.latest.window_events())
)
query("service_stop_metric", "SELECT * FROM ssm")(
    lambda w: daily.service_stop_metric(daily.trip_stop_metric(w.latest.window_events()))
)
query("service_stop_route", "SELECT DISTINCT service_key, stop_key, route_key FROM srs")(
    lambda w: daily.service_stop_route(w.latest.window_events())
)

_ROUTE_FACT = """
    SELECT * EXCLUDE (span_c, headway_c), span_c / 100.0 AS service_span_minutes,
           headway_c / 100.0 AS average_headway_minutes FROM route_fact"""
_STOP_FACT = _ROUTE_FACT.replace("route_fact", "stop_fact")
query("fact_route_service_day", _ROUTE_FACT)(lambda w: w.latest.derived_route_days())
query("fact_stop_service_day", _STOP_FACT)(lambda w: w.latest.derived_stop_days())


@query(
    "fact_insert_if_absent",
    f"""
    SELECT 'route' AS fact, route_key AS entity_key, date_key, scheduled_trip_count FROM ({_ROUTE_FACT}) r
    UNION ALL SELECT 'stop', stop_key, date_key, scheduled_trip_count FROM ({_STOP_FACT}) s""",
)
def fact_insert_if_absent(w: World) -> DataFrame:
    """Both facts in batches of days: a load stopped in its second batch, completed by a second load."""
    b, store = w.latest, Store(w.spark, run_folder(w.spark, "facts"))
    facts = {
        "fact_route_service_day": (b.route_days, daily.ROUTE_DAY_KEYS),
        "fact_stop_service_day": (b.stop_days, daily.STOP_DAY_KEYS),
    }
    begun: list[str] = []

    def second_batch(batch: str) -> None:
        begun.append(batch)
        if len(begun) == 2:
            raise InterruptedError(batch)

    try:
        store.insert_batches(facts, LATEST_SNAPSHOT, before_commit=second_batch)
    except InterruptedError:
        pass
    store.insert_batches(facts, LATEST_SNAPSHOT)
    route, stop = (
        store.read(f"fact_{name}_service_day").select(
            F.lit(name).alias("fact"), F.col(f"{name}_key").alias("entity_key"), "date_key", "scheduled_trip_count"
        )
        for name in ("route", "stop")
    )
    return route.unionByName(stop)


query(
    "previous_snapshot",
    f"""
    SELECT snapshot_key, downloaded_at_utc FROM source_snapshot s
    WHERE snapshot_key < 2 AND snapshot_status = 'LOADED'
      AND (SELECT COUNT(DISTINCT pipeline_name) FROM pipeline_run r
           WHERE r.snapshot_key = s.snapshot_key AND run_status = 'SUCCEEDED'
             AND pipeline_name IN ({STAGE_LIST})) = 4
    ORDER BY downloaded_at_utc DESC, snapshot_key DESC LIMIT 1""",
)(lambda w: changes.previous_snapshot(w.snapshots, w.runs, LATEST_SNAPSHOT))


@query(
    "entity_state",
    "SELECT 1 AS at_snapshot, * FROM state1 UNION ALL SELECT 2, * FROM state2",
)
def entity_state(w: World) -> DataFrame:
    def at(key: int) -> DataFrame:
        return w.latest.entity_state(key).select(F.lit(key).alias("at_snapshot"), "*")

    return at(OLDER_SNAPSHOT).unionByName(at(LATEST_SNAPSHOT))


query("publication_changes", "SELECT * FROM diff")(lambda w: w.detected())
query(
    "publication_change_counts",
    """
    SELECT (SELECT COUNT(*) FROM state1) AS previous_entity_rows,
           (SELECT COUNT(*) FROM state2) AS current_entity_rows, COUNT(*) AS changes_detected,
           COUNT(*) FILTER (change_type = 'ADDED') AS added_changes,
           COUNT(*) FILTER (change_type = 'REMOVED') AS removed_changes,
           COUNT(*) FILTER (change_type = 'MODIFIED') AS modified_changes FROM diff""",
)(
    lambda w: changes.publication_change_counts(
        w.latest.entity_state(OLDER_SNAPSHOT), w.latest.entity_state(LATEST_SNAPSHOT), w.detected()
    )
)
query(
    "publication_bootstrap",
    """
    SELECT CAST(NULL AS BIGINT) AS previous_snapshot_key, CAST(1 AS BIGINT) AS current_snapshot_key,
           CAST(0 AS BIGINT) AS previous_entity_rows, COUNT(*) AS current_entity_rows,
           CAST(0 AS BIGINT) AS changes_detected, CAST(0 AS BIGINT) AS changes_inserted
    FROM state1""",
)(
    lambda w: changes.publication_bootstrap(w.older.entity_state(OLDER_SNAPSHOT), OLDER_SNAPSHOT)
)


@query("fact_publication_change", "SELECT * FROM change_log")
def fact_publication_change(w: World) -> DataFrame:
    """A log that already holds the operator and route changes is completed."""
    stored = w.warehouse.changes.where(F.col("entity_type").isin("OPERATOR", "ROUTE"))
    return changes.fact_publication_change(stored, w.change_rows())


# Analytics views -------------------------------------------------------------


def _served(w: World, name: str) -> DataFrame:
    """A stored view."""
    return w.view(name, lambda: VIEW_BUILDERS[name](w))


VIEW_BUILDERS: dict[str, Callable[[World], DataFrame]] = {
    "platform_summary": lambda w: views.platform_summary(w.warehouse, AS_OF),
    "route_service_daily": lambda w: views.route_service_daily(w.warehouse),
    "route_summary": lambda w: views.route_summary(w.warehouse),
    "stop_summary": lambda w: views.stop_summary(w.warehouse),
    "publication_changes_view": lambda w: views.publication_changes_view(w.warehouse),
    "publication_change_summary": lambda w: views.publication_change_summary(w.warehouse),
    "recent_pipeline_runs": lambda w: views.recent_pipeline_runs(w.warehouse, AS_OF),
    "data_quality_results": lambda w: views.data_quality_results(w.warehouse),
    "network_daily_summary": lambda w: views.network_daily_summary(w.warehouse),
    "operator_summary": lambda w: views.operator_summary(w.warehouse),
    "transport_mode_summary": lambda w: views.transport_mode_summary(w.warehouse),
    "route_service_intelligence": lambda w: views.route_service_intelligence(
        w.warehouse, _served(w, "route_summary")
    ),
    "stop_service_intelligence": lambda w: views.stop_service_intelligence(
        w.warehouse, _served(w, "stop_summary")
    ),
    "location_summary": lambda w: views.location_summary(w.warehouse),
    "stop_location_changes": lambda w: views.stop_location_changes(w.warehouse),
    "pipeline_health": lambda w: views.pipeline_health(w.warehouse, AS_OF),
    "dashboard_kpis": lambda w: views.dashboard_kpis(
        w.warehouse, AS_OF, _served(w, "route_service_intelligence"),
        _served(w, "stop_service_intelligence"),
    ),
}



@query(
    "latest_snapshot",
    """
    SELECT snapshot_key, downloaded_at_utc, snapshot_status FROM (
        SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT) AS snapshot_key,
               CAST(MAX(o_orderdate) AS TIMESTAMP) AS downloaded_at_utc,
               CASE WHEN SUM(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) * 3 <= COUNT(*)
                    THEN 'LOADED' ELSE 'VALIDATED' END AS snapshot_status
        FROM orders GROUP BY year(o_orderdate) * 100 + month(o_orderdate)) p
    WHERE snapshot_status = 'LOADED' ORDER BY downloaded_at_utc DESC, snapshot_key DESC LIMIT 1""",
)
def latest_snapshot(w: World) -> DataFrame:
    """One publication per order month; months with many pending orders are not loaded."""
    month = (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("bigint")
    pending = F.count_if(F.col("o_orderstatus") == "P")
    publications = (
        w.spark.read.parquet(f"{w.folder}/orders.parquet")
        .groupBy(month.alias("snapshot_key"))
        .agg(
            F.max("o_orderdate").cast("timestamp_ntz").alias("downloaded_at_utc"),
            F.when(pending * 3 <= F.count("*"), "LOADED").otherwise("VALIDATED").alias("snapshot_status"),
        )
    )
    return views.latest_snapshot(publications)


for _name, _make in VIEW_BUILDERS.items():
    _table = "v_" + _name.removesuffix("_view")
    query(_name, f"SELECT * FROM {_table}")(_make)

# Dashboard reads -------------------------------------------------------------


def _prefixed(rows: DataFrame, prefix: str) -> list:
    return [F.col(f"{prefix}.{c}").alias(f"{prefix}_{c}") for c in rows.columns]


@query(
    "q_overview",
    """
    SELECT {kpis}, {platform}, '1' AS schema_version, '2' AS table_count, '2' AS total_rows
    FROM (SELECT *, 1 AS one FROM v_dashboard_kpis) k
    JOIN (SELECT *, 1 AS one FROM v_platform_summary) p ON p.one = k.one""",
)
def q_overview(w: World) -> DataFrame:
    from linespan.plans.serving import serving_metadata

    kpis, platform = _served(w, "dashboard_kpis"), _served(w, "platform_summary")
    counts = kpis.select(F.lit("dashboard_kpis").alias("table_name")).union(
        platform.select(F.lit("platform_summary"))
    )
    manifest = counts.groupBy("table_name").agg(F.count("*").alias("row_count"))
    overview = dashboard.q_overview(kpis, platform, serving_metadata(manifest, AS_OF))
    metadata = [
        F.col("metadata")[key].alias(key) for key in ("schema_version", "table_count", "total_rows")
    ]
    return overview.select(*_prefixed(kpis, "kpis"), *_prefixed(platform, "platform"), *metadata)


_KPI_COLUMNS = (
    "snapshot_key downloaded_at_utc data_age_hours freshness_status reporting_start_date "
    "reporting_end_date operator_count route_count stop_count trip_count "
    "scheduled_stop_event_count publication_change_count strong_service_route_count "
    "high_frequency_route_count major_hub_count accessible_stop_count leading_route "
    "leading_route_score leading_stop leading_stop_score healthy_pipeline_count "
    "recovered_pipeline_count service_ready_pipeline_count action_required_pipeline_count "
    "running_pipeline_count monitored_pipeline_count last_successful_pipeline_at_utc"
).split()
_PLATFORM_COLUMNS = (
    "snapshot_key source_name downloaded_at_utc source_last_modified_utc data_age_hours "
    "freshness_status file_name file_size_bytes sha256 feed_start_date feed_end_date feed_version "
    "reporting_start_date reporting_end_date operator_count route_count stop_count service_count "
    "trip_count scheduled_stop_event_count shape_point_count route_daily_fact_count "
    "stop_daily_fact_count publication_change_count last_successful_pipeline_at_utc "
    "successful_pipeline_run_count failed_pipeline_run_count"
).split()
REGISTRY["q_overview"] = Query(
    REGISTRY["q_overview"].run,
    REGISTRY["q_overview"].check.format(
        kpis=", ".join(f"k.{c} AS kpis_{c}" for c in _KPI_COLUMNS),
        platform=", ".join(f"p.{c} AS platform_{c}" for c in _PLATFORM_COLUMNS),
    ),
)

query(
    "q_network_trends",
    """
    SELECT service_date, CAST(SUM(active_route_count) AS BIGINT) AS active_route_count,
           CAST(SUM(scheduled_trip_count) AS BIGINT) AS scheduled_trip_count,
           CAST(SUM(scheduled_stop_event_count) AS BIGINT) AS scheduled_stop_event_count,
           ((2 * CAST(SUM(headway_c) AS BIGINT) + NULLIF(COUNT(headway_c), 0))
            // (2 * NULLIF(COUNT(headway_c), 0))) / 100.0 AS average_headway_minutes
    FROM nds
    WHERE service_date >= (SELECT MAX(service_date) FROM nds) - 29
    GROUP BY service_date""",
)(lambda w: dashboard.q_network_trends(_served(w, "network_daily_summary"), days=30))

query(
    "q_modes",
    """
    SELECT transport_mode, route_count, operator_count, total_scheduled_trips,
           total_scheduled_stop_events, average_route_daily_trips, average_route_stop_coverage,
           average_service_span_minutes, average_headway_minutes,
           CAST(total_scheduled_trips AS DOUBLE)
               / CAST((SELECT SUM(total_scheduled_trips) FROM v_transport_mode_summary) AS DOUBLE)
               * 100 AS trip_share_pct
    FROM v_transport_mode_summary""",
)(lambda w: dashboard.q_modes(_served(w, "transport_mode_summary")))

_ROUTE_LIST = """
    SELECT network_service_rank, route_id, route_display_name, operator_name, transport_mode,
           route_colour, route_text_colour, scheduled_service_score, scheduled_service_band,
           frequency_band, average_daily_trips, average_daily_unique_stops,
           average_service_span_minutes, average_headway_minutes, total_scheduled_trips
    FROM v_route_service_intelligence"""


@query(
    "q_routes",
    f"""
    SELECT 'service' AS sorted_by, * FROM ({_ROUTE_LIST}
        ORDER BY network_service_rank, route_id LIMIT 100) a
    UNION ALL SELECT 'trips', * FROM ({_ROUTE_LIST} WHERE transport_mode = 'Bus'
        ORDER BY average_daily_trips DESC, route_id LIMIT 100) b
    UNION ALL SELECT 'frequency', * FROM ({_ROUTE_LIST}
        ORDER BY average_headway_minutes ASC NULLS FIRST, route_id LIMIT 100) c
    UNION ALL SELECT 'coverage', * FROM ({_ROUTE_LIST}
        ORDER BY average_daily_unique_stops DESC, route_id LIMIT 100) d""",
)
def q_routes(w: World) -> DataFrame:
    routes = _served(w, "route_service_intelligence")

    def ordered(sort_by: str, mode: str | None = None) -> DataFrame:
        rows = dashboard.q_routes(routes, limit=100, mode=mode, sort_by=sort_by)
        return rows.select(F.lit(sort_by).alias("sorted_by"), "*")

    return (
        ordered("service")
        .unionByName(ordered("trips", "Bus"))
        .unionByName(ordered("frequency"))
        .unionByName(ordered("coverage"))
    )


query(
    "q_stops",
    """
    SELECT network_activity_rank, stop_id, stop_code, stop_name, stop_latitude, stop_longitude,
           zone_id, accessibility_status, scheduled_activity_score, scheduled_activity_band,
           average_daily_trips, average_daily_routes, average_service_span_minutes,
           average_headway_minutes, total_scheduled_trips
    FROM v_stop_service_intelligence WHERE stop_name ILIKE '%MER#%1%' OR stop_code ILIKE '%MER#%1%'
    ORDER BY network_activity_rank, stop_id LIMIT 250""",
)(
    lambda w: dashboard.q_stops(
        _served(w, "stop_service_intelligence"), limit=250, search=" MER#%1 "
    )
)
query(
    "q_map_stops",
    """
    SELECT stop_id, stop_name, stop_latitude, stop_longitude, accessibility_status,
           scheduled_activity_score, scheduled_activity_band, average_daily_trips,
           average_daily_routes
    FROM v_stop_service_intelligence
    WHERE stop_latitude IS NOT NULL AND stop_longitude IS NOT NULL
    ORDER BY network_activity_rank, stop_id LIMIT 5000""",
)(lambda w: dashboard.q_map_stops(_served(w, "stop_service_intelligence"), limit=5000))
query(
    "q_operators",
    """
    SELECT agency_id, operator_name, route_count, total_scheduled_trips,
           total_scheduled_stop_events, average_route_daily_trips, average_route_stop_coverage,
           average_service_span_minutes, average_headway_minutes
    FROM v_operator_summary
    ORDER BY total_scheduled_trips DESC, operator_name, agency_id LIMIT 100""",
)(lambda w: dashboard.q_operators(_served(w, "operator_summary"), limit=100))
query("q_locations", "SELECT * EXCLUDE (snapshot_key) FROM v_location_summary")(
    lambda w: dashboard.q_locations(_served(w, "location_summary"))
)


@query(
    "q_publication_changes",
    """
    SELECT 'SUMMARY' AS section, current_snapshot_key, entity_type, change_type,
           CAST(NULL AS VARCHAR) AS entity_id, change_count
    FROM v_publication_change_summary
    UNION ALL
    SELECT 'CHANGE', current_snapshot_key, entity_type, change_type, entity_id, NULL
    FROM (SELECT * FROM v_publication_changes
          ORDER BY detected_at_utc DESC, publication_change_key DESC LIMIT 200) c""",
)
def q_publication_changes(w: World) -> DataFrame:
    summary = dashboard.q_publication_change_summary(_served(w, "publication_change_summary"))
    recent = dashboard.q_publication_changes(_served(w, "publication_changes_view"), limit=200)
    return summary.select(
        F.lit("SUMMARY").alias("section"), "current_snapshot_key", "entity_type", "change_type",
        F.lit(None).cast("string").alias("entity_id"), "change_count",
    ).unionByName(
        recent.select(
            F.lit("CHANGE").alias("section"), "current_snapshot_key", "entity_type",
            "change_type", "entity_id", F.lit(None).cast("bigint").alias("change_count"),
        )
    )


@query(
    "q_pipelines",
    """
    SELECT 'HEALTH' AS section, pipeline_name, latest_pipeline_run_key AS pipeline_run_key,
           latest_run_status AS run_status, latest_started_at_utc AS started_at_utc,
           latest_duration_milliseconds AS duration_milliseconds, recent_success_rate_pct,
           pipeline_health_status
    FROM v_pipeline_health
    UNION ALL
    SELECT 'RUN', pipeline_name, pipeline_run_key, run_status, started_at_utc,
           duration_milliseconds, NULL, NULL
    FROM (SELECT * FROM v_recent_pipeline_runs
          ORDER BY started_at_utc DESC, pipeline_run_key DESC LIMIT 40) r""",
)
def q_pipelines(w: World) -> DataFrame:
    health = dashboard.q_pipelines(_served(w, "pipeline_health"))
    recent = dashboard.q_recent_runs(_served(w, "recent_pipeline_runs"))
    return health.select(
        F.lit("HEALTH").alias("section"), "pipeline_name",
        F.col("latest_pipeline_run_key").alias("pipeline_run_key"),
        F.col("latest_run_status").alias("run_status"),
        F.col("latest_started_at_utc").alias("started_at_utc"),
        F.col("latest_duration_milliseconds").alias("duration_milliseconds"),
        "recent_success_rate_pct", "pipeline_health_status",
    ).unionByName(
        recent.select(
            F.lit("RUN").alias("section"), "pipeline_name", "pipeline_run_key", "run_status",
            "started_at_utc", "duration_milliseconds",
            F.lit(None).cast("decimal(5,2)").alias("recent_success_rate_pct"),
            F.lit(None).cast("string").alias("pipeline_health_status"),
        )
    )


@query(
    "q_data_quality",
    """
    WITH recent AS (SELECT * FROM v_data_quality_results
                    ORDER BY checked_at_utc DESC, data_quality_result_key DESC LIMIT 100)
    SELECT pipeline_name, check_name, check_status, records_checked, failed_records,
           checked_at_utc, c.pass_count, c.warn_count, c.fail_count
    FROM (SELECT *, 1 AS one FROM recent) r
    JOIN (SELECT 1 AS one, COUNT(*) FILTER (check_status = 'PASS') AS pass_count,
                 COUNT(*) FILTER (check_status = 'WARN') AS warn_count,
                 COUNT(*) FILTER (check_status = 'FAIL') AS fail_count FROM recent) c
      ON c.one = r.one""",
)
def q_data_quality(w: World) -> DataFrame:
    results = _served(w, "data_quality_results")
    counts = dashboard.q_data_quality_counts(results, limit=100)
    total = counts.select(F.struct("*")).scalar()
    return (
        dashboard.q_data_quality(results, limit=100)
        .withColumn("_counts", total)
        .select(
            "pipeline_name", "check_name", "check_status", "records_checked", "failed_records",
            "checked_at_utc", "_counts.pass_count", "_counts.warn_count", "_counts.fail_count",
        )
    )


query(
    "q_accessibility_share",
    """
    SELECT CAST(SUM(accessible_stop_count) AS BIGINT) AS accessible_stop_count,
           CAST(SUM(unknown_accessibility_count) AS BIGINT) AS unknown_accessibility_count,
           CAST(CAST(SUM(accessible_stop_count) AS BIGINT) AS DOUBLE)
               / (SELECT stop_count FROM v_dashboard_kpis) * 100 AS accessible_share_pct
    FROM v_location_summary""",
)(
    lambda w: dashboard.q_accessibility_share(
        _served(w, "location_summary"), _served(w, "dashboard_kpis")
    )
)


def _register_all() -> None:
    """Load the modules that register further queries."""
    import verification.intake_checks  # noqa: F401
    import verification.quality_checks  # noqa: F401


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _register_all()

    def bound(run: Callable[[World], DataFrame]):
        return lambda spark, folder: plain(run(World(spark, folder)))

    return {name: bound(entry.run) for name, entry in REGISTRY.items()}


def checking_sql() -> dict[str, str]:
    _register_all()
    return {
        name: complete(entry.check) for name, entry in REGISTRY.items() if entry.check is not None
    }
