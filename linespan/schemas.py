"""Column contracts of feed files and governance tables."""

from __future__ import annotations

# The declared columns of each feed file, in hash order.
FEED_COLUMNS: dict[str, tuple[str, ...]] = {
    "agency": (
        "agency_id", "agency_name", "agency_url", "agency_timezone", "agency_lang",
        "agency_phone", "agency_fare_url", "agency_email", "agency_noc",
    ),
    "calendar": (
        "service_id", "monday", "tuesday", "wednesday", "thursday", "friday",
        "saturday", "sunday", "start_date", "end_date",
    ),
    "calendar_dates": ("service_id", "date", "exception_type"),
    "feed_info": (
        "feed_publisher_name", "feed_publisher_url", "feed_lang",
        "feed_start_date", "feed_end_date", "feed_version",
    ),
    "routes": (
        "route_id", "agency_id", "route_short_name", "route_long_name", "route_desc",
        "route_type", "route_url", "route_color", "route_text_color",
    ),
    "stops": (
        "stop_id", "stop_code", "stop_name", "stop_desc", "stop_lat", "stop_lon",
        "zone_id", "stop_url", "location_type", "parent_station", "wheelchair_boarding",
    ),
    "trips": (
        "route_id", "service_id", "trip_id", "trip_headsign", "trip_short_name",
        "direction_id", "block_id", "shape_id", "wheelchair_accessible",
    ),
    "stop_times": (
        "trip_id", "arrival_time", "departure_time", "stop_id", "stop_sequence",
        "stop_headsign", "pickup_type", "drop_off_type", "shape_dist_traveled", "timepoint",
    ),
    "shapes": (
        "shape_id", "shape_pt_lat", "shape_pt_lon", "shape_pt_sequence",
        "shape_dist_traveled",
    ),
}

# Staged only for the newest publication: each load replaces the whole table.
ROLLING_TABLES = ("stop_times", "shapes")
REFERENCE_TABLES = ("agency", "calendar", "calendar_dates", "feed_info")
NETWORK_TABLES = ("routes", "stops", "trips")

# Pipeline names recorded in the run log.
STAGE_REFERENCE = "load_gtfs_reference_staging"
STAGE_NETWORK = "load_gtfs_network_staging"
STAGE_HIGH_VOLUME = "load_gtfs_high_volume_staging"
STAGE_CORE = "load_gtfs_core_warehouse"
STAGE_DIM_NETWORK = "load_gtfs_network_warehouse"
STAGE_SERVICE = "load_gtfs_service_warehouse"
STAGE_TRIP = "load_gtfs_trip_warehouse"
STAGE_SHAPE = "load_gtfs_shape_point_warehouse"
STAGE_STOP_EVENT = "load_gtfs_scheduled_stop_event_warehouse"
STAGE_DAILY_FACT = "build_gtfs_daily_service_facts"
STAGE_CHANGE = "build_gtfs_publication_changes"
STAGE_EXPORT = "export_gtfs_analytics_sqlite"
ENTITY_STAGES = (STAGE_CORE, STAGE_DIM_NETWORK, STAGE_SERVICE, STAGE_TRIP)

SNAPSHOT_SCHEMA = """
    snapshot_key BIGINT, source_name STRING, source_url STRING,
    downloaded_at_utc TIMESTAMP_NTZ, source_last_modified_utc TIMESTAMP_NTZ,
    source_etag STRING, file_name STRING, file_size_bytes BIGINT, sha256 STRING,
    feed_start_date DATE, feed_end_date DATE, feed_version STRING, snapshot_status STRING
"""

RUN_SCHEMA = """
    pipeline_run_key BIGINT, snapshot_key BIGINT, pipeline_name STRING,
    orchestrator STRING, external_run_id STRING, run_status STRING,
    started_at_utc TIMESTAMP_NTZ, completed_at_utc TIMESTAMP_NTZ,
    rows_read BIGINT, rows_loaded BIGINT, rows_rejected BIGINT, error_message STRING
"""

QUALITY_SCHEMA = """
    data_quality_result_key BIGINT, pipeline_run_key BIGINT, snapshot_key BIGINT,
    check_name STRING, check_category STRING, table_name STRING, check_status STRING,
    records_checked BIGINT, failed_records BIGINT, threshold_value DECIMAL(18,6),
    observed_value DECIMAL(18,6), details STRING, checked_at_utc TIMESTAMP_NTZ
"""
