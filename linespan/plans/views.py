"""Analytics views: each is one function over the warehouse tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linespan.functions.columns import cleaned
from linespan.functions.measures import (
    average_2dp,
    average_6dp,
    geodesic_metres,
    hours_crossed,
    milliseconds_crossed,
    minutes_crossed,
    score_1dp,
)
from linespan.operators.daily import WORD_BITS
from linespan.operators.history import versions_by_key
from linespan.plans.warehouse import Warehouse
from linespan.session import settled

RECENT_RUNS = 200
RECENT_RESULTS = 500
HEALTH_WINDOW_RUNS = 20


def moment(as_of: str) -> Column:
    return F.lit(as_of).cast("timestamp_ntz")


def latest_snapshot(snapshots: DataFrame) -> DataFrame:
    return (
        snapshots.where(F.col("snapshot_status") == "LOADED")
        .orderBy(F.desc("downloaded_at_utc"), F.desc("snapshot_key"))
        .limit(1)
    )


def _latest_key(snapshots: DataFrame) -> Column:
    return latest_snapshot(snapshots).select("snapshot_key").scalar()


def platform_summary(w: Warehouse, as_of: str) -> DataFrame:
    latest = _latest_key(w.snapshots)
    now = moment(as_of)
    own = F.col("snapshot_key") == latest
    downloaded = F.col("downloaded_at_utc")
    age = hours_crossed(downloaded, now)

    def total(rows: DataFrame) -> Column:
        return rows.select(F.count("*")).scalar()

    facts = w.route_days.where(own).agg(
        F.struct(
            F.min("full_date").alias("first"),
            F.max("full_date").alias("last"),
            F.count("*").alias("rows"),
        ).alias("facts")
    ).scalar()
    runs = w.runs.where(own).agg(
        F.struct(
            F.max(F.when(F.col("run_status") == "SUCCEEDED", F.col("completed_at_utc"))).alias(
                "completed"
            ),
            F.count_if(F.col("run_status") == "SUCCEEDED").alias("succeeded"),
            F.count_if(F.col("run_status") == "FAILED").alias("failed"),
        ).alias("runs")
    ).scalar()
    return (
        latest_snapshot(w.snapshots)
        .withColumns({"_facts": facts, "_runs": runs})
        .select(
            "snapshot_key",
            "source_name",
            "downloaded_at_utc",
            "source_last_modified_utc",
            F.round(minutes_crossed(downloaded, now).cast("decimal(12,0)") / 60, 2)
            .cast("decimal(18,2)")
            .alias("data_age_hours"),
            F.when(age <= 36, "CURRENT").when(age <= 72, "DELAYED").otherwise("STALE").alias(
                "freshness_status"
            ),
            "file_name",
            "file_size_bytes",
            "sha256",
            "feed_start_date",
            "feed_end_date",
            "feed_version",
            F.col("_facts.first").alias("reporting_start_date"),
            F.col("_facts.last").alias("reporting_end_date"),
            total(versions_by_key(w.dim_operator, latest)).alias("operator_count"),
            total(versions_by_key(w.dim_route, latest)).alias("route_count"),
            total(versions_by_key(w.dim_stop, latest)).alias("stop_count"),
            total(w.dim_service.where(own)).alias("service_count"),
            total(w.dim_trip.where(own)).alias("trip_count"),
            total(w.events.where(own)).alias("scheduled_stop_event_count"),
            total(w.shapes.where(own)).alias("shape_point_count"),
            F.col("_facts.rows").alias("route_daily_fact_count"),
            total(w.stop_days.where(own)).alias("stop_daily_fact_count"),
            total(w.changes.where(F.col("current_snapshot_key") == latest)).alias(
                "publication_change_count"
            ),
            F.col("_runs.completed").alias("last_successful_pipeline_at_utc"),
            F.col("_runs.succeeded").alias("successful_pipeline_run_count"),
            F.col("_runs.failed").alias("failed_pipeline_run_count"),
        )
    )


# Route type codes and their names.
MODES = {0: "Tram", 1: "Underground", 2: "Rail", 3: "Bus"}
OTHER_MODE = "Other"


def transport_mode(route_type: Column) -> Column:
    named = F.when(F.lit(False), OTHER_MODE)
    for code, name in MODES.items():
        named = named.when(route_type == code, name)
    return named.otherwise(OTHER_MODE)


ROUTE_ATTRIBUTES = (
    "snapshot_key", "operator_key", "agency_id", "operator_name", "route_key", "route_id",
    "route_short_name", "route_long_name", "route_display_name", "route_type", "transport_mode",
    "route_colour", "route_text_colour",
)


def _described_routes(w: Warehouse) -> DataFrame:
    """Route versions with operator, display name and mode."""
    routes = w.dim_route.select(
        "route_key", "route_id", "route_short_name", "route_long_name", "route_type",
        "route_colour", "route_text_colour", "operator_key",
        F.coalesce(cleaned("route_short_name"), cleaned("route_long_name"), "route_id").alias(
            "route_display_name"
        ),
        transport_mode(F.col("route_type")).alias("transport_mode"),
    )
    operators = w.dim_operator.select("operator_key", "agency_id", "operator_name")
    return routes.join(operators, "operator_key")


def route_service_daily(w: Warehouse) -> DataFrame:
    facts = w.route_days.where(F.col("snapshot_key") == _latest_key(w.snapshots))
    dates = w.dim_date.select(
        "full_date", "day_name", "is_weekend", "month_name", "calendar_year"
    )
    return (
        facts.drop("operator_key", "date_key")
        .join(F.broadcast(dates), "full_date")
        .join(_described_routes(w), "route_key")
        .select(
            "snapshot_key",
            F.col("full_date").alias("service_date"),
            "day_name", "is_weekend", "month_name", "calendar_year",
            *ROUTE_ATTRIBUTES[1:],
            "scheduled_trip_count", "scheduled_stop_event_count", "unique_stop_count",
            "first_departure_seconds", "last_arrival_seconds",
            "service_span_minutes", "average_headway_minutes",
        )
    )


def route_summary(w: Warehouse) -> DataFrame:
    """Per route over the window. Facts are aggregated by key, then described,
    so wide route and operator text is never shuffled per day."""
    measures = (
        w.route_days.where(F.col("snapshot_key") == _latest_key(w.snapshots))
        .groupBy("snapshot_key", "route_key")
        .agg(
            F.min("full_date").alias("first_service_date"),
            F.max("full_date").alias("last_service_date"),
            F.count("*").alias("service_day_count"),
            F.sum("scheduled_trip_count").alias("total_scheduled_trips"),
            F.sum("scheduled_stop_event_count").alias("total_scheduled_stop_events"),
            F.max("scheduled_trip_count").alias("maximum_daily_trips"),
            average_2dp("scheduled_trip_count").alias("average_daily_trips"),
            average_2dp("unique_stop_count").alias("average_daily_unique_stops"),
            F.max("unique_stop_count").alias("maximum_daily_unique_stops"),
            average_2dp("service_span_minutes").alias("average_service_span_minutes"),
            average_2dp("average_headway_minutes").alias("average_headway_minutes"),
        )
    )
    names = measures.columns[2:]
    return measures.join(_described_routes(w), "route_key").select(*ROUTE_ATTRIBUTES, *names)


def stop_summary(w: Warehouse) -> DataFrame:
    measures = (
        w.stop_days.where(F.col("snapshot_key") == _latest_key(w.snapshots))
        .groupBy("snapshot_key", "stop_key")
        .agg(
            F.min("full_date").alias("first_service_date"),
            F.max("full_date").alias("last_service_date"),
            F.count("*").alias("service_day_count"),
            F.sum("scheduled_trip_count").alias("total_scheduled_trips"),
            average_2dp("scheduled_trip_count").alias("average_daily_trips"),
            F.max("scheduled_route_count").alias("maximum_daily_routes"),
            average_2dp("scheduled_route_count").alias("average_daily_routes"),
            average_2dp("service_span_minutes").alias("average_service_span_minutes"),
            average_2dp("average_headway_minutes").alias("average_headway_minutes"),
        )
    )
    names = measures.columns[2:]
    boarding = F.col("wheelchair_boarding")
    stops = w.dim_stop.select(
        "stop_key", "stop_id", "stop_code", "stop_name", "stop_latitude", "stop_longitude",
        "zone_id", "location_type", "parent_station_id", "wheelchair_boarding",
        F.when(boarding == 1, "Accessible")
        .when(boarding == 2, "Not accessible")
        .otherwise("Unknown")
        .alias("accessibility_status"),
    )
    return measures.join(stops, "stop_key").select(
        "snapshot_key", *stops.columns, *names
    )


def publication_changes_view(w: Warehouse) -> DataFrame:
    registry = w.snapshots.select("snapshot_key", "downloaded_at_utc")
    return (
        w.changes.join(
            registry.select(
                F.col("snapshot_key").alias("previous_snapshot_key"),
                F.col("downloaded_at_utc").alias("previous_downloaded_at_utc"),
            ),
            "previous_snapshot_key",
        )
        .join(
            registry.select(
                F.col("snapshot_key").alias("current_snapshot_key"),
                F.col("downloaded_at_utc").alias("current_downloaded_at_utc"),
            ),
            "current_snapshot_key",
        )
        .select(
            "publication_change_key", "previous_snapshot_key", "previous_downloaded_at_utc",
            "current_snapshot_key", "current_downloaded_at_utc", "entity_type", "entity_id",
            "change_type", "changed_fields", "change_details_json", "detected_at_utc",
        )
    )


def publication_change_summary(w: Warehouse) -> DataFrame:
    return (
        publication_changes_view(w)
        .groupBy(
            "previous_snapshot_key", "previous_downloaded_at_utc", "current_snapshot_key",
            "current_downloaded_at_utc", "entity_type", "change_type",
        )
        .agg(
            F.count("*").alias("change_count"),
            F.min("detected_at_utc").alias("first_detected_at_utc"),
            F.max("detected_at_utc").alias("last_detected_at_utc"),
        )
    )


def _run_duration(as_of: str) -> Column:
    return milliseconds_crossed(
        F.col("started_at_utc"), F.coalesce("completed_at_utc", moment(as_of))
    )


def recent_pipeline_runs(w: Warehouse, as_of: str) -> DataFrame:
    """Newest runs. The top-k runs before the join, so only those rows join."""
    newest = w.runs.orderBy(F.desc("started_at_utc"), F.desc("pipeline_run_key")).limit(RECENT_RUNS)
    registry = w.snapshots.select(
        "snapshot_key", F.col("downloaded_at_utc").alias("snapshot_downloaded_at_utc")
    )
    return newest.join(registry, "snapshot_key", "left").select(
        "pipeline_run_key", "snapshot_key", "snapshot_downloaded_at_utc", "pipeline_name",
        "orchestrator", "external_run_id", "run_status", "started_at_utc", "completed_at_utc",
        _run_duration(as_of).alias("duration_milliseconds"),
        "rows_read", "rows_loaded", "rows_rejected", "error_message",
    )


def data_quality_results(w: Warehouse) -> DataFrame:
    """Newest results of known runs. The top-k runs before names are joined."""
    runs = w.runs.select("pipeline_run_key", "pipeline_name")
    order = F.desc("checked_at_utc"), F.desc("data_quality_result_key")
    newest = (
        w.quality.join(runs.select("pipeline_run_key"), "pipeline_run_key", "left_semi")
        .orderBy(*order)
        .limit(RECENT_RESULTS)
    )
    return (
        newest.join(runs, "pipeline_run_key")
        .orderBy(*order)
        .limit(RECENT_RESULTS)
        .select(
            "data_quality_result_key", "pipeline_run_key", "snapshot_key", "pipeline_name",
            "check_name", "check_category", "table_name", "check_status", "records_checked",
            "failed_records", "threshold_value", "observed_value", "details", "checked_at_utc",
        )
    )


def network_daily_summary(w: Warehouse) -> DataFrame:
    """Per day and mode. Date text joins after the aggregate, a few rows per day.

    A distinct count over the facts would shuffle a row per operator and day. Operators
    are counted from their days instead, packed into 64-bit words before the shuffle.
    """
    modes = w.dim_route.select(
        "route_key", transport_mode(F.col("route_type")).alias("transport_mode")
    )
    facts = w.route_days.where(F.col("snapshot_key") == _latest_key(w.snapshots))
    group = ["snapshot_key", "full_date", "transport_mode"]
    number = F.unix_date("full_date")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(number, F.lit(WORD_BITS)))
    word = F.floor(number / WORD_BITS).cast("int")
    by_operator = ["snapshot_key", "operator_key", "_word"]
    active = (
        facts.where("operator_key IS NOT NULL")
        .groupBy("route_key", "snapshot_key", "operator_key", word.alias("_word"))
        .agg(F.bit_or(bit).alias("_days"))
        .join(modes, "route_key")
        .groupBy("transport_mode", *by_operator)
        .agg(F.bit_or("_days").alias("_days"))
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(WORD_BITS - 1))).alias("_offset"))
        .where(F.getbit("_days", F.col("_offset")) == 1)
        .withColumn("full_date", F.date_from_unix_date(F.col("_word") * WORD_BITS + F.col("_offset")))
        .groupBy(*group)
        .agg(F.count("*").alias("_operators"))
    )
    measures = (
        facts.join(modes, "route_key")
        .groupBy(*group)
        .agg(
            F.count("*").alias("active_route_count"),
            F.sum("scheduled_trip_count").alias("scheduled_trip_count"),
            F.sum("scheduled_stop_event_count").alias("scheduled_stop_event_count"),
            average_2dp("unique_stop_count").alias("average_stops_per_route"),
            average_2dp("service_span_minutes").alias("average_service_span_minutes"),
            average_2dp("average_headway_minutes").alias("average_headway_minutes"),
        )
    )
    dates = w.dim_date.select(
        "full_date", "day_name", "is_weekend", "month_name", "calendar_year"
    )
    return (
        measures.join(active, group, "left")
        .join(F.broadcast(dates), "full_date")
        .select(
            "snapshot_key", F.col("full_date").alias("service_date"), "day_name", "is_weekend",
            "month_name", "calendar_year", "transport_mode", "active_route_count",
            F.coalesce("_operators", F.lit(0)).alias("active_operator_count"),
            *measures.columns[4:],
        )
    )


def _route_rollup() -> list[Column]:
    return [
        F.sum("total_scheduled_trips").alias("total_scheduled_trips"),
        F.sum("total_scheduled_stop_events").alias("total_scheduled_stop_events"),
        average_2dp("average_daily_trips").alias("average_route_daily_trips"),
        average_2dp("average_daily_unique_stops").alias("average_route_stop_coverage"),
        average_2dp("average_service_span_minutes").alias("average_service_span_minutes"),
        average_2dp("average_headway_minutes").alias("average_headway_minutes"),
    ]


def operator_summary(w: Warehouse, summary: DataFrame | None = None) -> DataFrame:
    return (
        (summary or route_summary(w))
        .groupBy("snapshot_key", "operator_key", "agency_id", "operator_name")
        .agg(
            F.count("*").alias("route_count"),
            *_route_rollup(),
            F.min("first_service_date").alias("first_service_date"),
            F.max("last_service_date").alias("last_service_date"),
        )
    )


def transport_mode_summary(w: Warehouse, summary: DataFrame | None = None) -> DataFrame:
    return (
        (summary or route_summary(w))
        .groupBy("snapshot_key", "transport_mode")
        .agg(
            F.count("*").alias("route_count"),
            F.countDistinct("operator_key").alias("operator_count"),
            *_route_rollup(),
        )
    )


def _banded(value: Column, bands: list[tuple[int, str]], lowest: str) -> Column:
    band = F.when(F.lit(False), lowest)
    for limit, name in bands:
        band = band.when(value >= limit, name)
    return band.otherwise(lowest)


# Score weights, score bands and headway bands.
ROUTE_WEIGHTS = (
    ("average_daily_trips", "trip_intensity_percentile", 0.45),
    ("average_service_span_minutes", "span_percentile", 0.30),
    ("average_daily_unique_stops", "coverage_percentile", 0.25),
)
ROUTE_BANDS = [(80, "VERY HIGH"), (60, "HIGH"), (40, "MODERATE")]
ROUTE_LOWEST_BAND = "LIMITED"
STOP_WEIGHTS = (
    ("average_daily_trips", "trip_activity_percentile", 0.50),
    ("average_daily_routes", "route_choice_percentile", 0.30),
    ("average_service_span_minutes", "span_percentile", 0.20),
)
STOP_BANDS = [(80, "MAJOR HUB"), (60, "HIGH ACTIVITY"), (40, "MODERATE ACTIVITY")]
STOP_LOWEST_BAND = "LOCAL ACCESS"
HEADWAY_BANDS = [(10, "HIGH FREQUENCY"), (20, "FREQUENT"), (30, "STANDARD")]
NO_HEADWAY = "SINGLE JOURNEY"
LONG_HEADWAY = "LOW FREQUENCY"


def _value_ranks(summary: DataFrame, measure: str, output: str) -> DataFrame:
    """PERCENT_RANK per distinct value of one measure.

    Ranking every route or stop in one task per publication does not scale. A
    value's rank depends only on how many rows lie below it, so rows are first
    counted per distinct value; the window then runs over distinct two-decimal
    values, not over entities. The summary is read four times, so callers pass
    a written one.
    """
    counts = summary.groupBy("snapshot_key", measure).agg(F.count("*").alias("_rows"))
    by_snapshot = Window.partitionBy("snapshot_key")
    below = by_snapshot.orderBy(measure).rowsBetween(Window.unboundedPreceding, -1)
    rows_below = F.coalesce(F.sum("_rows").over(below), F.lit(0))
    others = F.sum("_rows").over(by_snapshot) - 1
    rank = F.when(others > 0, rows_below / others).otherwise(F.lit(0.0))
    return counts.select("snapshot_key", measure, rank.cast("double").alias(output))


def _scored(summary: DataFrame, weights: tuple, score: str) -> DataFrame:
    """Rows with ranks and score, written once: several branches read them.

    A row without a measure ranks lowest in it, as ``PERCENT_RANK`` has it.
    """
    ranked = summary
    for measure, output, _ in weights:
        ranks = _value_ranks(summary, measure, output).select(
            F.col("snapshot_key").alias("_key"), F.col(measure).alias("_value"), output
        )
        same = (F.col("snapshot_key") == F.col("_key")) & F.col(measure).eqNullSafe(F.col("_value"))
        ranked = ranked.join(ranks, same).drop("_key", "_value")
    weighted = sum((F.lit(weight) * F.col(output) for _, output, weight in weights), F.lit(0.0))
    return settled(ranked.withColumn(score, score_1dp(F.lit(100.0) * weighted)), "scored")


def _score_ranks(scored: DataFrame, keys: list[str], score: str, output: str) -> DataFrame:
    """DENSE_RANK over distinct scores: at most 1,001 rows per partition."""
    order = Window.partitionBy(*keys).orderBy(F.desc(score))
    return scored.select(*keys, score).distinct().withColumn(output, F.dense_rank().over(order))


def route_service_intelligence(w: Warehouse, summary: DataFrame | None = None) -> DataFrame:
    """Scores and ranks of routes. ``summary`` is a stored route summary, if there is one."""
    score = "scheduled_service_score"
    if summary is None:
        summary = settled(route_summary(w), "route-summary")
    scored = _scored(summary, ROUTE_WEIGHTS, score)
    network = ["snapshot_key"]
    mode = ["snapshot_key", "transport_mode"]
    headway = F.col("average_headway_minutes")
    frequency = F.when(headway.isNull(), NO_HEADWAY)
    for limit, name in HEADWAY_BANDS:
        frequency = frequency.when(headway <= limit, name)
    columns = [
        *ROUTE_ATTRIBUTES, "first_service_date", "last_service_date", "service_day_count",
        "total_scheduled_trips", "total_scheduled_stop_events", "maximum_daily_trips",
        "average_daily_trips", "average_daily_unique_stops", "maximum_daily_unique_stops",
        "average_service_span_minutes", "average_headway_minutes",
        *[output for _, output, _ in ROUTE_WEIGHTS], score,
        "network_service_rank", "mode_service_rank",
    ]
    return (
        scored.join(
            F.broadcast(_score_ranks(scored, network, score, "network_service_rank")),
            [*network, score],
        )
        .join(
            F.broadcast(_score_ranks(scored, mode, score, "mode_service_rank")), [*mode, score]
        )
        .select(
            *columns,
            _banded(F.col(score), ROUTE_BANDS, ROUTE_LOWEST_BAND).alias("scheduled_service_band"),
            frequency.otherwise(LONG_HEADWAY).alias("frequency_band"),
        )
    )


def stop_service_intelligence(w: Warehouse, summary: DataFrame | None = None) -> DataFrame:
    """Scores and ranks of stops. ``summary`` is a stored stop summary, if there is one."""
    score = "scheduled_activity_score"
    if summary is None:
        summary = settled(stop_summary(w), "stop-summary")
    scored = _scored(summary, STOP_WEIGHTS, score)
    columns = [
        "snapshot_key", "stop_key", "stop_id", "stop_code", "stop_name", "stop_latitude",
        "stop_longitude", "zone_id", "location_type", "parent_station_id",
        "wheelchair_boarding", "accessibility_status", "first_service_date",
        "last_service_date", "service_day_count", "total_scheduled_trips",
        "average_daily_trips", "maximum_daily_routes", "average_daily_routes",
        "average_service_span_minutes", "average_headway_minutes",
        *[output for _, output, _ in STOP_WEIGHTS], score, "network_activity_rank",
    ]
    return scored.join(
        F.broadcast(_score_ranks(scored, ["snapshot_key"], score, "network_activity_rank")),
        ["snapshot_key", score],
    ).select(
        *columns,
        _banded(F.col(score), STOP_BANDS, STOP_LOWEST_BAND).alias("scheduled_activity_band"),
    )


def location_summary(w: Warehouse, summary: DataFrame | None = None) -> DataFrame:
    status = F.col("accessibility_status")
    return (
        (summary or stop_summary(w))
        .withColumn("location_group", F.coalesce(cleaned("zone_id"), F.lit("UNASSIGNED")))
        .groupBy("snapshot_key", "location_group")
        .agg(
            F.count("*").alias("stop_count"),
            F.sum("total_scheduled_trips").alias("total_scheduled_trips"),
            average_2dp("average_daily_trips").alias("average_stop_daily_trips"),
            average_2dp("average_daily_routes").alias("average_route_choice"),
            F.count_if(status == "Accessible").alias("accessible_stop_count"),
            F.count_if(status == "Not accessible").alias("inaccessible_stop_count"),
            F.count_if(status == "Unknown").alias("unknown_accessibility_count"),
            average_6dp("stop_latitude").alias("centre_latitude"),
            average_6dp("stop_longitude").alias("centre_longitude"),
        )
    )


def stop_location_changes(w: Warehouse) -> DataFrame:
    moved = w.changes.where(
        (F.col("entity_type") == "STOP") & (F.col("change_type") == "MODIFIED")
    ).select(
        "publication_change_key", "previous_snapshot_key", "current_snapshot_key",
        F.col("entity_id").alias("stop_id"), "detected_at_utc",
    )

    def version(prefix: str) -> DataFrame:
        return w.dim_stop.select(
            "stop_id",
            F.col("stop_name").alias(f"{prefix}_stop_name"),
            F.col("stop_latitude").alias(f"{prefix}_latitude"),
            F.col("stop_longitude").alias(f"{prefix}_longitude"),
            F.col("valid_from_snapshot_key").alias(f"{prefix}_from"),
            F.col("valid_to_snapshot_key").alias(f"{prefix}_to"),
        )

    def valid(prefix: str) -> Column:
        key = F.col(f"{prefix}_snapshot_key")
        closed = F.col(f"{prefix}_to")
        return (F.col(f"{prefix}_from") <= key) & (closed.isNull() | (closed > key))

    distance = geodesic_metres(
        F.col("previous_latitude"), F.col("previous_longitude"),
        F.col("current_latitude"), F.col("current_longitude"),
    )
    return (
        moved.join(version("previous"), "stop_id")
        .where(valid("previous"))
        .join(version("current"), "stop_id")
        .where(valid("current"))
        .where(
            (F.col("previous_latitude") != F.col("current_latitude"))
            | (F.col("previous_longitude") != F.col("current_longitude"))
        )
        .select(
            "publication_change_key", "previous_snapshot_key", "current_snapshot_key", "stop_id",
            "previous_stop_name", "current_stop_name", "previous_latitude", "previous_longitude",
            "current_latitude", "current_longitude",
            F.round(distance, 2).cast("decimal(18,2)").alias("location_change_metres"),
            "detected_at_utc",
        )
    )


def pipeline_health(w: Warehouse, as_of: str) -> DataFrame:
    """Latest state and recent history per pipeline.

    ``row_number`` up to a bound is a per-group limit, which Spark applies
    before the shuffle, so one busy pipeline does not pile up in one task.
    """
    recency = Window.partitionBy("pipeline_name").orderBy(
        F.desc("started_at_utc"), F.desc("pipeline_run_key")
    )
    recent = w.runs.withColumn("recency_rank", F.row_number().over(recency)).where(
        F.col("recency_rank") <= HEALTH_WINDOW_RUNS
    )
    latest_columns = (
        "pipeline_run_key", "snapshot_key", "orchestrator", "run_status", "started_at_utc",
        "completed_at_utc", "rows_read", "rows_loaded", "rows_rejected", "error_message",
    )
    status = F.col("run_status")
    succeeded = F.count_if(status == "SUCCEEDED")
    history = recent.groupBy("pipeline_name").agg(
        F.min_by(F.struct(*latest_columns), "recency_rank").alias("latest"),
        F.count("*").alias("recent_run_count"),
        succeeded.alias("recent_success_count"),
        F.count_if(status == "FAILED").alias("recent_failure_count"),
        F.round(succeeded.cast("decimal(12,0)") * 100 / F.count("*").cast("decimal(12,0)"), 2)
        .cast("decimal(5,2)")
        .alias("recent_success_rate_pct"),
    )
    latest_status = F.col("latest.run_status")
    rate = F.col("recent_success_rate_pct")
    health = (
        F.when(latest_status == "STARTED", "RUNNING")
        .when(latest_status == "FAILED", "ACTION REQUIRED")
        .when((latest_status == "SUCCEEDED") & (F.col("recent_failure_count") > 0), "RECOVERED")
        .when(rate >= 95, "HEALTHY")
        .otherwise("WATCH")
    )
    duration = milliseconds_crossed(
        F.col("latest.started_at_utc"),
        F.coalesce(F.col("latest.completed_at_utc"), moment(as_of)),
    )
    return history.select(
        "pipeline_name",
        F.col("latest.pipeline_run_key").alias("latest_pipeline_run_key"),
        F.col("latest.snapshot_key").alias("latest_snapshot_key"),
        "latest.orchestrator",
        latest_status.alias("latest_run_status"),
        F.col("latest.started_at_utc").alias("latest_started_at_utc"),
        F.col("latest.completed_at_utc").alias("latest_completed_at_utc"),
        duration.alias("latest_duration_milliseconds"),
        F.col("latest.rows_read").alias("latest_rows_read"),
        F.col("latest.rows_loaded").alias("latest_rows_loaded"),
        F.col("latest.rows_rejected").alias("latest_rows_rejected"),
        F.col("latest.error_message").alias("latest_error_message"),
        "recent_run_count", "recent_success_count", "recent_failure_count",
        "recent_success_rate_pct",
        health.alias("pipeline_health_status"),
    )


def dashboard_kpis(
    w: Warehouse,
    as_of: str,
    routes: DataFrame | None = None,
    stops: DataFrame | None = None,
) -> DataFrame:
    """One executive row. Each source view is aggregated once, as one struct.

    ``routes`` and ``stops`` are stored intelligence views, if there are any.
    """
    if routes is None:
        routes = route_service_intelligence(w)
    if stops is None:
        stops = stop_service_intelligence(w)
    route_figures = routes.agg(
        F.struct(
            F.count_if(F.col("scheduled_service_band").isin("VERY HIGH", "HIGH")).alias("strong"),
            F.count_if(F.col("frequency_band") == "HIGH FREQUENCY").alias("frequent"),
            F.min_by(
                F.struct("route_display_name", "scheduled_service_score"),
                F.struct("network_service_rank", "route_id"),
            ).alias("leading"),
        ).alias("routes")
    ).scalar()
    stop_figures = stops.agg(
        F.struct(
            F.count_if(F.col("scheduled_activity_band") == "MAJOR HUB").alias("hubs"),
            F.count_if(F.col("accessibility_status") == "Accessible").alias("accessible"),
            F.min_by(
                F.struct("stop_name", "scheduled_activity_score"),
                F.struct("network_activity_rank", "stop_id"),
            ).alias("leading"),
        ).alias("stops")
    ).scalar()
    health = F.col("pipeline_health_status")
    pipelines = pipeline_health(w, as_of).agg(
        F.struct(
            F.count_if(health == "HEALTHY").alias("healthy"),
            F.count_if(health == "RECOVERED").alias("recovered"),
            F.count_if(health.isin("HEALTHY", "RECOVERED")).alias("ready"),
            F.count_if(health == "ACTION REQUIRED").alias("action"),
            F.count_if(health == "RUNNING").alias("running"),
            F.count("*").alias("monitored"),
        ).alias("pipelines")
    ).scalar()
    return (
        platform_summary(w, as_of)
        .withColumns(
            {"_routes": route_figures, "_stops": stop_figures, "_pipelines": pipelines}
        )
        .select(
            "snapshot_key", "downloaded_at_utc", "data_age_hours", "freshness_status",
            "reporting_start_date", "reporting_end_date", "operator_count", "route_count",
            "stop_count", "trip_count", "scheduled_stop_event_count", "publication_change_count",
            F.col("_routes.strong").alias("strong_service_route_count"),
            F.col("_routes.frequent").alias("high_frequency_route_count"),
            F.col("_stops.hubs").alias("major_hub_count"),
            F.col("_stops.accessible").alias("accessible_stop_count"),
            F.col("_routes.leading.route_display_name").alias("leading_route"),
            F.col("_routes.leading.scheduled_service_score").alias("leading_route_score"),
            F.col("_stops.leading.stop_name").alias("leading_stop"),
            F.col("_stops.leading.scheduled_activity_score").alias("leading_stop_score"),
            F.col("_pipelines.healthy").alias("healthy_pipeline_count"),
            F.col("_pipelines.recovered").alias("recovered_pipeline_count"),
            F.col("_pipelines.ready").alias("service_ready_pipeline_count"),
            F.col("_pipelines.action").alias("action_required_pipeline_count"),
            F.col("_pipelines.running").alias("running_pipeline_count"),
            F.col("_pipelines.monitored").alias("monitored_pipeline_count"),
            "last_successful_pipeline_at_utc",
        )
    )
