"""Scheduled stop events and shape points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linespan.functions.columns import (
    call_seconds,
    cleaned,
    coordinate,
    distance,
    packed_hash,
    small_number,
    trimmed,
    unpacked_hash,
    whole_number,
)


def _coded(name: str, default: int) -> Column:
    return F.coalesce(small_number(cleaned(name)), F.lit(default).cast("smallint"))


def scheduled_stop_event(
    stop_times: DataFrame, trips: DataFrame, stop_versions: DataFrame, snapshot_key: int
) -> DataFrame:
    """Typed calls resolved to trip and stop version.

    The row also carries the trip's route and service key, so the daily facts
    read events alone and never join the trip table again. Calls are typed and
    their hashes packed before they move: both joins place all calls anew. The
    trip join comes last: a large load is then already placed by trip, its files
    hold whole trips, and the per-trip aggregates shrink before they shuffle.
    """
    own_trips = trips.where(F.col("snapshot_key") == snapshot_key).select(
        "trip_id", "trip_key", "route_key", "service_key"
    )
    stops = stop_versions.select("stop_id", "stop_key")
    calls = stop_times.select(
        trimmed("trip_id").alias("trip_id"),
        trimmed("stop_id").alias("stop_id"),
        whole_number("stop_sequence").alias("stop_sequence"),
        call_seconds("arrival_time").alias("arrival_seconds"),
        call_seconds("departure_time").alias("departure_seconds"),
        cleaned("stop_headsign").alias("stop_headsign"),
        _coded("pickup_type", 0).alias("pickup_type"),
        _coded("drop_off_type", 0).alias("drop_off_type"),
        distance(cleaned("shape_dist_traveled")).alias("shape_dist_travelled"),
        (_coded("timepoint", 1) != 0).alias("is_timepoint"),
        *packed_hash("row_hash"),
    )
    measures = calls.columns[2:-2]
    return (
        calls.join(stops, "stop_id")
        .join(own_trips, "trip_id")
        .select(
            F.lit(snapshot_key).cast("bigint").alias("snapshot_key"),
            "trip_key",
            "route_key",
            "service_key",
            "stop_key",
            *measures,
            unpacked_hash().alias("row_hash"),
        )
    )


def shape_point(shapes: DataFrame, snapshot_key: int) -> DataFrame:
    return shapes.select(
        F.lit(snapshot_key).cast("bigint").alias("snapshot_key"),
        trimmed("shape_id").alias("shape_id"),
        whole_number("shape_pt_sequence").alias("shape_point_sequence"),
        coordinate("shape_pt_lat").alias("shape_point_latitude"),
        coordinate("shape_pt_lon").alias("shape_point_longitude"),
        distance(cleaned("shape_dist_traveled")).alias("shape_dist_travelled"),
    )


SHAPE_KEYS = ("snapshot_key", "shape_id", "shape_point_sequence")
SHAPE_COMPARE = ("shape_point_latitude", "shape_point_longitude", "shape_dist_travelled")
EVENT_KEYS = ("snapshot_key", "trip_key", "stop_sequence")
EVENT_COMPARE = ("row_hash", "route_key", "stop_key")
TRIP_KEYS = ("snapshot_key", "trip_id")
TRIP_COMPARE = ("row_hash", "route_key", "service_key")
