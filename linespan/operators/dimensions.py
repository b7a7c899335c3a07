"""Dates, operators, routes, stops and trips from staged feed rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linespan.functions.columns import (
    cleaned,
    coordinate,
    date_key,
    feed_date,
    packed_hash,
    small_number,
    trimmed,
    unpacked_hash,
    version_key,
)
from linespan.operators.history import current_versions, scd2_merge


def staged_dates(feed_info_dates: DataFrame, calendar: DataFrame, exceptions: DataFrame) -> DataFrame:
    """Every date a publication mentions, one column ``source_date``."""
    parts = [
        feed_info_dates.select(F.col("feed_start_date").alias("source_date")),
        feed_info_dates.select(F.col("feed_end_date")),
        calendar.select(feed_date("start_date")),
        calendar.select(feed_date("end_date")),
        exceptions.select(feed_date("date")),
    ]
    return reduce(DataFrame.union, parts).where("source_date IS NOT NULL")


def date_bounds(snapshot: DataFrame, calendar: DataFrame, exceptions: DataFrame) -> DataFrame:
    """First and last date a publication mentions; ``snapshot`` is its registry row."""
    return staged_dates(snapshot, calendar, exceptions).agg(
        F.min("source_date").alias("minimum_date"), F.max("source_date").alias("maximum_date")
    )


def dim_date(bounds: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Date rows for the bounds that are not stored yet."""
    days = bounds.where("minimum_date IS NOT NULL").select(
        F.explode(F.sequence("minimum_date", "maximum_date")).alias("full_date")
    )
    day = F.col("full_date")
    weekday = F.weekday(day) + 1
    rows = days.select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).alias("calendar_year"),
        F.quarter(day).alias("calendar_quarter"),
        F.month(day).alias("calendar_month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day_of_month"),
        weekday.alias("day_of_week_iso"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.weekofyear(day).alias("week_of_year"),
        weekday.isin(6, 7).alias("is_weekend"),
    )
    if existing is None:
        return rows
    return rows.join(existing.select("full_date"), "full_date", "left_anti").select(*rows.columns)


def operator_source(agency: DataFrame) -> DataFrame:
    return agency.select(
        trimmed("agency_id").alias("agency_id"),
        cleaned("agency_noc").alias("agency_noc"),
        trimmed("agency_name").alias("operator_name"),
        cleaned("agency_url").alias("operator_url"),
        cleaned("agency_timezone").alias("operator_timezone"),
        cleaned("agency_lang").alias("operator_language"),
        cleaned("agency_phone").alias("operator_phone"),
        cleaned("agency_email").alias("operator_email"),
        "row_hash",
    )


def scd2_operator(target: DataFrame | None, source: DataFrame, snapshot_key: int) -> DataFrame:
    return scd2_merge(
        target, source, key="agency_id", surrogate="operator_key", snapshot_key=snapshot_key
    )


def route_source(routes: DataFrame, operators: DataFrame) -> DataFrame:
    """Typed routes resolved to the current operator version."""
    resolved = current_versions(operators).select("agency_id", "operator_key")
    return (
        routes.withColumn("agency_id", trimmed("agency_id"))
        .join(resolved, "agency_id")
        .select(
            trimmed("route_id").alias("route_id"),
            "operator_key",
            cleaned("route_short_name").alias("route_short_name"),
            cleaned("route_long_name").alias("route_long_name"),
            cleaned("route_desc").alias("route_description"),
            small_number("route_type").alias("route_type"),
            cleaned("route_url").alias("route_url"),
            F.upper(cleaned("route_color")).alias("route_colour"),
            F.upper(cleaned("route_text_color")).alias("route_text_colour"),
            "row_hash",
        )
    )


def scd2_route(target: DataFrame | None, source: DataFrame, snapshot_key: int) -> DataFrame:
    """A route also opens a new version when its operator version changed."""
    return scd2_merge(
        target,
        source,
        key="route_id",
        surrogate="route_key",
        snapshot_key=snapshot_key,
        compare=("row_hash", "operator_key"),
    )


def stop_source(stops: DataFrame) -> DataFrame:
    return stops.select(
        trimmed("stop_id").alias("stop_id"),
        cleaned("stop_code").alias("stop_code"),
        trimmed("stop_name").alias("stop_name"),
        cleaned("stop_desc").alias("stop_description"),
        coordinate("stop_lat").alias("stop_latitude"),
        coordinate("stop_lon").alias("stop_longitude"),
        cleaned("zone_id").alias("zone_id"),
        cleaned("stop_url").alias("stop_url"),
        small_number(cleaned("location_type")).alias("location_type"),
        cleaned("parent_station").alias("parent_station_id"),
        small_number(cleaned("wheelchair_boarding")).alias("wheelchair_boarding"),
        "row_hash",
    )


def scd2_stop(target: DataFrame | None, source: DataFrame, snapshot_key: int) -> DataFrame:
    return scd2_merge(
        target, source, key="stop_id", surrogate="stop_key", snapshot_key=snapshot_key
    )


def trip_source(
    trips: DataFrame, route_versions: DataFrame, services: DataFrame, snapshot_key: int
) -> DataFrame:
    """Typed trips resolved to a route version and a service of the same publication.

    ``route_versions`` are the versions valid at this publication and
    ``services`` are its service rows, two short texts each, which are broadcast.
    The join with the routes is left to AQE, which sees the actual sizes; hashes
    are packed before it moves them.
    """
    routes = route_versions.select("route_id", "route_key")
    own_services = services.where(F.col("snapshot_key") == snapshot_key).select(
        "service_id", "service_key"
    )
    own = trips.select(
        trimmed("route_id").alias("route_id"),
        trimmed("service_id").alias("service_id"),
        trimmed("trip_id").alias("trip_id"),
        cleaned("trip_headsign").alias("trip_headsign"),
        cleaned("trip_short_name").alias("trip_short_name"),
        small_number(cleaned("direction_id")).alias("direction_id"),
        cleaned("block_id").alias("block_id"),
        cleaned("shape_id").alias("shape_id"),
        small_number(cleaned("wheelchair_accessible")).alias("wheelchair_accessible"),
        *packed_hash("row_hash"),
    )
    described = own.columns[2:-2]
    return (
        own.join(routes, "route_id")
        .join(F.broadcast(own_services), "service_id")
        .select(
            F.lit(snapshot_key).cast("bigint").alias("snapshot_key"),
            version_key(snapshot_key, "trip_id").alias("trip_key"),
            "route_key",
            "service_key",
            *described,
            unpacked_hash().alias("row_hash"),
        )
    )
