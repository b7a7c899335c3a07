"""Service definitions and the dates each service runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linespan.functions.columns import (
    cleaned,
    date_key,
    feed_date,
    small_number,
    trimmed,
    version_key,
)
from linespan.operators.history import insert_if_absent

WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
CALENDAR = "CALENDAR"
EXCEPTION_ADDED = "EXCEPTION_ADDED"
DATE_ADDED = 1


def exception_source(calendar_dates: DataFrame) -> DataFrame:
    return calendar_dates.select(
        trimmed("service_id").alias("service_id"),
        feed_date("date").alias("service_date"),
        small_number("exception_type").alias("exception_type"),
    )


def service_source(calendar: DataFrame, exceptions: DataFrame) -> DataFrame:
    """Calendar services, plus services known only through added dates."""
    regular = calendar.select(
        trimmed("service_id").alias("service_id"),
        *[(trimmed(day) == "1").alias(day) for day in WEEKDAYS],
        feed_date("start_date").alias("start_date"),
        feed_date("end_date").alias("end_date"),
        "row_hash",
    )
    first, last = F.col("start_date"), F.col("end_date")
    exception_only = (
        exceptions.where(F.col("exception_type") == DATE_ADDED)
        .groupBy("service_id")
        .agg(F.min("service_date").alias("start_date"), F.max("service_date").alias("end_date"))
        .join(regular.select("service_id"), "service_id", "left_anti")
        .select(
            "service_id",
            *[F.lit(False).alias(day) for day in WEEKDAYS],
            first,
            last,
            F.sha2(
                F.concat_ws(
                    "|",
                    "service_id",
                    F.lit("EXCEPTION_ONLY"),
                    date_key(first).cast("string"),
                    date_key(last).cast("string"),
                ),
                256,
            ).alias("row_hash"),
        )
    )
    return regular.unionByName(exception_only)


def dim_service(target: DataFrame | None, source: DataFrame, snapshot_key: int) -> DataFrame:
    """Service rows of one publication, added where absent."""
    rows = source.select(
        F.lit(snapshot_key).cast("bigint").alias("snapshot_key"),
        version_key(snapshot_key, "service_id").alias("service_key"),
        *source.columns,
    )
    return insert_if_absent(target, rows, ("snapshot_key", "service_id"))


def _bridge_columns(rows: DataFrame, activation: str) -> DataFrame:
    return rows.select(
        "snapshot_key",
        "service_key",
        "service_id",
        date_key("full_date").alias("date_key"),
        "full_date",
        F.lit(activation).alias("activation_source"),
    )


def service_calendar_dates(services: DataFrame, exceptions: DataFrame, dates: DataFrame) -> DataFrame:
    """Dates of the weekday pattern that carry no exception of any type.

    Exceptions are folded to one date set per service first, so the join runs
    on services rather than on expanded service days. A set holds at most the
    days of the publication. ``dates`` has one row per day, so it is small by
    nature and is broadcast.
    """
    excluded = exceptions.groupBy("service_id").agg(
        F.collect_set("service_date").alias("excluded_dates")
    )
    pattern = F.array(*[F.col(day) for day in WEEKDAYS])
    span = F.sequence("start_date", "end_date")
    days = (
        services.join(excluded, "service_id", "left")
        .withColumn("pattern", pattern)
        .select(
            "snapshot_key",
            "service_key",
            "service_id",
            "pattern",
            F.explode(
                F.when(F.col("excluded_dates").isNull(), span).otherwise(
                    F.array_except(span, "excluded_dates")
                )
            ).alias("full_date"),
        )
        .where(F.get("pattern", F.weekday("full_date")))
    )
    known = days.join(F.broadcast(dates.select("full_date")), "full_date", "left_semi")
    return _bridge_columns(known, CALENDAR)


def service_added_dates(services: DataFrame, exceptions: DataFrame, dates: DataFrame) -> DataFrame:
    """Every added date, whether or not the weekday pattern also holds."""
    added = (
        exceptions.where(F.col("exception_type") == DATE_ADDED)
        .select("service_id", F.col("service_date").alias("full_date"))
        .join(F.broadcast(dates.select("full_date")), "full_date", "left_semi")
        .join(services.select("snapshot_key", "service_key", "service_id"), "service_id")
    )
    return _bridge_columns(added, EXCEPTION_ADDED)


def bridge_service_date(services: DataFrame, exceptions: DataFrame, dates: DataFrame) -> DataFrame:
    """All dates each service of one publication runs."""
    return service_calendar_dates(services, exceptions, dates).unionByName(
        service_added_dates(services, exceptions, dates)
    )


def bridge_batch(date: Column) -> Column:
    """The month of a service day, by which the stored bridge is cut."""
    return F.date_format(date, "yyyy-MM")


def bridge_sync(stored: DataFrame, desired: DataFrame) -> DataFrame:
    """Per service day, what must happen to make the stored bridge equal the desired one.

    ``sync_action`` is KEEP, INSERT, DELETE or REPLACE; a replaced row counts
    as one deletion and one insertion.
    """
    keys = ["snapshot_key", "service_key", "date_key"]
    left = stored.select(*keys, F.col("activation_source").alias("stored_source"))
    right = desired.select(*keys, F.col("activation_source").alias("desired_source"))
    action = (
        F.when(F.col("stored_source").isNull(), "INSERT")
        .when(F.col("desired_source").isNull(), "DELETE")
        .when(F.col("stored_source") != F.col("desired_source"), "REPLACE")
        .otherwise("KEEP")
    )
    return left.join(right, keys, "full_outer").withColumn("sync_action", action)


def bridge_sync_counts(actions: DataFrame) -> DataFrame:
    action = F.col("sync_action")
    return actions.agg(
        F.count_if(action != "DELETE").alias("service_date_rows_derived"),
        F.count_if(action.isin("INSERT", "REPLACE")).alias("service_date_rows_inserted"),
        F.count_if(action.isin("DELETE", "REPLACE")).alias("service_date_rows_deleted"),
    )


def changed_batches(actions: DataFrame) -> list[str]:
    """Batches that hold a service day to insert, delete or replace; one value a month."""
    day = F.to_date(F.col("date_key").cast("string"), "yyyyMMdd")
    rows = actions.where("sync_action <> 'KEEP'").select(bridge_batch(day).alias("batch")).distinct()
    return sorted(row.batch for row in rows.collect())


def available_shapes(shapes: DataFrame) -> DataFrame:
    return shapes.select(cleaned("shape_id").alias("shape_id")).where(
        "shape_id IS NOT NULL"
    ).distinct()
