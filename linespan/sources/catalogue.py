"""Publication registry: registration, gate and status."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linespan.schemas import STAGE_EXPORT
from linespan.sources.landing import first_feed_info, utc_moment

RECEIVED, VALIDATED, LOADED = "RECEIVED", "VALIDATED", "LOADED"


def snapshot_register(
    landed: DataFrame,
    feed_info: DataFrame,
    registered: DataFrame,
    source_name: str,
) -> DataFrame:
    """Registry rows for publications whose SHA-256 is not registered yet.

    ``landed`` has file identity and sidecar columns, one row per archive. New
    keys continue after the highest one, in order of download: publications are
    numbered within their day, after the count of those of earlier days.
    """
    fresh = landed.join(registered.select("sha256"), "sha256", "left_anti")
    downloaded = utc_moment(F.col("downloaded_at_utc"))
    rows = (
        fresh.withColumn("downloaded_at_utc", downloaded)
        .groupBy("sha256")
        .agg(F.min_by(F.struct(*[c for c in fresh.columns if c != "sha256"]),
                      "downloaded_at_utc").alias("first"))
        .select("sha256", "first.*")
    )
    highest = registered.select(F.coalesce(F.max("snapshot_key"), F.lit(0))).scalar()
    dated = rows.withColumn("_day", F.to_date("downloaded_at_utc"))
    earlier = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        dated.groupBy("_day").agg(F.count("*").alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .select(F.col("_day").alias("_of_day"), "_before")
    )
    inside = Window.partitionBy("_day").orderBy("downloaded_at_utc", "sha256")
    return (
        dated.join(before, F.col("_day").eqNullSafe(F.col("_of_day")))
        .join(first_feed_info(feed_info), "sha256", "left")
        .withColumn("snapshot_key", highest + F.col("_before") + F.row_number().over(inside))
        .select(
            F.col("snapshot_key").cast("bigint").alias("snapshot_key"),
            F.lit(source_name).alias("source_name"),
            "source_url",
            "downloaded_at_utc",
            utc_moment(F.col("last_modified")).alias("source_last_modified_utc"),
            F.nullif("etag", F.lit("")).alias("source_etag"),
            "file_name",
            "file_size_bytes",
            "sha256",
            "feed_start_date",
            "feed_end_date",
            "feed_version",
            F.lit(RECEIVED).alias("snapshot_status"),
        )
    )


def snapshot_gate(
    landed: DataFrame, registered: DataFrame, runs: DataFrame, force: bool = False
) -> DataFrame:
    """What to do with each landed publication.

    NEW when it is not registered, RESUME when registered without a succeeded
    export, else SKIP; ``force`` turns SKIP and RESUME into FORCED.
    """
    exported = (
        runs.where(
            (F.col("pipeline_name") == STAGE_EXPORT) & (F.col("run_status") == "SUCCEEDED")
        )
        .select("snapshot_key")
        .distinct()
        .withColumn("exported", F.lit(True))
    )
    known = registered.select("sha256", "snapshot_key").join(exported, "snapshot_key", "left")
    action = (
        F.when(F.col("snapshot_key").isNull(), "NEW")
        .when(F.lit(force), "FORCED")
        .when(F.col("exported"), "SKIP")
        .otherwise("RESUME")
    )
    return landed.select("sha256").join(known, "sha256", "left").select(
        "sha256", "snapshot_key", action.alias("action")
    )


def snapshot_status(events: DataFrame) -> DataFrame:
    """Latest status per publication from status events."""
    return events.groupBy("snapshot_key").agg(
        F.max_by("snapshot_status", F.struct("changed_at_utc", "event_number")).alias(
            "snapshot_status"
        )
    )


def loaded_snapshots(registered: DataFrame, events: DataFrame) -> DataFrame:
    """Registry with the latest status of each publication."""
    status = snapshot_status(events)
    return registered.drop("snapshot_status").join(status, "snapshot_key", "left").select(
        *[c for c in registered.columns if c != "snapshot_status"],
        F.coalesce("snapshot_status", F.lit(RECEIVED)).alias("snapshot_status"),
    )
