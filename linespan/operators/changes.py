"""Publication comparison."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linespan.functions.columns import differs, packed_hash, unpacked_hash
from linespan.operators.history import absent_rows, versions_by_key
from linespan.schemas import ENTITY_STAGES

CHANGE_KEYS = ("previous_snapshot_key", "current_snapshot_key", "entity_type", "entity_id")
CHANGE_COMPARE = ("change_type", "previous_row_hash", "current_row_hash")


def succeeded_entity_stages(runs: DataFrame) -> DataFrame:
    """Number of distinct entity stages that succeeded, per publication."""
    return (
        runs.where(F.col("run_status") == "SUCCEEDED")
        .where(F.col("pipeline_name").isin(*ENTITY_STAGES))
        .groupBy("snapshot_key")
        .agg(F.countDistinct("pipeline_name").alias("stage_count"))
    )


def previous_snapshot(snapshots: DataFrame, runs: DataFrame, current_snapshot_key: int) -> DataFrame:
    """The latest earlier LOADED publication whose entity stages all succeeded."""
    complete = succeeded_entity_stages(runs).where(F.col("stage_count") == len(ENTITY_STAGES))
    return (
        snapshots.where(F.col("snapshot_key") < current_snapshot_key)
        .where(F.col("snapshot_status") == "LOADED")
        .join(complete, "snapshot_key", "left_semi")
        .orderBy(F.desc("downloaded_at_utc"), F.desc("snapshot_key"))
        .limit(1)
        .select("snapshot_key", "downloaded_at_utc")
    )


def entity_state(
    operators: DataFrame,
    routes: DataFrame,
    stops: DataFrame,
    services: DataFrame,
    trips: DataFrame,
    snapshot_key: int,
) -> DataFrame:
    """Type, id and hash of every entity a publication holds."""

    def typed(rows: DataFrame, kind: str, identifier: str) -> DataFrame:
        return rows.select(
            F.lit(kind).alias("entity_type"), F.col(identifier).alias("entity_id"), "row_hash"
        )

    own = F.col("snapshot_key") == snapshot_key
    return reduce(
        DataFrame.unionByName,
        [
            typed(versions_by_key(operators, snapshot_key), "OPERATOR", "agency_id"),
            typed(versions_by_key(routes, snapshot_key), "ROUTE", "route_id"),
            typed(versions_by_key(stops, snapshot_key), "STOP", "stop_id"),
            typed(services.where(own), "SERVICE", "service_id"),
            typed(trips.where(own), "TRIP", "trip_id"),
        ],
    )


def publication_changes(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Entities added, removed or modified between two states."""
    keys = ["entity_type", "entity_id"]
    old = previous.select(*keys, *packed_hash("row_hash", "_previous"))
    new = current.select(*keys, *packed_hash("row_hash", "_current"))
    before, after = (
        unpacked_hash(f"_{side}").alias(f"{side}_row_hash") for side in ("previous", "current")
    )
    change = (
        F.when(before.isNull(), "ADDED").when(after.isNull(), "REMOVED").otherwise("MODIFIED")
    )
    unequal = differs("_previous_packed_hash", "_current_packed_hash") | differs(
        "_previous_other_hash", "_current_other_hash"
    )
    return (
        old.join(new, keys, "full_outer")
        .where(unequal)
        .select(*keys, change.alias("change_type"), before, after)
    )


def publication_change_counts(
    previous: DataFrame, current: DataFrame, changes: DataFrame
) -> DataFrame:
    """One row of entity totals and change totals."""
    kind = F.col("change_type")
    return changes.agg(
        F.count("*").alias("changes_detected"),
        F.count_if(kind == "ADDED").alias("added_changes"),
        F.count_if(kind == "REMOVED").alias("removed_changes"),
        F.count_if(kind == "MODIFIED").alias("modified_changes"),
    ).select(
        previous.select(F.count("*")).scalar().alias("previous_entity_rows"),
        current.select(F.count("*")).scalar().alias("current_entity_rows"),
        "changes_detected",
        "added_changes",
        "removed_changes",
        "modified_changes",
    )


def publication_bootstrap(current: DataFrame, snapshot_key: int) -> DataFrame:
    """Result row for the first publication: nothing to compare with."""
    zero = F.lit(0).cast("bigint")
    return current.agg(F.count("*").alias("current_entity_rows")).select(
        F.lit(None).cast("bigint").alias("previous_snapshot_key"),
        F.lit(snapshot_key).cast("bigint").alias("current_snapshot_key"),
        zero.alias("previous_entity_rows"),
        "current_entity_rows",
        zero.alias("changes_detected"),
        zero.alias("changes_inserted"),
    )


def change_rows(changes: DataFrame, previous_key: int, current_key: int, detected_at: str) -> DataFrame:
    """Detected changes shaped like the change log."""
    return changes.select(
        F.concat_ws(
            ":",
            F.lit(previous_key).cast("string"),
            F.lit(current_key).cast("string"),
            "entity_type",
            "entity_id",
        ).alias("publication_change_key"),
        F.lit(previous_key).cast("bigint").alias("previous_snapshot_key"),
        F.lit(current_key).cast("bigint").alias("current_snapshot_key"),
        "entity_type",
        "entity_id",
        "change_type",
        F.when(F.col("change_type") == "MODIFIED", "published_attributes").alias("changed_fields"),
        "previous_row_hash",
        "current_row_hash",
        F.lit(None).cast("string").alias("change_details_json"),
        F.lit(detected_at).cast("timestamp_ntz").alias("detected_at_utc"),
    )


def fact_publication_change(stored: DataFrame | None, detected: DataFrame) -> DataFrame:
    """Change log with the newly detected rows appended."""
    if stored is None:
        return detected
    return stored.unionByName(absent_rows(detected, stored, CHANGE_KEYS))
