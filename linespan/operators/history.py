"""Versioned dimensions: Type 2 merge, as-of lookup, insert-if-absent."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linespan.functions.columns import differs, packed_hash, unpacked_hash, version_key

VALIDITY = ("valid_from_snapshot_key", "valid_to_snapshot_key", "is_current")


def _opened(source: DataFrame, snapshot_key: int, key: str, surrogate: str) -> DataFrame:
    return source.select(
        version_key(snapshot_key, key).alias(surrogate),
        *source.columns,
        F.lit(snapshot_key).cast("bigint").alias("valid_from_snapshot_key"),
        F.lit(None).cast("bigint").alias("valid_to_snapshot_key"),
        F.lit(True).alias("is_current"),
    )


def scd2_merge(
    target: DataFrame | None,
    source: DataFrame,
    *,
    key: str,
    surrogate: str,
    snapshot_key: int,
    compare: Sequence[str] = ("row_hash",),
) -> DataFrame:
    """Return the dimension after loading ``source`` as publication ``snapshot_key``.

    A current version closes when its key is gone or any ``compare`` column
    differs; a key without a current version opens one. Unchanged versions and
    older history pass through. One full outer join does all of it: each joined
    pair yields the version to keep or close and, where needed, the new one.
    """
    opened = _opened(source, snapshot_key, key, surrogate)
    if target is None:
        return opened
    columns = opened.columns
    target = target.select(*columns)

    old = target.where("is_current").select(F.struct(*columns).alias("old"))
    new = opened.select(F.struct(*columns).alias("new"))
    pairs = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")

    changed = reduce(
        lambda left, right: left | right,
        [differs(f"old.{name}", f"new.{name}") for name in compare],
    )
    closes = F.col("old").isNotNull() & (F.col("new").isNull() | changed)
    opens = F.col("new").isNotNull() & (F.col("old").isNull() | changed)
    closed = F.struct(
        *[
            F.lit(snapshot_key).cast("bigint").alias(name)
            if name == "valid_to_snapshot_key"
            else F.lit(False).alias(name)
            if name == "is_current"
            else F.col(f"old.{name}").alias(name)
            for name in columns
        ]
    )
    kept = F.when(closes, closed).otherwise(F.col("old"))
    versions = F.array_compact(F.array(kept, F.when(opens, F.col("new"))))
    current = pairs.select(F.inline(versions))
    return target.where("NOT is_current").unionByName(current)


def merge_counts(merged: DataFrame, snapshot_key: int) -> DataFrame:
    """Rows opened and closed by the load of one publication."""
    return merged.agg(
        F.count_if(F.col("valid_from_snapshot_key") == snapshot_key).alias("rows_inserted"),
        F.count_if(F.col("valid_to_snapshot_key") == snapshot_key).alias("rows_closed"),
    )


def current_versions(dimension: DataFrame) -> DataFrame:
    return dimension.where("is_current")


def downloaded_at(snapshots: DataFrame, snapshot_key: int) -> Column:
    """Download time of one publication, as a scalar subquery."""
    return (
        snapshots.where(F.col("snapshot_key") == snapshot_key)
        .select(F.max("downloaded_at_utc"))
        .scalar()
    )


def versions_by_download(
    dimension: DataFrame, snapshots: DataFrame, snapshot_key: int
) -> DataFrame:
    """Versions valid at a publication, ordered by download time."""
    registry = snapshots.select("snapshot_key", "downloaded_at_utc")
    moment = downloaded_at(snapshots, snapshot_key)
    opened = registry.select(
        F.col("snapshot_key").alias("valid_from_snapshot_key"),
        F.col("downloaded_at_utc").alias("opened_at"),
    )
    closed = registry.select(
        F.col("snapshot_key").alias("valid_to_snapshot_key"),
        F.col("downloaded_at_utc").alias("closed_at"),
    )
    return (
        dimension.join(opened, "valid_from_snapshot_key")
        .join(closed, "valid_to_snapshot_key", "left")
        .where(F.col("opened_at") <= moment)
        .where(F.col("closed_at").isNull() | (moment < F.col("closed_at")))
        .select(*dimension.columns)
    )


def versions_by_key(dimension: DataFrame, snapshot_key: Column | int) -> DataFrame:
    """Versions valid at a publication, ordered by snapshot key."""
    key = F.lit(snapshot_key) if isinstance(snapshot_key, int) else snapshot_key
    return dimension.where(
        (F.col("valid_from_snapshot_key") <= key)
        & (F.col("valid_to_snapshot_key").isNull() | (F.col("valid_to_snapshot_key") > key))
    )


def absent_rows(source: DataFrame, target: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key is not stored yet."""
    if target is None:
        return source
    return source.join(target.select(*keys), list(keys), "left_anti").select(*source.columns)


def insert_if_absent(
    target: DataFrame | None, source: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Stored rows plus the source rows whose key is not stored yet."""
    if target is None:
        return source
    return target.unionByName(absent_rows(source, target, keys))


def conflicting_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str],
    *,
    missing_conflicts: bool,
) -> DataFrame:
    """Stored rows that disagree with the source on any compared column.

    With ``missing_conflicts`` a stored row without a source row also counts.
    A compared row hash is packed on both sides before the join moves it.
    """
    columns = [F.col(c) for c in target.columns]
    if "row_hash" in compare:
        compare = ["_packed_hash", "_other_hash", *[c for c in compare if c != "row_hash"]]
        columns = [unpacked_hash().alias(c) if c == "row_hash" else F.col(c) for c in target.columns]
        target = target.select("*", *packed_hash("row_hash")).drop("row_hash")
        source = source.select("*", *packed_hash("row_hash")).drop("row_hash")
    right = source.select(
        *keys, F.lit(True).alias("_found"), *[F.col(c).alias(f"_source_{c}") for c in compare]
    )
    joined = target.join(right, list(keys), "left" if missing_conflicts else "inner")
    unequal = reduce(
        lambda left, other: left | other, [differs(c, f"_source_{c}") for c in compare]
    )
    if missing_conflicts:
        unequal = F.col("_found").isNull() | unequal
    return joined.where(unequal).select(*columns)
