"""From a folder of landed archives to refreshed publications."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linespan import schemas
from linespan.operators.governance import latest_runs
from linespan.plans.refresh import RUN_EVENTS, SNAPSHOTS, run_refresh
from linespan.session import settled
from linespan.sources import catalogue, feed, landing, profile
from linespan.sources.store import Store

PROFILES = "feed_profile"
# Text files of the members unpacked so far: a log of the store, kept by archive hash.
MEMBERS = "landed_member"


class LandingError(ValueError):
    """Raised when an archive lacks its sidecar or a member of the feed."""


def landed_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Identity of every archive with the metadata written beside it."""
    identity = landing.archive_identity(spark, f"{folder}/*.zip")
    sidecars = landing.sidecars(spark, f"{folder}/*.json").drop("file_name", "file_size_bytes")
    landed = settled(identity.join(sidecars, "sha256", "left"), "landed")
    missing = [r.file_name for r in landed.where("downloaded_at_utc IS NULL").select("file_name").collect()]
    if missing:
        raise LandingError(f"no metadata for {', '.join(sorted(missing))}")
    return landed


def stored_or_none(store: Store, table: str, schema: str) -> DataFrame:
    return store.read(table) if store.exists(table) else store.spark.createDataFrame([], schema)


def member_paths(store: Store, archives: DataFrame) -> dict[tuple[str, str], str]:
    """Text file of each member of the archives, by hash and table; those not unpacked yet are.

    ``archives`` are those about to be refreshed. One short row a member comes back.
    """
    spark = store.spark
    known = stored_or_none(store, MEMBERS, landing.MEMBER_SCHEMA)
    fresh = settled(archives.join(known.select("sha256"), "sha256", "left_anti"), "to-unpack")
    if not fresh.isEmpty():
        store.append(MEMBERS, landing.unpacked(spark, fresh, store.path("landed_text")))
    held = store.read(MEMBERS).join(archives.select("sha256").distinct(), "sha256", "left_semi")
    return {(r.sha256, r.table_name): r.text_path for r in held.collect()}


def column_profiles(spark: SparkSession, paths: dict[str, str], snapshot_key: int) -> DataFrame:
    """Column profile of every table of one publication; ``paths`` by table."""
    parts = [profile.profile_columns(feed.scan(spark, path), table) for table, path in sorted(paths.items())]
    return reduce(DataFrame.unionByName, parts).withColumn("snapshot_key", F.lit(snapshot_key).cast("bigint"))


def refresh_landed(
    spark: SparkSession,
    store: Store,
    folder: str,
    source_name: str,
    serving_root: str,
    force: bool = False,
    as_of: str | None = None,
    refresh: Callable[..., DataFrame | None] = run_refresh,
) -> dict[int, DataFrame | None]:
    """Refresh every landed publication in the order of download.

    The gate comes before any work on contents: archives whose export succeeded are
    hashed and not opened further. Of the others each member is unpacked once, and a
    resumed refresh reads the text files of the run before. Archives
    with a registered hash keep their key. A publication is profiled before it is
    loaded. Returns per publication what ``refresh`` returned, None when it was skipped.
    """
    landed = landed_archives(spark, folder)
    known = settled(stored_or_none(store, SNAPSHOTS, schemas.SNAPSHOT_SCHEMA), "known")
    runs = latest_runs(stored_or_none(store, RUN_EVENTS, schemas.RUN_SCHEMA))
    gate = catalogue.snapshot_gate(landed.select("sha256").distinct(), known, runs, force)
    # One small row an archive; archives are few.
    actions = {row.sha256: row for row in gate.collect()}
    done: dict[int, DataFrame | None] = {
        row.snapshot_key: None for row in actions.values() if row.action == "SKIP"
    }
    open_hashes = [sha256 for sha256, row in actions.items() if row.action != "SKIP"]
    if not open_hashes:
        return dict(sorted(done.items()))
    due = settled(landed.where(F.col("sha256").isin(open_hashes)), "due")
    for row in due.select("path", "tables").collect():
        absent = profile.missing_files(f"{table}.txt" for table in row.tables)
        if absent:
            raise LandingError(f"{row.path} lacks {', '.join(absent)}")
    paths = member_paths(store, due)
    new = [sha256 for sha256 in open_hashes if actions[sha256].action == "NEW"]
    infos = [
        feed.stage_path(spark, paths[sha256, "feed_info"], "feed_info", 0).withColumn("sha256", F.lit(sha256))
        for sha256 in new
    ]
    own = known.join(due.select("sha256").distinct(), "sha256", "left_semi")
    if infos:
        info = reduce(DataFrame.unionByName, infos)
        own = own.unionByName(catalogue.snapshot_register(due, info, known, source_name))
    registry = settled(own, "registry")
    for row in registry.orderBy("downloaded_at_utc", "snapshot_key").select("snapshot_key", "sha256").collect():
        tables = {table: path for (sha256, table), path in paths.items() if sha256 == row.sha256}
        store.replace_snapshot(PROFILES, column_profiles(spark, tables, row.snapshot_key), row.snapshot_key)
        done[row.snapshot_key] = refresh(
            spark, store, registry.where(F.col("sha256") == row.sha256),
            lambda key, table, tables=tables: feed.stage_path(spark, tables[table], table, key),
            serving_root, force=force, as_of=as_of,
        )
    return dict(sorted(done.items()))
