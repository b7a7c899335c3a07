from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from linespan.operators.quality import QualityError
from linespan.plans import refresh, serving
from linespan.schemas import FEED_COLUMNS
from linespan.session import run_folder
from linespan.sources.feed import with_lineage
from verification.projection import AS_OF
from linespan.sources.store import Store
from verification.world import World


@pytest.fixture(scope="module")
def world(spark, small):
    return World(spark, small)


def registry_row(world, key):
    return world.snapshots.where(F.col("snapshot_key") == key).withColumn(
        "snapshot_status", F.lit("RECEIVED")
    )


def test_two_publications_from_feed_to_serving(spark, world):
    store, root = Store(spark, run_folder(spark, "wh")), run_folder(spark, "serving")

    def run(key, **options):
        return refresh.run_refresh(
            spark, store, registry_row(world, key), world.staged, root, as_of=AS_OF, **options
        )

    first = {r.table_name: r.row_count for r in run(1).collect()}
    assert len(first) == 17 and first["publication_changes"] == 0
    assert run(1) is None
    second = {r.table_name: r.row_count for r in run(2).collect()}
    assert second["data_quality_results"] > first["data_quality_results"] > 0
    assert serving.published_version(spark, root) is not None

    # The stored pipeline gives what the lazily built one gives.
    b = world.latest
    assert second["route_service_daily"] == b.route_days.count()
    assert second["publication_changes"] == world.detected().count()
    compared = ["route_id", "service_day_count", "total_scheduled_trips", "average_headway_minutes"]
    from linespan.plans import views

    stored = serving.served(spark, root, "route_summary").select(*compared)
    lazy = views.route_summary(world.warehouse).select(*compared)
    assert stored.exceptAll(lazy).count() == 0 and lazy.exceptAll(stored).count() == 0

    runs = refresh.latest_runs(store.read(refresh.RUN_EVENTS))
    assert runs.where("run_status <> 'SUCCEEDED'").count() == 0
    assert runs.select("snapshot_key", "pipeline_name").distinct().count() == 2 * 12
    assert store.read("staging_shapes").select("snapshot_key").distinct().count() == 1
    assert store.read("staging_trips").select("snapshot_key").distinct().count() == 2
    status = refresh.catalogue.snapshot_status(store.read(refresh.STATUS_EVENTS))
    assert {r.snapshot_status for r in status.collect()} == {"LOADED"}
    assert store.read(refresh.QUALITY).where("check_status = 'FAIL'").count() == 0

    # Staging and core dimensions again: each replaces its own rows only.
    before = {t: store.read(t).count() for t in ("dim_operator", "dim_date", "staging_trips")}
    rerun = refresh.Refresh(spark, store, 2, lambda table: world.staged(2, table))
    rerun.stage_feed()
    again = rerun.build()
    assert again.previous is not None and again.previous.snapshot_key == 1
    assert again.dim_operator.count() + again.previous.dim_operator.count() == before["dim_operator"]
    again.dim_date.count()
    assert {t: store.read(t).count() for t in before} == before


def test_failed_rule_stops_the_refresh(spark, world):
    store = Store(spark, run_folder(spark, "wh"))

    def faulty(key, table):
        rows = world.staged(key, table)
        return rows.withColumn("agency_name", F.lit(" ")) if table == "agency" else rows

    with pytest.raises(QualityError, match="50004"):
        refresh.run_refresh(
            spark, store, registry_row(world, 1), faulty, run_folder(spark, "serving"), as_of=AS_OF
        )
    runs = refresh.latest_runs(store.read(refresh.RUN_EVENTS))
    failed = runs.where("run_status = 'FAILED'").collect()
    assert [r.pipeline_name for r in failed] == ["load_gtfs_core_warehouse"]
    assert "50004" in failed[0].error_message
    assert not store.exists("dim_operator")


def third(world):
    """A publication after the second with the very same feed."""
    return registry_row(world, 2).withColumns(
        {
            "snapshot_key": F.lit(3).cast("bigint"),
            "sha256": F.sha2(F.lit("third"), 256),
            "downloaded_at_utc": F.col("downloaded_at_utc") + F.expr("INTERVAL 1 DAY"),
        }
    )


def relabelled(rows, table, key, **columns):
    """Rows as another publication holds them, with the hash of their values."""
    values = rows.select(*FEED_COLUMNS[table]).withColumns(columns)
    return with_lineage(values, table, key)


def feed_of(world):
    """Publication 3 is the second with other agency names."""

    def staged(key, table):
        if key < 3:
            return world.staged(key, table)
        other = {"agency_name": F.concat("agency_name", F.lit(" Ltd"))} if table == "agency" else {}
        return relabelled(world.staged(2, table), table, key, **other)

    return staged


def test_change_log_after_a_publication_that_failed_late(spark, world):
    store, root = Store(spark, run_folder(spark, "wh")), run_folder(spark, "serving")
    feed = feed_of(world)

    def late_departures(key, table):
        """One trip arrives everywhere before it first leaves."""
        rows = feed(key, table)
        if table != "stop_times":
            return rows
        own = F.col("trip_id") == rows.select(F.min("trip_id")).first()[0]
        return relabelled(
            rows, table, key,
            arrival_time=F.when(own, "01:00:00").otherwise(F.col("arrival_time")),
            departure_time=F.when(own, "02:00:00").otherwise(F.col("departure_time")),
        )

    refresh.run_refresh(spark, store, registry_row(world, 1), feed, root, as_of=AS_OF)
    with pytest.raises(QualityError, match="50609"):
        refresh.run_refresh(spark, store, registry_row(world, 2), late_departures, root, as_of=AS_OF)
    # No fact of the stopped publication was written, and its changes are not logged.
    assert store.stored_load("fact_route_service_day", 2) is None
    assert store.stored_load(refresh.CHANGES, 2) is None
    failed = store.read(refresh.QUALITY).where("check_status = 'FAIL'").select("check_name").collect()
    assert [r.check_name[:5] for r in failed] == ["50609"]

    refresh.run_refresh(spark, store, third(world), feed, root, as_of=AS_OF)
    log = store.read_load(refresh.CHANGES, 3)
    # The third differs from the second, whose entities were all loaded, in operators only.
    assert {(r.entity_type, r.change_type, r.previous_snapshot_key) for r in log.collect()} == {
        ("OPERATOR", "MODIFIED", 2)
    }
    build = refresh.Refresh(spark, store, 3, lambda table: feed(3, table))
    assert build.previous_key() == 2

    # The older publication again would continue newer history.
    with pytest.raises(QualityError, match="50002"):
        refresh.run_refresh(spark, store, registry_row(world, 2), feed, root, as_of=AS_OF)


def test_forced_rerun_with_changed_rows_is_refused(spark, world):
    store, root = Store(spark, run_folder(spark, "wh")), run_folder(spark, "serving")
    feed = feed_of(world)
    refresh.run_refresh(spark, store, registry_row(world, 1), feed, root, as_of=AS_OF)
    tables = ("dim_trip", "shape_point", "fact_scheduled_stop_event", "fact_route_service_day", refresh.CHANGES)
    before = {t: store.read(t).count() for t in tables}

    again = refresh.run_refresh(spark, store, registry_row(world, 1), feed, root, force=True, as_of=AS_OF)
    assert again is not None and {t: store.read(t).count() for t in tables} == before

    def changed(key, table):
        rows = feed(key, table)
        return relabelled(rows, table, key, trip_headsign=F.lit("elsewhere")) if table == "trips" else rows

    kept = store.read("dim_trip").collect()
    with pytest.raises(QualityError, match="50311"):
        refresh.run_refresh(spark, store, registry_row(world, 1), changed, root, force=True, as_of=AS_OF)
    assert sorted(store.read("dim_trip").collect()) == sorted(kept)
    assert {t: store.read(t).count() for t in tables} == before
