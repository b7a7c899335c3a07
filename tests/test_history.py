from __future__ import annotations

import datetime as dt

from linespan.operators import changes, history


def source(spark, rows):
    return spark.createDataFrame(rows, "agency_id string, operator_name string, row_hash string")


def load(target, rows, key, compare=("row_hash",)):
    return history.scd2_merge(
        target, rows, key="agency_id", surrogate="operator_key", snapshot_key=key, compare=compare
    )


def versions(frame):
    return {
        (r.operator_key, r.operator_name, r.valid_from_snapshot_key, r.valid_to_snapshot_key,
         r.is_current)
        for r in frame.collect()
    }


def test_versions_open_close_and_return(spark):
    first = load(None, source(spark, [("A", "a", "h1"), ("B", "b", "h1"), ("C", "c", "h1")]), 1)
    second = load(first, source(spark, [("A", "a", "h1"), ("B", "b2", "h2"), ("D", "d", "h1")]), 2)
    assert versions(second) == {
        ("1:A", "a", 1, None, True),
        ("1:B", "b", 1, 2, False), ("2:B", "b2", 2, None, True),
        ("1:C", "c", 1, 2, False),
        ("2:D", "d", 2, None, True),
    }
    third = load(second, source(spark, [("C", "c", "h1"), ("B", "b2", "h2")]), 3)
    assert versions(third) >= {
        ("1:C", "c", 1, 2, False), ("3:C", "c", 3, None, True), ("2:B", "b2", 2, None, True),
        ("1:A", "a", 1, 3, False),
    }
    counts = history.merge_counts(third, 3).first()
    assert (counts.rows_inserted, counts.rows_closed) == (1, 2)
    # The same publication again changes nothing.
    again = load(third, source(spark, [("C", "c", "h1"), ("B", "b2", "h2")]), 3)
    assert versions(again) == versions(third)


def test_extra_compared_column_opens_a_version(spark):
    first = load(None, source(spark, [("A", "old", "h")]), 1)
    second = load(first, source(spark, [("A", "new", "h")]), 2, ("row_hash", "operator_name"))
    assert versions(second) == {("1:A", "old", 1, 2, False), ("2:A", "new", 2, None, True)}


def test_download_order_and_key_order_differ(spark):
    first = load(None, source(spark, [("A", "a", "h1")]), 1)
    second = load(first, source(spark, [("A", "a2", "h2")]), 2)
    # Publication 3 has the highest key but was downloaded between 1 and 2.
    snapshots = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 9)), (3, dt.datetime(2024, 1, 5))],
        "snapshot_key bigint, downloaded_at_utc timestamp_ntz",
    )
    by_time = history.versions_by_download(second, snapshots, 3).collect()
    by_key = history.versions_by_key(second, 3).collect()
    assert [r.operator_key for r in by_time] == ["1:A"]
    assert [r.operator_key for r in by_key] == ["2:A"]


def test_insert_if_absent_and_conflicts(spark):
    stored = spark.createDataFrame([(1, "a", None), (2, "b", 1)], "k int, v string, n int")
    fresh = spark.createDataFrame([(2, "b", 1), (3, "c", 2)], "k int, v string, n int")
    merged = history.insert_if_absent(stored, fresh, ("k",))
    assert {tuple(r) for r in merged.collect()} == {(1, "a", None), (2, "b", 1), (3, "c", 2)}
    changed = spark.createDataFrame([(1, "a", 5), (2, "b", 1)], "k int, v string, n int")
    found = history.conflicting_rows(stored, changed, ("k",), ("v", "n"), missing_conflicts=False)
    assert [r.k for r in found.collect()] == [1]
    missing = history.conflicting_rows(stored, fresh, ("k",), ("v",), missing_conflicts=True)
    assert [r.k for r in missing.collect()] == [1]


def test_publication_changes(spark):
    schema = "entity_type string, entity_id string, row_hash string"
    old = spark.createDataFrame([("STOP", "1", "a"), ("STOP", "2", "b"), ("TRIP", "1", "a")], schema)
    new = spark.createDataFrame([("STOP", "1", "a"), ("STOP", "2", "c"), ("ROUTE", "1", "a")], schema)
    found = changes.publication_changes(old, new)
    assert {(r.entity_type, r.entity_id, r.change_type) for r in found.collect()} == {
        ("STOP", "2", "MODIFIED"), ("TRIP", "1", "REMOVED"), ("ROUTE", "1", "ADDED"),
    }
    log = changes.change_rows(found, 1, 2, "2024-01-01 00:00:00")
    assert changes.fact_publication_change(log, log).count() == 3
    fields = {r.change_type: r.changed_fields for r in log.collect()}
    assert fields == {"MODIFIED": "published_attributes", "ADDED": None, "REMOVED": None}
    counts = changes.publication_change_counts(old, new, found).first()
    assert list(counts) == [3, 3, 3, 1, 1, 1]


def test_previous_snapshot_needs_every_stage(spark):
    snapshots = spark.createDataFrame(
        [(k, dt.datetime(2024, 1, k), s) for k, s in
         ((1, "LOADED"), (2, "LOADED"), (3, "VALIDATED"), (4, "LOADED"), (5, "LOADED"))],
        "snapshot_key bigint, downloaded_at_utc timestamp_ntz, snapshot_status string",
    )
    stages = changes.ENTITY_STAGES
    runs = [(k, s, "SUCCEEDED") for k in (1, 2, 3) for s in stages]
    runs += [(4, s, "SUCCEEDED") for s in stages[:3]] + [(4, stages[3], "FAILED")]
    runs = spark.createDataFrame(runs, "snapshot_key bigint, pipeline_name string, run_status string")
    assert changes.previous_snapshot(snapshots, runs, 5).first().snapshot_key == 2
    assert changes.previous_snapshot(snapshots, runs, 1).count() == 0
