from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from linespan.operators import quality


def test_row_rules_count_in_one_pass_and_gate(spark):
    rows = spark.createDataFrame([("a", 1), ("", 2), ("b", -1)], "id string, n int")
    results = quality.rows_rules(
        rows, "t",
        {"id given": F.trim("id") == "", "n not negative": F.col("n") < 0, "fine": F.lit(False)},
        present="rows exist",
    )
    got = {r.check_name: (r.check_status, r.records_checked, r.failed_records)
           for r in results.collect()}
    assert got == {
        "rows exist": ("PASS", 3, 0), "id given": ("FAIL", 3, 1),
        "n not negative": ("FAIL", 3, 1), "fine": ("PASS", 3, 0),
    }
    with pytest.raises(quality.QualityError, match="id given"):
        quality.gate(results)
    quality.gate(results.where("check_status = 'PASS'"))
    empty = quality.rows_rules(rows.limit(0), "t", {}, present="rows exist").first()
    assert (empty.check_status, empty.records_checked, empty.failed_records) == ("FAIL", 1, 1)


def test_uniqueness_and_reference_rules(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,)], "id string")
    known = spark.createDataFrame([("a",), ("a",)], "id string")
    unique = quality.unique_rule(rows, "t", "unique", [F.col("id")]).first()
    assert (unique.records_checked, unique.failed_records) == (5, 1)
    resolves = quality.resolves_rule(rows, "t", "resolves", F.col("id"), known, "id").first()
    assert (resolves.records_checked, resolves.failed_records) == (5, 2)


def test_older_download_may_not_replace_history(spark):
    snapshots = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1), "LOADED"), (2, dt.datetime(2024, 1, 8), "LOADED")],
        "snapshot_key bigint, downloaded_at_utc timestamp_ntz, snapshot_status string",
    )
    history = spark.createDataFrame(
        [(2, True), (1, False)], "valid_from_snapshot_key bigint, is_current boolean"
    )
    late = quality.not_older([history], snapshots, 1, "not older", "d").first()
    assert (late.check_status, late.failed_records) == ("FAIL", 1)
    assert quality.not_older([history], snapshots, 2, "n", "d").first().check_status == "PASS"
    assert quality.snapshot_loaded(snapshots, 9, "n").first().check_status == "FAIL"


def test_negative_trip_span_is_found(spark):
    events = spark.createDataFrame(
        [("t1", 100, 130), ("t1", 300, 330), ("t2", 100, 130)],
        "trip_key string, arrival_seconds int, departure_seconds int",
    )
    found = (
        events.groupBy("trip_key")
        .agg(F.max("arrival_seconds").alias("a"), F.min("departure_seconds").alias("d"))
        .where("a < d")
    )
    rule = quality.empty_rule(found, "t", "50609 trip span is not negative", "VALIDITY").first()
    assert (rule.check_status, rule.failed_records) == ("FAIL", 1)


CALL_COLUMNS = (
    "trip_id", "stop_id", "stop_sequence", "arrival_time", "departure_time", "pickup_type",
    "drop_off_type", "shape_dist_traveled", "timepoint",
)


def test_call_rules_agree_with_single_rules_and_move_calls_once(spark):
    def call(trip, stop, sequence, arrival="08:00:00"):
        return (trip, stop, sequence, arrival, "08:01:00", "0", "0", "1.5", "1")

    rows = [call("hot", f"s{i % 7}", str(i)) for i in range(3000)]
    rows += [call("hot", "s1", "2500"), call(" hot ", "s1", "2500"), call("hot", "s1", "x"), call("hot", "s1", None)]
    rows += [call("t1", "s1", "1"), call("t1", "s2", "01"), call("lost", "s9", "1"), call(None, None, "1")]
    rows += [call(None, "s1", "1"), call("", "s1", "-4", "8 o'clock"), call("t1", "s2", "7", None)]
    calls = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in CALL_COLUMNS))
    trips = spark.createDataFrame([("hot",), ("t1",), ("idle",), (None,)], "trip_id string")
    stops = spark.createDataFrame([(f"s{i}",) for i in range(7)] * 2 + [(None,)], "stop_id string")
    trip, stop = F.trim("trip_id"), F.trim("stop_id")
    sequence = F.col("stop_sequence").try_cast("int")
    alone = [
        quality.unique_rule(calls, "gtfs_stop_times", "50505 trip sequence is unique", [trip, sequence]),
        quality.resolves_rule(calls, "gtfs_stop_times", "50506 trip resolves", trip, trips, "trip_id"),
        quality.resolves_rule(
            calls, "gtfs_stop_times", "50507 stop version resolves", stop, stops, "stop_id"
        ),
    ]
    together = quality.call_rules(calls, trips, stops)
    found = {r.check_name: r for r in together.collect()}
    for rule in alone:
        expected = rule.first()
        assert found.pop(expected.check_name) == expected
    staged, values = (found.pop(n) for n in sorted(found))
    assert (staged.check_status, staged.records_checked) == ("PASS", len(rows))
    # Two bad sequences of the hot trip, two missing trips, one blank trip, one missing time.
    assert (values.records_checked, values.failed_records) == (len(rows), 6)
    plan = together._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1
    nothing = {r.check_name[:5]: r.check_status for r in quality.call_rules(calls.limit(0), trips, stops).collect()}
    assert nothing == {"50503": "FAIL", "50504": "PASS", "50505": "PASS", "50506": "PASS", "50507": "PASS"}
