"""What queries move and keep on disk."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from linespan.functions.columns import packed_hash, unpacked_hash
from linespan.functions.measures import average_2dp, ratio_2dp
from linespan.operators import changes, daily, dimensions, history, quality, schedule
from linespan.operators.daily import ROUTE_DAY_COMPARE, STOP_DAY_COMPARE
from linespan.plans import serving
from linespan.session import bound_tasks, settled
from linespan.sources.store import Store
from verification import intake_checks
from verification.projection import projected
from verification.world import World

EVENTS = "trip_key string, stop_key string, route_key string, service_key string, departure_seconds int"


def physical(rows) -> str:
    return rows._jdf.queryExecution().executedPlan().toString()


def shuffle_files(spark) -> int:
    return spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString().count("shuffle_")


def test_shuffle_files_go_with_their_query(spark):
    bound_tasks(spark, 0)
    before = shuffle_files(spark)
    rows = settled(spark.range(5000).groupBy((F.col("id") % 700).alias("k")).count(), "cleaned")
    assert rows.count() == 700
    assert shuffle_files(spark) <= before


def test_packed_hashes_keep_every_text(spark):
    texts = ["ab" * 32, "AB" * 32, "abc", "", "no hex", " ab", "0" * 64, None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, row_hash string")
    packed = rows.select("i", *packed_hash("row_hash"))
    assert {r.i: r.t for r in packed.select("i", unpacked_hash().alias("t")).collect()} == dict(enumerate(texts))
    sizes = {r.i: r.n for r in packed.select("i", F.octet_length("_packed_hash").alias("n")).collect()}
    assert sizes[0] == sizes[6] == 32


def test_loads_move_packed_hashes(spark):
    feed = {
        "trip_id": " T1 ", "stop_id": "S1", "stop_sequence": "1", "arrival_time": "24:00:01",
        "departure_time": "24:00:02", "stop_headsign": None, "pickup_type": "", "drop_off_type": "1",
        "shape_dist_traveled": "1.5", "timepoint": None, "route_id": "R1", "service_id": "V1 ",
        "trip_headsign": " To ", "trip_short_name": "", "direction_id": "1", "block_id": " ", "shape_id": "H1",
        "wheelchair_accessible": "2", "row_hash": "ab" * 32,
    }
    staged = spark.createDataFrame([feed], ", ".join(f"{c} string" for c in feed))
    routes = spark.createDataFrame([("R1", "1:R1")], "route_id string, route_key string")
    services = spark.createDataFrame([(2, "V1", "2:V1")], "snapshot_key bigint, service_id string, service_key string")
    stops = spark.createDataFrame([("S1", "1:S1")], "stop_id string, stop_key string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        trips = dimensions.trip_source(staged, routes, services, 2)
        calls = schedule.scheduled_stop_event(staged, trips, stops, 2)
        for rows in (trips, calls):
            plan = physical(rows)
            # The packing lies below the first exchange of the staged rows.
            assert "_packed_hash" in plan[plan.index("Exchange hashpartitioning"):]
        assert list(trips.collect()[0]) == [
            2, "2:T1", "1:R1", "2:V1", "T1", "To", None, 1, None, "H1", 2, "ab" * 32,
        ]
        assert list(calls.collect()[0]) == [
            2, "2:T1", "1:R1", "2:V1", "1:S1", 1, 86401, 86402, None, 0, 1, Decimal("1.500"), True, "ab" * 32,
        ]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_calls_move_once_to_their_roll_up(spark):
    calls = [("T1", "S1", "R", "V", 5), ("T1", "S1", "R", "V", 9), ("T2", "S1", "R", "V", 7), ("T2", "S2", "R", "V", 8)]
    events = spark.createDataFrame(calls, EVENTS)
    rollup = daily.service_route_stop_metric(daily.trip_stop_metric(daily.by_service_route_stop(events)))
    assert physical(rollup).count("Exchange") == 1
    assert {tuple(r) for r in rollup.collect()} == {("V", "R", "S1", 2, 5, 7), ("V", "R", "S2", 1, 8, 8)}


def test_days_are_summed_before_they_expand(spark):
    window = daily.Window(dt.date(2024, 1, 1), dt.date(2024, 4, 9))
    assert window.days == 100
    # Days 0, 7, 8, 63 (the sign bit of its word) and 99, and a service of no day.
    first, second = sum(1 << d for d in (0, 7, 8)) - (1 << 63), 1 << 35
    base = spark.createDataFrame(
        [("a", 2, 10, first, second), ("a", 1, 5, 1, 0), ("a", 7, 1, 0, 0), (None, 1, None, 1, 0)],
        "stop_key string, scheduled_trip_count bigint, first_departure_seconds int, days_0 bigint, days_1 bigint",
    )
    pairs = spark.createDataFrame([("a", first, 0), ("b", 2, 0)], "stop_key string, days_0 bigint, days_1 bigint")
    facts = daily._day_facts(base, pairs, "stop_key", "scheduled_route_count", window)
    got = {
        (r.stop_key, (r.full_date - window.first).days): (r.scheduled_trip_count, r.first_departure_seconds, r.scheduled_route_count)
        for r in facts.collect()
    }
    assert got == {
        ("a", 0): (3, 5, 1), ("a", 7): (2, 10, 1), ("a", 8): (2, 10, 1), ("a", 63): (2, 10, 1),
        ("a", 99): (2, 10, None), ("b", 1): (None, None, 1), (None, 0): (1, None, None),
    }
    assert "63]" not in physical(facts)


def test_averages_sum_whole_numbers(spark):
    values = [Decimal("0.01"), Decimal("0.02"), None, Decimal("-7.35"), Decimal("9999999999.99")]
    rows = spark.createDataFrame([(v, 3) for v in values], "v decimal(12,2), n bigint")
    result = rows.agg(average_2dp("v").alias("v"), average_2dp("n").alias("n"))
    assert tuple(result.first()) == (Decimal("2499999998.17"), Decimal("3.00"))
    assert "decimal(22,2)" not in result._jdf.queryExecution().optimizedPlan().toString()


def test_lines_of_an_order_move_once_to_their_calls(spark, small):
    calls = projected(spark, small, "p2_stop_times")
    assert physical(calls).count("Exchange hashpartitioning") == 1


def test_compared_hashes_are_packed_and_compared_exactly(spark):
    schema = "k int, row_hash string, v int"
    same, other = "ab" * 32, "cd" * 32
    stored = [(1, same, 1), (2, same, 1), (3, "h", 1), (4, None, 1), (5, same.upper(), 1), (6, same, 1), (7, same, 1)]
    source = [(1, same, 1), (2, other, 1), (3, "H", 1), (4, None, 1), (5, same, 1), (6, same, 2)]
    frames = [spark.createDataFrame(rows, schema) for rows in (stored, source)]
    wrong = history.conflicting_rows(*frames, ("k",), ("row_hash", "v"), missing_conflicts=True)
    assert wrong.columns == ["k", "row_hash", "v"]
    assert {tuple(r) for r in wrong.collect()} == {row for row in stored if row[0] in (2, 3, 5, 6, 7)}
    assert "_packed_hash" in physical(wrong)
    states = [f.select(F.lit("TRIP").alias("entity_type"), F.col("k").cast("string").alias("entity_id"), "row_hash") for f in frames]
    found = changes.publication_changes(*states)
    assert {tuple(r)[1:] for r in found.collect()} == {
        ("2", "MODIFIED", same, other), ("3", "MODIFIED", "h", "H"), ("5", "MODIFIED", same.upper(), same),
        ("7", "REMOVED", same, None),
    }
    assert "_packed_hash" in physical(found)


def test_slices_of_days_share_out_all_stored_facts(spark):
    window = daily.Window(dt.date(2024, 1, 10), dt.date(2024, 3, 20))
    days = [dt.date(2024, 1, 1) + dt.timedelta(n) for n in range(100)]

    def facts(key: str, compare: tuple, trips: int, beyond: bool):
        rows = [(2, int(d.strftime("%Y%m%d")), d, "a", trips if d.day != 7 else 3) for d in days if beyond or d in (days[20], days[45])]
        rows += [(2, None, days[30], "a", 1), (1, 20240203, days[33], "a", 1)] if beyond else []
        made = spark.createDataFrame(
            rows, f"snapshot_key bigint, date_key int, full_date date, {key} string, scheduled_trip_count bigint"
        )
        return made.select("*", *[F.lit(1).alias(c) for c in compare if c != "scheduled_trip_count"])

    route = [facts("route_key", ROUTE_DAY_COMPARE, n, b) for n, b in ((4, True), (5, False))]
    stop = [facts("stop_key", STOP_DAY_COMPARE, n, b) for n, b in ((5, True), (5, False))]
    slices = quality.day_slices(window)
    assert len(slices) == 3
    assert sum(route[0].where(s).count() for s in slices) == route[0].count()
    whole, cut = (
        sorted(map(tuple, quality.dq_fact_agreement(window, *route, *stop, 2, s).collect())) for s in ((), slices)
    )
    assert whole == cut and any(row[3] == "FAIL" for row in cut)


def test_staging_keeps_no_replaced_parts(spark, small, monkeypatch):
    stores = []
    monkeypatch.setattr(intake_checks, "Store", lambda *a: stores.append(Store(*a)) or stores[-1])
    rows = intake_checks.stage_replace(World(spark, small))
    store = stores[0]
    for table in ("stops", "stop_times"):
        live = {part.folder.split("/")[1] for part in store.parts(table)}
        assert set(store._children(f"{store.path(table)}/parts")) == live
    assert rows.where("table_name = 'stops'").select("snapshot_key").distinct().count() == 2


def test_ratios_stay_whole_numbers_until_they_are_decimals(spark):
    rows = spark.createDataFrame([(7, 60), (-7, 60), (1, 8), (-1, 8), (0, 3), (None, 3)], "n int, d int")
    result = rows.select(ratio_2dp(F.col("n"), F.col("d")).alias("r"))
    assert [r.r for r in result.collect()] == [
        Decimal("0.12"), Decimal("-0.12"), Decimal("0.13"), Decimal("-0.13"), Decimal("0.00"), None,
    ]
    assert "double" not in result._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "signum" not in result._jdf.queryExecution().optimizedPlan().toString().lower()


def test_lookup_values_are_texts_made_once_a_value(spark):
    day = dt.date(2024, 1, 2)
    rows = spark.createDataFrame(
        [("a", day, "x"), ("a", day, "x"), ("a|", None, "y"), (None, day, None), ("", day, ""), (None, None, "")],
        "route_id string, service_date date, kind string",
    )

    def counted(*lookup):
        return {r.lookup_value: r.row_count for r in serving.lookup_counts(rows, lookup).collect()}

    assert counted("route_id", "service_date") == {"a|2024-01-02": 2, "a||": 1, "|2024-01-02": 2, "|": 1}
    assert counted("service_date") == {"2024-01-02": 4, "": 2}
    assert counted("route_id", "kind") == {"a|x": 2, "a||y": 1, "|": 3}
    assert counted() == {"": 6}
    plan = physical(serving.lookup_counts(rows, ("service_date",)))
    assert "concat_ws" not in plan[plan.index("HashAggregate"):]
