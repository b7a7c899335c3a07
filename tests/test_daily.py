from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest

from linespan.operators import calendar, daily, dimensions

EVENT_SCHEMA = (
    "snapshot_key bigint, trip_key string, route_key string, service_key string, stop_key string, "
    "stop_sequence int, arrival_seconds int, departure_seconds int"
)


def two_places(numerator, denominator):
    return (Decimal(numerator) / Decimal(denominator)).quantize(Decimal("0.01"), ROUND_HALF_UP)


def make_world(seed):
    """Random timetable in which one route holds a third of all trips."""
    rng = random.Random(seed)
    start = dt.date(2024, 1, 1)
    services = {f"2:V{i}": {start + dt.timedelta(d) for d in range(200) if rng.random() < 0.3}
                for i in range(6)}
    events = []
    for trip in range(90):
        route = "1:R0" if trip % 3 == 0 else f"1:R{rng.randrange(1, 8)}"
        service = rng.choice(list(services))
        moment = rng.randrange(18000, 90000)
        for sequence in range(rng.randrange(1, 9)):
            moment += rng.randrange(0, 400)
            arrival = moment
            moment += rng.randrange(0, 60)
            events.append((2, f"2:T{trip}", route, service, f"1:S{rng.randrange(12)}", sequence,
                           arrival, moment))
    return services, events


def expected(services, events, first, last):
    routes, stops = {}, {}
    trips = defaultdict(list)
    for row in events:
        trips[row[1]].append(row)
    day = first
    while day <= last:
        by_route, by_stop = defaultdict(list), defaultdict(list)
        for rows in trips.values():
            if day not in services[rows[0][3]]:
                continue
            by_route[rows[0][2]].append(rows)
            for stop in {r[4] for r in rows}:
                by_stop[stop].append(
                    (min(r[7] for r in rows if r[4] == stop), rows[0][2])
                )
        for route, group in by_route.items():
            flat = [r for rows in group for r in rows]
            dep = [r[7] for r in flat]
            arr = max(r[6] for r in flat)
            n = len(group)
            routes[route, day] = (
                n, len(flat), len({r[4] for r in flat}), min(dep), arr,
                two_places(arr - min(dep), 60),
                two_places(max(dep) - min(dep), 60 * (n - 1)) if n > 1 else None,
            )
        for stop, calls in by_stop.items():
            dep = [c[0] for c in calls]
            n = len(calls)
            stops[stop, day] = (
                n, len({c[1] for c in calls}), min(dep), max(dep),
                two_places(max(dep) - min(dep), 60),
                two_places(max(dep) - min(dep), 60 * (n - 1)) if n > 1 else None,
            )
        day += dt.timedelta(1)
    return routes, stops


@pytest.mark.parametrize("seed", [1, 2])
def test_daily_facts_equal_brute_force(spark, seed):
    services, events = make_world(seed)
    # Single-call trips may arrive before they depart; keep valid spans only.
    events = [(*e[:6], max(e[6], e[7]), e[7]) for e in events]
    frame = spark.createDataFrame(events, EVENT_SCHEMA)
    bridge = spark.createDataFrame(
        [(2, key, day) for key, days in services.items() for day in days],
        "snapshot_key bigint, service_key string, full_date date",
    )
    routes = spark.createDataFrame(
        [(f"1:R{i}", f"1:A{i % 2}") for i in range(8)], "route_key string, operator_key string"
    )
    snapshots = spark.createDataFrame(
        [(2, dt.datetime(2024, 1, 5, 23, 0))],
        "snapshot_key bigint, downloaded_at_utc timestamp_ntz",
    )
    row = daily.reporting_window(bridge, snapshots, 2, horizon_days=150)
    window = daily.resolve_window(row)
    assert window.first == dt.date(2024, 1, 5)
    assert window.days == 150 and len(window.words) == 3
    want_routes, want_stops = expected(services, events, window.first, window.last)

    got = daily.fact_route_service_day(frame, bridge, routes, window, 2).collect()
    assert {
        (r.route_key, r.full_date): (
            r.scheduled_trip_count, r.scheduled_stop_event_count, r.unique_stop_count,
            r.first_departure_seconds, r.last_arrival_seconds, r.service_span_minutes,
            r.average_headway_minutes,
        )
        for r in got
    } == want_routes
    assert all(r.date_key == int(r.full_date.strftime("%Y%m%d")) for r in got)
    assert {r.operator_key for r in got if r.route_key == "1:R3"} == {"1:A1"}

    got = daily.fact_stop_service_day(frame, bridge, window, 2).collect()
    assert {
        (r.stop_key, r.full_date): (
            r.scheduled_trip_count, r.scheduled_route_count, r.first_departure_seconds,
            r.last_departure_seconds, r.service_span_minutes, r.average_headway_minutes,
        )
        for r in got
    } == want_stops


def test_expansion_is_not_shuffled(spark):
    services, events = make_world(3)
    frame = spark.createDataFrame(events, EVENT_SCHEMA)
    bridge = spark.createDataFrame(
        [(2, key, day) for key, days in services.items() for day in days],
        "snapshot_key bigint, service_key string, full_date date",
    )
    window = daily.Window(dt.date(2024, 1, 1), dt.date(2024, 3, 1))
    plan = daily.fact_stop_service_day(frame, bridge, window, 2)._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    above = physical[: physical.index("Generate explode")]
    assert "Exchange" not in above
    assert "CartesianProduct" not in physical and "NestedLoop" not in physical


def test_calls_are_rolled_up_before_they_meet_the_days(spark):
    services, events = make_world(4)
    frame = spark.createDataFrame(events, EVENT_SCHEMA)
    bridge = spark.createDataFrame(
        [(2, key, day) for key, days in services.items() for day in days],
        "snapshot_key bigint, service_key string, full_date date",
    )
    window = daily.Window(dt.date(2024, 1, 1), dt.date(2024, 5, 1))
    facts = daily.fact_stop_service_day(frame, bridge, window, 2)
    physical = facts._jdf.queryExecution().executedPlan().toString()
    # Joins with the days read aggregates, and no exchange has a given number of partitions.
    for line in physical.split("\n"):
        assert "REPARTITION_BY_NUM" not in line
    raw = [x for x in physical.split("\n") if "Exchange hashpartitioning(service_key" in x]
    assert raw and all("trip_key" not in x for x in raw)
    # One route holds a third of the trips: its days spread over its words.
    rows = spark.createDataFrame(
        [("hot", 1, *[2**62 - 1] * len(window.words)) for _ in range(10)],
        "stop_key string, scheduled_trip_count bigint, " + ", ".join(f"{w} bigint" for w in window.words),
    )
    assert daily._by_word(rows, window).select("_word").distinct().count() == len(window.words) == 2


def test_window_bounds(spark):
    bridge = spark.createDataFrame(
        [(2, "2:V", dt.date(2024, 2, 1)), (2, "2:V", dt.date(2024, 3, 1))],
        "snapshot_key bigint, service_key string, full_date date",
    )
    snapshots = spark.createDataFrame(
        [(2, dt.datetime(2024, 1, 1))], "snapshot_key bigint, downloaded_at_utc timestamp_ntz"
    )

    def resolve(**options):
        return daily.resolve_window(daily.reporting_window(bridge, snapshots, 2, **options))

    raised = resolve()
    assert (raised.first, raised.last) == (dt.date(2024, 2, 1), dt.date(2024, 3, 1))
    short = resolve(start_date="2024-02-10", horizon_days=5)
    assert (short.first, short.last) == (dt.date(2024, 2, 10), dt.date(2024, 2, 14))
    with pytest.raises(daily.WindowError, match="after all"):
        resolve(start_date="2024-03-02")
    with pytest.raises(daily.WindowError, match="no active"):
        daily.resolve_window(daily.reporting_window(bridge.limit(0), snapshots, 2))
    with pytest.raises(ValueError):
        resolve(horizon_days=0)


def test_calendar_exceptions(spark):
    calendar_rows = spark.createDataFrame(
        [("V1", "1", "0", "0", "0", "0", "0", "0", "20240101", "20240131", "h")],
        "service_id string, monday string, tuesday string, wednesday string, thursday string, "
        "friday string, saturday string, sunday string, start_date string, end_date string, "
        "row_hash string",
    )
    # A Monday removed, a Monday added although it runs anyway, a Tuesday
    # added, and a service known only through an added date.
    exceptions = calendar.exception_source(
        spark.createDataFrame(
            [("V1", "20240108", "2"), ("V1", "20240115", "1"), ("V1", "20240116", "1"),
             ("X", "20240120", "1"), ("X", "20240122", "1"), ("Y", "20240120", "2")],
            "service_id string, date string, exception_type string",
        )
    )
    source = calendar.service_source(calendar_rows, exceptions)
    only = {r.service_id: r for r in source.collect()}
    assert set(only) == {"V1", "X"}
    assert (only["X"].start_date, only["X"].end_date) == (dt.date(2024, 1, 20), dt.date(2024, 1, 22))
    services = calendar.dim_service(None, source, 2)
    bounds = spark.createDataFrame(
        [(dt.date(2024, 1, 1), dt.date(2024, 1, 31))], "minimum_date date, maximum_date date"
    )
    dates = dimensions.dim_date(bounds)
    bridge = calendar.bridge_service_date(services, exceptions, dates)
    got = {(r.service_id, r.full_date.day, r.activation_source) for r in bridge.collect()}
    assert got == {
        ("V1", 1, "CALENDAR"), ("V1", 22, "CALENDAR"), ("V1", 29, "CALENDAR"),
        ("V1", 15, "EXCEPTION_ADDED"), ("V1", 16, "EXCEPTION_ADDED"),
        ("X", 20, "EXCEPTION_ADDED"), ("X", 22, "EXCEPTION_ADDED"),
    }
    actions = calendar.bridge_sync(bridge.where("full_date <> '2024-01-22'"), bridge)
    counts = calendar.bridge_sync_counts(actions).first()
    assert list(counts) == [7, 2, 0]


def test_dates_carry_iso_week(spark):
    bounds = spark.createDataFrame(
        [(dt.date(2023, 12, 30), dt.date(2024, 1, 2))], "minimum_date date, maximum_date date"
    )
    rows = {r.full_date: r for r in dimensions.dim_date(bounds).collect()}
    last = rows[dt.date(2023, 12, 31)]
    assert (last.week_of_year, last.day_name, last.is_weekend, last.day_of_week_iso) == (
        52, "Sunday", True, 7,
    )
    assert rows[dt.date(2024, 1, 1)].week_of_year == 1
    again = dimensions.dim_date(bounds, dimensions.dim_date(bounds))
    assert again.count() == 0
