"""Data-quality rules as result rows.

Each ``dq_*`` function returns one row per rule, shaped like the quality log.
All row rules of a table are counted in one pass over it; uniqueness and
reference rules add one aggregate or anti-join each, those over calls share
two aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linespan.functions.columns import (
    HEX_COLOUR,
    call_seconds,
    coordinate,
    differs,
    distance,
    feed_date,
    is_blank,
    small_number,
    trimmed,
    whole_number,
)
from linespan.operators import calendar as service_calendar
from linespan.operators.changes import CHANGE_COMPARE, CHANGE_KEYS, succeeded_entity_stages
from linespan.operators.daily import (
    ROUTE_DAY_COMPARE,
    ROUTE_DAY_KEYS,
    STOP_DAY_COMPARE,
    STOP_DAY_KEYS,
    Window,
    window_bridge,
)
from linespan.operators.history import conflicting_rows, current_versions, downloaded_at
from linespan.operators.schedule import (
    EVENT_COMPARE,
    EVENT_KEYS,
    SHAPE_COMPARE,
    SHAPE_KEYS,
    TRIP_COMPARE,
    TRIP_KEYS,
)
from linespan.schemas import ENTITY_STAGES
from linespan.session import settled

MAXIMUM_DATE_RANGE_DAYS = 7320
# Days of stored facts that are compared together.
AGREEMENT_DAYS = 31
RESULT_COLUMNS = (
    "check_name", "check_category", "table_name", "check_status", "records_checked",
    "failed_records",
)


class QualityError(RuntimeError):
    """Raised by the gate when a rule fails."""


def _result(name: str, category: str, table: str, checked: Column, failed: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"),
        F.lit(category).alias("check_category"),
        F.lit(table).alias("table_name"),
        F.when(failed > 0, "FAIL").otherwise("PASS").alias("check_status"),
        checked.cast("bigint").alias("records_checked"),
        failed.cast("bigint").alias("failed_records"),
    )


def rows_rules(
    rows: DataFrame, table: str, rules: dict[str, Column], present: str | None = None
) -> DataFrame:
    """Count violations of every row rule in one pass.

    ``present`` names a rule that fails when the table is empty.
    """
    aggregates = [F.count("*").alias("_rows")]
    aggregates += [F.count_if(bad).alias(f"_bad_{i}") for i, bad in enumerate(rules.values())]
    results = []
    if present:
        empty = F.when(F.col("_rows") == 0, 1).otherwise(0)
        results.append(
            _result(present, "COMPLETENESS", table, F.greatest("_rows", F.lit(1)), empty)
        )
    results += [
        _result(name, "VALIDITY", table, F.col("_rows"), F.col(f"_bad_{i}"))
        for i, name in enumerate(rules)
    ]
    return rows.agg(*aggregates).select(F.inline(F.array(*results)))


def unique_rule(rows: DataFrame, table: str, name: str, keys: Sequence[Column]) -> DataFrame:
    """Count key values held by more than one row."""
    named = [key.alias(f"_key_{i}") for i, key in enumerate(keys)]
    return (
        rows.groupBy(*named)
        .agg(F.count("*").alias("_rows"))
        .agg(
            F.coalesce(F.sum("_rows"), F.lit(0)).alias("_checked"),
            F.count_if(F.col("_rows") > 1).alias("_bad"),
        )
        .select(
            F.inline(F.array(_result(name, "UNIQUENESS", table, F.col("_checked"), F.col("_bad"))))
        )
    )


def resolves_rule(
    rows: DataFrame, table: str, name: str, key: Column, known: DataFrame, known_key: str
) -> DataFrame:
    """Count rows whose non-NULL-safe key has no match among the known ones.

    Keys are counted before the join, so a hot key is one row in it.
    """
    keys = rows.groupBy(key.alias("_key")).agg(F.count("*").alias("_rows"))
    found = known.select(F.col(known_key).alias("_key"), F.lit(True).alias("_found")).distinct()
    return (
        keys.join(found, "_key", "left")
        .agg(
            F.coalesce(F.sum("_rows"), F.lit(0)).alias("_checked"),
            F.coalesce(F.sum(F.when(F.col("_found").isNull(), F.col("_rows"))), F.lit(0)).alias(
                "_bad"
            ),
        )
        .select(
            F.inline(F.array(_result(name, "REFERENCE", table, F.col("_checked"), F.col("_bad"))))
        )
    )


def empty_rule(violations: DataFrame, table: str, name: str, category: str) -> DataFrame:
    """Rule over rows that must not exist; only violations are counted."""
    bad = F.col("_bad")
    return violations.agg(F.count("*").alias("_bad")).select(
        F.inline(F.array(_result(name, category, table, F.greatest(bad, F.lit(1)), bad)))
    )


def agrees_rule(
    stored: DataFrame | None, source: DataFrame, keys: Sequence[str], compare: Sequence[str],
    table: str, name: str, *, missing_conflicts: bool,
) -> DataFrame:
    """Stored rows of a publication must equal its source; nothing stored, nothing joined."""
    if stored is None:
        return unchecked_rule(source, table, name, "CONSISTENCY")
    return empty_rule(
        conflicting_rows(stored, source, keys, compare, missing_conflicts=missing_conflicts),
        table, name, "CONSISTENCY",
    )


def unchecked_rule(rows: DataFrame, table: str, name: str, category: str) -> DataFrame:
    """Rule that had nothing to look at: passed over zero rows."""
    zero = F.lit(0)
    return rows.sparkSession.range(1).select(
        F.inline(F.array(_result(name, category, table, zero, zero)))
    )


def true_rule(row: DataFrame, table: str, name: str, holds: Column, category: str) -> DataFrame:
    """Rule over a one-row frame."""
    bad = F.when(F.coalesce(holds, F.lit(False)), 0).otherwise(1)
    return row.select(F.inline(F.array(_result(name, category, table, F.lit(1), bad))))


def _all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def snapshot_loaded(snapshots: DataFrame, snapshot_key: int, name: str) -> DataFrame:
    own = (F.col("snapshot_key") == snapshot_key) & (F.col("snapshot_status") == "LOADED")
    row = snapshots.agg(F.count_if(own).alias("_rows"))
    return true_rule(row, "source_snapshot", name, F.col("_rows") > 0, "PREREQUISITE")


def stage_succeeded(runs: DataFrame, snapshot_key: int, stage: str, name: str) -> DataFrame:
    own = (
        (F.col("snapshot_key") == snapshot_key)
        & (F.col("pipeline_name") == stage)
        & (F.col("run_status") == "SUCCEEDED")
    )
    row = runs.agg(F.count_if(own).alias("_rows"))
    return true_rule(row, "pipeline_run", name, F.col("_rows") > 0, "PREREQUISITE")


def not_older(
    dimensions: Sequence[DataFrame], snapshots: DataFrame, snapshot_key: int, name: str, table: str
) -> DataFrame:
    """No current version comes from a later download."""
    loads = _all([current_versions(d).select("valid_from_snapshot_key") for d in dimensions])
    later = snapshots.where(
        F.col("downloaded_at_utc") > downloaded_at(snapshots, snapshot_key)
    ).select(F.col("snapshot_key").alias("valid_from_snapshot_key"))
    violations = loads.join(later, "valid_from_snapshot_key", "left_semi")
    return empty_rule(violations, table, name, "PREREQUISITE")


def _given(name: str) -> Column:
    return ~is_blank(name)


def _coded_bad(name: str, highest: int) -> Column:
    """Given but not a code in 0..highest."""
    value = small_number(name)
    return _given(name) & ~F.coalesce(value.between(0, highest), F.lit(False))


def _outside(value: Column, limit: int) -> Column:
    return ~F.coalesce(value.between(-limit, limit), F.lit(False))


def _bad_distance(name: str) -> Column:
    return _given(name) & ~F.coalesce(distance(name) >= 0, F.lit(False))


def dq_core(
    snapshots: DataFrame,
    snapshot_key: int,
    operators: DataFrame,
    agency: DataFrame,
    calendar: DataFrame,
    exceptions: DataFrame,
    bounds: DataFrame,
) -> DataFrame:
    first, last = F.col("minimum_date"), F.col("maximum_date")
    span = F.datediff(last, first)
    bad_date = {
        name: _given(name) & feed_date(name).isNull() for name in ("start_date", "end_date", "date")
    }
    return _all(
        [
            snapshot_loaded(snapshots, snapshot_key, "50001 snapshot is loaded"),
            not_older(
                [operators], snapshots, snapshot_key, "50002 operator history is not newer",
                "dim_operator",
            ),
            rows_rules(
                agency,
                "gtfs_agency",
                {
                    "50004 agency id and name are given": is_blank("agency_id")
                    | is_blank("agency_name")
                },
                present="50003 agency rows are staged",
            ),
            unique_rule(
                agency, "gtfs_agency", "50005 agency id is unique", [trimmed("agency_id")]
            ),
            rows_rules(
                calendar,
                "gtfs_calendar",
                {"50006 calendar dates parse": bad_date["start_date"] | bad_date["end_date"]},
            ),
            rows_rules(
                exceptions,
                "gtfs_calendar_dates",
                {"50007 exception dates parse": bad_date["date"]},
            ),
            true_rule(
                bounds, "dim_date", "50008 date range exists", first.isNotNull(), "COMPLETENESS"
            ),
            true_rule(
                bounds, "dim_date", "50009 date range is ordered",
                first.isNull() | (last >= first), "VALIDITY",
            ),
            true_rule(
                bounds, "dim_date", "50010 date range is at most twenty years",
                first.isNull() | (span <= MAXIMUM_DATE_RANGE_DAYS), "VALIDITY",
            ),
        ]
    )


def dq_network(
    snapshots: DataFrame,
    runs: DataFrame,
    snapshot_key: int,
    operators: DataFrame,
    dim_route: DataFrame,
    dim_stop: DataFrame,
    routes: DataFrame,
    stops: DataFrame,
) -> DataFrame:
    def bad_colour(name: str) -> Column:
        return _given(name) & ~trimmed(name).rlike(HEX_COLOUR)

    return _all(
        [
            snapshot_loaded(snapshots, snapshot_key, "50101 snapshot is loaded"),
            stage_succeeded(
                runs, snapshot_key, ENTITY_STAGES[0], "50102 core stage succeeded"
            ),
            not_older(
                [dim_route, dim_stop], snapshots, snapshot_key,
                "50103 network history is not newer", "dim_route",
            ),
            rows_rules(
                routes,
                "gtfs_routes",
                {
                    "50106 route id, agency and type are valid": is_blank("route_id")
                    | is_blank("agency_id")
                    | ~F.coalesce(small_number("route_type") >= 0, F.lit(False)),
                    "50108 route colours are six hex digits": bad_colour("route_color")
                    | bad_colour("route_text_color"),
                },
                present="50104 route rows are staged",
            ),
            unique_rule(routes, "gtfs_routes", "50107 route id is unique", [trimmed("route_id")]),
            resolves_rule(
                routes, "gtfs_routes", "50109 route operator resolves", trimmed("agency_id"),
                current_versions(operators), "agency_id",
            ),
            rows_rules(
                stops,
                "gtfs_stops",
                {
                    "50110 stop id, name and coordinates are valid": is_blank("stop_id")
                    | is_blank("stop_name")
                    | _outside(coordinate("stop_lat"), 90)
                    | _outside(coordinate("stop_lon"), 180),
                    "50112 stop codes are valid": _coded_bad("location_type", 4)
                    | _coded_bad("wheelchair_boarding", 2),
                },
                present="50105 stop rows are staged",
            ),
            unique_rule(stops, "gtfs_stops", "50111 stop id is unique", [trimmed("stop_id")]),
        ]
    )


def dq_calendar(
    snapshots: DataFrame,
    runs: DataFrame,
    snapshot_key: int,
    calendar: DataFrame,
    exceptions: DataFrame,
    stored_services: DataFrame | None,
    dates: DataFrame,
) -> DataFrame:
    flags = reduce(
        lambda left, right: left | right,
        [~F.coalesce(trimmed(day).isin("0", "1"), F.lit(False))
         for day in service_calendar.WEEKDAYS],
    )
    start, end = feed_date("start_date"), feed_date("end_date")
    typed = service_calendar.exception_source(exceptions)
    source = service_calendar.service_source(calendar, typed)
    rows = calendar.select(F.lit(1)).union(exceptions.select(F.lit(1)))
    additions = typed.where(F.col("exception_type") == service_calendar.DATE_ADDED)
    known = (
        calendar.select(trimmed("service_id").alias("service_id"))
        .union(additions.select("service_id"))
    )
    orphans = typed.join(known, "service_id", "left_anti")
    own_services = (
        None if stored_services is None
        else stored_services.where(F.col("snapshot_key") == snapshot_key)
    )
    return _all(
        [
            snapshot_loaded(snapshots, snapshot_key, "50201 snapshot is loaded"),
            stage_succeeded(
                runs, snapshot_key, ENTITY_STAGES[0], "50202 core stage succeeded"
            ),
            rows_rules(rows, "gtfs_calendar", {}, present="50203 service rows are staged"),
            rows_rules(
                calendar,
                "gtfs_calendar",
                {
                    "50204 calendar values are valid": is_blank("service_id")
                    | flags
                    | ~F.coalesce(end >= start, F.lit(False))
                },
            ),
            unique_rule(
                calendar, "gtfs_calendar", "50205 service id is unique", [trimmed("service_id")]
            ),
            rows_rules(
                exceptions,
                "gtfs_calendar_dates",
                {
                    "50206 exception values are valid": is_blank("service_id")
                    | feed_date("date").isNull()
                    | ~F.coalesce(small_number("exception_type").isin(1, 2), F.lit(False))
                },
            ),
            unique_rule(
                exceptions, "gtfs_calendar_dates", "50207 service exception date is unique",
                [trimmed("service_id"), feed_date("date")],
            ),
            empty_rule(
                orphans, "gtfs_calendar_dates", "50208 exception-only service has an added date",
                "REFERENCE",
            ),
            agrees_rule(
                own_services, source, ("service_id",), ("row_hash",), "dim_service",
                "50209 stored services agree", missing_conflicts=True,
            ),
            empty_rule(
                typed.join(
                    F.broadcast(dates.select(F.col("full_date").alias("service_date"))),
                    "service_date", "left_anti",
                ),
                "dim_date", "50210 dates cover every exception", "REFERENCE",
            ),
        ]
    )


def dq_trips(
    snapshots: DataFrame,
    runs: DataFrame,
    snapshot_key: int,
    trips: DataFrame,
    route_versions: DataFrame,
    services: DataFrame,
    shapes: DataFrame,
    stored_trips: DataFrame | None,
    source_trips: DataFrame,
) -> DataFrame:
    own_services = services.where(F.col("snapshot_key") == snapshot_key)
    return _all(
        [
            snapshot_loaded(snapshots, snapshot_key, "50301 snapshot is loaded"),
            stage_succeeded(
                runs, snapshot_key, ENTITY_STAGES[1], "50302 network stage succeeded"
            ),
            stage_succeeded(
                runs, snapshot_key, ENTITY_STAGES[2], "50303 service stage succeeded"
            ),
            rows_rules(
                trips,
                "gtfs_trips",
                {
                    "50305 route, service and trip id are given": is_blank("route_id")
                    | is_blank("service_id")
                    | is_blank("trip_id"),
                    "50307 trip codes are valid": _coded_bad("direction_id", 1)
                    | _coded_bad("wheelchair_accessible", 2),
                },
                present="50304 trip rows are staged",
            ),
            unique_rule(trips, "gtfs_trips", "50306 trip id is unique", [trimmed("trip_id")]),
            resolves_rule(
                trips, "gtfs_trips", "50308 route version resolves", trimmed("route_id"),
                route_versions, "route_id",
            ),
            resolves_rule(
                trips, "gtfs_trips", "50309 service resolves", trimmed("service_id"),
                own_services, "service_id",
            ),
            resolves_rule(
                trips.where(_given("shape_id")), "gtfs_trips", "50310 shape resolves",
                trimmed("shape_id"), service_calendar.available_shapes(shapes), "shape_id",
            ),
            agrees_rule(
                None if stored_trips is None
                else stored_trips.where(F.col("snapshot_key") == snapshot_key),
                source_trips, TRIP_KEYS, TRIP_COMPARE, "dim_trip", "50311 stored trips agree",
                missing_conflicts=True,
            ),
        ]
    )


def dq_shapes(
    snapshots: DataFrame,
    runs: DataFrame,
    snapshot_key: int,
    shapes: DataFrame,
    stored_points: DataFrame | None,
    source_points: DataFrame,
    stage: str,
) -> DataFrame:
    return _all(
        [
            snapshot_loaded(snapshots, snapshot_key, "50401 snapshot is loaded"),
            stage_succeeded(runs, snapshot_key, stage, "50402 high volume stage succeeded"),
            rows_rules(
                shapes,
                "gtfs_shapes",
                {
                    "50404 shape values are valid": is_blank("shape_id")
                    | _outside(coordinate("shape_pt_lat"), 90)
                    | _outside(coordinate("shape_pt_lon"), 180)
                    | ~F.coalesce(whole_number("shape_pt_sequence") >= 0, F.lit(False))
                    | _bad_distance("shape_dist_traveled")
                },
                present="50403 shape rows are staged",
            ),
            unique_rule(
                shapes, "gtfs_shapes", "50405 shape point is unique",
                [trimmed("shape_id"), whole_number("shape_pt_sequence")],
            ),
            agrees_rule(
                stored_points, source_points, SHAPE_KEYS, SHAPE_COMPARE, "shape_point",
                "50408 stored points agree", missing_conflicts=False,
            ),
        ]
    )


# Sequence numbers of one trip that are counted together; a longer trip is dealt to several tasks.
SEQUENCE_BLOCK_BITS = 10


def call_rules(calls: DataFrame, trips: DataFrame, stop_versions: DataFrame) -> DataFrame:
    """Rules over staged calls, from two scans.

    One aggregate by stop counts rows, bad values and unknown stops and combines before its
    shuffle. The other places the calls by trip once: calls of equal sequence, then of one trip,
    are counted there, and only counts by trip meet the known trips.
    """
    table = "gtfs_stop_times"
    bad = (
        is_blank("trip_id")
        | is_blank("stop_id")
        | ~F.coalesce(whole_number("stop_sequence") >= 0, F.lit(False))
        | call_seconds("arrival_time").isNull()
        | call_seconds("departure_time").isNull()
        | _coded_bad("pickup_type", 3)
        | _coded_bad("drop_off_type", 3)
        | _bad_distance("shape_dist_traveled")
        | _coded_bad("timepoint", 1)
    )
    by_stop = _with_known(
        calls.select(
            trimmed("stop_id").alias("_key"), F.lit(1).cast("bigint").alias("_rows"),
            bad.cast("bigint").alias("_bad"),
        ),
        stop_versions.select(F.col("stop_id").alias("_key")),
    )
    placed = calls.select(
        trimmed("trip_id").alias("_key"), whole_number("stop_sequence").alias("_sequence")
    ).withColumn("_block", F.shiftright("_sequence", SEQUENCE_BLOCK_BITS))
    of_trip = (
        placed.repartition("_key", "_block")
        .groupBy("_key", "_block", "_sequence").agg(F.count("*").alias("_rows"))
        .groupBy("_key", "_block")
        .agg(F.sum("_rows").alias("_rows"), F.count_if(F.col("_rows") > 1).alias("_bad"))
    )
    by_trip = _with_known(
        of_trip.select("_key", "_rows", "_bad"), trips.select(F.col("trip_id").alias("_key"))
    )
    rows, unknown = F.col("_rows"), F.col("_unknown")
    empty = F.when(rows == 0, 1).otherwise(0)
    return by_stop.select(
        F.inline(
            F.array(
                _result("50503 call rows are staged", "COMPLETENESS", table, F.greatest(rows, F.lit(1)), empty),
                _result("50504 call values are valid", "VALIDITY", table, rows, F.col("_bad")),
                _result("50507 stop version resolves", "REFERENCE", table, rows, unknown),
            )
        )
    ).unionByName(
        by_trip.select(
            F.inline(
                F.array(
                    _result("50505 trip sequence is unique", "UNIQUENESS", table, rows, F.col("_bad")),
                    _result("50506 trip resolves", "REFERENCE", table, rows, unknown),
                )
            )
        )
    )


def _with_known(counted: DataFrame, known: DataFrame) -> DataFrame:
    """Totals of counted rows and of those under no known key; a NULL key is never known.

    Both sides meet in one aggregate by key, which combines before its shuffle.
    """
    zero = F.lit(0).cast("bigint")
    marks = known.where("_key IS NOT NULL").select(
        "_key", zero.alias("_rows"), zero.alias("_bad"), F.lit(True).alias("_known")
    )
    by_key = counted.withColumn("_known", F.lit(False)).unionByName(marks).groupBy("_key").agg(
        F.sum("_rows").alias("_rows"), F.sum("_bad").alias("_bad"), F.bool_or("_known").alias("_known")
    )
    nothing = F.lit(0)
    return by_key.agg(
        F.coalesce(F.sum("_rows"), nothing).alias("_rows"),
        F.coalesce(F.sum("_bad"), nothing).alias("_bad"),
        F.coalesce(F.sum(F.when(~F.col("_known"), F.col("_rows"))), nothing).alias("_unknown"),
    )


def dq_stop_times(
    snapshots: DataFrame,
    runs: DataFrame,
    snapshot_key: int,
    stop_times: DataFrame,
    trips: DataFrame,
    stop_versions: DataFrame,
    stored_events: DataFrame | None,
    source_events: DataFrame,
) -> DataFrame:
    own_trips = trips.where(F.col("snapshot_key") == snapshot_key)
    return _all(
        [
            snapshot_loaded(snapshots, snapshot_key, "50501 snapshot is loaded"),
            stage_succeeded(runs, snapshot_key, ENTITY_STAGES[3], "50502 trip stage succeeded"),
            call_rules(stop_times, own_trips, stop_versions),
            agrees_rule(
                stored_events, source_events, EVENT_KEYS, EVENT_COMPARE,
                "fact_scheduled_stop_event", "50511 stored events agree",
                missing_conflicts=False,
            ),
        ]
    )


def dq_window_bounds(window_row: DataFrame) -> DataFrame:
    """Rules over the one-row reporting window, before a window can be resolved."""
    start = F.col("reporting_start_date")
    return _all(
        [
            true_rule(
                window_row, "bridge_service_date", "50607 service dates exist",
                F.col("first_service_date").isNotNull(), "COMPLETENESS",
            ),
            true_rule(
                window_row, "bridge_service_date", "50617 window starts within service dates",
                start <= F.col("last_service_date"), "VALIDITY",
            ),
        ]
    )


def dq_window_content(
    bridge: DataFrame, window: Window, window_events: DataFrame, snapshot_key: int
) -> DataFrame:
    """Rules over what the facts are derived from."""
    inverted = (
        window_events.groupBy("trip_key")
        .agg(
            F.max("arrival_seconds").alias("last_arrival"),
            F.min("departure_seconds").alias("first_departure"),
        )
        .where(F.col("last_arrival") < F.col("first_departure"))
    )
    return _all(
        [
            rows_rules(
                window_events, "fact_scheduled_stop_event", {},
                present="50606 window has events",
            ),
            empty_rule(
                inverted, "fact_scheduled_stop_event", "50609 trip span is not negative",
                "VALIDITY",
            ),
            rows_rules(
                window_bridge(bridge, window, snapshot_key), "bridge_service_date", {},
                present="50618 window has service dates",
            ),
        ]
    )


def _fact_rules(
    window: Window, snapshot_key: int, stored: DataFrame | None, derived: DataFrame,
    keys: Sequence[str], compare: Sequence[str], table: str, codes: Sequence[str],
    slices: Sequence[Column] = (),
) -> list[DataFrame]:
    """Rules over the stored facts of one table.

    With ``slices``, conditions on the day that share out all rows, the tables are joined
    slice by slice, so that only one slice's shuffle is on disk at a time.
    """
    own = F.col("snapshot_key") == snapshot_key
    if stored is None:
        categories = ("CONSISTENCY", "CONSISTENCY", "COMPLETENESS")
        return [
            unchecked_rule(derived, table, code, category)
            for code, category in zip(codes, categories, strict=True)
        ]
    counts = stored.where(own).agg(F.count("*").alias("_stored")).select(
        "_stored", derived.select(F.count("*")).scalar().alias("_derived")
    )
    # One join for both rules: a stored row disagrees with a derived one, or has none.
    source = derived.select(
        *keys, F.lit(True).alias("_found"), *[F.col(c).alias(f"_source_{c}") for c in compare]
    )
    unequal = reduce(lambda left, other: left | other, [differs(c, f"_source_{c}") for c in compare])
    found, in_window = F.col("_found").isNotNull(), own & window.covers(F.col("full_date"))

    def disagreements(rows: DataFrame, others: DataFrame) -> DataFrame:
        return rows.join(others, list(keys), "left").agg(
            F.count_if(found & unequal).alias("_unequal"),
            F.count_if(~found & in_window).alias("_underived"),
        )

    if slices:
        parts = [settled(disagreements(stored.where(part), source.where(part)), "agreement") for part in slices]
        bad = _all(parts).agg(*[F.sum(c).alias(c) for c in ("_unequal", "_underived")])
    else:
        bad = disagreements(stored, source)
    return [
        bad.select(
            F.inline(
                F.array(
                    *[
                        _result(code, "CONSISTENCY", table, F.greatest(F.col(name), F.lit(1)), F.col(name))
                        for code, name in zip(codes, ("_unequal", "_underived"), strict=False)
                    ]
                )
            )
        ),
        true_rule(
            counts, table, codes[2], F.col("_stored") == F.col("_derived"), "COMPLETENESS"
        ),
    ]


def day_slices(window: Window, days: int = AGREEMENT_DAYS) -> list[Column]:
    """Conditions on ``date_key`` that share out all rows: the window cut, its ends left open."""
    key = F.coalesce(F.col("date_key"), F.lit(0))
    cuts = [
        int((window.first + timedelta(days=n)).strftime("%Y%m%d")) for n in range(days, window.days, days)
    ]
    lower = [None, *cuts]
    return [
        (F.lit(True) if first is None else key >= first) & (F.lit(True) if last is None else key < last)
        for first, last in zip(lower, [*cuts, None], strict=True)
    ]


def dq_fact_agreement(
    window: Window,
    stored_routes: DataFrame | None,
    derived_routes: DataFrame,
    stored_stops: DataFrame | None,
    derived_stops: DataFrame,
    snapshot_key: int,
    slices: Sequence[Column] = (),
) -> DataFrame:
    """Stored facts of the publication against the derived ones."""
    return _all(
        [
            *_fact_rules(
                window, snapshot_key, stored_routes, derived_routes, ROUTE_DAY_KEYS, ROUTE_DAY_COMPARE,
                "fact_route_service_day",
                (
                    "50610 stored route facts agree", "50611 stored route facts are derived",
                    "50614 route fact count is complete",
                ),
                slices,
            ),
            *_fact_rules(
                window, snapshot_key, stored_stops, derived_stops, STOP_DAY_KEYS, STOP_DAY_COMPARE,
                "fact_stop_service_day",
                (
                    "50612 stored stop facts agree", "50613 stored stop facts are derived",
                    "50615 stop fact count is complete",
                ),
                slices,
            ),
        ]
    )


def dq_daily_facts(
    bridge: DataFrame,
    window_row: DataFrame,
    window: Window,
    window_events: DataFrame,
    stored_routes: DataFrame | None,
    derived_routes: DataFrame,
    stored_stops: DataFrame | None,
    derived_stops: DataFrame,
    snapshot_key: int,
) -> DataFrame:
    """All rules of the daily facts; the stored facts are joined in slices of days."""
    return _all(
        [
            dq_window_bounds(window_row),
            dq_window_content(bridge, window, window_events, snapshot_key),
            dq_fact_agreement(
                window, stored_routes, derived_routes, stored_stops, derived_stops, snapshot_key,
                day_slices(window),
            ),
        ]
    )


def dq_changes(
    snapshots: DataFrame,
    runs: DataFrame,
    previous_key: int,
    current_key: int,
    stored: DataFrame | None,
    detected: DataFrame,
) -> DataFrame:
    stages = succeeded_entity_stages(runs)

    def complete(snapshot_key: int, name: str) -> DataFrame:
        row = stages.where(F.col("snapshot_key") == snapshot_key).agg(
            F.max("stage_count").alias("_stages")
        )
        return true_rule(
            row, "pipeline_run", name, F.col("_stages") >= len(ENTITY_STAGES), "PREREQUISITE"
        )

    earlier = snapshots.agg(
        F.count_if(
            (F.col("snapshot_key") == previous_key)
            & (F.col("snapshot_status") == "LOADED")
            & F.lit(previous_key < current_key)
        ).alias("_rows")
    )
    pair = None if stored is None else stored.where(
        (F.col("previous_snapshot_key") == previous_key)
        & (F.col("current_snapshot_key") == current_key)
    )
    return _all(
        [
            snapshot_loaded(snapshots, current_key, "50701 current snapshot is loaded"),
            complete(current_key, "50702 current entity stages succeeded"),
            true_rule(
                earlier, "source_snapshot", "50703 previous snapshot is earlier and loaded",
                F.col("_rows") > 0, "PREREQUISITE",
            ),
            complete(previous_key, "50704 previous entity stages succeeded"),
            agrees_rule(
                pair, detected, CHANGE_KEYS, CHANGE_COMPARE, "fact_publication_change",
                "50705 stored changes agree", missing_conflicts=True,
            ),
        ]
    )


# Permitted status names.
SNAPSHOT_STATUSES = ("RECEIVED", "VALIDATED", "LOADED", "REJECTED")
RUN_STATUSES = ("STARTED", "SUCCEEDED", "FAILED", "PARTIAL", "CANCELLED")
CHECK_STATUSES = ("PASS", "WARN", "FAIL")


def dq_model(
    snapshots: DataFrame,
    runs: DataFrame,
    quality: DataFrame,
    operators: DataFrame,
    routes: DataFrame,
    stops: DataFrame,
    changes: DataFrame,
) -> DataFrame:
    """Table constraints as rules."""

    def history(rows: DataFrame, table: str, surrogate: str, key: str) -> list[DataFrame]:
        flag = F.col("is_current") != F.col("valid_to_snapshot_key").isNull()
        return [
            rows_rules(rows, table, {f"{table} current flag matches validity": flag}),
            unique_rule(rows, table, f"{table} version key is unique", [F.col(surrogate)]),
            unique_rule(
                current_versions(rows), table, f"{table} has one current version per id",
                [F.col(key)],
            ),
        ]

    before, after = F.col("previous_row_hash"), F.col("current_row_hash")
    kind = F.col("change_type")
    pattern = (
        F.when(kind == "ADDED", before.isNull() & after.isNotNull())
        .when(kind == "REMOVED", before.isNotNull() & after.isNull())
        .when(kind == "MODIFIED", before.isNotNull() & after.isNotNull() & (before != after))
        .otherwise(F.lit(False))
    )
    details = F.col("change_details_json")
    return _all(
        [
            rows_rules(
                snapshots,
                "source_snapshot",
                {
                    "source_snapshot size is positive": F.col("file_size_bytes") <= 0,
                    "source_snapshot status is known": ~F.col("snapshot_status").isin(
                        *SNAPSHOT_STATUSES
                    ),
                },
            ),
            unique_rule(
                snapshots, "source_snapshot", "source_snapshot sha256 is unique", [F.col("sha256")]
            ),
            rows_rules(
                runs,
                "pipeline_run",
                {
                    "pipeline_run status is known": ~F.col("run_status").isin(*RUN_STATUSES),
                    "pipeline_run ends after it starts": F.coalesce(
                        F.col("completed_at_utc") < F.col("started_at_utc"), F.lit(False)
                    ),
                    "pipeline_run counts are not negative": F.least(
                        "rows_read", "rows_loaded", "rows_rejected"
                    )
                    < 0,
                },
            ),
            rows_rules(
                quality,
                "data_quality_result",
                {
                    "data_quality_result status is known": ~F.col("check_status").isin(
                        *CHECK_STATUSES
                    ),
                    "data_quality_result counts are consistent": (F.col("failed_records") < 0)
                    | (F.col("failed_records") > F.col("records_checked")),
                },
            ),
            *history(operators, "dim_operator", "operator_key", "agency_id"),
            *history(routes, "dim_route", "route_key", "route_id"),
            *history(stops, "dim_stop", "stop_key", "stop_id"),
            rows_rules(
                changes,
                "fact_publication_change",
                {
                    "fact_publication_change hashes match the type": ~pattern,
                    "fact_publication_change details are JSON": details.isNotNull()
                    & F.try_parse_json(details).isNull(),
                },
            ),
        ]
    )


def gate(results: DataFrame) -> None:
    """Raise when any rule failed. Results hold one row per rule."""
    failures = [
        f"{row.check_name} ({row.table_name}: {row.failed_records} of {row.records_checked})"
        for row in results.where(F.col("check_status") == "FAIL").collect()
    ]
    if failures:
        raise QualityError("; ".join(sorted(failures)))
