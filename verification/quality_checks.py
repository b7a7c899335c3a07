"""Quality-rule queries over the faulty publication, with their checking SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linespan.operators import quality
from linespan.schemas import STAGE_HIGH_VOLUME
from linespan.sources.feed import with_lineage
from verification.projection import LATEST_SNAPSHOT, OLDER_SNAPSHOT, projected
from verification.oracle import STAGE_LIST
from verification.queries import query
from verification.world import World

INTEGER = "'\\s*[+-]?[0-9]+\\s*'"
DECIMAL = "'\\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)\\s*'"


def _rule(name: str, category: str, table: str, checked: str, failed: str) -> str:
    return f"""
        SELECT '{name}' AS check_name, '{category}' AS check_category, '{table}' AS table_name,
               CASE WHEN f > 0 THEN 'FAIL' ELSE 'PASS' END AS check_status,
               CAST(c AS BIGINT) AS records_checked, CAST(f AS BIGINT) AS failed_records
        FROM (SELECT {checked} AS c, {failed} AS f) r"""


def _rows(name: str, table: str, source: str, bad: str) -> str:
    return _rule(
        name, "VALIDITY", table, f"(SELECT COUNT(*) FROM {source})",
        f"(SELECT COUNT(*) FROM {source} WHERE {bad})",
    )


def _present(name: str, table: str, source: str) -> str:
    count = f"(SELECT COUNT(*) FROM {source})"
    return _rule(
        name, "COMPLETENESS", table, f"GREATEST({count}, 1)",
        f"CASE WHEN {count} = 0 THEN 1 ELSE 0 END",
    )


def _unique(name: str, table: str, source: str, keys: str) -> str:
    return _rule(
        name, "UNIQUENESS", table, f"(SELECT COUNT(*) FROM {source})",
        f"(SELECT COUNT(*) FROM (SELECT {keys} FROM {source} GROUP BY {keys} "
        f"HAVING COUNT(*) > 1) d)",
    )


def _resolves(name: str, table: str, source: str, key: str, known: str, known_key: str) -> str:
    return _rule(
        name, "REFERENCE", table, f"(SELECT COUNT(*) FROM {source})",
        f"(SELECT COUNT(*) FROM {source} a WHERE NOT EXISTS "
        f"(SELECT 1 FROM {known} k WHERE k.{known_key} = {key}))",
    )


def _none(name: str, category: str, table: str, violations: str) -> str:
    count = f"(SELECT COUNT(*) FROM ({violations}) v)"
    return _rule(name, category, table, f"GREATEST({count}, 1)", count)


def _holds(name: str, category: str, table: str, condition: str) -> str:
    return _rule(name, category, table, "1", f"CASE WHEN {condition} THEN 0 ELSE 1 END")


def _loaded(name: str, key: int = 2) -> str:
    return _holds(
        name, "PREREQUISITE", "source_snapshot",
        f"EXISTS (SELECT 1 FROM source_snapshot WHERE snapshot_key = {key} "
        f"AND snapshot_status = 'LOADED')",
    )


def _stage(name: str, stage: str) -> str:
    return _holds(
        name, "PREREQUISITE", "pipeline_run",
        f"EXISTS (SELECT 1 FROM pipeline_run WHERE snapshot_key = 2 AND run_status = 'SUCCEEDED' "
        f"AND pipeline_name = '{stage}')",
    )


def _not_older(name: str, table: str, dimensions: list[str], key: int) -> str:
    union = " UNION ALL ".join(
        f"SELECT valid_from_snapshot_key FROM {d} WHERE is_current" for d in dimensions
    )
    return _none(
        name, "PREREQUISITE", table,
        f"SELECT 1 FROM ({union}) u JOIN source_snapshot s ON s.snapshot_key = "
        f"u.valid_from_snapshot_key WHERE s.downloaded_at_utc > (SELECT downloaded_at_utc "
        f"FROM source_snapshot WHERE snapshot_key = {key})",
    )


def _all(*parts: str) -> str:
    return " UNION ALL ".join(parts)


def _blank(name: str) -> str:
    return f"(COALESCE(TRIM({name}), '') = '')"


def _coded(name: str, codes: str) -> str:
    return f"(NOT {_blank(name)} AND TRIM({name}) NOT IN ({codes}))"


def _date_bad(name: str) -> str:
    return (
        f"(TRY_STRPTIME({name}, '%Y%m%d') IS NULL "
        f"OR NOT regexp_full_match({name}, '[0-9]{{8}}'))"
    )


def _outside(name: str, limit: int) -> str:
    return (
        f"NOT COALESCE(regexp_full_match({name}, {DECIMAL}) AND "
        f"TRY_CAST({name} AS DECIMAL(9,6)) BETWEEN -{limit} AND {limit}, FALSE)"
    )


def _negative(name: str) -> str:
    """Not a whole number of zero or more."""
    return (
        f"NOT COALESCE(regexp_full_match({name}, {INTEGER}) "
        f"AND TRY_CAST({name} AS BIGINT) >= 0, FALSE)"
    )


def _bad_distance(name: str) -> str:
    return (
        f"(NOT {_blank(name)} AND NOT COALESCE(regexp_full_match({name}, {DECIMAL}) "
        f"AND TRY_CAST({name} AS DECIMAL(18,3)) >= 0, FALSE))"
    )


def _time_bad(name: str) -> str:
    return (
        f"NOT COALESCE(regexp_full_match(TRIM({name}), '[0-9]+:[0-5]?[0-9]:[0-5]?[0-9]'), FALSE)"
    )


def faulty(w: World, table: str) -> DataFrame:
    """A staged table of the faulty publication."""
    return w.kept(
        f"faulty_{table}",
        lambda: with_lineage(
            projected(w.spark, w.folder, f"bad_{table}"), table, LATEST_SNAPSHOT
        ),
    )


def relabelled(rows: DataFrame) -> DataFrame:
    """Rows of the older publication as if stored for the latest one."""
    new = f"{LATEST_SNAPSHOT}:"
    changed = {"snapshot_key": F.lit(LATEST_SNAPSHOT).cast("bigint")}
    for key in ("service_key", "trip_key"):
        if key in rows.columns:
            changed[key] = F.concat(F.lit(new), F.substring_index(key, ":", -1))
    return rows.withColumns(changed)


@query(
    "dq_core",
    _all(
        _loaded("50001 snapshot is loaded", 1),
        _not_older("50002 operator history is not newer", "dim_operator", ["dim_operator"], 1),
        _present("50003 agency rows are staged", "gtfs_agency", "bad_agency"),
        _rows(
            "50004 agency id and name are given", "gtfs_agency", "bad_agency",
            f"{_blank('agency_id')} OR {_blank('agency_name')}",
        ),
        _unique("50005 agency id is unique", "gtfs_agency", "bad_agency", "TRIM(agency_id)"),
        _rows(
            "50006 calendar dates parse", "gtfs_calendar", "bad_calendar",
            f"(NOT {_blank('start_date')} AND {_date_bad('start_date')}) OR "
            f"(NOT {_blank('end_date')} AND {_date_bad('end_date')})",
        ),
        _rows(
            "50007 exception dates parse", "gtfs_calendar_dates", "bad_calendar_dates",
            f"NOT {_blank('date')} AND {_date_bad('date')}",
        ),
        _holds("50008 date range exists", "COMPLETENESS", "dim_date",
               "(SELECT MIN(d) FROM dates2) IS NOT NULL"),
        _holds("50009 date range is ordered", "VALIDITY", "dim_date",
               "(SELECT MAX(d) >= MIN(d) FROM dates2)"),
        _holds("50010 date range is at most twenty years", "VALIDITY", "dim_date",
               "(SELECT MAX(d) - MIN(d) <= 7320 FROM dates2)"),
    ),
)
def dq_core(w: World) -> DataFrame:
    """Checked as if the older publication were loaded after the latest one."""
    return quality.dq_core(
        w.snapshots, OLDER_SNAPSHOT, w.latest.dim_operator, faulty(w, "agency"),
        faulty(w, "calendar"), faulty(w, "calendar_dates"), w.latest.date_bounds(),
    )


@query(
    "dq_network",
    _all(
        _loaded("50101 snapshot is loaded"),
        _stage("50102 core stage succeeded", "load_gtfs_core_warehouse"),
        _not_older(
            "50103 network history is not newer", "dim_route", ["dim_route", "dim_stop"], 2
        ),
        _present("50104 route rows are staged", "gtfs_routes", "bad_routes"),
        _rows(
            "50106 route id, agency and type are valid", "gtfs_routes", "bad_routes",
            f"{_blank('route_id')} OR {_blank('agency_id')} OR {_negative('route_type')}",
        ),
        _rows(
            "50108 route colours are six hex digits", "gtfs_routes", "bad_routes",
            " OR ".join(
                f"(NOT {_blank(c)} AND NOT regexp_full_match(TRIM({c}), '[0-9A-Fa-f]{{6}}'))"
                for c in ("route_color", "route_text_color")
            ),
        ),
        _unique("50107 route id is unique", "gtfs_routes", "bad_routes", "TRIM(route_id)"),
        _resolves(
            "50109 route operator resolves", "gtfs_routes", "bad_routes", "TRIM(a.agency_id)",
            "(SELECT agency_id FROM dim_operator WHERE is_current)", "agency_id",
        ),
        _present("50105 stop rows are staged", "gtfs_stops", "bad_stops"),
        _rows(
            "50110 stop id, name and coordinates are valid", "gtfs_stops", "bad_stops",
            f"{_blank('stop_id')} OR {_blank('stop_name')} OR {_outside('stop_lat', 90)} "
            f"OR {_outside('stop_lon', 180)}",
        ),
        _rows(
            "50112 stop codes are valid", "gtfs_stops", "bad_stops",
            _coded("location_type", "'0', '1', '2', '3', '4'")
            + " OR " + _coded("wheelchair_boarding", "'0', '1', '2'"),
        ),
        _unique("50111 stop id is unique", "gtfs_stops", "bad_stops", "TRIM(stop_id)"),
    ),
)
def dq_network(w: World) -> DataFrame:
    b = w.latest
    return quality.dq_network(
        w.snapshots, w.runs, LATEST_SNAPSHOT, b.dim_operator, b.dim_route, b.dim_stop,
        faulty(w, "routes"), faulty(w, "stops"),
    )


_FLAGS = " OR ".join(
    f"COALESCE(TRIM({day}), '') NOT IN ('0', '1')"
    for day in ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
)


@query(
    "dq_calendar",
    _all(
        _loaded("50201 snapshot is loaded"),
        _stage("50202 core stage succeeded", "load_gtfs_core_warehouse"),
        _present(
            "50203 service rows are staged", "gtfs_calendar",
            "(SELECT 1 FROM bad_calendar UNION ALL SELECT 1 FROM bad_calendar_dates) u",
        ),
        _rows(
            "50204 calendar values are valid", "gtfs_calendar", "bad_calendar",
            f"{_blank('service_id')} OR {_FLAGS} OR {_date_bad('start_date')} OR "
            f"{_date_bad('end_date')} OR end_date < start_date",
        ),
        _unique("50205 service id is unique", "gtfs_calendar", "bad_calendar", "TRIM(service_id)"),
        _rows(
            "50206 exception values are valid", "gtfs_calendar_dates", "bad_calendar_dates",
            f"{_blank('service_id')} OR {_date_bad('date')} OR "
            f"COALESCE(exception_type, '') NOT IN ('1', '2')",
        ),
        _unique(
            "50207 service exception date is unique", "gtfs_calendar_dates", "bad_calendar_dates",
            "TRIM(service_id), TRY_STRPTIME(date, '%Y%m%d')",
        ),
        _none(
            "50208 exception-only service has an added date", "REFERENCE", "gtfs_calendar_dates",
            "SELECT 1 FROM bad_calendar_dates e WHERE NOT EXISTS (SELECT 1 FROM bad_calendar c "
            "WHERE TRIM(c.service_id) = TRIM(e.service_id)) AND NOT EXISTS (SELECT 1 FROM "
            "bad_calendar_dates a WHERE TRIM(a.service_id) = TRIM(e.service_id) "
            "AND a.exception_type = '1')",
        ),
        _none(
            "50209 stored services agree", "CONSISTENCY", "dim_service",
            "SELECT 1 FROM services1 o LEFT JOIN sv_src2 n ON n.service_id = o.service_id "
            "WHERE n.service_id IS NULL OR n.row_hash <> o.row_hash",
        ),
        _none(
            "50210 dates cover every exception", "REFERENCE", "dim_date",
            "SELECT 1 FROM bad_calendar_dates e WHERE NOT EXISTS (SELECT 1 FROM dim_date d "
            "WHERE d.full_date = CAST(TRY_STRPTIME(e.date, '%Y%m%d') AS DATE))",
        ),
    ),
)
def dq_calendar(w: World) -> DataFrame:
    """Row rules on the faulty tables; 50209 on the older services as stored."""
    b = w.latest
    faults = quality.dq_calendar(
        w.snapshots, w.runs, LATEST_SNAPSHOT, faulty(w, "calendar"), faulty(w, "calendar_dates"),
        relabelled(w.older.services), b.dim_date,
    )
    clean = quality.dq_calendar(
        w.snapshots, w.runs, LATEST_SNAPSHOT, b.staged("calendar"), b.staged("calendar_dates"),
        relabelled(w.older.services), b.dim_date,
    )
    stored = F.col("check_name").startswith("50209")
    return faults.where(~stored).unionByName(clean.where(stored))


@query(
    "dq_trips",
    _all(
        _loaded("50301 snapshot is loaded"),
        _stage("50302 network stage succeeded", "load_gtfs_network_warehouse"),
        _stage("50303 service stage succeeded", "load_gtfs_service_warehouse"),
        _present("50304 trip rows are staged", "gtfs_trips", "bad_trips"),
        _rows(
            "50305 route, service and trip id are given", "gtfs_trips", "bad_trips",
            f"{_blank('route_id')} OR {_blank('service_id')} OR {_blank('trip_id')}",
        ),
        _rows(
            "50307 trip codes are valid", "gtfs_trips", "bad_trips",
            _coded("direction_id", "'0', '1'") + " OR "
            + _coded("wheelchair_accessible", "'0', '1', '2'"),
        ),
        _unique("50306 trip id is unique", "gtfs_trips", "bad_trips", "TRIM(trip_id)"),
        _resolves("50308 route version resolves", "gtfs_trips", "bad_trips",
                  "TRIM(a.route_id)", "route_at2", "route_id"),
        _resolves("50309 service resolves", "gtfs_trips", "bad_trips",
                  "TRIM(a.service_id)", "services2", "service_id"),
        _resolves(
            "50310 shape resolves", "gtfs_trips",
            f"(SELECT * FROM bad_trips WHERE NOT {_blank('shape_id')})", "TRIM(a.shape_id)",
            "p2_shapes", "shape_id",
        ),
        _none(
            "50311 stored trips agree", "CONSISTENCY", "dim_trip",
            "SELECT 1 FROM trips1 o LEFT JOIN trips2 n ON n.trip_id = o.trip_id "
            "WHERE n.trip_id IS NULL OR n.row_hash <> o.row_hash OR n.route_key <> o.route_key "
            "OR SUBSTR(n.service_key, 3) <> SUBSTR(o.service_key, 3)",
        ),
    ),
)
def dq_trips(w: World) -> DataFrame:
    b = w.latest
    return quality.dq_trips(
        w.snapshots, w.runs, LATEST_SNAPSHOT, faulty(w, "trips"), b.route_versions(), b.services,
        b.staged("shapes"), relabelled(w.older.trips), b.trip_source(),
    )


@query(
    "dq_shapes",
    _all(
        _loaded("50401 snapshot is loaded"),
        _stage("50402 high volume stage succeeded", STAGE_HIGH_VOLUME),
        _present("50403 shape rows are staged", "gtfs_shapes", "bad_shapes"),
        _rows(
            "50404 shape values are valid", "gtfs_shapes", "bad_shapes",
            f"{_blank('shape_id')} OR {_outside('shape_pt_lat', 90)} OR "
            f"{_outside('shape_pt_lon', 180)} OR {_negative('shape_pt_sequence')} OR "
            f"{_bad_distance('shape_dist_traveled')}",
        ),
        _unique("50405 shape point is unique", "gtfs_shapes", "bad_shapes",
                "TRIM(shape_id), TRY_CAST(shape_pt_sequence AS BIGINT)"),
        _none("50408 stored points agree", "CONSISTENCY", "shape_point",
              "SELECT 1 FROM shape_point WHERE shape_dist_travelled IS NOT NULL"),
    ),
)
def dq_shapes(w: World) -> DataFrame:
    """Stored points lack their distances, so every measured point disagrees."""
    b = w.latest
    stored = b.shapes.withColumn("shape_dist_travelled", F.lit(None).cast("decimal(18,3)"))
    return quality.dq_shapes(
        w.snapshots, w.runs, LATEST_SNAPSHOT, faulty(w, "shapes"), stored, b.shapes,
        STAGE_HIGH_VOLUME,
    )


@query(
    "dq_stop_times",
    _all(
        _loaded("50501 snapshot is loaded"),
        _stage("50502 trip stage succeeded", "load_gtfs_trip_warehouse"),
        _present("50503 call rows are staged", "gtfs_stop_times", "bad_stop_times"),
        _rows(
            "50504 call values are valid", "gtfs_stop_times", "bad_stop_times",
            f"{_blank('trip_id')} OR {_blank('stop_id')} OR {_negative('stop_sequence')} OR "
            f"{_time_bad('arrival_time')} OR {_time_bad('departure_time')} OR "
            + _coded("pickup_type", "'0', '1', '2', '3'") + " OR "
            + _coded("drop_off_type", "'0', '1', '2', '3'") + " OR "
            + _bad_distance("shape_dist_traveled") + " OR " + _coded("timepoint", "'0', '1'"),
        ),
        _unique("50505 trip sequence is unique", "gtfs_stop_times", "bad_stop_times",
                "TRIM(trip_id), TRY_CAST(stop_sequence AS BIGINT)"),
        _resolves("50506 trip resolves", "gtfs_stop_times", "bad_stop_times",
                  "TRIM(a.trip_id)", "trips2", "trip_id"),
        _resolves("50507 stop version resolves", "gtfs_stop_times", "bad_stop_times",
                  "TRIM(a.stop_id)", "stop_at2", "stop_id"),
        _none("50511 stored events agree", "CONSISTENCY", "fact_scheduled_stop_event",
              "SELECT 1 FROM ev WHERE NOT is_timepoint"),
    ),
)
def dq_stop_times(w: World) -> DataFrame:
    """Stored events carry another hash where the call is not a timepoint."""
    b = w.latest
    stored = b.events.withColumn(
        "row_hash", F.when(F.col("is_timepoint"), F.col("row_hash")).otherwise("changed")
    )
    return quality.dq_stop_times(
        w.snapshots, w.runs, LATEST_SNAPSHOT, faulty(w, "stop_times"), b.trips, b.stop_versions(),
        stored, b.events,
    )


_MARKED_DAY = "2024-02-01"


def _fact_rules(table: str, source: str, codes: tuple[str, str, str]) -> str:
    marked = f"(SELECT COUNT(*) FROM {source} WHERE full_date = DATE '{_MARKED_DAY}')"
    return _all(
        _rule(codes[0], "CONSISTENCY", table, f"GREATEST({marked}, 1)", marked),
        _rule(codes[1], "CONSISTENCY", table, f"GREATEST({marked}, 1)", marked),
        _holds(codes[2], "COMPLETENESS", table, f"{marked} = 0"),
    )


@query(
    "dq_daily_facts",
    _all(
        _present("50606 window has events", "fact_scheduled_stop_event", "wev"),
        _holds("50607 service dates exist", "COMPLETENESS", "bridge_service_date",
               "(SELECT COUNT(*) FROM bridge2) > 0"),
        _none("50609 trip span is not negative", "VALIDITY", "fact_scheduled_stop_event",
              "SELECT trip_key FROM wev GROUP BY trip_key "
              "HAVING MAX(arrival_seconds) < MIN(departure_seconds)"),
        _fact_rules(
            "fact_route_service_day", "route_fact",
            ("50610 stored route facts agree", "50611 stored route facts are derived",
             "50614 route fact count is complete"),
        ),
        _fact_rules(
            "fact_stop_service_day", "stop_fact",
            ("50612 stored stop facts agree", "50613 stored stop facts are derived",
             "50615 stop fact count is complete"),
        ),
        _holds("50617 window starts within service dates", "VALIDITY", "bridge_service_date",
               "(SELECT reporting_start_date <= last_service_date FROM win)"),
        _present("50618 window has service dates", "bridge_service_date", "wb"),
    ),
)
def dq_daily_facts(w: World) -> DataFrame:
    """Stored facts of one day count a trip too many, and appear again under unknown keys."""
    b = w.latest
    marked = F.col("full_date") == F.lit(_MARKED_DAY).cast("date")

    def altered(rows: DataFrame, key: str) -> DataFrame:
        trips = F.col("scheduled_trip_count")
        wrong = rows.withColumn("scheduled_trip_count", F.when(marked, trips + 1).otherwise(trips))
        extra = rows.where(marked).withColumn(key, F.concat(F.lit("unknown "), key))
        return wrong.unionByName(extra)

    return quality.dq_daily_facts(
        b.bridge, b.window_row(), b.window, b.window_events(),
        altered(b.route_days, "route_key"), b.route_days,
        altered(b.stop_days, "stop_key"), b.stop_days, LATEST_SNAPSHOT,
    )


def _stages(name: str, key: int) -> str:
    return _holds(
        name, "PREREQUISITE", "pipeline_run",
        f"(SELECT COUNT(DISTINCT pipeline_name) FROM pipeline_run WHERE snapshot_key = {key} "
        f"AND run_status = 'SUCCEEDED' AND pipeline_name IN ({STAGE_LIST})) >= 4",
    )


@query(
    "dq_changes",
    _all(
        _loaded("50701 current snapshot is loaded"),
        _stages("50702 current entity stages succeeded", 2),
        _holds("50703 previous snapshot is earlier and loaded", "PREREQUISITE", "source_snapshot",
               "EXISTS (SELECT 1 FROM source_snapshot WHERE snapshot_key = 1 "
               "AND snapshot_status = 'LOADED')"),
        _stages("50704 previous entity stages succeeded", 1),
        _none("50705 stored changes agree", "CONSISTENCY", "fact_publication_change",
              "SELECT 1 FROM diff WHERE entity_type = 'STOP'"),
    ),
)
def dq_changes(w: World) -> DataFrame:
    """Stored stop changes carry another type."""
    stored = w.warehouse.changes
    altered = stored.withColumn(
        "change_type",
        F.when(F.col("entity_type") == "STOP", "UNKNOWN").otherwise(F.col("change_type")),
    )
    return quality.dq_changes(
        w.snapshots, w.runs, OLDER_SNAPSHOT, LATEST_SNAPSHOT, altered, stored
    )


def _history_rules(table: str, surrogate: str, key: str) -> str:
    return _all(
        _rows(f"{table} current flag matches validity", table, table,
              "is_current <> (valid_to_snapshot_key IS NULL)"),
        _unique(f"{table} version key is unique", table, table, surrogate),
        _unique(f"{table} has one current version per id", table,
                f"(SELECT * FROM {table} WHERE is_current)", key),
    )


@query(
    "dq_model",
    _all(
        _rows("source_snapshot size is positive", "source_snapshot", "source_snapshot",
              "file_size_bytes <= 0"),
        _rows("source_snapshot status is known", "source_snapshot", "source_snapshot",
              "snapshot_status NOT IN ('RECEIVED', 'VALIDATED', 'LOADED', 'REJECTED')"),
        _unique("source_snapshot sha256 is unique", "source_snapshot", "source_snapshot", "sha256"),
        _rows("pipeline_run status is known", "pipeline_run", "pipeline_run",
              "run_status NOT IN ('STARTED', 'SUCCEEDED', 'FAILED', 'PARTIAL', 'CANCELLED')"),
        _rows("pipeline_run ends after it starts", "pipeline_run", "pipeline_run",
              "completed_at_utc < started_at_utc"),
        _rows("pipeline_run counts are not negative", "pipeline_run", "pipeline_run",
              "LEAST(rows_read, rows_loaded, rows_rejected) < 0"),
        _rows("data_quality_result status is known", "data_quality_result", "data_quality_result",
              "check_status NOT IN ('PASS', 'WARN', 'FAIL')"),
        _rows("data_quality_result counts are consistent", "data_quality_result",
              "data_quality_result", "failed_records < 0 OR failed_records > records_checked"),
        _history_rules("dim_operator", "operator_key", "agency_id"),
        _history_rules("dim_route", "route_key", "route_id"),
        _history_rules("dim_stop", "stop_key", "stop_id"),
        _rows(
            "fact_publication_change hashes match the type", "fact_publication_change",
            "change_log",
            "NOT CASE change_type WHEN 'ADDED' THEN previous_row_hash IS NULL AND "
            "current_row_hash IS NOT NULL WHEN 'REMOVED' THEN previous_row_hash IS NOT NULL AND "
            "current_row_hash IS NULL ELSE previous_row_hash <> current_row_hash END",
        ),
        _rows("fact_publication_change details are JSON", "fact_publication_change", "change_log",
              "change_details_json IS NOT NULL AND NOT json_valid(change_details_json)"),
    ),
)
def dq_model(w: World) -> DataFrame:
    b = w.latest
    return quality.dq_model(
        w.snapshots, w.runs, w.quality, b.dim_operator, b.dim_route, b.dim_stop,
        w.warehouse.changes,
    )
