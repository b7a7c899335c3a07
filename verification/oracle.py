"""Checking SQL: plain relational definitions over the same test tables."""

from __future__ import annotations

from linespan.schemas import ENTITY_STAGES, FEED_COLUMNS
from verification.projection import AS_OF, projection_sql, with_clause

HASH_CALL = "sha256({})"


def _big(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def _dbl(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


def _ratio(numerator: str, denominator: str) -> str:
    """Non-negative whole ratio in hundredths, halves up."""
    return f"((200 * ({numerator}) + ({denominator})) // (2 * ({denominator})))"


def _avg_whole(column: str) -> str:
    """Average of a whole column in hundredths."""
    return _ratio(_big(f"SUM({column})"), f"NULLIF(COUNT({column}), 0)")


def _avg_cents(column: str) -> str:
    """Average, in hundredths, of a column already in hundredths."""
    total, count = _big(f"SUM({column})"), f"NULLIF(COUNT({column}), 0)"
    return f"((2 * {total} + {count}) // (2 * {count}))"


def _hours(start: str, end: str) -> str:
    return f"date_diff('hour', {start}, {end})"


def _valid_by_key(prefix: str, key: str) -> str:
    return (
        f"{prefix}valid_from_snapshot_key <= {key} AND ({prefix}valid_to_snapshot_key IS NULL "
        f"OR {prefix}valid_to_snapshot_key > {key})"
    )


def _clean(name: str, alias: str | None = None) -> str:
    return f"NULLIF(TRIM({name}), '') AS {alias or name}"


_OPERATOR = ", ".join(
    [
        "TRIM(agency_id) AS agency_id", _clean("agency_noc"),
        "TRIM(agency_name) AS operator_name", _clean("agency_url", "operator_url"),
        _clean("agency_timezone", "operator_timezone"), _clean("agency_lang", "operator_language"),
        _clean("agency_phone", "operator_phone"), _clean("agency_email", "operator_email"),
        "row_hash",
    ]
)
_STOP = ", ".join(
    [
        "TRIM(stop_id) AS stop_id", _clean("stop_code"), "TRIM(stop_name) AS stop_name",
        _clean("stop_desc", "stop_description"),
        _dbl("CAST(stop_lat AS DECIMAL(9,6))") + " AS stop_latitude",
        _dbl("CAST(stop_lon AS DECIMAL(9,6))") + " AS stop_longitude",
        _clean("zone_id"), _clean("stop_url"),
        _big("NULLIF(TRIM(location_type), '')") + " AS location_type",
        _clean("parent_station", "parent_station_id"),
        _big("NULLIF(TRIM(wheelchair_boarding), '')") + " AS wheelchair_boarding",
        "row_hash",
    ]
)


def _history(first: str, second: str, key: str, surrogate: str, columns: str, unequal: str) -> str:
    """Two loads of a versioned dimension."""
    plain = ", ".join(f"o.{c}" for c in columns.split(", "))
    fresh = ", ".join(f"n.{c}" for c in columns.split(", "))
    return f"""
        SELECT CONCAT('1:', o.{key}) AS {surrogate}, {plain},
               CAST(1 AS BIGINT) AS valid_from_snapshot_key,
               CASE WHEN n.{key} IS NULL OR {unequal} THEN CAST(2 AS BIGINT) END
                   AS valid_to_snapshot_key,
               NOT (n.{key} IS NULL OR {unequal}) AS is_current
        FROM {first} o LEFT JOIN {second} n ON n.{key} = o.{key}
        UNION ALL
        SELECT CONCAT('2:', n.{key}), {fresh}, 2, NULL, TRUE
        FROM {second} n LEFT JOIN {first} o ON n.{key} = o.{key}
        WHERE o.{key} IS NULL OR {unequal}"""


_OPERATOR_COLUMNS = (
    "agency_id, agency_noc, operator_name, operator_url, operator_timezone, operator_language, "
    "operator_phone, operator_email, row_hash"
)
_ROUTE_COLUMNS = (
    "route_id, operator_key, route_short_name, route_long_name, route_description, route_type, "
    "route_url, route_colour, route_text_colour, row_hash"
)
_STOP_COLUMNS = (
    "stop_id, stop_code, stop_name, stop_description, stop_latitude, stop_longitude, zone_id, "
    "stop_url, location_type, parent_station_id, wheelchair_boarding, row_hash"
)
_WEEK = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")


def _day(text: str) -> str:
    return f"CAST(strptime({text}, '%Y%m%d') AS DATE)"


def _key(day: str) -> str:
    return f"CAST(strftime({day}, '%Y%m%d') AS BIGINT)"


def _seconds(text: str) -> str:
    return (
        f"(CAST(split_part({text}, ':', 1) AS BIGINT) * 3600 + "
        f"CAST(split_part({text}, ':', 2) AS BIGINT) * 60 + "
        f"CAST(split_part({text}, ':', 3) AS BIGINT))"
    )


def definitions() -> dict[str, str]:
    """Named intermediate tables, each in terms of earlier ones."""
    sql = projection_sql("TIMESTAMP", HASH_CALL)
    for key in (1, 2):
        for table, columns in FEED_COLUMNS.items():
            joined = ", ".join(f"COALESCE({c}, '')" for c in columns)
            sql[f"s{key}_{table}"] = (
                f"SELECT CAST({key} AS BIGINT) AS snapshot_key, "
                + ", ".join(columns)
                + f", sha256(concat_ws(chr(31), {joined})) AS row_hash FROM p{key}_{table}"
            )
        sql[f"dates{key}"] = f"""
            SELECT feed_start_date AS d FROM source_snapshot WHERE snapshot_key = {key}
            UNION ALL SELECT feed_end_date FROM source_snapshot WHERE snapshot_key = {key}
            UNION ALL SELECT {_day('start_date')} FROM s{key}_calendar
            UNION ALL SELECT {_day('end_date')} FROM s{key}_calendar
            UNION ALL SELECT {_day('date')} FROM s{key}_calendar_dates"""
        sql[f"op_src{key}"] = f"SELECT {_OPERATOR} FROM s{key}_agency"
        sql[f"st_src{key}"] = f"SELECT {_STOP} FROM s{key}_stops"
    sql["dim_operator"] = _history(
        "op_src1", "op_src2", "agency_id", "operator_key", _OPERATOR_COLUMNS,
        "n.row_hash <> o.row_hash",
    )
    sql["dim_stop"] = _history(
        "st_src1", "st_src2", "stop_id", "stop_key", _STOP_COLUMNS, "n.row_hash <> o.row_hash"
    )
    for key in (1, 2):
        resolved = (
            "SELECT agency_id, CONCAT('1:', agency_id) AS operator_key FROM op_src1"
            if key == 1
            else "SELECT agency_id, operator_key FROM dim_operator WHERE is_current"
        )
        sql[f"rt_src{key}"] = f"""
            SELECT TRIM(route_id) AS route_id, o.operator_key, {_clean('route_short_name')},
                   {_clean('route_long_name')}, {_clean('route_desc', 'route_description')},
                   {_big('route_type')} AS route_type, {_clean('route_url')},
                   UPPER(NULLIF(TRIM(route_color), '')) AS route_colour,
                   UPPER(NULLIF(TRIM(route_text_color), '')) AS route_text_colour, row_hash
            FROM s{key}_routes r JOIN ({resolved}) o ON o.agency_id = TRIM(r.agency_id)"""
    sql["dim_route"] = _history(
        "rt_src1", "rt_src2", "route_id", "route_key", _ROUTE_COLUMNS,
        "(n.row_hash <> o.row_hash OR n.operator_key <> o.operator_key)",
    )
    sql["dim_date"] = f"""
        SELECT {_key('d')} AS date_key, d AS full_date, {_big('year(d)')} AS calendar_year,
               {_big('quarter(d)')} AS calendar_quarter, {_big('month(d)')} AS calendar_month,
               monthname(d) AS month_name, {_big('day(d)')} AS day_of_month,
               {_big('isodow(d)')} AS day_of_week_iso, dayname(d) AS day_name,
               {_big('week(d)')} AS week_of_year, isodow(d) >= 6 AS is_weekend
        FROM (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP),
                                                 INTERVAL 1 DAY)) AS DATE) AS d
              FROM (SELECT MIN(d) AS lo, MAX(d) AS hi
                    FROM (SELECT d FROM dates1 UNION ALL SELECT d FROM dates2) u) b) x"""
    for key in (1, 2):
        flags = ", ".join(f"TRIM({day}) = '1' AS {day}" for day in _WEEK)
        off = ", ".join("FALSE" for _ in _WEEK)
        sql[f"exc{key}"] = f"""
            SELECT TRIM(service_id) AS service_id, {_day('date')} AS service_date,
                   CAST(exception_type AS BIGINT) AS exception_type
            FROM s{key}_calendar_dates"""
        sql[f"sv_src{key}"] = f"""
            SELECT TRIM(service_id) AS service_id, {flags}, {_day('start_date')} AS start_date,
                   {_day('end_date')} AS end_date, row_hash
            FROM s{key}_calendar
            UNION ALL
            SELECT service_id, {off}, MIN(service_date), MAX(service_date),
                   sha256(CONCAT(service_id, '|EXCEPTION_ONLY|',
                                 strftime(MIN(service_date), '%Y%m%d'), '|',
                                 strftime(MAX(service_date), '%Y%m%d')))
            FROM exc{key}
            WHERE exception_type = 1
              AND service_id NOT IN (SELECT TRIM(service_id) FROM s{key}_calendar)
            GROUP BY service_id"""
        sql[f"services{key}"] = f"""
            SELECT CAST({key} AS BIGINT) AS snapshot_key,
                   CONCAT('{key}:', service_id) AS service_key, * FROM sv_src{key}"""
        case = " ".join(f"WHEN {i} THEN s.{day}" for i, day in enumerate(_WEEK, start=1))
        sql[f"cal{key}"] = f"""
            SELECT s.snapshot_key, s.service_key, s.service_id, d.date_key, d.full_date,
                   'CALENDAR' AS activation_source
            FROM services{key} s JOIN dim_date d ON d.full_date BETWEEN s.start_date AND s.end_date
            WHERE CASE d.day_of_week_iso {case} END
              AND NOT EXISTS (SELECT 1 FROM exc{key} e WHERE e.service_id = s.service_id
                              AND e.service_date = d.full_date)"""
        sql[f"add{key}"] = f"""
            SELECT s.snapshot_key, s.service_key, s.service_id, d.date_key, d.full_date,
                   'EXCEPTION_ADDED' AS activation_source
            FROM exc{key} e JOIN services{key} s ON s.service_id = e.service_id
            JOIN dim_date d ON d.full_date = e.service_date
            WHERE e.exception_type = 1"""
        sql[f"bridge{key}"] = f"SELECT * FROM cal{key} UNION ALL SELECT * FROM add{key}"
    sql["dim_service"] = "SELECT * FROM services1 UNION ALL SELECT * FROM services2"

    def valid_at(dimension: str, key: int) -> str:
        return f"""
            SELECT v.* FROM {dimension} v
            JOIN source_snapshot f ON f.snapshot_key = v.valid_from_snapshot_key
            LEFT JOIN source_snapshot t ON t.snapshot_key = v.valid_to_snapshot_key
            WHERE f.downloaded_at_utc <=
                  (SELECT downloaded_at_utc FROM source_snapshot WHERE snapshot_key = {key})
              AND (t.downloaded_at_utc IS NULL OR
                   (SELECT downloaded_at_utc FROM source_snapshot WHERE snapshot_key = {key})
                   < t.downloaded_at_utc)"""

    for key in (1, 2):
        sql[f"route_at{key}"] = valid_at("dim_route", key)
        sql[f"stop_at{key}"] = valid_at("dim_stop", key)
        sql[f"trips{key}"] = f"""
            SELECT CAST({key} AS BIGINT) AS snapshot_key,
                   CONCAT('{key}:', TRIM(t.trip_id)) AS trip_key, r.route_key, s.service_key,
                   TRIM(t.trip_id) AS trip_id, {_clean('t.trip_headsign', 'trip_headsign')},
                   {_clean('t.trip_short_name', 'trip_short_name')},
                   {_big("NULLIF(TRIM(t.direction_id), '')")} AS direction_id,
                   {_clean('t.block_id', 'block_id')}, {_clean('t.shape_id', 'shape_id')},
                   {_big("NULLIF(TRIM(t.wheelchair_accessible), '')")} AS wheelchair_accessible,
                   t.row_hash
            FROM s{key}_trips t JOIN route_at{key} r ON r.route_id = TRIM(t.route_id)
            JOIN services{key} s ON s.service_id = TRIM(t.service_id)"""
    sql["shape_point"] = f"""
        SELECT CAST(2 AS BIGINT) AS snapshot_key, TRIM(shape_id) AS shape_id,
               {_big('shape_pt_sequence')} AS shape_point_sequence,
               {_dbl('CAST(shape_pt_lat AS DECIMAL(9,6))')} AS shape_point_latitude,
               {_dbl('CAST(shape_pt_lon AS DECIMAL(9,6))')} AS shape_point_longitude,
               {_dbl("CAST(NULLIF(TRIM(shape_dist_traveled), '') AS DECIMAL(18,3))")}
                   AS shape_dist_travelled
        FROM s2_shapes"""
    sql["ev"] = f"""
        SELECT CAST(2 AS BIGINT) AS snapshot_key, t.trip_key, t.route_key, t.service_key,
               s.stop_key, {_big('c.stop_sequence')} AS stop_sequence,
               {_seconds('TRIM(c.arrival_time)')} AS arrival_seconds,
               {_seconds('TRIM(c.departure_time)')} AS departure_seconds,
               {_clean('c.stop_headsign', 'stop_headsign')},
               COALESCE({_big("NULLIF(TRIM(c.pickup_type), '')")}, 0) AS pickup_type,
               COALESCE({_big("NULLIF(TRIM(c.drop_off_type), '')")}, 0) AS drop_off_type,
               {_dbl("CAST(NULLIF(TRIM(c.shape_dist_traveled), '') AS DECIMAL(18,3))")}
                   AS shape_dist_travelled,
               COALESCE({_big("NULLIF(TRIM(c.timepoint), '')")}, 1) <> 0 AS is_timepoint,
               c.row_hash
        FROM s2_stop_times c JOIN trips2 t ON t.trip_id = TRIM(c.trip_id)
        JOIN stop_at2 s ON s.stop_id = TRIM(c.stop_id)"""

    # Daily facts for publication 2.
    sql["win"] = """
        SELECT lo AS reporting_start_date,
               LEAST(CAST(lo + INTERVAL 365 DAY AS DATE), last_service_date) AS reporting_end_date,
               first_service_date, last_service_date
        FROM (SELECT GREATEST(CAST((SELECT downloaded_at_utc FROM source_snapshot
                                    WHERE snapshot_key = 2) AS DATE), MIN(full_date)) AS lo,
                     MIN(full_date) AS first_service_date, MAX(full_date) AS last_service_date
              FROM bridge2) b"""
    sql["wb"] = """
        SELECT b.* FROM bridge2 b
        WHERE b.full_date >= (SELECT reporting_start_date FROM win)
          AND b.full_date <= (SELECT reporting_end_date FROM win)"""
    sql["part_sv"] = "SELECT DISTINCT service_key FROM wb"
    sql["wev"] = "SELECT * FROM ev WHERE service_key IN (SELECT service_key FROM part_sv)"
    sql["tem"] = """
        SELECT trip_key, route_key, service_key, COUNT(*) AS stop_event_count,
               MIN(departure_seconds) AS first_departure_seconds,
               MAX(departure_seconds) AS last_departure_seconds,
               MAX(arrival_seconds) AS last_arrival_seconds
        FROM wev GROUP BY trip_key, route_key, service_key"""
    sql["tsm"] = """
        SELECT trip_key, stop_key, route_key, service_key,
               MIN(departure_seconds) AS departure_seconds
        FROM wev GROUP BY trip_key, stop_key, route_key, service_key"""
    sql["srm"] = f"""
        SELECT service_key, route_key, COUNT(*) AS scheduled_trip_count,
               {_big('SUM(stop_event_count)')} AS scheduled_stop_event_count,
               MIN(first_departure_seconds) AS first_departure_seconds,
               MAX(last_departure_seconds) AS last_departure_seconds,
               MAX(last_arrival_seconds) AS last_arrival_seconds
        FROM tem GROUP BY service_key, route_key"""
    sql["srs"] = "SELECT DISTINCT service_key, route_key, stop_key FROM tsm"
    sql["ssm"] = """
        SELECT service_key, stop_key, COUNT(*) AS scheduled_trip_count,
               MIN(departure_seconds) AS first_departure_seconds,
               MAX(departure_seconds) AS last_departure_seconds
        FROM tsm GROUP BY service_key, stop_key"""
    sql["route_fact"] = f"""
        SELECT CAST(2 AS BIGINT) AS snapshot_key, b.date_key, b.full_date, b.route_key,
               r.operator_key, b.trips AS scheduled_trip_count,
               b.calls AS scheduled_stop_event_count, n.stops AS unique_stop_count,
               b.dep0 AS first_departure_seconds, b.arr1 AS last_arrival_seconds,
               {_ratio('b.arr1 - b.dep0', '60')} AS span_c,
               CASE WHEN b.trips > 1
                    THEN {_ratio('b.dep1 - b.dep0', '60 * (b.trips - 1)')} END AS headway_c
        FROM (SELECT w.date_key, w.full_date, m.route_key,
                     {_big('SUM(m.scheduled_trip_count)')} AS trips,
                     {_big('SUM(m.scheduled_stop_event_count)')} AS calls,
                     MIN(m.first_departure_seconds) AS dep0,
                     MAX(m.last_departure_seconds) AS dep1, MAX(m.last_arrival_seconds) AS arr1
              FROM srm m JOIN wb w ON w.service_key = m.service_key
              GROUP BY w.date_key, w.full_date, m.route_key) b
        JOIN (SELECT w.date_key, s.route_key, COUNT(DISTINCT s.stop_key) AS stops
              FROM srs s JOIN wb w ON w.service_key = s.service_key
              GROUP BY w.date_key, s.route_key) n
          ON n.date_key = b.date_key AND n.route_key = b.route_key
        JOIN dim_route r ON r.route_key = b.route_key"""
    sql["stop_fact"] = f"""
        SELECT CAST(2 AS BIGINT) AS snapshot_key, b.date_key, b.full_date, b.stop_key,
               b.trips AS scheduled_trip_count, n.routes AS scheduled_route_count,
               b.dep0 AS first_departure_seconds, b.dep1 AS last_departure_seconds,
               {_ratio('b.dep1 - b.dep0', '60')} AS span_c,
               CASE WHEN b.trips > 1
                    THEN {_ratio('b.dep1 - b.dep0', '60 * (b.trips - 1)')} END AS headway_c
        FROM (SELECT w.date_key, w.full_date, m.stop_key,
                     {_big('SUM(m.scheduled_trip_count)')} AS trips,
                     MIN(m.first_departure_seconds) AS dep0,
                     MAX(m.last_departure_seconds) AS dep1
              FROM ssm m JOIN wb w ON w.service_key = m.service_key
              GROUP BY w.date_key, w.full_date, m.stop_key) b
        JOIN (SELECT w.date_key, s.stop_key, COUNT(DISTINCT s.route_key) AS routes
              FROM srs s JOIN wb w ON w.service_key = s.service_key
              GROUP BY w.date_key, s.stop_key) n
          ON n.date_key = b.date_key AND n.stop_key = b.stop_key"""

    # Publication comparison.
    for key in (1, 2):
        sql[f"state{key}"] = f"""
            SELECT 'OPERATOR' AS entity_type, agency_id AS entity_id, row_hash FROM dim_operator
            WHERE {_valid_by_key('', str(key))}
            UNION ALL SELECT 'ROUTE', route_id, row_hash FROM dim_route
            WHERE {_valid_by_key('', str(key))}
            UNION ALL SELECT 'STOP', stop_id, row_hash FROM dim_stop
            WHERE {_valid_by_key('', str(key))}
            UNION ALL SELECT 'SERVICE', service_id, row_hash FROM services{key}
            UNION ALL SELECT 'TRIP', trip_id, row_hash FROM trips{key}"""
    sql["diff"] = """
        SELECT COALESCE(c.entity_type, p.entity_type) AS entity_type,
               COALESCE(c.entity_id, p.entity_id) AS entity_id,
               CASE WHEN p.entity_id IS NULL THEN 'ADDED' WHEN c.entity_id IS NULL THEN 'REMOVED'
                    ELSE 'MODIFIED' END AS change_type,
               p.row_hash AS previous_row_hash, c.row_hash AS current_row_hash
        FROM state1 p FULL OUTER JOIN state2 c
          ON c.entity_type = p.entity_type AND c.entity_id = p.entity_id
        WHERE p.entity_id IS NULL OR c.entity_id IS NULL OR p.row_hash <> c.row_hash"""
    sql["change_log"] = f"""
        SELECT CONCAT('1:2:', entity_type, ':', entity_id) AS publication_change_key,
               CAST(1 AS BIGINT) AS previous_snapshot_key,
               CAST(2 AS BIGINT) AS current_snapshot_key, entity_type, entity_id, change_type,
               CASE WHEN change_type = 'MODIFIED' THEN 'published_attributes' END
                   AS changed_fields,
               previous_row_hash, current_row_hash,
               CAST(NULL AS VARCHAR) AS change_details_json,
               TIMESTAMP '{AS_OF}' AS detected_at_utc
        FROM diff"""

    # Analytics views; *_c columns are hundredths.
    sql["latest"] = """
        SELECT * FROM source_snapshot WHERE snapshot_status = 'LOADED'
        ORDER BY downloaded_at_utc DESC, snapshot_key DESC LIMIT 1"""
    sql["rsd"] = """
        SELECT f.snapshot_key, f.full_date AS service_date, d.day_name, d.is_weekend,
               d.month_name, d.calendar_year, o.operator_key, o.agency_id, o.operator_name,
               r.route_key, r.route_id, r.route_short_name, r.route_long_name,
               COALESCE(NULLIF(r.route_short_name, ''), NULLIF(r.route_long_name, ''), r.route_id)
                   AS route_display_name,
               r.route_type,
               CASE r.route_type WHEN 0 THEN 'Tram' WHEN 1 THEN 'Underground' WHEN 2 THEN 'Rail'
                    WHEN 3 THEN 'Bus' ELSE 'Other' END AS transport_mode,
               r.route_colour, r.route_text_colour, f.scheduled_trip_count,
               f.scheduled_stop_event_count, f.unique_stop_count, f.first_departure_seconds,
               f.last_arrival_seconds, f.span_c, f.headway_c
        FROM route_fact f JOIN latest l ON l.snapshot_key = f.snapshot_key
        JOIN dim_date d ON d.date_key = f.date_key
        JOIN dim_route r ON r.route_key = f.route_key
        JOIN dim_operator o ON o.operator_key = f.operator_key"""
    route_attributes = (
        "snapshot_key, operator_key, agency_id, operator_name, route_key, route_id, "
        "route_short_name, route_long_name, route_display_name, route_type, transport_mode, "
        "route_colour, route_text_colour"
    )
    sql["rsum"] = f"""
        SELECT {route_attributes}, MIN(service_date) AS first_service_date,
               MAX(service_date) AS last_service_date, COUNT(*) AS service_day_count,
               {_big('SUM(scheduled_trip_count)')} AS total_scheduled_trips,
               {_big('SUM(scheduled_stop_event_count)')} AS total_scheduled_stop_events,
               MAX(scheduled_trip_count) AS maximum_daily_trips,
               {_avg_whole('scheduled_trip_count')} AS trips_c,
               {_avg_whole('unique_stop_count')} AS stops_c,
               MAX(unique_stop_count) AS maximum_daily_unique_stops,
               {_avg_cents('span_c')} AS span_c, {_avg_cents('headway_c')} AS headway_c
        FROM rsd GROUP BY {route_attributes}"""
    stop_attributes = (
        "f.snapshot_key, s.stop_key, s.stop_id, s.stop_code, s.stop_name, s.stop_latitude, "
        "s.stop_longitude, s.zone_id, s.location_type, s.parent_station_id, s.wheelchair_boarding"
    )
    sql["ssum"] = f"""
        SELECT {stop_attributes},
               CASE s.wheelchair_boarding WHEN 1 THEN 'Accessible' WHEN 2 THEN 'Not accessible'
                    ELSE 'Unknown' END AS accessibility_status,
               MIN(f.full_date) AS first_service_date, MAX(f.full_date) AS last_service_date,
               COUNT(*) AS service_day_count,
               {_big('SUM(f.scheduled_trip_count)')} AS total_scheduled_trips,
               {_avg_whole('f.scheduled_trip_count')} AS trips_c,
               MAX(f.scheduled_route_count) AS maximum_daily_routes,
               {_avg_whole('f.scheduled_route_count')} AS routes_c,
               {_avg_cents('f.span_c')} AS span_c, {_avg_cents('f.headway_c')} AS headway_c
        FROM stop_fact f JOIN latest l ON l.snapshot_key = f.snapshot_key
        JOIN dim_stop s ON s.stop_key = f.stop_key
        GROUP BY {stop_attributes}"""

    def scored(source: str, weights: list[tuple[str, str, str]], score: str) -> str:
        ranks = ", ".join(
            f"PERCENT_RANK() OVER (PARTITION BY snapshot_key ORDER BY {column}) AS {name}"
            for column, name, _ in weights
        )
        total = " + ".join(f"CAST({weight} AS DOUBLE) * {name}" for _, name, weight in weights)
        return (
            f"SELECT *, FLOOR((CAST(100 AS DOUBLE) * ({total})) * 10 + 0.5) / 10 AS {score} "
            f"FROM (SELECT *, {ranks} FROM {source}) p"
        )

    sql["rscore"] = scored(
        "rsum",
        [
            ("trips_c", "trip_intensity_percentile", "0.45"),
            ("span_c", "span_percentile", "0.30"),
            ("stops_c", "coverage_percentile", "0.25"),
        ],
        "scheduled_service_score",
    )
    sql["sscore"] = scored(
        "ssum",
        [
            ("trips_c", "trip_activity_percentile", "0.50"),
            ("routes_c", "route_choice_percentile", "0.30"),
            ("span_c", "span_percentile", "0.20"),
        ],
        "scheduled_activity_score",
    )
    sql["nds"] = f"""
        SELECT snapshot_key, service_date, day_name, is_weekend, month_name, calendar_year,
               transport_mode, COUNT(*) AS active_route_count,
               COUNT(DISTINCT operator_key) AS active_operator_count,
               {_big('SUM(scheduled_trip_count)')} AS scheduled_trip_count,
               {_big('SUM(scheduled_stop_event_count)')} AS scheduled_stop_event_count,
               {_avg_whole('unique_stop_count')} AS stops_c, {_avg_cents('span_c')} AS span_c,
               {_avg_cents('headway_c')} AS headway_c
        FROM rsd GROUP BY snapshot_key, service_date, day_name, is_weekend, month_name,
                          calendar_year, transport_mode"""
    sql.update(_view_sql(route_attributes))
    return sql


def _route_rollup() -> str:
    return f"""
        {_big('SUM(total_scheduled_trips)')} AS total_scheduled_trips,
        {_big('SUM(total_scheduled_stop_events)')} AS total_scheduled_stop_events,
        {_avg_cents('trips_c')} / 100.0 AS average_route_daily_trips,
        {_avg_cents('stops_c')} / 100.0 AS average_route_stop_coverage,
        {_avg_cents('span_c')} / 100.0 AS average_service_span_minutes,
        {_avg_cents('headway_c')} / 100.0 AS average_headway_minutes"""


def _view_sql(route_attributes: str) -> dict[str, str]:
    """The analytics views in output form."""
    sql: dict[str, str] = {}
    now = f"TIMESTAMP '{AS_OF}'"
    sql["v_route_service_daily"] = """
        SELECT * EXCLUDE (span_c, headway_c), span_c / 100.0 AS service_span_minutes,
               headway_c / 100.0 AS average_headway_minutes FROM rsd"""
    route_measures = """
        first_service_date, last_service_date, service_day_count, total_scheduled_trips,
        total_scheduled_stop_events, maximum_daily_trips, trips_c / 100.0 AS average_daily_trips,
        stops_c / 100.0 AS average_daily_unique_stops, maximum_daily_unique_stops,
        span_c / 100.0 AS average_service_span_minutes,
        headway_c / 100.0 AS average_headway_minutes"""
    sql["v_route_summary"] = f"SELECT {route_attributes}, {route_measures} FROM rsum"
    stop_attributes = (
        "snapshot_key, stop_key, stop_id, stop_code, stop_name, stop_latitude, stop_longitude, "
        "zone_id, location_type, parent_station_id, wheelchair_boarding, accessibility_status"
    )
    stop_measures = """
        first_service_date, last_service_date, service_day_count, total_scheduled_trips,
        trips_c / 100.0 AS average_daily_trips, maximum_daily_routes,
        routes_c / 100.0 AS average_daily_routes,
        span_c / 100.0 AS average_service_span_minutes,
        headway_c / 100.0 AS average_headway_minutes"""
    sql["v_stop_summary"] = f"SELECT {stop_attributes}, {stop_measures} FROM ssum"
    sql["v_network_daily_summary"] = """
        SELECT * EXCLUDE (stops_c, span_c, headway_c), stops_c / 100.0 AS average_stops_per_route,
               span_c / 100.0 AS average_service_span_minutes,
               headway_c / 100.0 AS average_headway_minutes FROM nds"""
    sql["v_operator_summary"] = f"""
        SELECT snapshot_key, operator_key, agency_id, operator_name, COUNT(*) AS route_count,
               {_route_rollup()}, MIN(first_service_date) AS first_service_date,
               MAX(last_service_date) AS last_service_date
        FROM rsum GROUP BY snapshot_key, operator_key, agency_id, operator_name"""
    sql["v_transport_mode_summary"] = f"""
        SELECT snapshot_key, transport_mode, COUNT(*) AS route_count,
               COUNT(DISTINCT operator_key) AS operator_count, {_route_rollup()}
        FROM rsum GROUP BY snapshot_key, transport_mode"""
    sql["v_route_service_intelligence"] = f"""
        SELECT {route_attributes}, {route_measures}, trip_intensity_percentile, span_percentile,
               coverage_percentile, scheduled_service_score,
               DENSE_RANK() OVER (PARTITION BY snapshot_key ORDER BY scheduled_service_score DESC)
                   AS network_service_rank,
               DENSE_RANK() OVER (PARTITION BY snapshot_key, transport_mode
                                  ORDER BY scheduled_service_score DESC) AS mode_service_rank,
               CASE WHEN scheduled_service_score >= 80 THEN 'VERY HIGH'
                    WHEN scheduled_service_score >= 60 THEN 'HIGH'
                    WHEN scheduled_service_score >= 40 THEN 'MODERATE' ELSE 'LIMITED' END
                   AS scheduled_service_band,
               CASE WHEN headway_c IS NULL THEN 'SINGLE JOURNEY'
                    WHEN headway_c <= 1000 THEN 'HIGH FREQUENCY'
                    WHEN headway_c <= 2000 THEN 'FREQUENT' WHEN headway_c <= 3000 THEN 'STANDARD'
                    ELSE 'LOW FREQUENCY' END AS frequency_band
        FROM rscore"""
    sql["v_stop_service_intelligence"] = f"""
        SELECT {stop_attributes}, {stop_measures}, trip_activity_percentile,
               route_choice_percentile, span_percentile, scheduled_activity_score,
               DENSE_RANK() OVER (PARTITION BY snapshot_key ORDER BY scheduled_activity_score DESC)
                   AS network_activity_rank,
               CASE WHEN scheduled_activity_score >= 80 THEN 'MAJOR HUB'
                    WHEN scheduled_activity_score >= 60 THEN 'HIGH ACTIVITY'
                    WHEN scheduled_activity_score >= 40 THEN 'MODERATE ACTIVITY'
                    ELSE 'LOCAL ACCESS' END AS scheduled_activity_band
        FROM sscore"""

    def average_micro(column: str) -> str:
        micro = _big(f"SUM(CAST(ROUND({column} * 1000000) AS BIGINT))")
        return (
            f"(CASE WHEN {micro} < 0 THEN -1 ELSE 1 END * "
            f"((2 * ABS({micro}) + COUNT(*)) // (2 * COUNT(*)))) / 1000000.0"
        )

    sql["v_location_summary"] = f"""
        SELECT snapshot_key, COALESCE(NULLIF(zone_id, ''), 'UNASSIGNED') AS location_group,
               COUNT(*) AS stop_count,
               {_big('SUM(total_scheduled_trips)')} AS total_scheduled_trips,
               {_avg_cents('trips_c')} / 100.0 AS average_stop_daily_trips,
               {_avg_cents('routes_c')} / 100.0 AS average_route_choice,
               COUNT(*) FILTER (accessibility_status = 'Accessible') AS accessible_stop_count,
               COUNT(*) FILTER (accessibility_status = 'Not accessible')
                   AS inaccessible_stop_count,
               COUNT(*) FILTER (accessibility_status = 'Unknown') AS unknown_accessibility_count,
               {average_micro('stop_latitude')} AS centre_latitude,
               {average_micro('stop_longitude')} AS centre_longitude
        FROM ssum GROUP BY snapshot_key, COALESCE(NULLIF(zone_id, ''), 'UNASSIGNED')"""
    sql["v_publication_changes"] = """
        SELECT c.publication_change_key, c.previous_snapshot_key,
               p.downloaded_at_utc AS previous_downloaded_at_utc, c.current_snapshot_key,
               n.downloaded_at_utc AS current_downloaded_at_utc, c.entity_type, c.entity_id,
               c.change_type, c.changed_fields, c.change_details_json, c.detected_at_utc
        FROM change_log c JOIN source_snapshot p ON p.snapshot_key = c.previous_snapshot_key
        JOIN source_snapshot n ON n.snapshot_key = c.current_snapshot_key"""
    sql["v_publication_change_summary"] = """
        SELECT previous_snapshot_key, previous_downloaded_at_utc, current_snapshot_key,
               current_downloaded_at_utc, entity_type, change_type, COUNT(*) AS change_count,
               MIN(detected_at_utc) AS first_detected_at_utc,
               MAX(detected_at_utc) AS last_detected_at_utc
        FROM v_publication_changes
        GROUP BY previous_snapshot_key, previous_downloaded_at_utc, current_snapshot_key,
                 current_downloaded_at_utc, entity_type, change_type"""
    flattening = "(1 / 298.257223563)"
    sql["v_stop_location_changes"] = f"""
        SELECT publication_change_key, previous_snapshot_key, current_snapshot_key, stop_id,
               previous_stop_name, current_stop_name, previous_latitude, previous_longitude,
               current_latitude, current_longitude,
               FLOOR((CASE WHEN sg = 0 THEN 0 ELSE 6378137.0::DOUBLE * (sg - {flattening} / 2 * (
                   (sg - sin(sg)) * power(sin((b1 + b2) / 2) * cos((b2 - b1) / 2)
                                          / cos(sg / 2), 2)
                   + (sg + sin(sg)) * power(cos((b1 + b2) / 2) * sin((b2 - b1) / 2)
                                            / sin(sg / 2), 2))) END) * 100 + 0.5) / 100
                   AS location_change_metres,
               detected_at_utc
        FROM (SELECT *, 2 * asin(sqrt(power(sin((b2 - b1) / 2), 2) + cos(b1) * cos(b2)
                     * power(sin(radians(current_longitude - previous_longitude) / 2), 2))) AS sg
              FROM (SELECT c.publication_change_key, c.previous_snapshot_key,
                           c.current_snapshot_key, c.entity_id AS stop_id,
                           p.stop_name AS previous_stop_name, n.stop_name AS current_stop_name,
                           p.stop_latitude AS previous_latitude,
                           p.stop_longitude AS previous_longitude,
                           n.stop_latitude AS current_latitude,
                           n.stop_longitude AS current_longitude, c.detected_at_utc,
                           atan(tan(radians(p.stop_latitude)) * (1 - {flattening})) AS b1,
                           atan(tan(radians(n.stop_latitude)) * (1 - {flattening})) AS b2
                    FROM change_log c
                    JOIN dim_stop p ON p.stop_id = c.entity_id
                     AND {_valid_by_key('p.', 'c.previous_snapshot_key')}
                    JOIN dim_stop n ON n.stop_id = c.entity_id
                     AND {_valid_by_key('n.', 'c.current_snapshot_key')}
                    WHERE c.entity_type = 'STOP' AND c.change_type = 'MODIFIED'
                      AND (p.stop_latitude <> n.stop_latitude
                           OR p.stop_longitude <> n.stop_longitude)) x) y"""
    duration = f"date_diff('millisecond', {{0}}started_at_utc, COALESCE({{0}}completed_at_utc, {now}))"
    sql["v_recent_pipeline_runs"] = f"""
        SELECT r.pipeline_run_key, r.snapshot_key,
               s.downloaded_at_utc AS snapshot_downloaded_at_utc, r.pipeline_name, r.orchestrator,
               r.external_run_id, r.run_status, r.started_at_utc, r.completed_at_utc,
               {duration.format('r.')} AS duration_milliseconds, r.rows_read, r.rows_loaded,
               r.rows_rejected, r.error_message
        FROM pipeline_run r LEFT JOIN source_snapshot s ON s.snapshot_key = r.snapshot_key
        ORDER BY r.started_at_utc DESC, r.pipeline_run_key DESC LIMIT 200"""
    sql["v_data_quality_results"] = """
        SELECT q.data_quality_result_key, q.pipeline_run_key, q.snapshot_key, r.pipeline_name,
               q.check_name, q.check_category, q.table_name, q.check_status, q.records_checked,
               q.failed_records, CAST(q.threshold_value AS DOUBLE) AS threshold_value,
               CAST(q.observed_value AS DOUBLE) AS observed_value, q.details, q.checked_at_utc
        FROM data_quality_result q JOIN pipeline_run r ON r.pipeline_run_key = q.pipeline_run_key
        ORDER BY q.checked_at_utc DESC, q.data_quality_result_key DESC LIMIT 500"""
    sql["ranked_runs"] = """
        SELECT *, ROW_NUMBER() OVER (PARTITION BY pipeline_name
                  ORDER BY started_at_utc DESC, pipeline_run_key DESC) AS recency_rank
        FROM pipeline_run"""
    sql["run_history"] = """
        SELECT pipeline_name, COUNT(*) AS recent_run_count,
               COUNT(*) FILTER (run_status = 'SUCCEEDED') AS recent_success_count,
               COUNT(*) FILTER (run_status = 'FAILED') AS recent_failure_count,
               ((2 * 10000 * COUNT(*) FILTER (run_status = 'SUCCEEDED') + COUNT(*))
                // (2 * COUNT(*))) / 100.0 AS recent_success_rate_pct
        FROM ranked_runs WHERE recency_rank <= 20 GROUP BY pipeline_name"""
    sql["v_pipeline_health"] = f"""
        SELECT l.pipeline_name, l.pipeline_run_key AS latest_pipeline_run_key,
               l.snapshot_key AS latest_snapshot_key, l.orchestrator,
               l.run_status AS latest_run_status, l.started_at_utc AS latest_started_at_utc,
               l.completed_at_utc AS latest_completed_at_utc,
               {duration.format('l.')} AS latest_duration_milliseconds,
               l.rows_read AS latest_rows_read, l.rows_loaded AS latest_rows_loaded,
               l.rows_rejected AS latest_rows_rejected, l.error_message AS latest_error_message,
               h.recent_run_count, h.recent_success_count, h.recent_failure_count,
               h.recent_success_rate_pct,
               CASE WHEN l.run_status = 'STARTED' THEN 'RUNNING'
                    WHEN l.run_status = 'FAILED' THEN 'ACTION REQUIRED'
                    WHEN l.run_status = 'SUCCEEDED' AND h.recent_failure_count > 0
                        THEN 'RECOVERED'
                    WHEN h.recent_success_rate_pct >= 95 THEN 'HEALTHY' ELSE 'WATCH' END
                   AS pipeline_health_status
        FROM ranked_runs l JOIN run_history h ON h.pipeline_name = l.pipeline_name
        WHERE l.recency_rank = 1"""

    def total(source: str, condition: str = "TRUE") -> str:
        return f"(SELECT COUNT(*) FROM {source} WHERE {condition})"

    valid = _valid_by_key("", "l.snapshot_key")
    sql["v_platform_summary"] = f"""
        SELECT l.snapshot_key, l.source_name, l.downloaded_at_utc, l.source_last_modified_utc,
               {_ratio(f"date_diff('minute', l.downloaded_at_utc, {now})", '60')} / 100.0
                   AS data_age_hours,
               CASE WHEN {_hours('l.downloaded_at_utc', now)} <= 36 THEN 'CURRENT'
                    WHEN {_hours('l.downloaded_at_utc', now)} <= 72 THEN 'DELAYED' ELSE 'STALE' END
                   AS freshness_status,
               l.file_name, l.file_size_bytes, l.sha256, l.feed_start_date, l.feed_end_date,
               l.feed_version,
               (SELECT MIN(full_date) FROM route_fact) AS reporting_start_date,
               (SELECT MAX(full_date) FROM route_fact) AS reporting_end_date,
               {total('dim_operator', valid)} AS operator_count,
               {total('dim_route', valid)} AS route_count,
               {total('dim_stop', valid)} AS stop_count,
               {total('services2')} AS service_count, {total('trips2')} AS trip_count,
               {total('ev')} AS scheduled_stop_event_count,
               {total('shape_point')} AS shape_point_count,
               {total('route_fact')} AS route_daily_fact_count,
               {total('stop_fact')} AS stop_daily_fact_count,
               {total('change_log')} AS publication_change_count,
               (SELECT MAX(completed_at_utc) FROM pipeline_run r
                WHERE r.snapshot_key = l.snapshot_key AND run_status = 'SUCCEEDED')
                   AS last_successful_pipeline_at_utc,
               {total('pipeline_run r', "r.snapshot_key = l.snapshot_key AND run_status = 'SUCCEEDED'")}
                   AS successful_pipeline_run_count,
               {total('pipeline_run r', "r.snapshot_key = l.snapshot_key AND run_status = 'FAILED'")}
                   AS failed_pipeline_run_count
        FROM latest l"""
    leading_route = "(SELECT {} FROM v_route_service_intelligence ORDER BY network_service_rank, route_id LIMIT 1)"
    leading_stop = "(SELECT {} FROM v_stop_service_intelligence ORDER BY network_activity_rank, stop_id LIMIT 1)"
    health = "pipeline_health_status"
    sql["v_dashboard_kpis"] = f"""
        SELECT snapshot_key, downloaded_at_utc, data_age_hours, freshness_status,
               reporting_start_date, reporting_end_date, operator_count, route_count, stop_count,
               trip_count, scheduled_stop_event_count, publication_change_count,
               {total('v_route_service_intelligence', "scheduled_service_band IN ('VERY HIGH', 'HIGH')")}
                   AS strong_service_route_count,
               {total('v_route_service_intelligence', "frequency_band = 'HIGH FREQUENCY'")}
                   AS high_frequency_route_count,
               {total('v_stop_service_intelligence', "scheduled_activity_band = 'MAJOR HUB'")}
                   AS major_hub_count,
               {total('ssum', "accessibility_status = 'Accessible'")} AS accessible_stop_count,
               {leading_route.format('route_display_name')} AS leading_route,
               {leading_route.format('scheduled_service_score')} AS leading_route_score,
               {leading_stop.format('stop_name')} AS leading_stop,
               {leading_stop.format('scheduled_activity_score')} AS leading_stop_score,
               {total('v_pipeline_health', f"{health} = 'HEALTHY'")} AS healthy_pipeline_count,
               {total('v_pipeline_health', f"{health} = 'RECOVERED'")}
                   AS recovered_pipeline_count,
               {total('v_pipeline_health', f"{health} IN ('HEALTHY', 'RECOVERED')")}
                   AS service_ready_pipeline_count,
               {total('v_pipeline_health', f"{health} = 'ACTION REQUIRED'")}
                   AS action_required_pipeline_count,
               {total('v_pipeline_health', f"{health} = 'RUNNING'")} AS running_pipeline_count,
               {total('v_pipeline_health')} AS monitored_pipeline_count,
               last_successful_pipeline_at_utc
        FROM v_platform_summary"""
    return sql


STAGE_LIST = ", ".join(f"'{stage}'" for stage in ENTITY_STAGES)


def complete(text: str) -> str:
    """Checking SQL with every intermediate table it uses."""
    if text.lstrip().startswith("WITH"):
        text = f"SELECT * FROM ({text}) checked"
    return with_clause(definitions(), text)
