"""Projection of the generated test tables into two timetable publications.

The SQL text is shared by Spark and by the checking engine; only the name of
the zone-less timestamp type differs. Publication 2 covers the whole tables.
Publication 1 is the older state: it lacks entities that joined later, carries
older attribute values, and holds entities that were withdrawn afterwards.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from linespan.session import table_path

RAW_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

OLDER_SNAPSHOT = 1
LATEST_SNAPSHOT = 2
AS_OF = "2024-01-10 12:00:00"

_DECIMAL_LAT = "CAST(53 + (c_custkey % 500) * 0.001 AS DECIMAL(9,6))"
_DECIMAL_LON = "CAST(-2.5 + (c_custkey % 700) * 0.001 AS DECIMAL(9,6))"
_NONE = "CAST(NULL AS STRING)"

_CALL_TIME = (
    "CONCAT(LPAD(CAST(CAST(FLOOR({s} / 3600) AS INT) AS STRING), 2, '0'), ':', "
    "LPAD(CAST(CAST(FLOOR({s} / 60) AS INT) % 60 AS STRING), 2, '0'), ':', "
    "LPAD(CAST({s} % 60 AS STRING), 2, '0'))"
)

# Number of calendar services, and the wider range that also holds services
# known only through exceptions.
_SERVICES = "(SELECT COUNT(*) FROM supplier)"
_ALL_SERVICES = "(SELECT COUNT(*) + CAST(FLOOR(COUNT(*) / 10) AS INT) + 1 FROM supplier)"

_STAGES = (
    "load_gtfs_core_warehouse", "load_gtfs_network_warehouse",
    "load_gtfs_service_warehouse", "load_gtfs_trip_warehouse",
    "load_gtfs_high_volume_staging", "load_gtfs_scheduled_stop_event_warehouse",
)


def _calendar_sql(end_date: str) -> str:
    return f"""
        SELECT CONCAT('V', CAST(s_suppkey AS STRING)) AS service_id,
               CASE WHEN s_nationkey % 3 = 0 THEN '0' ELSE '1' END AS monday,
               CASE WHEN s_nationkey % 4 = 0 THEN '0' ELSE '1' END AS tuesday,
               '1' AS wednesday,
               CASE WHEN s_nationkey % 5 = 0 THEN '0' ELSE '1' END AS thursday,
               '1' AS friday,
               CASE WHEN s_nationkey % 2 = 0 THEN '1' ELSE '0' END AS saturday,
               CASE WHEN s_nationkey % 7 = 0 THEN '1' ELSE '0' END AS sunday,
               '20240101' AS start_date,
               {end_date} AS end_date
        FROM supplier"""


def _exception_sql(condition: str) -> str:
    return f"""
        SELECT CONCAT('V', CAST(k AS STRING)) AS service_id,
               REPLACE(CAST(d AS STRING), '-', '') AS date,
               CASE WHEN k >= {_SERVICES} THEN '1' WHEN v < 20 THEN '1' ELSE '2' END
                   AS exception_type
        FROM (SELECT event_id % {_ALL_SERVICES} AS k, CAST(ts AS DATE) AS d, MIN(value) AS v
              FROM events WHERE {condition}
              GROUP BY event_id % {_ALL_SERVICES}, CAST(ts AS DATE)) e"""


def _trip_columns(trip: str, direction: str) -> str:
    return f"""
        SELECT CONCAT('R', CAST(o_orderkey % (SELECT COUNT(*) FROM part) AS STRING)) AS route_id,
               CONCAT('V', CAST((o_orderkey + o_custkey) % {_ALL_SERVICES} AS STRING))
                   AS service_id,
               CONCAT('{trip}', CAST(o_orderkey AS STRING)) AS trip_id,
               CONCAT('To ', o_orderpriority) AS trip_headsign, {_NONE} AS trip_short_name,
               {direction} AS direction_id,
               CASE WHEN o_orderstatus = 'P' THEN '' ELSE CONCAT('B', o_orderstatus) END
                   AS block_id,
               CONCAT('H', CAST(o_orderkey % {_SERVICES} AS STRING)) AS shape_id,
               CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '2' END
                   AS wheelchair_accessible
        FROM orders"""


def projection_sql(timestamp_type: str, hash_call: str) -> dict[str, str]:
    """Return name to SQL, each later entry may use the earlier ones.

    ``hash_call`` is the engine's SHA-256 call with ``{}`` for the text.
    """
    sql: dict[str, str] = {}

    # Publication 2: the whole tables.
    sql["p2_agency"] = f"""
        SELECT CONCAT('A', CAST(s_suppkey AS STRING)) AS agency_id, s_name AS agency_name,
               CONCAT('https://operator.example/', CAST(s_suppkey AS STRING)) AS agency_url,
               'Europe/London' AS agency_timezone, 'en' AS agency_lang,
               {_NONE} AS agency_phone, {_NONE} AS agency_fare_url, '' AS agency_email,
               CONCAT(' N', CAST(s_nationkey AS STRING), ' ') AS agency_noc
        FROM supplier"""
    sql["p2_routes"] = f"""
        SELECT CONCAT('R', CAST(p_partkey AS STRING)) AS route_id,
               CONCAT('A', CAST(p_partkey % {_SERVICES} AS STRING)) AS agency_id,
               CASE WHEN p_partkey % 8 = 0 THEN NULL ELSE p_brand END AS route_short_name,
               p_name AS route_long_name, p_type AS route_desc,
               CAST(p_size % 5 AS STRING) AS route_type, '' AS route_url,
               CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE 'ffd400' END AS route_color,
               {_NONE} AS route_text_color
        FROM part"""
    sql["p2_stops"] = f"""
        SELECT CONCAT('S', CAST(c_custkey AS STRING)) AS stop_id,
               CONCAT('C', CAST(c_custkey % 97 AS STRING)) AS stop_code,
               c_name AS stop_name, {_NONE} AS stop_desc,
               CAST({_DECIMAL_LAT} AS STRING) AS stop_lat,
               CAST({_DECIMAL_LON} AS STRING) AS stop_lon,
               CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_mktsegment END AS zone_id,
               {_NONE} AS stop_url, '0' AS location_type, {_NONE} AS parent_station,
               CASE c_nationkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '1' ELSE '2' END
                   AS wheelchair_boarding
        FROM customer"""
    sql["p2_calendar"] = _calendar_sql(
        "CASE WHEN s_nationkey % 2 = 0 THEN '20240331' ELSE '20240215' END"
    )
    sql["p2_calendar_dates"] = _exception_sql("ts IS NOT NULL")
    sql["p2_trips"] = _trip_columns("T", "CAST(o_orderkey % 2 AS STRING)")
    sql["p2_stop_times"] = f"""
        SELECT trip_id, {_CALL_TIME.format(s='(s - dwell)')} AS arrival_time,
               {_CALL_TIME.format(s='s')} AS departure_time,
               stop_id, stop_sequence, {_NONE} AS stop_headsign, '' AS pickup_type,
               '0' AS drop_off_type, {_NONE} AS shape_dist_traveled,
               CASE WHEN s % 7 = 0 THEN '0' END AS timepoint
        FROM (SELECT CONCAT('T', CAST(l_orderkey AS STRING)) AS trip_id,
                     CASE WHEN COUNT(*) OVER (PARTITION BY l_orderkey) > 1 THEN 30 ELSE 0 END
                         AS dwell,
                     CONCAT('S', CAST(MIN(l_partkey * 7 + l_suppkey * 13)
                         % (SELECT COUNT(*) FROM customer) AS STRING)) AS stop_id,
                     CAST(l_linenumber AS STRING) AS stop_sequence,
                     18000 + (l_orderkey % 1200) * 60 + l_linenumber * 180 AS s
              FROM lineitem GROUP BY l_orderkey, l_linenumber) t"""
    sql["p2_shapes"] = f"""
        SELECT CONCAT('H', CAST(event_id % {_SERVICES} AS STRING)) AS shape_id,
               CAST(CAST(53 + (event_id % 400) * 0.001 AS DECIMAL(9,6)) AS STRING)
                   AS shape_pt_lat,
               CAST(CAST(-2.5 + (event_id % 300) * 0.001 AS DECIMAL(9,6)) AS STRING)
                   AS shape_pt_lon,
               CAST(CAST(FLOOR(event_id / {_SERVICES}) AS INT) AS STRING)
                   AS shape_pt_sequence,
               CASE WHEN event_type = 'view' THEN CAST(CAST(value AS DECIMAL(9,2)) AS STRING) END
                   AS shape_dist_traveled
        FROM events"""

    # Publication 1: the older state of the same network.
    sql["p1_agency"] = f"""
        SELECT agency_id, CASE WHEN s_nationkey IN (3, 11) THEN CONCAT(s_name, ' old')
                               ELSE agency_name END AS agency_name,
               agency_url, agency_timezone, agency_lang, agency_phone, agency_fare_url,
               agency_email, agency_noc
        FROM p2_agency JOIN supplier ON agency_id = CONCAT('A', CAST(s_suppkey AS STRING))
        WHERE s_acctbal >= 500
        UNION ALL
        SELECT CONCAT('AX', CAST(n_nationkey AS STRING)), n_name, '', 'Europe/London', 'en',
               {_NONE}, {_NONE}, '', ''
        FROM nation"""
    sql["p1_routes"] = f"""
        SELECT r.route_id, r.agency_id, r.route_short_name, r.route_long_name, r.route_desc,
               r.route_type, r.route_url, r.route_color, r.route_text_color
        FROM (SELECT route_id,
                     CASE WHEN p_type = 'SMALL'
                          THEN CONCAT('AX', CAST(p_partkey % 25 AS STRING))
                          ELSE agency_id END AS agency_id,
                     route_short_name,
                     CASE WHEN p_brand = 'Brand#7' THEN CONCAT(p_name, ' old')
                          ELSE route_long_name END AS route_long_name,
                     route_desc, route_type, route_url, route_color, route_text_color
              FROM p2_routes JOIN part ON route_id = CONCAT('R', CAST(p_partkey AS STRING))
              WHERE p_size >= 4
              UNION ALL
              SELECT CONCAT('RX', CAST(p_partkey AS STRING)),
                     CONCAT('AX', CAST(p_partkey % 25 AS STRING)), p_brand, p_name, p_type,
                     '3', '', {_NONE}, {_NONE}
              FROM part WHERE p_size = 50) r
        WHERE r.agency_id IN (SELECT agency_id FROM p1_agency)"""
    sql["p1_stops"] = f"""
        SELECT stop_id, stop_code,
               CASE WHEN c_nationkey = 5 THEN CONCAT(c_name, ' old') ELSE stop_name END
                   AS stop_name,
               stop_desc,
               CASE WHEN c_mktsegment = 'MACHINERY' AND c_nationkey < 5
                    THEN CAST(CAST({_DECIMAL_LAT} - CAST(0.0005 AS DECIMAL(9,6))
                         AS DECIMAL(9,6)) AS STRING)
                    ELSE stop_lat END AS stop_lat,
               stop_lon, zone_id, stop_url, location_type, parent_station, wheelchair_boarding
        FROM p2_stops JOIN customer ON stop_id = CONCAT('S', CAST(c_custkey AS STRING))
        WHERE c_acctbal >= 0
        UNION ALL
        SELECT CONCAT('SX', CAST(c_custkey AS STRING)), '', c_name, {_NONE},
               CAST({_DECIMAL_LAT} AS STRING), CAST({_DECIMAL_LON} AS STRING), c_mktsegment,
               {_NONE}, '1', {_NONE}, {_NONE}
        FROM customer WHERE c_nationkey = 9"""
    sql["p1_calendar"] = _calendar_sql(
        "CASE WHEN s_nationkey % 2 = 0 AND s_nationkey > 3 THEN '20240331' ELSE '20240215' END"
    )
    sql["p1_calendar_dates"] = _exception_sql(
        f"ts < CAST('2024-01-20 00:00:00' AS {timestamp_type})"
    )
    sql["p1_trips"] = f"""
        SELECT t.route_id, t.service_id, t.trip_id, t.trip_headsign, t.trip_short_name,
               t.direction_id, t.block_id, t.shape_id, t.wheelchair_accessible
        FROM ({_trip_columns('T', "CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 - o_orderkey % 2 ELSE o_orderkey % 2 END AS STRING)")}
              WHERE o_orderdate < CAST('2001-01-01 00:00:00' AS {timestamp_type})
              UNION ALL
              {_trip_columns('TX', "CAST(o_orderkey % 2 AS STRING)")}
              WHERE o_orderdate < CAST('1995-03-01 00:00:00' AS {timestamp_type})) t
        WHERE t.route_id IN (SELECT route_id FROM p1_routes)
          AND t.service_id IN (SELECT service_id FROM p1_calendar
                               UNION ALL SELECT service_id FROM p1_calendar_dates)"""
    sql["p1_stop_times"] = """
        SELECT trip_id, departure_time AS arrival_time, departure_time, stop_id, stop_sequence,
               stop_headsign, pickup_type, drop_off_type, shape_dist_traveled, timepoint
        FROM p2_stop_times
        WHERE trip_id IN (SELECT trip_id FROM p1_trips)
          AND stop_id IN (SELECT stop_id FROM p1_stops)"""
    sql["p1_shapes"] = "SELECT * FROM p2_shapes"
    for key in (1, 2):
        sql[f"p{key}_feed_info"] = f"""
            SELECT 'Example publisher' AS feed_publisher_name,
                   'https://feed.example' AS feed_publisher_url, 'en' AS feed_lang,
                   REPLACE(CAST(CAST(MIN(ts) AS DATE) AS STRING), '-', '') AS feed_start_date,
                   '2024040{key}' AS feed_end_date, 'v{key}' AS feed_version
            FROM events"""

    # Publication 2 with faults, for the quality rules.
    sql["bad_agency"] = f"""
        SELECT * FROM p2_agency
        UNION ALL
        SELECT CASE WHEN n_nationkey < 5 THEN ' ' ELSE 'A1' END, n_name, '', '', '', {_NONE},
               {_NONE}, '', '' FROM nation"""
    sql["bad_calendar"] = """
        SELECT service_id, CASE WHEN s_nationkey = 6 THEN '2' ELSE monday END AS monday,
               tuesday, wednesday, thursday, friday,
               CASE WHEN s_nationkey = 7 THEN '' ELSE saturday END AS saturday, sunday,
               CASE WHEN s_nationkey = 8 THEN '2024-01-01' ELSE start_date END AS start_date,
               CASE WHEN s_nationkey = 10 THEN '20231201' ELSE end_date END AS end_date
        FROM p2_calendar JOIN supplier ON service_id = CONCAT('V', CAST(s_suppkey AS STRING))
        UNION ALL
        SELECT service_id, monday, tuesday, wednesday, thursday, friday, saturday, sunday,
               start_date, end_date
        FROM p2_calendar JOIN supplier ON service_id = CONCAT('V', CAST(s_suppkey AS STRING))
        WHERE s_nationkey = 12"""
    sql["bad_calendar_dates"] = """
        SELECT * FROM p2_calendar_dates
        UNION ALL
        SELECT CONCAT('VX', CAST(n_nationkey AS STRING)), '20260105',
               CASE WHEN n_nationkey > 20 THEN '3' ELSE '2' END FROM nation
        UNION ALL
        SELECT 'V0', '20240199', '1' FROM region"""
    sql["bad_routes"] = """
        SELECT route_id,
               CASE WHEN route_short_name = 'Brand#4' THEN 'A-none' ELSE agency_id END
                   AS agency_id,
               route_short_name, route_long_name, route_desc,
               CASE WHEN route_short_name = 'Brand#3' THEN '-1'
                    WHEN route_short_name = 'Brand#9' THEN 'bus' ELSE route_type END
                   AS route_type,
               route_url,
               CASE WHEN route_desc = 'PROMO' AND route_color IS NOT NULL THEN 'ffd40'
                    ELSE route_color END AS route_color,
               CASE WHEN route_desc = 'MEDIUM' THEN '12345G' ELSE route_text_color END
                   AS route_text_color
        FROM p2_routes
        UNION ALL
        SELECT * FROM p2_routes WHERE route_short_name = 'Brand#5'"""
    sql["bad_stops"] = """
        SELECT stop_id, stop_code,
               CASE WHEN stop_code = 'C13' THEN '  ' ELSE stop_name END AS stop_name, stop_desc,
               CASE WHEN stop_code = 'C11' THEN '95.1' WHEN stop_code = 'C12' THEN '5e1'
                    ELSE stop_lat END AS stop_lat,
               CASE WHEN stop_code = 'C14' THEN 'west' ELSE stop_lon END AS stop_lon,
               zone_id, stop_url,
               CASE WHEN stop_code = 'C15' THEN '5' ELSE location_type END AS location_type,
               parent_station,
               CASE WHEN stop_code = 'C16' THEN 'yes' ELSE wheelchair_boarding END
                   AS wheelchair_boarding
        FROM p2_stops
        UNION ALL
        SELECT * FROM p2_stops WHERE stop_code = 'C17'"""
    sql["bad_trips"] = """
        SELECT CASE WHEN trip_headsign = 'To 5-LOW' AND direction_id = '1' THEN 'R-none'
                    ELSE route_id END AS route_id,
               CASE WHEN trip_headsign = 'To 1-URGENT' AND direction_id = '1' THEN 'V-none'
                    ELSE service_id END AS service_id,
               CASE WHEN shape_id = 'H1' THEN ' ' ELSE trip_id END AS trip_id, trip_headsign,
               trip_short_name,
               CASE WHEN block_id = 'BF' THEN '2' ELSE direction_id END AS direction_id, block_id,
               CASE WHEN shape_id = 'H2' THEN 'H-none' WHEN shape_id = 'H3' THEN ''
                    ELSE shape_id END AS shape_id,
               wheelchair_accessible
        FROM p2_trips
        UNION ALL
        SELECT * FROM p2_trips WHERE shape_id = 'H4'"""
    sql["bad_stop_times"] = """
        SELECT CASE WHEN stop_sequence = '6' THEN 'T-none' ELSE trip_id END AS trip_id,
               CASE WHEN stop_id = 'S1' THEN '' ELSE arrival_time END AS arrival_time,
               CASE WHEN stop_sequence = '3' THEN '25:61:00' ELSE departure_time END
                   AS departure_time,
               CASE WHEN stop_sequence = '5' THEN 'S-none' ELSE stop_id END AS stop_id,
               stop_sequence, stop_headsign,
               CASE WHEN stop_id = 'S2' THEN '9' ELSE pickup_type END AS pickup_type,
               drop_off_type,
               CASE WHEN stop_id = 'S3' THEN '-1.5' ELSE shape_dist_traveled END
                   AS shape_dist_traveled,
               CASE WHEN stop_id = 'S4' THEN '2' ELSE timepoint END AS timepoint
        FROM p2_stop_times
        UNION ALL
        SELECT * FROM p2_stop_times WHERE stop_sequence = '7'"""
    sql["bad_shapes"] = """
        SELECT CASE WHEN shape_pt_sequence = '3' THEN '' ELSE shape_id END AS shape_id,
               CASE WHEN shape_pt_sequence = '4' THEN '91' ELSE shape_pt_lat END AS shape_pt_lat,
               CASE WHEN shape_pt_sequence = '5' THEN NULL ELSE shape_pt_lon END AS shape_pt_lon,
               CASE WHEN shape_id = 'H1' THEN '-1' ELSE shape_pt_sequence END
                   AS shape_pt_sequence,
               CASE WHEN shape_pt_sequence = '6' THEN 'far' ELSE shape_dist_traveled END
                   AS shape_dist_traveled
        FROM p2_shapes
        UNION ALL
        SELECT * FROM p2_shapes WHERE shape_id = 'H2'"""

    # Governance records.
    sql["source_snapshot"] = f"""
        SELECT CAST(k AS BIGINT) AS snapshot_key, 'Example feed' AS source_name,
               'https://feed.example/feed.zip' AS source_url,
               CAST(d AS {timestamp_type}) AS downloaded_at_utc,
               CAST(NULL AS {timestamp_type}) AS source_last_modified_utc,
               {_NONE} AS source_etag, CONCAT('feed_', CAST(k AS STRING), '.zip') AS file_name,
               (SELECT COUNT(*) FROM lineitem) AS file_size_bytes, {hash_call.format("CONCAT('publication ', CAST(k AS STRING))")} AS sha256,
               CAST('2024-01-01' AS DATE) AS feed_start_date,
               CAST('2024-04-02' AS DATE) AS feed_end_date,
               CONCAT('v', CAST(k AS STRING)) AS feed_version, 'LOADED' AS snapshot_status
        FROM (SELECT 1 AS k, '2024-01-01 22:53:08' AS d UNION ALL SELECT 2, '2024-01-08 22:53:08') p"""
    stage_rows = " UNION ALL ".join(
        f"SELECT {snapshot * 10 + i} AS k, {snapshot} AS s, '{stage}' AS p"
        for snapshot in (1, 2)
        for i, stage in enumerate(_STAGES)
    )
    sql["pipeline_run"] = f"""
        SELECT event_id + 101 AS pipeline_run_key, 1 + event_id % 2 AS snapshot_key,
               CONCAT('refresh_', event_type) AS pipeline_name, 'Spark' AS orchestrator,
               {_NONE} AS external_run_id,
               CASE WHEN value > 220 THEN 'FAILED' WHEN value > 150 THEN 'PARTIAL'
                    WHEN value < 0.6 THEN 'STARTED' ELSE 'SUCCEEDED' END AS run_status,
               ts - INTERVAL '21' DAY AS started_at_utc,
               CASE WHEN value < 0.6 THEN NULL
                    ELSE CAST(CAST(ts - INTERVAL '20' DAY AS DATE) AS {timestamp_type}) END
                   AS completed_at_utc,
               CAST(FLOOR(value * 1000) AS BIGINT) AS rows_read,
               CAST(FLOOR(value * 900) AS BIGINT) AS rows_loaded, CAST(0 AS BIGINT) AS rows_rejected,
               CASE WHEN value > 220 THEN 'stage failed' END AS error_message
        FROM events
        UNION ALL
        SELECT CAST(k AS BIGINT), CAST(s AS BIGINT), p, 'Spark', {_NONE}, 'SUCCEEDED',
               CAST('2024-01-09 08:00:00' AS {timestamp_type}),
               CAST('2024-01-09 08:10:00.250' AS {timestamp_type}),
               CAST(10 AS BIGINT), CAST(10 AS BIGINT), CAST(0 AS BIGINT), {_NONE}
        FROM ({stage_rows}) stages"""
    sql["data_quality_result"] = f"""
        SELECT event_id + 1 AS data_quality_result_key, event_id + 101 AS pipeline_run_key,
               1 + event_id % 2 AS snapshot_key,
               CONCAT('check_', CAST(user_id % 7 AS STRING)) AS check_name,
               'VALIDITY' AS check_category, event_type AS table_name,
               CASE WHEN value > 150 THEN 'FAIL' WHEN value > 80 THEN 'WARN' ELSE 'PASS' END
                   AS check_status,
               CAST(1000 AS BIGINT) AS records_checked,
               CAST(CASE WHEN value > 150 THEN 7 ELSE 0 END AS BIGINT) AS failed_records,
               CAST(NULL AS DECIMAL(18,6)) AS threshold_value,
               CAST(NULL AS DECIMAL(18,6)) AS observed_value, {_NONE} AS details,
               ts - INTERVAL '21' DAY AS checked_at_utc
        FROM events"""
    return sql


def needed_names(definitions: dict[str, str], text: str) -> list[str]:
    """Return, in definition order, every entry that ``text`` uses."""
    needed: set[str] = set()
    frontier = [text]
    while frontier:
        words = set(re.findall(r"[A-Za-z_][A-Za-z_0-9]*", frontier.pop()))
        for name in definitions:
            if name in words and name not in needed:
                needed.add(name)
                frontier.append(definitions[name])
    return [name for name in definitions if name in needed]


def with_clause(definitions: dict[str, str], text: str) -> str:
    """Prefix ``text`` with the common table expressions it uses."""
    names = needed_names(definitions, text)
    if not names:
        return text
    body = ",\n".join(f"{name} AS ({definitions[name]})" for name in names)
    return f"WITH {body}\n{text}"


def projected(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Return one projected table read from the test data in ``folder``."""
    definitions = {
        raw: f"SELECT * FROM parquet.`{table_path(folder, raw)}`" for raw in RAW_TABLES
    }
    if name.endswith("_stop_times"):
        # Calls are numbered and counted within an order: its lines move once, to one place for both.
        definitions["lineitem"] = definitions["lineitem"].replace("SELECT", "SELECT /*+ REPARTITION(l_orderkey) */", 1)
    definitions.update(projection_sql("TIMESTAMP_NTZ", "sha2({}, 256)"))
    return spark.sql(with_clause(definitions, f"SELECT * FROM {name}"))
