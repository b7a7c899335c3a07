"""Work that must not grow per task, or move more than it has to."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from linespan.operators import quality
from linespan.operators.daily import ROUTE_DAY_COMPARE, STOP_DAY_COMPARE, Window
from linespan.plans import serving, views
from linespan.plans.warehouse import Warehouse
from linespan.session import bound_tasks, run_folder, settled
from verification.world import World

INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def test_rows_of_a_task_do_not_grow_with_the_input(spark, small):
    World(spark, small)
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.parallelismFirst") == "false"
    assert int(spark.conf.get(INITIAL)) >= int(spark.conf.get("spark.sql.shuffle.partitions"))

    def largest_task(rows: int) -> int:
        bound_tasks(spark, rows * 64)
        keys = spark.range(rows).groupBy(F.sha2(F.col("id").cast("string"), 256).alias("k")).count()
        return keys.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

    try:
        assert largest_task(1_200_000) < 1.6 * largest_task(300_000)
    finally:
        bound_tasks(spark, 0)


def test_written_tables_are_compressed_with_zstd(spark):
    path = settled(spark.range(9), "codec").inputFiles()[0]
    assert path.endswith(".zstd.parquet")


def test_active_operators_are_distinct_without_a_row_per_operator_and_day(spark):
    days = [dt.date(1969, 12, 30), dt.date(1969, 12, 31), dt.date(1970, 1, 1), dt.date(1970, 3, 7)]
    # Route, operator, indexes of its days; routes 4 and 5 repeat an operator, 6 has none.
    served = [("r1", "o1", (0, 1)), ("r2", "o2", (1, 2, 3)), ("r4", "o1", (1, 2)), ("r5", "o2", (3,)), ("r6", None, (0, 2))]
    facts = [(1, days[i], r, o, 2, 5, 3) for r, o, at in served for i in at]
    facts.append(facts[0])
    modes = {"r1": 3, "r2": 3, "r4": 0, "r5": 3, "r6": 0}
    nothing = spark.createDataFrame([], "x int")
    route_days = spark.createDataFrame(
        facts,
        "snapshot_key bigint, full_date date, route_key string, operator_key string, "
        "scheduled_trip_count bigint, scheduled_stop_event_count bigint, unique_stop_count bigint",
    ).withColumn("service_span_minutes", F.lit(1.5).cast("decimal(18,2)")).withColumn(
        "average_headway_minutes", F.lit(None).cast("decimal(18,2)")
    )
    tables = {
        "snapshots": spark.createDataFrame(
            [(1, dt.datetime(2024, 1, 1), "LOADED")],
            "snapshot_key bigint, downloaded_at_utc timestamp_ntz, snapshot_status string",
        ),
        "route_days": route_days,
        "dim_route": spark.createDataFrame(list(modes.items()), "route_key string, route_type int"),
        "dim_date": spark.createDataFrame([(d,) for d in days], "full_date date").select(
            "full_date", F.lit("d").alias("day_name"), F.lit(False).alias("is_weekend"),
            F.lit("m").alias("month_name"), F.lit(1).alias("calendar_year"),
        ),
        "quality": nothing,
    }
    summary = views.network_daily_summary(Warehouse({k: lambda v=v: v for k, v in tables.items()}))
    got = {
        (r.service_date, r.transport_mode): (r.active_route_count, r.active_operator_count, r.scheduled_trip_count)
        for r in summary.collect()
    }
    wanted: dict = {}
    for _, day, route, operator, trips, _, _ in facts:
        rows = wanted.setdefault((day, "Bus" if modes[route] == 3 else "Tram"), [0, set(), 0])
        rows[0] += 1
        rows[1] |= {operator} - {None}
        rows[2] += trips
    assert got == {key: (n, len(operators), trips) for key, (n, operators, trips) in wanted.items()}
    assert summary.columns[6:9] == ["transport_mode", "active_route_count", "active_operator_count"]
    assert "count(distinct" not in summary._jdf.queryExecution().optimizedPlan().toString()


def test_one_day_of_a_served_table_is_cut_into_several_files(spark):
    rows = spark.range(40_000, numPartitions=3).select(
        F.lit("2024-01-01").alias("service_date"), F.sha2(F.col("id").cast("string"), 256).alias("route_id")
    )
    path = run_folder(spark, "one-day") + "/t"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        lookups = (("service_date",), ("route_id", "service_date"))
        assert serving.write_served(rows, path, lookups) == 40_000
        assert serving.write_served(rows, path + "2", lookups[:1], ("route_id",)) == 40_000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for written in (path, path + "2"):
        stored = spark.read.parquet(written)
        files = [r[1] for r in stored.groupBy(F.input_file_name()).count().collect()]
        assert len(files) > 2 and max(files) < 25_000


def test_fact_rules_join_the_stored_facts_once(spark):
    window = Window(dt.date(2024, 1, 1), dt.date(2024, 1, 31))

    def facts(key: str, compare: tuple, rows: list):
        made = spark.createDataFrame(
            [(s, int(d.strftime("%Y%m%d")), d, k, n) for s, d, k, n in rows],
            f"snapshot_key bigint, date_key int, full_date date, {key} string, scheduled_trip_count bigint",
        )
        return made.select("*", *[F.lit(1).alias(c) for c in compare if c != "scheduled_trip_count"])

    day, late = dt.date(2024, 1, 5), dt.date(2024, 3, 1)
    derived = [(2, day, "a", 3), (2, day, "b", 3), (2, day, "c", 3)]
    # a agrees, b counts otherwise, x and a row without key are not derived; one lies beyond the window, one elsewhere.
    stored = [(2, day, "a", 3), (2, day, "b", 4), (2, day, "x", 3), (2, day, None, 3), (2, late, "y", 3), (1, day, "z", 3)]
    results = quality.dq_fact_agreement(
        window, facts("route_key", ROUTE_DAY_COMPARE, stored), facts("route_key", ROUTE_DAY_COMPARE, derived),
        facts("stop_key", STOP_DAY_COMPARE, derived), facts("stop_key", STOP_DAY_COMPARE, derived), 2,
    )
    got = {r.check_name[:5]: (r.check_status, r.records_checked, r.failed_records) for r in results.collect()}
    assert got == {
        "50610": ("FAIL", 1, 1), "50611": ("FAIL", 2, 2), "50614": ("FAIL", 1, 1),
        "50612": ("PASS", 1, 0), "50613": ("PASS", 1, 0), "50615": ("PASS", 1, 0),
    }
    assert results._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 2
