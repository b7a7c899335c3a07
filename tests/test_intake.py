from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from linespan.operators import governance
from linespan.session import run_folder
from linespan.sources.store import Store
from linespan.streaming import intake


def staged(spark, numbers):
    return spark.createDataFrame(
        [(2, f"H{n % 3}", n) for n in numbers], "snapshot_key bigint, shape_id string, n int"
    )


def run(spark, source, store, checkpoint):
    return intake.incremental_intake(
        spark, source, staged(spark, [0]).schema, store, "points",
        ("snapshot_key", "shape_id", "n"), 2, lambda batch: batch, checkpoint,
        files_per_batch=1,
    )


def test_intake_resumes_and_never_inserts_twice(spark):
    source, store = run_folder(spark, "source"), Store(spark, run_folder(spark, "store"))
    staged(spark, range(50)).repartition(3).write.parquet(source)
    assert run(spark, source, store, f"{store.root}/cursor").count() == 50
    staged(spark, range(40, 80)).write.mode("append").parquet(source)
    stored = run(spark, source, store, f"{store.root}/cursor")
    assert stored.count() == 80 and stored.distinct().count() == 80
    # A lost cursor replays every file.
    assert run(spark, source, store, f"{store.root}/other").count() == 80
    assert not store.exists("points_arrived")
    keys = ("snapshot_key", "shape_id", "n")
    intake.check_complete(stored, staged(spark, range(80)), keys, "points")
    with pytest.raises(intake.IntakeError, match="80 rows for 81"):
        intake.check_complete(stored, staged(spark, range(81)), keys, "points")
    files = store.read("points_files")
    assert files.agg(F.sum("row_count")).first()[0] == 50 + 40 + 90


def test_intake_refuses_rows_that_disagree(spark):
    source, store = run_folder(spark, "source"), Store(spark, run_folder(spark, "store"))
    one = spark.createDataFrame([(2, "H1", 1), (2, "H2", 1)], "snapshot_key bigint, shape_id string, n int")

    def run_keyed(cursor):
        return intake.incremental_intake(
            spark, source, one.schema, store, "points", ("snapshot_key", "shape_id"), 2, lambda batch: batch,
            f"{store.root}/{cursor}",
        )

    one.write.parquet(source)
    assert run_keyed("a").count() == 2
    one.withColumn("n", F.lit(2)).limit(1).write.mode("append").parquet(source)
    with pytest.raises(intake.IntakeError, match="holds other rows"):
        run_keyed("a")
    with pytest.raises(intake.IntakeError, match="rows that disagree"):
        run_keyed("b")
    assert store.read("points").count() == 2


def test_store_partitions(spark):
    store = Store(spark, run_folder(spark, "store"))
    first, second = staged(spark, range(5)), staged(spark, range(7))
    store.replace_snapshot("t", first, 1)
    store.replace_snapshot("t", second, 2)
    store.replace_snapshot("t", second, 2)
    assert store.read("t").count() == 12
    assert store.read_load("t", 1).count() == 5
    store.replace_rolling("t", first, 3)
    assert store.read("t").count() == 5
    assert not store.exists("nothing")


def test_failed_stage_is_recorded_and_raised(spark):
    store = Store(spark, run_folder(spark, "audit"))

    def broken():
        raise LookupError("x" * 5000)

    def log(row):
        store.append("runs", row)

    with pytest.raises(LookupError):
        governance.run_audit(spark, log, "stage", 3, broken)
    governance.run_audit(spark, log, "stage", 3, lambda: (7, 6))
    events = store.read("runs")
    assert events.count() == 4
    runs = {r.run_status: r for r in governance.latest_runs(events).collect()}
    assert set(runs) == {"FAILED", "SUCCEEDED"}
    assert len(runs["FAILED"].error_message) == 4000
    assert (runs["SUCCEEDED"].rows_read, runs["SUCCEEDED"].rows_loaded) == (7, 6)
    assert runs["SUCCEEDED"].completed_at_utc >= runs["SUCCEEDED"].started_at_utc
    assert events.where(F.col("run_status") == "STARTED").count() == 2
