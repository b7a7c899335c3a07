from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from linespan.plans import serving
from linespan.session import run_folder


def rows_scanned(rows) -> int:
    """Rows that the scan of a collected frame handed on."""
    plan = rows._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.finalPhysicalPlan()
    leaf = plan.collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


@pytest.mark.parametrize("alike", [True, False])
def test_each_lookup_reads_one_range_or_one_file(spark, alike, monkeypatch):
    # Few values go to a dictionary, many to a Bloom filter; the reader asks either.
    total = 4_000 if alike else 400_000
    code = F.sha2(F.col("id").cast("string"), 256)
    rows = spark.range(total, numPartitions=3).select(
        ((F.col("id") * 7919) % total).alias("network_service_rank"), code.alias("route_id"),
        F.lit("x").alias("name"),
    )
    path = run_folder(spark, "one-table") + "/t"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        count = serving.write_served(rows, path, (("network_service_rank",), ("route_id",)))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert count == total
    stored = spark.read.parquet(path)
    files = {r[0]: r[1] for r in stored.groupBy(F.input_file_name()).count().collect()}
    assert len(files) > 2
    largest = max(files.values())
    ranked = stored.where("network_service_rank = 77")
    assert len(ranked.collect()) == 1 and rows_scanned(ranked) <= largest
    named = stored.where(F.col("route_id") == stored.where("network_service_rank = 77").first().route_id)
    assert [r.network_service_rank for r in named.collect()] == [77]
    assert rows_scanned(named) <= largest
    absent = stored.where(F.col("route_id") == "no such route")
    assert absent.collect() == [] and rows_scanned(absent) == 0


def test_tables_without_rows_or_lookups_are_written(spark):
    rows = spark.createDataFrame([], "route_id string, transport_mode string")
    for number, lookups in enumerate(((), (("route_id",),), (("route_id",), ("transport_mode",)))):
        path = run_folder(spark, "empty-table") + f"/t{number}"
        assert serving.write_served(rows, path, lookups) == 0
        assert spark.read.schema(rows.schema).parquet(path).count() == 0
