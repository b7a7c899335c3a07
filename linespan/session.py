"""Session settings and the shared folder used for written intermediates."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings a timetable job wants on any cluster. Partition counts are left to
# AQE: it coalesces small shuffles and splits skewed join partitions, so one
# setting serves a small feed and a very large one.
RECOMMENDED_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# A task reads about this much, at every size of the input: without a fixed
# size AQE's tasks grow with the input up to 64 MB of compressed rows, whose
# hash tables and expanded days then take gigabytes and spill.
TASK_SETTINGS = {
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    # Shuffle files go when their query ends. Otherwise they stay until the driver collects
    # garbage, and a build that writes twenty tables keeps the shuffles of all on disk.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}
# Input for which a shuffle begins with one more partition; AQE joins small ones.
BYTES_PER_PARTITION = 1 << 20
# Compression of written tables; hashes in hex halve under it.
CODEC = "zstd"


def build_session(
    app_name: str = "linespan",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with the recommended settings applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**RECOMMENDED_SETTINGS, **TASK_SETTINGS}
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def stored_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Return the size of the files below the paths; those that are absent count nothing."""
    total = 0
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        if files.exists(folder):
            total += files.getContentSummary(folder).getLength()
    return total


def bound_tasks(spark: SparkSession, input_bytes: int) -> None:
    """Let the number of tasks grow with the input, and not what one task holds."""
    for key, value in TASK_SETTINGS.items():
        spark.conf.set(key, value)
    partitions = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes // BYTES_PER_PARTITION)
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", partitions)


def shared_folder(spark: SparkSession) -> str:
    """Return the folder for written intermediates that every executor can read.

    A cluster names it in ``spark.checkpoint.dir``. Only where nothing is set
    and driver and executors are one process, as in tests, a local folder is
    made and set for the session.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.split("[")[0] == "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    return context.getCheckpointDir().rstrip("/")


def run_folder(spark: SparkSession, purpose: str) -> str:
    """Return a new, not yet existing folder name below the shared folder."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"


def table_path(folder: str, name: str) -> str:
    """Return the path of one test-data table."""
    return os.path.join(folder, f"{name}.parquet")


def settled(rows: DataFrame, purpose: str) -> DataFrame:
    """Write rows to the shared folder and return them read back.

    Used where one result feeds several branches of a plan. Spark prunes each
    branch differently and would compute the common part once per branch. The
    written copy also survives lost executors and carries true sizes, which
    AQE needs to choose joins.
    """
    spark = rows.sparkSession
    path = run_folder(spark, purpose)
    rows.write.option("compression", CODEC).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
