"""Resumable intake of staged rows with Structured Streaming."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linespan.operators.history import conflicting_rows
from linespan.session import settled
from linespan.sources.store import Store

SOURCE_FILE = "_source_file"
# Keys named in an error.
SHOWN = 5


class IntakeError(RuntimeError):
    """Raised when arrived rows disagree with others or are not all stored."""


def incremental_intake(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    store: Store,
    table: str,
    keys: Sequence[str],
    snapshot_key: int,
    transform: Callable[[DataFrame], DataFrame],
    checkpoint: str,
    files_per_batch: int = 64,
) -> DataFrame:
    """Load every staged file not loaded yet and return the stored table.

    The checkpoint is the cursor: files are taken in bounded batches, each is
    recorded when done, and a rerun continues after the last finished batch. A
    batch is written under its number, with the rows of each of its files, so one that is
    repeated after a lost driver replaces itself, and its cost does not depend on what is stored.
    Once per run the arrived rows are merged. Equal rows are one row, and rows
    stored already are left out. A row that disagrees with another of its key, arrived
    or stored, fails the run before anything is stored; what arrived then stays for inspection
    below ``<table>_arrived`` and takes part in the next run unless it is removed. Rows per file and
    the fingerprint of a run's keys are logged in ``<table>_files``; all keys of a run must
    be stored in the end, which is checked without reading the source again.
    """
    staged = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(source)
        .select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))
    )
    cursor = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]
    arrived, counted = f"{table}_arrived/{cursor}", f"{table}_counted/{cursor}"

    def load(batch: DataFrame, number: int) -> None:
        def write(rows: DataFrame, folder: str) -> None:
            rows.write.mode("overwrite").parquet(f"{store.path(folder)}/batch={number}")

        write(transform(batch.drop(SOURCE_FILE)), arrived)
        write(batch.groupBy(F.col(SOURCE_FILE).alias("file")).agg(F.count("*").alias("row_count")), counted)

    run = (
        staged.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(load)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    if store.exists(arrived):
        rows = spark.read.parquet(store.path(arrived)).drop("batch").distinct()
        mark = merge(store, table, rows, keys, snapshot_key)
        files = spark.read.parquet(store.path(counted)).select(
            "file", "row_count", F.lit(snapshot_key).cast("bigint").alias("snapshot_key"),
            F.lit(mark).alias("run_fingerprint"),
        )
        store.append(f"{table}_files", files)
        # Merged rows are stored; what arrives next starts anew.
        store.remove(arrived)
        store.remove(counted)
    return store.read(table)


def fingerprint(keys: Sequence[str]) -> Column:
    """Sum of key hashes, which does not depend on order."""
    return F.sum(F.xxhash64(*keys).cast("decimal(38,0)"))


def merge(store: Store, table: str, arrived: DataFrame, keys: Sequence[str], snapshot_key: int) -> str:
    """Add distinct arrived rows; refuse those that disagree with another row of their key.

    Returns the fingerprint of their keys.
    """
    rows = settled(arrived, "arrived")
    several = rows.groupBy(*keys).count().where("count > 1").limit(SHOWN).collect()
    if several:
        raise IntakeError(f"{table} received rows that disagree, with keys {_shown(several, keys)}")
    stored = store.stored_load(table, snapshot_key)
    others = [c for c in rows.columns if c not in keys]
    if stored is not None and others:
        wrong = conflicting_rows(stored, rows, keys, others, missing_conflicts=False).limit(SHOWN).collect()
        if wrong:
            raise IntakeError(f"{table} holds other rows for keys {_shown(wrong, keys)}")
    now = store.insert_absent(table, rows, keys, snapshot_key)
    return check_complete(now.join(rows.select(*keys), list(keys), "left_semi"), rows, keys, table)


def _shown(rows: list, keys: Sequence[str]) -> str:
    return ", ".join(str(tuple(row[k] for k in keys)) for row in rows)


def check_complete(stored: DataFrame, source: DataFrame, keys: Sequence[str], name: str) -> str:
    """Stored rows must have the keys of the source rows, each once; their fingerprint as text."""
    have, want = (rows.agg(F.count("*"), fingerprint(keys)).first() for rows in (stored, source))
    if tuple(have) != tuple(want):
        raise IntakeError(f"{name} holds {have[0]} rows for {want[0]} source rows")
    return str(want[1] or 0)
