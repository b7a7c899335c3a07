"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable
from contextlib import contextmanager, suppress

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linespan.session import CODEC, run_folder, table_path

# The white space that separates words, as characters and as a class.
WHITE = " \t\n\x0b\f\r"
WHITE_CLASS = "[\\x20\\x09-\\x0D]"

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """Hold one session setting for the duration of a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


# Folders made since ``collecting`` began; None where nobody asks.
_made: list[str] | None = None


@contextmanager
def collecting():
    """Collect the names of the shared folders made in a block."""
    global _made
    before, _made = _made, []
    try:
        yield _made
    finally:
        _made = before


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """Name a new folder below the shared folder."""
    path = run_folder(spark, purpose)
    if _made is not None:
        _made.append(path)
    return path


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settle(rows: DataFrame, purpose: str, codec: str | None = None) -> DataFrame:
    """Write rows to the shared folder and read them back.

    The shuffle files of the finished write go at once, so the disk a chain of
    steps needs is that of its largest step.
    """
    spark = rows.sparkSession
    path = scratch_folder(spark, purpose)
    with setting(spark, CLEANUP, "true"):
        rows.write.parquet(path, compression=codec)
    table = spark.read.schema(rows.schema).parquet(path)
    table.settled_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete settled tables that no later step reads."""
    for table in tables:
        delete_folder(table.sparkSession, table.settled_path)


def keyed(docs: DataFrame, purpose: str, *, codec: str | None = None, **columns: Column) -> DataFrame:
    """Store whole rows as ``doc`` under a ``row_key`` no other row has.

    The original columns stay inside one struct, so their names cannot clash
    with those of an operator. ``columns`` are evaluated on the original rows.
    """
    extra = [expression.alias(name) for name, expression in columns.items()]
    return settle(
        docs.select(F.monotonically_increasing_id().alias("row_key"), *extra, F.struct("*").alias("doc")),
        purpose, codec,
    )


def whole_rows(stored: DataFrame, kept: DataFrame) -> DataFrame:
    """Return the original rows of ``stored`` whose ``row_key`` is in ``kept``."""
    return stored.join(kept.select("row_key"), "row_key", "left_semi").select("doc.*")


def words_of(text: Column) -> Column:
    """Split text into words; no words for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{WHITE_CLASS}+"), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it any number of times in ``body``."""
    return F.transform(F.array(value), body)[0]


def tidy(run):
    """Wrap a partition function: give freed memory back before the worker waits for its next task."""

    def wrapped(batches):
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with suppress(OSError, AttributeError):
            ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def documents(spark: SparkSession, folder: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(table_path(folder, table))


__all__ = [
    "CODEC", "WHITE", "WHITE_CLASS", "collecting", "delete_folder", "discard", "documents", "keyed", "let", "scratch_folder",
    "setting", "settle", "tidy", "whole_rows", "words_of",
]
