"""Reading feed files: declared columns, malformed records, lineage."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linespan.functions.columns import row_hash
from linespan.schemas import FEED_COLUMNS
from linespan.session import settled

MALFORMED = "_malformed_record"
FIRST_DATA_ROW = 2


class FeedError(ValueError):
    """Raised when a feed file breaks its contract."""


def _reader(spark: SparkSession, multi_line: bool):
    return (
        spark.read.option("header", True)
        .option("encoding", "UTF-8")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("inferSchema", False)
    )


def file_shapes(spark: SparkSession, path: str) -> list[tuple[tuple[str, ...], bool, list[str]]]:
    """Files of a path by their columns and by whether a quoted value spans lines.

    One pass over the lines: a line with an odd number of quotes opens or
    closes a value of several lines. One small row a file comes back.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    order = F.struct("_metadata.file_block_start", F.monotonically_increasing_id())
    files = (
        spark.read.text(path)
        .select(F.col("_metadata.file_path").alias("file"), "value", quotes.alias("quotes"), order.alias("place"))
        .groupBy("file")
        .agg(F.min_by("value", "place").alias("header"), F.bool_or(F.col("quotes") % 2 == 1).alias("spans"))
        .orderBy("file")
        .collect()
    )
    groups: dict[tuple, list[str]] = {}
    for row in files:
        names = tuple(next(csv.reader([row.header.lstrip("\ufeff")]), ()))
        groups.setdefault((names, row.spans), []).append(row.file)
    return [(names, spans, members) for (names, spans), members in groups.items()]


def scans(spark: SparkSession, path: str) -> list[DataFrame]:
    """One scan for each kind of file: same columns in the same order, spanning values or not.

    All columns are text, with the raw record where its field count is wrong.
    Files without spanning values are read by lines and stay splittable.
    """
    parts = []
    for names, spans, files in file_shapes(spark, path):
        fields = ", ".join(f"`{name}` STRING" for name in [*names, MALFORMED])
        parts.append(
            _reader(spark, spans)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", MALFORMED)
            .option("columnPruning", False)
            .schema(fields)
            .csv(files)
        )
    if not parts:
        raise FeedError(f"{path} has no header")
    return parts


def _together(parts: list[DataFrame]) -> DataFrame:
    """Rows of all scans, columns by name."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)


def scan(spark: SparkSession, path: str) -> DataFrame:
    """All files of a path as one table, columns by name."""
    return _together(scans(spark, path))


def malformed_rows(rows: DataFrame) -> DataFrame:
    """Records with more or fewer fields than the header."""
    return rows.where(F.col(MALFORMED).isNotNull())


def check_columns(table: str, names: list[str]) -> None:
    missing = sorted(set(FEED_COLUMNS[table]) - set(names))
    if missing:
        raise FeedError(f"{table} is missing columns: {', '.join(missing)}")


def _well_formed(table: str, value: Column) -> Column:
    """The value, or an error that stops the job when the record is malformed."""
    message = F.concat(F.lit(f"{table} holds a malformed record: "), F.col(MALFORMED))
    return F.when(F.col(MALFORMED).isNull(), value).otherwise(F.raise_error(message))


def _given(name: str) -> Column:
    return F.nullif(F.col(name), F.lit(""))


def declared(rows: DataFrame, table: str) -> DataFrame:
    """Declared columns by name, in declared order, with blanks as NULL.

    A malformed record stops the job that reads it.
    """
    check_columns(table, rows.columns)
    first, *others = FEED_COLUMNS[table]
    return rows.select(
        _well_formed(table, _given(first)).alias(first),
        *[_given(name).alias(name) for name in others],
    )


def read_feed(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One feed table from a landed folder of text files."""
    parts = scans(spark, f"{folder}/{table}.txt")
    return _together([declared(part, table) for part in parts])


def with_lineage(rows: DataFrame, table: str, snapshot_key: int) -> DataFrame:
    """Add the publication key and the hash of the raw declared values."""
    return rows.select(
        F.lit(snapshot_key).cast("bigint").alias("snapshot_key"),
        *rows.columns,
        row_hash(FEED_COLUMNS[table]).alias("row_hash"),
    )


def with_row_numbers(rows: DataFrame) -> DataFrame:
    """Add ``source_row_number``: the record ordinal in its file, first data row 2.

    The rows are written once, each with its file, the start of the split it was read in
    and its place there. Counts of the written rows per split, one small row a
    split, become offsets that join the same written rows. So numbers belong to
    the splits of that one pass, however files are split before or after it, and
    a split without an offset is an error.
    """
    placed = settled(
        rows.select(
            "*",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_start"),
            F.monotonically_increasing_id().alias("_position"),
        ),
        "records",
    )
    splits = placed.groupBy("_file", "_start").agg(
        F.count("*").alias("_rows"), F.min("_position").alias("_first")
    )
    before = (
        Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = settled(
        splits.select(
            "_file", "_start", "_first",
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"),
        ),
        "row-offsets",
    )
    number = F.col("_offset") + F.col("_position") - F.col("_first") + FIRST_DATA_ROW
    lost = F.raise_error(F.concat(F.lit("no offset for a split of "), F.col("_file"))).cast("bigint")
    return placed.join(offsets, ["_file", "_start"], "left").select(
        *rows.columns, F.coalesce(number, lost).alias("source_row_number")
    )


def staged_rows(rows: DataFrame, table: str, snapshot_key: int) -> DataFrame:
    """Staged form of numbered rows: publication, row number, declared values and hash."""
    check_columns(table, rows.columns)
    columns = FEED_COLUMNS[table]
    return rows.select(
        F.lit(snapshot_key).cast("bigint").alias("snapshot_key"),
        _well_formed(table, F.col("source_row_number")).alias("source_row_number"),
        *[_given(name).alias(name) for name in columns],
        row_hash(columns).alias("row_hash"),
    )


def stage_path(spark: SparkSession, path: str, table: str, snapshot_key: int) -> DataFrame:
    """Staged rows of one feed table at a path: values, row number and hash."""
    return _together(
        [staged_rows(with_row_numbers(part), table, snapshot_key) for part in scans(spark, path)]
    )


def stage(spark: SparkSession, folder: str, table: str, snapshot_key: int) -> DataFrame:
    """Staged rows of one feed table of a folder of text files."""
    return stage_path(spark, f"{folder}/{table}.txt", table, snapshot_key)
