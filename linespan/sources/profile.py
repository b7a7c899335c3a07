"""Structural and column profiles of feed files."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linespan.schemas import FEED_COLUMNS
from linespan.sources.feed import MALFORMED, scans


def missing_files(names: Iterable[str]) -> list[str]:
    """Required files that are not among the landed names."""
    return sorted({f"{table}.txt" for table in FEED_COLUMNS} - set(names))


def profile_table(parts: list[DataFrame], table: str) -> DataFrame:
    """Columns, column count, row count, malformed rows and bytes of the scans of one table."""
    columns = list(dict.fromkeys(c for rows in parts for c in rows.columns if c != MALFORMED))

    def marked(rows: DataFrame) -> DataFrame:
        # The malformed mark is only available beside a parsed column.
        first = F.coalesce(F.col(f"`{rows.columns[0]}`"), F.lit(""))
        return rows.select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_size").alias("size"),
            F.concat(first, F.col(MALFORMED)).alias("malformed"),
        )

    per_file = reduce(DataFrame.unionByName, map(marked, parts)).groupBy("path").agg(
        F.max("size").alias("size"),
        F.count("*").alias("rows"),
        F.count("malformed").alias("malformed"),
    )
    return per_file.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum("malformed"), F.lit(0)).alias("malformed_row_count"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("uncompressed_bytes"),
    ).select(
        F.lit(table).alias("table_name"),
        F.lit(",".join(columns)).alias("columns"),
        F.lit(len(columns)).alias("column_count"),
        "row_count",
        "malformed_row_count",
        "uncompressed_bytes",
    )


def profile_structure(spark: SparkSession, folder: str, tables: Iterable[str]) -> DataFrame:
    """One row per feed table."""
    parts = [profile_table(scans(spark, f"{folder}/{t}.txt"), t) for t in tables]
    return reduce(DataFrame.unionByName, parts)


def profile_columns(rows: DataFrame, table: str) -> DataFrame:
    """Per column: longest value, blank values, blank share in per cent.

    One pass over the table measures every column.
    """
    columns = [c for c in rows.columns if c != MALFORMED]
    aggregates = [F.count("*").alias("_rows")]
    for i, name in enumerate(columns):
        value = F.coalesce(F.col(f"`{name}`"), F.lit(""))
        aggregates += [
            F.max(F.length(value)).alias(f"_length_{i}"),
            F.count_if(F.trim(value) == "").alias(f"_blank_{i}"),
        ]
    percentage = [
        F.round(
            F.try_divide(
                F.col(f"_blank_{i}").cast("decimal(18,0)") * 100,
                F.col("_rows").cast("decimal(18,0)"),
            ),
            4,
        ).cast("decimal(7,4)")
        for i in range(len(columns))
    ]
    results = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(name).alias("column_name"),
            F.coalesce(F.col(f"_length_{i}"), F.lit(0)).alias("max_length"),
            F.col(f"_blank_{i}").alias("blank_count"),
            F.coalesce(percentage[i], F.lit(0).cast("decimal(7,4)")).alias("blank_percentage"),
        )
        for i, name in enumerate(columns)
    ]
    return rows.agg(*aggregates).select(F.inline(F.array(*results)))
