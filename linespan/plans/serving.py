"""Serving export: views copied to versioned Parquet, with a manifest."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linespan.operators.governance import counted
from linespan.plans import views
from linespan.plans.warehouse import Warehouse
from linespan.session import CODEC

SCHEMA_VERSION = "1"
MANIFEST = "export_manifest"
METADATA = "serving_metadata"
POINTER = "published_versions"

# Serving tables with their lookup columns. Rows are placed in
# ranges of the first lookup and sorted, so readers skip files by statistics;
# columns of the other lookups carry Bloom filters (see write_served).
SERVING_LOOKUPS: dict[str, tuple[tuple[str, ...], ...]] = {
    "dashboard_kpis": (),
    "platform_summary": (),
    "network_daily_summary": (("service_date",),),
    "route_service_daily": (("service_date",), ("route_id", "service_date")),
    "route_summary": (("route_id",), ("transport_mode",)),
    "route_service_intelligence": (("network_service_rank",), ("route_id",)),
    "stop_summary": (("stop_id",), ("zone_id",)),
    "stop_service_intelligence": (("network_activity_rank",), ("stop_id",)),
    "operator_summary": (("agency_id",),),
    "transport_mode_summary": (("transport_mode",),),
    "location_summary": (("location_group",),),
    "publication_changes": (("change_type",), ("entity_type",)),
    "publication_change_summary": (("current_snapshot_key",),),
    "stop_location_changes": (("current_snapshot_key",), ("stop_id",)),
    "pipeline_health": (("pipeline_name",), ("pipeline_health_status",)),
    "recent_pipeline_runs": (("pipeline_name",), ("started_at_utc",)),
    "data_quality_results": (("check_status",), ("checked_at_utc",)),
}

# Rows of one value of the first lookup are dealt to several ranges by these
# columns, after those of the other lookups: some lookups have few values.
RANGE_KEYS = {"publication_changes": ("publication_change_key",)}

# Views that others read come first, so that they are written once and reused.
EXPORT_ORDER = (
    "route_summary", "stop_summary", "route_service_intelligence", "stop_service_intelligence",
    *[name for name in SERVING_LOOKUPS if name not in (
        "route_summary", "stop_summary", "route_service_intelligence",
        "stop_service_intelligence",
    )],
)


def serving_views(
    w: Warehouse, as_of: str
) -> dict[str, Callable[[Mapping[str, DataFrame]], DataFrame]]:
    """Each serving table as a function of the serving tables written before it."""
    return {
        "route_summary": lambda done: views.route_summary(w),
        "stop_summary": lambda done: views.stop_summary(w),
        "route_service_intelligence": lambda done: views.route_service_intelligence(
            w, done["route_summary"]
        ),
        "stop_service_intelligence": lambda done: views.stop_service_intelligence(
            w, done["stop_summary"]
        ),
        "dashboard_kpis": lambda done: views.dashboard_kpis(
            w, as_of, done["route_service_intelligence"], done["stop_service_intelligence"]
        ),
        "platform_summary": lambda done: views.platform_summary(w, as_of),
        "network_daily_summary": lambda done: views.network_daily_summary(w),
        "route_service_daily": lambda done: views.route_service_daily(w),
        "operator_summary": lambda done: views.operator_summary(w, done["route_summary"]),
        "transport_mode_summary": lambda done: views.transport_mode_summary(
            w, done["route_summary"]
        ),
        "location_summary": lambda done: views.location_summary(w, done["stop_summary"]),
        "publication_changes": lambda done: views.publication_changes_view(w),
        "publication_change_summary": lambda done: views.publication_change_summary(w),
        "stop_location_changes": lambda done: views.stop_location_changes(w),
        "pipeline_health": lambda done: views.pipeline_health(w, as_of),
        "recent_pipeline_runs": lambda done: views.recent_pipeline_runs(w, as_of),
        "data_quality_results": lambda done: views.data_quality_results(w),
    }


class ExportError(RuntimeError):
    """Raised when a view does not fit its serving contract."""


def check_lookups(rows: DataFrame, table: str) -> None:
    wanted = {column for lookup in SERVING_LOOKUPS[table] for column in lookup}
    missing = sorted(wanted - set(rows.columns))
    if missing:
        raise ExportError(f"Lookup columns missing from {table}: {missing}")


def write_served(
    rows: DataFrame, path: str, lookups: tuple[tuple[str, ...], ...], range_keys: tuple[str, ...] = ()
) -> int:
    """Write one table so that each lookup opens few row groups; return its number of rows.

    A file holds a range of the first lookup, so its statistics decide. The other lookups and
    ``range_keys`` cut a frequent value, such as a day of all routes, into several files. Values of the other
    lookups lie anywhere: a reader asks the dictionary of a column chunk, or the Bloom filter
    written where the values are too many for a dictionary.
    """
    ordered = rows
    if lookups:
        order = list(dict.fromkeys([column for lookup in lookups for column in lookup] + list(range_keys)))
        ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    written, observation = counted(ordered)
    writer = written.write.mode("overwrite").option("compression", CODEC)
    for column in sorted({column for lookup in lookups[1:] for column in lookup}):
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.parquet(path)
    return observation.get["rows"]


def serving_export(
    w: Warehouse, spark: SparkSession, root: str, version: str, as_of: str
) -> DataFrame:
    """Write every serving table below ``root/version`` and publish the version.

    Readers follow the pointer, whose row is written last, so a failed export
    leaves the published version as it was. Returns the manifest.
    """
    makers = serving_views(w, as_of)
    done: dict[str, DataFrame] = {}
    counts = {}
    for table in EXPORT_ORDER:
        rows = makers[table](done)
        check_lookups(rows, table)
        path = f"{root}/{version}/{table}"
        counts[table] = write_served(rows, path, SERVING_LOOKUPS[table], RANGE_KEYS.get(table, ()))
        done[table] = spark.read.schema(rows.schema).parquet(path)
    manifest = export_manifest(spark, counts, as_of)
    manifest.write.mode("overwrite").parquet(f"{root}/{version}/{MANIFEST}")
    serving_metadata(manifest, as_of).write.mode("overwrite").parquet(
        f"{root}/{version}/{METADATA}"
    )
    pointer = spark.createDataFrame([(version, as_of)], "version STRING, exported_at_utc STRING")
    pointer.write.mode("append").parquet(f"{root}/{POINTER}")
    return spark.read.parquet(f"{root}/{version}/{MANIFEST}")


def export_manifest(spark: SparkSession, counts: Mapping[str, int], exported_at: str) -> DataFrame:
    """One row per serving table."""
    rows = [(table, f"vw_{table}", count, exported_at) for table, count in counts.items()]
    return spark.createDataFrame(
        rows, "table_name STRING, source_view STRING, row_count BIGINT, exported_at_utc STRING"
    )


def published_version(spark: SparkSession, root: str) -> str:
    """Version that readers use."""
    rows = spark.read.parquet(f"{root}/{POINTER}")
    return rows.select(F.max_by("version", F.struct("exported_at_utc", "version"))).first()[0]


def served(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A serving table of the published version."""
    return spark.read.parquet(f"{root}/{published_version(spark, root)}/{table}")


def served_row_counts(spark: SparkSession, root: str) -> DataFrame:
    """Rows actually readable per serving table of the published version."""
    version = published_version(spark, root)
    parts = [
        spark.read.parquet(f"{root}/{version}/{table}").agg(
            F.lit(table).alias("table_name"), F.count("*").alias("row_count")
        )
        for table in SERVING_LOOKUPS
    ]
    return reduce(DataFrame.unionByName, parts)


def lookup_counts(rows: DataFrame, lookup: tuple[str, ...]) -> DataFrame:
    """Rows per value of one lookup, the value as text in which NULL is blank.

    Where at most one column is text, the texts differ whenever the values do. Rows are
    then counted by the values, and one text a value is made instead of one a row.
    """
    kinds = dict(rows.dtypes)
    named = {
        c: F.coalesce(F.col(c), F.lit("")) if kinds[c] == "string" else F.col(c) for c in lookup
    }

    def value(columns: list[Column]) -> Column:
        return F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])

    count = F.count("*").alias("row_count")
    if not lookup or sum(kinds[c] == "string" for c in lookup) > 1:
        return rows.groupBy(value(list(named.values())).alias("lookup_value")).agg(count)
    counted_values = rows.groupBy(*[v.alias(c) for c, v in named.items()]).agg(count)
    return counted_values.select(value([F.col(c) for c in lookup]).alias("lookup_value"), "row_count")


def served_lookup_counts(spark: SparkSession, root: str) -> DataFrame:
    """Rows per value of every lookup of the published version; tables without one in one row."""
    version = published_version(spark, root)
    parts = []
    for table, lookups in SERVING_LOOKUPS.items():
        rows = spark.read.parquet(f"{root}/{version}/{table}")
        for lookup in lookups or ((),):
            counts = lookup_counts(rows, lookup)
            parts.append(
                counts.select(
                    F.lit(table).alias("table_name"), F.lit(",".join(lookup)).alias("lookup"),
                    "lookup_value", "row_count",
                )
            )
    return reduce(DataFrame.unionByName, parts)


def serving_metadata(manifest: DataFrame, exported_at: str) -> DataFrame:
    """Key and value rows that describe one export."""
    totals = manifest.agg(
        F.count("*").cast("string").alias("table_count"),
        F.coalesce(F.sum("row_count"), F.lit(0)).cast("string").alias("total_rows"),
    )
    values = {
        "schema_version": F.lit(SCHEMA_VERSION),
        "exported_at_utc": F.lit(exported_at),
        "table_count": F.col("table_count"),
        "total_rows": F.col("total_rows"),
    }
    entries = F.array(
        *[
            F.struct(F.lit(key).alias("metadata_key"), value.alias("metadata_value"))
            for key, value in values.items()
        ]
    )
    return totals.select(F.inline(entries))
