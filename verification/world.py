"""The projected test data as two publications and their warehouse."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linespan.operators import changes
from linespan.plans.warehouse import PublicationBuild, Warehouse
from linespan.session import bound_tasks, settled, stored_bytes, table_path
from linespan.sources.feed import with_lineage
from verification.projection import AS_OF, LATEST_SNAPSHOT, OLDER_SNAPSHOT, RAW_TABLES, projected


def plain(rows: DataFrame) -> DataFrame:
    """Whole numbers as BIGINT and decimals as DOUBLE, for comparison."""
    columns = []
    for field in rows.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            column = column.cast("bigint")
        columns.append(column.alias(field.name))
    return rows.select(*columns)


# Written tables by application and test-data folder. A deployed warehouse
# stores every staged and derived table; the queries read them the same way.
_WRITTEN: dict[tuple[str, str, str], DataFrame] = {}


class World:
    """Publications 1 and 2 over one test-data folder.

    Tables are derived from the given tables by Spark on first use and written
    to the shared folder. Each query then runs its operator over whole tables.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder
        bound_tasks(spark, stored_bytes(spark, [table_path(folder, name) for name in RAW_TABLES]))

    def kept(self, name: str, make) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _WRITTEN:
            _WRITTEN[key] = settled(make(), name.replace("_", "-"))
        return _WRITTEN[key]

    def feed(self, snapshot_key: int, table: str) -> DataFrame:
        """Feed rows as published, all text."""
        return projected(self.spark, self.folder, f"p{snapshot_key}_{table}")

    def staged(self, snapshot_key: int, table: str) -> DataFrame:
        return self.kept(
            f"staged{snapshot_key}_{table}",
            lambda: with_lineage(self.feed(snapshot_key, table), table, snapshot_key),
        )

    def _registry(self, name: str) -> DataFrame:
        return self.kept(name, lambda: projected(self.spark, self.folder, name))

    @property
    def snapshots(self) -> DataFrame:
        return self._registry("source_snapshot")

    @property
    def runs(self) -> DataFrame:
        return self._registry("pipeline_run")

    @property
    def quality(self) -> DataFrame:
        return self._registry("data_quality_result")

    def _build(self, snapshot_key: int, previous: PublicationBuild | None) -> PublicationBuild:
        return PublicationBuild(
            lambda name: self.staged(snapshot_key, name),
            self.snapshots,
            snapshot_key,
            previous,
            keep=lambda name, make: self.kept(f"built{snapshot_key}_{name}", make),
        )

    @cached_property
    def older(self) -> PublicationBuild:
        return self._build(OLDER_SNAPSHOT, None)

    @cached_property
    def latest(self) -> PublicationBuild:
        return self._build(LATEST_SNAPSHOT, self.older)

    def detected(self) -> DataFrame:
        b = self.latest
        return changes.publication_changes(
            b.entity_state(OLDER_SNAPSHOT), b.entity_state(LATEST_SNAPSHOT)
        )

    def change_rows(self) -> DataFrame:
        return changes.change_rows(self.detected(), OLDER_SNAPSHOT, LATEST_SNAPSHOT, AS_OF)

    @cached_property
    def warehouse(self) -> Warehouse:
        b = self.latest
        return Warehouse(
            {
                "snapshots": lambda: self.snapshots,
                "runs": lambda: self.runs,
                "quality": lambda: self.quality,
                "dim_date": lambda: b.dim_date,
                "dim_operator": lambda: b.dim_operator,
                "dim_route": lambda: b.dim_route,
                "dim_stop": lambda: b.dim_stop,
                "dim_service": lambda: b.dim_service,
                "dim_trip": b.all_trips,
                "bridge": lambda: b.bridge,
                "events": lambda: b.events,
                "shapes": lambda: b.shapes,
                "route_days": lambda: b.route_days,
                "stop_days": lambda: b.stop_days,
                "changes": lambda: self.kept("fact_publication_change", self.change_rows),
            }
        )

    def view(self, name: str, make) -> DataFrame:
        """A written view, for dashboard reads over serving tables."""
        return self.kept(f"view_{name}", make)
