"""One publication from landed feed files to published serving tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linespan import schemas
from linespan.operators import calendar, changes, daily, quality, schedule
from linespan.operators.governance import latest_runs, new_run_key, now_utc, run_audit
from linespan.operators.history import absent_rows
from linespan.plans.serving import serving_export
from linespan.plans.warehouse import PublicationBuild, Warehouse
from linespan.session import settled
from linespan.sources import catalogue
from linespan.sources.store import SYNCED, Store

SNAPSHOTS = "source_snapshot"
STATUS_EVENTS = "source_snapshot_status"
RUN_EVENTS = "pipeline_run"
QUALITY = "data_quality_result"
CHANGES = "fact_publication_change"
# Service days derived, inserted and deleted by each run of the service stage.
SYNC_COUNTS = "service_date_sync"


class Refresh:
    """Stages of one publication, in order, over one store.

    ``feed`` returns the staged rows of a feed table by name, lineage columns
    included. Every stage is audited; quality rules gate the next stage.
    """

    def __init__(
        self,
        spark: SparkSession,
        store: Store,
        snapshot_key: int,
        feed: Callable[[str], DataFrame],
        horizon_days: int = daily.DEFAULT_HORIZON_DAYS,
    ) -> None:
        self.spark = spark
        self.store = store
        self.snapshot_key = snapshot_key
        self.feed = feed
        self.horizon_days = horizon_days
        self.run_key: int | None = None

    # Registry and logs --------------------------------------------------

    def snapshots(self) -> DataFrame:
        registered = self.store.read(SNAPSHOTS)
        if not self.store.exists(STATUS_EVENTS):
            return registered
        return catalogue.loaded_snapshots(registered, self.store.read(STATUS_EVENTS))

    def runs(self) -> DataFrame:
        return latest_runs(self.store.read(RUN_EVENTS))

    def set_status(self, status: str, event_number: int) -> None:
        row = [(self.snapshot_key, status, now_utc(), event_number)]
        schema = (
            "snapshot_key BIGINT, snapshot_status STRING, changed_at_utc TIMESTAMP_NTZ, "
            "event_number INT"
        )
        self.store.append(STATUS_EVENTS, self.spark.createDataFrame(row, schema))

    def stage(self, name: str, work: Callable[[], tuple[int, int]]) -> int:
        self.run_key = new_run_key()
        return run_audit(
            self.spark, lambda row: self.store.append(RUN_EVENTS, row), name,
            self.snapshot_key, work, self.run_key,
        )

    def gated(self, results: DataFrame) -> None:
        """Record rule results, then stop the stage when one failed."""
        number = F.xxhash64(F.lit(self.run_key), "check_name", "table_name")
        rows = results.select(
            number.alias("data_quality_result_key"),
            F.lit(self.run_key).cast("bigint").alias("pipeline_run_key"),
            F.lit(self.snapshot_key).cast("bigint").alias("snapshot_key"),
            "check_name", "check_category", "table_name", "check_status", "records_checked",
            "failed_records",
            F.lit(None).cast("decimal(18,6)").alias("threshold_value"),
            F.lit(None).cast("decimal(18,6)").alias("observed_value"),
            F.lit(None).cast("string").alias("details"),
            F.lit(now_utc()).cast("timestamp_ntz").alias("checked_at_utc"),
        ).coalesce(1)
        written = self.store.replace_snapshot(
            f"{QUALITY}_latest", rows, self.snapshot_key
        )
        self.store.append(QUALITY, written)
        quality.gate(written)

    # Staging -------------------------------------------------------------

    def _stage_tables(self, tables: tuple[str, ...]) -> tuple[int, int]:
        total = 0
        for table in tables:
            replace = (
                self.store.replace_rolling
                if table in schemas.ROLLING_TABLES
                else self.store.replace_snapshot
            )
            total += replace(f"staging_{table}", self.feed(table), self.snapshot_key).count()
        return total, total

    def staged(self, table: str) -> DataFrame:
        return self.store.read_load(f"staging_{table}", self.snapshot_key)

    def stage_feed(self) -> None:
        groups = (
            (schemas.STAGE_REFERENCE, schemas.REFERENCE_TABLES, catalogue.VALIDATED),
            (schemas.STAGE_NETWORK, schemas.NETWORK_TABLES, catalogue.VALIDATED),
            (schemas.STAGE_HIGH_VOLUME, schemas.ROLLING_TABLES, catalogue.LOADED),
        )
        for number, (name, tables, status) in enumerate(groups, start=1):
            self.stage(name, lambda tables=tables: self._stage_tables(tables))
            self.set_status(status, number)

    # Warehouse -----------------------------------------------------------

    def previous_key(self) -> int | None:
        """The publication this one continues and is compared with.

        One definition for both: the latest earlier loaded publication whose
        entity stages all succeeded, whatever became of its later stages.
        """
        earlier = changes.previous_snapshot(self.snapshots(), self.runs(), self.snapshot_key).first()
        return None if earlier is None else earlier.snapshot_key

    def build(self) -> PublicationBuild:
        snapshots = self.snapshots()
        previous_key = self.previous_key()
        previous = None
        if previous_key is not None:
            previous = PublicationBuild(
                self.staged, snapshots, previous_key, keep=self.store.kept(previous_key)
            )
        return PublicationBuild(
            self.staged, snapshots, self.snapshot_key, previous,
            keep=self.store.keep(self.snapshot_key), horizon_days=self.horizon_days,
        )

    def load_warehouse(self) -> PublicationBuild:
        b = self.build()
        key = self.snapshot_key
        stored = lambda table: self.store.stored_load(table, key)

        def newest(table: str, none: DataFrame) -> DataFrame:
            """History of the newest load, which an older publication must not continue."""
            rows = self.store.newest_load(table)
            return none.limit(0) if rows is None else rows

        def core() -> tuple[int, int]:
            self.gated(
                quality.dq_core(
                    b.snapshots, key, newest("dim_operator", b.merged_operators()), self.staged("agency"), self.staged("calendar"),
                    self.staged("calendar_dates"), b.date_bounds(),
                )
            )
            return self.staged("agency").count(), b.dim_date.count() + b.dim_operator.count()

        def network() -> tuple[int, int]:
            self.gated(
                quality.dq_network(
                    b.snapshots, self.runs(), key, b.dim_operator,
                    newest("dim_route", b.merged_routes()), newest("dim_stop", b.merged_stops()),
                    self.staged("routes"), self.staged("stops"),
                )
            )
            read = self.staged("routes").count() + self.staged("stops").count()
            return read, b.dim_route.count() + b.dim_stop.count()

        def service() -> tuple[int, int]:
            self.gated(
                quality.dq_calendar(
                    b.snapshots, self.runs(), key, self.staged("calendar"),
                    self.staged("calendar_dates"), stored("dim_service"), b.dim_date,
                )
            )
            changed = self.sync_bridge(b)
            return self.staged("calendar_dates").count(), b.services.count() + changed

        def trip() -> tuple[int, int]:
            source = b.trip_source()
            self.gated(
                quality.dq_trips(
                    b.snapshots, self.runs(), key, self.staged("trips"), b.route_versions(),
                    b.services, self.staged("shapes"), stored("dim_trip"), source,
                )
            )
            return self.staged("trips").count(), b.trips.count()

        def shape() -> tuple[int, int]:
            source = schedule.shape_point(self.staged("shapes"), key)
            self.gated(
                quality.dq_shapes(
                    b.snapshots, self.runs(), key, self.staged("shapes"), stored("shape_point"), source,
                    schemas.STAGE_HIGH_VOLUME,
                )
            )
            return self.staged("shapes").count(), b.shapes.count()

        def stop_event() -> tuple[int, int]:
            source = b.event_source()
            self.gated(
                quality.dq_stop_times(
                    b.snapshots, self.runs(), key, self.staged("stop_times"), b.trips,
                    b.stop_versions(), stored("fact_scheduled_stop_event"), source,
                )
            )
            return self.staged("stop_times").count(), b.events.count()

        def daily_fact() -> tuple[int, int]:
            # What the facts come from is checked before any fact is written.
            self.gated(quality.dq_window_bounds(b.window_row()))
            self.gated(quality.dq_window_content(b.bridge, b.window, b.window_events(), key))
            old = stored("fact_route_service_day"), stored("fact_stop_service_day")
            self.gated(
                quality.dq_fact_agreement(
                    b.window, old[0], b.derived_route_days(), old[1], b.derived_stop_days(), key
                )
            )
            written = self.store.insert_batches(
                {
                    "fact_route_service_day": (b.derived_route_days(), daily.ROUTE_DAY_KEYS),
                    "fact_stop_service_day": (b.derived_stop_days(), daily.STOP_DAY_KEYS),
                },
                key,
            )
            return b.events.count(), sum(written.values())

        self.stage(schemas.STAGE_CORE, core)
        self.stage(schemas.STAGE_DIM_NETWORK, network)
        self.stage(schemas.STAGE_SERVICE, service)
        self.stage(schemas.STAGE_TRIP, trip)
        self.stage(schemas.STAGE_SHAPE, shape)
        self.stage(schemas.STAGE_STOP_EVENT, stop_event)
        self.stage(schemas.STAGE_DAILY_FACT, daily_fact)
        self.stage(schemas.STAGE_CHANGE, lambda: self.load_changes(b))
        return b

    def sync_bridge(self, b: PublicationBuild) -> int:
        """Make the stored bridge equal the derived one; log the counts, return the rows inserted.

        Only months with a difference are written.
        """
        derived = settled(b.service_dates(), "service-dates")
        stored = self.store.stored_load(SYNCED, self.snapshot_key)
        actions = settled(
            calendar.bridge_sync(derived.limit(0) if stored is None else stored, derived), "bridge-actions"
        )
        counts = calendar.bridge_sync_counts(actions)
        month = calendar.bridge_batch(F.col("full_date"))
        self.store.replace_batches(
            SYNCED, derived, self.snapshot_key, month, calendar.changed_batches(actions)
        )
        self.store.append(
            SYNC_COUNTS,
            counts.select(
                F.lit(self.run_key).cast("bigint").alias("pipeline_run_key"),
                F.lit(self.snapshot_key).cast("bigint").alias("snapshot_key"), "*",
            ),
        )
        return counts.first().service_date_rows_inserted

    def load_changes(self, b: PublicationBuild) -> tuple[int, int]:
        """Compare with the publication the build continues, then check the whole model."""
        key = self.snapshot_key
        current = b.entity_state(key)
        if b.previous is None:
            schema = changes.change_rows(
                changes.publication_changes(current, current), key, key, "2000-01-01"
            ).schema
            detected = self.spark.createDataFrame([], schema)
        else:
            earlier = b.previous.snapshot_key
            detected = changes.change_rows(
                changes.publication_changes(b.entity_state(earlier), current),
                earlier, key, now_utc().isoformat(),
            )
            self.gated(
                quality.dq_changes(
                    b.snapshots, self.runs(), earlier, key, self.store.stored_load(CHANGES, key),
                    detected,
                )
            )
        logged = self.store.insert_absent(CHANGES, detected, changes.CHANGE_KEYS, key)
        self.gated(
            quality.dq_model(
                b.snapshots, self.runs(), self.store.read(QUALITY), b.dim_operator, b.dim_route,
                b.dim_stop, logged,
            )
        )
        return current.count(), logged.count()

    # Serving -------------------------------------------------------------

    def warehouse(self, b: PublicationBuild) -> Warehouse:
        read = self.store.read
        return Warehouse(
            {
                "snapshots": self.snapshots,
                "runs": self.runs,
                "quality": lambda: read(QUALITY),
                "dim_date": lambda: b.dim_date,
                "dim_operator": lambda: b.dim_operator,
                "dim_route": lambda: b.dim_route,
                "dim_stop": lambda: b.dim_stop,
                "dim_service": lambda: read("dim_service"),
                "dim_trip": lambda: read("dim_trip"),
                "bridge": lambda: b.bridge,
                "events": lambda: b.events,
                "shapes": lambda: b.shapes,
                "route_days": lambda: b.route_days,
                "stop_days": lambda: b.stop_days,
                "changes": lambda: read(CHANGES),
            }
        )

    def export(self, b: PublicationBuild, root: str, as_of: str | None = None) -> DataFrame:
        moment = as_of or now_utc().isoformat(sep=" ", timespec="milliseconds")
        version = f"v{now_utc():%Y%m%dT%H%M%S%f}"
        exported: list[DataFrame] = []

        def work() -> tuple[int, int]:
            manifest = serving_export(self.warehouse(b), self.spark, root, version, moment)
            exported.append(manifest)
            total = manifest.agg(F.sum("row_count")).first()[0]
            return total, total

        self.stage(schemas.STAGE_EXPORT, work)
        for table in schemas.ROLLING_TABLES:
            self.store.vacuum(f"staging_{table}")
        return exported[0]


def register(store: Store, new_rows: DataFrame) -> DataFrame:
    """Add registry rows whose SHA-256 is new and return the registry."""
    stored = store.read(SNAPSHOTS) if store.exists(SNAPSHOTS) else None
    store.append(SNAPSHOTS, absent_rows(new_rows, stored, ("sha256",)))
    return store.read(SNAPSHOTS)


def run_refresh(
    spark: SparkSession,
    store: Store,
    snapshot: DataFrame,
    feed: Callable[[int, str], DataFrame],
    serving_root: str,
    force: bool = False,
    as_of: str | None = None,
) -> DataFrame | None:
    """Register, stage, build and export one landed publication.

    ``snapshot`` is its registry row. A publication whose export succeeded
    before is skipped unless ``force`` is set. Returns the export manifest, or
    None when skipped.
    """
    registered = register(store, snapshot)
    identity = snapshot.select("sha256")
    row = identity.join(registered, "sha256").select("snapshot_key").first()
    runs = (
        latest_runs(store.read(RUN_EVENTS))
        if store.exists(RUN_EVENTS)
        else spark.createDataFrame([], schemas.RUN_SCHEMA)
    )
    action = catalogue.snapshot_gate(identity, registered, runs, force).first().action
    if action == "SKIP":
        return None
    key = row.snapshot_key
    refresh = Refresh(spark, store, key, lambda table: feed(key, table))
    refresh.stage_feed()
    return refresh.export(refresh.load_warehouse(), serving_root, as_of)
