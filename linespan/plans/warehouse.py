"""The set of tables the views read, and the build that derives them."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linespan.operators import calendar, changes, daily, dimensions, schedule
from linespan.operators.history import versions_by_download


@dataclass
class Warehouse:
    """Tables by name; each is made or read once, on first use."""

    builders: Mapping[str, Callable[[], DataFrame]]
    _made: dict[str, DataFrame] = field(default_factory=dict)

    def __getattr__(self, name: str) -> DataFrame:
        builders = self.__dict__.get("builders", {})
        if name not in builders:
            raise AttributeError(name)
        made = self.__dict__["_made"]
        if name not in made:
            made[name] = builders[name]()
        return made[name]


WAREHOUSE_TABLES = (
    "snapshots", "runs", "quality", "dim_date", "dim_operator", "dim_route", "dim_stop",
    "dim_service", "dim_trip", "bridge", "events", "shapes", "route_days", "stop_days", "changes",
)


class PublicationBuild:
    """Derive one publication's warehouse tables from its staged tables.

    ``staged`` returns a staged feed table by name. ``previous`` is the build
    of the publication loaded before, whose versions this one continues.
    ``keep`` receives every table's name and a function that makes its plan,
    and returns what later steps read: a store returns the written table, the
    default passes the plan on.
    """

    def __init__(
        self,
        staged: Callable[[str], DataFrame],
        snapshots: DataFrame,
        snapshot_key: int,
        previous: PublicationBuild | None = None,
        keep: Callable[[str, Callable[[], DataFrame]], DataFrame] = lambda name, make: make(),
        reporting_start: str | None = None,
        horizon_days: int = daily.DEFAULT_HORIZON_DAYS,
    ) -> None:
        self.staged = staged
        self.snapshots = snapshots
        self.snapshot_key = snapshot_key
        self.previous = previous
        self.keep = keep
        self.reporting_start = reporting_start
        self.horizon_days = horizon_days

    def _earlier(self, name: str) -> DataFrame | None:
        return getattr(self.previous, name) if self.previous else None

    @property
    def registry_row(self) -> DataFrame:
        return self.snapshots.where(F.col("snapshot_key") == self.snapshot_key)

    def date_bounds(self) -> DataFrame:
        return dimensions.date_bounds(
            self.registry_row, self.staged("calendar"), self.staged("calendar_dates")
        )

    def new_dates(self) -> DataFrame:
        return dimensions.dim_date(self.date_bounds(), self._earlier("dim_date"))

    def all_dates(self) -> DataFrame:
        stored = self._earlier("dim_date")
        return self.new_dates() if stored is None else stored.unionByName(self.new_dates())

    @cached_property
    def dim_date(self) -> DataFrame:
        return self.keep("dim_date", self.all_dates)

    def operator_source(self) -> DataFrame:
        return dimensions.operator_source(self.staged("agency"))

    def merged_operators(self) -> DataFrame:
        return dimensions.scd2_operator(
            self._earlier("dim_operator"), self.operator_source(), self.snapshot_key
        )

    @cached_property
    def dim_operator(self) -> DataFrame:
        return self.keep("dim_operator", self.merged_operators)

    def route_source(self) -> DataFrame:
        return dimensions.route_source(self.staged("routes"), self.dim_operator)

    def merged_routes(self) -> DataFrame:
        return dimensions.scd2_route(
            self._earlier("dim_route"), self.route_source(), self.snapshot_key
        )

    @cached_property
    def dim_route(self) -> DataFrame:
        return self.keep("dim_route", self.merged_routes)

    def stop_source(self) -> DataFrame:
        return dimensions.stop_source(self.staged("stops"))

    def merged_stops(self) -> DataFrame:
        return dimensions.scd2_stop(
            self._earlier("dim_stop"), self.stop_source(), self.snapshot_key
        )

    @cached_property
    def dim_stop(self) -> DataFrame:
        return self.keep("dim_stop", self.merged_stops)

    def exceptions(self) -> DataFrame:
        return calendar.exception_source(self.staged("calendar_dates"))

    def service_source(self) -> DataFrame:
        return calendar.service_source(self.staged("calendar"), self.exceptions())

    def merged_services(self) -> DataFrame:
        return calendar.dim_service(
            self._earlier("dim_service"), self.service_source(), self.snapshot_key
        )

    @cached_property
    def services(self) -> DataFrame:
        """Service rows of this publication alone; each publication's are stored once."""
        return self.keep(
            "dim_service",
            lambda: calendar.dim_service(None, self.service_source(), self.snapshot_key),
        )

    @cached_property
    def dim_service(self) -> DataFrame:
        """Service rows of this and every earlier publication of the build."""
        earlier = self._earlier("dim_service")
        return self.services if earlier is None else earlier.unionByName(self.services)

    def service_dates(self) -> DataFrame:
        return calendar.bridge_service_date(self.services, self.exceptions(), self.dim_date)

    @cached_property
    def bridge(self) -> DataFrame:
        """Service days of this publication alone."""
        return self.keep("bridge_service_date", self.service_dates)

    def route_versions(self) -> DataFrame:
        return versions_by_download(self.dim_route, self.snapshots, self.snapshot_key)

    def stop_versions(self) -> DataFrame:
        return versions_by_download(self.dim_stop, self.snapshots, self.snapshot_key)

    def trip_source(self) -> DataFrame:
        return dimensions.trip_source(
            self.staged("trips"), self.route_versions(), self.services, self.snapshot_key
        )

    @cached_property
    def trips(self) -> DataFrame:
        """Trip rows of this publication alone."""
        return self.keep("dim_trip", self.trip_source)

    @cached_property
    def shapes(self) -> DataFrame:
        return self.keep(
            "shape_point", lambda: schedule.shape_point(self.staged("shapes"), self.snapshot_key)
        )

    def event_source(self) -> DataFrame:
        return schedule.scheduled_stop_event(
            self.staged("stop_times"), self.trips, self.stop_versions(), self.snapshot_key
        )

    @cached_property
    def events(self) -> DataFrame:
        return self.keep("fact_scheduled_stop_event", self.event_source)

    def window_row(self) -> DataFrame:
        return daily.reporting_window(
            self.bridge, self.snapshots, self.snapshot_key, self.reporting_start,
            self.horizon_days,
        )

    @cached_property
    def window(self) -> daily.Window:
        return daily.resolve_window(self.keep("reporting_window", self.window_row))

    def window_events(self) -> DataFrame:
        services = daily.participating_service(self.bridge, self.window, self.snapshot_key)
        return daily.window_events(self.events, services, self.snapshot_key)

    def derived_rollup(self) -> DataFrame:
        own = self.events.where(F.col("snapshot_key") == self.snapshot_key)
        return daily.service_route_stop_metric(daily.trip_stop_metric(daily.by_service_route_stop(own)))

    @cached_property
    def rollup(self) -> DataFrame:
        """Calls rolled up to service, route and stop, for both facts."""
        return self.keep("service_route_stop", self.derived_rollup)

    def derived_route_days(self) -> DataFrame:
        return daily.fact_route_service_day(
            self.events, self.bridge, self.dim_route, self.window, self.snapshot_key, self.rollup
        )

    @cached_property
    def route_days(self) -> DataFrame:
        return self.keep("fact_route_service_day", self.derived_route_days)

    def derived_stop_days(self) -> DataFrame:
        return daily.fact_stop_service_day(
            self.events, self.bridge, self.window, self.snapshot_key, self.rollup
        )

    @cached_property
    def stop_days(self) -> DataFrame:
        return self.keep("fact_stop_service_day", self.derived_stop_days)

    def all_trips(self) -> DataFrame:
        """Trips of this and every earlier publication."""
        if self.previous is None:
            return self.trips
        return self.previous.all_trips().unionByName(self.trips)

    def entity_state(self, snapshot_key: int) -> DataFrame:
        return changes.entity_state(
            self.dim_operator, self.dim_route, self.dim_stop, self.dim_service,
            self.all_trips(), snapshot_key,
        )
