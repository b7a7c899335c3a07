"""Route-day and stop-day facts.

The heavy part is counting distinct stops per route and day (and routes per
stop and day) across services that run on overlapping dates. Expanding every
(service, route, stop) row by its dates and counting distinct would shuffle
that expansion. Here calls are first rolled up to (service, route, stop), once
for both facts, and a service's dates in the window are packed into 64-bit
words. ``bit_or`` over (route, stop) then gives the exact set of days the pair
is served, with a fixed-size state that combines before the shuffle. Rows are
placed by entity and word, so the days of a busy route spread over tasks. There
equal day sets collapse into one counted row, and only then are the days summed,
eight at a time in a column each, and expanded, which is never shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linespan.functions.columns import date_key
from linespan.functions.measures import ratio_2dp

DEFAULT_HORIZON_DAYS = 366
MAXIMUM_HORIZON_DAYS = 3660
WORD_BITS = 64
# Days that are summed together, in one column a measure and day.
LANES = 8


class WindowError(ValueError):
    """Raised when a publication has no reportable service dates."""


@dataclass(frozen=True)
class Window:
    """Inclusive reporting window."""

    first: date
    last: date

    @property
    def start(self) -> Column:
        return F.lit(self.first)

    @property
    def end(self) -> Column:
        return F.lit(self.last)

    @property
    def days(self) -> int:
        return (self.last - self.first).days + 1

    @property
    def words(self) -> list[str]:
        return [f"days_{i}" for i in range(-(-self.days // WORD_BITS))]

    def covers(self, day: Column) -> Column:
        return day.between(self.start, self.end)


def reporting_window(
    bridge: DataFrame,
    snapshots: DataFrame,
    snapshot_key: int,
    start_date: str | None = None,
    horizon_days: int = DEFAULT_HORIZON_DAYS,
) -> DataFrame:
    """One row with the first and last reported date.

    The window starts at ``start_date``, else at the download date, and moves
    into the range of service dates. The end is NULL-free only when it starts
    no later than the last service date.
    """
    if not 1 <= horizon_days <= MAXIMUM_HORIZON_DAYS:
        raise ValueError(f"horizon_days must be between 1 and {MAXIMUM_HORIZON_DAYS}")
    download_date = (
        snapshots.where(F.col("snapshot_key") == snapshot_key)
        .select(F.max(F.to_date("downloaded_at_utc")))
        .scalar()
    )
    wanted = F.lit(start_date).cast("date") if start_date else download_date
    bounds = bridge.where(F.col("snapshot_key") == snapshot_key).agg(
        F.min("full_date").alias("first_service_date"),
        F.max("full_date").alias("last_service_date"),
    )
    started = bounds.withColumn(
        "reporting_start_date",
        F.when(
            F.col("first_service_date").isNotNull(),
            F.greatest(wanted, F.col("first_service_date")),
        ),
    )
    return started.select(
        "reporting_start_date",
        F.least(
            F.date_add("reporting_start_date", horizon_days - 1), F.col("last_service_date")
        ).alias("reporting_end_date"),
        "first_service_date",
        "last_service_date",
    )


def resolve_window(window: DataFrame) -> Window:
    """Read the one-row reporting window, so that later plans hold literal dates.

    Literal dates prune files and fix how many day words a service needs.
    """
    row = window.first()
    if row is None or row.first_service_date is None:
        raise WindowError("The publication has no active service dates.")
    if row.reporting_start_date > row.last_service_date:
        raise WindowError("The reporting window begins after all service dates.")
    return Window(row.reporting_start_date, row.reporting_end_date)


def window_bridge(bridge: DataFrame, window: Window, snapshot_key: int) -> DataFrame:
    return bridge.where(F.col("snapshot_key") == snapshot_key).where(
        window.covers(F.col("full_date"))
    )


def participating_service(bridge: DataFrame, window: Window, snapshot_key: int) -> DataFrame:
    """Services with at least one date in the window."""
    return window_bridge(bridge, window, snapshot_key).select("service_key").distinct()


def window_events(events: DataFrame, services: DataFrame, snapshot_key: int) -> DataFrame:
    """Calls of one publication whose service runs in the window."""
    return events.where(F.col("snapshot_key") == snapshot_key).join(
        services.select("service_key"), "service_key", "left_semi"
    )


def trip_event_metric(events: DataFrame) -> DataFrame:
    return events.groupBy("trip_key", "route_key", "service_key").agg(
        F.count("*").alias("stop_event_count"),
        F.min("departure_seconds").alias("first_departure_seconds"),
        F.max("departure_seconds").alias("last_departure_seconds"),
        F.max("arrival_seconds").alias("last_arrival_seconds"),
    )


def trip_stop_metric(events: DataFrame) -> DataFrame:
    """One row per trip and stop, so a stop called twice counts once."""
    return events.groupBy("trip_key", "stop_key", "route_key", "service_key").agg(
        F.min("departure_seconds").alias("departure_seconds")
    )


def service_route_metric(trip_events: DataFrame) -> DataFrame:
    return trip_events.groupBy("service_key", "route_key").agg(
        F.count("*").alias("scheduled_trip_count"),
        F.sum("stop_event_count").alias("scheduled_stop_event_count"),
        F.min("first_departure_seconds").alias("first_departure_seconds"),
        F.max("last_departure_seconds").alias("last_departure_seconds"),
        F.max("last_arrival_seconds").alias("last_arrival_seconds"),
    )


def service_stop_metric(trip_stops: DataFrame) -> DataFrame:
    return trip_stops.groupBy("service_key", "stop_key").agg(
        F.count("*").alias("scheduled_trip_count"),
        F.min("departure_seconds").alias("first_departure_seconds"),
        F.max("departure_seconds").alias("last_departure_seconds"),
    )


def service_route_stop_metric(trip_stops: DataFrame) -> DataFrame:
    """Roll-up of the calls, from which both facts take pairs and the stop fact its measures."""
    return trip_stops.groupBy("service_key", "route_key", "stop_key").agg(
        F.count("*").alias("scheduled_trip_count"),
        F.min("departure_seconds").alias("first_departure_seconds"),
        F.max("departure_seconds").alias("last_departure_seconds"),
    )


def by_service_route_stop(events: DataFrame) -> DataFrame:
    """Calls placed once for ``trip_stop_metric`` and its roll-up: both group within these keys."""
    return events.select(
        "trip_key", "stop_key", "route_key", "service_key", "departure_seconds"
    ).repartition("service_key", "route_key", "stop_key")


def service_route_stop(trip_stops: DataFrame) -> DataFrame:
    return trip_stops.select("service_key", "route_key", "stop_key").distinct()


def service_stop_route(trip_stops: DataFrame) -> DataFrame:
    return trip_stops.select("service_key", "stop_key", "route_key").distinct()


def service_days(bridge: DataFrame, window: Window, snapshot_key: int) -> DataFrame:
    """One row per service: its days in the window packed into words.

    A publication has few services beside its calls, and in the usual window a
    service is a key and at most six words; so it is the days that go to the roll-ups.
    """
    offset = F.datediff("full_date", window.start)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(offset, F.lit(WORD_BITS)))
    word = F.call_function("div", offset, F.lit(WORD_BITS))
    packed = (
        window_bridge(bridge, window, snapshot_key)
        .groupBy("service_key")
        .agg(
            *[
                F.bit_or(F.when(word == i, bit).otherwise(F.lit(0).cast("bigint"))).alias(name)
                for i, name in enumerate(window.words)
            ]
        )
    )
    return F.broadcast(packed) if window.days <= DEFAULT_HORIZON_DAYS else packed


def pair_days(rollup: DataFrame, days: DataFrame, window: Window) -> DataFrame:
    """Per route and stop, the set of days on which some service links them."""
    return (
        rollup.select("service_key", "route_key", "stop_key").join(days, "service_key")
        .groupBy("route_key", "stop_key")
        .agg(*[F.bit_or(name).alias(name) for name in window.words])
    )


def _by_word(rows: DataFrame, window: Window) -> DataFrame:
    """One row per non-empty day word: ``_word``, its number, and ``_days``, its bits."""
    kept = [c for c in rows.columns if c not in window.words]
    words = F.array(*[F.col(name) for name in window.words])
    return rows.select(*kept, F.posexplode(words).alias("_word", "_days")).where(F.col("_days") != 0)


def _day_facts(
    base: DataFrame, pairs: DataFrame, entity: str, count_name: str, window: Window
) -> DataFrame:
    """Sum per entity and day: base measures across services, distinct partners.

    Both inputs are pre-aggregates: per entity at most one row per service and
    one per partner. They are placed by entity and word once; there rows with
    equal day sets merge. A word is then cut into bytes, and the rows of an
    entity's byte add up in one column for each of its eight days: a row finds
    its sums once a byte instead of once a day. Only sums expand, so the
    expansion itself is never shuffled.
    """
    partners = pairs.select(entity, *window.words, F.lit(1).cast("bigint").alias(count_name))
    rows = _by_word(base.unionByName(partners, allowMissingColumns=True), window)
    measures = [c for c in rows.columns if c not in (entity, "_word", "_days")]

    def summed(measure: str, value: Column) -> Column:
        if measure.endswith("_count"):
            return F.sum(value)
        return F.min(value) if measure.startswith("first_") else F.max(value)

    same_days = rows.repartition(entity, "_word").groupBy(entity, "_word", "_days").agg(
        *[summed(c, F.col(c)).alias(c) for c in measures]
    )
    parts = same_days.select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(WORD_BITS // LANES - 1))).alias("_part")
    ).withColumn(
        "_bits",
        F.call_function("shiftrightunsigned", F.col("_days"), F.col("_part") * LANES).bitwiseAND(2**LANES - 1),
    ).where("_bits <> 0")
    lanes = {
        c: [
            summed(c, F.when(F.getbit("_bits", F.lit(i)) == 1, F.col(c))).alias(f"{c}_{i}")
            for i in range(LANES)
        ]
        for c in measures
    }
    sums = parts.groupBy(entity, "_word", "_part").agg(*[lane for of in lanes.values() for lane in of])
    arrays = sums.select(
        entity, "_word", "_part", *[F.array(*[f"{c}_{i}" for i in range(LANES)]).alias(c) for c in measures]
    )
    days = arrays.select("*", F.explode(F.sequence(F.lit(0), F.lit(LANES - 1))).alias("_offset"))
    day = F.date_add(
        window.start, F.col("_word") * WORD_BITS + F.col("_part") * LANES + F.col("_offset")
    )
    # A day without any row has nothing in the two columns that every row fills one of.
    return days.select(
        entity, "_word", day.alias("full_date"), *[F.get(c, F.col("_offset")).alias(c) for c in measures]
    ).where(F.col("scheduled_trip_count").isNotNull() | F.col(count_name).isNotNull())


def _headway() -> Column:
    trips = F.col("scheduled_trip_count")
    gap = F.col("last_departure_seconds") - F.col("first_departure_seconds")
    return F.when(trips > 1, ratio_2dp(gap, (trips - 1) * 60))


def fact_route_service_day(
    events: DataFrame, bridge: DataFrame, routes: DataFrame, window: Window, snapshot_key: int,
    rollup: DataFrame | None = None,
) -> DataFrame:
    """Scheduled service per route and day of the reporting window.

    ``rollup`` is the stored ``service_route_stop_metric`` of the same events.
    """
    days = service_days(bridge, window, snapshot_key)
    own = events.where(F.col("snapshot_key") == snapshot_key)
    base = service_route_metric(trip_event_metric(own)).join(days, "service_key").drop("service_key")
    if rollup is None:
        rollup = service_route_stop_metric(trip_stop_metric(by_service_route_stop(own)))
    facts = _day_facts(
        base, pair_days(rollup, days, window), "route_key", "unique_stop_count", window
    )
    operators = routes.select("route_key", "operator_key")
    span = F.col("last_arrival_seconds") - F.col("first_departure_seconds")
    return facts.join(operators, "route_key").select(
        F.lit(snapshot_key).cast("bigint").alias("snapshot_key"),
        date_key("full_date").alias("date_key"),
        "full_date",
        "route_key",
        "operator_key",
        "scheduled_trip_count",
        "scheduled_stop_event_count",
        "unique_stop_count",
        "first_departure_seconds",
        "last_arrival_seconds",
        ratio_2dp(span, F.lit(60)).alias("service_span_minutes"),
        _headway().alias("average_headway_minutes"),
    )


def fact_stop_service_day(
    events: DataFrame, bridge: DataFrame, window: Window, snapshot_key: int,
    rollup: DataFrame | None = None,
) -> DataFrame:
    """Scheduled service per stop and day of the reporting window.

    ``rollup`` is the stored ``service_route_stop_metric`` of the same events.
    """
    days = service_days(bridge, window, snapshot_key)
    if rollup is None:
        own = events.where(F.col("snapshot_key") == snapshot_key)
        rollup = service_route_stop_metric(trip_stop_metric(by_service_route_stop(own)))
    # A trip has one route, so trips add up over the routes of a stop.
    by_stop = rollup.groupBy("service_key", "stop_key").agg(
        F.sum("scheduled_trip_count").alias("scheduled_trip_count"),
        F.min("first_departure_seconds").alias("first_departure_seconds"),
        F.max("last_departure_seconds").alias("last_departure_seconds"),
    )
    base = by_stop.join(days, "service_key").drop("service_key")
    facts = _day_facts(
        base, pair_days(rollup, days, window), "stop_key", "scheduled_route_count", window
    )
    span = F.col("last_departure_seconds") - F.col("first_departure_seconds")
    return facts.select(
        F.lit(snapshot_key).cast("bigint").alias("snapshot_key"),
        date_key("full_date").alias("date_key"),
        "full_date",
        "stop_key",
        "scheduled_trip_count",
        "scheduled_route_count",
        "first_departure_seconds",
        "last_departure_seconds",
        ratio_2dp(span, F.lit(60)).alias("service_span_minutes"),
        _headway().alias("average_headway_minutes"),
    )


ROUTE_DAY_KEYS = ("snapshot_key", "date_key", "route_key")
STOP_DAY_KEYS = ("snapshot_key", "date_key", "stop_key")
ROUTE_DAY_COMPARE = (
    "operator_key", "scheduled_trip_count", "scheduled_stop_event_count", "unique_stop_count",
    "first_departure_seconds", "last_arrival_seconds", "service_span_minutes",
    "average_headway_minutes",
)
STOP_DAY_COMPARE = (
    "scheduled_trip_count", "scheduled_route_count", "first_departure_seconds",
    "last_departure_seconds", "service_span_minutes", "average_headway_minutes",
)
