"""Daily schedules of station pairs from a GTFS timetable.

A corridor is a pair of stations (a, b). Its trips are those that stop at both; a trip runs
a → b if it reaches a first, else b → a.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railtempo.functions.times import service_time, wall_clock
from railtempo.schema import GTFS_RT_COLUMNS, REALTIME_COLUMNS, TRIPS


def active_services(
    calendar_dates: DataFrame, days: date | Iterable[date] | None = None
) -> DataFrame:
    """Service days that are added by the calendar, for one day, some days or all."""
    added = calendar_dates.filter(F.col("exception_type") == "1")
    if days is not None:
        wanted = [days] if isinstance(days, date) else days
        added = added.filter(F.col("date").isin([d.strftime("%Y%m%d") for d in wanted]))
    return added.select(
        "service_id",
        F.to_date(F.try_to_timestamp("date", F.lit("yyyyMMdd"))).alias("service_date"),
    ).distinct()


def service_day_trips(
    stop_times: DataFrame, trips: DataFrame, services: DataFrame
) -> DataFrame:
    """Trips that run on each active day, with their number of stops.

    Stops are counted per trip before the joins, so a trip with very many stop rows is one
    row by the time it is shuffled on.
    """
    stops = stop_times.groupBy("trip_id").agg(F.count(F.lit(1)).alias("n_stops"))
    return (
        stops.join(trips.select("trip_id", "service_id"), "trip_id")
        .join(services, "service_id")
        .select("trip_id", "service_id", "service_date", "n_stops")
    )


def days_back(stop_times: DataFrame) -> int:
    """How many days before a departure the service day of its trip may lie: whole days in the greatest time."""
    times = F.array(*[service_time(F.lit("1970-01-01").cast("date"), F.col(c)) for c in ("departure_time", "arrival_time")])
    last = stop_times.agg(F.max(F.array_max(times)).alias("last"))
    return last.select(F.coalesce(F.unix_date(F.to_date("last")), F.lit(0)).alias("n")).first().n


def with_route(trips: DataFrame, routes: DataFrame) -> DataFrame:
    """Add the route's short name; blank for a route that is not listed."""
    names = routes.select("route_id", "route_short_name")
    return trips.join(names, "route_id", "left").withColumn(
        "route_short_name", F.coalesce("route_short_name", F.lit(""))
    )


def _clock_code(text: Column) -> Column:
    """The digits of an HH:MM:SS text as a number, -1 for a blank one, null for any other."""
    return F.when(text.rlike(r"^\d\d:\d\d:\d\d\z"), F.translate(text, ":", "").cast("int")).when(text == "", -1)


def _odd_clock(text: Column) -> Column:
    return F.when(_clock_code(text).isNull(), text)


def _clock_text(code: Column) -> Column:
    """The text that `_clock_code` made a number of."""
    digits = F.lpad(code.cast("string"), 6, "0")
    return F.when(code >= 0, F.regexp_replace(digits, r"^(..)(..)(..)$", "$1:$2:$3")).when(code == -1, "")


def corridor_trips(
    stop_times: DataFrame, stations: DataFrame, corridors: DataFrame
) -> DataFrame:
    """Trips through both stations of a corridor, with direction and GTFS time texts.

    `stop_times` needs an orderable `position`. Stops away from all corridors are dropped by
    the join with the list of corridor ends (inline tables: the optimizer knows their size and
    broadcasts them while they are small); the rest folds in one aggregation per trip and
    corridor. A station visited twice counts with its first visit for the direction and its
    last for the times.
    """
    ends = corridors.select(
        "station_a",
        "station_b",
        F.inline(
            F.array(
                F.struct(F.col("station_a").alias("station_name"), F.lit(True).alias("is_a")),
                F.struct(F.col("station_b").alias("station_name"), F.lit(False).alias("is_a")),
            )
        ),
    ).join(stations.select("station_name", F.col("gtfs_stop_id").alias("stop_id")), "station_name")

    end = {"a": F.col("is_a"), "b": ~F.col("is_a")}
    times = ("departure", "arrival")

    def visits(pick, side):
        return pick(F.when(end[side], F.col("position")))

    rows = stop_times.join(ends.drop("station_name"), "stop_id").withColumns(
        {f"{t}_{kind}": of(F.col(f"{t}_time")) for t in times for kind, of in (("code", _clock_code), ("odd", _odd_clock))}
    )
    # Numbers only, so this step aggregates by hash; times of another form go along as keys.
    per_form = rows.groupBy("trip_id", "station_a", "station_b", *[f"{t}_odd" for t in times]).agg(
        *[visits(pick, side).alias(f"{name}_{side}") for side in end for name, pick in (("first", F.min), ("last", F.max))],
        *[F.max_by(f"{t}_code", F.when(end[side], F.col("position"))).alias(f"{t}_{side}") for t in times for side in end],
    )
    # One row per corridor trip but for odd times. By trip, as the joins with the trips go on.
    folded = (
        per_form.repartition("trip_id")
        .groupBy("trip_id", "station_a", "station_b")
        .agg(
            *[F.min(f"first_{side}").alias(f"first_{side}") for side in end],
            *[
                F.max_by(F.coalesce(f"{t}_odd", _clock_text(F.col(f"{t}_{side}"))), f"last_{side}").alias(f"{t}_{side}")
                for t in times
                for side in end
            ],
        )
        .filter(F.col("first_a").isNotNull() & F.col("first_b").isNotNull())
    )
    forward = F.col("first_a") < F.col("first_b")

    def pick(a, b):
        return F.when(forward, F.col(a)).otherwise(F.col(b))

    return folded.select(
        "trip_id",
        pick("station_a", "station_b").alias("departure_station_name"),
        pick("station_b", "station_a").alias("arrival_station_name"),
        pick("departure_a", "departure_b").alias("departure_time"),
        pick("arrival_b", "arrival_a").alias("arrival_time"),
    )


def build_schedule(
    gtfs: dict[str, DataFrame],
    stations: DataFrame,
    corridors: DataFrame,
    created_at: datetime,
    days: date | Iterable[date] | None = None,
) -> DataFrame:
    """Trip-table rows of one service day, of some, or of every day in the calendar.

    The stop times are folded first, so the joins see one row per corridor trip.
    """
    services = active_services(gtfs["calendar_dates"], days)
    through = corridor_trips(gtfs["stop_times"], stations, corridors)
    listed = gtfs["trips"].select("trip_id", "route_id", "service_id", "trip_headsign")
    rows = with_route(through.join(listed, "trip_id"), gtfs["routes"]).join(services, "service_id")
    rows = rows.withColumns(
        {
            "departure_time_scheduled": service_time(F.col("service_date"), F.col("departure_time")),
            "arrival_time_scheduled": service_time(F.col("service_date"), F.col("arrival_time")),
            "created_at": wall_clock(created_at),
        }
    )
    unset = {
        c: F.lit(None).cast(TRIPS[c].dataType)
        for c in (*REALTIME_COLUMNS, "siri_updated_at", *GTFS_RT_COLUMNS)
    }
    return rows.withColumns(unset).select(*TRIPS.fieldNames())
