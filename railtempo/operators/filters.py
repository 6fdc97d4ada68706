"""Row filters on the trip table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railtempo.functions.delay import is_cancelled
from railtempo.schema import DEPARTURE_DAY, PRESET_DAYS


def departure_date() -> Column:
    return F.to_date("departure_time_scheduled")


def has_departure_day(trips: DataFrame) -> bool:
    """Whether trips come from the stored table, which is partitioned by the departure date."""
    return DEPARTURE_DAY.name in trips.columns


def date_filter(
    trips: DataFrame, start: date | Column | None = None, end: date | Column | None = None
) -> DataFrame:
    """Trips that depart from `start` to `end`, both inclusive and both optional.

    On the stored table the same bounds select partitions: a trip's partition is its departure date.
    """
    days = [departure_date()]
    if has_departure_day(trips):
        days.append(F.col(DEPARTURE_DAY.name))
    out = trips
    for day in days:
        if start is not None:
            out = out.filter(day >= (start if isinstance(start, Column) else F.lit(start)))
        if end is not None:
            out = out.filter(day <= (end if isinstance(end, Column) else F.lit(end)))
    return out


def on_day(trips: DataFrame, day: date) -> DataFrame:
    return date_filter(trips, day, day)


def date_range(trips: DataFrame) -> DataFrame:
    """First and last departure date; nulls for an empty table. The stored table's partitions tell them."""
    day = F.col(DEPARTURE_DAY.name) if has_departure_day(trips) else departure_date()
    return trips.agg(F.min(day).alias("min_date"), F.max(day).alias("max_date"))


def preset_filter(trips: DataFrame, preset: str, as_of: date) -> DataFrame:
    """`week`, `month` or `all` up to `as_of`, clamped to the available dates."""
    available = date_range(trips)
    first = available.select("min_date").scalar()
    last = available.select("max_date").scalar()

    def clamp(day: Column) -> Column:
        return F.least(F.greatest(day, first), last)

    until = F.lit(as_of)
    since = first if preset == "all" else clamp(F.date_sub(until, PRESET_DAYS[preset]))
    return date_filter(trips, since, clamp(until))


def cancelled_trips(trips: DataFrame) -> DataFrame:
    return trips.filter(is_cancelled())
