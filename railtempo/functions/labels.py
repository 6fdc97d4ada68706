"""Display texts: lines, directions, platforms, weekdays, durations, delays, periods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from railtempo.schema import (
    LABEL_ARRIVAL,
    LABEL_CANCELLED,
    LABEL_DEPARTURE,
    LABEL_ON_TIME,
    WEEKDAY_LABELS,
)


def line_label() -> Column:
    return F.concat("route_short_name", F.lit(" "), "trip_headsign")


def direction_label() -> Column:
    return F.concat("departure_station_name", F.lit(" → "), "arrival_station_name")


def platform_label(platform: Column) -> Column:
    return F.replace(platform, F.lit("Hall "), F.lit("H"))


def numeric_stop_id(stop_id: Column) -> Column:
    """The number that ends a stop id, or blank."""
    return F.coalesce(F.regexp_extract(stop_id, r"(\d+)$", 1), F.lit(""))


# --- weekdays: a set of days is a bit mask, Monday = 1 -----------------------------------


def weekday_bit(day: str) -> Column:
    """Bit of a date column's weekday; `bit_or` over rows gives the set."""
    return F.expr(f"shiftleft(1, weekday({day}))")


def _has_day(mask: Column, i: int) -> Column:
    return mask.bitwiseAND(F.lit(1 << i)) != 0


def weekday_list(mask: Column) -> Column:
    """Day labels, Monday first: `Lu, Ma, Di`."""
    return F.concat_ws(
        ", ", *[F.when(_has_day(mask, i), F.lit(name)) for i, name in enumerate(WEEKDAY_LABELS)]
    )


def weekday_ranges(mask: Column) -> Column:
    """Day labels with runs joined: `Lu - Ve, Di`."""
    runs = []
    for first, start in enumerate(WEEKDAY_LABELS):
        opens = _has_day(mask, first)
        if first > 0:
            opens = opens & ~_has_day(mask, first - 1)
        text = F.lit(start)
        for last in range(first + 1, len(WEEKDAY_LABELS)):
            span = ((1 << (last - first + 1)) - 1) << first
            text = F.when(
                mask.bitwiseAND(F.lit(span)) == span, F.lit(f"{start} - {WEEKDAY_LABELS[last]}")
            ).otherwise(text)
        runs.append(F.when(opens, text))
    return F.concat_ws(", ", *runs)


# --- durations and delays -----------------------------------------------------------------


def minutes_text(minutes: Column) -> Column:
    """`n min` below an hour, else `hHmm`."""
    return F.when(minutes < 60, F.concat(minutes.cast("string"), F.lit(" min"))).otherwise(
        F.concat(
            F.floor(minutes / 60).cast("string"),
            F.lit("h"),
            F.lpad((minutes % 60).cast("string"), 2, "0"),
        )
    )


def _end_text(label: str, seconds: Column) -> Column:
    minutes = F.floor(seconds / 60)
    return F.when(seconds > 0, F.concat(F.lit(f"{label}: "), minutes_text(minutes))).when(
        seconds <= 0, F.lit(f"{label}: {LABEL_ON_TIME}")
    )


def delay_text(departure: Column, arrival: Column, cancelled: Column) -> Column:
    """Delay of a trip in words, from the delay seconds at both ends."""
    same = (
        F.when(departure <= 0, F.lit(LABEL_ON_TIME)).otherwise(
            minutes_text(F.floor(departure / 60))
        )
    )
    return (
        F.when(cancelled, F.lit(LABEL_CANCELLED))
        .when(departure.isNull() & arrival.isNull(), F.lit(""))
        .when(departure == arrival, same)
        .otherwise(
            F.concat_ws(
                ", ", _end_text(LABEL_DEPARTURE, departure), _end_text(LABEL_ARRIVAL, arrival)
            )
        )
    )


def time_state(real: Column, delay_seconds: Column, cancelled: Column) -> Column:
    return (
        F.when(cancelled, F.lit("cancelled"))
        .when(real.isNull(), F.lit("unknown"))
        .when(delay_seconds > 0, F.lit("late"))
        .otherwise(F.lit("on_time"))
    )


# --- periods ------------------------------------------------------------------------------


def day_label(day: Column) -> Column:
    return F.date_format(day, "dd/MM")


def week_label(monday: Column) -> Column:
    """`d-d/mm`, or `d/mm-d/mm` when the week spans two months."""
    sunday = F.date_add(monday, 6)
    return F.concat(
        F.when(F.month(monday) == F.month(sunday), F.date_format(monday, "d")).otherwise(
            F.date_format(monday, "d/MM")
        ),
        F.lit("-"),
        F.date_format(sunday, "d/MM"),
    )
