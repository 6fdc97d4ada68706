"""Clock, date and duration expressions.

Scheduled and real times are wall-clock timestamps of the network (TIMESTAMP_NTZ);
TIMESTAMP columns work as well and are compared as instants.
"""

from __future__ import annotations

from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railtempo.schema import NETWORK_ZONE


#: Whole texts that are read: a date, or a date with hours and minutes, and for an instant an offset.
ISO_LOCAL = r"^\d{4}-\d\d-\d\d([Tt ]\d\d:\d\d(:\d\d(\.\d+)?)?)?$"
ISO_INSTANT = r"^\d{4}-\d\d-\d\d[Tt ]\d\d:\d\d(:\d\d(\.\d+)?)?([Zz]|[+-]\d\d:?(\d\d)?)$"


def wall_clock(moment: datetime, zone: str = NETWORK_ZONE) -> Column:
    """A moment as a wall-clock literal; naive moments are wall-clock time already.

    Written as text, because a datetime literal would be shifted between the time zones of
    the driver and the session.
    """
    if moment.tzinfo is not None:
        moment = moment.astimezone(ZoneInfo(zone)).replace(tzinfo=None)
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def service_time(day: Column, text: Column) -> Column:
    """`HH:MM:SS` of a service day as a timestamp; hours may pass 24 by any number, blank gives NULL."""
    hour, minute, second = (
        F.try_element_at(F.split(F.trim(text), ":"), F.lit(i)).try_cast("int") for i in (1, 2, 3)
    )
    midnight = day.cast("timestamp_ntz")
    return midnight + F.make_dt_interval(F.lit(0), hour, minute, second.cast("decimal(18,6)"))


def iso_time(text: Column, zone: str = NETWORK_ZONE) -> Column:
    """ISO-8601 text as wall-clock time of `zone`, to the second; any other text gives NULL.

    Text without an offset is taken as wall-clock time already. The result does not depend
    on the session zone: text with an offset is an instant whatever the session.
    """
    trimmed = F.trim(text)
    instant = F.unix_seconds(F.upper(trimmed).try_cast("timestamp"))
    local = F.substring(trimmed, 1, 19).try_cast("timestamp_ntz")
    return F.when(trimmed.rlike(ISO_INSTANT), epoch_time(instant, zone)).when(
        trimmed.rlike(ISO_LOCAL), local
    )


def epoch_time(seconds: Column, zone: str = NETWORK_ZONE) -> Column:
    """Epoch seconds as wall-clock time of `zone`."""
    shifted = F.from_utc_timestamp(F.timestamp_seconds(seconds), zone)
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.timestamp_add("SECOND", F.unix_seconds(shifted), epoch)


def elapsed_seconds(df: DataFrame, start: str, end: str) -> Column:
    """Whole seconds from `start` to `end` (columns of `df`), negative if early."""
    wall_clock = any(
        isinstance(df.schema[c].dataType, T.TimestampNTZType) for c in (start, end)
    )
    if wall_clock:
        return F.timestamp_diff("SECOND", F.col(start), F.col(end))
    return F.unix_seconds(F.col(end)) - F.unix_seconds(F.col(start))


def clock_minutes(seconds: Column) -> Column:
    """Hours and minutes of an interval as minutes; whole days and seconds are dropped."""
    return F.call_function("div", seconds, F.lit(60)) % 1440


def minute_of_day(ts: Column) -> Column:
    return F.hour(ts) * 60 + F.minute(ts)


def clock_text(minute: Column) -> Column:
    """Minute of the day as `HH:MM`."""
    return F.concat(
        F.lpad(F.floor(minute / 60).cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad((minute % 60).cast("string"), 2, "0"),
    )


def week_start(day: Column) -> Column:
    """Monday of the day's week, by calendar arithmetic."""
    return F.date_sub(day, F.weekday(day))


def freshness_text(ts: Column) -> Column:
    return F.date_format(ts, "dd/MM/yyyy 'à' HH'h'mm")
