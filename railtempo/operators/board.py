"""The board of a day's trips, its texts, and feed freshness."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railtempo.functions.delay import delay_class, is_cancelled
from railtempo.functions.labels import (
    delay_text,
    direction_label,
    minutes_text,
    platform_label,
    time_state,
)
from railtempo.functions.times import clock_minutes, elapsed_seconds, freshness_text, wall_clock
from railtempo.operators.filters import on_day
from railtempo.schema import STALE_AFTER_MINUTES


def with_times(trips: DataFrame) -> DataFrame:
    """Add delays at both ends (seconds) and scheduled and real durations (minutes)."""
    return trips.withColumns(
        {
            "departure_delay_seconds": elapsed_seconds(
                trips, "departure_time_scheduled", "siri_departure_time_real"
            ),
            "arrival_delay_seconds": elapsed_seconds(
                trips, "arrival_time_scheduled", "siri_arrival_time_real"
            ),
            "duration_scheduled_minutes": clock_minutes(
                elapsed_seconds(trips, "departure_time_scheduled", "arrival_time_scheduled")
            ),
            "duration_real_minutes": clock_minutes(
                elapsed_seconds(trips, "siri_departure_time_real", "siri_arrival_time_real")
            ),
            "is_skipped": is_cancelled(),
        }
    )


def in_minutes(seconds: str) -> Column:
    return F.col(seconds) / 60


def live_board(trips: DataFrame, day: date) -> DataFrame:
    """All trips of a day for display, by direction and departure."""

    def clock(column: str) -> Column:
        return F.date_format(column, "HH:mm:ss")

    shown = with_times(on_day(trips, day)).select(
        F.col("route_short_name").alias("line"),
        "trip_id",
        "trip_headsign",
        direction_label().alias("direction"),
        clock("departure_time_scheduled").alias("departure_time_scheduled"),
        clock("siri_departure_time_real").alias("departure_time_real"),
        platform_label(F.col("siri_departure_platform")).alias("departure_platform"),
        clock("arrival_time_scheduled").alias("arrival_time_scheduled"),
        clock("siri_arrival_time_real").alias("arrival_time_real"),
        platform_label(F.col("siri_arrival_platform")).alias("arrival_platform"),
        "duration_scheduled_minutes",
        "duration_real_minutes",
        in_minutes("departure_delay_seconds").alias("departure_delay_minutes"),
        in_minutes("arrival_delay_seconds").alias("arrival_delay_minutes"),
        F.col("siri_updated_at").alias("updated_at"),
        "is_skipped",
    )
    return shown.orderBy("direction", "departure_time_scheduled", "trip_id")


def trip_labels(trips: DataFrame) -> DataFrame:
    """Texts shown for each trip: durations, delay, and the time at both ends."""
    timed = with_times(trips)
    skipped = F.col("is_skipped")
    real, planned = F.col("duration_real_minutes"), F.col("duration_scheduled_minutes")

    def end(name: str) -> list[Column]:
        actual, seconds = F.col(f"siri_{name}_time_real"), F.col(f"{name}_delay_seconds")
        state = time_state(actual, seconds, skipped)
        return [
            F.date_format(
                F.when(state == "late", actual).otherwise(F.col(f"{name}_time_scheduled")), "HH:mm"
            ).alias(f"{name}_display_time"),
            state.alias(f"{name}_display_state"),
            delay_class(seconds, skipped).alias(f"{name}_delay_class"),
        ]

    return timed.select(
        "trip_id",
        minutes_text(planned).alias("duration_scheduled_text"),
        F.when(real != 0, minutes_text(real)).alias("duration_real_text"),
        F.coalesce((real != 0) & (real > planned), F.lit(False)).alias("duration_exceeded"),
        delay_text(
            F.col("departure_delay_seconds"), F.col("arrival_delay_seconds"), skipped
        ).alias("delay_text"),
        *end("departure"),
        *end("arrival"),
    )


def past_trips(trips: DataFrame, all_trips: DataFrame) -> DataFrame:
    """Flag trips that the latest feed run no longer updates."""
    latest = all_trips.select(F.max("siri_updated_at")).scalar()
    return trips.withColumn(
        "is_past", F.coalesce(F.col("siri_updated_at") < latest, F.lit(False))
    )


def feed_freshness(trips: DataFrame, now: datetime) -> DataFrame:
    """Latest update, its text, and whether it is older than 15 minutes; one row."""
    moment = wall_clock(now)
    limit = moment - F.make_dt_interval(mins=F.lit(STALE_AFTER_MINUTES))
    return trips.agg(F.max("siri_updated_at").alias("updated_at")).select(
        "updated_at",
        freshness_text(F.col("updated_at")).alias("formatted_timestamp"),
        (F.col("updated_at") < limit).alias("is_outdated"),
    )
