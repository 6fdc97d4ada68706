"""Cancellation, delay class and delay statistics as expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railtempo.functions.times import elapsed_seconds
from railtempo.schema import CANCELLED, DELAY_CLASSES, DELAY_LIMITS


def is_cancelled() -> Column:
    """True if either end of the trip is cancelled; a missing status is not cancelled."""
    return F.coalesce(F.col("siri_departure_status") == CANCELLED, F.lit(False)) | F.coalesce(
        F.col("siri_arrival_status") == CANCELLED, F.lit(False)
    )


def delay_class(seconds: Column, cancelled: Column) -> Column:
    """One of DELAY_CLASSES; every trip falls into exactly one."""
    out = F.when(cancelled, F.lit("delay_skipped")).when(seconds.isNull(), F.lit("delay_unknown"))
    for name, limit in DELAY_LIMITS:
        out = out.when(seconds <= limit, F.lit(name))
    return out.otherwise(F.lit("delay_over_45min"))


def with_delay(trips: DataFrame) -> DataFrame:
    """Add arrival `delay_seconds`, `is_cancelled` and `delay_class`."""
    seconds = elapsed_seconds(trips, "arrival_time_scheduled", "siri_arrival_time_real")
    return trips.withColumns({"delay_seconds": seconds, "is_cancelled": is_cancelled()}).withColumn(
        "delay_class", delay_class(F.col("delay_seconds"), F.col("is_cancelled"))
    )


def class_counts() -> list[Column]:
    """Row count and one count per delay class, from `delay_class`."""
    return [F.count(F.lit(1)).alias("total_trains")] + [
        F.count_if(F.col("delay_class") == name).alias(name) for name in DELAY_CLASSES
    ]


def summed_counts() -> list[Column]:
    """The same columns, added up from already aggregated rows."""
    return [F.sum(name).alias(name) for name in ("total_trains", *DELAY_CLASSES)]


def percentages() -> list[Column]:
    """Share of each class in percent, truncated; 0 for an empty group."""
    return [
        F.expr(f"CASE WHEN total_trains > 0 THEN (100 * {name}) div total_trains ELSE 0 END").alias(
            f"{name}_percentage"
        )
        for name in DELAY_CLASSES
    ]


def known_delay() -> Column:
    """Delay of trips that ran and whose arrival is known, for averages."""
    return F.when(~F.col("is_cancelled"), F.col("delay_seconds"))


def average_minutes(total_seconds: Column, known: Column) -> Column:
    """Mean delay in minutes from integer totals; 0 if no delay is known."""
    return F.when(
        known > 0, total_seconds.cast("double") / (known * 60).cast("double")
    ).otherwise(F.lit(0.0))
