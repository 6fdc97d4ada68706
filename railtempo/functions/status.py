"""Statuses and platforms of SIRI-ET journeys and calls."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from railtempo.schema import CANCELLED, NORMAL, PREDICTION_INACCURATE, UNMONITORED


def call_status(call: Column) -> Column:
    """A Cancellation element cancels the call whatever its text."""
    return (
        F.when(call["Cancellation"].isNotNull(), F.lit(CANCELLED))
        .when(call["PredictionInaccurate"] == "true", F.lit(PREDICTION_INACCURATE))
        .otherwise(F.lit(NORMAL))
    )


def call_platform(call: Column) -> Column:
    """Departure platform if the element is there, even blank, else the arrival platform."""
    return F.nullif(
        F.coalesce(call["DeparturePlatformName"], call["ArrivalPlatformName"]), F.lit("")
    )


def trip_status() -> Column:
    """Status of a journey row; its first inaccuracy flag in document order decides."""
    in_calls = F.filter(
        F.transform(
            F.concat("recorded_calls", "estimated_calls"), lambda c: c["PredictionInaccurate"]
        ),
        lambda flag: flag.isNotNull(),
    )
    flag = F.coalesce("prediction_inaccurate", F.try_element_at(in_calls, F.lit(1)))
    return (
        F.when(F.col("monitored") == "false", F.lit(UNMONITORED))
        .when(flag == "true", F.lit(PREDICTION_INACCURATE))
        .otherwise(F.lit(NORMAL))
    )
