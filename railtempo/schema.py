"""Schemas and fixed values shared by all operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Delay classes, in display order, with their upper bound in seconds.
DELAY_LIMITS = (
    ("on_time", 0),
    ("delay_5min", 5 * 60),
    ("delay_15min", 15 * 60),
    ("delay_45min", 45 * 60),
)
DELAY_CLASSES = (
    "on_time",
    "delay_5min",
    "delay_15min",
    "delay_45min",
    "delay_over_45min",
    "delay_skipped",
    "delay_unknown",
)

# Statuses.
CANCELLED = "CANCELLED"
PREDICTION_INACCURATE = "PREDICTION_INACCURATE"
UNMONITORED = "UNMONITORED"
NORMAL = "NORMAL"

# French labels.
WEEKDAY_LABELS = ("Lu", "Ma", "Me", "Je", "Ve", "Sa", "Di")
LABEL_CANCELLED = "Supprimé"
LABEL_ON_TIME = "À l'heure"
LABEL_DEPARTURE = "Départ"
LABEL_ARRIVAL = "Arrivée"

# The network's clock, feed limits, corridor stations and their identifiers.
NETWORK_ZONE = "Europe/Paris"
STALE_AFTER_MINUTES = 15
WEEKLY_ABOVE_DAYS = 30
PRESET_DAYS = {"week": 7, "month": 30}
DEFAULT_STATIONS = (
    ("Paris Nord", "StopPoint:OCETrain TER-87271007", "FR:ScheduledStopPoint::87271007"),
    ("Compiègne", "StopPoint:OCETrain TER-87276691", "FR:ScheduledStopPoint::87276691"),
)
DEFAULT_CORRIDORS = (("Paris Nord", "Compiègne"),)

STATIONS = T.StructType(
    [
        T.StructField("station_name", T.StringType(), False),
        T.StructField("gtfs_stop_id", T.StringType(), False),
        T.StructField("siri_stop_id", T.StringType(), False),
    ]
)
CORRIDORS = T.StructType(
    [
        T.StructField("station_a", T.StringType(), False),
        T.StructField("station_b", T.StringType(), False),
    ]
)

#: Columns that a real-time update may fill, in table order.
REALTIME_COLUMNS = (
    "siri_departure_time_real",
    "siri_departure_platform",
    "siri_departure_status",
    "siri_arrival_time_real",
    "siri_arrival_platform",
    "siri_arrival_status",
    "siri_trip_status",
)

#: Columns that only GTFS-RT fills.
GTFS_RT_COLUMNS = (
    "departure_gtfs_delay",
    "arrival_gtfs_delay",
    "trip_schedule_relationship",
    "departure_schedule_relationship",
    "arrival_schedule_relationship",
)

#: The trip table: one row per trip and service day.
TRIPS = T.StructType(
    [
        T.StructField("trip_id", T.StringType()),
        T.StructField("route_id", T.StringType()),
        T.StructField("route_short_name", T.StringType()),
        T.StructField("trip_headsign", T.StringType()),
        T.StructField("departure_station_name", T.StringType()),
        T.StructField("departure_time_scheduled", T.TimestampNTZType()),
        T.StructField("siri_departure_time_real", T.TimestampNTZType()),
        T.StructField("siri_departure_platform", T.StringType()),
        T.StructField("siri_departure_status", T.StringType()),
        T.StructField("arrival_station_name", T.StringType()),
        T.StructField("arrival_time_scheduled", T.TimestampNTZType()),
        T.StructField("siri_arrival_time_real", T.TimestampNTZType()),
        T.StructField("siri_arrival_platform", T.StringType()),
        T.StructField("siri_arrival_status", T.StringType()),
        T.StructField("siri_trip_status", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("siri_updated_at", T.TimestampNTZType()),
        T.StructField("departure_gtfs_delay", T.LongType()),
        T.StructField("arrival_gtfs_delay", T.LongType()),
        T.StructField("trip_schedule_relationship", T.StringType()),
        T.StructField("departure_schedule_relationship", T.StringType()),
        T.StructField("arrival_schedule_relationship", T.StringType()),
        T.StructField("service_date", T.DateType()),
    ]
)
#: The day a trip departs, which may lie any number of days after its service day; kept by the stored table.
DEPARTURE_DAY = T.StructField("departure_day", T.DateType())


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


#: GTFS columns in use; every cell stays text (ids have leading zeros).
GTFS = {
    "calendar_dates": _text("service_id", "date", "exception_type"),
    "trips": _text("route_id", "service_id", "trip_id", "trip_headsign"),
    "routes": _text("route_id", "route_short_name"),
    "stop_times": _text(
        "trip_id", "arrival_time", "departure_time", "stop_id", "stop_sequence"
    ),
}

#: One call of a journey as the SIRI-ET feed carries it.
SIRI_CALL = _text(
    "StopPointRef",
    "Cancellation",
    "PredictionInaccurate",
    "ExpectedArrivalTime",
    "ArrivalPlatformName",
    "ExpectedDepartureTime",
    "DeparturePlatformName",
)
#: EstimatedVehicleJourney; train number and date may sit at journey level or one level down.
SIRI_JOURNEY = T.StructType(
    [
        T.StructField("RecordedAtTime", T.StringType()),
        T.StructField("DataFrameRef", T.StringType()),
        T.StructField("FramedVehicleJourneyRef", _text("DataFrameRef", "DatedVehicleJourneyRef")),
        T.StructField("TrainNumberRef", T.StringType()),
        T.StructField(
            "TrainNumbers",
            T.StructType([T.StructField("TrainNumberRef", T.ArrayType(T.StringType()))]),
        ),
        T.StructField("Monitored", T.StringType()),
        T.StructField("PredictionInaccurate", T.StringType()),
        T.StructField(
            "RecordedCalls",
            T.StructType([T.StructField("RecordedCall", T.ArrayType(SIRI_CALL))]),
        ),
        T.StructField(
            "EstimatedCalls",
            T.StructType([T.StructField("EstimatedCall", T.ArrayType(SIRI_CALL))]),
        ),
    ]
)

_STOP_EVENT = T.StructType(
    [T.StructField("time", T.LongType()), T.StructField("delay", T.LongType())]
)
#: Decoded GTFS-RT entity.
GTFS_RT_ENTITY = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField(
            "trip_update",
            T.StructType(
                [
                    T.StructField(
                        "trip",
                        _text("trip_id", "route_id", "start_date", "schedule_relationship"),
                    ),
                    T.StructField(
                        "stop_time_update",
                        T.ArrayType(
                            T.StructType(
                                [
                                    T.StructField("stop_id", T.StringType()),
                                    T.StructField("departure", _STOP_EVENT),
                                    T.StructField("arrival", _STOP_EVENT),
                                    T.StructField("schedule_relationship", T.StringType()),
                                ]
                            )
                        ),
                    ),
                ]
            ),
        ),
    ]
)


def parameter_table(
    spark: SparkSession, rows: Sequence[Sequence[str]], schema: T.StructType
) -> DataFrame:
    """A few rows of text as a DataFrame.

    Built as an inline table, whose size the optimizer knows exactly: joins with it become
    broadcast joins while it is small, and shuffled joins should it ever be large.
    """
    names = [[f"r{i}c{j}" for j in range(len(row))] for i, row in enumerate(rows)]
    values = ", ".join(f"({', '.join(':' + n for n in row)})" for row in names)
    return spark.sql(
        f"SELECT * FROM VALUES {values} AS t({', '.join(schema.names)})",
        args={n: v for row, given in zip(names, rows) for n, v in zip(row, given)},
    )


def default_stations(spark: SparkSession) -> DataFrame:
    return parameter_table(spark, DEFAULT_STATIONS, STATIONS)


def default_corridors(spark: SparkSession) -> DataFrame:
    return parameter_table(spark, DEFAULT_CORRIDORS, CORRIDORS)
