"""GTFS timetable files (CSV folders or single files, all cells text)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railtempo.schema import GTFS

# Packing of the file order into one BIGINT: 1 KiB blocks, then the row in the task.
_BLOCK = 1024
_ROW_BITS = 31


def read_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One GTFS table with the columns in use; they are matched by header name."""
    wanted = GTFS[table].fieldNames()
    raw = spark.read.option("header", True).option("inferSchema", False).csv(
        f"{folder.rstrip('/')}/{table}.txt"
    )
    return raw.select(
        *[
            (F.col(c) if c in raw.columns else F.lit(None).cast("string")).alias(c)
            for c in wanted
        ],
        file_order().alias("file_order"),
    )


def file_order() -> Column:
    """Row order inside a text file, whatever order its splits are read in."""
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    block = F.expr(f"_metadata.file_block_start div {_BLOCK}")
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        (block * F.lit(1 << _ROW_BITS) + row).alias("row"),
    )


def read_calendar_dates(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "calendar_dates").drop("file_order")


def read_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Trips, one row per id: last service wins, first route and headsign win."""
    rows = read_table(spark, folder, "trips")
    return rows.groupBy("trip_id").agg(
        F.min_by("route_id", "file_order").alias("route_id"),
        F.max_by("service_id", "file_order").alias("service_id"),
        F.min_by("trip_headsign", "file_order").alias("trip_headsign"),
    )


def read_routes(spark: SparkSession, folder: str) -> DataFrame:
    """Routes, one row per id: the last one wins."""
    rows = read_table(spark, folder, "routes")
    return rows.groupBy("route_id").agg(
        F.max_by("route_short_name", "file_order").alias("route_short_name")
    )


def read_stop_times(spark: SparkSession, folder: str) -> DataFrame:
    """Stop times with a `position`: stop_sequence where given, then file order."""
    rows = read_table(spark, folder, "stop_times")
    position = F.struct(F.col("stop_sequence").try_cast("bigint"), F.col("file_order"))
    return rows.select(
        "trip_id", "stop_id", "arrival_time", "departure_time", position.alias("position")
    )


def write_table(df: DataFrame, folder: str, table: str) -> None:
    """Write a GTFS table as CSV with a header."""
    df.select(*GTFS[table].fieldNames()).write.option("header", True).csv(
        f"{folder.rstrip('/')}/{table}.txt"
    )
