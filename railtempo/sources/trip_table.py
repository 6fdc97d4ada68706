"""The trip table: Parquet, partitioned by service_date and departure_day.

One writer at a time. A table made by `create_versioned` keeps versions of its days, so readers never miss one
(`sources.versions`). Any other path is a plain Parquet folder: what replaces days is staged whole beside it and then
swapped in; a swap that fails is done again, from the staged rows, before the next write. All functions take both.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railtempo.operators.updates import apply_updates
from railtempo.schema import DEPARTURE_DAY, TRIPS
from railtempo.session import delete_path, path_exists, work_path
from railtempo.sources import versions

STORED = T.StructType([*TRIPS.fields, DEPARTURE_DAY])


class DayAlreadyLoaded(ValueError):
    """The trip table already has rows for a day that was to be loaded."""


def create_versioned(spark: SparkSession, path: str) -> None:
    """An empty trip table with versions of its days."""
    versions.create(spark, path, ("service_date", DEPARTURE_DAY.name))


def read_trip_table(spark: SparkSession, path: str) -> DataFrame:
    """The columns of TRIPS and departure_day; of a versioned table what it holds at the time of the call."""
    if versions.is_versioned(spark, path):
        return versions.read(spark, path, STORED)
    return spark.read.schema(STORED).parquet(path)


def write_days(trips: DataFrame, path: str, mode: str = "append") -> None:
    """Write whole service days.

    The rebalance hint gives each day few, evenly sized files: small days are merged into
    one file, a day that holds much of the data is split over many tasks.
    """
    rows = trips.select(*TRIPS.fieldNames(), F.to_date("departure_time_scheduled").alias(DEPARTURE_DAY.name))
    if versions.is_versioned(trips.sparkSession, path):
        versions.write(rows, path, append=mode == "append")
        return
    (
        rows.hint("rebalance", "service_date", DEPARTURE_DAY.name)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("service_date", DEPARTURE_DAY.name)
        .parquet(path)
    )


def day_is_loaded(trips: DataFrame, day: date) -> bool:
    return not trips.filter(F.col("service_date") == F.lit(day)).limit(1).isEmpty()


def missing_days(spark: SparkSession, path: str, days: Iterable[date]) -> list[date]:
    """Those of `days` for which the table has no rows; all if there is no table."""
    wanted = sorted(set(days))
    if not path_exists(spark, path):
        return wanted
    held = read_trip_table(spark, path).filter(F.col("service_date").isin(wanted))
    found = {r.service_date for r in held.select("service_date").distinct().collect()}
    return [d for d in wanted if d not in found]


def load_day(schedule: DataFrame, path: str, day: date) -> None:
    """Load one day's schedule; refuses a day that the table already has rows for."""
    spark = schedule.sparkSession
    recover(spark, path)
    if not missing_days(spark, path, [day]):
        raise DayAlreadyLoaded(f"trip table already has rows for {day}")
    replace_days(schedule.filter(F.col("service_date") == F.lit(day)), path)


def new_days(schedule: DataFrame, existing: DataFrame) -> DataFrame:
    """Rows of `schedule` for days that `existing` does not hold yet."""
    loaded = existing.select("service_date").distinct()
    return schedule.join(loaded, "service_date", "left_anti")


def _pending(path: str) -> str:
    return f"{path.rstrip('/')}.pending"


def replace_days(rows: DataFrame, path: str) -> None:
    """Put `rows` in place of the partitions that they lie in."""
    if versions.is_versioned(rows.sparkSession, path):
        write_days(rows, path, mode="overwrite")
        return
    rows.write.mode("overwrite").parquet(_pending(path))
    _swap(rows.sparkSession, path)


def _swap(spark: SparkSession, path: str) -> None:
    write_days(spark.read.schema(TRIPS).parquet(_pending(path)), path, mode="overwrite")
    delete_path(spark, _pending(path))


def recover(spark: SparkSession, path: str) -> None:
    """End a write that failed: rows that were staged whole are swapped in, others dropped."""
    if path_exists(spark, f"{_pending(path)}/_SUCCESS"):
        _swap(spark, path)
    elif path_exists(spark, _pending(path)):
        delete_path(spark, _pending(path))


def upsert(spark: SparkSession, path: str, folded: DataFrame, keys: list[str]) -> None:
    """Apply folded updates to the trip table, rewriting only the departure days they are about.

    A failure while merging leaves the table as it was. A versioned table is switched at once;
    otherwise a failure while swapping is mended by the next write, or by `recover`, from the
    merged rows.
    """
    recover(spark, path)
    folded_path = work_path(spark, "updates")
    folded.write.parquet(folded_path)
    updates = spark.read.schema(folded.schema).parquet(folded_path)
    # One row per calendar day: as literals they select partitions without another join.
    days = [r.departure_date for r in updates.select("departure_date").distinct().collect()]
    if days:
        changed = read_trip_table(spark, path).filter(F.col(DEPARTURE_DAY.name).isin(days))
        replace_days(apply_updates(changed, updates, keys), path)
    delete_path(spark, folded_path)
