"""JSON export of reports, one object per row with the column names as keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def write_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)
