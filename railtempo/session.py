"""Session set-up and the shared working folder."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession

_local_root: str | None = None


def local_session(cpus: int | str = "*", **conf: str) -> SparkSession:
    """Single-JVM session for tests and the benchmark."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # HotSpot does not compile methods above 8000 bytes; beyond that Spark's unfused
        # operators are faster than one long interpreted method.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        "spark.driver.memory": "8g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("railtempo")
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder that all executors share (spark.checkpoint.dir).

    Only a local session may do without that setting; it then gets a temporary folder.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        _local_root = _local_root or tempfile.mkdtemp(prefix="railtempo-")
        root = _local_root
    return f"{root.rstrip('/')}/railtempo/{name}-{uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def delete_path(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    listed = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(where)
    return [entry.getPath().getName() for entry in listed]
