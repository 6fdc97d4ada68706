"""What several text operators share: reading documents, staging, and Arrow helpers for tasks."""

from __future__ import annotations

import atexit
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railtempo.session import work_path

#: Stands for a missing doc_id as a join key, as Spark joins no nulls.
NO_ID = -(2**63)
#: Words are runs of anything but blank, tab, line feed, vertical tab, form feed and carriage return.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_bytes() -> Column:
    """The whole text as UTF-8; a missing text is empty."""
    return F.coalesce(F.col("text"), F.lit("")).cast("binary")


def id_key() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))


def id_bucket(modulus: int) -> Column:
    """crc32 of the doc_id as text, modulo; a missing id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % modulus


def staged(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared work folder and read again, so that later jobs need not make it anew.

    The folder goes when the process that made it ends.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    atexit.register(_forget, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """df checkpointed, in the cluster's folder for that; only a session without one gets a folder of its own."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(work_path(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def _forget(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # noqa: BLE001  the session has ended before
        pass


def slices(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Shorter batches, so that a task holds few texts as Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column in one array, and the n + 1 places where its values begin and end."""
    wide = pa.types.is_large_binary(column.type)
    _, places, data = column.buffers()
    at = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    held = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return held[at[0] : at[-1]], at - at[0]


def whole_groups(batches: Iterable[pa.RecordBatch], key: str, rows: int) -> Iterator[pa.Table]:
    """Tables of at least `rows` rows, but for the last, none of which splits a group; input comes sorted by key."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count < rows:
            continue
        table = pa.Table.from_batches(held)
        keys = table.column(key).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1], "left"))
        if cut:
            yield table.slice(0, cut)
            held = table.slice(cut).to_batches()
            count -= cut
    if count:
        yield pa.Table.from_batches(held)
