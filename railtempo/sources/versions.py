"""Day tables whose readers never miss a day: versioned day folders and one pointer that is switched last.

A table is a folder with `data`, where every write makes a version of its own, partitioned by
day, and `manifests`, numbered files of which the last one says which folders hold each
partition now. A write first makes its files, then a manifest under another name, and at last
renames that: readers see all of a write or nothing of it, and a write that fails leaves the
table as it was. Nothing is changed in place, so a reader that has begun goes on reading what
it has found until `vacuum` removes it.

One writer at a time; a second one that got between fails when it switches the pointer.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Manifests whose files `vacuum` leaves in place, for readers that began with them.
KEPT_MANIFESTS = 10


class ConcurrentWrite(RuntimeError):
    """Another writer has switched the pointer since this one read it."""


@dataclass(frozen=True)
class Manifest:
    """Per partition (its folder path, `column=value/...`) the versions that hold it, oldest first.

    `tag` is a number that the last write left, such as that of its micro-batch.
    """

    number: int
    columns: tuple[str, ...]
    held: dict[str, list[str]]
    tag: int = -1

    def folders(self, path: str) -> list[str]:
        return [f"{_data(path)}/version={v}/{p}" for p, versions in sorted(self.held.items()) for v in versions]


def _data(path: str) -> str:
    return f"{path.rstrip('/')}/data"


class _Files:
    """The file system that a path lies in."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self.path = jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.streams = jvm.org.apache.hadoop.io.IOUtils
        self.buffer = jvm.java.io.ByteArrayOutputStream

    def names(self, path: str) -> list[str]:
        where = self.path(path)
        if not self.fs.exists(where):
            return []
        return sorted(entry.getPath().getName() for entry in self.fs.listStatus(where))

    def read(self, path: str) -> bytes:
        source, held = self.fs.open(self.path(path)), self.buffer()
        try:
            self.streams.copyBytes(source, held, 65536, False)
        finally:
            source.close()
        return bytes(held.toByteArray())

    def write(self, path: str, content: bytes) -> None:
        out = self.fs.create(self.path(path), True)
        try:
            out.write(content)
        finally:
            out.close()

    def rename(self, old: str, new: str) -> bool:
        return not self.fs.exists(self.path(new)) and self.fs.rename(self.path(old), self.path(new))

    def delete(self, path: str) -> None:
        self.fs.delete(self.path(path), True)


def _numbers(files: _Files, path: str) -> list[int]:
    names = files.names(f"{path.rstrip('/')}/manifests")
    return [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_"))]


def _manifest(files: _Files, path: str, number: int) -> Manifest:
    held = json.loads(files.read(f"{path.rstrip('/')}/manifests/{number:010d}.json"))
    return Manifest(number, tuple(held["columns"]), held["held"], held["tag"])


def is_versioned(spark: SparkSession, path: str) -> bool:
    return bool(_numbers(_Files(spark, path), path))


def current(spark: SparkSession, path: str) -> Manifest:
    files = _Files(spark, path)
    return _manifest(files, path, _numbers(files, path)[-1])


def create(spark: SparkSession, path: str, columns: tuple[str, ...]) -> None:
    """An empty table partitioned by `columns`; one that is there stays."""
    if not is_versioned(spark, path):
        _switch(spark, path, Manifest(0, columns, {}))


def _switch(spark: SparkSession, path: str, manifest: Manifest) -> None:
    files, folder = _Files(spark, path), f"{path.rstrip('/')}/manifests"
    draft = f"{folder}/_{uuid4().hex}"
    content = {"columns": manifest.columns, "held": manifest.held, "tag": manifest.tag}
    files.write(draft, json.dumps(content).encode())
    if not files.rename(draft, f"{folder}/{manifest.number:010d}.json"):
        files.delete(draft)
        raise ConcurrentWrite(f"{path}: version {manifest.number} is there already")


def read(spark: SparkSession, path: str, schema: T.StructType, manifest: Manifest | None = None) -> DataFrame:
    """The rows of the current version, or of the given one; filters on the partition columns select folders."""
    manifest = manifest or current(spark, path)
    folders = manifest.folders(path)
    if not folders:
        return spark.createDataFrame([], schema)
    found = spark.read.schema(schema).option("basePath", _data(path)).parquet(*folders)
    return found.select(*schema.fieldNames())


def write(rows: DataFrame, path: str, append: bool = False, tag: int | None = None) -> Manifest:
    """Put rows in place of the partitions that they lie in, or beside what these hold; a table without any is replaced.

    The rebalance hint gives each day few, evenly sized files; a day that holds much of the
    data is split over many tasks.
    """
    spark = rows.sparkSession
    before = current(spark, path)
    version = f"{before.number + 1}-{uuid4().hex[:8]}"
    folder = f"{_data(path)}/version={version}"
    rows.hint("rebalance", *before.columns).write.partitionBy(*before.columns).parquet(folder)
    held = dict(before.held)
    for partition in _partitions(_Files(spark, path), folder, len(before.columns)):
        held[partition] = [*(held.get(partition, []) if append else []), version]
    after = Manifest(before.number + 1, before.columns, held, before.tag if tag is None else tag)
    _switch(spark, path, after)
    return after


def _partitions(files: _Files, folder: str, depth: int) -> list[str]:
    found = [""]
    for _ in range(depth):
        found = [f"{f}/{n}".lstrip("/") for f in found for n in files.names(f"{folder}/{f}") if "=" in n]
    return found


def vacuum(spark: SparkSession, path: str, keep: int = KEPT_MANIFESTS) -> None:
    """Remove files that none of the last `keep` versions of the table holds, and manifests before them.

    Files of a write that failed go as well, so no write may be under way.
    """
    files = _Files(spark, path)
    numbers = _numbers(files, path)
    last = [_manifest(files, path, n) for n in numbers[-keep:]]
    used = {(v, p) for m in last for p, versions in m.held.items() for v in versions}
    for n in numbers[:-keep]:
        files.delete(f"{path.rstrip('/')}/manifests/{n:010d}.json")
    versions = {v for v, _ in used}
    for name in files.names(_data(path)):
        version = name.removeprefix("version=")
        if version not in versions:
            files.delete(f"{_data(path)}/{name}")
            continue
        for partition in _partitions(files, f"{_data(path)}/{name}", len(last[-1].columns)):
            if (version, partition) not in used:
                files.delete(f"{_data(path)}/{name}/{partition}")
