"""Written snapshots: small compressed files that every reader takes."""

import os

import pytest

from railtempo.plans import tables
from railtempo.plans.queries import QUERIES
from railtempo.sources import siri
from railtempo.streaming import jobs

SF = "/root/testdata/sf0.001"


def files(path):
    return sorted(n for n in os.listdir(path) if not n.startswith((".", "_")))


def rows(journeys):
    return sorted(str(r) for r in journeys.drop("feed_seq").collect())


@pytest.mark.parametrize("split", [False, True])
def test_written_files_are_compressed_and_bounded(spark, tmp_path, split):
    journeys = tables.journeys(spark, SF)
    path, n = str(tmp_path / "siri"), journeys.count()
    siri.write_snapshot(journeys, path, per_file=500)
    found = files(path)
    assert all(f.endswith(".xml.gz") for f in found) and len(found) >= n / 500
    assert sum(os.path.getsize(f"{path}/{f}") for f in found) < 200 * n  # plain XML takes 1,200 bytes a journey
    read = siri.read_journeys(spark, path, split=split)
    assert rows(read) == rows(journeys) and read.count() == n
    assert max(read.groupBy("feed_seq.file").count().collect(), key=lambda r: r["count"])["count"] <= 500


def test_rows_keep_their_order_over_files(spark, tmp_path):
    journeys = tables.journeys_of(tables.table(spark, SF, "lineitem").coalesce(1))
    path = str(tmp_path / "siri")
    siri.write_snapshot(journeys, path, per_file=500)
    by_file = siri.read_journeys(spark, path).orderBy("feed_seq.file", "feed_seq.row")
    assert [r.journey_ref for r in by_file.select("journey_ref").collect()] == [r.journey_ref for r in journeys.select("journey_ref").collect()]


def test_stream_reads_written_files(spark, tmp_path):
    path, out = str(tmp_path / "siri"), str(tmp_path / "out")
    siri.write_snapshot(tables.journeys(spark, SF), path, per_file=500)
    stream = siri.stream_journeys(spark, path).select("journey_ref")
    writer = stream.writeStream.format("parquet").option("path", out).outputMode("append")
    jobs.start(writer, str(tmp_path / "progress"), available_now=True).awaitTermination()
    found = [r.journey_ref for r in spark.read.parquet(out).collect()]
    assert sorted(found) == sorted(r.journey_ref for r in tables.journeys(spark, SF).select("journey_ref").collect())
    assert QUERIES["stream_siri_ingest"](spark, SF).count() > 0
