"""Snapshot files read in several splits give what one task reads."""

import random

import pytest
from helpers import A, B, trip, trips
from test_realtime import call, journey, snapshot, stations

from railtempo.operators import realtime
from railtempo.sources import siri
from railtempo.streaming import jobs


@pytest.fixture()
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "1777", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def feed(folder, n=400):
    """One poll, so that the order within the file decides; end tags, start tags and blanks of several forms."""
    rng = random.Random(8)
    journeys = []
    for i in range(n):
        stops = [call("Estimated", at, f"2024-07-03T08:{rng.randrange(60):02d}:00+02:00") for at in rng.sample([A, B], 2)]
        text = journey(str(800 + rng.randrange(12)), day="2024-07-03", estimated="".join(stops))
        text += rng.choice(["", "\n", "\r\n  ", "<!-- é -->"])
        if i % 7 == 0:
            text = text.replace("</EstimatedVehicleJourney>", "</EstimatedVehicleJourney >")
        if i % 11 == 0:
            text = text.replace("<EstimatedVehicleJourney>", '<EstimatedVehicleJourney\n id="é/1">')
        journeys.append(text)
    return snapshot(folder, "all.xml", *journeys)


def without_place(journeys):
    return sorted(str(r) for r in journeys.drop("feed_seq").collect())


def test_splits_give_the_same_rows_and_fold(spark, tmp_path, small_splits):
    path = feed(tmp_path / "feed")
    whole, split = siri.read_journeys(spark, path), siri.read_journeys(spark, path, split=True)
    assert whole.rdd.getNumPartitions() == 1 and split.rdd.getNumPartitions() > 20
    assert without_place(split) == without_place(whole) and split.count() == 400
    in_order = [r.estimated_calls for r in whole.orderBy("feed_seq").collect()]
    assert [r.estimated_calls for r in split.orderBy("feed_seq").collect()] == in_order
    folds = [realtime.fold_log(realtime.feed_log(realtime.valid_journeys(j), stations(spark))) for j in (whole, split)]
    found = [sorted(str(r) for r in fold.collect()) for fold in folds]
    assert found[0] == found[1] and len(found[0]) > 20


def test_one_long_journey_over_many_splits(spark, tmp_path, small_splits):
    stops = "".join(call("Estimated", f"elsewhere{i}", "2024-07-03T08:04:00+02:00") for i in range(300))
    path = snapshot(tmp_path / "feed", "1.xml", journey("1", estimated=stops), journey("2"))
    rows = siri.read_journeys(spark, path, split=True).orderBy("feed_seq").collect()
    assert [(r.train_number, len(r.estimated_calls)) for r in rows] == [("1", 300), ("2", 0)]


def test_files_without_journeys(spark, tmp_path):
    path = snapshot(tmp_path / "feed", "1.xml", "<EstimatedVehicleJourney/>", journey("3"))
    snapshot(tmp_path / "feed", "2.xml")
    (tmp_path / "feed" / "3.xml").write_text("")
    assert [r.train_number for r in siri.read_journeys(spark, path, split=True).collect()] == ["3"]


def test_stream_of_split_files(spark, tmp_path, small_splits):
    path, out = feed(tmp_path / "feed", 120), str(tmp_path / "fold")
    sink = jobs.fold_batches(spark, out, stations(spark), siri.number_rows)
    stream = siri.stream_journeys(spark, path, split=True)
    jobs.start(stream.writeStream.foreachBatch(sink), str(tmp_path / "progress"), available_now=True).awaitTermination()
    whole = realtime.fold_log(realtime.feed_log(realtime.valid_journeys(siri.read_journeys(spark, path)), stations(spark)))
    found = jobs.newest_fold(spark, out).select(whole.columns)
    assert sorted(str(r) for r in found.collect()) == sorted(str(r) for r in whole.collect())
    table = trips(spark, [trip("t", "2024-07-03", headsign="801", start=A, end=B)])
    assert realtime.orient_fold(found, table, stations(spark)).count() == 1
