"""The running fold in the state store: equal to the batch fold, bounded, and not misled by odd dates."""

from datetime import date, datetime, timedelta

import pytest
from helpers import A, B, by, trip, trips
from pyspark.sql import functions as F
from test_realtime import call, journey, snapshot, stations

from railtempo.operators import realtime
from railtempo.sources import siri, versions
from railtempo.streaming import jobs

DAY = date(2024, 1, 15)


class Feed:
    """Snapshots that arrive one by one, each in a run of its own that goes on from the last one's progress."""

    def __init__(self, spark, tmp_path, late_days=jobs.LATE_DAYS):
        self.spark, self.folder, self.out = spark, tmp_path / "feed", str(tmp_path / "fold")
        self.progress, self.n, self.late_days, self.states = str(tmp_path / "progress"), 0, late_days, []
        self.folder.mkdir()

    def stream(self):
        return jobs.running_fold(siri.stream_journeys(self.spark, str(self.folder), 1), stations(self.spark), self.late_days)

    def poll(self, *journeys):
        self.n += 1
        snapshot(self.folder, f"{self.n:03d}.xml", *journeys)
        folded = self.stream()
        writer = folded.writeStream.foreachBatch(jobs.running_sink(self.spark, self.out)).outputMode("update")
        query = jobs.start(writer, self.progress, available_now=True)
        query.awaitTermination()
        self.states.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])

    def result(self):
        return jobs.running_result(self.spark, self.out, self.stream().schema)

    def batch(self):
        journeys = realtime.valid_journeys(siri.read_journeys(self.spark, str(self.folder)))
        return realtime.fold_log(realtime.feed_log(journeys, stations(self.spark)))


def said(day, minute, train="847", at=A, polled=None, polled_day=None):
    stamp = f"{day}T08:{minute:02d}:00+01:00"
    times = (stamp, None) if at == A else (None, stamp)
    polled = polled or f"{polled_day or day}T07:{minute:02d}:00+01:00"
    return journey(train, day=str(day), polled=polled, estimated=call("Estimated", at, *times))


def rows(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=str)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_equals_the_batch_fold(spark, feed):
    feed.poll(said(DAY, 4), said(DAY, 1, "900", B))
    feed.poll(said(DAY, 9, at=B), said(DAY + timedelta(days=1), 2))
    feed.poll(said(DAY, 6), said(DAY + timedelta(days=1), 3))
    assert rows(feed.result()) == rows(feed.batch())
    table = trips(spark, [trip("go", str(DAY), headsign="847"), trip("next", "2024-01-16", headsign="847")])
    found = by(realtime.orient_fold(feed.result(), table, stations(spark)), "departure_date")
    assert found[DAY]["siri_departure_time_real"] == datetime(2024, 1, 15, 8, 6)
    assert found[DAY]["siri_arrival_time_real"] == datetime(2024, 1, 15, 8, 9) and found[DAY]["n_updates"] == 3


def test_far_date_costs_only_its_own_row(feed):
    for k in range(7):
        feed.poll(said(DAY + timedelta(days=k), 4))
    far = date(2099, 1, 1)
    feed.poll(said(far, 1, polled_day=DAY + timedelta(days=6)), said(DAY + timedelta(days=6), 30))
    feed.poll(said(DAY + timedelta(days=3), 40, polled_day=DAY + timedelta(days=7)))
    feed.poll(said(far, 2, polled_day=DAY + timedelta(days=8)))
    found = by(feed.result(), "departure_date", "station")
    assert {d for d, _ in found} == {far, *(DAY + timedelta(days=k) for k in range(7))}
    assert found[DAY + timedelta(days=3), A]["expected_departure"] == datetime(2024, 1, 18, 8, 40)
    assert found[far, A]["expected_departure"] == datetime(2099, 1, 1, 8, 2) and found[far, ""]["n_updates"] == 2
    assert rows(feed.result()) == rows(feed.batch())


def test_state_falls_and_results_stay(spark, tmp_path):
    feed = Feed(spark, tmp_path, late_days=1)
    for k in range(16):
        feed.poll(said(DAY + timedelta(days=k), 4))
    # Of one train a day, two rows each: the days to the limit, and those that a feed may be ahead.
    assert max(feed.states) <= 2 * (jobs.AHEAD_DAYS + 1 + 2) < 2 * 16 and feed.states[-1] == feed.states[-2]
    assert {r.departure_date for r in feed.result().collect()} == {DAY + timedelta(days=k) for k in range(16)}
    feed.poll(said(DAY, 50, polled_day=DAY + timedelta(days=16)))  # too late
    assert by(feed.result(), "departure_date", "station")[DAY, A]["expected_departure"] == datetime(2024, 1, 15, 8, 4)


def test_only_changed_days_are_written(spark, feed):
    feed.poll(said(DAY, 4), said(DAY + timedelta(days=1), 4))
    before = versions.current(spark, feed.out).held
    feed.poll(said(DAY, 5))
    after = versions.current(spark, feed.out).held
    assert [p for p in after if after[p] != before[p]] == [f"departure_date={DAY}"]


def test_batch_run_again_changes_nothing(spark, feed):
    feed.poll(said(DAY, 4), said(DAY, 1, "900", B))
    sink = jobs.running_sink(spark, feed.out)
    log = realtime.feed_log(
        realtime.valid_journeys(siri.read_journeys(spark, str(feed.folder))).withColumn("falls", F.col("departure_date").cast("timestamp")),
        stations(spark), "falls",
    )
    before = rows(feed.result())
    for _ in range(2):
        sink(realtime.fold_log(log, "falls"), 0)
        assert rows(feed.result()) == before
    sink(realtime.fold_log(log, "falls").limit(0), 1)
    assert rows(feed.result()) == before


def test_journeys_without_a_date_have_no_state(feed):
    feed.poll(said(DAY, 4), journey("847", day="soon"), journey("847", day=None))
    assert feed.result().count() == 2 and feed.states == [2]


def test_batch_sink_keeps_all_days_and_survives_a_far_one(spark, tmp_path):
    out = str(tmp_path / "all")
    days = [DAY + timedelta(days=k) for k in range(9)]
    far = date(2099, 1, 1)
    texts = [[said(d, 4)] for d in days] + [[said(far, 1, polled_day=days[-1])]]
    for keep, kept in ((None, {*days, far}), (2, {days[-1], far})):
        sink = jobs.fold_batches(spark, f"{out}{keep}", stations(spark), siri.number_rows, keep_days=keep)
        for k, journeys in enumerate(texts):
            path = snapshot(tmp_path / f"{keep}-{k}", "1.xml", *journeys)
            sink(siri.read_journeys(spark, path), k)
        found = {r.departure_date for r in jobs.newest_fold(spark, f"{out}{keep}").collect()}
        assert kept <= found and (keep is None or days[0] not in found)
