"""Daily delay distribution of trips that are updated: equal to a recount after every batch."""

import random
from datetime import date, datetime, timedelta
from unittest import mock

import pytest
from helpers import trip, trips
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railtempo.operators import running_counts, statistics
from railtempo.schema import DELAY_CLASSES, TRIPS
from railtempo.sources import versions
from railtempo.streaming import jobs

DAY = date(2024, 1, 15)
ROWS = T.StructType([*TRIPS.fields, T.StructField("seq", T.LongType())])


def frame(spark, rows):
    """rows: (trip, seq)."""
    return spark.createDataFrame([(*r, seq) for r, seq in rows], ROWS).repartition(3)


def counts(df):
    return {r.date: tuple(r[c] for c in ("total_trains", *DELAY_CLASSES)) for r in df.collect()}


def recount(spark, rows):
    """The batch result over each trip's last row."""
    last = {}
    for row, seq in rows:
        key = row[0], row[-1]
        if key not in last or seq > last[key][1]:
            last[key] = row, seq
    return counts(statistics.daily_counts(trips(spark, [r for r, _ in last.values()])))


def some_trip(rng, seq):
    number, day = rng.randrange(30), DAY + timedelta(days=rng.randrange(3))
    real = rng.choice([None, "08:59:00", "09:03:00", "09:12:00", "09:40:00", "10:30:00"])
    status = rng.choice([None, None, None, "CANCELLED"])
    return trip(f"t{number}", str(day), real_arrival=real, departure_status=status), seq


def test_equal_to_a_recount_after_every_batch(spark, tmp_path):
    rng, path, seen = random.Random(5), str(tmp_path / "daily"), []
    sink = jobs.daily_sink(spark, path)
    order = rng.sample(range(1000), 240)  # late rows among them
    for batch_id in range(6):
        batch = [some_trip(rng, order.pop()) for _ in range(40)]
        seen += batch
        sink(frame(spark, batch), batch_id)
        assert counts(jobs.daily_result(spark, path)) == recount(spark, seen)


def test_an_update_changes_its_day_once(spark, tmp_path):
    path = str(tmp_path / "daily")
    sink = jobs.daily_sink(spark, path)
    sink(frame(spark, [(trip("a", str(DAY)), 1), (trip("b", str(DAY)), 1)]), 0)
    sink(frame(spark, [(trip("a", str(DAY), real_arrival="09:03:00"), 2), (trip("a", str(DAY), real_arrival="09:50:00"), 3)]), 1)
    assert counts(jobs.daily_result(spark, path)) == {DAY: (2, 0, 0, 0, 0, 1, 0, 1)}
    sink(frame(spark, [(trip("a", str(DAY), real_arrival="09:03:00"), 2)]), 2)  # late
    assert counts(jobs.daily_result(spark, path)) == {DAY: (2, 0, 0, 0, 0, 1, 0, 1)}


def test_trip_that_moves_to_another_day(spark, tmp_path):
    path, rows = str(tmp_path / "daily"), []
    sink = jobs.daily_sink(spark, path)
    for seq, (departs, service) in enumerate([("2024-01-15 23:50", DAY), ("2024-01-16 00:10", DAY), (None, DAY), ("2024-01-15 08:00", None)]):
        row = dict(zip(TRIPS.names, trip("late", str(DAY))))
        row["departure_time_scheduled"] = departs and datetime.fromisoformat(departs)
        row["service_date"] = service
        rows.append((tuple(row.values()), seq))
        sink(frame(spark, rows[-1:]), seq)
        if service:
            assert {d: n[0] for d, n in counts(jobs.daily_result(spark, path)).items()} == {departs and date.fromisoformat(departs[:10]): 1}
    # Without a service day a trip is known by its departure date, here that of the same trip.
    assert {d: n[0] for d, n in counts(jobs.daily_result(spark, path)).items()} == {DAY: 1}


@pytest.mark.parametrize("fails_at", [1, 2])
def test_failed_batch_is_run_again(spark, tmp_path, fails_at):
    """Before the counts are switched, or between them and the trips."""
    path = str(tmp_path / "daily")
    sink = jobs.daily_sink(spark, path)
    first = [(trip(f"t{i}", str(DAY)), 1) for i in range(5)]
    second = [(trip(f"t{i}", str(DAY), real_arrival="09:10:00"), 2) for i in range(3)]
    sink(frame(spark, first), 0)
    switch, calls = versions._switch, []

    def lost(*args):
        calls.append(args)
        if len(calls) == fails_at:
            raise OSError("lost")
        switch(*args)

    with mock.patch.object(versions, "_switch", lost), pytest.raises(OSError):
        sink(frame(spark, second), 1)
    for _ in range(2):
        sink(frame(spark, second), 1)
        assert counts(jobs.daily_result(spark, path)) == recount(spark, first + second)


def test_equal_order_does_not_depend_on_arrival(spark):
    rows = [(trip("a", str(DAY), real_arrival=clock), 1) for clock in ("09:03:00", "09:12:00", "10:30:00")]
    found = {running_counts.counted_as(frame(spark, r), "seq").first().counted for r in (rows, rows[::-1], rows[1:] + rows[:1])}
    assert len(found) == 1


def test_batches_cost_what_they_change(spark, tmp_path):
    path = str(tmp_path / "daily")
    sink = jobs.daily_sink(spark, path)
    days = [DAY + timedelta(days=k) for k in range(4)]
    sink(frame(spark, [(trip(f"t{i}", str(d)), 1) for d in days for i in range(3)]), 0)
    before = versions.current(spark, f"{path}/held").held
    sink(frame(spark, [(trip("t1", str(days[2]), real_arrival="09:10:00"), 2)]), 1)
    after = versions.current(spark, f"{path}/held").held
    assert [p for p in after if after[p] != before[p]] == [f"day={days[2]}"]
    held = versions.read(spark, f"{path}/held", running_counts.HELD)
    changed = running_counts.changes(held, running_counts.counted_as(frame(spark, [(trip("t1", str(DAY)), 5)]), "seq"))
    assert running_counts.retractions(changed).count() == 0  # the same class again
    assert held.filter(F.col("seq") == 2).count() == 1


def test_empty_batches(spark, tmp_path):
    path = str(tmp_path / "daily")
    sink = jobs.daily_sink(spark, path)
    sink(frame(spark, []), 0)
    assert jobs.daily_result(spark, path).count() == 0
    sink(frame(spark, [(trip("a", str(DAY)), 1)]), 1)
    sink(frame(spark, []), 2)
    assert counts(jobs.daily_result(spark, path))[DAY][0] == 1
