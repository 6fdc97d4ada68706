"""GTFS-RT updates without a day find the run of their trip that is nearest in time."""

import random
from datetime import date, datetime, timedelta

import pytest
from helpers import by, trip, trips
from pyspark.sql import functions as F
from test_realtime import entity, stations

from railtempo import schema
from railtempo.functions.times import wall_clock
from railtempo.operators import gtfs_rt, updates
from railtempo.schema import GTFS_RT_ENTITY, TRIPS
from railtempo.sources import trip_table

DAY = date(2024, 1, 15)
#: 00:00 in Paris on DAY.
MIDNIGHT = 1_705_273_200
STOP_A, STOP_B = (s[1] for s in schema.DEFAULT_STATIONS)


def run(name, service, departs, lasts=50):
    """A run that departs so many minutes after DAY begins."""
    row = dict(zip(TRIPS.names, trip(name, str(service))))
    row["departure_time_scheduled"] = datetime(2024, 1, 15) + timedelta(minutes=departs)
    row["arrival_time_scheduled"] = row["departure_time_scheduled"] + timedelta(minutes=lasts)
    return tuple(row.values())


def at(minute):
    return MIDNIGHT + 60 * minute


def entities(spark, rows, day=None):
    numbered = [(f"e{i}", *r[1:]) for i, r in enumerate(rows)]
    return gtfs_rt.entity_rows(spark.createDataFrame(numbered, GTFS_RT_ENTITY), day).withColumn("seq", F.monotonically_increasing_id())


def days_found(spark, rows, table, **limits):
    found = gtfs_rt.match_runs(entities(spark, rows), table, **limits)
    return [r.service_date for r in sorted(found.collect(), key=lambda r: int(r.entity_id[1:]))]


def nightly(spark):
    """Every evening from 23:50 to 00:40."""
    return trips(spark, [run("n", DAY + timedelta(days=k), 1440 * k + 1430) for k in range(-2, 3)])


def test_update_after_midnight_concerns_the_evening_before(spark, tmp_path):
    """What stops remain at 00:45 on the 16th belong to the run of the 15th; that of the 16th stays as it is."""
    path = str(tmp_path / "t")
    trip_table.write_days(nightly(spark), path)
    table = trip_table.read_trip_table(spark, path)
    rows = entities(spark, [entity("n", [(STOP_B, None, (at(1440 + 45), 300), None)], None, None)])
    assert gtfs_rt.known_trips(rows, table).count() == 1
    one = gtfs_rt.trip_updates(rows, table, stations(spark)).first()
    assert one.departure_date == DAY and one.arrival_time_real == datetime(2024, 1, 16, 0, 45)
    folded = gtfs_rt.fold_trip_updates(rows, table, stations(spark))
    trip_table.upsert(spark, path, gtfs_rt.as_update(folded, wall_clock(datetime(2024, 1, 16, 0, 44))), updates.RUN)
    found = by(trip_table.read_trip_table(spark, path), "service_date")
    assert {d for d, r in found.items() if r["siri_updated_at"]} == {DAY}
    assert found[DAY]["siri_arrival_time_real"] == datetime(2024, 1, 16, 0, 45)


def test_two_runs_may_depart_on_one_date(spark, tmp_path):
    """A run past midnight and that of the next service day: each keeps its own updates."""
    path = str(tmp_path / "t")
    trip_table.write_days(trips(spark, [run("n", DAY, 1440 + 20), run("n", DAY + timedelta(days=1), 1440 + 1200)]), path)
    rows = entities(
        spark,
        [entity("n", [(STOP_A, (at(1440 + 25), 300), None, None)], None, None), entity("n", [(STOP_A, (at(1440 + 1201), 60), None, None)], None, None)],
    )
    folded = gtfs_rt.fold_trip_updates(rows, trip_table.read_trip_table(spark, path), stations(spark))
    trip_table.upsert(spark, path, gtfs_rt.as_update(folded, wall_clock(datetime(2024, 1, 16))), updates.RUN)
    found = by(trip_table.read_trip_table(spark, path), "service_date")
    assert len(found) == 2 and {d: r["departure_gtfs_delay"] for d, r in found.items()} == {DAY: 300, DAY + timedelta(days=1): 60}


def test_nearest_limits_and_ties(spark):
    table = trips(spark, [run("x", DAY, 600, 60), run("x", DAY + timedelta(days=1), 720, 60), run("y", DAY, 600, 2000), run("z", DAY, 0, 0)])
    stop = lambda minute: [(STOP_A, (at(minute), 0), None, None)]
    rows = [entity("x", stop(m), None, None) for m in (630, 690, 691, 689, -120, -121, 780 + 720, 780 + 721)]
    rows += [entity("y", stop(2500), None, None), entity("x", [], "CANCELED", None), entity("none", stop(0), None, None)]
    rows += [entity("x", stop(630), None, "20240101"), entity("z", stop(-60), None, None)]
    next_day = DAY + timedelta(days=1)
    assert days_found(spark, rows, table) == [
        DAY, DAY, next_day, DAY, DAY, None, next_day, None, DAY, None, None, date(2024, 1, 1), DAY,
    ]
    assert days_found(spark, rows[:1] + rows[4:5], table, within_hours=1) == [DAY, None]
    assert [r.service_date for r in entities(spark, rows[:2], DAY).collect()] == [DAY, DAY]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rng = random.Random(seed)
    runs = [(f"t{rng.randrange(6)}", DAY + timedelta(days=rng.randrange(6)), rng.randrange(8000), rng.randrange(300)) for _ in range(40)]
    updates_at = [(f"t{rng.randrange(7)}", rng.randrange(-1000, 9500)) for _ in range(300)]
    rows = [entity(t, [(STOP_A, (at(m), 0), None, None), (STOP_B, None, (at(m + 40), 0), None)], None, None) for t, m in updates_at]
    spans = {}
    for t, d, m, lasts in runs:
        a, b = spans.get((t, d), (m, m + lasts))
        spans[t, d] = min(a, m), max(b, m + lasts)
    expected = []
    for t, m in updates_at:
        near = [(max(a - m, m - b, 0), a, d) for (of, d), (a, b) in spans.items() if of == t]
        near = [n for n in near if n[0] <= 720]
        expected.append(min(near)[2] if near else None)
    assert days_found(spark, rows, trips(spark, [run(*r) for r in runs])) == expected


def test_no_pairs_for_a_hot_trip(spark, monkeypatch):
    """A trip with all updates and many runs: rows stay as many as entities, and lie in several partitions."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        table = trips(spark, [run("n", DAY + timedelta(days=k), 1440 * k + 600) for k in range(300)])
        rows = entities(spark, [entity("n", [(STOP_A, (at(600 + k % 7), 0), None, None)], None, None) for k in range(800)])
        matched = gtfs_rt.match_runs(rows, table)
        assert {r.service_date for r in matched.collect()} == {DAY} and matched.count() == 800
        sizes = [r["count"] for r in matched.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) > 1 and max(sizes) < 700
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_undated_updates_select_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    trip_table.write_days(trips(spark, [run("n", DAY + timedelta(days=k), 1440 * k + 600) for k in range(-10, 10)]), path)
    table = trip_table.read_trip_table(spark, path)
    rows = entities(spark, [entity("n", [(STOP_A, (at(600), 0), None, None)], None, None)])
    near = gtfs_rt.near_feed(table, rows)
    assert near.count() == 4
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "service_date" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert gtfs_rt.known_trips(rows, table).count() == 1
