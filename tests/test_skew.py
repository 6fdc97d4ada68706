"""Results stay whole when one key holds a third of the rows, under a plan that shuffles."""

import random
from datetime import date, timedelta

import pytest
from helpers import A, B, trip, trips

from railtempo import schema
from railtempo.operators import realtime, schedule, statistics, updates
from railtempo.plans import tables
from railtempo.sources import reports

LINE_ITEM = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_returnflag string, l_linestatus string"
)


@pytest.fixture()
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def skewed_lines(spark, n=6000):
    rng = random.Random(11)
    rows = []
    for i in range(n):
        order = 4242 if rng.random() < 0.34 else rng.randrange(3000)
        rows.append((order, i + 1, rng.randrange(1000), 1 + rng.randrange(7), float(1 + rng.randrange(50)),
                     rng.choice("RAN"), rng.choice("OF")))
    return spark.createDataFrame(rows, LINE_ITEM).repartition(6)


def many_trips(spark):
    """One train number holds a third of all trips; orders 4242 belong to it."""
    rng = random.Random(12)
    rows = []
    for i in range(3000):
        number = 42 if rng.random() < 0.34 else rng.randrange(30)
        start, end = (A, B) if number % 2 == 0 else (B, A)
        day = str(date(2024, 1, 1) + timedelta(days=rng.randrange(30)))
        rows.append(trip(f"t{i}", day, headsign=str(number), start=start, end=end, real_arrival="09:10:00"))
    return trips(spark, rows).repartition(6)


def test_folding_first_equals_folding_the_update_log(spark, no_broadcast):
    stations, table = tables.stations(spark), many_trips(spark)
    journeys = realtime.valid_journeys(tables.journeys_of(skewed_lines(spark)))
    first = realtime.fold_feed(journeys, table, stations)
    log = realtime.build_updates(journeys, table, stations)
    after = updates.fold_updates(log, updates.SLOT)
    columns = sorted(first.columns)
    found = {tuple(r) for r in first.select(columns).collect()}
    assert found == {tuple(r) for r in after.select(columns).collect()} and len(found) > 100
    counted = realtime.feed_counters(tables.journeys_of(skewed_lines(spark)), table, stations).first()
    assert counted.updates == log.groupBy().sum("n_trips").first()[0]
    assert counted.journeys_matched == realtime.journey_match(journeys, table).count()
    upserted = updates.apply_updates(table, first, updates.SLOT)
    assert upserted.count() == table.count()


def test_hot_trip_in_stop_times(spark, no_broadcast):
    lines = skewed_lines(spark)
    stops = lines.selectExpr(
        "cast(l_orderkey as string) as trip_id", "concat('stop_', l_suppkey % 10) as stop_id",
        "l_partkey as position", "concat('a', l_partkey) as arrival_time", "concat('d', l_partkey) as departure_time",
    )
    found = {
        r.trip_id: tuple(r)
        for r in schedule.corridor_trips(stops, tables.stations(spark), tables.corridors(spark)).collect()
    }
    visits = {}
    for r in stops.collect():
        visits.setdefault(r.trip_id, []).append((r.position, r.stop_id))
    expected = {}
    for trip_id, seen in visits.items():
        seen.sort()
        at = {s: [p for p, q in seen if q == s] for s in ("stop_1", "stop_2")}
        if at["stop_1"] and at["stop_2"]:
            forward = at["stop_1"][0] < at["stop_2"][0]
            i, j = ("stop_1", "stop_2") if forward else ("stop_2", "stop_1")
            expected[trip_id] = (trip_id, *((A, B) if forward else (B, A)), f"d{at[i][-1]}", f"a{at[j][-1]}")
    assert found == expected and "4242" in found


def test_hot_line_in_reports(spark, no_broadcast, tmp_path):
    table = many_trips(spark)
    report = statistics.line_report(statistics.timetable_profile(table))
    rows = {r.trip_headsign: r for r in report.collect()}
    assert rows["42"].total_trains == table.filter("trip_headsign = '42'").count() > 900
    assert sum(r.total_trains for r in rows.values()) == 3000
    for r in rows.values():
        assert sum(r[c] for c in schema.DELAY_CLASSES) == r.total_trains
    path = str(tmp_path / "report")
    reports.write_report(report, path)
    copy = reports.read_report(spark, path, report.schema)
    assert {tuple(r) for r in copy.collect()} == {tuple(r) for r in report.collect()}


def test_hot_service(spark, no_broadcast):
    trip_rows = [(f"r{i % 3}", "hot" if i % 3 == 0 else f"s{i}", f"t{i}", "h") for i in range(300)]
    gtfs_trips = spark.createDataFrame(trip_rows, schema.GTFS["trips"])
    calendar = [("hot", f"202401{d:02d}", "1") for d in range(1, 11)] + [(f"s{i}", "20240101", "1") for i in range(300)]
    services = schedule.active_services(spark.createDataFrame(calendar, schema.GTFS["calendar_dates"]))
    stops = spark.createDataFrame([(f"t{i}", k) for i in range(300) for k in range(2)], "trip_id string, position int")
    found = schedule.service_day_trips(stops, gtfs_trips, services)
    assert found.count() == 100 * 10 + 200
    assert {r.n_stops for r in found.select("n_stops").distinct().collect()} == {2}
