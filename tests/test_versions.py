"""Versioned day folders: a reader sees all of a write or nothing of it."""

import threading
from datetime import date, datetime, timedelta
from unittest import mock

import pytest
from helpers import A, B, by, trip, trips
from pyspark.sql import functions as F


from railtempo.operators import filters, updates
from railtempo.sources import trip_table, versions

DAY = date(2024, 1, 15)
DAYS = [DAY + timedelta(days=k) for k in range(4)]
KEYS = ["service_date", "departure_day"]


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "t")
    trip_table.create_versioned(spark, path)
    trip_table.write_days(trips(spark, [trip(f"t{i}", str(d), headsign=str(i)) for d in DAYS for i in range(5)]), path)
    return path


def update(spark, day, minute, headsign="1"):
    rows = [(headsign, day, A, B, datetime(day.year, day.month, day.day, 8, minute))]
    return spark.createDataFrame(rows, "trip_headsign string, departure_date date, departure_station_name string, arrival_station_name string, siri_departure_time_real timestamp_ntz")


def counts(spark, path):
    found = trip_table.read_trip_table(spark, path).groupBy("service_date").count().collect()
    return {r.service_date: r["count"] for r in found}


def test_reader_never_misses_a_day(spark, table):
    """A reader in a loop while every day is updated again and again."""
    seen, errors, stop = [], [], threading.Event()

    def reader():
        while not stop.is_set():
            try:
                seen.append(counts(spark, table))
            except Exception as error:  # noqa: BLE001
                errors.append(error)

    thread = threading.Thread(target=reader)
    thread.start()
    try:
        for minute in range(6):
            both = update(spark, DAYS[0], minute).unionByName(update(spark, DAYS[minute % 4], minute, "2"))
            trip_table.upsert(spark, table, both, updates.SLOT)
    finally:
        stop.set()
        thread.join()
    assert not errors and len(seen) > 3
    assert all(found == dict.fromkeys(DAYS, 5) for found in seen)


def test_a_reader_keeps_what_it_has_found(spark, table):
    old = trip_table.read_trip_table(spark, table)
    trip_table.upsert(spark, table, update(spark, DAY, 7), updates.SLOT)
    assert old.filter("siri_departure_time_real IS NOT NULL").count() == 0
    new = trip_table.read_trip_table(spark, table)
    assert new.filter("siri_departure_time_real IS NOT NULL").count() == 1 and new.count() == 20


def test_failed_writes_leave_the_table(spark, table):
    for name in ("_switch", "_partitions"):
        with mock.patch.object(versions, name, side_effect=OSError("lost")), pytest.raises(OSError):
            trip_table.upsert(spark, table, update(spark, DAY, 7), updates.SLOT)
        assert counts(spark, table) == dict.fromkeys(DAYS, 5)
        assert trip_table.read_trip_table(spark, table).filter("siri_departure_time_real IS NOT NULL").count() == 0
    trip_table.upsert(spark, table, update(spark, DAY, 7), updates.SLOT)
    assert trip_table.read_trip_table(spark, table).filter("siri_departure_time_real IS NOT NULL").count() == 1


def test_second_writer_is_refused(spark, table):
    before = versions.current(spark, table)
    trip_table.upsert(spark, table, update(spark, DAY, 7), updates.SLOT)
    with mock.patch.object(versions, "current", return_value=before), pytest.raises(versions.ConcurrentWrite):
        versions.write(trip_table.read_trip_table(spark, table), table)
    assert counts(spark, table) == dict.fromkeys(DAYS, 5)
    assert trip_table.read_trip_table(spark, table).filter("siri_departure_time_real IS NOT NULL").count() == 1


def test_only_touched_days_are_written(spark, table):
    before = versions.current(spark, table).held
    trip_table.upsert(spark, table, update(spark, DAYS[2], 7), updates.SLOT)
    after = versions.current(spark, table).held
    assert {p for p in after if after[p] != before[p]} == {f"service_date={DAYS[2]}/departure_day={DAYS[2]}"}


def test_append_and_guard(spark, table):
    trip_table.write_days(trips(spark, [trip("more", str(DAY), headsign="9")]), table)
    assert counts(spark, table)[DAY] == 6
    with pytest.raises(trip_table.DayAlreadyLoaded):
        trip_table.load_day(trips(spark, [trip("x", str(DAY))]), table, DAY)
    fresh = DAY - timedelta(days=3)
    trip_table.load_day(trips(spark, [trip("x", str(fresh))]), table, fresh)
    assert counts(spark, table)[fresh] == 1 and trip_table.missing_days(spark, table, [DAY, fresh, date(2020, 1, 1)]) == [date(2020, 1, 1)]


def test_vacuum_keeps_what_versions_hold(spark, table, tmp_path):
    for minute in range(5):
        trip_table.upsert(spark, table, update(spark, DAY, minute), updates.SLOT)
    orphan = tmp_path / "t" / "data" / "version=99-lost" / "service_date=2024-01-15"
    orphan.mkdir(parents=True)
    old = trip_table.read_trip_table(spark, table)
    versions.vacuum(spark, table, keep=1)
    assert not orphan.exists()
    found = by(old, "service_date", "trip_id")
    assert len(found) == 20 and found[DAY, "t1"]["siri_departure_time_real"] == datetime(2024, 1, 15, 8, 4)
    data = tmp_path / "t" / "data"
    assert len(list(data.iterdir())) == 2 and not list(data.glob("version=1-*/service_date=2024-01-15/departure_day=*"))
    assert len(list((tmp_path / "t" / "manifests").glob("*.json"))) == 1
    trip_table.upsert(spark, table, update(spark, DAYS[1], 9), updates.SLOT)
    assert counts(spark, table) == dict.fromkeys(DAYS, 5)


def test_days_select_folders(spark, table):
    day = filters.on_day(trip_table.read_trip_table(spark, table), DAY)
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "departure_day" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert len({r.f for r in day.select(F.input_file_name().alias("f")).collect()}) == 1


def test_null_days_and_empty_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    trip_table.create_versioned(spark, path)
    trip_table.create_versioned(spark, path)
    assert trip_table.read_trip_table(spark, path).count() == 0 and trip_table.missing_days(spark, path, DAYS) == DAYS
    trip_table.upsert(spark, path, update(spark, DAY, 1), updates.SLOT)
    rows = trips(spark, [trip("a", str(DAY))]).withColumn("service_date", F.lit(None).cast("date"))
    trip_table.write_days(rows, path)
    found = trip_table.read_trip_table(spark, path).first()
    assert found.service_date is None and found.departure_day == DAY

