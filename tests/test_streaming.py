import os
from datetime import date, datetime, timedelta

import pytest
from helpers import by, trip, trips
from pyspark.sql import functions as F
from test_realtime import A, B, call, journey, schedule, snapshot, stations

from railtempo.operators import realtime, statistics, updates
from railtempo.schema import TRIPS
from railtempo.sources import siri, trip_table
from railtempo.streaming import jobs

ON = date(2024, 7, 1)


def run(writer, checkpoint):
    jobs.start(writer, str(checkpoint), available_now=True).awaitTermination()


def polls(folder):
    """Three snapshots; the second one repeats the first."""
    first = journey("847", estimated=call("Estimated", A, "2024-07-01T08:04:00+02:00"))
    snapshot(folder, "1.xml", first, journey("900", estimated=call("Estimated", B, "2024-07-01T18:01:00+02:00")))
    snapshot(folder, "2.xml", first)
    snapshot(
        folder,
        "3.xml",
        journey("847", estimated=call("Estimated", B, None, "2024-07-01T09:30:00+02:00"), polled="2024-07-01T08:04:00+02:00"),
        journey("847", recorded=call("Recorded", A, "2024-07-01T08:06:00+02:00"), polled="2024-07-01T08:04:00+02:00"),
    )
    for i in (1, 2, 3):
        os.utime(folder / f"{i}.xml", (1_700_000_000 + i, 1_700_000_000 + i))
    return str(folder)


def test_running_fold_equals_batch(spark, tmp_path):
    path = polls(tmp_path / "feed")
    out = str(tmp_path / "fold")
    stream = siri.stream_journeys(spark, path, max_files=1)
    sink = jobs.fold_batches(spark, out, stations(spark), siri.number_rows)
    run(stream.writeStream.foreachBatch(sink), tmp_path / "progress")
    assert sorted(p.name for p in (tmp_path / "fold").iterdir()) == ["batch=1", "batch=2"]
    sink(siri.read_journeys(spark, f"{path}/3.xml"), 2)
    newest = jobs.newest_fold(spark, out)
    streamed = realtime.orient_fold(newest, schedule(spark), stations(spark))
    journeys = realtime.valid_journeys(siri.read_journeys(spark, path))
    batch = realtime.fold_feed(journeys, schedule(spark), stations(spark))
    assert {tuple(r) for r in streamed.collect()} == {tuple(r) for r in batch.collect()}


def test_feed_into_empty_table(spark, tmp_path):
    """The day's schedule is loaded by the first batch; later batches only update it."""
    table = str(tmp_path / "trips")
    loads = []

    def schedule_of_days(days):
        loads.append(days)
        return schedule(spark).filter(F.col("service_date").isin(days))

    jobs.create_table(spark, table)
    job = jobs.realtime_job(spark, polls(tmp_path / "feed"), table, schedule_of_days, stations(spark), max_files=1)
    run(job, tmp_path / "progress")
    assert loads == [[ON - timedelta(days=1), ON]]
    found = by(trip_table.read_trip_table(spark, table), "trip_id")
    assert set(found) == {"go", "go_twin", "back", "elsewhere"}
    assert found["go"]["siri_departure_time_real"] == datetime(2024, 7, 1, 8, 6)
    assert found["go"]["siri_arrival_time_real"] == datetime(2024, 7, 1, 9, 30)
    assert found["back"]["siri_departure_time_real"] == datetime(2024, 7, 1, 18, 1)


def test_rerun_batch_changes_nothing(spark, tmp_path):
    table = str(tmp_path / "trips")
    jobs.create_table(spark, table)
    sink = jobs.upsert_batches(spark, table, lambda days: schedule(spark), stations(spark))
    batch = siri.read_journeys(spark, polls(tmp_path / "feed"))
    results = []
    for _ in range(2):
        sink(batch, 0)
        results.append(sorted(map(str, trip_table.read_trip_table(spark, table).collect())))
    assert results[0] == results[1] and len(results[0]) == 4


def test_upsert_leaves_other_days_alone(spark, tmp_path):
    table = str(tmp_path / "trips")
    rows = [trip(f"t{i}", str(ON + timedelta(days=i)), headsign="847") for i in range(5)]
    overnight = dict(zip(TRIPS.names, trip("late", "2024-07-02", headsign="847")))
    overnight["departure_time_scheduled"] = datetime(2024, 7, 3, 0, 30)
    trip_table.write_days(trips(spark, [*rows, tuple(overnight.values())]), table)

    def files():
        listed = spark.read.parquet(table).select("service_date", F.input_file_name().alias("f")).distinct()
        return {(str(r.service_date), r.f) for r in listed.collect()}

    before = files()
    path = snapshot(tmp_path / "feed", "1.xml", journey("847", day="2024-07-03", estimated=call("Estimated", A, "2024-07-03T08:04:00+02:00")))
    journeys = realtime.valid_journeys(siri.read_journeys(spark, path))
    current = trip_table.read_trip_table(spark, table)
    trip_table.upsert(spark, table, realtime.fold_feed(journeys, current, stations(spark)), updates.SLOT)
    spark.catalog.refreshByPath(table)
    after = files()
    assert {d for d, _ in before - after} == {"2024-07-02", "2024-07-03"}
    found = by(trip_table.read_trip_table(spark, table), "trip_id")
    assert len(found) == 6
    assert {k for k, r in found.items() if r["siri_updated_at"]} == {"t2", "late"}


def test_running_daily_delay(spark, tmp_path):
    source, out = str(tmp_path / "trips"), str(tmp_path / "daily")
    rows = [trip(f"t{i}", f"2024-01-0{1 + i % 3}", real_arrival="09:03:00") for i in range(30)]
    table = trips(spark, rows)
    table.repartition(3).write.parquet(source)
    stream = spark.readStream.schema(TRIPS).option("maxFilesPerTrigger", 1).parquet(source)
    daily = jobs.running_daily_delay(stream)
    run(daily.writeStream.foreachBatch(jobs.batches_to(out)).outputMode("complete"), tmp_path / "progress")
    streamed = jobs.newest_batch(spark, out).collect()
    assert {tuple(r) for r in streamed} == {tuple(r) for r in statistics.daily_counts(table).collect()}


def test_duplicates_and_late_rows(spark, tmp_path):
    landing, out, progress = str(tmp_path / "in"), str(tmp_path / "out"), tmp_path / "progress"
    schema = "key string, at timestamp"

    def deliver(rows):
        spark.createDataFrame([(k, datetime.fromisoformat(a)) for k, a in rows], schema).coalesce(1).write.mode("append").parquet(landing)
        stream = jobs.first_deliveries(spark.readStream.schema(schema).parquet(landing), ["key"], "at")
        run(stream.writeStream.format("parquet").option("path", out).outputMode("append"), progress)

    deliver([("a", "2024-01-03T00:00:00"), ("a", "2024-01-03T00:00:00"), ("b", "2024-01-01T00:00:00")])
    deliver([("late", "2024-01-02T00:00:00"), ("in_time", "2024-01-02T00:00:01"), ("a", "2024-01-03T00:00:00")])
    assert sorted(r.key for r in spark.read.parquet(out).collect()) == ["a", "b", "in_time"]


@pytest.mark.parametrize("hour, kept", [(0, True), (1, True), (2, False), (4, False), (5, True), (23, True)])
def test_operating_hours(spark, hour, kept):
    df = spark.createDataFrame([(datetime(2024, 1, 1, hour, 59),)], "at timestamp_ntz")
    assert (jobs.operating_hours(df, F.col("at")).count() == 1) is kept


def test_station_value_stream(spark, tmp_path):
    path = polls(tmp_path / "feed")
    out = str(tmp_path / "values")
    stream = jobs.station_value_stream(siri.stream_journeys(spark, path), stations(spark)).drop("feed_seq")
    run(stream.writeStream.format("parquet").option("path", out).outputMode("append"), tmp_path / "progress")
    assert spark.read.parquet(out).count() == 5
