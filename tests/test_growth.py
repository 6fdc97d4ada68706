"""What queries hold per task or per pair does not grow beside the feed."""

import gzip
import random
import zlib
from collections import Counter
from datetime import date, datetime, timedelta

import pyspark.sql.classic.dataframe as classic
from helpers import A, B, trip, trips
from pyspark.sql import functions as F
from test_realtime import call, entity, journey, snapshot, stations
from test_runs import MIDNIGHT, STOP_A, STOP_B, run

from railtempo.functions.labels import numeric_stop_id
from railtempo.functions.times import epoch_time
from railtempo.operators import gtfs_rt
from railtempo.plans import queries, tables
from railtempo.schema import GTFS_RT_ENTITY
from railtempo.sources import gtfs_rt as gtfs_rt_files
from railtempo.sources import siri, trip_table
from railtempo.streaming import jobs

SF = "/root/testdata/sf0.001"
DAY = date(2024, 7, 3)


def test_entities_meet_alike_trips_as_one_row(spark):
    rows = gtfs_rt.entity_rows(tables.entities(spark, SF))
    runs, at = tables.runs(spark, SF), tables.stations(spark)
    once = Counter(tuple(r) for r in gtfs_rt.trip_updates(rows, runs, at).collect())
    found = gtfs_rt.trip_updates(rows, runs.unionAll(runs).unionAll(runs), at)
    assert Counter(tuple(r) for r in found.collect()) == {k: 3 * n for k, n in once.items()} and once
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "n_trips" in plan and plan.index("Generate explode(sequence(") < plan.index("Join")


def updates_by_two_joins(rows, table, at):
    """The run first, then the trips of the run, with a filter of the stop updates for each."""
    oriented = gtfs_rt._oriented(table, at)

    def last_stop(stop):
        return F.try_element_at(F.filter("stop_time_update", lambda s: numeric_stop_id(s["stop_id"]) == F.col(stop)), F.lit(-1))

    met = gtfs_rt.match_runs(rows, table).join(oriented, gtfs_rt.RUN)
    met = met.withColumns({"a": last_stop("departure_stop"), "b": last_stop("arrival_stop")})
    times = epoch_time(F.col("a.departure.time")), "a.departure.delay", epoch_time(F.col("b.arrival.time")), "b.arrival.delay"
    return met.select("entity_id", "trip_id", "departure_date", *times, "trip_schedule_relationship", "a.schedule_relationship", "b.schedule_relationship")


def odd_runs_and_entities(spark):
    """Runs that recur, lack times, dates, ids or a listed end; entities with and without a day, times, stops and ids."""
    rng, first = random.Random(5), date(2024, 1, 15)
    made = [(n, first + timedelta(days=d), 1440 * d + rng.randint(-300, 1500)) for n in ("a", "b", "c", None) for d in range(4) for _ in range(rng.randint(0, 3))]
    made += [("old", date(1969, 5, 1), -28_900_000), ("a", first, 100), ("a", first, 100)]
    names, runs = tables.TRIPS.names, []
    for made_row in made:
        row = dict(zip(names, run(*made_row, lasts=rng.choice([50, 900, 2000]))))
        row["departure_station_name"], row["arrival_station_name"] = rng.choice([(A, B), (A, B), (B, A), (A, "elsewhere"), (None, B)])
        if rng.random() < 0.15:
            row[rng.choice(["departure_time_scheduled", "arrival_time_scheduled", "service_date"])] = None
        runs.append(tuple(row.values()))
    feed = []
    for i in range(1000):
        at = MIDNIGHT + 60 * rng.randint(-2000, 6000)
        event = [None, (at, 60), (None, 5), (at + 900, None)]
        stops = [
            None if rng.random() < 0.05 else (rng.choice([STOP_A, STOP_B, "stop_9", "", None]), rng.choice(event), rng.choice(event), rng.choice([None, "SKIPPED"]))
            for _ in range(rng.randint(0, 5))
        ]
        start = rng.choice([None, None, "20240115", "20240117", "20230101", "19690501", "soon"])
        one = entity(rng.choice(["a", "b", "c", "old", "unknown", None]), rng.choice([stops, stops, stops, None]), rng.choice([None, "CANCELED"]), start)
        feed.append((rng.choice([f"e{i}", "twice", None]), one[1]))
    return spark.createDataFrame(runs, tables.TRIPS), gtfs_rt.entity_rows(spark.createDataFrame(feed, GTFS_RT_ENTITY))


def test_entities_meet_their_run_and_its_trips_in_one_join(spark):
    table, rows = odd_runs_and_entities(spark)
    found = gtfs_rt.trip_updates(rows, table, stations(spark))
    expected = Counter(tuple(r) for r in updates_by_two_joins(rows, table, stations(spark)).collect())
    assert Counter(tuple(r) for r in found.collect()) == expected and sum(expected.values()) > 200
    node, joins = found._jdf.queryExecution().optimizedPlan(), 0
    while node.children().size():
        joins, node = joins + (node.nodeName() == "Join"), node.children().apply(0)
    assert joins == 1 and "trip_update" in node.toString()


def test_first_time_of_an_entity_needs_no_lambda(spark):
    rows = odd_runs_and_entities(spark)[1]
    assert "lambda" not in rows.select("first_time")._jdf.queryExecution().optimizedPlan().toString()


def test_written_entities_are_compressed_fast(spark, tmp_path):
    path = tmp_path / "rt"
    gtfs_rt_files.write_entities(tables.entities(spark, SF).coalesce(1), str(path))
    (part,) = path.glob("part-*")
    text = gzip.decompress(part.read_bytes())
    usual = len(zlib.compress(text, 6))
    assert 1.1 * usual < part.stat().st_size < len(text) / 5


def test_written_entities_are_compressed_and_bounded(spark, tmp_path):
    path, entities = str(tmp_path / "rt"), tables.entities(spark, SF)
    gtfs_rt_files.write_entities(entities, path, per_file=1000)
    names = [p.name for p in (tmp_path / "rt").iterdir() if p.name.startswith("part-")]
    assert all(n.endswith(".json.gz") for n in names) and len(names) >= entities.count() / 1000
    read = gtfs_rt_files.read_entities(spark, path)
    assert sorted(str(r) for r in read.collect()) == sorted(str(r) for r in entities.collect())


def test_upsert_keeps_the_fold_of_a_batch_not_its_journeys(spark, tmp_path, monkeypatch):
    polls = [
        journey("847", day=str(DAY), estimated=call("Estimated", A, f"{DAY}T08:{m:02d}:00+02:00"), polled=f"{DAY}T07:{m:02d}:00+02:00")
        for m in range(60)
    ]
    feed = siri.read_journeys(spark, snapshot(tmp_path / "feed", "1.xml", *polls))
    table, kept = str(tmp_path / "trips"), []
    trip_table.create_versioned(spark, table)
    persist = classic.DataFrame.persist
    monkeypatch.setattr(classic.DataFrame, "persist", lambda df, *a: kept.append(persist(df, *a)) or kept[-1])
    sizes = []
    unpersist = classic.DataFrame.unpersist
    monkeypatch.setattr(classic.DataFrame, "unpersist", lambda df, *a: sizes.append(df.count()) or unpersist(df, *a))
    rows = trips(spark, [trip("t", str(DAY), headsign="847", start=A, end=B)])
    jobs.upsert_batches(spark, table, lambda days: rows, stations(spark))(feed, 0)
    assert sizes == [2] and "estimated_calls" not in kept[0].columns
    assert [r.siri_departure_time_real.minute for r in trip_table.read_trip_table(spark, table).collect()] == [59]


def test_parts_of_the_journey_stream_grow_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(queries, "ROWS_PER_PART", 100)
    n = tables.table(spark, SF, "lineitem").count() // 100
    plan = queries._journey_stream(spark, SF)._jdf.queryExecution().logical().toString()
    assert n > 8 and f"Repartition {n}, true" in plan


def test_kept_deliveries_are_those_of_the_state_store(spark, tmp_path):
    schema, batches = "key string, other int, at timestamp", [
        [("a", 1, "2024-01-03T00:00:00"), ("a", 1, "2024-01-03T00:00:00"), ("b", 1, "2024-01-01T00:00:00"), ("c", 1, None), ("c", 1, None)],
        [("late", 2, "2024-01-02T00:00:00"), ("in_time", 2, "2024-01-02T00:00:01"), ("a", 2, "2024-01-03T00:00:00"), (None, 2, "2024-01-03T00:00:00")],
        [(None, 3, "2024-01-03T00:00:00"), ("in_time", 3, "2024-01-02T00:00:01"), ("a", 3, "2024-01-03T00:00:01"), ("d", 3, "2024-01-09T00:00:00")],
        [("a", 4, "2024-01-03T00:00:01"), ("d", 4, "2024-01-09T00:00:00"), ("e", 4, "2024-01-08T00:00:01")],
    ]
    landing, out, path = (str(tmp_path / n) for n in ("in", "out", "kept"))
    sink, frames = jobs.deliveries_sink(spark, path, ["key", "at"], "at"), []
    for rows in batches:
        frames.append(spark.createDataFrame([(k, n, a and datetime.fromisoformat(a)) for k, n, a in rows], schema).coalesce(1))
        frames[-1].write.mode("append").parquet(landing)
        stream = spark.readStream.schema(schema).parquet(landing)
        unique = jobs.first_deliveries(stream, ["key", "at"], "at")
        writer = unique.writeStream.format("parquet").option("path", out).outputMode("append")
        jobs.start(writer, str(tmp_path / "progress"), available_now=True).awaitTermination()
        query = jobs.start(stream.writeStream.foreachBatch(sink), str(tmp_path / "kept-progress"), available_now=True)
        query.awaitTermination()
        assert query.lastProgress["stateOperators"] == []
    kept = sorted(map(str, jobs.kept_deliveries(spark, path, unique.schema).collect()))
    assert kept == sorted(map(str, spark.read.parquet(out).collect())) and len(kept) == 8
    sink(frames[-1], 3)  # again, after a failure
    assert kept == sorted(map(str, jobs.kept_deliveries(spark, path, unique.schema).collect()))


def test_update_dedup_keeps_no_keys_in_the_state_store(spark, monkeypatch):
    held, start = [], jobs.start

    def started(*args, **more):
        held.append(start(*args, **more))
        return held[-1]

    monkeypatch.setattr(jobs, "start", started)
    for name in ("stream_update_dedup", "stream_late_updates"):
        assert queries.QUERIES[name](spark, SF).count() > 0
    assert len(held) == 3 and all(q.lastProgress["stateOperators"] == [] for q in held)
