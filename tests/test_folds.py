"""Folds: hash aggregation before the first shuffle, texts of any form, against row-by-row folds."""

import random

import pytest
from helpers import A, B
from pyspark.sql import functions as F

from railtempo import schema
from railtempo.operators import realtime, schedule, updates
from railtempo.plans import tables
from railtempo.plans.queries import QUERIES


def before_first_shuffle(df):
    """Names of the operators that see the feed before it is shuffled for the first fold."""
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [len(line) - len(line.lstrip(" :+-*")) for line in plan]
    found = set()
    for at, line in enumerate(plan):
        if "Exchange hashpartitioning" not in line:
            continue
        below = []
        for later in range(at + 1, len(plan)):
            if depth[later] <= depth[at]:
                break
            below.append(plan[later])
        if not any("Exchange hashpartitioning" in text for text in below):
            found |= {text.lstrip(" :+-*").split("(")[0].split(" ")[0] for text in below}
    return found


@pytest.mark.parametrize("name", ["corridor_trips", "corridor_trips_multi", "update_fold", "gtfs_rt_fold"])
def test_folds_hash_before_they_shuffle(spark, name):
    operators = before_first_shuffle(QUERIES[name](spark, "/root/testdata/sf0.001"))
    assert "HashAggregate" in operators
    assert not operators & {"SortAggregate", "ObjectHashAggregate"}


def test_last_known_values_equal_a_loop_over_the_log(spark):
    rng = random.Random(3)
    log = [
        (rng.choice("xyz"), rng.choice([None, "1", "2", "", "Hall with a very long name"]), rng.choice([None, "GO", "STOP"]),
         rng.choice([None, 1, 2, 3, 4]), seq)
        for seq in range(400)
    ]
    rng.shuffle(log)
    expected = {}
    for key, *values, _ in sorted(log, key=lambda r: r[-1]):
        row = expected.setdefault(key, [None, None, None, 0])
        row[:3] = [new if new is not None else old for new, old in zip(values, row)]
        row[3] += 1
    rows = spark.createDataFrame(log, "k string, platform string, status string, delay int, seq bigint").repartition(5)
    folded = updates.fold_last(rows, ["k"], ["platform", "status", "delay"], F.lit(1)).collect()
    assert {r.k: [r.platform, r.status, r.delay, r.n_updates] for r in folded} == expected


def test_empty_logs_and_keys_without_values(spark):
    types = "k string, platform string, delay int, seq bigint"
    empty = updates.fold_last(spark.createDataFrame([], types), ["k"], ["platform", "delay"], F.lit(1))
    assert empty.collect() == []
    blank = spark.createDataFrame([(None, None, None, 1), (None, None, None, 2)], types)
    [row] = updates.fold_last(blank, ["k"], ["platform", "delay"], F.lit(1)).collect()
    assert tuple(row) == (None, None, None, 2)


CLOCKS = ["08:00:00", "25:10:59", "8:05:00", "", None, "soon", "123:00:00", "00:00:00", "99:99:99", " 08:00:00", "08:00:00\n", "٠٨:٠٠:٠٠"]


def test_times_of_any_form_come_back_as_they_were(spark):
    rng = random.Random(5)
    stops, expected = [], {}
    names = {s.gtfs_stop_id: s.station_name for s in schema.default_stations(spark).collect()}
    by_name = {name: stop for stop, name in names.items()}
    for n in range(300):
        visits = [rng.choice([A, B, "elsewhere"]) for _ in range(rng.randrange(1, 7))]
        rows = [(f"t{n}", by_name.get(at, "elsewhere"), rng.choice(CLOCKS), rng.choice(CLOCKS), i) for i, at in enumerate(visits)]
        stops += rows
        if A in visits and B in visits:
            start, end = (A, B) if visits.index(A) < visits.index(B) else (B, A)
            last = {name: [r for r, at in zip(rows, visits) if at == name][-1] for name in (A, B)}
            expected[f"t{n}"] = (start, end, last[start][3], last[end][2])
    types = "trip_id string, stop_id string, arrival_time string, departure_time string, position bigint"
    table = spark.createDataFrame(rng.sample(stops, len(stops)), types).repartition(4)
    found = schedule.corridor_trips(table, schema.default_stations(spark), schema.default_corridors(spark)).collect()
    assert {r.trip_id: tuple(r[1:]) for r in found} == expected and len(found) == len(expected) > 100


def test_the_log_has_the_last_call_at_each_stop_without_nested_lambdas(spark):
    rng = random.Random(9)
    stops = ["SA", "SB", "elsewhere", None]
    fields = "StopPointRef Cancellation PredictionInaccurate ExpectedArrivalTime ArrivalPlatformName ExpectedDepartureTime DeparturePlatformName"
    types = ", ".join(f"{name}: string" for name in fields.split())
    rows, expected = [], []
    for n in range(200):
        made = [None if rng.random() < 0.1 else (rng.choice(stops), *[None] * 5, str(i)) for i in range(rng.randrange(6))]
        cut = rng.randrange(len(made) + 1)
        rows.append(("1", None, None, "NORMAL", made[:cut], made[cut:], n))
        last = {c[0]: c[-1] for c in made if c and c[0] in ("SA", "SB")}
        expected += [(n, "", None), *[(n, stop[1], platform) for stop, platform in last.items()]]
    rows += [("1", None, None, "NORMAL", None, [], 200)]  # no calls known: as before, nothing in the log
    feed = spark.createDataFrame(
        rows,
        "trip_headsign string, departure_date date, polled_at timestamp_ntz, trip_status string,"
        f" estimated_calls array<struct<{types}>>, recorded_calls array<struct<{types}>>, feed_seq bigint",
    )
    listed = spark.createDataFrame([("SA", "A"), ("SB", "B")], "siri_stop_id string, station_name string")
    log = realtime.feed_log(feed, listed)
    assert sorted((r.seq, r.station, r.platform) for r in log.collect()) == sorted(expected)
    assert "lambda" not in log._jdf.queryExecution().optimizedPlan().toString()


def test_lines_of_a_train_are_dealt_out_together(spark):
    """One shuffle without the sort of a round robin; the first fold then leaves about a row per train and text."""
    plan = tables.lines(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions [hundred" in plan
    read = tables.lines(spark, "/root/testdata/sf0.001")
    assert sorted(map(str, read.collect())) == sorted(map(str, tables.table(spark, "/root/testdata/sf0.001", "lineitem").collect()))
