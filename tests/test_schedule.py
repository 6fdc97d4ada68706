from datetime import date, datetime

import pytest
from helpers import A, B, by

from railtempo import schema
from railtempo.operators import schedule
from railtempo.schema import CORRIDORS, STATIONS, parameter_table
from railtempo.sources import gtfs, trip_table

STOP_A, STOP_B = (s[1] for s in schema.DEFAULT_STATIONS)
MONDAY, TUESDAY = date(2024, 1, 1), date(2024, 1, 2)
LOADED = datetime(2024, 1, 1, 3, 23)

# Trip, first stop, second stop, departure, arrival.
STOPS = [
    ("trip_01", STOP_A, STOP_B, "08:00:00", "09:00:00"),
    ("trip_02", STOP_A, STOP_B, "10:00:00", "11:00:00"),
    ("trip_03", STOP_A, STOP_B, "12:00:00", "13:00:00"),
    ("trip_04", STOP_B, STOP_A, "14:00:00", "15:00:00"),
    ("trip_05", STOP_B, STOP_A, "16:00:00", "17:00:00"),
    ("trip_06", STOP_A, STOP_B, "23:40:00", "24:30:00"),
    ("trip_07", STOP_A, STOP_B, "18:00:00", ""),
]


def write(folder, name, header, rows):
    folder.mkdir(exist_ok=True)
    lines = [header, *[",".join(r) for r in rows]]
    (folder / f"{name}.txt").write_text("\n".join(lines) + "\n", encoding="utf-8")


@pytest.fixture()
def feed(tmp_path):
    folder = tmp_path / "gtfs"
    services = [f"{i:06d}" for i in range(1, 8)]
    calendar = [(s, "20240101", "1") for s in services]
    calendar += [(services[i], "20240102", "1") for i in (0, 1, 5)]
    calendar += [(services[3], "20240102", "2")]
    write(folder, "calendar_dates", "service_id,date,exception_type", calendar)
    write(folder, "routes", "route_id,agency_id,route_short_name",
          [(f"route_K0{i}", "x", f"K0{i}") for i in (1, 2, 3)])
    write(folder, "trips", "route_id,service_id,trip_id,trip_headsign,direction_id",
          [(f"route_K0{i}", services[i - 1], f"trip_0{i}", f"0{i}", "0") for i in range(1, 8)])
    stops = []
    for trip, first, second, departure, arrival in STOPS:
        stops.append((trip, departure, departure, first, ""))
        stops.append((trip, arrival, arrival, second, ""))
    write(folder, "stop_times", "trip_id,arrival_time,departure_time,stop_id,stop_sequence", stops)
    return str(folder)


def tables(spark, folder):
    return {
        "calendar_dates": gtfs.read_calendar_dates(spark, folder),
        "trips": gtfs.read_trips(spark, folder),
        "routes": gtfs.read_routes(spark, folder),
        "stop_times": gtfs.read_stop_times(spark, folder),
    }


def build(spark, folder, day=None):
    return schedule.build_schedule(
        tables(spark, folder), schema.default_stations(spark), schema.default_corridors(spark), LOADED, day
    )


def test_active_services(spark, feed):
    calendar = gtfs.read_calendar_dates(spark, feed)
    assert schedule.active_services(calendar, MONDAY).count() == 7
    found = {r.service_id for r in schedule.active_services(calendar, TUESDAY).collect()}
    assert found == {"000001", "000002", "000006"}
    assert schedule.active_services(calendar).count() == 10


def test_schedule_of_days(spark, feed):
    monday = by(build(spark, feed, MONDAY), "trip_id")
    assert set(monday) == {s[0] for s in STOPS}
    first = monday["trip_01"]
    assert (first["route_short_name"], first["trip_headsign"]) == ("K01", "01")
    assert (first["departure_station_name"], first["arrival_station_name"]) == (A, B)
    assert first["departure_time_scheduled"] == datetime(2024, 1, 1, 8)
    assert first["arrival_time_scheduled"] == datetime(2024, 1, 1, 9)
    assert first["created_at"] == LOADED and first["siri_trip_status"] is None
    assert (monday["trip_04"]["departure_station_name"], monday["trip_04"]["arrival_station_name"]) == (B, A)
    assert monday["trip_04"]["route_short_name"] == ""
    assert monday["trip_06"]["arrival_time_scheduled"] == datetime(2024, 1, 2, 0, 30)
    assert monday["trip_06"]["service_date"] == MONDAY
    assert monday["trip_07"]["arrival_time_scheduled"] is None
    assert set(by(build(spark, feed, TUESDAY), "trip_id")) == {"trip_01", "trip_02", "trip_06"}
    assert build(spark, feed).count() == 10


def test_service_day_trips(spark, feed):
    g = tables(spark, feed)
    services = schedule.active_services(g["calendar_dates"], TUESDAY)
    found = schedule.service_day_trips(g["stop_times"], g["trips"], services).collect()
    assert {(r.trip_id, r.n_stops) for r in found} == {("trip_01", 2), ("trip_02", 2), ("trip_06", 2)}


def test_first_and_last_rows_win(spark, tmp_path):
    folder = tmp_path / "gtfs"
    write(folder, "trips", "route_id,service_id,trip_id,trip_headsign", [("r1", "s1", "t", "h1"), ("r2", "s2", "t", "h2")])
    write(folder, "routes", "route_id,route_short_name", [("r1", "old"), ("r1", "new")])
    trip = gtfs.read_trips(spark, str(folder)).first()
    assert (trip.route_id, trip.trip_headsign, trip.service_id) == ("r1", "h1", "s2")
    assert gtfs.read_routes(spark, str(folder)).first().route_short_name == "new"


def test_missing_optional_column_is_null(spark, tmp_path):
    folder = tmp_path / "gtfs"
    write(folder, "routes", "route_id", [("r1",)])
    assert gtfs.read_routes(spark, str(folder)).first().route_short_name is None


def test_file_order_with_many_splits(spark, tmp_path):
    """Stops without a sequence keep file order even when the file is read in pieces."""
    folder = tmp_path / "gtfs"
    names = [f"stop_{i}" for i in range(4000)]
    rows = [("t", "08:00:00", "08:00:00", name, "") for name in names]
    write(folder, "stop_times", "trip_id,arrival_time,departure_time,stop_id,stop_sequence", rows)
    settings = {"spark.sql.files.maxPartitionBytes": "8192", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        stops = gtfs.read_stop_times(spark, str(folder))
        assert stops.rdd.getNumPartitions() > 4
        assert [r.stop_id for r in stops.orderBy("position").collect()] == names
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def stop_rows(spark, rows):
    return spark.createDataFrame(rows, "trip_id string, stop_id string, position bigint, arrival_time string, departure_time string")


def test_station_visited_twice(spark):
    """The first visit decides the direction, the last one gives the times."""
    stops = stop_rows(
        spark,
        [
            ("t", STOP_A, 1, "a1", "d1"),
            ("t", STOP_B, 2, "a2", "d2"),
            ("t", STOP_A, 3, "a3", "d3"),
            ("u", STOP_A, 1, "a1", "d1"),
        ],
    )
    found = schedule.corridor_trips(stops, schema.default_stations(spark), schema.default_corridors(spark)).collect()
    assert [tuple(r) for r in found] == [("t", A, B, "d3", "a2")]


@pytest.mark.parametrize("limit", [10 << 20, -1])
def test_many_corridors_against_brute_force(spark, limit):
    """Same result with broadcast corridor ends and with a shuffled join."""
    import random

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(limit))
    rng = random.Random(5)
    stations = [(f"S{i}", f"g{i}", f"s{i}") for i in range(6)]
    pairs = [("S0", "S1"), ("S1", "S2"), ("S4", "S0")]
    rows, expected = [], set()
    for t in range(60):
        visits = [rng.randrange(6) for _ in range(rng.randrange(1, 8))]
        rows += [(f"t{t}", f"g{v}", p, f"a{p}", f"d{p}") for p, v in enumerate(visits)]
        for x, y in pairs:
            i, j = int(x[1]), int(y[1])
            if i in visits and j in visits:
                start, end = (i, j) if visits.index(i) < visits.index(j) else (j, i)

                def last(v):
                    return len(visits) - 1 - visits[::-1].index(v)

                expected.add((f"t{t}", f"S{start}", f"S{end}", f"d{last(start)}", f"a{last(end)}"))
    found = schedule.corridor_trips(
        stop_rows(spark, rows), parameter_table(spark, stations, STATIONS), parameter_table(spark, pairs, CORRIDORS)
    )
    try:
        assert {tuple(r) for r in found.collect()} == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_load_guard_and_new_days(spark, feed, tmp_path):
    path = str(tmp_path / "trips")
    trip_table.load_day(build(spark, feed, MONDAY), path, MONDAY)
    table = trip_table.read_trip_table(spark, path)
    assert table.count() == 7
    with pytest.raises(trip_table.DayAlreadyLoaded):
        trip_table.load_day(build(spark, feed, MONDAY), path, MONDAY)
    assert trip_table.read_trip_table(spark, path).count() == 7
    missing = trip_table.new_days(build(spark, feed), table)
    assert {r.service_date for r in missing.collect()} == {TUESDAY}
    trip_table.write_days(missing, path)
    assert trip_table.read_trip_table(spark, path).count() == 10


def test_date_filter_prunes_partitions(spark, feed, tmp_path):
    from railtempo.operators.filters import on_day

    path = str(tmp_path / "trips")
    trip_table.write_days(build(spark, feed), path)
    plan = on_day(trip_table.read_trip_table(spark, path), TUESDAY)._jdf.queryExecution().executedPlan().toString()
    partition_filters = plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "departure_day" in partition_filters
    assert "departure_time_scheduled" in plan.split("PushedFilters: ")[1]


def test_gtfs_round_trip_keeps_text(spark, tmp_path):
    df = spark.createDataFrame([("000001", "20240101", "1")], schema.GTFS["calendar_dates"])
    gtfs.write_table(df, str(tmp_path), "calendar_dates")
    assert tuple(gtfs.read_calendar_dates(spark, str(tmp_path)).first()) == ("000001", "20240101", "1")
