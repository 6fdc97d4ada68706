import random
from datetime import date, datetime

import pytest
from helpers import A, B, by, trip, trips
from pyspark.sql import functions as F

from railtempo import schema
from railtempo.operators import gtfs_rt, realtime, updates
from railtempo.schema import GTFS_RT_ENTITY
from railtempo.sources import siri

STOP = {A: "FR:ScheduledStopPoint::87271007", B: "FR:ScheduledStopPoint::87276691"}
DAY = "2024-07-01"


def call(kind, station, departure=None, arrival=None, extra=""):
    times = ""
    if arrival:
        times += f"<ExpectedArrivalTime>{arrival}</ExpectedArrivalTime>"
    if departure:
        times += f"<ExpectedDepartureTime>{departure}</ExpectedDepartureTime>"
    stop = STOP.get(station, station)
    return f"<{kind}Call><StopPointRef>{stop}</StopPointRef>{extra}{times}</{kind}Call>"


def journey(number, day=DAY, estimated="", recorded="", flags="", polled="2024-07-01T08:00:00+02:00"):
    train = f"<TrainNumbers><TrainNumberRef>{number}</TrainNumberRef></TrainNumbers>" if number is not None else ""
    frame = f"<FramedVehicleJourneyRef><DataFrameRef>{day}</DataFrameRef></FramedVehicleJourneyRef>" if day else ""
    return (
        f"<EstimatedVehicleJourney><RecordedAtTime>{polled}</RecordedAtTime>{frame}{train}{flags}"
        f"<RecordedCalls>{recorded}</RecordedCalls><EstimatedCalls>{estimated}</EstimatedCalls>"
        "</EstimatedVehicleJourney>"
    )


def snapshot(folder, name, *journeys):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(
        '<?xml version="1.0" encoding="UTF-8"?><Siri xmlns="http://www.siri.org.uk/siri"><ServiceDelivery>'
        "<EstimatedTimetableDelivery><EstimatedJourneyVersionFrame>"
        + "".join(journeys)
        + "</EstimatedJourneyVersionFrame></EstimatedTimetableDelivery></ServiceDelivery></Siri>",
        encoding="utf-8",
    )
    return str(folder)


def valid(spark, path):
    return realtime.valid_journeys(siri.read_journeys(spark, path))


def stations(spark):
    return schema.default_stations(spark)


def schedule(spark):
    return trips(
        spark,
        [
            trip("go", DAY, headsign="847"),
            trip("go_twin", DAY, headsign="847", departure="08:10:00"),
            trip("back", DAY, headsign="900", start=B, end=A, departure="18:00:00", arrival="19:00:00"),
            trip("next_day", "2024-07-02", headsign="847"),
            trip("elsewhere", DAY, headsign="555", start=A, end="Creil"),
        ],
    )


def updated(spark, path):
    journeys, table = valid(spark, path), schedule(spark)
    folded = realtime.fold_feed(journeys, table, stations(spark))
    log = realtime.build_updates(journeys, table, stations(spark))
    one_by_one = updates.fold_updates(log, updates.SLOT)
    columns = sorted(folded.columns)
    assert {tuple(r) for r in folded.select(columns).collect()} == {
        tuple(r) for r in one_by_one.select(columns).collect()
    }
    return by(updates.apply_updates(table, folded, updates.SLOT), "trip_id")


def test_updates_follow_direction_and_match_all_trips_of_a_train(spark, tmp_path):
    path = snapshot(
        tmp_path / "feed",
        "1.xml",
        journey(
            "847",
            estimated=call("Estimated", B, "2024-07-01T09:20:00+02:00", "2024-07-01T07:12:00Z",
                           "<ArrivalPlatformName>3</ArrivalPlatformName>"),
            recorded=call("Recorded", A, "2024-07-01T08:04:00+02:00", "2024-07-01T07:58:00+02:00",
                          "<DeparturePlatformName>Hall 1</DeparturePlatformName>"),
        ),
        journey("900", estimated=call("Estimated", A, None, "2024-07-01T19:05:00+02:00")),
        journey("555", estimated=call("Estimated", A, "2024-07-01T08:05:00+02:00")),
    )
    found = updated(spark, path)
    for trip_id in ("go", "go_twin"):
        row = found[trip_id]
        assert row["siri_departure_time_real"] == datetime(2024, 7, 1, 8, 4)
        assert row["siri_arrival_time_real"] == datetime(2024, 7, 1, 9, 12)
        assert (row["siri_departure_platform"], row["siri_arrival_platform"]) == ("Hall 1", "3")
        assert (row["siri_departure_status"], row["siri_trip_status"]) == ("NORMAL", "NORMAL")
        assert row["siri_updated_at"] == datetime(2024, 7, 1, 8)
    back = found["back"]
    assert back["siri_arrival_time_real"] == datetime(2024, 7, 1, 19, 5)
    assert back["siri_departure_time_real"] is None and back["siri_departure_status"] is None
    for untouched in ("next_day", "elsewhere"):
        assert found[untouched]["siri_updated_at"] is None


def test_later_journeys_keep_known_values(spark, tmp_path):
    folder = tmp_path / "feed"
    snapshot(folder, "1.xml", journey("847", estimated=call("Estimated", A, "2024-07-01T08:04:00+02:00")))
    path = snapshot(
        folder,
        "2.xml",
        journey("847", estimated=call("Estimated", B, None, "2024-07-01T09:30:00+02:00"), polled="2024-07-01T08:02:00+02:00"),
        journey("847", polled="2024-07-01T08:02:00+02:00", flags="<Monitored>false</Monitored>"),
    )
    row = updated(spark, path)["go"]
    assert row["siri_departure_time_real"] == datetime(2024, 7, 1, 8, 4)
    assert row["siri_arrival_time_real"] == datetime(2024, 7, 1, 9, 30)
    assert row["siri_trip_status"] == "UNMONITORED"
    assert row["siri_updated_at"] == datetime(2024, 7, 1, 8, 2)


def test_last_call_at_a_station_replaces_all_its_values(spark, tmp_path):
    """Recorded calls come after estimated ones, whatever their place in the document."""
    path = snapshot(
        tmp_path / "feed",
        "1.xml",
        journey(
            "847",
            estimated=call("Estimated", A, "2024-07-01T08:30:00+02:00", extra="<DeparturePlatformName>9</DeparturePlatformName>"),
            recorded=call("Recorded", A, None, "2024-07-01T07:58:00+02:00"),
        ),
    )
    value = realtime.station_values(valid(spark, path), stations(spark)).first()
    assert value.expected_departure is None and value.platform is None
    assert value.expected_arrival == datetime(2024, 7, 1, 7, 58)
    row = updated(spark, path)["go"]
    assert row["siri_departure_time_real"] is None and row["siri_departure_platform"] is None


def test_call_status_and_platform(spark, tmp_path):
    def extra(i, text):
        return journey(str(i), estimated=call("Estimated", A, extra=text))

    path = snapshot(
        tmp_path / "feed",
        "1.xml",
        extra(1, "<Cancellation/>"),
        extra(2, "<Cancellation>false</Cancellation>"),
        extra(3, "<PredictionInaccurate>true</PredictionInaccurate>"),
        extra(4, "<PredictionInaccurate>false</PredictionInaccurate>"),
        extra(5, "<DeparturePlatformName></DeparturePlatformName><ArrivalPlatformName>4</ArrivalPlatformName>"),
        extra(6, "<ArrivalPlatformName>4</ArrivalPlatformName>"),
    )
    found = by(realtime.calls(valid(spark, path)), "train_number")
    assert [found[str(i)]["call_status"] for i in (1, 2, 3, 4)] == ["CANCELLED", "CANCELLED", "PREDICTION_INACCURATE", "NORMAL"]
    assert (found["5"]["platform"], found["6"]["platform"]) == (None, "4")


def test_trip_status_looks_at_the_first_flag(spark, tmp_path):
    yes, no = ("<PredictionInaccurate>true</PredictionInaccurate>", "<PredictionInaccurate>false</PredictionInaccurate>")
    path = snapshot(
        tmp_path / "feed",
        "1.xml",
        journey("1", flags="<Monitored>false</Monitored>" + yes),
        journey("2", flags=yes),
        journey("3", recorded=call("Recorded", A, extra=no), estimated=call("Estimated", B, extra=yes)),
        journey("4", recorded=call("Recorded", A), estimated=call("Estimated", B, extra=yes)),
        journey("5", flags=no, estimated=call("Estimated", B, extra=yes)),
        journey("6", flags="<Monitored>true</Monitored>"),
    )
    found = by(valid(spark, path), "train_number")
    assert [found[str(i)]["trip_status"] for i in range(1, 7)] == [
        "UNMONITORED", "PREDICTION_INACCURATE", "NORMAL", "PREDICTION_INACCURATE", "NORMAL", "NORMAL",
    ]


def test_invalid_journeys_and_times(spark, tmp_path):
    path = snapshot(
        tmp_path / "feed",
        "1.xml",
        journey(None),
        journey(""),
        journey("1", day=None),
        journey("2", day="someday"),
        journey("3", estimated=call("Estimated", A, "soon")),
    )
    journeys = valid(spark, path)
    assert {r.train_number for r in journeys.collect()} == {"2", "3"}
    assert by(journeys, "train_number")["2"]["departure_date"] is None
    assert by(realtime.calls(journeys), "train_number")["3"]["expected_departure"] is None


def test_counters(spark, tmp_path):
    path = snapshot(
        tmp_path / "feed",
        "1.xml",
        journey("847", estimated=call("Estimated", A) + call("Estimated", B) + call("Estimated", "other")),
        journey("847"),
        journey("555", estimated=call("Estimated", A)),
        journey("404", estimated=call("Estimated", A)),
        journey(None),
    )
    row = realtime.feed_counters(siri.read_journeys(spark, path), schedule(spark), stations(spark)).first()
    assert row.asDict() == {"journeys_seen": 5, "journeys_matched": 3, "station_calls": 3, "updates": 4, "trips_updated": 2}
    journeys = valid(spark, path)
    assert realtime.journey_match(journeys, schedule(spark)).count() == 3
    assert [r.train_number for r in realtime.unmatched_journeys(journeys, schedule(spark)).collect()] == ["404"]
    folded = realtime.fold_feed(journeys, schedule(spark), stations(spark))
    left = updates.without_update(schedule(spark), folded, updates.SLOT)
    assert {r.trip_id for r in left.collect()} == {"back", "next_day", "elsewhere"}


def test_xml_round_trip(spark, tmp_path):
    first = snapshot(tmp_path / "feed", "1.xml", journey("847", estimated=call("Estimated", A, extra="<Cancellation/>")))
    journeys = siri.read_journeys(spark, first)
    path = str(tmp_path / "copy")
    siri.write_snapshot(journeys, path)
    same = ["train_number", "journey_date", "estimated_calls", "recorded_calls", "polled_at"]
    assert siri.read_journeys(spark, path).select(same).first() == journeys.select(same).first()


# --- update logs --------------------------------------------------------------------------

LOG = (
    "trip_id string, departure_date date, seq bigint, siri_departure_time_real timestamp_ntz,"
    " siri_departure_platform string, siri_departure_status string, siri_arrival_time_real timestamp_ntz,"
    " siri_arrival_platform string, siri_arrival_status string, siri_trip_status string, siri_updated_at timestamp_ntz"
)


def random_log(seed, n, hot):
    """Updates of a few trips; `hot` of them concern one trip."""
    rng = random.Random(seed)

    def maybe(value):
        return value if rng.random() < 0.5 else None

    rows = []
    for seq in range(n):
        key = "hot" if rng.random() < hot else f"t{rng.randrange(20)}"
        moment = datetime(2024, 1, 1, 8, rng.randrange(60))
        rows.append(
            (key, date(2024, 1, 1), seq, maybe(moment), maybe(f"p{seq}"), maybe("NORMAL"), maybe(moment),
             maybe(f"q{seq}"), maybe("CANCELLED"), maybe("UNMONITORED"), moment)
        )
    return rows


@pytest.mark.parametrize("partitions", [1, 7])
def test_fold_equals_applying_one_by_one(spark, partitions):
    rows = random_log(3, 2000, hot=0.4)
    state = {}
    for key, day, seq, *values in rows:
        old = state.get(key, [None] * len(values))
        state[key] = [new if new is not None else known for new, known in zip(values, old)]
    shuffled = rows[:]
    random.Random(partitions).shuffle(shuffled)
    log = spark.createDataFrame(shuffled, LOG).repartition(partitions)
    folded = updates.fold_updates(log, updates.TRIP)
    names = [*schema.REALTIME_COLUMNS, "siri_updated_at"]
    assert {r.trip_id: [r[c] for c in names] for r in folded.collect()} == state
    assert folded.agg({"n_updates": "sum"}).first()[0] == len(rows)


def test_apply_keeps_known_values(spark):
    table = trips(spark, [trip("a", real_departure="08:01:00", siri_departure_platform="1"), trip("b")])
    log = spark.createDataFrame(
        [("a", date(2024, 1, 1), 1, None, "2", None, datetime(2024, 1, 1, 9, 3), None, None, "NORMAL", datetime(2024, 1, 1, 9))],
        LOG,
    )
    found = by(updates.apply_updates(table, updates.fold_updates(log, updates.TRIP), updates.TRIP), "trip_id")
    assert found["a"]["siri_departure_time_real"] == datetime(2024, 1, 1, 8, 1)
    assert (found["a"]["siri_departure_platform"], found["a"]["siri_trip_status"]) == ("2", "NORMAL")
    assert found["a"]["siri_arrival_time_real"] == datetime(2024, 1, 1, 9, 3)
    assert found["b"]["siri_updated_at"] is None


# --- GTFS-RT ------------------------------------------------------------------------------


def entity(trip_id, stops, relationship=None, start="20240101"):
    return (f"e_{trip_id}", ((trip_id, "route_K01", start, relationship), stops))


def test_gtfs_rt_updates(spark):
    stop_a, stop_b = (s[1] for s in schema.DEFAULT_STATIONS)
    table = trips(spark, [trip("go"), trip("back", start=B, end=A), trip("half"), trip("gone")])
    start = 1704096000  # 2024-01-01 09:00 in Paris
    rows = [
        entity("go", [(stop_a, (start, 300), None, None), (stop_b, None, (start + 3600, 600), None)]),
        entity("back", [(stop_b, (start, 180), None, None), (stop_a, None, (start + 3600, 300), None)]),
        entity("half", [(stop_a, (start, 180), None, None)]),
        entity("gone", [(stop_a, None, None, "SKIPPED"), (stop_b, None, None, "SKIPPED")], "CANCELED"),
        entity("trip_999", [(stop_a, (start, 0), None, None)]),
    ]
    entities = gtfs_rt.entity_rows(spark.createDataFrame(rows, GTFS_RT_ENTITY))
    assert {r.trip_id for r in gtfs_rt.known_trips(entities, table).collect()} == {"go", "back", "half", "gone"}
    found = by(gtfs_rt.trip_updates(entities, table, stations(spark)), "trip_id")
    assert set(found) == {"go", "back", "half", "gone"}
    for trip_id, delays in {"go": (300, 600), "back": (180, 300)}.items():
        row = found[trip_id]
        assert row["departure_time_real"] == datetime(2024, 1, 1, 9)
        assert row["arrival_time_real"] == datetime(2024, 1, 1, 10)
        assert (row["departure_delay_seconds"], row["arrival_delay_seconds"]) == delays
        assert row["trip_schedule_relationship"] is None
    assert found["half"]["arrival_time_real"] is None and found["half"]["departure_delay_seconds"] == 180
    gone = found["gone"]
    assert gone["departure_time_real"] is None
    assert [gone[f"{x}_schedule_relationship"] for x in ("trip", "departure", "arrival")] == ["CANCELED", "SKIPPED", "SKIPPED"]


def test_gtfs_rt_fold_keeps_known_values(spark):
    stop_a, stop_b = (s[1] for s in schema.DEFAULT_STATIONS)
    table = trips(spark, [trip("go"), trip("quiet")])
    start = 1704096000
    polls = [
        entity("go", [(stop_a, (start, 60), None, None), (stop_b, None, (start + 3600, 90), None)]),
        entity("go", [(stop_a, (start, 0), None, None), (stop_a, (start + 300, 300), None, None), ("stop_9", None, None, None)]),
        entity("go", [], "CANCELED"),
    ]
    rows = gtfs_rt.entity_rows(spark.createDataFrame(polls, GTFS_RT_ENTITY))
    found = by(gtfs_rt.fold_trip_updates(rows.withColumn("seq", F.monotonically_increasing_id()), table, stations(spark)), "trip_id")
    assert set(found) == {"go"}
    go = found["go"]
    assert go["departure_time_real"] == datetime(2024, 1, 1, 9, 5) and go["departure_delay_seconds"] == 300
    assert go["arrival_time_real"] == datetime(2024, 1, 1, 10) and go["arrival_delay_seconds"] == 90
    assert (go["trip_schedule_relationship"], go["n_updates"]) == ("CANCELED", 3)
