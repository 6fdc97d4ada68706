from datetime import date, datetime, timezone
from itertools import groupby

import pytest
from helpers import by, trip, trips
from pyspark.sql import functions as F

from railtempo.functions import labels
from railtempo.functions.times import (
    clock_minutes,
    clock_text,
    epoch_time,
    iso_time,
    service_time,
    wall_clock,
)
from railtempo.operators import board
from railtempo.schema import WEEKDAY_LABELS


def test_every_weekday_set(spark):
    def expected(mask):
        days = [i for i in range(7) if mask >> i & 1]
        runs = [[d for _, d in g] for _, g in groupby(enumerate(days), key=lambda p: p[1] - p[0])]
        text = [WEEKDAY_LABELS[r[0]] if len(r) == 1 else f"{WEEKDAY_LABELS[r[0]]} - {WEEKDAY_LABELS[r[-1]]}" for r in runs]
        return ", ".join(WEEKDAY_LABELS[d] for d in days), ", ".join(text)

    rows = spark.range(128).select(
        "id", labels.weekday_list(F.col("id")).alias("days"), labels.weekday_ranges(F.col("id")).alias("ranges")
    )
    assert {r.id: (r.days, r.ranges) for r in rows.collect()} == {m: expected(m) for m in range(128)}


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-07-01T08:00:00+02:00", datetime(2024, 7, 1, 8)),
        ("2024-07-01T06:00:00Z", datetime(2024, 7, 1, 8)),
        ("2024-01-01T07:30:00Z", datetime(2024, 1, 1, 8, 30)),
        ("2024-01-01T07:30:00.250Z", datetime(2024, 1, 1, 8, 30)),
        ("2024-01-01T07:30:00-05:00", datetime(2024, 1, 1, 13, 30)),
        ("2024-01-01T08:30:00+01:00", datetime(2024, 1, 1, 8, 30)),
        ("2024-01-01T08:30:00", datetime(2024, 1, 1, 8, 30)),
        ("2024-01-01T08:30", datetime(2024, 1, 1, 8, 30)),
        ("2024-01-01t07:30:00z", datetime(2024, 1, 1, 8, 30)),
        ("2024-01-01T08:00:00garbage", None),
        ("2024-01-01T08:00:00 maybe", None),
        ("2024", None),
        ("not a time", None),
        ("", None),
        (None, None),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_iso_time_in_any_session_zone(spark, text, expected, zone):
    previous = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(text,)], "t string")
        assert df.select(iso_time(F.col("t"))).first()[0] == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", previous)


def test_literals_keep_their_clock_time_in_any_session_zone(spark):
    previous = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        naive, aware = datetime(2024, 7, 1, 8), datetime(2024, 7, 1, 6, tzinfo=timezone.utc)
        row = spark.range(1).select(wall_clock(naive), wall_clock(aware)).first()
        assert tuple(row) == (naive, naive)
    finally:
        spark.conf.set("spark.sql.session.timeZone", previous)


def test_service_time(spark):
    df = spark.createDataFrame([("08:00:00",), ("24:30:00",), ("47:59:59",), ("",), (None,), (" 5:01:02",)], "t string")
    found = [r[0] for r in df.select(service_time(F.lit(date(2024, 1, 1)), F.col("t"))).collect()]
    assert found == [
        datetime(2024, 1, 1, 8),
        datetime(2024, 1, 2, 0, 30),
        datetime(2024, 1, 2, 23, 59, 59),
        None,
        None,
        datetime(2024, 1, 1, 5, 1, 2),
    ]


def test_service_time_has_no_last_hour(spark):
    df = spark.createDataFrame([("75:00:00",), ("240:00:01",)], "t string")
    found = [r[0] for r in df.select(service_time(F.lit(date(2024, 1, 1)), F.col("t"))).collect()]
    assert found == [datetime(2024, 1, 4, 3), datetime(2024, 1, 11, 0, 0, 1)]


def test_epoch_time(spark):
    df = spark.createDataFrame([(1704096000,), (None,)], "s bigint")
    assert [r[0] for r in df.select(epoch_time(F.col("s"))).collect()] == [datetime(2024, 1, 1, 9), None]


def test_clock_minutes_drop_days_and_keep_sign(spark):
    df = spark.createDataFrame([(3660,), (-5400,), (90000,), (59,), (None,)], "s bigint")
    assert [r[0] for r in df.select(clock_minutes(F.col("s"))).collect()] == [61, -90, 60, 0, None]


def test_small_texts(spark):
    df = spark.createDataFrame([(0,)], "x int").select(
        labels.numeric_stop_id(F.lit("stop_12345678")).alias("a"),
        labels.numeric_stop_id(F.lit("12345678")).alias("b"),
        labels.numeric_stop_id(F.lit(None).cast("string")).alias("c"),
        labels.numeric_stop_id(F.lit("")).alias("d"),
        labels.platform_label(F.lit("Hall 3")).alias("e"),
        labels.platform_label(F.lit("12")).alias("f"),
        labels.minutes_text(F.lit(59)).alias("g"),
        labels.minutes_text(F.lit(65)).alias("h"),
        clock_text(F.lit(485)).alias("i"),
        labels.week_label(F.lit(date(2024, 1, 29))).alias("j"),
        labels.week_label(F.lit(date(2024, 1, 1))).alias("k"),
        labels.day_label(F.lit(date(2024, 1, 9))).alias("l"),
    )
    assert list(df.first()) == [
        "12345678", "12345678", "", "", "H3", "12", "59 min", "1h05", "08:05", "29/01-4/02", "1-7/01", "09/01",
    ]


def test_trip_labels(spark):
    table = trips(
        spark,
        [
            trip("same", real_departure="08:10:00", real_arrival="09:10:00"),
            trip("both", real_departure="08:05:00", real_arrival="10:10:00"),
            trip("early", real_departure="07:59:00", real_arrival="08:58:00"),
            trip("half", real_arrival="09:03:30"),
            trip("none"),
            trip("gone", departure_status="CANCELLED", real_departure="08:10:00"),
            trip("onedge", real_departure="08:00:00", real_arrival="09:00:00"),
        ],
    )
    found = by(board.trip_labels(table), "trip_id")
    assert {k: r["delay_text"] for k, r in found.items()} == {
        "same": "10 min",
        "both": "Départ: 5 min, Arrivée: 1h10",
        "early": "Départ: À l'heure, Arrivée: À l'heure",
        "half": "Arrivée: 3 min",
        "none": "",
        "gone": "Supprimé",
        "onedge": "À l'heure",
    }
    both = found["both"]
    assert (both["departure_display_time"], both["departure_display_state"]) == ("08:05", "late")
    assert (both["duration_scheduled_text"], both["duration_real_text"], both["duration_exceeded"]) == ("1h00", "2h05", True)
    assert (found["early"]["departure_display_time"], found["early"]["departure_display_state"]) == ("08:00", "on_time")
    assert found["early"]["duration_exceeded"] is False
    assert (found["none"]["arrival_display_state"], found["none"]["duration_real_text"]) == ("unknown", None)
    assert (found["gone"]["arrival_display_time"], found["gone"]["arrival_display_state"]) == ("09:00", "cancelled")


def test_board_and_freshness(spark):
    seen = datetime(2024, 1, 1, 8, 30)
    table = trips(
        spark,
        [
            trip("a", departure="10:00:00", arrival="11:00:00", updated=seen),
            trip("b", real_departure="08:01:30", updated=datetime(2024, 1, 1, 8)),
            trip("c", "2024-01-02"),
            trip("d", start="Compiègne", end="Paris Nord", siri_departure_platform="Hall 2"),
        ],
    )
    day = board.live_board(table, date(2024, 1, 1)).collect()
    assert [r.trip_id for r in day] == ["d", "b", "a"]
    assert day[0].direction == "Compiègne → Paris Nord" and day[0].departure_platform == "H2"
    assert day[1].departure_delay_minutes == 1.5 and day[1].arrival_delay_minutes is None
    past = {r.trip_id: r.is_past for r in board.past_trips(table, table).collect()}
    assert past == {"a": False, "b": True, "c": False, "d": False}
    fresh = board.feed_freshness(table, datetime(2024, 1, 1, 8, 45)).first()
    assert (fresh.formatted_timestamp, fresh.is_outdated) == ("01/01/2024 à 08h30", False)
    assert board.feed_freshness(table, datetime(2024, 1, 1, 8, 45, 1)).first().is_outdated is True
