"""SIRI-ET journeys: calls, station values, schedule match and oriented updates.

A journey element is small (its stops), so everything that stays inside one journey is an
array expression on the row and needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railtempo.functions.status import call_platform, call_status, trip_status
from railtempo.functions.times import iso_time
from railtempo.operators.filters import has_departure_day
from railtempo.operators.updates import SLOT, fold_last, with_departure_date
from railtempo.schema import DEPARTURE_DAY

#: Journeys meet the schedule on train number and departure date.
MATCH = ["trip_headsign", "departure_date"]
#: What a call says about its station.
STATION_VALUES = ["expected_departure", "expected_arrival", "platform", "call_status"]


def valid_journeys(journeys: DataFrame) -> DataFrame:
    """Journeys with a train number and a date, with match keys and `trip_status`."""
    kept = journeys.filter((F.col("train_number") != "") & (F.col("journey_date") != ""))
    return kept.withColumns(
        {
            "trip_headsign": F.col("train_number"),
            "departure_date": _journey_day(),
            "trip_status": trip_status(),
        }
    )


def _journey_day() -> Column:
    return F.when(
        F.col("journey_date").rlike(r"^\d{4}-\d\d-\d\d$"), F.col("journey_date").try_cast("date")
    )


def _tagged_calls() -> Column:
    """Estimated calls, then recorded ones: the order in which they are applied."""

    def tag(kind: str):
        return lambda c: F.struct(F.lit(kind).alias("kind"), c.alias("call"))

    return F.concat(
        F.transform("estimated_calls", tag("estimated")),
        F.transform("recorded_calls", tag("recorded")),
    )


def calls(journeys: DataFrame) -> DataFrame:
    """One row per call with its kind and its position in application order."""
    kept = [c for c in journeys.columns if c not in ("recorded_calls", "estimated_calls")]
    return journeys.select(
        *kept, F.posexplode(_tagged_calls()).alias("call_position", "tagged")
    ).select(
        *kept,
        "call_position",
        F.col("tagged.kind").alias("call_kind"),
        F.col("tagged.call.StopPointRef").alias("siri_stop_id"),
        *call_values(F.col("tagged.call")),
    )


def call_values(call: Column) -> list[Column]:
    values = (
        iso_time(call["ExpectedDepartureTime"]),
        iso_time(call["ExpectedArrivalTime"]),
        call_platform(call),
        call_status(call),
    )
    return [value.alias(name) for name, value in zip(STATION_VALUES, values)]


def station_calls(exploded: DataFrame, stations: DataFrame) -> DataFrame:
    """Calls at the listed stations only, with the station's name."""
    return exploded.join(stations.select("siri_stop_id", "station_name"), "siri_stop_id")


def _last_calls(journeys: DataFrame) -> tuple[DataFrame, Column]:
    """Journeys with `ordered_calls`, and the array of the last call at each stop.

    Calls without a stop say nothing about a station and are left out first.
    """
    ordered = F.col("ordered_calls")
    last_only = F.filter(
        ordered,
        lambda c, i: ~F.exists(
            F.slice(ordered, i + 2, F.size(ordered)),
            lambda later: later["StopPointRef"] == c["StopPointRef"],
        ),
    )
    return (
        journeys.withColumn(
            "ordered_calls",
            F.filter(
                F.concat("estimated_calls", "recorded_calls"), lambda c: c["StopPointRef"].isNotNull()
            ),
        ),
        last_only,
    )


def station_values(journeys: DataFrame, stations: DataFrame) -> DataFrame:
    """One row per journey and station: the last call there replaces earlier ones whole.

    Earlier calls at the same stop are dropped inside the array, before it is exploded, and
    texts are read only for calls that meet a listed station.
    """
    kept = [c for c in journeys.columns if c not in ("recorded_calls", "estimated_calls")]
    ordered, last_only = _last_calls(journeys)
    exploded = ordered.select(*kept, F.explode(last_only).alias("call")).withColumn(
        "siri_stop_id", F.col("call.StopPointRef")
    )
    return station_calls(exploded, stations).select(
        *kept, "station_name", *call_values(F.col("call"))
    )


def feed_log(journeys: DataFrame, stations: DataFrame, *kept: str) -> DataFrame:
    """The feed as rows to fold: one per journey (station blank) and one per station value.

    `kept` are further columns of the journeys that all their rows have.
    """
    calls = F.concat("estimated_calls", "recorded_calls")
    exploded = (
        journeys.select(
            *MATCH,
            *kept,
            "polled_at",
            "trip_status",
            F.col("feed_seq").alias("seq"),
            F.reverse(calls["StopPointRef"]).alias("from_last"),
            F.posexplode(F.concat(calls, F.array(F.lit(None)))).alias("at", "call"),
        )
        .withColumns({"siri_stop_id": F.col("call.StopPointRef"), "n_after": F.size("from_last") - F.col("at")})
        .filter((F.col("n_after") == 0) | (F.array_position("from_last", F.col("siri_stop_id")) == F.col("n_after")))
    )
    listed = stations.select("siri_stop_id", F.col("station_name").alias("station"))
    itself = F.col("n_after") == 0
    return (
        exploded.join(listed, "siri_stop_id", "left")
        .filter(itself | F.col("station").isNotNull())
        .select(
            *MATCH,
            *kept,
            F.coalesce("station", F.lit("")).alias("station"),
            *[F.when(~itself, v).alias(n) for n, v in zip(STATION_VALUES, call_values(F.col("call")))],
            F.when(itself, F.col("trip_status")).alias("trip_status"),
            F.when(itself, F.col("polled_at")).alias("polled_at"),
            "seq",
        )
    )


def fold_log(log: DataFrame, *kept: str) -> DataFrame:
    """Last known values per train number, date and station (and the further keys `kept`).

    Needs no schedule, so it can run before any join: a train that much of the feed is about
    is down to a few rows per task before the shuffle.
    """
    itself = (F.col("station") == "").cast("int")
    return fold_last(log, [*MATCH, "station", *kept], [*STATION_VALUES, "trip_status", "polled_at"], itself)


def orient_fold(folded: DataFrame, trips: DataFrame, stations: DataFrame) -> DataFrame:
    """Folded feed values as one update per slot of the schedule."""
    ends = known_slots(trips, stations).select(
        *SLOT,
        F.inline(
            F.array(
                F.struct(F.lit("departure").alias("role"), F.col("departure_station_name").alias("station")),
                F.struct(F.lit("arrival").alias("role"), F.col("arrival_station_name").alias("station")),
                F.struct(F.lit("journey").alias("role"), F.lit("").alias("station")),
            )
        ),
    )

    def at(role: str, column: str) -> Column:
        return F.max(F.when(F.col("role") == role, F.col(column)))

    return (
        ends.join(folded, [*MATCH, "station"])
        .groupBy(*SLOT)
        .agg(
            at("departure", "expected_departure").alias("siri_departure_time_real"),
            at("departure", "platform").alias("siri_departure_platform"),
            at("departure", "call_status").alias("siri_departure_status"),
            at("arrival", "expected_arrival").alias("siri_arrival_time_real"),
            at("arrival", "platform").alias("siri_arrival_platform"),
            at("arrival", "call_status").alias("siri_arrival_status"),
            at("journey", "trip_status").alias("siri_trip_status"),
            at("journey", "polled_at").alias("siri_updated_at"),
            at("journey", "n_updates").alias("n_updates"),
        )
    )


def fold_feed(journeys: DataFrame, trips: DataFrame, stations: DataFrame) -> DataFrame:
    """What `fold_updates` makes of `build_updates`, folding before the schedule join."""
    return orient_fold(fold_log(feed_log(journeys, stations)), near_feed(trips, journeys), stations)


def near_feed(trips: DataFrame, journeys: DataFrame) -> DataFrame:
    """Of the stored trip table, the departure days that the feed is about; other trips as they are.

    The bounds come from the feed and select partitions when the query runs.
    """
    if not has_departure_day(trips) or journeys.isStreaming:
        return trips
    days = journeys.select("departure_date")
    first, last = (days.agg(f("departure_date")).scalar() for f in (F.min, F.max))
    return trips.filter(F.col(DEPARTURE_DAY.name).between(first, last))


def schedule_slots(trips: DataFrame) -> DataFrame:
    """Scheduled trips per train number, departure date and direction, with their number.

    Updates depend on this slot only, not on the single trip: matching journeys with slots
    keeps the result linear where several trips share a train number.
    """
    return with_departure_date(trips).groupBy(*SLOT).agg(F.count(F.lit(1)).alias("n_trips"))


def known_slots(trips: DataFrame, stations: DataFrame) -> DataFrame:
    """Slots between listed stations, with the feed's stop ids of both."""
    by_name = stations.select("station_name", "siri_stop_id")
    return (
        schedule_slots(trips)
        .join(by_name.toDF("departure_station_name", "departure_stop"), "departure_station_name")
        .join(by_name.toDF("arrival_station_name", "arrival_stop"), "arrival_station_name")
    )


def journey_match(journeys: DataFrame, trips: DataFrame) -> DataFrame:
    """Valid journeys that have scheduled trips, with the number of trips they concern."""
    near = near_feed(trips, journeys)
    scheduled = schedule_slots(near).groupBy(*MATCH).agg(F.sum("n_trips").alias("n_trips"))
    return journeys.join(scheduled, MATCH)


def build_updates(journeys: DataFrame, trips: DataFrame, stations: DataFrame) -> DataFrame:
    """One update per valid journey and direction of its scheduled trips.

    Departure values come from the last call at the departure station, arrival values from
    the last call at the arrival station; trips between unlisted stations get no update.
    """
    slots = known_slots(near_feed(trips, journeys), stations)
    return oriented_updates(journeys.join(slots, MATCH))


def oriented_updates(matched: DataFrame) -> DataFrame:
    """Journeys that have met a slot (`known_slots`), as updates of it."""
    ordered = F.concat("estimated_calls", "recorded_calls")

    def last_call(stop: str) -> Column:
        return F.try_element_at(
            F.filter(ordered, lambda c: c["StopPointRef"] == F.col(stop)), F.lit(-1)
        )

    picked = matched.withColumns(
        {"at_departure": last_call("departure_stop"), "at_arrival": last_call("arrival_stop")}
    )
    departure, arrival = F.col("at_departure"), F.col("at_arrival")
    return picked.select(
        *SLOT,
        "n_trips",
        iso_time(departure["ExpectedDepartureTime"]).alias("siri_departure_time_real"),
        call_platform(departure).alias("siri_departure_platform"),
        F.when(departure.isNotNull(), call_status(departure)).alias("siri_departure_status"),
        iso_time(arrival["ExpectedArrivalTime"]).alias("siri_arrival_time_real"),
        call_platform(arrival).alias("siri_arrival_platform"),
        F.when(arrival.isNotNull(), call_status(arrival)).alias("siri_arrival_status"),
        F.col("trip_status").alias("siri_trip_status"),
        F.col("polled_at").alias("siri_updated_at"),
        F.col("feed_seq").alias("seq"),
    )


def feed_counters(journeys: DataFrame, trips: DataFrame, stations: DataFrame) -> DataFrame:
    """Counters of one feed run, as one row; `journeys` may include invalid ones.

    Journeys and calls are counted per train number and date in one pass; only these counts
    meet the schedule, never journey-by-trip pairs.
    """
    listed = stations.select("siri_stop_id", "station_name")
    per_key = (
        journeys.select(
            F.nullif("train_number", F.lit("")).alias("trip_headsign"),
            _journey_day().alias("departure_date"),
            F.posexplode_outer(
                F.concat("estimated_calls.StopPointRef", "recorded_calls.StopPointRef")
            ).alias("call_position", "siri_stop_id"),
        )
        .join(listed, "siri_stop_id", "left")
        .groupBy(*MATCH)
        .agg(
            F.count_if(F.coalesce(F.col("call_position"), F.lit(0)) == 0).alias("journeys"),
            F.count("station_name").alias("calls"),
        )
    )
    known = F.coalesce(F.col("from_known") & F.col("to_known"), F.lit(False))

    def flagged(end: str, flag: str) -> DataFrame:
        return stations.select(F.col("station_name").alias(end), F.lit(True).alias(flag))

    dated = journeys.select(_journey_day().alias("departure_date"))
    scheduled = (
        schedule_slots(near_feed(trips, dated))
        .join(flagged("departure_station_name", "from_known"), "departure_station_name", "left")
        .join(flagged("arrival_station_name", "to_known"), "arrival_station_name", "left")
        .groupBy(*MATCH)
        .agg(F.sum(F.when(known, F.col("n_trips")).otherwise(0)).alias("n_known"))
    )
    hit = F.col("n_known").isNotNull()

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0)).cast("bigint")

    return per_key.join(scheduled, MATCH, "left").agg(
        total(F.col("journeys")).alias("journeys_seen"),
        total(F.when(hit, F.col("journeys"))).alias("journeys_matched"),
        total(F.when(hit, F.col("calls"))).alias("station_calls"),
        total(F.col("journeys") * F.col("n_known")).alias("updates"),
        total(F.col("n_known")).alias("trips_updated"),
    )


def unmatched_journeys(journeys: DataFrame, trips: DataFrame) -> DataFrame:
    """Valid journeys without any scheduled trip."""
    scheduled = schedule_slots(near_feed(trips, journeys)).select(*MATCH).distinct()
    return journeys.join(scheduled, MATCH, "left_anti")
