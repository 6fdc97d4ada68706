"""Domain tables derived from the shared test tables.

Each view is a row-by-row projection (the calendar and the routes are distinct projections),
so its size and key space grow with the tables. Train numbers are one per hundred orders or
one per user: a train number and date always has a handful of trips and journeys.
`plans.reference_sql` states the same views in SQL.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railtempo.schema import CORRIDORS, GTFS_RT_ENTITY, STATIONS, TRIPS, parameter_table

FIRST_DAY = "2024-01-01"
AS_OF = date(2024, 1, 15)
NOW = datetime(2024, 1, 31, 1, 30)
LOADED_AT = datetime(2024, 1, 1, 3, 23)
RELOADED_AT = datetime(2024, 1, 16, 3, 23)

PAIR = ("Paris Nord", "Compiègne")
#: Stations 0-9; 1 and 2 are the ends of the main corridor.
STATION_ROWS = [
    (PAIR[i - 1] if i in (1, 2) else f"Gare {i}", f"stop_{i}", f"S{i}") for i in range(10)
]
MANY_CORRIDORS = [PAIR, ("Gare 3", "Gare 4"), ("Compiègne", "Gare 5"), ("Gare 7", "Gare 9"), ("Gare 0", "Gare 6")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table as a stream; the glob lets the source accept a single file."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir.rstrip('/')}/{name}.parque[t]")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line items, in even partitions: turning one into a feed record costs much, and a file may be one split.

    The lines of a train (a hundred orders) lie together, so folds leave few rows before their first shuffle. Dealing by
    a key also needs no sort, which a round robin does. Adaptive execution splits the partition of a hot train.
    """
    dealt = table(spark, sf_dir, "lineitem").withColumn("hundred", _div("l_orderkey", 100))
    return dealt.hint("rebalance", "hundred").drop("hundred")


def stations(spark: SparkSession) -> DataFrame:
    """The two stations of the main corridor."""
    return parameter_table(spark, STATION_ROWS[1:3], STATIONS)


def all_stations(spark: SparkSession) -> DataFrame:
    return parameter_table(spark, STATION_ROWS, STATIONS)


def corridors(spark: SparkSession) -> DataFrame:
    return parameter_table(spark, [PAIR], CORRIDORS)


def many_corridors(spark: SparkSession) -> DataFrame:
    return parameter_table(spark, MANY_CORRIDORS, CORRIDORS)


def _plus(ts: Column, minutes: Column | None = None, seconds: Column | None = None) -> Column:
    if minutes is not None:
        return F.timestamp_add("MINUTE", minutes, ts)
    return F.timestamp_add("SECOND", seconds, ts)


def _midnight(day: Column) -> Column:
    return day.cast("timestamp_ntz")


def _div(a: str, b: int) -> Column:
    return F.expr(f"{a} div {b}")


# --- trips, from events -------------------------------------------------------------------


def trips_of(events: DataFrame) -> DataFrame:
    """Trip table rows, one per event (batch or stream)."""
    user, event, value = F.col("user_id"), F.col("event_id"), F.col("value")
    kind = F.col("event_type")
    day = F.to_date("ts")
    minute = user * 37 % 960 + 300 + F.when(event % 5 == 0, 1).otherwise(0)
    departure = _plus(_midnight(day), minute)
    arrival = _plus(_midnight(day), minute + 50 + user % 31)
    delay = F.floor(value * 20) - 240
    known = ~((kind == "signup") & (value < 25))
    forward = user % 2 == 0
    weekday = F.weekday(day)
    shift = (
        F.when(user % 4 == 1, F.call_function("div", weekday, F.lit(3)))
        .when(user % 4 == 2, weekday % 3)
        .when(user % 4 == 3, F.call_function("div", weekday, F.lit(2)) % 2)
        .otherwise(0)
    )
    route = F.concat(F.lit("K"), ((user + shift) % 7).cast("string"))
    real_arrival = F.when(known, _plus(arrival, seconds=delay))
    columns = {
        "trip_id": F.concat(F.lit("trip_"), event.cast("string")),
        "route_id": F.concat(F.lit("route_"), route),
        "route_short_name": route,
        "trip_headsign": user.cast("string"),
        "departure_station_name": F.when(forward, PAIR[0]).otherwise(PAIR[1]),
        "departure_time_scheduled": departure,
        "siri_departure_time_real": F.when(
            known, _plus(departure, seconds=F.call_function("div", delay, F.lit(2)))
        ),
        "siri_departure_status": F.when((kind == "error") & (value < 15), "CANCELLED")
        .when(kind == "click", F.lit(None))
        .otherwise("NORMAL"),
        "arrival_station_name": F.when(forward, PAIR[1]).otherwise(PAIR[0]),
        "arrival_time_scheduled": arrival,
        "siri_arrival_time_real": real_arrival,
        "siri_arrival_platform": F.when(event % 3 == 0, F.concat(F.lit("Hall "), (event % 4).cast("string"))),
        "siri_arrival_status": F.when(
            (kind == "error") & (value >= 15) & (value < 25), "CANCELLED"
        ).otherwise("NORMAL"),
        "created_at": _plus(_midnight(day), F.lit(203)),
        "siri_updated_at": real_arrival,
        "service_date": day,
    }
    return events.select(
        *[
            columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in TRIPS.fields
        ]
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_of(table(spark, sf_dir, "events"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same trips under ids that recur on other days; some run past midnight, or only after it."""
    number = F.substring("trip_id", 6, 20).cast("bigint") % 5000
    later = F.when(number % 4 == 0, 600).otherwise(0)
    ends = ("departure_time_scheduled", "arrival_time_scheduled")
    return trips(spark, sf_dir).withColumns(
        {"trip_id": _numbered("trip_", number), **{c: _plus(F.col(c), later) for c in ends}}
    )


# --- GTFS, from orders and lineitem -------------------------------------------------------


def _train(order_key: str) -> Column:
    return _div(order_key, 100).cast("string")


def _day(order_key: str) -> Column:
    return F.date_add(F.lit(FIRST_DAY).cast("date"), (F.col(order_key) % 30).cast("int"))


def _sequence() -> Column:
    """Total order of an order's lines."""
    return (
        F.col("l_linenumber") * F.lit(10**17) + F.col("l_partkey") * 10**6 + F.col("l_suppkey")
    )


def _gtfs_clock(minute: Column) -> Column:
    return F.concat(
        F.lpad(F.call_function("div", minute, F.lit(60)).cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad((minute % 60).cast("string"), 2, "0"),
        F.lit(":00"),
    )


def gtfs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    service = F.lpad(F.col("o_custkey").cast("string"), 6, "0")
    # Times go past 24:00, those of some trips past 48:00.
    late = F.when(F.col("l_orderkey") % 50 == 7, 1440).otherwise(0)
    minute = 300 + F.col("l_linenumber") * 47 + F.col("l_orderkey") % 1000 + late
    return {
        "calendar_dates": orders.select(
            service.alias("service_id"),
            F.date_format(_day("o_orderkey"), "yyyyMMdd").alias("date"),
            F.when(F.col("o_orderkey") % 10 == 0, "2").otherwise("1").alias("exception_type"),
        ).distinct(),
        "trips": orders.select(
            F.col("o_orderpriority").alias("route_id"),
            service.alias("service_id"),
            F.col("o_orderkey").cast("string").alias("trip_id"),
            _train("o_orderkey").alias("trip_headsign"),
        ),
        "routes": orders.filter(F.col("o_orderpriority") != "5-LOW")
        .select(
            F.col("o_orderpriority").alias("route_id"),
            F.concat(F.lit("K0"), F.left("o_orderpriority", F.lit(1))).alias("route_short_name"),
        )
        .distinct(),
        "stop_times": lines.select(
            F.col("l_orderkey").cast("string").alias("trip_id"),
            F.when(F.col("l_partkey") % 29 != 0, _gtfs_clock(minute))
            .otherwise("")
            .alias("arrival_time"),
            F.when(F.col("l_partkey") % 31 != 0, _gtfs_clock(minute + 1))
            .otherwise("")
            .alias("departure_time"),
            F.concat(F.lit("stop_"), (F.col("l_suppkey") % 10).cast("string")).alias("stop_id"),
            _sequence().cast("string").alias("stop_sequence"),
            _sequence().alias("position"),
        ),
    }


# --- SIRI-ET journeys and GTFS-RT entities, from lineitem ---------------------------------


def _iso(minutes: Column) -> Column:
    """Feed text of a clock time on the journey's (winter) day, from `midnight` and minutes.

    Some texts carry +01:00, some are in UTC with Z, some cannot be read.
    """
    shown = _plus(F.col("midnight"), minutes + F.col("utc_shift")).cast("string")
    return F.when(F.col("l_partkey") % 50 == 7, "soon").otherwise(
        F.concat(F.substring_index(shown, " ", 1), F.lit("T"), F.substring_index(shown, " ", -1), F.col("offset"))
    )


def _call(**fields: Column) -> Column:
    order = (
        "StopPointRef",
        "Cancellation",
        "PredictionInaccurate",
        "ExpectedArrivalTime",
        "ArrivalPlatformName",
        "ExpectedDepartureTime",
        "DeparturePlatformName",
    )
    return F.struct(*[fields[name].cast("string").alias(name) for name in order])


def _numbered(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def journeys_of(lines: DataFrame) -> DataFrame:
    """Journeys as `sources.siri` reads them, one per line item (batch or stream)."""
    order, part, supp = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    flag, quantity = F.col("l_returnflag"), F.col("l_quantity").cast("int")
    in_utc = order % 3 == 0
    base = 300 + order % 960 + quantity
    # One text per station keeps the generated code of this view short enough for the JVM
    # to compile.
    first_time, second_time = F.col("first_time"), F.col("second_time")

    first = _call(
        StopPointRef=_numbered("S", supp % 10),
        Cancellation=F.when(
            (flag == "R") & (part % 2 == 0),
            F.when(part % 3 == 0, "").when(part % 3 == 1, "false").otherwise("true"),
        ),
        PredictionInaccurate=F.when((flag == "A") & (part % 5 == 0), "true").when(
            (flag == "A") & (part % 5 == 1), "false"
        ),
        ExpectedArrivalTime=F.when(part % 4 != 0, first_time),
        ArrivalPlatformName=F.when(supp % 6 != 0, _numbered("Voie ", part % 9)),
        ExpectedDepartureTime=F.when(part % 3 != 0, first_time),
        DeparturePlatformName=F.when(flag == "N", F.lit(None))
        .when(part % 17 == 0, "")
        .otherwise(_numbered("Hall ", supp % 4)),
    )
    second = _call(
        StopPointRef=F.when(supp % 37 != 0, _numbered("S", part % 10)),
        Cancellation=F.when(supp % 19 == 0, ""),
        PredictionInaccurate=F.when(supp % 23 == 0, "true"),
        ExpectedArrivalTime=F.when(part % 4 != 1, second_time),
        ArrivalPlatformName=_numbered("Hall ", part % 3),
        ExpectedDepartureTime=F.when(part % 3 != 1, second_time),
        DeparturePlatformName=F.when(part % 2 != 0, _numbered("Quai ", supp % 5)),
    )
    recorded = F.col("l_linestatus") == "F"
    first_call, second_call = F.col("first_call"), F.col("second_call")
    prepared = lines.withColumns(
        {
            "midnight": _midnight(_day("l_orderkey")),
            "utc_shift": F.when(in_utc, -60).otherwise(0),
            "offset": F.when(in_utc, "Z").otherwise("+01:00"),
        }
    ).withColumns({"first_time": _iso(base), "second_time": _iso(base + 50)})
    prepared = prepared.withColumns({"first_call": first, "second_call": second})
    return prepared.select(
        F.concat_ws("-", order, _sequence()).alias("journey_ref"),
        F.when((_div("l_orderkey", 100) + order % 30) % 11 == 0, F.lit(None))
        .when(order % 97 == 1, "")
        .otherwise(_train("l_orderkey"))
        .alias("train_number"),
        F.when(part % 101 != 0, _day("l_orderkey").cast("string")).alias("journey_date"),
        F.when(part % 11 == 0, "false")
        .when(part % 11 == 1, F.lit(None))
        .otherwise("true")
        .alias("monitored"),
        F.when(supp % 7 == 0, "true").when(supp % 7 == 1, "false").alias("prediction_inaccurate"),
        F.when(recorded, F.array(first_call)).otherwise(F.array()).alias("recorded_calls"),
        F.when(recorded, F.array(second_call))
        .otherwise(F.array(first_call, second_call))
        .alias("estimated_calls"),
        _plus(F.col("midnight"), 300 + 2 * F.col("l_linenumber")).alias("polled_at"),
        _sequence().alias("feed_seq"),
    )


def journeys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return journeys_of(lines(spark, sf_dir))


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded GTFS-RT entities, one per line item, for the trips of `runs`; some lack the start date."""
    items = lines(spark, sf_dir)
    part, supp, line = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    # Orders 0 to 29 modulo 30 are of the 30 days from 2024-01-01, in seconds since the epoch.
    start = F.lit(1704067200) + F.col("l_orderkey") % 30 * 86400 + F.col("l_orderkey") % 1440 * 60
    quantity = F.col("l_quantity").cast("bigint")
    cancelled = part % 13 == 0

    def event(offset: int, missing: Column) -> Column:
        return F.when(
            ~cancelled & ~missing,
            F.struct(
                (start + offset + quantity * 60).alias("time"), (quantity * 60).alias("delay")
            ),
        )

    def stop(number: Column, offset: int, absent: int) -> Column:
        return F.struct(
            F.when(number != 9, _numbered("stop_", number)).alias("stop_id"),
            event(offset, part % 3 == absent).alias("departure"),
            event(offset - 60, part % 4 == absent).alias("arrival"),
            F.when(cancelled, "SKIPPED").alias("schedule_relationship"),
        )

    return items.select(
        F.concat_ws("-", "l_orderkey", _sequence()).alias("id"),
        F.struct(
            F.struct(
                _numbered("trip_", F.col("l_orderkey") % 5000).alias("trip_id"),
                _numbered("route_K", line).alias("route_id"),
                F.when(supp % 5 != 0, F.date_format(_day("l_orderkey"), "yyyyMMdd")).alias("start_date"),
                F.when(cancelled, "CANCELED").alias("schedule_relationship"),
            ).alias("trip"),
            F.array(stop(supp % 10, 0, 0), stop(part % 10, 3000, 1)).alias("stop_time_update"),
        ).alias("trip_update"),
    ).select(*[F.col(f.name).cast(f.dataType) for f in GTFS_RT_ENTITY.fields])
