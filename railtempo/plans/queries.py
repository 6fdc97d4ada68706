"""Registered queries: every operator over the shared test tables.

Results carry dates and timestamps as ISO text, so that two engines' values compare equal
whatever types their client libraries map them to.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railtempo.functions.delay import with_delay
from railtempo.functions.labels import numeric_stop_id, platform_label
from railtempo.functions.times import iso_time, service_time, wall_clock
from railtempo.operators import board, filters, gtfs_rt, realtime, schedule, statistics, updates
from railtempo.plans import tables as t
from railtempo.schema import GTFS_RT_COLUMNS
from railtempo.session import work_path
from railtempo.sources import gtfs as gtfs_files
from railtempo.sources import gtfs_rt as gtfs_rt_files
from railtempo.sources import reports, siri, trip_table
from railtempo.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RANGE_START, RANGE_END = date(2024, 1, 8), date(2024, 1, 21)
#: Journeys of one task where a stream deals them out, beyond the number of cores.
ROWS_PER_PART = 500_000
VALUES = [*updates.REALTIME_COLUMNS, "siri_updated_at"]


def portable(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text."""
    patterns = {
        T.DateType: "yyyy-MM-dd",
        T.TimestampType: "yyyy-MM-dd HH:mm:ss",
        T.TimestampNTZType: "yyyy-MM-dd HH:mm:ss",
    }
    return df.withColumns(
        {
            f.name: F.date_format(f.name, patterns[type(f.dataType)])
            for f in df.schema.fields
            if type(f.dataType) in patterns
        }
    )


def query(fn: Query) -> Query:
    """Register a query under its function name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(fn(spark, sf_dir))

    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__.removesuffix("_query")] = run
    return run


# --- filters and scalar expressions on trips ----------------------------------------------


@query
def delay_class(spark, sf):
    return with_delay(t.trips(spark, sf)).select(
        "trip_id", "delay_seconds", "is_cancelled", "delay_class"
    )


@query
def delay_minutes(spark, sf):
    return board.with_times(t.trips(spark, sf)).select(
        "trip_id",
        board.in_minutes("departure_delay_seconds").alias("departure_delay_minutes"),
        board.in_minutes("arrival_delay_seconds").alias("arrival_delay_minutes"),
    )


@query
def trip_durations(spark, sf):
    return board.with_times(t.trips(spark, sf)).select(
        "trip_id", "duration_scheduled_minutes", "duration_real_minutes"
    )


@query
def trip_count(spark, sf):
    return t.trips(spark, sf).agg(F.count(F.lit(1)).alias("n_trips"))


@query
def cancelled_trips(spark, sf):
    return filters.cancelled_trips(t.trips(spark, sf)).select(
        "trip_id", "service_date", "siri_departure_status", "siri_arrival_status"
    )


def _filtered(spark, sf, start, end):
    return filters.date_filter(t.trips(spark, sf), start, end).select(
        "trip_id", "departure_time_scheduled"
    )


@query
def date_filter_between(spark, sf):
    return _filtered(spark, sf, RANGE_START, RANGE_END)


@query
def date_filter_from(spark, sf):
    return _filtered(spark, sf, RANGE_START, None)


@query
def date_filter_until(spark, sf):
    return _filtered(spark, sf, None, RANGE_END)


@query
def date_range(spark, sf):
    return filters.date_range(t.trips(spark, sf))


# --- statistics ---------------------------------------------------------------------------


@query
def delay_stats_global(spark, sf):
    return statistics.global_stats(t.trips(spark, sf))


@query
def delay_stats_by_direction(spark, sf):
    return statistics.stats_by_direction(t.trips(spark, sf))


@query
def delay_stats_by_date(spark, sf):
    return statistics.stats_by_date(t.trips(spark, sf))


@query
def delay_stats_weekly(spark, sf):
    return statistics.stats_by_week(t.trips(spark, sf))


@query
def delay_timeline_auto(spark, sf):
    return statistics.timeline(t.trips(spark, sf))


@query
def preset_week_stats(spark, sf):
    return statistics.global_stats(filters.preset_filter(t.trips(spark, sf), "week", t.AS_OF))


@query
def preset_month_stats(spark, sf):
    return statistics.global_stats(filters.preset_filter(t.trips(spark, sf), "month", t.AS_OF))


def _profile(spark, sf):
    return statistics.timetable_profile(t.trips(spark, sf))


@query
def delay_stats_by_line(spark, sf):
    return statistics.stats_by_line(_profile(spark, sf))


@query
def avg_delay_by_line(spark, sf):
    return statistics.average_delay(_profile(spark, sf))


@query
def line_common_times(spark, sf):
    return statistics.common_times(_profile(spark, sf))


@query
def line_weekdays(spark, sf):
    return statistics.line_weekdays(_profile(spark, sf)).select("line", "jours")


@query
def line_weekday_ranges(spark, sf):
    return statistics.line_weekdays(_profile(spark, sf)).select("line", "day_ranges")


@query
def line_report(spark, sf):
    return statistics.line_report(_profile(spark, sf))


@query
def delay_stack_offsets(spark, sf):
    return statistics.stack_offsets(statistics.daily_counts(t.trips(spark, sf)), ["date"])


@query
def delay_share_segments(spark, sf):
    lines = statistics.stats_by_line(_profile(spark, sf))
    return statistics.share_segments(lines, ["line"])


@query
def report_json(spark, sf):
    """The line report written as JSON and read back."""
    report = statistics.line_report(_profile(spark, sf))
    path = work_path(spark, "line-report")
    reports.write_report(report, path)
    return reports.read_report(spark, path, report.schema)


# --- board --------------------------------------------------------------------------------


@query
def live_board(spark, sf):
    return board.live_board(t.trips(spark, sf), t.AS_OF)


@query
def trip_text_labels(spark, sf):
    return board.trip_labels(t.trips(spark, sf))


@query
def feed_freshness(spark, sf):
    return board.feed_freshness(t.trips(spark, sf), t.NOW)


@query
def past_trip_flag(spark, sf):
    """The day's trips after its feed run, against the latest update of the whole table."""
    current = _upserted(spark, sf)
    return board.past_trips(filters.on_day(current, t.AS_OF), current).select(
        "trip_id", "siri_updated_at", "is_past"
    )


# --- schedule -----------------------------------------------------------------------------


@query
def gtfs_scan(spark, sf):
    """All four GTFS tables written as CSV and read back."""
    folder = work_path(spark, "gtfs")
    for name, df in t.gtfs(spark, sf).items():
        gtfs_files.write_table(df, folder, name)
    rows = []
    for name, fields in gtfs_files.GTFS.items():
        content = F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in fields.fieldNames()])
        rows.append(
            gtfs_files.read_table(spark, folder, name).select(
                F.lit(name).alias("table_name"), content.alias("content")
            )
        )
    out = rows[0]
    for df in rows[1:]:
        out = out.unionByName(df)
    return out


@query
def active_services(spark, sf):
    return schedule.active_services(t.gtfs(spark, sf)["calendar_dates"])


@query
def service_day_trips(spark, sf):
    g = t.gtfs(spark, sf)
    services = schedule.active_services(g["calendar_dates"])
    return schedule.service_day_trips(g["stop_times"], g["trips"], services)


@query
def trips_with_route(spark, sf):
    g = t.gtfs(spark, sf)
    return schedule.with_route(g["trips"], g["routes"])


@query
def corridor_trips(spark, sf):
    stops = t.gtfs(spark, sf)["stop_times"]
    return schedule.corridor_trips(stops, t.stations(spark), t.corridors(spark))


@query
def corridor_trips_multi(spark, sf):
    stops = t.gtfs(spark, sf)["stop_times"]
    return schedule.corridor_trips(stops, t.all_stations(spark), t.many_corridors(spark))


@query
def gtfs_service_time(spark, sf):
    day = F.lit(t.AS_OF)
    return t.gtfs(spark, sf)["stop_times"].select(
        "trip_id",
        "stop_sequence",
        service_time(day, F.col("arrival_time")).alias("arrival"),
        service_time(day, F.col("departure_time")).alias("departure"),
    )


def _schedule(spark, sf, created_at=t.LOADED_AT, days=None):
    return schedule.build_schedule(
        t.gtfs(spark, sf), t.stations(spark), t.corridors(spark), created_at, days
    )


SCHEDULE_COLUMNS = [
    "trip_id",
    "route_id",
    "route_short_name",
    "trip_headsign",
    "departure_station_name",
    "departure_time_scheduled",
    "arrival_station_name",
    "arrival_time_scheduled",
    "created_at",
    "siri_updated_at",
    "service_date",
]


@query
def schedule_load(spark, sf):
    """Every day's schedule written to the trip table and read back."""
    path = work_path(spark, "trips")
    trip_table.write_days(_schedule(spark, sf), path)
    return trip_table.read_trip_table(spark, path).select(*SCHEDULE_COLUMNS)


@query
def schedule_append_new_days(spark, sf):
    """A first load up to the as-of day, then a second one that adds only missing days."""
    path = work_path(spark, "trips")
    trip_table.create_versioned(spark, path)
    first = _schedule(spark, sf).filter(F.col("service_date") <= F.lit(t.AS_OF))
    trip_table.write_days(first, path)
    again = _schedule(spark, sf, t.RELOADED_AT)
    trip_table.write_days(
        trip_table.new_days(again, trip_table.read_trip_table(spark, path)), path
    )
    return trip_table.read_trip_table(spark, path).select(*SCHEDULE_COLUMNS)


@query
def schedule_load_guard(spark, sf):
    """One day loaded, and loaded again, which is refused and changes nothing."""
    path = work_path(spark, "trips")
    for created_at in (t.LOADED_AT, t.RELOADED_AT):
        try:
            trip_table.load_day(_schedule(spark, sf, created_at, t.AS_OF), path, t.AS_OF)
        except trip_table.DayAlreadyLoaded:
            if created_at == t.LOADED_AT:
                raise
    return trip_table.read_trip_table(spark, path).select(*SCHEDULE_COLUMNS)


@query
def trips_scan(spark, sf):
    """Trip table written, then read with the columns that matching needs."""
    path = work_path(spark, "trips")
    trip_table.write_days(t.trips(spark, sf), path)
    return trip_table.read_trip_table(spark, path).select(
        "trip_id",
        "departure_station_name",
        "arrival_station_name",
        "departure_time_scheduled",
        "arrival_time_scheduled",
        "trip_headsign",
        "service_date",
    )


# --- SIRI-ET ------------------------------------------------------------------------------


def _valid(spark, sf):
    return realtime.valid_journeys(t.journeys(spark, sf))


def _scanned(journeys: DataFrame) -> DataFrame:
    def text(calls: str):
        def fields(c):
            return F.concat_ws("|", *[F.coalesce(c[f], F.lit("~")) for f in siri.SIRI_CALL.names])

        return F.array_join(F.transform(calls, fields), ";")

    return journeys.select(
        "journey_ref",
        "train_number",
        "journey_date",
        "monitored",
        "prediction_inaccurate",
        text("recorded_calls").alias("recorded_calls"),
        text("estimated_calls").alias("estimated_calls"),
        "polled_at",
    )


@query
def siri_scan(spark, sf):
    """Journeys written as SIRI-ET XML and read back."""
    path = work_path(spark, "siri")
    siri.write_snapshot(t.journeys(spark, sf), path)
    return _scanned(siri.read_journeys(spark, path))


@query
def siri_scan_split(spark, sf):
    """The same, with files read by as many tasks as they have splits."""
    path = work_path(spark, "siri")
    siri.write_snapshot(t.journeys(spark, sf), path)
    return _scanned(siri.read_journeys(spark, path, split=True))


@query
def siri_valid_journeys(spark, sf):
    return _valid(spark, sf).select("journey_ref", "train_number", "journey_date")


@query
def siri_trip_status(spark, sf):
    return _valid(spark, sf).select("journey_ref", "trip_status")


@query
def siri_calls(spark, sf):
    return realtime.calls(_valid(spark, sf)).select(
        "journey_ref", "call_position", "call_kind", "siri_stop_id"
    )


@query
def siri_station_calls(spark, sf):
    calls = realtime.calls(_valid(spark, sf))
    return realtime.station_calls(calls, t.stations(spark)).select(
        "journey_ref", "call_position", "station_name"
    )


@query
def siri_call_status(spark, sf):
    return realtime.calls(_valid(spark, sf)).select("journey_ref", "call_position", "call_status")


@query
def platform_label_query(spark, sf):
    return realtime.calls(_valid(spark, sf)).select(
        "journey_ref",
        "call_position",
        "platform",
        platform_label(F.col("platform")).alias("platform_label"),
    )


@query
def siri_timestamp(spark, sf):
    """Every expected time of the feed, as text and as time."""
    both = F.concat("estimated_calls", "recorded_calls")
    texts = t.journeys(spark, sf).select(
        "journey_ref", F.posexplode(F.transform(both, lambda c: c["ExpectedDepartureTime"]))
    )
    return texts.select(
        "journey_ref",
        F.col("pos").alias("call_position"),
        F.col("col").alias("feed_text"),
        iso_time(F.col("col")).alias("feed_time"),
    )


@query
def siri_station_fold(spark, sf):
    return realtime.station_values(_valid(spark, sf), t.stations(spark)).select(
        "journey_ref",
        "station_name",
        "expected_departure",
        "expected_arrival",
        "platform",
        "call_status",
    )


@query
def journey_match(spark, sf):
    return realtime.journey_match(_valid(spark, sf), t.trips(spark, sf)).select(
        "journey_ref", "train_number", "journey_date", "n_trips"
    )


@query
def journeys_unmatched(spark, sf):
    return realtime.unmatched_journeys(_valid(spark, sf), t.trips(spark, sf)).select(
        "journey_ref", "train_number", "journey_date"
    )


def _updates(spark, sf):
    return realtime.build_updates(_valid(spark, sf), t.trips(spark, sf), t.stations(spark))


@query
def trip_update_build(spark, sf):
    return _updates(spark, sf)


def _folded(spark, sf):
    return realtime.fold_feed(_valid(spark, sf), t.trips(spark, sf), t.stations(spark))


@query
def update_fold(spark, sf):
    return _folded(spark, sf)


@query
def schedule_without_update(spark, sf):
    return updates.without_update(
        t.trips(spark, sf), _folded(spark, sf), updates.SLOT
    ).select("trip_id", "trip_headsign", "service_date")


@query
def feed_counters(spark, sf):
    return realtime.feed_counters(
        t.journeys(spark, sf), t.trips(spark, sf), t.stations(spark)
    )


def _upserted(spark, sf):
    """T written as the trip table, then updated from the whole feed."""
    path = work_path(spark, "trips")
    trip_table.create_versioned(spark, path)
    trip_table.write_days(t.trips(spark, sf), path)
    trip_table.upsert(spark, path, _folded(spark, sf), updates.SLOT)
    return trip_table.read_trip_table(spark, path)


@query
def trips_upsert(spark, sf):
    return _upserted(spark, sf).select("trip_id", "service_date", *VALUES)


# --- GTFS-RT ------------------------------------------------------------------------------


def _entities(spark, sf):
    path = work_path(spark, "gtfs-rt")
    gtfs_rt_files.write_entities(t.entities(spark, sf), path)
    return gtfs_rt.entity_rows(gtfs_rt_files.read_entities(spark, path))


@query
def gtfs_rt_updates(spark, sf):
    """Decoded entities written as JSON, read back and oriented by the schedule."""
    return gtfs_rt.trip_updates(_entities(spark, sf), t.runs(spark, sf), t.stations(spark))


def _rt_folded(spark, sf, trips):
    rows = gtfs_rt.entity_rows(t.entities(spark, sf))
    ordered = rows.withColumn("seq", F.split_part("entity_id", F.lit("-"), F.lit(2)).cast("bigint"))
    return gtfs_rt.fold_trip_updates(ordered, trips, t.stations(spark))


@query
def gtfs_rt_fold(spark, sf):
    """Last known GTFS-RT values per run of a trip."""
    return _rt_folded(spark, sf, t.runs(spark, sf))


@query
def gtfs_rt_upsert(spark, sf):
    """The runs written as the trip table, then updated from GTFS-RT."""
    path = work_path(spark, "trips")
    trip_table.create_versioned(spark, path)
    trip_table.write_days(t.runs(spark, sf), path)
    folded = _rt_folded(spark, sf, trip_table.read_trip_table(spark, path))
    update = gtfs_rt.as_update(folded, wall_clock(t.NOW))
    trip_table.upsert(spark, path, update, updates.RUN)
    current = trip_table.read_trip_table(spark, path)
    return current.select("trip_id", "service_date", *VALUES, *GTFS_RT_COLUMNS)


@query
def gtfs_rt_known_trips(spark, sf):
    rows = gtfs_rt.entity_rows(t.entities(spark, sf))
    return gtfs_rt.known_trips(rows, t.runs(spark, sf)).select(
        "entity_id", "trip_id", "trip_schedule_relationship"
    )


@query
def stop_id_clean(spark, sf):
    rows = gtfs_rt.entity_rows(t.entities(spark, sf))
    stops = rows.select("entity_id", F.posexplode("stop_time_update").alias("stop_position", "s"))
    return stops.select(
        "entity_id", "stop_position", numeric_stop_id(F.col("s.stop_id")).alias("stop_number")
    )


# --- streaming ----------------------------------------------------------------------------


def _run(writer, spark, name):
    jobs.start(writer, work_path(spark, f"{name}-progress"), available_now=True).awaitTermination()


def _appended(stream: DataFrame, spark, name) -> DataFrame:
    path = work_path(spark, name)
    _run(stream.writeStream.format("parquet").option("path", path).outputMode("append"), spark, name)
    return spark.read.schema(stream.schema).parquet(path)


def _journey_stream(spark, sf):
    """In even partitions, as `tables.lines`: the one file that arrives is one split. Their number grows with the table."""
    n = max(spark.sparkContext.defaultParallelism, t.table(spark, sf, "lineitem").count() // ROWS_PER_PART)
    return t.journeys_of(t.table_stream(spark, sf, "lineitem").repartition(n))


@query
def stream_siri_ingest(spark, sf):
    """XML snapshots as a stream, down to one row per journey and station."""
    landing = work_path(spark, "siri")
    siri.write_snapshot(t.journeys(spark, sf), landing)
    stream = jobs.station_value_stream(siri.stream_journeys(spark, landing), t.stations(spark))
    return _appended(
        stream.select(
            "journey_ref",
            "station_name",
            "expected_departure",
            "expected_arrival",
            "platform",
            "call_status",
            "trip_status",
        ),
        spark,
        "station-values",
    )


@query
def stream_operating_hours(spark, sf):
    events = t.table_stream(spark, sf, "events")
    kept = jobs.operating_hours(events, F.col("ts"))
    return _appended(kept.select("event_id", "ts"), spark, "operating-hours")


@query
def stream_schedule_join(spark, sf):
    """Feed and schedule as streams: the later days are loaded when all journeys have come, and meet them all the same."""
    landing, path = work_path(spark, "slots"), work_path(spark, "update-log")
    progress, sink = work_path(spark, "update-log-progress"), jobs.updates_sink(spark, path)
    trips, day = t.trips(spark, sf), filters.departure_date()
    for loaded in (trips.filter(day <= F.lit(t.AS_OF)), trips.filter(day > F.lit(t.AS_OF))):
        jobs.publish_slots(loaded, t.stations(spark), landing)
        journeys, slots = _journey_stream(spark, sf), jobs.slot_stream(spark, landing)
        both = jobs.feed_and_schedule(journeys, slots)
        jobs.start(both.writeStream.foreachBatch(sink), progress, available_now=True).awaitTermination()
    return jobs.kept_updates(spark, path, jobs.renewing_update_stream(journeys, slots).schema)


@query
def stream_update_fold(spark, sf):
    """The running fold, kept in the state store, and what its sink has written, matched with the schedule."""
    path = work_path(spark, "update-fold")
    folded = jobs.running_fold(_journey_stream(spark, sf), t.stations(spark))
    sink = jobs.running_sink(spark, path)
    _run(folded.writeStream.foreachBatch(sink).outputMode("update"), spark, "fold")
    newest = jobs.running_result(spark, path, folded.schema)
    return realtime.orient_fold(newest, t.trips(spark, sf), t.stations(spark))


@query
def stream_daily_delay(spark, sf):
    trips = t.trips_of(t.table_stream(spark, sf, "events"))
    path = work_path(spark, "daily-delay")
    daily = jobs.running_daily_delay(trips)
    _run(daily.writeStream.foreachBatch(jobs.batches_to(path)).outputMode("complete"), spark, "daily")
    return jobs.newest_batch(spark, path)


@query
def stream_daily_updates(spark, sf):
    """Trips arrive as scheduled, two thirds again with their real times, and some once more as they first were."""
    landing, path = work_path(spark, "trip-rows"), work_path(spark, "daily-updates")
    progress, known = work_path(spark, "daily-updates-progress"), t.trips(spark, sf)
    sink = jobs.daily_sink(spark, path)
    number = F.substring("trip_id", 6, 20).cast("bigint")
    blank = {c: F.lit(None).cast(known.schema[c].dataType) for c in known.columns if c.startswith("siri_")}
    first = known.withColumns(blank)
    for seq, rows in ((1, first), (2, known.filter(number % 3 != 0)), (1, first.filter(number % 5 == 0))):
        rows.withColumn("seq", F.lit(seq).cast("bigint")).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(T.StructType([*known.schema, T.StructField("seq", T.LongType())])).parquet(landing)
        jobs.start(stream.writeStream.foreachBatch(sink), progress, available_now=True).awaitTermination()
    return jobs.daily_result(spark, path)


def _deliveries(journeys: DataFrame) -> DataFrame:
    return journeys.select(
        "journey_ref", "train_number", F.col("polled_at").cast("timestamp").alias("polled_at")
    )


@query
def stream_update_dedup(spark, sf):
    """Every journey polled twice, and each poll delivered twice; each poll is kept once."""
    stream = _deliveries(_journey_stream(spark, sf))
    polls = stream.withColumn("later", F.explode(F.array(F.lit(0), F.lit(2))))
    polls = polls.withColumn("polled_at", F.timestamp_add("MINUTE", F.col("later"), "polled_at"))
    twice = polls.withColumn("delivery", F.explode(F.sequence(F.lit(1), F.lit(2)))).drop("later", "delivery")
    path = work_path(spark, "unique-journeys")
    sink = jobs.deliveries_sink(spark, path, jobs.POLLED, "polled_at")
    _run(twice.writeStream.foreachBatch(sink), spark, "unique-journeys")
    return jobs.kept_deliveries(spark, path, twice.schema)


@query
def stream_late_updates(spark, sf):
    """Journeys with open lines arrive first, the others after them.

    The second run drops what lies at or before the watermark that the first one reached.
    """
    landing, path = work_path(spark, "deliveries"), work_path(spark, "in-time")
    progress = work_path(spark, "in-time-progress")
    sink = jobs.deliveries_sink(spark, path, jobs.POLLED, "polled_at", jobs.LATE_LIMIT)
    lines = t.table(spark, sf, "lineitem")

    def deliver(status: str) -> None:
        arrived = t.journeys_of(lines.filter(F.col("l_linestatus") == status))
        _deliveries(arrived).write.mode("append").parquet(landing)
        schema = _deliveries(arrived).schema
        stream = spark.readStream.schema(schema).parquet(landing)
        jobs.start(stream.writeStream.foreachBatch(sink), progress, available_now=True).awaitTermination()

    deliver("O")
    deliver("F")
    return jobs.kept_deliveries(spark, path, _deliveries(t.journeys_of(lines)).schema)


@query
def bootstrap_day(spark, sf):
    """Feed of many days meets an empty trip table: their schedules are loaded, then updated."""
    path = work_path(spark, "trips")
    trip_table.create_versioned(spark, path)
    sink = jobs.upsert_batches(
        spark,
        path,
        lambda days: _schedule(spark, sf, days=days),
        t.stations(spark),
        days_back=schedule.days_back(t.gtfs(spark, sf)["stop_times"]),
    )
    _run(_journey_stream(spark, sf).writeStream.foreachBatch(sink), spark, "bootstrap")
    return trip_table.read_trip_table(spark, path).select(*SCHEDULE_COLUMNS, *VALUES[:-1])
