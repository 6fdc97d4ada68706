"""Real-time jobs: snapshots in, trip table and running statistics out.

Each job is one Structured Streaming query. Jobs that publish a whole result per batch write
it to its own `batch=` folder, so a batch that is run again after a failure replaces its own
output and readers take the newest one.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from railtempo.operators import running_counts
from railtempo.operators.realtime import (
    MATCH,
    build_updates,
    feed_log,
    fold_log,
    known_slots,
    orient_fold,
    oriented_updates,
    station_values,
    valid_journeys,
)
from railtempo.operators.statistics import daily_counts
from railtempo.operators.updates import SLOT, last_known
from railtempo.schema import DEPARTURE_DAY
from railtempo.session import delete_path, list_names, path_exists
from railtempo.sources import siri, versions
from railtempo.sources.trip_table import STORED, missing_days, read_trip_table, recover, replace_days, upsert

POLL = "2 minutes"
#: How late a delivery may be, unless a job is told otherwise.
LATE_LIMIT = "1 day"
#: How many days after its departure a train's updates are still taken, and how far ahead of a poll feeds look.
LATE_DAYS = 7
AHEAD_DAYS = 7


def start(writer: DataStreamWriter, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Start polling every two minutes, or process what is there and stop."""
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=POLL).start()


# --- row-wise streams ---------------------------------------------------------------------


def operating_hours(stream: DataFrame, polled_at: Column) -> DataFrame:
    """Keep what is polled from 05:00 to 01:59."""
    hour = F.hour(polled_at)
    return stream.filter((hour >= 5) | (hour <= 1))


def station_value_stream(journeys: DataFrame, stations: DataFrame) -> DataFrame:
    """Snapshots to one row per journey and listed station."""
    return station_values(valid_journeys(journeys), stations)


def update_stream(journeys: DataFrame, trips: DataFrame, stations: DataFrame) -> DataFrame:
    """Journeys matched with the (static) schedule, as an update log.

    The schedule's files are listed when the stream starts; `renewing_update_stream` takes a
    schedule that goes on arriving.
    """
    return build_updates(valid_journeys(journeys), trips, stations)


#: What `publish_slots` writes: the schedule as the stream needs it, a few rows per train and day.
SLOTS = T.StructType(
    [
        T.StructField("trip_headsign", T.StringType()),
        T.StructField("departure_date", T.DateType()),
        T.StructField("departure_station_name", T.StringType()),
        T.StructField("arrival_station_name", T.StringType()),
        T.StructField("n_trips", T.LongType()),
        T.StructField("departure_stop", T.StringType()),
        T.StructField("arrival_stop", T.StringType()),
    ]
)


def publish_slots(trips: DataFrame, stations: DataFrame, path: str) -> None:
    """Add the slots of whole departure days to a folder that a stream reads; each day once, when it is loaded."""
    slots = known_slots(trips.filter(F.col("departure_time_scheduled").isNotNull()), stations)
    slots.select(*SLOTS.fieldNames()).hint("rebalance").write.mode("append").parquet(path)


def slot_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(SLOTS).parquet(path)


def renewing_update_stream(
    journeys: DataFrame,
    slots: DataFrame,
    late_limit: str = "1 day",
    late_days: int = 7,
    ahead_days: int = 7,
) -> DataFrame:
    """Journeys matched with a schedule that arrives as a stream as well, as an update log.

    Whichever of the two comes first waits for the other: a day that is loaded after the
    stream has started is matched with the polls before and after. A poll meets slots that
    depart at most `ahead_days` after it and at most `late_days` before it, so both sides'
    state falls with the watermarks. The older watermark counts: a poll may be `late_limit`
    late, a schedule day `late_days`, and odd dates of one side make nothing of the other old.
    """
    # Always true here. It lets each of these be null, as the state's schema must not depend on whether a batch has
    # files: their metadata is never null, what stands for no files is.
    given = F.col("train_number") != ""
    kept = ["estimated_calls", "recorded_calls", "trip_status", "polled_at", "feed_seq"]
    said = valid_journeys(journeys).withColumn("polled", F.col("polled_at").cast("timestamp"))
    said = said.withColumns({c: F.when(given, F.col(c)) for c in (*kept, "polled")})
    said = said.withWatermark("polled", late_limit).alias("j")
    known = slots.withColumn("departs", F.col("departure_date").cast("timestamp"))
    known = known.withWatermark("departs", f"{late_days} days").alias("s")
    bound = F.expr(
        f"j.polled >= s.departs - INTERVAL {ahead_days} DAYS AND j.polled <= s.departs + INTERVAL {late_days + 1} DAYS"
    )
    same = [F.col(f"j.{c}") == F.col(f"s.{c}") for c in MATCH]
    matched = said.join(known, [*same, bound])
    return oriented_updates(matched.select(*[F.col(f"j.{c}") for c in kept], *[F.col(f"s.{c}") for c in SLOTS.fieldNames()]))


FEED, SCHEDULE = "feed", "schedule"


def feed_and_schedule(journeys: DataFrame, slots: DataFrame) -> DataFrame:
    """Both streams as one, for `updates_sink`."""
    sides = {FEED: journeys, SCHEDULE: slots}
    feed, schedule = (df.select(F.lit(side).alias("side"), F.struct(*df.columns).alias(side)) for side, df in sides.items())
    return feed.unionByName(schedule, allowMissingColumns=True)


def updates_sink(
    spark: SparkSession, path: str, late_limit: str = "1 day", late_days: int = 7, ahead_days: int = 7
) -> Callable[[DataFrame, int], None]:
    """foreachBatch sink of `feed_and_schedule`: `renewing_update_stream`, whose two sides may outgrow memory.

    What has come lies in a folder per batch and side. New journeys meet all slots, slots that
    are new meet the journeys before them as well; only folders that rows after the watermark
    can still meet are read and kept. A batch that is run again replaces its own folders.
    """
    times = {FEED: F.col("polled_at").cast("timestamp"), SCHEDULE: F.col("departure_date").cast("timestamp")}
    reach = {FEED: ahead_days, SCHEDULE: late_days + 1}

    def write(batch: DataFrame, batch_id: int) -> None:
        def rows(side: str, batches: list[int]) -> DataFrame:
            folders = [f"{path}/in/batch={b}/side={side}" for b in batches]
            return spark.read.schema(T.StructType([batch.schema[side]])).parquet(*folders).select(f"{side}.*")

        newest = _newest(spark, path, batch_id)
        mark = _watermark(spark, {FEED: late_limit, SCHEDULE: f"{late_days} days"}, newest)
        came = F.coalesce(F.col(f"{FEED}.polled_at").cast("timestamp"), F.col(f"{SCHEDULE}.departure_date").cast("timestamp"))
        new = batch.filter(came > F.timestamp_micros(F.lit(mark)))
        new.write.mode("overwrite").partitionBy("side").parquet(f"{path}/in/batch={batch_id}")
        arrived = [s for s in (FEED, SCHEDULE) if f"side={s}" in list_names(spark, f"{path}/in/batch={batch_id}")]
        needed = {k: m for k, m in newest.items() if m > mark - reach[k[0]] * 86_400_000_000}
        held = {s: [b for side, b in needed if side == s] for s in (FEED, SCHEDULE)}
        now = {s: [batch_id] if s in arrived else [] for s in (FEED, SCHEDULE)}
        found = [
            renewing_update_stream(rows(FEED, feed), rows(SCHEDULE, slots), late_limit, late_days, ahead_days)
            for feed, slots in ((now[FEED], held[SCHEDULE] + now[SCHEDULE]), (held[FEED], now[SCHEDULE]))
            if feed and slots
        ]
        if found:
            reduce(DataFrame.unionByName, found).write.mode("overwrite").parquet(f"{path}/out/batch={batch_id}")
        last = {s: rows(s, now[s]) if s == SCHEDULE else valid_journeys(rows(s, now[s])) for s in arrived}
        told = {(s, batch_id): df.agg(F.max(F.unix_micros(times[s]))).first()[0] for s, df in last.items()}
        tops = [max((m for (of, _), m in newest.items() if of == s), default=None) for s in (FEED, SCHEDULE)]
        _remember(spark, path, batch_id, {k: m for k, m in newest.items() if k in needed or m in tops} | told)
        for side, b in _newest(spark, path, batch_id, 2).keys() - newest.keys():
            delete_path(spark, f"{path}/in/batch={b}/side={side}")

    return write


def kept_updates(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What `updates_sink` has written so far."""
    folders = [f"{path}/out/batch={b}" for b in _folders(spark, f"{path}/out")]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


# --- stateful streams ---------------------------------------------------------------------


#: One poll of a journey; a later poll of the same journey is another delivery.
POLLED = ["journey_ref", "polled_at"]


def first_deliveries(
    updates: DataFrame, keys: list[str], event_time: str, late_limit: str = LATE_LIMIT
) -> DataFrame:
    """Drop repeated deliveries, and anything older than the watermark; a batch has no watermark.

    A stream's keys lie in the state store. Where they are more than executors can hold, `deliveries_sink` does the same.
    """
    if not updates.isStreaming:
        return updates.dropDuplicates(keys)
    return updates.withWatermark(event_time, late_limit).dropDuplicatesWithinWatermark(keys)


def running_daily_delay(trips: DataFrame) -> DataFrame:
    """Delay distribution per day over all trips so far, each of which arrives once; run it in complete mode.

    `daily_sink` keeps the distribution of trips whose rows arrive again with later values.
    """
    return daily_counts(trips)


# --- sinks --------------------------------------------------------------------------------


def batches_to(path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch sink: each batch in its own folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def newest_batch(spark: SparkSession, path: str) -> DataFrame:
    """Result of a complete-mode query: its last batch."""
    batches = spark.read.parquet(path)
    last = batches.select(F.max("batch")).scalar()
    return batches.filter(F.col("batch") == last).drop("batch")


def deliveries_sink(
    spark: SparkSession, path: str, keys: list[str], event_time: str, late_limit: str = LATE_LIMIT
) -> Callable[[DataFrame, int], None]:
    """foreachBatch sink that keeps each delivery once: `first_deliveries` of a stream, whose keys may outgrow memory.

    Each batch is a folder of its own, and the folders are all that is remembered: a batch is
    sorted out by itself and against those kept rows that lie after the watermark. As `event_time`
    is one of the keys, a repeated row is as old as the one that was kept, so nothing older is
    looked for, and the kept rows tell the watermark. A batch that is run again replaces its own folder.
    """
    if event_time not in keys:
        raise ValueError(f"{event_time} is not among the keys {keys}")
    at = F.col(event_time).cast("timestamp")

    def write(batch: DataFrame, batch_id: int) -> None:
        newest = _newest(spark, path, batch_id)
        mark = _watermark(spark, {"rows": late_limit}, newest)
        in_time = at > F.timestamp_micros(F.lit(mark))
        new = first_deliveries(batch.filter(at.isNull() | in_time), keys, event_time)
        alive = [b for (_, b), micros in newest.items() if micros > mark]
        if alive:
            held = spark.read.schema(batch.schema).parquet(*[f"{path}/rows/batch={b}" for b in alive]).filter(in_time)
            same = [F.col(f"n.{k}").eqNullSafe(F.col(f"h.{k}")) for k in keys]
            new = new.alias("n").join(held.alias("h"), same, "left_anti")
        new.write.mode("overwrite").parquet(f"{path}/rows/batch={batch_id}")
        kept = spark.read.schema(batch.schema).parquet(f"{path}/rows/batch={batch_id}")
        told = {k: m for k, m in newest.items() if m > mark or m == max(newest.values())}
        _remember(spark, path, batch_id, told | {("rows", batch_id): kept.agg(F.max(F.unix_micros(at))).first()[0]})

    return write


def _newest(spark: SparkSession, path: str, batch_id: int, back: int = 1) -> dict[tuple[str, int], int]:
    """What a sink has remembered before a batch, or that many batches back: of each side and batch still needed the newest time."""
    ended = [b for b in _folders(spark, f"{path}/newest") if b < batch_id]
    if len(ended) < back:
        return {}
    return {(r.side, r.batch): r.micros for r in spark.read.parquet(f"{path}/newest/batch={ended[-back]}").collect()}


def _remember(spark: SparkSession, path: str, batch_id: int, newest: dict[tuple[str, int], int | None]) -> None:
    """The last thing a sink does with a batch; a side without times has none to remember."""
    known = [(side, b, micros) for (side, b), micros in newest.items() if micros is not None]
    told = spark.createDataFrame(known, "side string, batch long, micros long").coalesce(1)
    told.write.mode("overwrite").parquet(f"{path}/newest/batch={batch_id}")
    for old in [b for b in _folders(spark, f"{path}/newest") if b < batch_id][:-2]:
        delete_path(spark, f"{path}/newest/batch={old}")


def _watermark(spark: SparkSession, limits: dict[str, str], newest: dict[tuple[str, int], int]) -> int:
    """As Spark's, in microseconds: that of the oldest side, to the millisecond, and 1970 until all sides have rows."""
    marks = []
    for side, limit in limits.items():
        last = max((micros for (of, _), micros in newest.items() if of == side), default=None)
        if last is None:
            return 0
        marks.append(spark.sql(f"SELECT unix_micros(timestamp_micros({last // 1000 * 1000}) - INTERVAL {limit})").first()[0])
    return min(marks)


def kept_deliveries(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What `deliveries_sink` has kept so far."""
    folders = [f"{path}/rows/batch={b}" for b in _folders(spark, f"{path}/rows")]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def fold_batches(
    spark: SparkSession,
    path: str,
    stations: DataFrame,
    prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
    keep_days: int | None = None,
) -> Callable[[DataFrame, int], None]:
    """foreachBatch sink: latest known values per train, date and station.

    Each batch is folded by itself and laid over the result before it; of the folders only the
    last two stay. With `keep_days` the result keeps that many departure days up to the newest
    one; a date further ahead of its poll than AHEAD_DAYS counts as the day of the poll there.
    A batch that is run again starts from the result before it. The fold does not depend on
    the schedule: `orient_fold` joins that. For streams whose order needs no micro-batch,
    `running_fold` keeps the values in the state store instead.
    """
    keys = [*MATCH, "station"]

    def write(batch: DataFrame, batch_id: int) -> None:
        journeys = valid_journeys(prepare(batch))
        new = fold_log(feed_log(journeys, stations))
        days = journeys.select("departure_date", "polled_at")
        before = [b for b in _folders(spark, path) if b < batch_id]
        if before:
            old = spark.read.parquet(f"{path}/batch={before[-1]}")
            days = days.unionByName(old.filter("polled_at IS NOT NULL").select("departure_date", "polled_at"))
            values = [c for c in old.columns if c not in (*keys, "n_updates")]
            same = [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]
            both = old.alias("o").join(new.alias("n"), same, "full")
            counts = [F.coalesce(f"{side}.n_updates", F.lit(0)) for side in "on"]
            new = both.select(
                *[F.coalesce(f"n.{c}", f"o.{c}").alias(c) for c in (*keys, *values)],
                (counts[0] + counts[1]).alias("n_updates"),
            )
        if keep_days:
            newest = days.agg(F.max(_falls())).scalar()
            new = new.filter(F.col("departure_date") > F.date_sub(newest, keep_days))
        new.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        for old_batch in before[:-1]:
            delete_path(spark, f"{path}/batch={old_batch}")

    return write


def _folders(spark: SparkSession, path: str) -> list[int]:
    """The finished batches below a path, in order."""
    if not path_exists(spark, path):
        return []
    found = list_names(spark, path)
    done = (n for n in found if n.startswith("batch=") and path_exists(spark, f"{path}/{n}/_SUCCESS"))
    return sorted(int(n.removeprefix("batch=")) for n in done)


def _falls() -> Column:
    """The departure date, or where that is further ahead of the poll than a feed looks, the day of the poll."""
    polled = F.to_date("polled_at")
    return F.when(F.col("departure_date") > F.date_add(polled, AHEAD_DAYS), polled).otherwise(F.col("departure_date"))


def running_fold(journeys: DataFrame, stations: DataFrame, late_days: int = LATE_DAYS) -> DataFrame:
    """Latest known values per train, date and station of a stream, as a stateful aggregation; run it in update mode.

    The state store keeps a train until `late_days` days after its departure; the watermark is
    taken from the dates that a feed can be about at the time of its poll, so a date far ahead
    costs its own row and makes no other one old. Such rows have a `falls` of their own for
    each day they are polled on; `running_result` puts them together. What `running_sink` has
    written stays when the state falls. Journeys need an order `feed_seq` within the stream.
    """
    dated = valid_journeys(journeys).filter(F.col("departure_date").isNotNull())
    # A date that lies behind its poll by more than the limit is late, one that lies ahead of it is not early.
    log = feed_log(dated.withColumn("falls", _falls().cast("timestamp")), stations, "falls")
    return fold_log(log.withWatermark("falls", f"{AHEAD_DAYS + late_days} days"), "falls")


RUNNING_KEY = [*MATCH, "station", "falls"]


def running_sink(spark: SparkSession, path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch sink of `running_fold`: rows that changed, into a table with versions of its departure days.

    Only days with changed rows are written again, and readers never miss one. A batch that is
    run again gives the same rows.
    """
    versions.create(spark, path, ("departure_date",))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read for its days, and written
        try:
            days = [r.departure_date for r in batch.select("departure_date").distinct().collect()]
            if not days:
                return
            held = versions.current(spark, path)
            before = versions.read(spark, path, batch.schema, held).filter(F.col("departure_date").isin(days))
            new = batch
            if any(f"departure_date={d}" in held.held for d in days):
                new = before.join(batch, RUNNING_KEY, "left_anti").unionByName(batch)
            versions.write(new, path)
            versions.vacuum(spark, path)
        finally:
            batch.unpersist()

    return write


def running_result(spark: SparkSession, path: str, folded: T.StructType) -> DataFrame:
    """What `running_sink` has written so far, one row per train, date and station; `folded` is the fold's schema."""
    rows = versions.read(spark, path, folded)
    values = [c for c in folded.fieldNames() if c not in (*RUNNING_KEY, "n_updates")]
    # Almost every key has one row; only those that were polled far ahead have several, of which later ones know more.
    return rows.groupBy(*MATCH, "station").agg(*last_known(values, "falls"), F.sum("n_updates").alias("n_updates"))


def daily_sink(spark: SparkSession, path: str, seq: str = "seq") -> Callable[[DataFrame, int], None]:
    """foreachBatch sink of trip rows, each of which may arrive again: the delay distribution per day, by retraction.

    Below `path` lie what every trip counts as, by service day, and the daily counts. Both are
    switched to a new version per batch, counts first, and remember the batch, so one that is
    run again after a failure adds nothing twice. Only the service days of the batch are read
    and written. `seq` orders a trip's rows, over all batches.
    """
    held, counts = f"{path}/held", f"{path}/counts"
    versions.create(spark, held, ("day",))
    versions.create(spark, counts, ())

    def write(batch: DataFrame, batch_id: int) -> None:
        if versions.current(spark, held).tag >= batch_id:
            return
        new = running_counts.counted_as(batch, seq).persist()  # read for its days, and matched
        try:
            days = [r.day for r in new.select("day").distinct().collect()]
            before = versions.read(spark, held, running_counts.HELD).filter(F.col("day").isin(days))
            changed = running_counts.changes(before, new).persist()  # counted, and kept
            if versions.current(spark, counts).tag < batch_id:
                daily = versions.read(spark, counts, running_counts.COUNTED)
                versions.write(running_counts.added(daily, running_counts.retractions(changed)).coalesce(1), counts, tag=batch_id)
            same = [F.col(f"o.{c}").eqNullSafe(F.col(f"c.{c}")) for c in running_counts.TRIP]
            kept = before.alias("o").join(changed.alias("c"), same, "left_anti")
            versions.write(kept.unionByName(changed.drop("before")), held, tag=batch_id)
            changed.unpersist()
            for table in (held, counts):
                versions.vacuum(spark, table)
        finally:
            new.unpersist()

    return write


def daily_result(spark: SparkSession, path: str) -> DataFrame:
    """The daily counts that `daily_sink` has written, as `statistics.daily_counts` gives them."""
    return versions.read(spark, f"{path}/counts", running_counts.COUNTED).filter("total_trains > 0")


def newest_fold(spark: SparkSession, path: str) -> DataFrame:
    """Result of `fold_batches`: its last folder."""
    return spark.read.parquet(f"{path}/batch={_folders(spark, path)[-1]}")


def upsert_batches(
    spark: SparkSession,
    table: str,
    schedule_of_days: Callable[[list[date]], DataFrame],
    stations: DataFrame,
    prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
    days_back: int = 1,
) -> Callable[[DataFrame, int], None]:
    """foreachBatch sink: journeys into the trip table, whatever days they are about.

    The days come from the batch. A train past midnight belongs to a service day before, so
    the schedules of each day and of the `days_back` days before it are loaded if the table
    has none of them; `schedule.days_back` tells how many a timetable needs. Both steps give the
    same table when a batch is run again. For XML snapshots pass `siri.number_rows` as
    `prepare`, so that journeys of one file keep their order.
    """
    without_trips: set[date] = set()

    def write(batch: DataFrame, batch_id: int) -> None:
        recover(spark, table)
        journeys = valid_journeys(prepare(batch)).filter(F.col("departure_date").isNotNull())
        # Read for its days, and matched: a few rows per train and day, where the journeys would be the whole batch.
        folded = fold_log(feed_log(journeys, stations)).persist()
        try:
            days = [r.departure_date for r in folded.select("departure_date").distinct().collect()]
            if days:
                load(days)
                trips = read_trip_table(spark, table).filter(F.col(DEPARTURE_DAY.name).isin(days))
                upsert(spark, table, orient_fold(folded, trips, stations), SLOT)
        finally:
            folded.unpersist()

    def load(days: list[date]) -> None:
        concerned = {d - timedelta(days=back) for d in days for back in range(days_back + 1)}
        absent = missing_days(spark, table, concerned - without_trips)
        if absent:
            replace_days(schedule_of_days(absent).filter(F.col("service_date").isin(absent)), table)
            without_trips.update(missing_days(spark, table, absent))

    return write


def realtime_job(
    spark: SparkSession,
    snapshots: str,
    table: str,
    schedule_of_days: Callable[[list[date]], DataFrame],
    stations: DataFrame,
    max_files: int | None = None,
    days_back: int = 1,
) -> DataStreamWriter:
    """The whole job, to be started: snapshot files in, what is polled in operating hours into the trip table."""
    stream = siri.stream_journeys(spark, snapshots, max_files)
    open_hours = operating_hours(stream, F.col("polled_at"))
    sink = upsert_batches(spark, table, schedule_of_days, stations, siri.number_rows, days_back)
    return open_hours.writeStream.foreachBatch(sink)


def create_table(spark: SparkSession, table: str) -> None:
    """An empty trip table."""
    spark.createDataFrame([], STORED).write.mode("ignore").parquet(table)
