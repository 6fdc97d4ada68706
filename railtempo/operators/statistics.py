"""Delay statistics: overall, per line, direction, day and week."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railtempo.functions.delay import (
    average_minutes,
    class_counts,
    known_delay,
    percentages,
    summed_counts,
    with_delay,
)
from railtempo.functions.labels import (
    day_label,
    direction_label,
    line_label,
    week_label,
    weekday_bit,
    weekday_list,
    weekday_ranges,
)
from railtempo.functions.times import (
    clock_minutes,
    clock_text,
    elapsed_seconds,
    minute_of_day,
    week_start,
)
from railtempo.operators.filters import departure_date
from railtempo.schema import DELAY_CLASSES, WEEKLY_ABOVE_DAYS

COUNTS = ("total_trains", *DELAY_CLASSES)
LINE = ["route_short_name", "trip_headsign"]
_TIMETABLE = [*LINE, "departure_station_name", "arrival_station_name", "departure_minute", "arrival_minute"]


# --- overall and per group ----------------------------------------------------------------


def global_stats(trips: DataFrame) -> DataFrame:
    """Delay distribution of all trips; no row if there are none."""
    counts = with_delay(trips).agg(*class_counts())
    return counts.filter(F.col("total_trains") > 0).select("*", *percentages())


def stats_by_direction(trips: DataFrame) -> DataFrame:
    counts = (
        with_delay(trips)
        .groupBy("departure_station_name", "arrival_station_name")
        .agg(*class_counts())
    )
    return counts.select(direction_label().alias("direction"), *COUNTS, *percentages())


def daily_counts(trips: DataFrame) -> DataFrame:
    return with_delay(trips).groupBy(departure_date().alias("date")).agg(*class_counts())


def stats_by_date(trips: DataFrame) -> DataFrame:
    """Delay distribution per departure date, in date order."""
    return daily_counts(trips).select("date", *COUNTS, *percentages()).orderBy("date")


def _by_period(daily: DataFrame, period: Column, label: Column) -> DataFrame:
    return (
        daily.groupBy(period.alias("period_start"), label.alias("period_label"))
        .agg(*summed_counts())
        .select("period_start", "period_label", *COUNTS, *percentages())
        .orderBy("period_start")
    )


def stats_by_week(trips: DataFrame) -> DataFrame:
    """Delay distribution per week, keyed by its Monday."""
    monday = week_start(F.col("date"))
    return _by_period(daily_counts(trips), monday, week_label(monday))


def timeline(trips: DataFrame) -> DataFrame:
    """Per week if the trips span more than 30 days, else per day.

    The span is a window over the daily rows, of which there is one per calendar day.
    """
    everything = Window.partitionBy()
    span = F.datediff(F.max("date").over(everything), F.min("date").over(everything))
    daily = daily_counts(trips).withColumn("weekly", span > WEEKLY_ABOVE_DAYS)
    monday = week_start(F.col("date"))
    return _by_period(
        daily,
        F.when(F.col("weekly"), monday).otherwise(F.col("date")),
        F.when(F.col("weekly"), week_label(monday)).otherwise(day_label(F.col("date"))),
    )


# --- per line -----------------------------------------------------------------------------


def timetable_profile(trips: DataFrame) -> DataFrame:
    """Counts per line and timetable: the one pass over trips behind all line reports.

    Keys are texts and clock minutes and all running values are numbers, so this is a hash
    aggregation that shrinks the trips to a few rows per line before any shuffle; a line
    with very many trips is no heavier than others from here on.
    """
    scheduled = elapsed_seconds(trips, "departure_time_scheduled", "arrival_time_scheduled")
    prepared = with_delay(trips).withColumns(
        {
            "departure_minute": minute_of_day(F.col("departure_time_scheduled")),
            "arrival_minute": minute_of_day(F.col("arrival_time_scheduled")),
            "duration": clock_minutes(scheduled),
            "weekday_bit": weekday_bit("departure_time_scheduled"),
            "known_delay": known_delay(),
        }
    )
    return prepared.groupBy(*_TIMETABLE).agg(
        *class_counts(),
        F.min("duration").alias("duration"),
        F.bit_or("weekday_bit").alias("weekdays"),
        F.sum("known_delay").alias("delay_sum"),
        F.count("known_delay").alias("delay_count"),
    )


def _line_aggregates() -> list[Column]:
    return [
        F.min(direction_label()).alias("direction"),
        F.min("departure_minute").alias("first_departure"),
        F.min("arrival_minute").alias("first_arrival"),
        F.min("duration").alias("shortest"),
        F.bit_or("weekdays").alias("weekdays"),
        F.sum("delay_sum").alias("delay_sum"),
        F.sum("delay_count").alias("delay_count"),
        *summed_counts(),
    ]


def _average() -> Column:
    return average_minutes(F.col("delay_sum"), F.col("delay_count")).alias("average_delay_minutes")


def stats_by_line(profile: DataFrame) -> DataFrame:
    """Statistics per line with its earliest clock times, in order of departure."""
    lines = profile.groupBy(*LINE).agg(*_line_aggregates())
    return lines.select(
        line_label().alias("line"),
        "direction",
        clock_text(F.col("first_departure")).alias("departure_time_scheduled"),
        clock_text(F.col("first_arrival")).alias("arrival_time_scheduled"),
        F.col("shortest").alias("duration_scheduled"),
        _average(),
        weekday_list(F.col("weekdays")).alias("jours"),
        *COUNTS,
        *percentages(),
    ).orderBy("departure_time_scheduled", "line")


def average_delay(profile: DataFrame) -> DataFrame:
    lines = profile.groupBy(*LINE).agg(F.sum("delay_sum").alias("delay_sum"), F.sum("delay_count").alias("delay_count"))
    return lines.select(line_label().alias("line"), _average(), F.col("delay_count").alias("known_trains"))


def line_weekdays(profile: DataFrame) -> DataFrame:
    """Days on which each line runs, as a list and with runs joined."""
    days = profile.groupBy(*LINE).agg(F.bit_or("weekdays").alias("weekdays"))
    return days.select(
        line_label().alias("line"),
        weekday_list(F.col("weekdays")).alias("jours"),
        weekday_ranges(F.col("weekdays")).alias("day_ranges"),
    )


def _rank(n: Column) -> Column:
    """Most frequent first, then earliest; larger is better and unknown times come last."""
    return F.struct(n, -F.col("departure_minute"), -F.col("arrival_minute"))


def _timetable() -> Column:
    return F.struct("departure_minute", "arrival_minute", "duration")


def common_times(profile: DataFrame) -> DataFrame:
    """Most common timetable of each train number."""
    counted = profile.groupBy("trip_headsign", "departure_minute", "arrival_minute").agg(
        F.sum("total_trains").alias("n_trains"), F.min("duration").alias("duration")
    )
    best = counted.groupBy("trip_headsign").agg(
        F.max_by(_timetable(), _rank(F.col("n_trains"))).alias("best"),
        F.max("n_trains").alias("n_trains"),
    )
    return best.select(
        "trip_headsign",
        clock_text(F.col("best.departure_minute")).alias("departure_time"),
        clock_text(F.col("best.arrival_minute")).alias("arrival_time"),
        F.coalesce("best.duration", F.lit(0)).alias("duration_scheduled"),
        "n_trains",
    )


def line_report(profile: DataFrame) -> DataFrame:
    """Full statistics per line, showing the most common timetable of its train number.

    The profile has few rows per train number, so both the choice of timetable and the
    totals run on one partitioning by train number.
    """
    same_times = Window.partitionBy("trip_headsign", "departure_minute", "arrival_minute")
    same_train = Window.partitionBy("trip_headsign")
    timed = profile.repartition("trip_headsign").withColumns(
        {
            "n_trains": F.sum("total_trains").over(same_times),
            "duration": F.min("duration").over(same_times),
        }
    )
    lines = (
        timed.withColumn(
            "common", F.max_by(_timetable(), _rank(F.col("n_trains"))).over(same_train)
        )
        .groupBy(*LINE)
        .agg(F.first("common").alias("common"), *_line_aggregates())
    )
    return lines.select(
        line_label().alias("line"),
        "trip_headsign",
        "direction",
        clock_text(F.col("first_departure")).alias("sort_time"),
        clock_text(F.col("common.departure_minute")).alias("departure_time_scheduled"),
        clock_text(F.col("common.arrival_minute")).alias("arrival_time_scheduled"),
        F.coalesce("common.duration", F.lit(0)).alias("duration_scheduled"),
        _average(),
        weekday_list(F.col("weekdays")).alias("jours"),
        weekday_ranges(F.col("weekdays")).alias("day_ranges"),
        *COUNTS,
        *percentages(),
    ).orderBy("sort_time", "line")


# --- chart data ---------------------------------------------------------------------------


def _segments(stats: DataFrame, keys: list[str], values) -> DataFrame:
    """One row per non-empty class; `values(i)` gives the columns of class number i."""
    items = F.array(
        *[
            F.struct(F.lit(name).alias("delay_class"), F.col(name).alias("trains"), *values(i))
            for i, name in enumerate(DELAY_CLASSES)
        ]
    )
    return stats.select(*keys, F.inline(items)).filter(F.col("trains") > 0)


def stack_offsets(stats: DataFrame, keys: list[str]) -> DataFrame:
    """Stacked bars: height and offset in percent of each class, from wide counts.

    Offsets add up the classes before, which are columns of the same row: no window needed.
    """

    def values(i: int) -> list[Column]:
        before = sum((F.col(c) for c in DELAY_CLASSES[:i]), F.lit(0).cast("bigint"))
        total = F.col("total_trains")
        return [
            (F.col(DELAY_CLASSES[i]) * 100 / total).alias("height"),
            (before * 100 / total).alias("offset"),
        ]

    return _segments(stats.filter("total_trains > 0"), keys, values)


def share_segments(stats: DataFrame, keys: list[str]) -> DataFrame:
    """Shares rounded to 0.1 percent; the last non-empty class takes what is left of 100."""

    def tenths(i: int) -> Column:
        return F.expr(f"(2000 * {DELAY_CLASSES[i]} + total_trains) div (2 * total_trains)")

    def values(i: int) -> list[Column]:
        after = sum((F.col(c) for c in DELAY_CLASSES[i + 1 :]), F.lit(0).cast("bigint"))
        used = sum((tenths(j) for j in range(i)), F.lit(0).cast("bigint"))
        share = F.when(after == 0, 1000 - used).otherwise(tenths(i))
        return [(share / 10).alias("width"), (tenths(i) / 10).alias("percentage")]

    return _segments(stats.filter("total_trains > 0"), keys, values)
