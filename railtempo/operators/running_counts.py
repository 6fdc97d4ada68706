"""Delay distribution per day under updates, kept by retraction.

Of every trip only its day and delay class are held. When a trip's row arrives again, its old
class is taken off its old day and the new one added, so each trip counts once and a batch
costs what it changes, not a recount.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railtempo.functions.delay import with_delay
from railtempo.operators.filters import departure_date
from railtempo.schema import DELAY_CLASSES

#: A trip on its service day (for rows without one, the departure date).
TRIP = ["trip_id", "day"]
HELD = T.StructType(
    [
        T.StructField("trip_id", T.StringType()),
        T.StructField("day", T.DateType()),
        T.StructField("seq", T.LongType()),
        T.StructField("counted", T.LongType()),
    ]
)
COUNTED = T.StructType(
    [T.StructField("date", T.DateType()), *[T.StructField(n, T.LongType()) for n in ("total_trains", *DELAY_CLASSES)]]
)
#: Classes that one day's number has room for, and the number of "no departure date".
_ROOM, _NO_DATE = 16, -(2**31)


def counted_as(trips: DataFrame, seq: str) -> DataFrame:
    """Per trip the day and class of its last row in the order of `seq`, as one number.

    Of rows with an equal `seq` the one with the greatest number counts, whichever comes first.
    """
    number = F.coalesce(*[F.when(F.col("delay_class") == name, k) for k, name in enumerate(DELAY_CLASSES)])
    day = F.coalesce(F.unix_date(departure_date()), F.lit(_NO_DATE)).cast("bigint")
    last = F.max(F.struct(F.col(seq).cast("bigint").alias("seq"), (day * _ROOM + number).alias("counted"))).alias("last")
    of = F.coalesce("service_date", departure_date(), F.lit("1970-01-01").cast("date")).alias("day")
    return with_delay(trips).groupBy("trip_id", of).agg(last).select(*TRIP, "last.seq", "last.counted")


def changes(held: DataFrame, new: DataFrame) -> DataFrame:
    """Trips whose number is new or another one, with the one `before`; rows older than what is held change nothing."""
    old = held.select(*TRIP, F.col("seq").alias("held_seq"), F.col("counted").alias("before"))
    same = [F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")) for c in TRIP]
    both = new.alias("n").join(old.alias("o"), same, "left")
    later = F.col("held_seq").isNull() | (F.col("seq") > F.col("held_seq"))
    return both.filter(later).select(*[F.col(f"n.{c}") for c in HELD.names], "before")


def retractions(changed: DataFrame) -> DataFrame:
    """What the changes add to, and take off, each day's counts."""
    steps = F.array(
        F.struct(F.col("before").alias("counted"), F.lit(-1).alias("step")), F.struct(F.col("counted"), F.lit(1).alias("step"))
    )
    moved = changed.filter(~F.col("before").eqNullSafe(F.col("counted"))).select(F.inline(steps)).filter("counted IS NOT NULL")
    number, day = F.pmod("counted", F.lit(_ROOM)), F.floor(F.col("counted") / _ROOM)
    date = F.when(day > _NO_DATE, F.date_from_unix_date(day.cast("int")))
    summed = [F.sum("step").alias("total_trains")]
    summed += [F.sum(F.when(number == k, F.col("step")).otherwise(0)).alias(name) for k, name in enumerate(DELAY_CLASSES)]
    return moved.groupBy(date.alias("date")).agg(*summed)


def added(counts: DataFrame, step: DataFrame) -> DataFrame:
    """Daily counts with the changes; a day that has lost all its trips keeps a row of zeros."""

    def total(name: str) -> Column:
        return F.sum(name).cast("bigint").alias(name)

    return counts.unionByName(step).groupBy("date").agg(*[total(n) for n in COUNTED.names[1:]])
