"""The first events of a key after a date, without pairing a key's dates with its events.

Events and dates of a key are brought on one time line. How many events lie before each day in use is a running sum of
the counts of the key's days. With that number an event knows its place, and a date the places that follow it, so both
meet by equality.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def events_before(events: DataFrame, days: DataFrame, on: Sequence[str], day: str = "day") -> DataFrame:
    """(on, day, before): events of the key on earlier days, for every day of the key in `events` or `days`."""
    return _line(events, days, list(on), day).drop("_held", "_asked")


def _line(events: DataFrame, days: DataFrame, on: list[str], day: str) -> DataFrame:
    """The same, with whether there are events on that day, and whether `days` asks for it.

    Events of one day are counted first, so the window of a key has a row for each day in use at most: its size is bounded by
    the calendar, however many events the key has.
    """
    counted = events.groupBy(*on, day).agg(F.count(F.lit(1)).alias("_n")).withColumn("_asked", F.lit(False))
    asked = days.select(*on, day).distinct().withColumns({"_n": F.lit(0).cast("bigint"), "_asked": F.lit(True)})
    line = counted.unionByName(asked).where(F.col(day).isNotNull()).groupBy(*on, day).agg(F.sum("_n").alias("_n"), F.max("_asked").alias("_asked"))
    earlier = W.partitionBy(*on).orderBy(day).rowsBetween(W.unboundedPreceding, -1)
    return line.select(*on, day, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("before"), (F.col("_n") > 0).alias("_held"), "_asked")


def first_events(
    probes: DataFrame, events: DataFrame, on: str | Sequence[str], since: str, at: str, n: int, until: str | None = None, name: str = "rnk"
) -> DataFrame:
    """The first `n` events of each row's key on or after its date, and up to `until` where given.

    One row for each probe row and event (inner), with the event's rank, as rank() over the events in reach by their
    date: events of one day share a rank, and all of those at rank `n` or before it are taken. Null keys and dates
    meet nothing. `events` must have no column of `probes` but the keys.
    """
    on = [on] if isinstance(on, str) else list(on)
    marked = events.where(F.col(at).isNotNull()).withColumn("_day", F.col(at))
    asked = probes.where(F.col(since).isNotNull()).withColumn("_since", F.col(since))
    line = _line(marked.withColumnRenamed("_day", "day"), asked.select(*on, F.col("_since").alias("day")), on, "day")
    held, wanted = (line.where(kind).select(*on, "day", "before") for kind in ("_held", "_asked"))
    placed = marked.join(held.withColumnRenamed("day", "_day"), [*on, "_day"]).withColumnRenamed("before", "_place").drop("_day")
    starts = asked.join(wanted.withColumnRenamed("day", "_since"), [*on, "_since"]).drop("_since")
    # Places are taken n at a time, so that the n places of a probe lie in two such parts at most.
    part = lambda place: F.floor(place / n).cast("bigint")
    wanted = starts.withColumn("_part", F.explode(F.sequence(part(F.col("before")), part(F.col("before") + n - 1))))
    out = wanted.join(placed.withColumn("_part", part(F.col("_place"))), [*on, "_part"])
    out = out.withColumn(name, (F.col("_place") - F.col("before") + 1).cast("int")).where(F.col(name).between(1, n)).drop("_place", "_part", "before")
    return out.where(F.col(at) <= F.col(until)) if until else out
