"""Joins of points and intervals by dyadic cells.

A line of 2**levels places is cut in halves, again and again; a cell is a half at some level. An interval is the
union of 2 * levels cells at most, however long or open it is, and a place lies in one cell of each level. So
"the place lies in the interval" is an equality of cells, true for exactly one cell: rows are matched by a plain
equi join, spread over cells, with no pair that does not hold.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.exprs import as_col
from millrace.operators.ordering import dense_positions

FIRST_DAY = date(1, 1, 1)
DAY_LEVELS = 22  # 2**22 days reach beyond the year 9999
CALENDAR_DAY = date(1960, 1, 1)
CALENDAR_LEVELS = 15  # to September 2049


def _names(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def cells(lo: Column, hi: Column, levels: int) -> Column:
    """The cells, as (level, cell), that make up the places from `lo` to `hi`; none if `lo` is after `hi`."""
    parts = []
    for k in range(levels + 1):
        low, high = F.shiftright(lo + ((1 << k) - 1), k), F.shiftright(hi + 1, k) - 1
        for edge, parity in ((low, 1), (high, 0)):
            use = (low <= high) & (F.pmod(edge, F.lit(2)) == parity)
            parts.append(F.when(use, F.struct(F.lit(k).cast("int").alias("level"), edge.cast("bigint").alias("cell"))))
    return F.filter(F.array(*parts), lambda x: x.isNotNull())


def cells_of_place(place: Column, levels: int) -> Column:
    """The cells that hold a place, one a level."""
    return F.array(*[F.struct(F.lit(k).cast("int").alias("level"), F.shiftright(place, k).cast("bigint").alias("cell")) for k in range(levels + 1)])


def day_place(day: Column, first: date = FIRST_DAY, levels: int = DAY_LEVELS) -> Column:
    """Days since `first`, held within the line. The default line has every date of a place of its own."""
    days = F.unix_date(day).cast("bigint") - (first - date(1970, 1, 1)).days
    return F.when(days.isNotNull(), F.greatest(F.lit(0).cast("bigint"), F.least(days, F.lit((1 << levels) - 1).cast("bigint"))))


def _spread(df: DataFrame, found: Column) -> DataFrame:
    return df.withColumn("_c", F.explode(found)).withColumns({"_level": F.col("_c.level"), "_cell": F.col("_c.cell")}).drop("_c")


def join_overlap(left: DataFrame, right: DataFrame, on: str | Sequence[str], s1: str, e1: str, s2: str, e2: str) -> DataFrame:
    """Pairs of one key whose intervals share a day.

    Two intervals overlap if the right one begins within the left, or the left one within the right after its first
    day: either way a start, a place, lies in an interval. So a pair comes out once, and an interval that is open
    to the end of time is 15 cells, not a copy for each month. Dates outside the calendar share its first and
    last place and are compared as dates after the match. Intervals that end before they begin, or with a null end,
    overlap nothing.
    """
    on = _names(on)
    place = lambda c: day_place(F.col(c), CALENDAR_DAY, CALENDAR_LEVELS)
    a, b = left.where(F.col(s1) <= F.col(e1)), right.where(F.col(s2) <= F.col(e2))
    wide = lambda df, s, e: _spread(df, cells(place(s), place(e), CALENDAR_LEVELS))
    starts = lambda df, s: _spread(df, cells_of_place(place(s), CALENDAR_LEVELS))
    names = [*on, *[c for c in left.columns if c not in on], *[c for c in right.columns if c not in on]]
    keys = [*on, "_level", "_cell"]
    later = wide(a, s1, e1).join(starts(b, s2), keys).where(F.col(s2).between(F.col(s1), F.col(e1)))
    sooner = starts(a, s1).join(wide(b, s2, e2), keys).where((F.col(s1) > F.col(s2)) & (F.col(s1) <= F.col(e2)))
    return later.select(*names).unionByName(sooner.select(*names))


def match_ranges(left: DataFrame, ranges: DataFrame, value: str, lo: str, hi: str) -> DataFrame:
    """(_code, columns of `ranges`): each distinct value of `left` with the ranges that hold it, both ends included.

    Values may be of any type that has an order, text too. The distinct values and range ends are numbered in that
    order; ranges and values then meet as intervals and places on that line.
    """
    codes = left.select(F.col(value).alias("_code")).where("_code is not null").distinct()
    ends = ranges.select(F.col(lo).alias("_lo"), F.col(hi).alias("_hi")).where("_lo <= _hi").distinct()
    line = dense_positions([(codes, "_code"), (ends, "_lo"), (ends, "_hi")], "_value", "_place")
    levels = max(1, int(line.agg(F.coalesce(F.max("_place"), F.lit(0))).first()[0]).bit_length())
    at = lambda c, name: line.select(F.col("_value").alias(c), F.col("_place").alias(name))
    placed = ends.join(at("_lo", "_from"), "_lo").join(at("_hi", "_to"), "_hi")
    wide = _spread(placed, cells(F.col("_from"), F.col("_to"), levels)).select("_lo", "_hi", "_level", "_cell")
    places = _spread(codes.join(at("_code", "_place"), "_code"), cells_of_place(F.col("_place"), levels)).select("_code", "_level", "_cell")
    held = places.join(wide, ["_level", "_cell"]).select("_code", "_lo", "_hi")
    return held.join(ranges, (held["_lo"] == ranges[lo]) & (held["_hi"] == ranges[hi])).drop("_lo", "_hi")


def halves(lo: Column, hi: Column) -> Column:
    """The places from `lo` to `hi` as (level, cell, edge): the end of one cell and the beginning of the next.

    The two are the halves of the smallest cell that holds both places. Of an even cell the places from the edge on are
    meant, of an odd one those up to the edge. A single place is one entry.
    """
    level = (F.length(F.bin(lo.bitwiseXOR(hi))) - 1).cast("int")
    half = lambda edge: F.struct(level.alias("level"), F.call_function("shiftright", edge, level).alias("cell"), edge.alias("edge"))
    return F.array_distinct(F.array(half(lo), half(hi)))


def best_open(
    probes: DataFrame, intervals: DataFrame, on: str | Sequence[str], at: Column | str, start: str, end: str, order: Sequence[str], cols: Sequence[str]
) -> DataFrame:
    """`probes` with `cols` of the interval of its key that is open on its day and greatest by `order`; null without one.

    Ties are settled by the greatest values of `cols`, in their order; nulls come last, as they do in a struct. An interval
    is two halves at most, and the halves of a key are first reduced to the best of each cell and edge. A day then takes a
    running maximum along each cell that holds it, of the levels its key has halves at only, so rows of a key never meet
    as pairs, however many intervals are open at once. What is gathered by key grows with its distinct days, not its rows.
    """
    on, cols = _names(on), list(cols)
    packed = F.struct(*order, *[c for c in cols if c not in order])
    span = intervals.where(F.col(start) <= F.col(end)).dropna(subset=on).select(*on, day_place(F.col(start)).alias("_from"), day_place(F.col(end)).alias("_to"), packed.alias("_best"))
    edged = span.withColumn("_c", F.explode(halves(F.col("_from"), F.col("_to")))).select(*on, *[F.col(f"_c.{c}").alias(f"_{c}") for c in ("level", "cell", "edge")], "_best")
    top = edged.groupBy(*on, "_level", "_cell", "_edge").agg(F.max("_best").alias("_best"))
    asked = probes.withColumn("_place", day_place(as_col(at)))
    days = asked.select(*on, "_place").dropna().distinct()
    bit = lambda level, cell: (2 * level + F.pmod(cell, F.lit(2))).cast("int")
    used = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit(F.col("_level"), F.col("_cell")))).over(W.partitionBy(*on))
    both = top.unionByName(days, allowMissingColumns=True).withColumn("_used", used)
    over = lambda k: F.call_function("shiftright", F.col("_place"), k)
    held = F.filter(F.sequence(F.lit(0), F.lit(DAY_LEVELS)), lambda k: F.call_function("shiftright", F.col("_used"), bit(k, over(k))).bitwiseAND(1) == 1)
    where = F.when(F.col("_place").isNull(), F.array(F.struct(F.col("_level").alias("level"), F.col("_cell").alias("cell")))).otherwise(F.transform(held, lambda k: F.struct(k.alias("level"), over(k).alias("cell"))))
    rows = both.withColumn("_c", F.explode(where)).withColumns({"_at": F.coalesce("_edge", "_place"), "_level": F.col("_c.level"), "_cell": F.col("_c.cell")})
    # Equal places lie in the same frame, so an edge counts on its own day.
    along = W.partitionBy(*on, "_level", "_cell").orderBy(F.when(F.pmod("_cell", F.lit(2)) == 1, -F.col("_at")).otherwise(F.col("_at")))
    found = rows.withColumn("_best", F.max("_best").over(along)).where("_place is not null and _best is not null")
    best = found.groupBy(*on, "_place").agg(F.max("_best").alias("_best")).select(*on, "_place", *[F.col(f"_best.{c}").alias(c) for c in cols])
    return asked.join(best, [*on, "_place"], "left").drop("_place")
