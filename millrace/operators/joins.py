"""Joins: history, range, tolerance, membership, waterfall.

Every join that can shuffle does so on an equality key, so adaptive execution can split hot keys.
Range joins get such a key from bins.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.exprs import as_col, literal
from millrace.operators.intervals import match_ranges
from millrace.operators.sizing import BROADCAST_BYTES, estimated_bytes, hint_small
from millrace.storage import settle


def _names(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def join_eq(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner", small: bool = False, salt: int = 0
) -> DataFrame:
    """Equi join. `small` asks for a broadcast of `right`, given only if its size allows.

    `salt` spreads each key of `left` over that many parts and repeats `right` for each; use it
    when a known hot key meets a `right` side of few rows per key. Not for right or full joins.
    """
    on = _names(on)
    if salt <= 1:
        return left.join(hint_small(right) if small else right, on, how)
    left = left.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(salt)).cast("int"))
    size = estimated_bytes(right)
    right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    if small and size is not None and size * salt <= BROADCAST_BYTES:
        right = F.broadcast(right)
    return left.join(right, on + ["_salt"], how).drop("_salt")


# --- history ------------------------------------------------------------------------------

def snapshot(hist: DataFrame, day, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """History rows valid on one day."""
    day = F.lit(day) if isinstance(day, date) else as_col(day)
    return hist.where(day.between(F.col(start), F.col(end)))


# Calendar years that get bins of their own; earlier and later dates share the first and the last.
CALENDAR = (1990, 2035)


def _bin(c: Column, unit: str, years: tuple[int, int] = CALENDAR) -> Column:
    first, last = (F.lit(date(y, 1, 1)) for y in years)
    return F.trunc(F.greatest(F.least(c, last), first), unit)


def _bins_between(lo: Column, hi: Column, unit: str, years: tuple[int, int] = CALENDAR) -> Column:
    step = {"MM": "1 month", "YEAR": "1 year", "QUARTER": "3 months"}[unit]
    return F.explode(F.sequence(_bin(lo, unit, years), _bin(hi, unit, years), F.expr(f"interval {step}")))


def join_asof(
    left: DataFrame,
    hist: DataFrame,
    on: str | Sequence[str],
    at: str,
    start: str = "start_date",
    end: str = "end_date",
    offset_days: int = 0,
    starts_only: bool = False,
    how: str = "left",
    unit: str | None = "YEAR",
    years: tuple[int, int] = CALENDAR,
) -> DataFrame:
    """Join each row to the history row of its key that is valid at date `at` (+ `offset_days`).

    Intervals include both ends; overlapping intervals give one row each. The key is joined
    together with a calendar bin, so that a hot key spreads over its bins. An interval is copied
    into the bins it touches; the calendar is bounded, so an open interval has few copies, and
    dates outside it fall into its first or last bin on both sides. Narrow `years` to those the
    left dates lie in to save copies, or set `unit` to None for a key that is nearly unique. The
    copies are not broadcast: the optimizer sees the size before them, the driver would hold them all.
    `starts_only` keeps the intervals that begin on the date itself.
    """
    on = _names(on)
    day = F.date_add(left[at], offset_days)
    if starts_only:
        return left.withColumn("_day", day).join(hist.withColumn("_day", F.col(start)), on + ["_day"], how).drop("_day")
    right = hist.where(F.col(start) <= F.col(end))
    renamed = right.select(*[F.col(k).alias("_r_" + k) for k in on], *[c for c in right.columns if c not in on])
    if unit:
        # The bin is that of `at` itself and the interval is moved instead, so joins at several offsets share one shuffle.
        moved = [F.date_sub(F.col(c), offset_days) for c in (start, end)]
        renamed = renamed.withColumn("_bin", _bins_between(*moved, unit, years)).hint("merge")
    keys = [left[k] == renamed["_r_" + k] for k in on] + ([_bin(left[at], unit, years) == renamed["_bin"]] if unit else [])
    cond = reduce(lambda a, b: a & b, [*keys, day.between(renamed[start], renamed[end])])
    return left.join(renamed, cond, how).drop("_bin", *["_r_" + k for k in on])


# --- ranges and tolerance -----------------------------------------------------------------

def join_range(
    left: DataFrame, ranges: DataFrame, value: str, lo: str, hi: str, width: float | None = None, how: str = "inner"
) -> DataFrame:
    """Join a value to the ranges that hold it, both ends included.

    With `width` the numeric line is cut into bins and the join is on the bin. Without it (text
    codes, or ranges of any length) the distinct values are matched by `intervals.match_ranges`.
    """
    if width is not None:
        binned = ranges.withColumn(
            "_bin",
            F.explode(F.sequence(F.floor(F.col(lo) / width).cast("bigint"), F.floor(F.col(hi) / width).cast("bigint"))),
        )
        probe = left.withColumn("_bin", F.floor(F.col(value) / width).cast("bigint"))
        binned = binned.withColumnRenamed("_bin", "_rbin")
        cond = (probe["_bin"] == binned["_rbin"]) & probe[value].between(binned[lo], binned[hi])
        return probe.join(binned, cond, how).drop("_bin", "_rbin")
    pairs = match_ranges(left, ranges, value, lo, hi)
    return left.join(pairs, left[value] == pairs["_code"], how).drop("_code")


def join_within(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    d1: str,
    d2: str,
    days: int,
    aggs: Mapping[str, tuple[str, str]],
    residual: tuple[str, str] | None = None,
    how: str = "inner",
) -> DataFrame:
    """Aggregates of the `right` rows of the same key dated within `days` of a left row.

    `aggs` gives name: (function, column) with sum, min, max or count. `right` is aggregated per
    key and day before it meets `left`, then over the 2*days+1 days, so no pair of rows is ever
    formed. `residual` is a (left, right) pair of id columns: a right row counts if its id equals
    the left one or is blank.
    """
    on = _names(on)
    again = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
    rid = [F.coalesce(F.trim(F.col(residual[1]).cast("string")), F.lit("")).alias("_id")] if residual else []
    ids = ["_id"] if residual else []
    first = [getattr(F, fn)(F.col(c)).alias(n) for n, (fn, c) in aggs.items()]
    daily = right.groupBy(*on, F.col(d2).alias("_at"), *rid).agg(*first)
    spread = daily.withColumn("_day", F.explode(F.array(*[F.date_add("_at", i) for i in range(-days, days + 1)])))
    near = spread.groupBy(*on, "_day", *ids).agg(*[again[fn](n).alias(n) for n, (fn, _) in aggs.items()])
    probe = left.withColumn("_day", F.col(d1))
    if not residual:
        return probe.join(near, on + ["_day"], how).drop("_day")
    probe = probe.withColumn("_id", F.coalesce(F.trim(F.col(residual[0]).cast("string")), F.lit("")))
    named = near.where("_id <> ''").select(*on, "_day", "_id", F.struct(*aggs).alias("_named"))
    anon = near.where("_id = ''").select(*on, "_day", F.struct(*aggs).alias("_anon"))
    out = probe.join(named, on + ["_day", "_id"], "left").join(anon, on + ["_day"], "left")
    if how == "inner":
        out = out.where("_named is not null or _anon is not null")
    merged = []
    for n, (fn, _) in aggs.items():
        own, free = F.col("_named." + n), F.col("_anon." + n)
        if fn in ("min", "max"):
            both = F.least(own, free) if fn == "min" else F.greatest(own, free)
        else:
            both = F.coalesce(own + free, own, free)
        merged.append(both.alias(n))
    return out.select(*left.columns, *merged)


# --- semi, anti ---------------------------------------------------------------------------

def keep_in(df: DataFrame, other: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key is in `other`."""
    on = _names(on)
    return df.join(other.select(*on), on, "left_semi")


def drop_in(df: DataFrame, other: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key is not in `other`; a null key is kept."""
    on = _names(on)
    return df.join(other.select(*on), on, "left_anti")


# --- grids, scalars, computed keys --------------------------------------------------------

def grid(first: DataFrame, *dims: DataFrame) -> DataFrame:
    """Every combination of the rows of small label sets.

    The distinct labels of a set are one array, a scalar subquery, and are exploded for each row; an empty
    set gives an empty grid.
    """
    out = first
    for dim in dims:
        labels = dim.agg(F.array_sort(F.collect_set(F.struct(*dim.columns))).alias("labels")).scalar()
        kept = out.columns
        out = out.withColumn("_labels", labels).withColumn("_label", F.explode("_labels")).select(*kept, "_label.*")
    return out


def fill_grid(cells: DataFrame, facts: DataFrame, on: Sequence[str], defaults: Mapping[str, object]) -> DataFrame:
    """Facts laid on a grid, absent cells taking the defaults."""
    out = cells.join(facts, list(on), "left")
    keep = [c for c in out.columns if c not in defaults]
    return out.select(*keep, *[F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in defaults.items()])


def with_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row frame to every row, as scalar subqueries."""
    return df.select("*", *[one_row.select(c).scalar().alias(c) for c in one_row.columns])


def join_on_expr(
    left: DataFrame, right: DataFrame, lexpr: Column | str, rexpr: Column | str, how: str = "inner"
) -> DataFrame:
    """Join on computed keys."""
    lexpr = F.expr(lexpr) if isinstance(lexpr, str) else lexpr
    rexpr = F.expr(rexpr) if isinstance(rexpr, str) else rexpr
    a, b = left.withColumn("_lk", lexpr), right.withColumn("_rk", rexpr)
    return a.join(b, a["_lk"] == b["_rk"], how).drop("_lk", "_rk")


def join_list_member(df: DataFrame, list_col: str, other: DataFrame, key: str, sep: str = ",", how: str = "inner") -> DataFrame:
    """Join rows holding a list text to the rows of `other` whose key is in the list."""
    items = F.array_distinct(F.transform(F.split(F.col(list_col), literal(sep)), lambda x: F.trim(x)))
    split = df.withColumn("_item", F.explode(items)).where("_item <> ''")
    keyed = other.withColumn("_key", F.trim(F.col(key).cast("string")))
    return split.join(keyed, split["_item"] == keyed["_key"], how).drop("_item", "_key")


def join_siblings(
    header: DataFrame, every: DataFrame, details: DataFrame, group: Sequence[str], id_: str
) -> DataFrame:
    """From a main document to all documents of the same group, and on to their details."""
    main = header.select(F.col(id_).alias("main_" + id_), *group)
    return main.join(every.select(id_, *group), list(group)).join(details, id_)


# --- waterfall ----------------------------------------------------------------------------

def waterfall(
    sources: Sequence[tuple[str, DataFrame]], keys: Sequence[str], tag: str = "source",
    stage: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Rows of each source whose key no earlier source has taken.

    The sources are stacked with their order, the lowest order per key is found by an aggregate,
    and a row stays if it has that order. The stack is read twice; `stage` may write it out first,
    which pays when the sources are costly.
    """
    keys = list(keys)
    parts = [
        df.withColumn(tag, F.lit(name)).withColumn("_prio", F.lit(i)) for i, (name, df) in enumerate(sources)
    ]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    rows = stage(rows) if stage else rows
    first = rows.groupBy(*keys).agg(F.min("_prio").alias("_prio"))
    cond = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(first[k]) for k in keys + ["_prio"]])
    return rows.join(first, cond, "left_semi").drop("_prio")


def match_fallback(
    base: DataFrame, key: str, matchers: Sequence[tuple[str, DataFrame]], default: Mapping[str, object], tag: str = "match"
) -> DataFrame:
    """Columns from the first matcher that has the row's key, defaults where none has. The matchers' rows are written once."""
    found = waterfall(matchers, [key], tag, stage=lambda rows: settle(rows, "matches"))
    out = base.join(found, key, "left")
    fill = {tag: "NONE", **default}
    keep = [c for c in out.columns if c not in fill]
    values = {c: v if isinstance(v, Column) else F.lit(v) for c, v in fill.items()}
    unmatched = F.col(tag).isNull()
    return out.select(*keep, *[F.when(unmatched, v).otherwise(F.col(c)).alias(c) for c, v in values.items()])

