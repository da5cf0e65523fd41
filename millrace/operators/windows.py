"""Row choice, ranks, shares and row-to-row operators.

Row choice is written as a ranking window with a bound on the rank: Spark then limits each group
before the shuffle, so a hot key sends only its first rows. Row-to-row operators (previous row,
runs) are windowed per key and time bin and stitched at the bin edges, so a hot key is never one
task's work.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.params import OPEN_DATE

Order = Sequence[Column | str]


def _list(x) -> list:
    return [x] if isinstance(x, (str, Column)) else list(x)


def nth_row(df: DataFrame, by: str | Sequence[str], order: Order, n: int = 1) -> DataFrame:
    """The n-th row of each group. State the null order in `order`, and end it on a unique key."""
    w = W.partitionBy(*_list(by)).orderBy(*_list(order))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == n).drop("_rn")


def ranked(
    df: DataFrame, by: str | Sequence[str], order: Order, upto: int, ties: bool = True, name: str = "rnk"
) -> DataFrame:
    """Rows ranked up to `upto` in their group, with the rank."""
    w = W.partitionBy(*_list(by)).orderBy(*_list(order))
    fn = F.rank() if ties else F.row_number()
    return df.withColumn(name, fn.over(w)).where(F.col(name) <= upto)


def share(df: DataFrame, value: str, by: str | Sequence[str] | None = None, name: str = "share") -> DataFrame:
    """Value as a part of the total of its group, or of the whole set."""
    if by is None:
        total = df.agg(F.sum(value).alias("_total"))
        return df.withColumn("_total", total.scalar()).withColumn(name, F.try_divide(F.col(value), F.col("_total"))).drop("_total")
    by = _list(by)
    totals = df.groupBy(*by).agg(F.sum(value).alias("_total"))
    return (
        df.join(totals, by, "left")
        .withColumn(name, F.try_divide(F.col(value), F.col("_total")))
        .drop("_total")
    )


def label_order(df: DataFrame, parent: Sequence[str], child: str, name: str = "ord") -> DataFrame:
    """Dense order of labels within their parent; found on the distinct labels, then joined back."""
    parent = _list(parent)
    labels = df.select(*parent, child).distinct()
    numbered = labels.withColumn(name, F.dense_rank().over(W.partitionBy(*parent).orderBy(F.col(child).asc_nulls_last())))
    return df.join(numbered, parent + [child], "left")


# --- row to row ---------------------------------------------------------------------------

BIN_SECONDS = 600


def time_bin(df: DataFrame, ts: str) -> Column:
    """Default bin of a time column: the year of a date, or ten minutes of a timestamp."""
    if isinstance(df.schema[ts].dataType, T.DateType):
        return F.trunc(F.col(ts), "YEAR")
    return F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / BIN_SECONDS)


def _neighbour(df, by, order, cols, bin_, prefix, step) -> DataFrame:
    by, order = _list(by), list(order)
    rows = df.withColumn("_bin", time_bin(df, order[0]) if bin_ is None else bin_)
    in_bin, along = W.partitionBy(*by, "_bin").orderBy(*order), W.partitionBy(*by).orderBy("_bin")
    pick, shift = (F.max_by, F.lag) if step < 0 else (F.min_by, F.lead)
    key = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    edges = rows.groupBy(*by, "_bin").agg(*[pick(c, key).alias("_e_" + c) for c in cols])
    carry = [shift("_e_" + c).over(along).alias("_c_" + c) for c in cols]
    carried = edges.select(*by, "_bin", *carry)
    # Within a bin the row number tells whether the near row is in the bin at all.
    edge = F.row_number().over(W.partitionBy(*by, "_bin").orderBy(*[F.col(c).desc() if step > 0 else F.col(c) for c in order])) == 1
    near = {"_n_" + c: shift(c).over(in_bin) for c in cols}
    out = rows.withColumns({**near, "_edge": edge}).join(carried, by + ["_bin"], "left")
    picked = [F.when(F.col("_edge"), F.col("_c_" + c)).otherwise(F.col("_n_" + c)).alias(prefix + c) for c in cols]
    return out.select(*df.columns, *picked)


def previous_row(
    df: DataFrame, by: str | Sequence[str], order: Sequence[str], cols: Sequence[str], bin_: Column | None = None, prefix: str = "prev_"
) -> DataFrame:
    """The values of `cols` in the row before, per key, in ascending `order`.

    `bin_` must not decrease along the first order column; by default it is the year of a date, or ten
    minutes of a timestamp, so that even a key with a third of all rows is many groups. Windows run per
    key and bin; the last row of each bin is carried over to the next bin in use. Keys and order
    columns must not be null, and `order` must be unique within a key.
    """
    return _neighbour(df, by, order, cols, bin_, prefix, -1)


def next_row(
    df: DataFrame, by: str | Sequence[str], order: Sequence[str], cols: Sequence[str], bin_: Column | None = None, prefix: str = "next_"
) -> DataFrame:
    """The same for the row after."""
    return _neighbour(df, by, order, cols, bin_, prefix, 1)


def build_history(
    df: DataFrame, by: str | Sequence[str], at: str, state: Sequence[str], open_end: date = OPEN_DATE
) -> DataFrame:
    """Dated states (one row per key and date) to validity intervals that meet without a gap."""
    by = _list(by)
    nxt = next_row(df, by, [at], [at], F.trunc(F.col(at), "YEAR"), "_n_")
    end = F.coalesce(F.date_sub(F.col("_n_" + at), 1), F.lit(open_end))
    return nxt.select(*by, *state, F.col(at).alias("start_date"), end.alias("end_date"))


def drop_repeats(df: DataFrame, by: str | Sequence[str], order: Sequence[str], state: str, bin_: Column | None = None) -> DataFrame:
    """Keep a row only where its state differs from that of the row before."""
    seen = previous_row(df, by, order, [state], bin_, "_p_").withColumnRenamed("_p_" + state, "_before")
    return seen.where(~F.col(state).eqNullSafe(F.col("_before")) | F.col("_before").isNull()).drop("_before")


def runs(df: DataFrame, by: str | Sequence[str], ts: str, state: str, bin_: Column | None = None) -> DataFrame:
    """Runs of one state per key: first and last time, and the state and first time of the next run.

    Repeated sightings count once. Runs are formed per key and bin; only the first and the last
    run of a bin can join up with another bin, so only those pass through the per-key window.
    """
    by = _list(by)
    seen = df.select(*by, F.col(ts).alias("_ts"), F.col(state).alias("_state")).where("_state is not null").distinct()
    seen = seen.withColumn("_bin", time_bin(seen, "_ts") if bin_ is None else bin_)
    inner = W.partitionBy(*by, "_bin").orderBy("_ts", "_state")
    before = F.lag("_state").over(inner)
    marked = seen.withColumn("_new", F.when(before.isNull() | (before != F.col("_state")), 1).otherwise(0))
    marked = marked.withColumn("_run", F.sum("_new").over(inner))
    local = marked.groupBy(*by, "_bin", "_run").agg(
        F.first("_state").alias("_state"), F.min("_ts").alias("_enter"), F.max("_ts").alias("_last")
    )
    in_bin = W.partitionBy(*by, "_bin").orderBy("_run")
    local = local.withColumns(
        {
            "_next": F.lead(F.struct("_state", "_enter")).over(in_bin),
            "_edge": F.col("_run") == 1,
        }
    ).withColumn("_edge", F.col("_edge") | F.col("_next").isNull())
    along = W.partitionBy(*by).orderBy("_bin", "_run")
    edges = local.where("_edge")
    joins_up = (F.lag("_state").over(along) == F.col("_state")) & (F.lag("_bin").over(along) != F.col("_bin"))
    edges = edges.withColumn("_new", F.when(F.coalesce(joins_up, F.lit(False)), 0).otherwise(1))
    edges = edges.withColumn("_island", F.sum("_new").over(along))
    merged = edges.groupBy(*by, "_island").agg(
        F.first("_state").alias("_state"),
        F.min("_enter").alias("_enter"),
        F.max("_last").alias("_last"),
        F.max_by("_next", F.struct("_bin", "_run")).alias("_next"),
    )
    islands = W.partitionBy(*by).orderBy("_island")
    merged = merged.withColumn("_next", F.coalesce("_next", F.lead(F.struct("_state", "_enter")).over(islands)))
    cols = [*by, "_state", "_enter", "_last", "_next"]
    out = local.where("not _edge").select(*cols).unionByName(merged.select(*cols))
    return out.select(
        *by,
        F.col("_state").alias(state),
        F.col("_enter").alias("enter_" + ts),
        F.col("_last").alias("last_" + ts),
        F.col("_next._state").alias("next_" + state),
        F.col("_next._enter").alias("next_" + ts),
    )


def seconds_between(a: Column, b: Column) -> Column:
    """Seconds from a to b with microseconds."""
    micros = F.unix_micros(b.cast("timestamp")) - F.unix_micros(a.cast("timestamp"))
    return (micros / F.lit(1000000.0)).cast("double")


def dwell(df: DataFrame, by: str | Sequence[str], ts: str, state: str, bin_: Column | None = None) -> DataFrame:
    """Stay per run: entry time, state, last time seen, seconds; a single sighting stays 0."""
    by = _list(by)
    r = runs(df, by, ts, state, bin_)
    return r.select(
        *by, F.col("enter_" + ts).alias(ts), state, F.col("last_" + ts).alias("timeout"),
        seconds_between(F.col("enter_" + ts), F.col("last_" + ts)).alias("dwell_time"),
    )


def movement(df: DataFrame, by: str | Sequence[str], ts: str, state: str, bin_: Column | None = None) -> DataFrame:
    """Each run with the next state and its entry time; null after the last one."""
    by = _list(by)
    r = runs(df, by, ts, state, bin_)
    return r.select(
        *by, F.col("enter_" + ts).alias(ts), state, F.col("next_" + ts).alias("timeout"),
        F.col("next_" + state).alias(state + "_out"),
    )
