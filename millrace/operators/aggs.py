"""Aggregates: keep-first, ordered lists, offset pairs, subtotals, pivots, allocation, audits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.exprs import ratio
from millrace.operators.sizing import small_values
from millrace.storage import settle

__all__ = [
    "allocate", "duplicate_keys", "keep_first", "list_agg", "offset_pairs", "per_day", "pick_rank", "pivot_blocks", "pivot_report",
    "pre_aggregate_join", "ratio", "ready", "reconcile", "signed_total", "summarise", "weighted_total", "with_subtotals",
]


def _list(x) -> list:
    return [x] if isinstance(x, (str, Column)) else list(x)


def summarise(df: DataFrame, by: str | Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(*_list(by)).agg(*[c.alias(n) for n, c in aggs.items()])


def pre_aggregate_join(
    facts: DataFrame, dim: DataFrame, on: Sequence[str], by: Sequence[str], sums: Sequence[str], how: str = "left"
) -> DataFrame:
    """Sum facts per join key first, join the reference, then sum per `by`.

    `by` may name columns of either side. The join then meets one row per key, not per fact.
    """
    on, by = _list(on), _list(by)
    held = on + [c for c in by if c in facts.columns and c not in on]
    first = facts.groupBy(*held).agg(*[F.sum(c).alias(c) for c in sums], F.count(F.lit(1)).alias("cnt"))
    joined = first.join(dim, on, how)
    return joined.groupBy(*by).agg(*[F.sum(c).alias(c) for c in sums], F.sum("cnt").alias("cnt"))


def _invertible(t: T.DataType) -> bool:
    return isinstance(t, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))


def _ascending_key(c: Column, t: T.DataType) -> Column:
    """A number that falls as `c` rises."""
    if isinstance(t, T.DateType):
        return -F.unix_date(c)
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return -F.unix_micros(c.cast("timestamp"))
    if isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType)):
        return -c
    return -c.cast("decimal(20,0)")


def keep_first(
    df: DataFrame, by: str | Sequence[str], order: str, cols: Sequence[str], desc: bool = False
) -> DataFrame:
    """Per group, the greatest value of each column among the rows that come first by `order`.

    Nulls of `order` come last ascending and first descending. Ties on `order` are settled per
    column, so two columns may come from different rows. Numbers and dates need one aggregate
    with partial results before the shuffle; text in ascending order is reduced per order value
    first.
    """
    by, cols = _list(by), list(cols)
    kind = df.schema[order].dataType
    null_rank = F.col(order).isNull().cast("int")
    if desc or _invertible(kind):
        key = F.col(order) if desc else _ascending_key(F.col(order), kind)
        lead = null_rank if desc else -null_rank
        packed = [F.max(F.struct(lead.alias("n"), key.alias("k"), F.col(c).alias("x")))["x"].alias(c) for c in cols]
        return df.groupBy(*by).agg(*packed)
    reduced = df.groupBy(*by, order).agg(*[F.max(c).alias("_m_" + c) for c in cols])
    w = W.partitionBy(*by).orderBy(F.col(order).asc_nulls_last())
    first = reduced.withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
    return first.select(*by, *[F.col("_m_" + c).alias(c) for c in cols])


def list_agg(
    df: DataFrame, by: str | Sequence[str], value: str, order: Sequence[str] | None = None, sep: str = ",",
    distinct: bool = False, name: str | None = None, repeats: bool = True,
) -> DataFrame:
    """Values joined to one text per group, in order; nulls are skipped.

    Equal values at the same place in the order are counted before the shuffle and repeated in
    the text, so a group full of repeats moves as a few rows. Set `repeats` to False where the
    order is close to unique: the count is then left out, and with it one shuffle.
    """
    by = _list(by)
    order = [value] if distinct or not order else list(order)
    name = name or value + "_list"
    text = F.col(value).cast("string")
    keyed = df.where(F.col(value).isNotNull()).select(*by, *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], text.alias("_v"))
    marks = [f"_o{i}" for i in range(len(order))]
    counted = keyed.withColumn("_n", F.lit(1))
    if repeats or distinct:
        counted = keyed.groupBy(*by, *marks, "_v").agg(F.count(F.lit(1)).alias("_n"))
    entry = F.struct(*marks, "_v", "_n")
    repeat = (lambda x: F.array(x["_v"])) if distinct else (lambda x: F.array_repeat(x["_v"], x["_n"].cast("int")))
    joined = F.array_join(F.flatten(F.transform(F.array_sort(F.collect_list(entry)), repeat)), sep)
    return counted.groupBy(*by).agg(joined.alias(name))


def offset_pairs(df: DataFrame, by: str | Sequence[str], amount: str) -> DataFrame:
    """Groups of exactly two rows of one absolute amount that cancel out."""
    return (
        df.groupBy(*_list(by), F.abs(F.col(amount)).alias("abs_" + amount))
        .agg(F.count(F.lit(1)).alias("cnt"), F.sum(amount).alias("_net"))
        .where("cnt = 2 and _net = 0")
        .drop("cnt", "_net")
    )


def with_subtotals(
    df: DataFrame, outer: str, member: str, measures: Sequence[str], all_label: str = "All", by: Sequence[str] = ()
) -> DataFrame:
    """Detail per outer and member, plus total and average rows per outer and over all.

    An outer's average divides by its distinct members, the overall one by the distinct outers;
    averages have 3 decimals. Detail is first reduced to one row per outer and member, so that
    the distinct counts are plain counts of a much smaller set.
    """
    by, measures = list(by), list(measures)
    # Written, as the detail, the totals of outers and those of all are made of it.
    detail = settle(df.groupBy(*by, outer, member).agg(*[F.sum(m).alias(m) for m in measures]), "subtotals")
    stores = detail.groupBy(*by, outer).agg(
        *[F.sum(m).alias(m) for m in measures], F.count(F.col(member)).alias("_n")
    )
    overall = stores.groupBy(*by).agg(
        *[F.sum(m).alias(m) for m in measures], F.count(F.col(outer)).alias("_n")
    )

    def lines(frame: DataFrame, key: Column, label: Column) -> DataFrame:
        kinds = F.explode(F.array(F.lit("Total"), F.lit("Average"))).alias("_kind")
        both = frame.select("*", kinds)
        avg = F.col("_kind") == "Average"
        return both.select(
            *by,
            key.alias(outer),
            F.concat(label, F.lit(" "), F.col("_kind")).alias(member),
            *[
                F.when(avg, F.round(F.try_divide(F.col(m).cast("decimal(24,3)"), F.col("_n")), 3).cast("decimal(28,3)"))
                .otherwise(F.col(m).cast("decimal(28,3)"))
                .alias(m)
                for m in measures
            ],
            F.lit("Y").alias("summ_fig"),
        )

    head = detail.select(
        *by, outer, member, *[F.col(m).cast("decimal(28,3)").alias(m) for m in measures], F.lit("N").alias("summ_fig")
    )
    per_outer = lines(stores, F.col(outer), F.col(outer))
    whole = lines(overall, F.lit(all_label), F.lit(all_label))
    return head.unionByName(per_outer).unionByName(whole)


PIVOT_LIMIT = 1000


def pivot_report(
    df: DataFrame, rows: Sequence[str], col: str, value: str, cols: Sequence | None = None
) -> DataFrame:
    """Long cells to a wide table, with the listed column values, or those found, in order.

    Each value becomes a column, so there may be PIVOT_LIMIT of them at most; `pivot_blocks` takes any number.
    """
    if cols is None:
        found = small_values(df.where(F.col(col).isNotNull()), [col], PIVOT_LIMIT)
        if found is None:
            raise ValueError(f"more than {PIVOT_LIMIT} values of {col}: list the columns, or use pivot_blocks")
        cols = [v for (v,) in found]
    return df.groupBy(*_list(rows)).pivot(col, list(cols)).agg(F.max(value))


def pivot_blocks(df: DataFrame, rows: Sequence[str], number: str, value: str, first: int, width: int) -> DataFrame:
    """Long cells to narrow tables, for columns of any number: (rows, block, c0 ... c<width-1>).

    Column `number` counts from `first`; block 0 holds the first `width` columns, block 1 the next, and so on. The
    columns are fixed, so nothing is collected to find them; a wide table is its blocks side by side.
    """
    at = F.col(number) - first
    place = F.pmod(at, F.lit(width))
    cells = [F.max(F.when(place == i, F.col(value))).alias(f"c{i}") for i in range(width)]
    return df.groupBy(*_list(rows), F.floor(at / width).cast("int").alias("block")).agg(*cells)


def pick_rank(df: DataFrame, by: str | Sequence[str], rank_col: str, ranks: Sequence[int], cols: Sequence[str]) -> DataFrame:
    """Values at the first of `ranks` that the group has; all columns come from that one rank."""
    at = [F.max(F.when(F.col(rank_col) == r, F.struct(*cols))).alias(f"_r{r}") for r in ranks]
    chosen = F.coalesce(*[F.col(f"_r{r}") for r in ranks])
    picked = df.groupBy(*_list(by)).agg(*at)
    return picked.select(*_list(by), *[chosen[c].alias(c) for c in cols])


def weighted_total(
    df: DataFrame, rates: DataFrame, on: str, value: str, rate: str, by: Sequence[str], name: str, default=1
) -> DataFrame:
    """Sum of value x rate; a key without a rate takes the default. Summed per key before the join."""
    by = _list(by)
    held = by + ([on] if on not in by else [])
    first = df.groupBy(*held).agg(F.sum(value).alias("_v"))
    joined = first.join(rates.select(on, rate), on, "left")
    return joined.groupBy(*by).agg(F.sum(F.col("_v") * F.coalesce(F.col(rate), F.lit(default))).alias(name))


def signed_total(
    df: DataFrame, by: Sequence[str], line: str, value: str, plus: Sequence, minus: Sequence, name: str = "contribution"
) -> DataFrame:
    """Sum in which some line classes add and others take away."""
    signed = F.when(F.col(line).isin(list(plus)), F.col(value)).when(F.col(line).isin(list(minus)), -F.col(value))
    return df.groupBy(*_list(by)).agg(F.coalesce(F.sum(signed), F.lit(0)).alias(name))


def allocate(weights: DataFrame, weight: str, pool: DataFrame, amount: str, name: str = "allocated") -> DataFrame:
    """Split the sum of a pool by each row's part of the total weight."""
    total = weights.agg(F.sum(weight).alias("w"))
    sum_ = pool.agg(F.sum(amount).alias("p"))
    part = F.try_divide(F.col(weight).cast("decimal(28,10)"), total.scalar())
    return weights.withColumn(name, part * sum_.scalar())


# --- audits -------------------------------------------------------------------------------

def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows, distinct keys and surplus rows of a key candidate."""
    per_key = df.groupBy(*_list(key)).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("row_cnt"),
        F.count(F.lit(1)).alias("key_cnt"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("dup_cnt"),
    )


def reconcile(parts: Mapping[str, DataFrame], whole: DataFrame) -> DataFrame:
    """Row counts of the parts and of the whole, and whether they agree."""
    counts = [df.agg(F.count(F.lit(1)).alias("cnt")).withColumn("part", F.lit(n)) for n, df in parts.items()]
    split = reduce(DataFrame.unionByName, counts).agg(F.sum("cnt").alias("part_cnt"))
    read = whole.agg(F.count(F.lit(1)).alias("whole_cnt"))
    return split.select("part_cnt", read.scalar().alias("whole_cnt")).withColumn(
        "balanced", F.when(F.col("part_cnt") == F.col("whole_cnt"), "Y").otherwise("N")
    )


def per_day(df: DataFrame, ts: str, name: str = "cnt") -> DataFrame:
    return df.groupBy(F.to_date(F.col(ts)).alias("day")).agg(F.count(F.lit(1)).alias(name))


def ready(df: DataFrame, cond: Column, period: str) -> DataFrame:
    """Gate for a run: exactly one period among the rows that meet the condition."""
    found = df.where(cond).agg(F.count_distinct(period).alias("periods"), F.count(F.lit(1)).alias("row_cnt"))
    return found.withColumn("ready", F.when((F.col("periods") == 1) & (F.col("row_cnt") > 0), "Y").otherwise("N"))
