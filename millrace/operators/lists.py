"""List texts: split to rows, look up, put together again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.exprs import literal
from millrace.operators.aggs import list_agg
from millrace.operators.ordering import with_running


def split_rows(df: DataFrame, col: str, sep: str = ",", name: str = "item", keep_empty: bool = False) -> DataFrame:
    """One row per item with its place; a null or empty list keeps one row with a null item."""
    items = F.split(F.col(col), literal(sep))
    if not keep_empty:
        items = F.filter(F.transform(items, lambda x: F.trim(x)), lambda x: x != "")
    out = df.select("*", F.posexplode_outer(items).alias("_pos", name))
    return out.withColumn("pos", F.col("_pos") + 1).drop("_pos")


def number_rows(df: DataFrame, count: str, name: str = "n") -> DataFrame:
    """Repeat each row with 1..count; rows with a count below 1 go."""
    return df.where(F.col(count) >= 1).withColumn(name, F.explode(F.sequence(F.lit(1), F.col(count).cast("int"))))


def regroup(
    df: DataFrame, by: Sequence[str], col: str, lookup: DataFrame, key: str, label: str, sep: str = ",", name: str = "labels"
) -> DataFrame:
    """Split a list column, look every item up, and list the labels per group in item order."""
    items = split_rows(df.select(*by, col), col, sep)
    found = items.join(lookup.select(F.col(key).alias("item"), F.col(label).alias("_label")), "item", "left")
    return list_agg(found, by, "_label", ["pos", "_label"], sep, name=name)


PIECE_ITEMS = 10_000


def list_pieces(
    df: DataFrame, by: Sequence[str], value: str, order: Sequence[str], sep: str = ",", items: int = PIECE_ITEMS, name: str = "list_text"
) -> DataFrame:
    """Ordered lists of any length: (by, piece, items, name), each piece a text of at most `items` values.

    The pieces of a group, numbered from 0 and joined by the separator, are the text that `list_agg` makes; so a group
    may hold any part of the rows while a cell stays bounded. Equal values at the same place are counted first. Each
    entry gets its place in the whole order from sums over ranges of it, so a large group is spread over tasks, and a
    value that is repeated more often than a piece is long is spread over its pieces. Nulls of `value` are skipped.
    """
    by, order = list(by), list(order)
    marks = [f"_o{i}" for i in range(len(order))]
    kept = df.where(F.col(value).isNotNull()).select(*by, *[F.col(c).alias(m) for c, m in zip(order, marks)], F.col(value).cast("string").alias("_v"))
    counted = kept.groupBy(*by, *marks, "_v").agg(F.count(F.lit(1)).alias("_n"))
    placed = with_running(counted, [*by, *marks, "_v"], "_n", "_at")
    first = placed.groupBy(*by).agg(F.min("_at").alias("_first"))
    same = first.select(*[F.col(c).alias("_g_" + c) for c in by], "_first")
    cond = F.lit(True)
    for c in by:
        cond = cond & placed[c].eqNullSafe(same["_g_" + c])
    own = placed.join(same, cond).withColumn("_at", F.col("_at") - F.col("_first"))
    last = F.floor((F.col("_at") + F.col("_n") - 1) / items)
    cut = own.withColumn("piece", F.explode(F.sequence(F.floor(F.col("_at") / items), last)))
    begin = F.greatest(F.col("_at"), F.col("piece") * items)
    end = F.least(F.col("_at") + F.col("_n"), (F.col("piece") + 1) * items)
    cut = cut.withColumns({"_from": begin, "_times": end - begin})
    entry = F.struct("_from", "_v", "_times")
    text = F.array_join(F.flatten(F.transform(F.array_sort(F.collect_list(entry)), lambda x: F.array_repeat(x["_v"], x["_times"].cast("int")))), sep)
    return cut.groupBy(*by, "piece").agg(F.sum("_times").alias("items"), text.alias(name))
