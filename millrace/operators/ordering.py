"""Positions in a global order without a window over the whole set."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.storage import settle


def with_position(df: DataFrame, order: Sequence[Column | str] | Column | str, name: str = "position") -> DataFrame:
    """Rows numbered from 0 in `order`.

    The rows are dealt to ranges of the order and written with the number of their range. A range is numbered by
    itself, and the sizes of the ranges, one row each, give what lies before it. Equal rows share a range, so end
    `order` on a unique key where one value may be common.
    """
    order = [order] if isinstance(order, (str, Column)) else list(order)
    dealt = settle(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "positions")
    sizes = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_range", F.coalesce(F.sum("_n").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    nth = F.row_number().over(W.partitionBy("_range").orderBy(*order))
    numbered = dealt.withColumn("_nth", nth).join(F.broadcast(before), "_range")
    return numbered.select(*df.columns, (F.col("_before") + F.col("_nth") - 1).alias(name))


def with_running(df: DataFrame, order: Sequence[Column | str] | Column | str, value: str, name: str = "before") -> DataFrame:
    """Sums of `value` over all rows before each row in `order`, made like `with_position`; nulls count as 0."""
    order = [order] if isinstance(order, (str, Column)) else list(order)
    dealt = settle(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "running")
    none = F.lit(0).cast(df.schema[value].dataType)
    sizes = dealt.groupBy("_range").agg(F.sum(value).alias("_n"))
    ahead = lambda w, c: F.coalesce(F.sum(c).over(w.rowsBetween(W.unboundedPreceding, -1)), none)
    before = sizes.select("_range", ahead(W.orderBy("_range"), "_n").alias("_before"))
    inner = dealt.withColumn("_inner", ahead(W.partitionBy("_range").orderBy(*order), value))
    return inner.join(F.broadcast(before), "_range").select(*df.columns, (F.col("_before") + F.col("_inner")).alias(name))


def dense_positions(frames: Sequence[tuple[DataFrame, str]], value: str = "value", name: str = "position") -> DataFrame:
    """(value, position) of the distinct non-null values of several columns, numbered from 0 in order."""
    first, *more = [df.select(F.col(c).alias(value)) for df, c in frames]
    for df in more:
        first = first.unionByName(df)
    return with_position(first.where(F.col(value).isNotNull()).distinct(), value, name)
