"""Stacking of row sets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stack(*dfs: DataFrame, distinct: bool = False) -> DataFrame:
    """UNION ALL by column name; `distinct` makes it UNION."""
    out = reduce(lambda a, b: a.unionByName(b), dfs)
    return out.distinct() if distinct else out


def with_header_rows(detail: DataFrame, header: DataFrame, order: str = "row_ord") -> DataFrame:
    """Header lines and detail lines in one set, told apart by an order column (header 0)."""
    return header.withColumn(order, F.lit(0)).unionByName(detail.withColumn(order, F.lit(1)), allowMissingColumns=True)


def printable(header: DataFrame, body: DataFrame, footer: DataFrame, part: str = "part_ord") -> DataFrame:
    """Header, body and footer of a printed report; sort by `part` and the body's own order."""
    parts = [f.withColumn(part, F.lit(i)) for i, f in enumerate((header, body, footer))]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def constant_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Fixed rows, such as a rate table, as a local relation whose size the optimizer knows."""
    fields = [part.split() for part in schema.split(",")]
    columns = {name: [r[i] for r in rows] for i, (name, _) in enumerate(fields)}
    df = spark.createDataFrame(pa.table(columns))
    return df.select(*[F.col(name).cast(type_).alias(name) for name, type_ in fields])
