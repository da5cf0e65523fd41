"""Order, limits and placement of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """First n rows of an order; end the order on a unique key."""
    return df.orderBy(*order).limit(n)


def cluster(df: DataFrame, by: Sequence[Column | str], n: int | None = None, sort: Sequence[Column | str] = (), salt: int = 0) -> DataFrame:
    """Bring rows of a key together and sort each part.

    `salt` spreads every key over that many parts, for keys that hold too much for one task.
    """
    keys = list(by)
    if salt > 1:
        keys.append(F.pmod(F.xxhash64(*df.columns), F.lit(salt)))
    out = df.repartition(n, *keys) if n else df.repartition(*keys)
    return out.sortWithinPartitions(*sort) if sort else out


PART_ROWS = 500_000


def modulo_parts(df: DataFrame, key: str, parts: int = 255, part_rows: int = PART_ROWS) -> DataFrame:
    """Key modulo by key modulo, each sorted by key.

    A part is one task up to about `part_rows` rows; beyond that it is a run of tasks by ranges of the key, in order,
    so that no task grows with the table. Rows of one key stay together.
    """
    part = F.pmod(F.col(key), F.lit(parts))
    pieces = -(-df.count() // (part_rows * parts))
    if pieces <= 1:
        return df.repartition(parts, part).sortWithinPartitions(key)
    return df.repartitionByRange(parts * pieces, part, F.col(key)).sortWithinPartitions(part, key)
