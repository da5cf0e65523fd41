"""Size checks that decide between a broadcast and a shuffle, and bounded reads of small sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate for `df`; None where the session does not give one."""
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return None
    return int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))


def hint_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint when the estimate is under the bound; else unchanged, so the join shuffles."""
    size = estimated_bytes(df)
    return F.broadcast(df) if size is not None and size <= max_bytes else df


def small_values(df: DataFrame, columns: list[str], limit: int) -> list[tuple] | None:
    """Distinct values of `columns` in order, or None when there are more than `limit`."""
    rows = df.select(*columns).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        return None
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is None, v) for v in r))
