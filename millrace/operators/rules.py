"""Row rules: what the source did as table updates and deletes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.exprs import as_col


def select_where(df: DataFrame, predicate: Column | str) -> DataFrame:
    return df.where(predicate)


def drop_where(df: DataFrame, cond: Column | str) -> DataFrame:
    """Delete by predicate: a row goes only where the predicate is true, not where it is null."""
    cond = F.expr(cond) if isinstance(cond, str) else cond
    return df.where(~F.coalesce(cond, F.lit(False)))


def apply_rules(df: DataFrame, rules: Sequence[tuple[Column | str, Mapping[str, Column | str]]]) -> DataFrame:
    """Ordered updates. Each rule sees the columns as the rules before it left them."""
    for cond, values in rules:
        cond = F.expr(cond) if isinstance(cond, str) else cond
        exprs = {n: F.expr(v) if isinstance(v, str) else v for n, v in values.items()}
        df = df.withColumns({n: F.when(cond, v).otherwise(F.col(n)) for n, v in exprs.items()})
    return df


def apply_match(
    df: DataFrame, other: DataFrame, on: Sequence[str], values: Mapping[str, Column | str], guard: Column | None = None
) -> DataFrame:
    """Update columns from the matching row of `other` (one row per key); unmatched rows stay.

    Columns of `other` are seen by `values` under the prefix `m_`.
    """
    on = list(on)
    m = other.select(*on, *[F.col(c).alias("m_" + c) for c in other.columns if c not in on], F.lit(True).alias("_hit"))
    out = df.join(m, on, "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    if guard is not None:
        hit = hit & F.coalesce(guard, F.lit(False))
    new = {n: F.when(hit, as_col(v)).otherwise(F.col(n)) for n, v in values.items()}
    return out.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns])


def update_from_agg(
    df: DataFrame, other: DataFrame, on: Sequence[str], agg: Mapping[str, Column], guard: Column | None = None
) -> DataFrame:
    """Update columns from an aggregate of the matching rows of `other`."""
    on = list(on)
    grouped = other.groupBy(*on).agg(*[c.alias(n) for n, c in agg.items()])
    return apply_match(df, grouped, on, {n: F.col("m_" + n) for n in agg}, guard)
