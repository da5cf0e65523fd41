"""Pieces shared by the report plans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators import drop_in
from millrace.params import Window

Frames = Mapping[str, DataFrame]
LINE = ["cust_num", "subr_num"]


def pick(df: DataFrame, *same: str, **renamed: str | Column) -> DataFrame:
    """Columns under their own names, then columns under new ones."""
    extra = [(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in renamed.items()]
    return df.select(*same, *extra)


def within(c: str | Column, w: Window) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.between(F.lit(w.start), F.lit(w.end))


def not_returned(df: DataFrame, t: Frames, since=None, until=None) -> DataFrame:
    """Invoices without a return (dated in the span, when one is given)."""
    returns = t["pos_return_header"]
    if since is not None:
        returns = returns.where(F.col("trx_date") >= F.lit(since))
    if until is not None:
        returns = returns.where(F.col("trx_date") <= F.lit(until))
    return drop_in(df, returns, "inv_num")


def filled(df: DataFrame, keep: Sequence[str], defaults: Mapping[str, object]) -> DataFrame:
    """Some columns as they are, others with a default for null."""
    return df.select(*keep, *[F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in defaults.items()])
