"""Checks around a load: counts on both sides, key candidates, arrivals per day."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import duplicate_keys, per_day, reconcile


def load_balance(read: DataFrame, loaded: DataFrame, rejected: DataFrame) -> DataFrame:
    return reconcile({"loaded": loaded, "rejected": rejected}, read)


def key_candidates(df: DataFrame, candidates: Mapping[str, Sequence[str]]) -> DataFrame:
    """For each key candidate the rows, distinct keys and surplus rows."""
    parts = [duplicate_keys(df, list(cols)).withColumn("candidate", F.lit(name)) for name, cols in candidates.items()]
    return reduce(DataFrame.unionByName, parts)


def arrivals(df: DataFrame, ts: str = "ts") -> DataFrame:
    return per_day(df, ts)
