"""Source tables by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """Parquet tables of one directory, read on first use and reachable as attributes."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory
        self._made: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self.spark.read.parquet(f"{self.directory}/{name}.parquet")
        return self._made[name]

    def put(self, name: str, df: DataFrame) -> DataFrame:
        """A derived table, found by later steps under its name (a stage)."""
        self._made[name] = df
        return df

    def stage(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A derived table that is made when first asked for."""
        return self._made[name] if name in self._made else self.put(name, make())

    def register(self, *names: str) -> None:
        for name in names:
            self[name].createOrReplaceTempView(name)


def register(name: str, df: DataFrame) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df
