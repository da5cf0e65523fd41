"""Named reports on the driver's tables, each with the SQL that states its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.sources.tables import Tables

Report = Callable[[Tables], DataFrame]

REPORTS: dict[str, Report] = {}
SQL: dict[str, str] = {}


def report(name: str, sql: str | None = None) -> Callable[[Report], Report]:
    def add(fn: Report) -> Report:
        if name in REPORTS:
            raise ValueError(f"two reports named {name}")
        REPORTS[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn

    return add


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn: Report):
        return lambda spark, sf_dir: fn(Tables(spark, sf_dir))

    return {name: bind(fn) for name, fn in REPORTS.items()}
