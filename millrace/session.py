"""Session settings shared by the bench and the tests."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def session(app: str = "millrace", cpus: int | str | None = None, **conf: str) -> SparkSession:
    """A session for local runs; on a cluster, submit with the cluster's own settings instead."""
    cpus = cpus or os.environ.get("BENCH_CPUS") or "*"
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", os.environ.get("MILLRACE_SHUFFLE", "8"))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
