"""Incremental file ingest: each arriving file is taken once, oldest first, a few per batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from millrace.storage import children


def last_batch(spark: SparkSession, checkpoint: str) -> int:
    """Number of the last batch that a checkpoint has committed; -1 before the first."""
    return max([int(n) for n in children(spark, f"{checkpoint}/commits") if n.isdigit()], default=-1)


def ingest_incremental(
    spark: SparkSession,
    src: str,
    sink: str,
    schema: T.StructType | str,
    checkpoint: str,
    fmt: str = "csv",
    max_files: int = 100,
    options: dict | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    partition_by: Sequence[str] = (),
    done_dir: str | None = None,
) -> int:
    """Take what has arrived and stop; returns the number of batches.

    Which files are done is kept in `checkpoint`, so a run that is broken off or repeated neither
    loses nor doubles a file. `done_dir` moves finished files there.
    """
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", max_files).options(**(options or {}))
    if done_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", done_dir)
    df = reader.load(src)
    if transform:
        df = transform(df)
    writer = df.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", sink)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    before = last_batch(spark, checkpoint)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return last_batch(spark, checkpoint) - before
