"""Arriving files with an account of every batch: rows read, accepted and rejected.

A batch writes to folders that carry its number and replaces what is there, so a batch that runs again, after a
failure between its steps, adds nothing. Its line in the ledger is written last: rows count as loaded once the
ledger has their batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.writers import split_valid
from millrace.storage import children
from millrace.streaming.ingest import last_batch

LEDGER = "batch_id bigint, read_cnt bigint, accepted_cnt bigint, rejected_cnt bigint"


def take_batch(batch: DataFrame, number: int, root: str, valid: Callable[[DataFrame], Column]) -> None:
    """Write one batch: accepted rows, rejected rows, then its line in the ledger with what was found in the files."""
    spark = batch.sparkSession
    good, bad = split_valid(batch, valid(batch))
    counts = []
    for kind, rows in (("accepted", good), ("rejected", bad)):
        path = f"{root}/{kind}/batch_id={number}"
        rows.write.mode("overwrite").parquet(path)
        counts.append(spark.read.schema(rows.schema).parquet(path).count())
    line = spark.range(1).select(F.lit(number).cast("bigint").alias("batch_id"), F.lit(batch.count()).alias("read_cnt"), F.lit(counts[0]).alias("accepted_cnt"), F.lit(counts[1]).alias("rejected_cnt"))
    line.coalesce(1).write.mode("overwrite").parquet(f"{root}/ledger/batch={number}")


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """A row for each batch that is done."""
    if not children(spark, f"{root}/ledger"):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).option("recursiveFileLookup", True).parquet(f"{root}/ledger")


def loaded(spark: SparkSession, root: str, schema: T.StructType | str, kind: str = "accepted") -> DataFrame:
    """The rows of one kind, `accepted` or `rejected`, from batches that the ledger has, with their batch_id."""
    if not children(spark, f"{root}/{kind}"):
        return spark.createDataFrame([], schema).withColumn("batch_id", F.lit(None).cast("bigint"))
    own = spark.createDataFrame([], schema).schema.add("batch_id", "long")
    return spark.read.schema(own).parquet(f"{root}/{kind}").join(ledger(spark, root).select("batch_id"), "batch_id", "left_semi")


def unbalanced(spark: SparkSession, root: str) -> DataFrame:
    """Batches whose accepted and rejected rows do not come to the rows read."""
    return ledger(spark, root).where("read_cnt <> accepted_cnt + rejected_cnt")


def ingest_checked(
    spark: SparkSession, src: str, root: str, schema: T.StructType | str, valid: Callable[[DataFrame], Column], fmt: str = "csv", max_files: int = 100, options: dict | None = None
) -> int:
    """Take what has arrived, a few files a batch, oldest first, and stop; returns the number of batches.

    `valid` gives the test of a row; a row whose test is null is rejected. Which files are done is kept in
    `<root>/state`, the rows in `<root>/accepted` and `<root>/rejected`, the account in `<root>/ledger`.
    """
    state = f"{root}/state"
    before = last_batch(spark, state)
    df = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", max_files).options(**(options or {})).load(src)
    query = df.writeStream.foreachBatch(lambda batch, number: take_batch(batch, number, root, valid)).option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()
    return last_batch(spark, state) - before
