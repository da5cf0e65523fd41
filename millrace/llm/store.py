"""Intermediate results: written once to the folder that all executors share, and read back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """`spark.checkpoint.dir` of the session; a temporary folder only where it is unset in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="llm-")


TASKS_A_CORE = 4


class Stages:
    """Tables of one run. Each is written under the shared folder and may be dropped when it has been used."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
        self.count = 0

    def keep(self, df: DataFrame, name: str, narrow: bool = False) -> DataFrame:
        """Write `df` and return the table read back: its lineage ends here and lost executors lose nothing.

        narrow: for a step among many small ones. Its last stage runs in a few tasks a core, each taking several
        shuffle partitions one after the other, where that is fewer tasks: starting tasks and files is most of its cost.
        """
        self.count += 1
        path = f"{self.root}/{self.count:03d}-{name}"
        if narrow:
            df = df.coalesce(TASKS_A_CORE * self.spark.sparkContext.defaultParallelism)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, df: DataFrame) -> None:
        """Delete a kept table that nothing reads any more."""
        for path in df.inputFiles()[:1]:
            where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getParent()
            where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
