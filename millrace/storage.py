"""Folders: where scratch data may go, and the few file-system calls the sinks need."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`; a temporary one only in local mode."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="millrace-")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the scratch root."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def scratch_name() -> str:
    return uuid.uuid4().hex


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that several later steps read, and read it back.

    The steps then share one result instead of one recomputation each, and the files outlive
    any executor.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where, jvm


def exists(spark: SparkSession, path: str) -> bool:
    fs, where, _ = _fs(spark, path)
    return fs.exists(where)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder, in order."""
    fs, where, _ = _fs(spark, path)
    if not fs.exists(where):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(where))


def drop_folder(spark: SparkSession, path: str) -> bool:
    fs, where, _ = _fs(spark, path)
    return fs.delete(where, True)


def touch(spark: SparkSession, path: str) -> None:
    fs, where, _ = _fs(spark, path)
    fs.create(where, True).close()


def move(spark: SparkSession, old: str, new: str) -> bool:
    """Rename one file, making the folder it goes to; False if `old` is not there."""
    fs, where, jvm = _fs(spark, old)
    if not fs.exists(where):
        return False
    goal = jvm.org.apache.hadoop.fs.Path(new)
    fs.mkdirs(goal.getParent())
    if not fs.rename(where, goal):
        raise OSError(f"{old} could not be renamed to {new}")
    return True


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole: written under another name, then renamed."""
    fs, where, jvm = _fs(spark, f"{path}.part")
    out = fs.create(where, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(where, jvm.org.apache.hadoop.fs.Path(path)):
        raise OSError(f"{path} could not be written")


def read_text(spark: SparkSession, path: str) -> str:
    fs, where, jvm = _fs(spark, path)
    stream = fs.open(where)
    try:
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
