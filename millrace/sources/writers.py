"""Writers and partition upkeep."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.layout import cluster
from millrace.sources.placement import place
from millrace.storage import children, drop_folder, move, read_text, scratch_name, touch, write_text


def write_partitioned(
    df: DataFrame, path: str, by: Sequence[str], cluster_by: Sequence[str] | None = None, sort: Sequence[str] = (),
    mode: str = "append", codec: str = "zstd", max_rows_per_file: int = 0, salt: int = 0, rows_per_task: int = 0,
) -> None:
    """Parquet under partition folders. Rows are brought together by `cluster_by` (default `by`).

    Sorting inside the files keeps their min/max statistics narrow for key lookups. `salt` spreads
    every partition over several files; `rows_per_task` deals rows by a plan from the counts instead, so that only
    partitions that are too large for one task are spread (`placement.place`).
    """
    if rows_per_task:
        placed = place(df, by, rows_per_task, sort)
    else:
        placed = cluster(df, list(cluster_by or by), sort=[*by, *sort] if sort else (), salt=salt)
    writer = placed.write.mode(mode).partitionBy(*by).option("compression", codec)
    if max_rows_per_file:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    writer.parquet(path)


def write_parquet(df: DataFrame, path: str, block_mb: int | None = None, codec: str = "snappy", mode: str = "overwrite") -> None:
    writer = df.write.mode(mode).option("compression", codec)
    if block_mb:
        writer = writer.option("parquet.block.size", block_mb * 1024 * 1024)
    writer.parquet(path)


def write_csv(
    df: DataFrame, path: str, files: int | None = None, mode: str = "append", codec: str | None = "gzip", sep: str = ",",
    header: bool = False, **options,
) -> None:
    """Separated text. `files` narrows the number of output files and is meant for small results."""
    if files:
        df = df.coalesce(files) if files > 1 else df.repartition(1)
    writer = df.write.mode(mode).options(sep=sep, header=header, **options)
    if codec:
        writer = writer.option("compression", codec)
    writer.csv(path)


def write_named(df: DataFrame, path: str, by: Sequence[str], name: Callable[..., str], header: bool = False, rows_per_file: int = 0) -> int:
    """CSV files named by the values of `by`, with a number after it; returns how many files.

    The files are written under partition folders, then renamed into one: work of the driver in proportion to files.
    """
    spark = df.sparkSession
    writer = df.repartition(*by).write.partitionBy(*by).options(header=header)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.csv(f"{path}/_parts")
    folders = [f"{path}/_parts"]
    for _ in by:
        folders = [f"{f}/{c}" for f in folders for c in children(spark, f) if "=" in c]
    made = 0
    for folder in folders:
        values = [p.split("=", 1)[1] for p in folder.split("/")[-len(by) :]]
        for old in children(spark, folder):
            move(spark, f"{folder}/{old}", f"{path}/{name(*values)}_{made:06d}.csv")
            made += 1
    drop_folder(spark, f"{path}/_parts")
    return made


def split_valid(df: DataFrame, cond: Column) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows; a row whose test is null is rejected."""
    ok = F.coalesce(cond, F.lit(False))
    return df.where(ok), df.where(~ok)


def _trimmed(df: DataFrame, trim: str | None) -> DataFrame:
    if trim is None:
        return df
    fn = {"both": F.trim, "right": F.rtrim}[trim]
    return df.select(*[fn(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in df.schema])


def unload(
    df: DataFrame, path: str, sep: str = ",", trim: str | None = None, date_format: str | None = None,
    timestamp_format: str | None = None, mode: str = "overwrite", header: bool = False, codec: str = "none",
) -> None:
    """Separated text with spaces trimmed around the separator and dates in a fixed form."""
    text = _trimmed(df, trim)
    dated = {}
    for f in text.schema:
        if isinstance(f.dataType, T.DateType) and date_format:
            dated[f.name] = F.date_format(f.name, date_format)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)) and timestamp_format:
            dated[f.name] = F.date_format(f.name, timestamp_format)
    if dated:
        text = text.withColumns(dated)
    keep = trim is None
    text.write.mode(mode).options(
        sep=sep, header=header, compression=codec, ignoreLeadingWhiteSpace=not keep, ignoreTrailingWhiteSpace=not keep
    ).csv(path)


def export_report(df: DataFrame, path: str, header: bool = True, sep: str = ",", remark: Sequence[str] = (), files: int | None = 1) -> None:
    """Report file with a header row; separators inside remark columns become pipes."""
    if remark:
        df = df.withColumns({c: F.translate(F.col(c), sep, "|") for c in remark})
    write_csv(df, path, files=files, mode="overwrite", codec="none", sep=sep, header=header)


def export_ordered(
    df: DataFrame, path: str, order: Sequence[Column | str], sep: str = ",", remark: Sequence[str] = (), header: bool = True
) -> int:
    """A report in a fixed order as numbered files: read in the order of their names they are the report.

    The first file is the header line, the others hold ranges of the order, each sorted by the task that wrote it;
    no task holds the whole. Separators inside remark columns become pipes. Returns the number of files.
    """
    spark = df.sparkSession
    if remark:
        df = df.withColumns({c: F.translate(F.col(c), sep, "|") for c in remark})
    drop_folder(spark, path)
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.options(sep=sep, header=False).csv(f"{path}/_parts")
    if header:
        write_text(spark, f"{path}/{0:06d}.csv", sep.join(df.columns) + "\n")
    parts = [n for n in children(spark, f"{path}/_parts") if n.startswith("part-")]
    for number, part in enumerate(parts, 1):
        move(spark, f"{path}/_parts/{part}", f"{path}/{number:06d}.csv")
    drop_folder(spark, f"{path}/_parts")
    return len(parts) + header


# --- window refresh -----------------------------------------------------------------------

REFRESH = "_refresh"


def _stage_window(spark: SparkSession, df: DataFrame, target: str, part_col: str, window: Sequence) -> str:
    """Write the recomputed rows beside the table; nothing that readers see changes."""
    run = scratch_name()
    inside = df.where(F.col(part_col).isin(list(window)))
    inside.write.partitionBy(part_col).parquet(f"{target}/{REFRESH}/{run}/new")
    return run


def _commit_window(spark: SparkSession, target: str, part_col: str, window: Sequence, run: str) -> None:
    """Write the manifest: which partitions are replaced, and which files each has and will have.

    It appears under its name at once. From here on the refresh is going to be finished, by this run or a later one.
    """
    folder = lambda root, v: f"{root}/{part_col}={v}"
    rows = {str(v): {"old": children(spark, folder(target, v)), "new": [n for n in children(spark, folder(f"{target}/{REFRESH}/{run}/new", v)) if n[0] not in "._"]} for v in window}
    write_text(spark, f"{target}/{REFRESH}/{run}.manifest", json.dumps({"column": part_col, "partitions": rows}))


def _switch_window(spark: SparkSession, target: str, run: str) -> None:
    """Do what the manifest says. Every step may be repeated: a file that is gone or moved already is passed over."""
    plan = json.loads(read_text(spark, f"{target}/{REFRESH}/{run}.manifest"))
    for value, files in plan["partitions"].items():
        home = f"{target}/{plan['column']}={value}"
        staged = f"{target}/{REFRESH}/{run}/new/{plan['column']}={value}"
        for name in files["new"]:
            move(spark, f"{staged}/{name}", f"{home}/.{name}")  # not seen by readers under this name
        for name in files["old"]:
            drop_folder(spark, f"{home}/{name}")
        for name in files["new"]:
            move(spark, f"{home}/.{name}", f"{home}/{name}")
        if not files["new"]:
            drop_folder(spark, home)


def _close_window(spark: SparkSession, target: str, run: str) -> None:
    drop_folder(spark, f"{target}/{REFRESH}/{run}")
    drop_folder(spark, f"{target}/{REFRESH}/{run}.manifest")


def recover_windows(spark: SparkSession, target: str) -> int:
    """Finish refreshes that broke off after their commit, remove what others left; returns how many were finished.

    Only one run may work on a table at a time.
    """
    found = children(spark, f"{target}/{REFRESH}")
    committed = [n.removesuffix(".manifest") for n in found if n.endswith(".manifest")]
    for run in committed:
        _switch_window(spark, target, run)
        _close_window(spark, target, run)
    for name in found:
        if not name.endswith(".manifest") and name not in committed:
            drop_folder(spark, f"{target}/{REFRESH}/{name}")
    return len(committed)


def refresh_window(spark: SparkSession, df: DataFrame, target: str, part_col: str, window: Sequence) -> None:
    """Replace the partitions of a window by the recomputed rows; other partitions are not touched.

    A partition of the window for which no row came out is removed. The rows are first written beside the table,
    then a manifest commits them, then files are switched by renames. A run that breaks off leaves the old window if
    that was before the manifest, and else a switch that the next run, or `recover_windows`, brings to its end; `df`
    may read the table itself.
    """
    recover_windows(spark, target)
    run = _stage_window(spark, df, target, part_col, window)
    _commit_window(spark, target, part_col, window, run)
    _switch_window(spark, target, run)
    _close_window(spark, target, run)


def append_stamped(df: DataFrame, path: str, by: Sequence[str] = (), mode: str = "append") -> None:
    """Write with audit columns for the time of the run."""
    stamped = df.withColumns({"create_ts": F.current_timestamp(), "refresh_ts": F.current_timestamp()})
    stamped.write.mode(mode).partitionBy(*by).parquet(path)


def stage(df: DataFrame, path: str) -> DataFrame:
    """Truncate and reload a stage, and read it back: cuts a long plan and survives lost executors."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def add_partition(spark: SparkSession, table: str, spec: Mapping[str, str], path: str | None = None) -> None:
    """Register a partition of a catalog table if it is not there."""
    keys = ", ".join(f"{k}='{v}'" for k, v in spec.items())
    where = f" LOCATION '{path}'" if path else ""
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({keys}){where}")


def drop_partitions_before(spark: SparkSession, table: str, column: str, before: str) -> int:
    """Drop the partitions of a catalog table with a value below `before`; returns how many."""
    specs = [r[0].split("/") for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    old = []
    for parts in specs:
        pairs = dict(p.split("=", 1) for p in parts)
        if pairs[column] < before:
            old.append("PARTITION (" + ", ".join(f"{k}='{v}'" for k, v in pairs.items()) + ")")
    if old:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(old))
    return len(old)


def drop_folders_before(spark: SparkSession, root: str, column: str, before: str) -> int:
    """The same for a partitioned folder without a catalog."""
    old = [n for n in children(spark, root) if n.startswith(column + "=") and n.split("=", 1)[1] < before]
    for name in old:
        drop_folder(spark, f"{root}/{name}")
    return len(old)


def resplit(spark: SparkSession, src: str, n: int, dst: str) -> None:
    """Text in files that cannot be split, rewritten as n files."""
    spark.read.text(src).repartition(n).write.mode("overwrite").option("compression", "gzip").text(dst)


def mark_complete(spark: SparkSession, path: str, name: str) -> str:
    """Empty marker file, written after a successful step."""
    marker = f"{path}/{name}.complete"
    touch(spark, marker)
    return marker
