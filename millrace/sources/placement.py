"""Where rows of a partitioned table go: a plan from counts, so that every task writes about as many rows.

Partitions of such tables are uneven: one may hold a third of the rows, most hold few. A first pass counts rows by
partition. The partitions are then laid one behind the other on a line of row numbers and the line is cut into
equal tasks: a large partition is spread over as many tasks as it fills, and small ones share a task.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordering import with_running
from millrace.storage import settle

ROWS_PER_TASK = 5_000_000


def plan_tasks(df: DataFrame, by: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> tuple[DataFrame, int]:
    """(by, rows, files, before) for every partition, and the number of tasks.

    files: into how many equal parts the partition is dealt, none of more than half a task, so that a task holds
    between a half and one and a half of `rows_per_task` rows; before: rows of the partitions ahead of it.
    """
    by = list(by)
    counts = settle(df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows")), "partition_counts")
    total = counts.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    dealt = counts.withColumn("files", F.ceil(F.col("rows") * 2 / F.lit(rows_per_task)).cast("int"))
    return with_running(dealt, by, "rows", "before"), max(1, ceil(total / rows_per_task))


def place(df: DataFrame, by: Sequence[str], rows_per_task: int = ROWS_PER_TASK, sort: Sequence[str] = ()) -> DataFrame:
    """`df` dealt to tasks by such a plan, sorted by partition, then `sort`, within each task.

    The rows of a partition are spread by a hash of all their columns; rows that are equal in all columns stay
    together. The source is read twice, so it must give the same rows each time. Null partition values are one
    partition.
    """
    by = list(by)
    plan, tasks = plan_tasks(df, by, rows_per_task)
    named = plan.select(*[F.col(c).alias("_p_" + c) for c in by], F.col("rows").alias("_rows"), F.col("files").alias("_files"), F.col("before").alias("_before"))
    same = [df[c].eqNullSafe(named["_p_" + c]) for c in by]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    part = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.col("_files"))
    place_ = F.col("_before") + part * (F.col("_rows") / F.col("_files")) + F.col("_rows") / F.col("_files") / 2
    task = F.least(F.floor(place_ / rows_per_task), F.lit(tasks - 1)).cast("int")
    dealt = df.join(named, cond).withColumn("_task", task).repartitionById(tasks, "_task")
    return dealt.select(*df.columns).sortWithinPartitions(*by, *sort)
