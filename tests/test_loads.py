"""Placement of rows, the loads, and refreshes that break off."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from millrace.operators import with_running
from millrace.plans import records
from millrace.sources import writers as Wr
from millrace.sources.placement import place, plan_tasks
from millrace.sources.readers import read_partitioned
from millrace.storage import children


def sizes(df):
    return [r.n for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]


def test_no_task_above_twice_the_median(spark):
    """One partition holds a third of the rows, a hundred hold the rest."""
    df = spark.range(60_000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), (F.col("id") % 100).cast("string"))).alias("k"))
    found = sorted(sizes(place(df, ["k"], 4_000)))
    assert sum(found) == 60_000 and len(found) >= 14 and found[-1] <= 2 * found[len(found) // 2]
    assert place(df, ["k"], 4_000).exceptAll(df).count() == 0


def test_plan_counts_every_partition(spark):
    df = spark.createDataFrame([("a",)] * 5 + [(None,)] * 2 + [("b",)], "k string")
    plan, tasks = plan_tasks(df, ["k"], 4)
    assert tasks == 2
    assert sorted(((r.k, r.rows, r.files, r.before) for r in plan.collect()), key=str) == sorted([(None, 2, 1, 0), ("a", 5, 3, 2), ("b", 1, 1, 7)], key=str)
    assert place(df, ["k"], 4).count() == 8 and place(df.limit(0), ["k"], 4).count() == 0


def test_running_sums(spark):
    df = spark.createDataFrame([(i, i % 7 if i % 5 else None) for i in range(500)], "i int, v int").repartition(6)
    got = {r.i: r.before for r in with_running(df, "i", "v").collect()}
    total = 0
    for i in range(500):
        assert got[i] == total
        total += i % 7 if i % 5 else 0


def test_firewall_load_counts(spark, tmp_path):
    lines = [f'"{i}"|"{i}"|"1"|"{"2024-01-0" + str(i % 3 + 1) if i % 10 else "1924-01-01"} 10:00:0{i % 10}"|"web"|"10.0.{i % 2}.{i % 50}"|"192.0.2.1"' for i in range(400)]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(f"{tmp_path}/in")
    counts = records.load_firewall(spark, f"{tmp_path}/in", f"{tmp_path}/table", f"{tmp_path}/bad", rows_per_task=50)
    table = read_partitioned(spark, f"{tmp_path}/table")
    assert counts == {"accepted": table.count(), "rejected": spark.read.text(f"{tmp_path}/bad").count()} and sum(counts.values()) == 400 and counts["rejected"] > 0
    again = records.load_firewall(spark, f"{tmp_path}/in", f"{tmp_path}/table", f"{tmp_path}/bad", rows_per_task=50)
    assert again == counts and read_partitioned(spark, f"{tmp_path}/table").count() == 2 * counts["accepted"]


def test_trace_load_rejects_other_names(spark, tmp_path):
    df = spark.createDataFrame([("20240101", "e1", 1), ("20240102", "e2", 2), ("x", "y", 3)], "d string, e string, n int")
    made = Wr.write_named(df, f"{tmp_path}/in", ["d", "e"], lambda d, e: f"A{d}_x_{e}" if d != "x" else "other", header=True)
    assert made == 3 and children(spark, f"{tmp_path}/in") == ["A20240101_x_e1_000000.csv", "A20240102_x_e2_000001.csv", "other_000002.csv"]
    counts = records.load_trace(spark, f"{tmp_path}/in", f"{tmp_path}/table", f"{tmp_path}/bad")
    assert counts == {"accepted": 2, "rejected": 1}
    assert sorted((r.trx_date, r.event_id, r.n) for r in read_partitioned(spark, f"{tmp_path}/table").collect()) == [("20240101", "e1", "1"), ("20240102", "e2", "2")]


class Stop(Exception):
    pass


def stop_after(monkeypatch, name, calls=1):
    real, seen = getattr(Wr, name), []

    def fn(*a, **b):
        if len(seen) == calls:
            raise Stop
        seen.append(1)
        return real(*a, **b)

    monkeypatch.setattr(Wr, name, fn)


STEPS = [("_stage_window", 0), ("_commit_window", 0), ("_switch_window", 0), ("_close_window", 0)] + [("move", n) for n in range(4)] + [("drop_folder", n) for n in range(4)]


@pytest.mark.parametrize("step, calls", STEPS)
def test_refresh_survives_a_stop_at_every_step(spark, tmp_path, monkeypatch, step, calls):
    """What is read after the next run, or a recovery, is the old window or the new one, never a part of either."""
    target = f"{tmp_path}/t"
    old = spark.createDataFrame([(m, i) for m in ("01", "02", "03") for i in range(3)], "m string, v int")
    old.repartition(1).write.partitionBy("m").parquet(target)
    new = spark.createDataFrame([("02", 100), ("02", 101)], "m string, v int").repartition(2)
    whole = lambda: sorted((r.m, r.v) for r in read_partitioned(spark, target).select("m", "v").collect())
    before = whole()
    after = sorted([("01", i) for i in range(3)] + [("02", 100), ("02", 101)])
    with monkeypatch.context() as patch:
        stop_after(patch, step, calls)
        try:
            Wr.refresh_window(spark, new, target, "m", ["02", "03"])
        except Stop:
            committed = any(n.endswith(".manifest") for n in children(spark, f"{target}/_refresh"))
            if not committed:
                assert whole() in (before, after)
    finished = Wr.recover_windows(spark, target)
    assert whole() == (after if finished or step == "drop_folder" and calls >= 3 or whole() == after else before)
    assert [n for n in children(spark, f"{target}/_refresh")] == []
    Wr.refresh_window(spark, new, target, "m", ["02", "03"])
    assert whole() == after
    assert not any(n.startswith(".") for m in ("01", "02") for n in children(spark, f"{target}/m={m}"))


def test_refresh_may_read_its_own_table(spark, tmp_path):
    target = f"{tmp_path}/t"
    spark.createDataFrame([("01", 1), ("02", 2)], "m string, v int").write.partitionBy("m").parquet(target)
    doubled = read_partitioned(spark, target).withColumn("v", F.col("v") * 2)
    Wr.refresh_window(spark, doubled, target, "m", ["01"])
    assert sorted((r.m, r.v) for r in read_partitioned(spark, target).collect()) == [("01", 2), ("02", 2)]


def test_append_stamped(spark, tmp_path):
    Wr.append_stamped(spark.createDataFrame([(1, "a")], "v int, k string"), f"{tmp_path}/t", ["k"])
    (r,) = spark.read.parquet(f"{tmp_path}/t").collect()
    assert r.v == 1 and r.create_ts == r.refresh_ts and r.create_ts.date() >= date(2024, 1, 1)
