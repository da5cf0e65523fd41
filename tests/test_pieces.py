"""Lists in pieces, pivots in blocks, exports in order, and batches with a ledger."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import list_agg, list_pieces, pivot_blocks, pivot_report
from millrace.sources import writers as Wr
from millrace.storage import children
from millrace.streaming import ledger


@pytest.mark.parametrize("items", [1, 7, 100])
def test_pieces_joined_are_the_list(spark, items):
    """One group holds a third of the rows; values repeat, and some are null."""
    rnd = random.Random(items)
    rows = [(rnd.choice(["hot", "a", "b", None]), rnd.choice([None, rnd.randrange(8)]), rnd.randrange(5)) for _ in range(900)]
    df = spark.createDataFrame(rows, "k string, v int, o int").repartition(5)
    whole = {r.k: r.x for r in list_agg(df, "k", "v", ["o", "v"], ";", name="x").collect()}
    got = {}
    for r in sorted(list_pieces(df, ["k"], "v", ["o", "v"], ";", items, "x").collect(), key=lambda r: (str(r.k), r.piece)):
        got.setdefault(r.k, []).append(r)
    assert {k: ";".join(r.x for r in p) for k, p in got.items()} == whole
    for parts in got.values():
        assert [r.piece for r in parts] == list(range(len(parts))) and all(r["items"] == items == r.x.count(";") + 1 for r in parts[:-1])


def test_one_value_many_times(spark):
    df = spark.range(10_000).select(F.lit("k").alias("k"), F.lit("v").alias("v"))
    got = list_pieces(df, ["k"], "v", ["v"], "", 3_000, "x").collect()
    assert sorted((r.piece, r["items"], len(r.x)) for r in got) == [(0, 3000, 3000), (1, 3000, 3000), (2, 3000, 3000), (3, 1000, 1000)]
    assert list_pieces(df.limit(0), ["k"], "v", ["v"]).count() == 0


def test_blocks_side_by_side_are_the_pivot(spark):
    df = spark.createDataFrame([(r, c, f"{r}-{c}") for r in "xy" for c in range(23) if (r, c) != ("y", 5)], "r string, c int, v string")
    wide = {r.r: [r[str(c)] for c in range(23)] for r in pivot_report(df, ["r"], "c", "v", list(range(23))).collect()}
    got = {}
    for r in pivot_blocks(df.withColumn("n", F.col("c") + 3), ["r"], "n", "v", 3, 10).collect():
        got.setdefault(r.r, {})[r.block] = [r[f"c{i}"] for i in range(10)]
    assert {k: [x for b in range(3) for x in v[b]][:23] for k, v in got.items()} == wide


def test_pivot_of_too_many_values_is_refused(spark):
    df = spark.range(1500).select(F.lit(1).alias("r"), F.col("id").alias("c"), F.lit("v").alias("v"))
    with pytest.raises(ValueError):
        pivot_report(df, ["r"], "c", "v")


def test_files_in_order_are_the_report(spark, tmp_path):
    rnd = random.Random(1)
    rows = [(rnd.randrange(10_000), f"t{i}", "a,b") for i in range(3000)]
    df = spark.createDataFrame(rows, "n int, t string, remark string").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        made = Wr.export_ordered(df, f"{tmp_path}/x", ["n", "t"], remark=["remark"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    names = sorted(children(spark, f"{tmp_path}/x"))
    assert made == len(names) > 2
    text = "".join((tmp_path / "x" / n).read_text() for n in names)
    assert text == "n,t,remark\n" + "".join(f"{n},{t},a|b\n" for n, t, _ in sorted(rows))
    Wr.export_ordered(df.limit(0), f"{tmp_path}/x", ["n"])
    assert "".join((tmp_path / "x" / n).read_text() for n in sorted(children(spark, f"{tmp_path}/x"))) == "n,t,remark\n"


SCHEMA = "k string, v int"


def arrivals(spark, tmp_path, number, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").csv(f"{tmp_path}/in")
    return number


def take(spark, tmp_path):
    return ledger.ingest_checked(spark, f"{tmp_path}/in", f"{tmp_path}/out", SCHEMA, lambda df: F.col("v") > 0, max_files=1)


def state(spark, tmp_path):
    rows = {k: sorted((r.k, r.v) for r in ledger.loaded(spark, f"{tmp_path}/out", SCHEMA, k).collect()) for k in ("accepted", "rejected")}
    return rows["accepted"], rows["rejected"], sorted(tuple(r) for r in ledger.ledger(spark, f"{tmp_path}/out").collect())


def test_a_batch_that_runs_again_adds_nothing(spark, tmp_path):
    arrivals(spark, tmp_path, 0, [("a", 1), ("b", -1)])
    arrivals(spark, tmp_path, 1, [("c", 2), ("d", 3), ("e", -5)])
    assert take(spark, tmp_path) == 2 and take(spark, tmp_path) == 0
    once = state(spark, tmp_path)
    assert once[:2] == ([("a", 1), ("c", 2), ("d", 3)], [("b", -1), ("e", -5)])
    assert sum(x[1] for x in once[2]) == 5 and ledger.unbalanced(spark, f"{tmp_path}/out").count() == 0
    for f in (tmp_path / "out/state/commits").glob("*1*"):  # as if the run had ended before the last commit
        f.unlink()
    assert take(spark, tmp_path) == 1
    assert state(spark, tmp_path) == once


@pytest.mark.parametrize("fails", ["rejected", "ledger"])
def test_a_batch_that_breaks_off_is_made_whole(spark, tmp_path, monkeypatch, fails):
    arrivals(spark, tmp_path, 0, [("a", 1), ("b", -1)])
    real = ledger.split_valid if fails == "rejected" else ledger.children

    def broken(*a, **b):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        if fails == "rejected":
            patch.setattr(ledger, "split_valid", lambda df, c: (real(df, c)[0], real(df, c)[1].withColumn("x", F.raise_error(F.lit("stopped")))))
        else:
            patch.setattr(type(spark), "range", broken)
        with pytest.raises(Exception):  # noqa: B017
            take(spark, tmp_path)
    assert state(spark, tmp_path) == ([], [], [])
    take(spark, tmp_path)
    assert state(spark, tmp_path) == ([("a", 1)], [("b", -1)], [(0, 2, 1, 1)])


def test_nothing_arrived(spark, tmp_path):
    (tmp_path / "in").mkdir()
    assert take(spark, tmp_path) == 0 and state(spark, tmp_path) == ([], [], [])
