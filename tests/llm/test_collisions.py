import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import collisions as m
from millrace.llm.queries import QUERIES

NAN, INF = float("nan"), float("inf")


def exact(rows, queries, k=5):
    """{query: [(score, vec_id), ...]} over all rows."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    lengths = np.sqrt((x * x).sum(1))
    out = {}
    for q in queries:
        at = int(np.flatnonzero(ids == q)[0])
        cosine = (x * x[at]).sum(1) / (lengths * lengths[at])
        order = [i for i in np.lexsort((ids, -cosine)) if i != at][:k]
        out[q] = [(float(cosine[i]), int(ids[i])) for i in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r.rank == len(out[r.query_id])
    return out


def test_query_on_the_given_vectors(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    want = exact(rows, [i for i, _ in rows if i % 50 == 0])
    got = found(QUERIES["op12_collision_counting"](spark, sf_dir))
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    assert np.mean([len(set(got[q]) & set(want[q])) / 5 for q in want]) >= 0.95
    assert all(s == dict((v, s) for s, v in want[q]).get(v, s) for q in want for s, v in got[q])


@pytest.mark.parametrize("spread", [0.05, 0.5, 3.0])
def test_recall_over_several_groups(spark, spread):
    rnd = np.random.default_rng(8)
    centres = rnd.standard_normal((40, 24))
    x = centres[rnd.integers(0, 40, 6000)] + spread * rnd.standard_normal((6000, 24))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = found(m.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0))
    want = exact(rows, list(got))
    assert len(got) == 120 and np.mean([len({v for _, v in got[q]} & {v for _, v in want[q]}) / 5 for q in got]) >= 0.95


def test_copies_come_by_id_and_exactly(spark):
    rnd = np.random.default_rng(2)
    same = rnd.standard_normal(16).tolist()
    rows = [(i, same) for i in range(1500)] + [(i, rnd.standard_normal(16).tolist()) for i in range(1500, 2200)]
    got = found(m.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id").isin(0, 700)))
    assert [v for _, v in got[0]] == [1, 2, 3, 4, 5] and [v for _, v in got[700]] == [0, 1, 2, 3, 4]


def test_opposite_and_few(spark):
    rows = [(0, [1.0, 0.0]), (50, [-1.0, 0.0]), (7, [-2.0, 0.0])]
    got = found(m.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0))
    assert got == {0: [(-1.0, 7), (-1.0, 50)], 50: [(1.0, 7), (-1.0, 0)]}
    alone = m.nearest(spark.createDataFrame(rows[:1], "vec_id long, embedding array<double>"), F.lit(True))
    assert alone.collect() == []


def test_what_takes_no_part(spark):
    rows = [(0, [1.0, 2.0], 1), (50, None, 1), (100, [], 1), (150, [0.0, 0.0], 1), (200, [NAN, 1.0], 1), (250, [INF, 1.0], 1), (300, [None, 1.0], 1), (None, [1.0, 2.0], 1), (1, [2.0, 1.0], 1), (1, [2.0, 1.0], 1), (1, [3.0, 1.0], 1), (2, [1.0, 2.0, 3.0], 1), (350, [1e300, 2e300], 1), (3, [1e-300, 0.0], 1), (50, [4.0, 1.0, 1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int").withColumnRenamed("score", "rank")
    got = found(m.nearest(df, F.col("vec_id") % 50 == 0))
    assert {q: [v for _, v in x] for q, x in got.items()} == {0: [350, 1, 3], 350: [0, 1, 3], 50: [2]}
    assert got[0][1][0] == 4 / (np.sqrt(5.0) * np.sqrt(5.0))
    assert m.nearest(df.where("false"), F.lit(True)).collect() == []


def test_threshold_is_the_binomial_one():
    rnd = np.random.default_rng(1)
    hits = (np.abs(rnd.standard_normal((20_000, m.PROJECTIONS))) <= m.HALF_WIDTH).sum(1)
    least = m.collision_threshold()
    assert (hits < least).mean() <= m.RISK + 0.005 and (hits < least + 1).mean() > m.RISK - 0.005
