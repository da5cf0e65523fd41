"""Nearest neighbours by cosine through counted collisions of single projections.

Every vector, scaled to length 1, is projected on random directions; a sorted array of each projection is the index.
A query opens a window around its own projection in every array. The windows of radius R hold a vector at distance
R with a known probability each, so such a vector collides with the query in at least a known number of arrays, but
for a stated risk: vectors that collide so often are compared exactly. If fewer than k lie within R, the windows
grow and only what they take in anew is counted (virtual rehashing: no array is made again for another radius).

Rows are spread over groups of bounded size, each with arrays of its own; queries, a stated part of the rows, visit
every group. A group is one stream of rows, its vectors first and then the queries.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PROJECTIONS = 128
HALF_WIDTH = 1.0
RISK = 0.02
FIRST_RADIUS = 0.125
GROWTH = 2.0
GROUP_ROWS = 131_072
LEAST_ROWS = 1_024
CHUNK = 256
CHUNK_CELLS = 1 << 21
UNKNOWN = -2.0
SEED = 20_011


def collision_threshold(projections: int = PROJECTIONS, half_width: float = HALF_WIDTH, risk: float = RISK) -> int:
    """Collisions that a vector at the windows' radius has at least, but for a probability of `risk`.

    A projection of the difference is normal with the distance as its deviation, so one array collides with
    probability p = P(|z| <= half_width), and the count is binomial.
    """
    from math import erf, sqrt

    p = erf(half_width / sqrt(2))
    below, least = 0.0, 0
    while least < projections:
        below += comb(projections, least) * p**least * (1 - p) ** (projections - least)
        if below > risk:
            break
        least += 1
    return least


def unit(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and their lengths, both after a scaling by powers of two that keeps squares in range (and cosines as they are)."""
    most = np.abs(vectors).max(axis=1)
    scaled = np.ldexp(vectors, -np.frexp(most)[1][:, None])
    return scaled, np.sqrt((scaled * scaled).sum(axis=1))


class Arrays:
    """The sorted projections of one group's vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, projections: int, seed: int = SEED):
        self.ids, self.k = ids, k
        self.vectors, self.lengths = unit(vectors)
        self.directions = np.random.default_rng(seed).standard_normal((vectors.shape[1], projections))
        values = self.project(self.vectors, self.lengths)
        self.order = np.argsort(values, axis=0, kind="stable").T.astype(np.int32)
        self.sorted = np.take_along_axis(values, self.order.T, axis=0).T.copy()
        self.least = collision_threshold(projections)

    def project(self, vectors: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return ((vectors / lengths[:, None]) @ self.directions).astype(np.float32)

    def search(self, ids: np.ndarray, vectors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places in the group and cosines of the k nearest found of each query, nearest first, ties by id."""
        queries, lengths = unit(vectors)
        at = self.project(queries, lengths)
        step = max(1, min(CHUNK, CHUNK_CELLS // max(1, len(self.ids))))
        for a in range(0, len(ids), step):
            yield from self._together(ids[a : a + step], queries[a : a + step], lengths[a : a + step], at[a : a + step])

    def _windows(self, at: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each query's window of its radius begins and ends, in every array."""
        reach = (HALF_WIDTH * radius + 1e-5).astype(np.float32)
        low = [row.searchsorted(x - reach, "left") for row, x in zip(self.sorted, at.T)]
        high = [row.searchsorted(x + reach, "right") for row, x in zip(self.sorted, at.T)]
        return np.array(low, np.int64).T, np.array(high, np.int64).T

    def _together(self, own: np.ndarray, queries: np.ndarray, lengths: np.ndarray, at: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """One chunk of queries; a round widens the windows of those that are not done, each to its own radius."""
        n, size = len(self.ids), len(own)
        counts = np.zeros((size, n), np.int16 if len(self.sorted) < 1 << 15 else np.int32)
        known = np.full((size, n), UNKNOWN)
        known[own[:, None] == self.ids] = np.nan
        wanted = np.minimum(self.k, n - np.isnan(known).sum(axis=1))
        radius = np.full(size, FIRST_RADIUS)
        low = high = None
        active = np.flatnonzero(wanted)
        while len(active):
            fresh_low, fresh_high = self._windows(at[active], radius[active])
            again = []
            for k, q in enumerate(active):
                if low is None:
                    sides = [row[a:b] for row, a, b in zip(self.order, fresh_low[k], fresh_high[k])]
                else:
                    sides = [row[a:b] for row, a, b in zip(self.order, fresh_low[k], low[k])] + [row[a:b] for row, a, b in zip(self.order, high[k], fresh_high[k])]
                counts[q] += np.bincount(np.concatenate(sides), minlength=n).astype(counts.dtype)
                # No two vectors of length 1 are farther apart than 2: what is left then is compared as well.
                fresh = np.flatnonzero(((counts[q] >= self.least) | (radius[q] >= 2)) & (known[q] == UNKNOWN))
                known[q, fresh] = (self.vectors[fresh] * queries[q]).sum(axis=1) / (self.lengths[fresh] * lengths[q])
                checked = known[q][known[q] > UNKNOWN]
                if len(checked) < wanted[q]:
                    radius[q] = min(2.0, radius[q] * GROWTH)
                    again.append(k)
                    continue
                worst = -np.partition(-checked, wanted[q] - 1)[wanted[q] - 1]
                needed = np.sqrt(max(0.0, 2 - 2 * worst))  # the distance of the k-th: nothing farther is wanted
                if needed > radius[q] and radius[q] < 2:
                    radius[q] = min(radius[q] * GROWTH, needed)
                    again.append(k)
            active, low, high = active[again], fresh_low[again], fresh_high[again]
        out = []
        for q in range(size):
            checked = np.flatnonzero(known[q] > UNKNOWN)
            best = checked[np.lexsort((self.ids[checked], -known[q, checked]))[: wanted[q]]]
            out.append((best, known[q, best]))
        return out


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, not zero, all components finite."""
    return vector.isNotNull() & F.exists(vector, lambda x: x != 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def nearest(rows: DataFrame, is_query: Column, k: int = 5, id_: str = "vec_id", vector: str = "embedding", projections: int = PROJECTIONS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest other rows that are found of every row for which `is_query` holds.

    score is the cosine in double precision, rank counts from 1, ties go to the smaller id; a query has fewer rows if
    there are fewer others. A neighbour is missed with probability `RISK` at most, however far it is. Vectors that
    are null, zero, or hold a null or non-finite component take no part, nor do rows without an id. Of rows with
    one id and as many components, that with the smallest vector counts. Vectors are compared with those of as many
    components only. Copies are neighbours like any other. Other columns are not read; an empty table gives no rows.

    Memory: a group holds GROUP_ROWS vectors and their projections; queries stream by. A query row is sent once a
    group, and comes back with k rows of each.
    """
    spark = rows.sparkSession
    plain = rows.select(F.col(f"`{id_}`").cast("bigint").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    plain = plain.where(F.col("id").isNotNull() & usable(F.col("vector"))).withColumn("dim", F.size("vector"))
    count = plain.count()
    groups = max(ceil(count / GROUP_ROWS), min(2 * spark.sparkContext.defaultParallelism, ceil(count / LEAST_ROWS)), 1)
    vectors = plain.select(F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int").alias("group"), "dim", F.lit(0).alias("kind"), "id", "vector")
    asked = plain.where("asks").groupBy("id", "dim").agg(F.min("vector").alias("vector"))
    queries = asked.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), "dim", F.lit(1).alias("kind"), "id", "vector")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the group at hand
        ids: list[np.ndarray] = []
        stock: list[np.ndarray] = []
        arrays: Arrays | None = None
        for batch in batches:
            numbers = {c: batch.column(c).to_numpy() for c in ("group", "dim", "kind", "id")}
            change = np.ones(batch.num_rows, bool)
            for c in ("group", "dim", "kind"):
                change[1:] &= numbers[c][1:] == numbers[c][:-1]
            starts = np.flatnonzero(~change | (np.arange(batch.num_rows) == 0))
            for a, b in zip(starts, np.append(starts[1:], batch.num_rows)):
                group, dim, kind = (int(numbers[c][a]) for c in ("group", "dim", "kind"))
                values = batch.column("vector").slice(a, b - a).flatten().to_numpy().reshape(b - a, dim)
                if (group, dim) != held:
                    held, ids, stock, arrays = (group, dim), [], [], None
                if kind == 0:
                    ids.append(numbers["id"][a:b])
                    stock.append(values)
                    continue
                if arrays is None:
                    if not ids:  # no vector of these many components in this group
                        continue
                    every, place = np.unique(np.concatenate(ids), return_index=True)  # the first of an id has its smallest vector
                    arrays = Arrays(every, np.concatenate(stock)[place], k, projections)
                    ids, stock = [], []
                out = list(arrays.search(numbers["id"][a:b], values))
                found = np.concatenate([x for x, _ in out])
                asking = np.repeat(numbers["id"][a:b], [len(x) for x, _ in out])
                yield pa.RecordBatch.from_arrays([pa.array(asking), pa.array(arrays.ids[found]), pa.array(np.concatenate([x for _, x in out]))], ["query_id", "vec_id", "score"])

    stream = vectors.unionByName(queries).repartitionById(groups, "group").sortWithinPartitions("group", "dim", "kind", "id", "vector")
    found = stream.mapInArrow(work, "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
