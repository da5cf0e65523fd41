"""Groups of things that are alike: links within buckets, and connected components of links.

Every step is a join or an aggregate, and its result is written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import text as tx
from millrace.llm.store import Stages


def components(links: DataFrame, stages: Stages, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has a link; root is the smallest node of its component.

    Links may be of any type that has an order, repeat, and be given in either direction. Each round points
    every larger neighbour of a node at the smallest one, then does the same among the smaller neighbours.
    The result of a round is written to the shared folder. Links are two keys each, and a node's are reduced by
    partial aggregates before they meet.
    """
    edges = stages.keep(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "links",
        narrow=True,
    )
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where(F.col("u") != F.col("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        after = stages.keep(small.select("e.u", "e.v").where(F.col("u") != F.col("v")).distinct(), "links", narrow=True)
        # Done when every node points at one other, and none of those points on.
        ends = after.select("u", F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(after.select(F.col("v").alias("u"), F.lit(0).alias("out"), F.lit(1).alias("into")))
        ends = ends.groupBy("u").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
        if ends.where("out > 1 or (out = 1 and into = 1)").isEmpty():
            break
        edges = after
    return after.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(after.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


LEADERS = 3
SKETCH_LONGS = 32
SKETCH_BITS = 64 * SKETCH_LONGS
DEVIATIONS = 4.5
STEP = 0xD1B54A32D192ED03


@dataclass
class Checker:
    """How pairs of keys are checked.

    links: keeps those of given pairs (a, b) that are links; sketches: (key, sketch) for given keys, arrays of
    SKETCH_LONGS numbers whose bits differ between two keys with probability (1 - similarity) / 2; threshold: the
    similarity of a link.
    """

    links: Callable[[DataFrame], DataFrame]
    sketches: Callable[[DataFrame], DataFrame]
    threshold: float

    def most_different(self) -> int:
        """Bits in which the sketches of a link differ at most, but for one link in 300,000."""
        p = (1 - self.threshold) / 2
        return int(SKETCH_BITS * p + DEVIATIONS * (SKETCH_BITS * p * (1 - p)) ** 0.5)


def bit_sketches(registers: np.ndarray) -> np.ndarray:
    """Sketches from SKETCH_BITS min-hash registers of each key: a bit of each register.

    The register's number is mixed in: an element that holds many registers gives each an independent bit.
    """
    numbers = np.arange(1, registers.shape[1] + 1, dtype=np.uint64) * np.uint64(STEP)
    bits = np.packbits((tx.mix(registers ^ numbers[None, :]) & np.uint64(1)).astype(np.uint8), axis=1)
    return bits.view("<i8").reshape(len(registers), SKETCH_LONGS)


def linked_groups(buckets: DataFrame, verifier: Callable[[DataFrame], Checker], stages: Stages) -> DataFrame:
    """(node, root) for keys that share a bucket with others, from (bucket, key): keys of a bucket may be linked.

    verifier: gets the (distinct) keys that share a bucket, once, and returns how to check pairs of them. Not all
    pairs of a bucket are made. Its keys are held against a few leaders, the
    first by different hashes of the key, so that buckets of one group mostly have the same ones. Keys that are
    still outside the bucket's largest component are held against another leader of it, as long as that brings
    many of them in. What is left then is compared by sketch, within the join, with all keys of other components
    of its bucket, and pairs that may be links by their sketches are checked: no link between components is lost, and
    what could only confirm a component is left out.
    """
    shared = buckets.groupBy("bucket").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low != high").select("bucket")
    members = stages.keep(buckets.join(stages.keep(shared, "buckets", narrow=True), "bucket").distinct(), "members", narrow=True)
    checker = verifier(members.select("key").distinct())
    verify = checker.links
    rank = lambda seed: F.struct(F.xxhash64(F.lit(seed), F.col("key")).alias("h"), F.col("key").alias("k"))
    pair = lambda x, y: [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]

    leaders = members.groupBy("bucket").agg(F.array(*[F.min(rank(s))["k"] for s in range(LEADERS)]).alias("leaders"))
    leaders = stages.keep(leaders, "leaders", narrow=True)
    first = members.join(leaders, "bucket").select("key", F.explode(F.array_distinct("leaders")).alias("leader")).where("key != leader")
    pairs = stages.keep(first.select(*pair("key", "leader")).distinct(), "pairs", narrow=True)
    links = stages.keep(verify(pairs), "links", narrow=True)
    roots = components(links, stages)
    placed = stages.keep(members.join(roots, members.key == roots.node, "left").select("bucket", "key", F.coalesce("root", "key").alias("root")), "placed", narrow=True)
    tried, seed, exact = pairs, LEADERS, False
    while True:
        sizes = placed.groupBy("bucket", "root").agg(F.count("*").alias("n"))
        largest = sizes.groupBy("bucket").agg(F.max(F.struct("n", "root"))["root"].alias("main"), F.count("*").alias("parts")).where("parts > 1").select("bucket", "main")
        apart = stages.keep(placed.join(stages.keep(largest, "largest", narrow=True), "bucket"), "apart", narrow=True)
        rest = apart.where("root != main").select("bucket", F.col("key").alias("x"), F.col("root").alias("root_x"))
        differs = F.col("root_x") != F.col("root_y")
        if exact:
            drawn = stages.keep(checker.sketches(apart.select("key").distinct()), "sketches", narrow=True)
            held = stages.keep(apart.groupBy("key").agg(F.collect_set("bucket").alias("held")).join(drawn, "key"), "held", narrow=True)  # a key has a bucket for each band at most
            side = lambda key, name: held.select(F.col("key").alias(key), F.col("held").alias(f"{name}_held"), *[F.col("sketch")[i].alias(f"{name}{i}") for i in range(SKETCH_LONGS)])
            others = stages.keep(apart.select("bucket", F.col("key").alias("y"), F.col("root").alias("root_y")).join(side("y", "v"), "y"), "others", narrow=True)
            rest = stages.keep(rest.join(side("x", "u"), "x"), "rest", narrow=True)
            bits = sum((F.bit_count(F.col(f"u{i}").bitwiseXOR(F.col(f"v{i}"))) for i in range(1, SKETCH_LONGS)), F.bit_count(F.col("u0").bitwiseXOR(F.col("v0"))))
            once = F.array_min(F.array_intersect("u_held", "v_held")) == rest["bucket"]  # a pair comes from the first bucket that it shares
            differs = differs & (bits <= checker.most_different()) & once
        else:
            chosen = apart.where("root = main").groupBy("bucket").agg(F.min(rank(seed))["k"].alias("y"), F.first("main").alias("root_y"))
            others = stages.keep(chosen, "leaders", narrow=True)
            others = others.select("bucket", "y", "root_y")
        more = rest.join(others, (rest["bucket"] == others["bucket"]) & differs).select(*pair("x", "y"), *[c.alias(n) for c, n in zip((F.least("root_x", "root_y"), F.greatest("root_x", "root_y")), ("root_a", "root_b"))])
        fresh = stages.keep(more.distinct().join(tried, ["a", "b"], "left_anti"), "pairs", narrow=True)
        count = fresh.count()
        found = stages.keep(verify(fresh.select("a", "b")), "links", narrow=True) if count else None
        hits = found.count() if count else 0
        if not hits and exact:
            return placed.select(F.col("key").alias("node"), "root").distinct()
        tried, seed, exact = tried.unionByName(fresh.select("a", "b")), seed + 1, hits * 20 < count or not hits
        if hits:
            merged = components(found.join(fresh, ["a", "b"]).select(F.col("root_a").alias("a"), F.col("root_b").alias("b")), stages)
            placed = stages.keep(placed.join(merged, placed.root == merged.node, "left").select("bucket", "key", F.coalesce(merged.root, placed.root).alias("root")), "placed", narrow=True)
