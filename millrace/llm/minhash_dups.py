"""Near-duplicate documents by ProbMinHash over weighted word shingles.

Each distinct five-word shingle of a document has the weight 1 + ln(count). A shingle sends points of a
Poisson process with its weight as rate; each point falls on one of m registers, and a register keeps the
shingle of its earliest point. A document is done when no shingle's next point can come before its latest
register. Two documents agree in a register with probability equal to their probability Jaccard similarity

    J(x, y) = sum over shared shingles d of 1 / sum over shingles e of max(x[e] / x[d], y[e] / y[d]),

which is the plain Jaccard similarity where all weights are 1. Registers are banded, members of a bucket are
linked to its leader, links are verified on the whole texts, and components of links are the groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import text as tx
from millrace.llm.components import SKETCH_BITS, SKETCH_LONGS, Checker, bit_sketches, linked_groups
from millrace.llm.store import Stages

U = np.uint64
SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 5
STEP = 0xD1B54A32D192ED03
REGISTERS = 1 << 18  # of all texts of a slice; 16 bytes each, and as much again while they are filled


def weights(counts: np.ndarray) -> np.ndarray:
    return 1.0 + np.log(counts)


def probminhash(codes: np.ndarray, who: np.ndarray, weight: np.ndarray, n: int, m: int) -> np.ndarray:
    """Registers (n x m) of n weighted sets: codes and weights of the elements, and the set of each.

    All sets go in step: every element's first point, then the second of those still in play, and so on. When
    few elements are left, each sends a block of points at once. Registers of an empty set stay 0.
    """
    best, sign = np.full(n * m, np.inf), np.zeros(n * m, U)
    time, k = np.zeros(len(codes)), 0
    live = np.arange(len(codes))
    while len(live):
        block = int(np.clip(40_000 // len(live), 1, 32))
        number = (np.arange(k + 1, k + block + 1, dtype=np.uint64) * U(STEP))[None, :]
        draw = tx.mix(codes[live][:, None] + number)
        gaps = -np.log(((draw >> U(11)).astype(np.float64) + 0.5) / 2.0**53) / weight[live][:, None]
        at = time[live][:, None] + np.cumsum(gaps, axis=1)
        register = who[live][:, None] * m + (tx.mix(draw ^ U(STEP)) % U(m)).astype(np.int64)
        time[live] = at[:, -1]
        flat_at, flat_register = at.ravel(), register.ravel()
        fresh = flat_at < best[flat_register]
        flat_at, flat_register = flat_at[fresh], flat_register[fresh]
        element = np.repeat(live, block)[fresh]
        np.minimum.at(best, flat_register, flat_at)
        won = flat_at == best[flat_register]
        sign[flat_register[won]] = codes[element[won]]
        latest = best.reshape(n, m).max(axis=1) if n else np.zeros(0)
        live = live[time[live] < latest[who[live]]]
        k += block
    return sign.reshape(n, m)


def band_keys(registers: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band of each signature."""
    parts = registers.reshape(len(registers), bands, rows)
    key = np.zeros((len(registers), bands), U) + np.arange(1, bands + 1, dtype=U)[None, :] * U(STEP)
    for r in range(rows):
        key = tx.mix(key * U(tx.BASE) + parts[:, :, r])
    return key.view(np.int64)


def weighted_shingles(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of the lower-cased texts, the text of each, and its weight."""
    data, offsets = tx.flat(pa.compute.utf8_lower(pa.compute.fill_null(texts, "").cast(pa.large_string())))
    hashes, owner, _, _ = tx.words(data, offsets)
    codes, who, counts = tx.distinct(*tx.shingles(hashes, owner, len(texts), k))
    return codes, who, weights(counts)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact probability Jaccard of two weighted sets, each as sorted distinct codes and their weights."""
    shared, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(shared):
        return 0.0
    x, y = a[1][i], b[1][j]
    ratio = y / x
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    below = np.cumsum(x) + (a[1].sum() - x.sum())
    above = b[1].sum() - np.cumsum(y)
    last = np.searchsorted(ratio, ratio, "right") - 1
    return float(np.sum(1.0 / (below[last] / x + above[last] / y)))


def signatures(docs: DataFrame, k: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(key, doc_id, words, bands): the text's digest, and the band keys of its signature, empty without words."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, rows=max(1, REGISTERS // (bands * rows))):
            codes, who, weight = weighted_shingles(part.column("text"), k)
            registers = probminhash(codes, who, weight, part.num_rows, bands * rows)
            some = np.bincount(who, minlength=part.num_rows) > 0
            keys = band_keys(registers[some], bands, rows)
            ends = np.concatenate([[0], np.cumsum(some * bands)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([part.column("key"), part.column("doc_id"), pa.ListArray.from_arrays(ends, pa.array(keys.ravel()))], ["key", "doc_id", "bands"])

    return docs.select(F.md5(F.coalesce("text", F.lit(""))).alias("key"), F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(tx.worker(sign), "key string, doc_id bigint, bands array<bigint>")


def verify(pairs: DataFrame, texts: DataFrame, k: int = SHINGLE, threshold: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b) of `texts.key` whose similarity is at least `threshold`."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for part in tx.slices(batches, "text_a", tx.SLICE_BYTES // 2):
            names, values = [], []
            for key, text in (("a", "text_a"), ("b", "text_b")):
                for name, value in zip(part.column(key).to_pylist(), part.column(text)):
                    if name not in known:
                        known[name] = (np.zeros(0, U), np.zeros(0))
                        names.append(name)
                        values.append(value)
            if names:
                codes, who, weight = weighted_shingles(pa.array([v.as_py() for v in values], pa.large_string()), k)
                at = np.searchsorted(who, np.arange(len(names) + 1))
                for i, name in enumerate(names):
                    known[name] = (codes[at[i] : at[i + 1]], weight[at[i] : at[i + 1]])
            found = [similarity(known[a], known[b]) for a, b in zip(part.column("a").to_pylist(), part.column("b").to_pylist())]
            keep = pa.array([x >= threshold - 1e-9 for x in found])
            yield pa.RecordBatch.from_arrays([part.column("a").filter(keep), part.column("b").filter(keep)], ["a", "b"])
            if sum(len(x[0]) for x in known.values()) > 2_000_000:
                known.clear()

    side = lambda c: texts.select(F.col("key").alias(c), F.col("text").alias(f"text_{c}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b").mapInArrow(tx.worker(check), "a string, b string")


def sketches(texts: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(key, sketch) of (key, text): a bit of each of many registers, see `components.Checker`."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, budget=tx.SLICE_BYTES // 4, rows=max(1, REGISTERS // SKETCH_BITS)):
            codes, who, weight = weighted_shingles(part.column("text"), k)
            bits = bit_sketches(probminhash(codes, who, weight, part.num_rows, SKETCH_BITS))
            ends = np.arange(part.num_rows + 1, dtype=np.int32) * SKETCH_LONGS
            yield pa.RecordBatch.from_arrays([part.column("key"), pa.ListArray.from_arrays(ends, pa.array(bits.ravel()))], ["key", "sketch"])

    return texts.select("key", "text").mapInArrow(tx.worker(draw), "key string, sketch array<bigint>")


def near_duplicates(docs: DataFrame, k: int = SHINGLE, threshold: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(text_key, class_key, class_id, class_size) for every distinct text of `docs` (columns doc_id, text; others are ignored).

    text_key is the MD5 of the text (null counts as empty), class_key that of the class's first text, class_id the
    smallest doc_id of the class (null if it has none), class_size its number of rows. Equal texts, also repeated
    rows and rows without a doc_id, are one class by their key alone. Texts without a word are only in the class
    of their equals. An empty table gives no rows.

    Buckets are handled without all their pairs, see `components.linked_groups`.
    """
    spark = docs.sparkSession
    stages = Stages(spark, "near-dups")
    signed = stages.keep(signatures(docs, k, bands, rows), "signed")
    distinct = stages.keep(signed.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.first("bands").alias("bands")), "distinct")
    stages.drop(signed)
    keyed = docs.select(F.md5(F.coalesce("text", F.lit(""))).alias("key"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")

    def verifier(keys: DataFrame):
        first = keys.join(distinct.select("key", F.col("doc_id").alias("first")), "key")
        chosen = keyed.join(first, (keyed.key == first.key) & keyed.doc_id.eqNullSafe(F.col("first")), "left_semi")
        texts = stages.keep(chosen.dropDuplicates(["key"]).select("key", "text"), "texts")
        return Checker(lambda pairs: verify(pairs, texts, k, threshold), lambda wanted: sketches(texts.join(wanted, "key", "left_semi"), k), threshold)

    roots = linked_groups(distinct.select("key", F.explode("bands").alias("bucket")), verifier, stages)
    grouped = distinct.join(roots, distinct.key == roots.node, "left").select("key", "doc_id", "copies", F.coalesce("root", "key").alias("class_key"))
    sizes = grouped.groupBy("class_key").agg(F.min("doc_id").alias("class_id"), F.sum("copies").alias("class_size"))
    grouped, sizes = stages.keep(grouped, "grouped"), stages.keep(sizes, "sizes")
    return grouped.join(sizes, "class_key").select(F.col("key").alias("text_key"), "class_key", "class_id", "class_size")


def _unused(docs: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores in front as it takes to be no column of `docs`."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name in taken:
            name = "_" + name
        out.append(name)
    return out


def labelled(docs: DataFrame, **options) -> DataFrame:
    """`docs` with class_id and class_size; columns of those names are replaced, all others kept."""
    rows = docs.drop("class_id", "class_size")
    (key,) = _unused(rows, "text_key")
    classes = near_duplicates(docs, **options).select(F.col("text_key").alias(key), "class_id", "class_size")
    return rows.withColumn(key, F.md5(F.coalesce("text", F.lit("")))).join(classes, key).drop(key)


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """One row of every class: that with the smallest doc_id (rows without one come last, then by text).

    Further rows that repeat the id and text of the one kept go. The columns are those of `docs`, whatever their names.
    """
    classes = near_duplicates(docs, **options)
    names = docs.columns
    key, id_, row = _unused(docs, "_key", "_id", "_row")
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c in names if docs.schema[c].dataType.typeName() != "map"])
    marked = docs.withColumns({key: F.md5(F.coalesce("text", F.lit(""))), id_: F.col("doc_id").cast("bigint"), row: hashed})
    numbered = Stages(docs.sparkSession, "near-dups-kept").keep(
        marked.select(F.col(key).alias("text_key"), F.col(id_).alias("id"), F.col(row).alias("row"))
        .join(classes.select("text_key", "class_key"), "text_key")
        .groupBy("class_key")
        .agg(F.min(F.struct(F.col("id").isNull().alias("no"), "id", "text_key", "row")).alias("w"))
        .select(F.col("w.text_key").alias("text_key"), F.col("w.id").alias("id"), F.col("w.row").alias("row")),
        "winners",
    )
    kept = marked.join(numbered, (marked[key] == numbered.text_key) & marked[id_].eqNullSafe(numbered.id) & (marked[row] == numbered.row), "left_semi")
    return kept.dropDuplicates([key, id_, row]).select(*[F.col(f"`{c}`") for c in names])
