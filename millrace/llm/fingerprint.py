"""Fingerprints from statistically improbable features, kept in chained Bloom filters.

Every window of 64 bytes has an entropy. Windows are ranked by how rare their entropy is in the whole corpus; in
each stretch of windows the rarest is the stretch's favourite, and windows that are the favourite of enough
stretches are the text's features. Features go, in order, into Bloom filters of 2,048 bits, at most 160 in one
and then into the next. Two fingerprints are compared by the bits that their filters share, above what unrelated
filters as full share by chance and relative to what they could share at most.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import text as tx

U = np.uint64
WINDOW = 64
STRETCH = 64
POPULAR = 16
FILTER_BITS, FILTER_FEATURES, PROBES = 2048, 160, 5
BINS = 512
FULLEST = 0.98  # windows of nearly the highest entropy, and below of nearly none, say nothing of a text
EMPTIEST = 0.02
CHUNK = 1 << 16
SHARED_BY_CHANCE = 0.1

NLOGN = np.array([0.0] + [n * np.log2(n) for n in range(1, WINDOW + 1)])
SCALED = np.rint(NLOGN * 65536).astype(np.int64)


def entropies(data: np.ndarray) -> np.ndarray:
    """Entropy bin (0 to BINS-1) of each window of WINDOW bytes.

    Sliding by one byte changes the sum of n log n over the counts by the byte that leaves and the one that
    comes; how often those bytes occur in the window is counted lag by lag, in whole arrays.
    """
    n = len(data)
    if n < WINDOW:
        return np.zeros(0, np.int64)
    same_before, same_after = np.zeros(n, np.uint8), np.zeros(n, np.uint8)  # equal bytes among the WINDOW-1 before, after
    for lag in range(1, WINDOW):
        equal = (data[lag:] == data[:-lag]).view(np.uint8)
        same_before[lag:] += equal
        same_after[:-lag] += equal
    first = SCALED[np.bincount(data[:WINDOW], minlength=256)].sum()
    leaves, comes = same_after[: n - WINDOW].astype(np.int64) + 1, same_before[WINDOW:].astype(np.int64)
    total = np.empty(n - WINDOW + 1, np.int64)
    total[0] = 0
    equal = data[: n - WINDOW] == data[WINDOW:]
    change = SCALED[leaves - 1] - SCALED[leaves] + SCALED[comes + 1] - SCALED[comes]
    change[equal] = 0
    np.cumsum(change, out=total[1:])
    total += first
    top = int(SCALED[WINDOW])
    return np.clip((top - total) * BINS // (top + 1), 0, BINS - 1)


def each_entropy(data: np.ndarray) -> np.ndarray:
    """`entropies` piece by piece, so that memory does not grow with the text beyond its result."""
    return np.concatenate([entropies(data[at : at + CHUNK + WINDOW - 1]) for at in range(0, max(len(data) - WINDOW + 1, 1), CHUNK)])


def entropy_counts(docs: DataFrame) -> list[int]:
    """Number of windows in each entropy bin over all documents: BINS numbers, whatever the input."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BINS, np.int64)
        for part in tx.slices(batches):
            data, offsets = tx.flat(part.column("text"))
            bins = each_entropy(data)
            ends = np.repeat(offsets[1:], np.diff(offsets))[: len(bins)]
            total += np.bincount(bins[np.arange(len(bins)) + WINDOW <= ends], minlength=BINS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BINS, dtype=np.int32)), pa.array(total)], ["bin", "n"])

    rows = docs.select("text").mapInArrow(count, "bin int, n bigint").groupBy("bin").agg(F.sum("n").alias("n")).collect()
    found = {r.bin: r.n for r in rows}
    return [int(found.get(b, 0)) for b in range(BINS)]


def rarity(counts: list[int]) -> np.ndarray:
    """Rank of each entropy bin, the rarest first; bins at either end have none (-1), bins without windows come first."""
    order = sorted(range(BINS), key=lambda b: (counts[b], b))
    rank = np.empty(BINS, np.int64)
    rank[order] = np.arange(BINS)
    rank[: int(BINS * EMPTIEST)] = -1
    rank[int(BINS * FULLEST) :] = -1
    return rank


def features(data: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """First bytes of the features of a text, in order. A text shorter than a stretch of windows has its rarest window."""
    if len(data) < WINDOW:
        return np.zeros(0, np.int64)
    value = rank[each_entropy(data)]
    places = np.flatnonzero(value >= 0)
    if not len(places):
        return np.zeros(1, np.int64)
    width = int(len(data)).bit_length()
    key = np.where(value >= 0, value, BINS) << width | np.arange(len(value))  # the leftmost wins a tie
    best, size = key, 1
    while size < STRETCH and len(best) > 1:
        step = min(size, len(best) - 1)
        best = np.minimum(best[:-step], best[step:])
        size += step
    votes = np.bincount(best & ((1 << width) - 1), minlength=len(value))
    chosen = np.flatnonzero((votes >= POPULAR) & (value >= 0))
    return chosen if len(chosen) else np.array([int(key.argmin())])


def fingerprint(data: np.ndarray, rank: np.ndarray) -> bytes:
    """Two bytes with the number of features of each filter, then its bits, filter by filter.

    A text shorter than a window is one feature as a whole; an empty text has the empty fingerprint.
    """
    if not len(data):
        return b""
    at = features(data, rank)
    if len(at):
        powers = tx.powers(WINDOW)[0]
        hashes = np.concatenate([(tx.BYTE_CODES[data[at[i : i + 4096, None] + np.arange(WINDOW)]] * powers).sum(axis=1, dtype=U) for i in range(0, len(at), 4096)])
    else:
        hashes = (tx.BYTE_CODES[data] * tx.powers(len(data))[0]).sum(dtype=U, keepdims=True) + U(len(data))
    hashes = tx.mix(hashes)
    out = []
    for i in range(0, len(hashes), FILTER_FEATURES):
        own = hashes[i : i + FILTER_FEATURES]
        bits = np.zeros(FILTER_BITS, np.uint8)
        for probe in range(PROBES):
            bits[((own >> U(11 * probe)) % U(FILTER_BITS)).astype(np.int64)] = 1
        out.append(len(own).to_bytes(2, "little") + np.packbits(bits).tobytes())
    return b"".join(out)


def filters(print_: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of features and bits (as rows of packed bytes) of a fingerprint's filters."""
    rows = np.frombuffer(print_, np.uint8).reshape(-1, 2 + FILTER_BITS // 8)
    return rows[:, 0].astype(np.int64) + 256 * rows[:, 1].astype(np.int64), rows[:, 2:]


def likeness(a: bytes, b: bytes) -> float:
    """0 to 1: for each filter of the fingerprint with fewer, the best match in the other, averaged by features.

    Equal fingerprints give 1 (also empty ones), an empty and another 0.
    """
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    (na, fa), (nb, fb) = filters(a), filters(b)
    if (len(na), int(na.sum()), a) > (len(nb), int(nb.sum()), b):
        na, fa, nb, fb = nb, fb, na, fa
    ones_b = np.bitwise_count(fb).sum(axis=1, dtype=np.int64)
    total = 0.0
    for n, own in zip(na.tolist(), fa):
        ones = int(np.bitwise_count(own).sum(dtype=np.int64))
        shared = np.bitwise_count(own & fb).sum(axis=1, dtype=np.int64)
        most = np.minimum(ones, ones_b)
        chance = ones * ones_b / FILTER_BITS
        cut = chance + SHARED_BY_CHANCE * (most - chance) * np.minimum(1.0, ones / 200)
        score = np.where(most > cut, (shared - cut) / np.maximum(most - cut, 1e-9), 0.0)
        total += n * float(np.clip(score, 0, 1).max())
    return total / float(na.sum())


def fingerprints(docs: DataFrame, rank: np.ndarray) -> DataFrame:
    """docs with `fingerprint` (base64), a column of that name being replaced. Null text counts as empty."""
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != "fingerprint"])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches):
            data, offsets = tx.flat(part.column("text"))
            made = [base64.b64encode(fingerprint(data[a:b], rank)).decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(made, pa.string())], [*part.schema.names, "fingerprint"])

    return kept.mapInArrow(apply, T.StructType([*kept.schema.fields, T.StructField("fingerprint", T.StringType())]))


def in_order(docs: DataFrame, parts: int) -> DataFrame:
    """(part, doc_id, text, extra): rows by falling doc_id (null last, equal ids by text), cut to parts by id.

    Rows with one id are in one part. Every part but the last, in order, also has the first row of the part after
    it, and the very last row's successor is the first of all: these copies, one a part, are marked `extra`.
    The bounds of the parts are quantiles of the ids: as many numbers as parts.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ids = rows.select(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 10_000)).first()[0] if parts > 1 else []
    bounds = sorted(set(ids or []), reverse=True)
    edges = F.array(*[F.lit(int(b)).cast("bigint") for b in bounds]) if bounds else F.expr("cast(array() as array<bigint>)")
    part = F.when(F.col("doc_id").isNull(), F.lit(len(bounds) + 1)).otherwise(F.size(F.filter(edges, lambda e: F.col("doc_id") < e)))
    placed = rows.withColumn("part", part.cast("int"))
    tops = placed.groupBy("part").agg(F.max("doc_id").alias("top")).collect()
    present = sorted(r.part for r in tops)
    top = {r.part: r.top for r in tops}
    before = [(p, present[i - 1], top[p]) for i, p in enumerate(present)]
    if not before:
        return placed.withColumn("extra", F.lit(False))
    schema = "part int, goes int, top bigint"
    firsts = placed.join(F.broadcast(docs.sparkSession.createDataFrame(before, schema)), "part").where(F.col("doc_id").eqNullSafe(F.col("top")))
    firsts = firsts.groupBy("goes", "doc_id").agg(F.min("text").alias("text"))
    extra = firsts.select("doc_id", "text", F.col("goes").alias("part"), F.lit(True).alias("extra"))
    return placed.withColumn("extra", F.lit(False)).unionByName(extra)


def with_edits(docs: DataFrame, rank: np.ndarray, parts: int) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for every row.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many of the next
    document's (or all of them if it has fewer). Rows are in the order of `in_order`; the last one's next is
    the first. A single row is its own next.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple] = []
        size = 0
        held: tuple | None = None

        def flush() -> pa.RecordBatch:
            names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made), kinds)], names)

        for part in tx.slices(batches):
            for number, doc, text, extra in zip(*[part.column(c).to_pylist() for c in ("part", "doc_id", "text", "extra")]):
                own = fingerprint(np.frombuffer(text.encode(), np.uint8), rank)
                if held is not None and held[0] == number:
                    _, doc0, text0, print0 = held
                    half = len(text0) // 2
                    edited = (text0[: len(text0) - half] + text[:half]).encode()
                    edit = fingerprint(np.frombuffer(edited, np.uint8), rank)
                    code = [base64.b64encode(x).decode() for x in (print0, edit)]
                    made.append((doc0, len(text0), hashlib.sha256(edited).hexdigest(), *code, likeness(print0, edit), likeness(print0, own)))
                    size += len(code[0]) + len(code[1])
                held = None if extra else (number, doc, text, own)
                if size > 4 << 20:
                    yield flush()
                    made, size = [], 0
        if made:
            yield flush()

    schema = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    ordered = in_order(docs, parts)
    spread = ordered.repartition(F.col("part")).sortWithinPartitions("part", "extra", F.col("doc_id").desc_nulls_last(), "text")
    return spread.mapInArrow(apply, schema)
