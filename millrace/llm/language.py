"""Language identification by nearest centroid.

A text is a vector of hashed letter n-grams (one to four letters, word boundaries counting as a letter), weighted
by (1 + ln count) * idf and scaled to length 1. Each language has a few centroids, clustered from its training
texts on the sphere. A text gets the language of the centroid with the highest cosine; one that lies farther
from all centroids than training texts of its length ever do is marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import text as tx
from millrace.llm.store import Stages

U = np.uint64
DIMENSIONS = 1 << 14
ORDERS = (1, 2, 3, 4)
PER_LANGUAGE = 400  # training texts of a language: the bounded sample that the centroids are fitted on
CLUSTERS = 3
ROUNDS = 8
SLACK = 0.4
SLICE = tx.SLICE_BYTES // 8  # n-gram codes and their sort take some 150 bytes a letter
SHORT = 32  # texts with fewer letters say little: never rejected by distance
LENGTH_EDGES = np.array([8, 16, 32, 64, 128, 256, 1024])
UNKNOWN = "und"


def letters_only(texts: pa.Array) -> pa.Array:
    """Lower-cased texts in which each run of characters other than letters is one space."""
    lower = pc.utf8_lower(pc.fill_null(texts, "").cast(pa.large_string()))
    return pc.utf8_trim_whitespace(pc.replace_substring_regex(lower, r"[^\p{L}\p{M}]+", " "))


def ngram_vectors(texts: pa.Array, dimensions: int = DIMENSIONS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows (text, dimension, count) in order of text, and the number of letters of each text."""
    none, space = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
    padded = pc.binary_join_element_wise(none, letters_only(texts), none, space)
    data, offsets = tx.flat(padded)
    heads = np.flatnonzero((data & 0xC0) != 0x80)  # first bytes of characters
    code = data[heads].astype(U)
    width = np.diff(np.append(heads, len(data)))
    for j in (1, 2, 3):
        more = width > j
        code[more] = (code[more] << U(8)) | data[heads[more] + j]
    owner = np.searchsorted(offsets, heads, "right") - 1
    letters = np.bincount(owner[code != 32], minlength=len(texts)) if len(code) else np.zeros(len(texts), np.int64)
    places = []
    mixed = np.zeros(len(code), U)
    for n in ORDERS:
        length = len(code) - n + 1
        if length <= 0:
            break
        mixed = mixed[:length] * U(tx.BASE) + code[n - 1 :] + U(1)
        good = owner[:length] == owner[n - 1 :]
        if n == 1:
            good = good & (code[:length] != 32)
        slot = (tx.mix(mixed[good] + U(n)) % U(dimensions)).astype(np.int64)
        places.append(owner[:length][good] * dimensions + slot)
    if not places:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, letters
    cells, counts = np.unique(np.concatenate(places), return_counts=True)
    return cells // dimensions, cells % dimensions, counts, letters


def weighted(rows: np.ndarray, slots: np.ndarray, counts: np.ndarray, n: int, idf: np.ndarray) -> np.ndarray:
    """Values of the sparse rows, each row scaled to length 1."""
    value = (1.0 + np.log(counts)) * idf[slots]
    norm = np.sqrt(np.bincount(rows, value * value, minlength=n))
    return value / np.maximum(norm[rows], 1e-12)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # (number of languages * clusters) x dimensions; a language has consecutive rows
    owners: np.ndarray  # language number of each centroid
    limits: np.ndarray  # lowest cosine of an accepted text by length class

    def classify(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language number (-1: no letter), cosine, and whether rejected, of each text."""
        rows, slots, counts, letters = ngram_vectors(texts, len(self.idf))
        n = len(texts)
        value = weighted(rows, slots, counts, n, self.idf)
        best, cosine = np.full(n, -1), np.zeros(n)
        if len(self.owners):
            scores = np.empty((n, len(self.owners)))
            for c in range(len(self.owners)):
                scores[:, c] = np.bincount(rows, value * self.centroids[c][slots], minlength=n)
            nearest = scores.argmax(axis=1)
            some = letters > 0
            best[some], cosine[some] = self.owners[nearest[some]], np.clip(scores.max(axis=1)[some], 0, 1)
        far = cosine < self.limits[np.searchsorted(LENGTH_EDGES, letters, "right")]
        return best, cosine, far | (best < 0)


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the documents that no classifier learns from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def cluster(vectors: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """k-means on the sphere; starts from texts that are far apart, fewer centroids if there are fewer texts."""
    chosen = [0]
    near = vectors @ vectors[0]
    while len(chosen) < min(k, len(vectors)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, vectors @ vectors[chosen[-1]])
    centres = vectors[chosen].copy()
    for _ in range(rounds):
        nearest = (vectors @ centres.T).argmax(axis=1)
        for c in range(len(centres)):
            if (nearest == c).any():
                mean = vectors[nearest == c].mean(axis=0)
                centres[c] = mean / max(np.linalg.norm(mean), 1e-12)
    return centres


def training_vectors(batches: list[pa.RecordBatch], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dense vectors of the texts with a letter, sorted by their first 64 dimensions, and the letters of each.

    The order comes from the sparse rows, which are then put at their places: there is one dense copy at any time.
    """
    parts, sizes, n = [], [np.zeros(0, np.int64)], 0
    for part in tx.slices(batches, budget=SLICE):
        rows, slots, counts, letters = ngram_vectors(part.column("text"), len(idf))
        value = weighted(rows, slots, counts, part.num_rows, idf).astype(np.float32)
        some = letters > 0
        place, own = np.cumsum(some) - 1 + n, some[rows]
        parts.append((place[rows[own]].astype(np.int32), slots[own].astype(np.int32), value[own]))
        sizes.append(letters[some])
        n += len(sizes[-1])
    lengths = np.concatenate(sizes)
    head = np.zeros((n, min(64, len(idf))), np.float32)
    for rows, slots, value in parts:
        first = slots < head.shape[1]
        head[rows[first], slots[first]] = value[first]
    order = np.lexsort(head.T[::-1]) if n else np.zeros(0, np.int64)
    to = np.empty(n, np.int64)
    to[order] = np.arange(n)
    vectors = np.zeros((n, len(idf)), np.float32)
    while parts:
        rows, slots, value = parts.pop()
        vectors[to[rows], slots] = value
    return vectors, lengths[order]


def training_rows(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """(lang, text): at most `per_language` documents of each language, those with the smallest hash of their id.

    Ids are ranked without their texts, with a limit in every task before the shuffle, so a language that holds
    most rows moves no more than others. Held-out documents, null languages and null texts are left out.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = usable.select("lang", "doc_id").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_language).select("lang", "doc_id").distinct()
    return usable.select("lang", "doc_id", "text").where("text is not null").join(F.broadcast(ids), ["lang", "doc_id"]).select("lang", "text")


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, clusters: int = CLUSTERS, dimensions: int = DIMENSIONS, slack: float = SLACK) -> Model:
    """Centroids of each language of the training documents; fitted for each language in a task of its own.

    The sample is bounded by `per_language`; rejection limits are `slack` times the lowest cosine that training texts
    of a length class have with the centroids of their own language.
    """
    sample = training_rows(docs, per_language)

    def counts_of(table: pa.Table) -> pa.Table:
        total, n = np.zeros(dimensions, np.int64), 0
        for part in tx.slices(table.to_batches(), budget=SLICE):
            _, slots, _, letters = ngram_vectors(part.column("text"), dimensions)
            total += np.bincount(slots, minlength=dimensions)
            n += int((letters > 0).sum())
        tx.release()
        return pa.table({"lang": table.column("lang").slice(0, 1).cast(pa.string()), "n": [n], "df": [total.tolist()]})

    kept = Stages(docs.sparkSession, "language").keep(sample, "sample")
    seen = kept.groupBy("lang").applyInArrow(counts_of, "lang string, n bigint, df array<bigint>").collect()
    seen = sorted((r for r in seen if r.n), key=lambda r: r.lang)
    frequency = np.sum([r.df for r in seen], axis=0) if seen else np.zeros(dimensions)
    idf = np.log((1.0 + sum(r.n for r in seen)) / (1.0 + frequency)) + 1.0

    def centres_of(table: pa.Table) -> pa.Table:
        vectors, lengths = training_vectors(table.to_batches(), idf)
        if not len(vectors):
            return pa.table({"lang": pa.array([], pa.string()), "number": pa.array([], pa.int32()), "centre": pa.array([], pa.binary()), "low": pa.array([], pa.list_(pa.float64()))})
        centres = cluster(vectors, clusters)
        cosine = (vectors @ centres.T).max(axis=1)
        kind = np.searchsorted(LENGTH_EDGES, lengths, "right")
        low = [float(cosine[kind == c].min()) if (kind == c).any() else 2.0 for c in range(len(LENGTH_EDGES) + 1)]
        n = len(centres)
        del vectors
        tx.release()
        return pa.table({"lang": pa.array([table.column("lang")[0].as_py()] * n, pa.string()), "number": pa.array(range(n), pa.int32()), "centre": pa.array([c.astype(np.float32).tobytes() for c in centres], pa.binary()), "low": pa.array([low] * n, pa.list_(pa.float64()))})

    found = kept.groupBy("lang").applyInArrow(centres_of, "lang string, number int, centre binary, low array<double>").collect()
    found = sorted(found, key=lambda r: (r.lang, r.number))
    names = sorted({r.lang for r in found})
    centroids = np.array([np.frombuffer(r.centre, np.float32) for r in found], np.float32).reshape(-1, dimensions)
    low = np.min([r.low for r in found], axis=0) if found else np.full(len(LENGTH_EDGES) + 1, 2.0)
    longer = np.minimum.accumulate(low[::-1])[::-1]  # a class without training texts takes the next longer one's
    shorter = np.where(longer > 1.5, low[low < 1.5][-1] if (low < 1.5).any() else 0.0, longer)
    limits = shorter * slack
    limits[: np.searchsorted(LENGTH_EDGES, SHORT)] = 0.0
    return Model(names, idf, centroids, np.array([names.index(r.lang) for r in found], np.int64), limits)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """docs with lang_pred, lang_score and lang_rejected; columns of those names are replaced.

    lang_pred is `und`, with score 0 and rejected, for null texts, texts without a letter, and all texts if nothing
    could be learned. Equal texts get equal results; a tie goes to the first language by name.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # languages x clusters x dimensions floats
    names = [f for f in docs.columns if f not in ("lang_pred", "lang_score", "lang_rejected")]
    schema = docs.select(*[F.col(f"`{c}`") for c in names]).schema

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        known = pa.array([*model.languages, UNKNOWN], pa.string())
        for part in tx.slices(batches, budget=SLICE):
            best, cosine, far = model.classify(part.column("text"))
            picked = known.take(pa.array(np.where(best < 0, len(known) - 1, best)))
            yield pa.RecordBatch.from_arrays([*part.columns, picked, pa.array(cosine), pa.array(far)], [*part.schema.names, "lang_pred", "lang_score", "lang_rejected"])

    out = schema.add("lang_pred", "string").add("lang_score", "double").add("lang_rejected", "boolean")
    return docs.select(*[F.col(f"`{c}`") for c in names]).mapInArrow(tx.worker(apply), out)


def identified(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs` whose language is not rejected, with their own columns."""
    return predict(docs, fit(docs, **options)).where(~F.col("lang_rejected")).select(*[F.col(f"`{c}`") for c in docs.columns])
