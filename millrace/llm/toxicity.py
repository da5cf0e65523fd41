"""Toxicity by non-negative positive-unlabelled learning.

A linear model over the character n-grams of a text's words, each with the logarithm of its count, is trained from
confirmed toxic texts (P) and unlabelled ones (U). With the class prior p and the loss l(z) = 1 / (1 + exp(z)), the
risk is

    p * mean over P of l(z)  +  max(0, mean over U of l(-z)  -  p * mean over P of l(-z)),

whose second term estimates the risk on clean texts; where a step would take it below zero, the step goes the
other way, so that the model cannot profit from explaining away unlabelled toxic texts.

Words alone do not do: in some languages what marks a toxic text is a sequence of letters inside ever new words,
which clean texts have too, less often. So n-grams count, not words, and how often they occur.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import text as tx
from millrace.llm.language import held_out
from millrace.llm.store import Stages

U = np.uint64
SLOTS = 1 << 20
ORDERS = (3, 4, 5, 6)
UNIT = 256  # values are whole numbers of 1 / UNIT, so that their sums are exact
POSITIVES, UNLABELLED = 4_000, 12_000  # the bounded samples that the model is fitted on
FIT_TASKS = 8
STRENGTH = 5.0  # standard errors by which an n-gram's mean value in P must exceed that in U
STEPS, RATE, DECAY = 300, 0.1, 1e-4


def gram_slots(texts: pa.Array, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, slot) pairs in order, with counts: hashed n-grams of lower-cased words of letters and apostrophes.

    A word has a space before and after it, so n-grams may begin or end with one, and never cross one. wanted: for
    each slot, whether it is asked for; others are passed over.
    """
    lower = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "").cast(pa.large_string())), r"[^\p{L}\p{M}']+", " ")
    none, space = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
    data, offsets = tx.flat(pc.binary_join_element_wise(none, pc.utf8_trim_whitespace(lower), none, space))
    heads = np.flatnonzero((data & 0xC0) != 0x80)  # first bytes of characters
    code = data[heads].astype(U)
    width = np.diff(np.append(heads, len(data)))
    for j in (1, 2, 3):
        more = width > j
        code[more] = (code[more] << U(8)) | data[heads[more] + j]
    owner = np.searchsorted(offsets, heads, "right") - 1
    spaces = np.concatenate([[0], np.cumsum(code == 32)])
    cells = [np.zeros(0, np.int64)]
    mixed = np.zeros(len(code), U)
    for n in range(1, max(ORDERS) + 1):
        length = len(code) - n + 1
        if length <= 0:
            break
        mixed = mixed[:length] * U(tx.BASE) + code[n - 1 :] + U(1)
        if n not in ORDERS:
            continue
        good = (owner[:length] == owner[n - 1 :]) & (spaces[n - 1 : n - 1 + length] == spaces[1 : 1 + length])  # none strictly inside
        slot = (tx.mix(mixed + U(n)) % U(SLOTS)).astype(np.int64)
        if wanted is not None:
            good &= wanted[slot]
        cells.append(owner[:length][good] * SLOTS + slot[good])
    cell, count = np.unique(np.concatenate(cells), return_counts=True)
    return cell // SLOTS, cell % SLOTS, count


def values(counts: np.ndarray) -> np.ndarray:
    """1 / UNIT of the value of an n-gram that occurs so often."""
    return np.rint(np.log1p(counts) * UNIT).astype(np.int64)


@dataclass
class Model:
    slots: np.ndarray  # sorted
    weights: np.ndarray
    bias: float

    def __post_init__(self):
        self.wanted = np.zeros(SLOTS, bool)
        self.wanted[self.slots] = True

    def scores(self, texts: pa.Array) -> np.ndarray:
        rows, slots, counts = gram_slots(texts, self.wanted)
        z = self.bias + np.bincount(rows, self.weights[np.searchsorted(self.slots, slots)] * values(counts) / UNIT, minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def risk(z: np.ndarray, positive: np.ndarray, prior: float) -> tuple[float, float, np.ndarray]:
    """The risk, its estimate on clean texts before the cut at 0, and the step's direction in each text's z."""
    n_p, n_u = int(positive.sum()), int((~positive).sum())
    s = 1 / (1 + np.exp(-np.clip(z, -30, 30)))  # l(-z); l(z) is 1 - s
    slope = s * (1 - s)
    toxic = prior * np.sum(1 - s[positive]) / n_p
    clean = np.sum(s[~positive]) / n_u - prior * np.sum(s[positive]) / n_p
    d_clean = np.where(positive, -prior / n_p, 1 / n_u) * slope
    if clean < 0:
        return toxic, clean, -d_clean
    return toxic + clean, clean, np.where(positive, -prior / n_p * slope, 0.0) + d_clean


def train(rows: np.ndarray, columns: np.ndarray, value: np.ndarray, positive: np.ndarray, k: int, prior: float) -> tuple[np.ndarray, float]:
    """Weights of k features and the bias, from their values in the sampled texts; positive: of each text, whether it is of P."""
    n = len(positive)
    w, b = np.zeros(k), float(np.log(prior / (1 - prior)))
    m1, m2 = np.zeros(k + 1), np.zeros(k + 1)
    for step in range(1, STEPS + 1):
        _, _, d = risk(b + np.bincount(rows, w[columns] * value, minlength=n), positive, prior)
        g = np.append(np.bincount(columns, d[rows] * value, minlength=k) + DECAY * w, d.sum())
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        move = RATE * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, b


def first_ids(ids: DataFrame, limit: int) -> DataFrame:
    """The `limit` distinct ids with the smallest hash; each task passes on that many at most."""
    return ids.where("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def fit(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    """A model from training rows only: labels (doc_id, toxic) and texts whose id is not held out.

    Fitted on at most `positives` texts labelled toxic and `unlabelled` texts taken without their labels; the
    prior is the share of toxic labels among all training labels. Without any of these, every score is 0. Of ids with
    several rows every row counts. N-grams are chosen by sums over the samples; only the chosen ones (SLOTS at
    most) and the samples' counts of those come to the driver. Texts are read whole, of any length.
    """
    known = labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull())
    prior = known.agg(F.avg(F.col("toxic").cast("double"))).first()[0] or 0.0
    ids = first_ids(known.where("toxic = 1").select("doc_id"), positives).withColumn("positive", F.lit(True))
    others = first_ids(docs.where(~held_out(F.col("doc_id"))).select("doc_id"), unlabelled).withColumn("positive", F.lit(False))
    stages = Stages(docs.sparkSession, "toxicity")
    sample = stages.keep(docs.select("doc_id", "text").join(F.broadcast(ids.unionByName(others)), "doc_id").repartition(FIT_TASKS), "sample")
    sizes = {r.positive: r.n for r in sample.groupBy("positive").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_p, n_u = sizes.get(True, 0), sizes.get(False, 0)
    if not n_p or not n_u:
        return Model(np.zeros(0, np.int64), np.zeros(0), -30.0)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, SLOTS), np.int64)  # of P, of U, of U squared
        for part in tx.slices(batches):
            rows, slots, counts = gram_slots(part.column("text"))
            value, of_p = values(counts), part.column("positive").to_numpy(zero_copy_only=False)[rows]
            for k, (use, x) in enumerate(((of_p, value), (~of_p, value), (~of_p, value * value))):
                total[k] += np.bincount(slots[use], x[use], minlength=SLOTS).astype(np.int64)
        some = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (some, *total[:, some])], ["slot", "p", "u", "uu"])

    mean_p, mean_u = F.col("p") / (n_p * UNIT), F.col("u") / (n_u * UNIT)
    spread = F.greatest(F.col("uu") / (n_u * UNIT * UNIT) - mean_u * mean_u, F.lit(0.0)) + 1.0 / n_u
    by_slot = sample.select("positive", "text").mapInArrow(tx.worker(sums), "slot bigint, p bigint, u bigint, uu bigint").groupBy("slot").agg(*[F.sum(c).alias(c) for c in ("p", "u", "uu")])
    chosen = np.array(sorted(r.slot for r in by_slot.where(mean_p - mean_u >= STRENGTH * F.sqrt(spread / n_p)).select("slot").collect()), np.int64)
    wanted = np.zeros(SLOTS, bool)
    wanted[chosen] = True

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches):
            rows, slots, counts = gram_slots(part.column("text"), wanted)
            ends = np.searchsorted(rows, np.arange(part.num_rows + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int32))) for x in (np.searchsorted(chosen, slots), values(counts))]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("positive"), *lists], ["doc_id", "positive", "columns", "values"])

    table = sample.mapInArrow(tx.worker(held), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, positive boolean, columns array<int>, values array<int>").toArrow()
    table = table.sort_by([("doc_id", "ascending"), ("positive", "ascending")]).combine_chunks()
    columns, value = (table.column(c).combine_chunks() for c in ("columns", "values"))
    rows = np.repeat(np.arange(table.num_rows), pc.list_value_length(columns).to_numpy())
    weights, bias = train(rows, columns.flatten().to_numpy(), value.flatten().to_numpy() / UNIT, table.column("positive").to_numpy().astype(bool), len(chosen), float(np.clip(prior, 1e-4, 1 - 1e-4)))
    return Model(chosen, weights, bias)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted) for every row; null texts count as empty and get the model's base score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most one weight for each slot, and a mark for each

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches):
            found = shared.value.scores(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found), pa.array((found >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.select("doc_id", "text").mapInArrow(apply, docs.select("doc_id").schema.add("score", "double").add("predicted", "integer"))
