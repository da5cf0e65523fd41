"""Document quality by perplexity under a small Kneser-Ney model of folded characters; `op9` takes `kneser_ney`, which folds none.

Characters are mapped to 64 symbols (letters by case, digits, common marks, other letters by code point), so that a
4-gram is a number below 2**24. The model is made from the 4-grams of all trusted texts: counts are summed per
task, then shuffled and joined by context, order by order, to probabilities and back-off weights. What is
gathered grows with the trusted texts until every 4-gram has been seen; its bound, 2**24 numbers, is what lets
the finished table be sent to the tasks that score texts, where joining each document's n-grams would shuffle
many times the text. A document's threshold is a quantile of the perplexities of trusted texts in its language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import text as tx
from millrace.llm.store import Stages

ORDER = 4
BITS = 6
SYMBOLS = 1 << BITS
QUANTILE = 0.995
START = 0

# Symbols of ASCII: fixed values, 0 stands before a text.
SPACE, NEWLINE, DIGIT, OTHER, UPPER = 27, 28, 29, 39, 40
MARKS = ".,!|%&$*#"  # 30 to 38


def symbol_table() -> np.ndarray:
    """Symbol of each code point below 2**16; lower-case letters 1 to 26, letters beyond ASCII 41 to 63."""
    table = 41 + np.arange(1 << 16) % 23
    table[:128] = OTHER
    table[[9, 11, 12, 32, 0xA0]] = SPACE
    table[[10, 13]] = NEWLINE
    table[48:58] = DIGIT
    table[65:91] = UPPER
    table[97:123] = np.arange(1, 27)
    table[[ord(c) for c in MARKS]] = np.arange(30, 30 + len(MARKS))
    return table.astype(np.uint8)


TABLE = symbol_table()


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The 4-gram that ends at each character, and the text of each; texts begin after ORDER - 1 start symbols."""
    joined = pc.fill_null(texts, "").cast(pa.large_string())
    lengths = pc.utf8_length(joined).to_numpy(zero_copy_only=False).astype(np.int64)
    data, _ = tx.flat(joined)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    symbols = TABLE[points & 0xFFFF].astype(np.int32)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(symbols)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    code = symbols.copy()
    for back in range(1, ORDER):
        earlier = np.zeros(len(symbols), np.int32)
        earlier[back:] = symbols[: len(symbols) - back]
        earlier[place < back] = START
        code |= earlier << np.int32(BITS * back)
    return code, owner


def gram_counts(texts: DataFrame) -> DataFrame:
    """(g, c): how often each 4-gram occurs in the `text`s; summed within a task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for part in tx.slices(batches):
            code, _ = grams(part.column("text"))
            if total is None:
                total = np.zeros(1 << (BITS * ORDER), np.int32)
                wide: dict[int, int] = {}
            seen, times = np.unique(code, return_counts=True)
            total[seen] += times.astype(np.int32)
            for g in seen[total[seen] > 1 << 30].tolist():
                wide[g] = wide.get(g, 0) + int(total[g])
                total[g] = 0
        if total is not None:
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen].astype(np.int64))], ["g", "c"])
            if wide:
                yield pa.RecordBatch.from_arrays([pa.array(list(wide), pa.int32()), pa.array(list(wide.values()), pa.int64())], ["g", "c"])

    return texts.select("text").mapInArrow(count, "g int, c bigint").groupBy("g").agg(F.sum("c").alias("c"))


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts 1, 2 and 3 or more, from the numbers of grams with counts 1 to 4.

    Where those are too few to tell, the discounts are 0.5, 1 and 1.5.
    """
    if min(n1, n2, n3, n4) == 0:
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    d = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(float(np.clip(x, 0.05, k)) for x, k in zip(d, (0.95, 1.95, 2.95)))  # type: ignore[return-value]


def smoothed(counts: DataFrame, lower: tuple[DataFrame, int] | None, stages: Stages) -> tuple[DataFrame, DataFrame]:
    """(g, p) and (context, gamma) of one order, from its counts (g, c) and the probabilities of the order below."""
    row = counts.agg(*[F.sum(F.when(F.col("c") == k, 1).otherwise(0)).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
    d1, d2, d3 = discounts(*[int(x or 0) for x in row])
    cut = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
    placed = counts.withColumn("context", F.shiftright("g", BITS))
    totals = placed.groupBy("context").agg(F.sum("c").alias("total"), F.sum(cut).alias("kept_back"))
    totals = totals.select("context", "total", (F.col("kept_back") / F.col("total")).alias("gamma"))
    own = placed.join(totals, "context").withColumn("suffix", F.col("g"))
    first = F.greatest(F.col("c") - cut, F.lit(0.0)) / F.col("total")
    if lower is None:
        table = own.select("g", (first + F.col("gamma") / SYMBOLS).alias("p"))
    else:
        below, mask = lower
        table = own.withColumn("suffix", F.col("g").bitwiseAND(mask)).join(below.withColumnsRenamed({"g": "suffix", "p": "below"}), "suffix")
        table = table.select("g", (first + F.col("gamma") * F.col("below")).alias("p"))
    return stages.keep(table, "grams"), totals.select("context", "gamma")


@dataclass
class Model:
    grams: list[np.ndarray]  # by order: seen grams, sorted
    logs: list[np.ndarray]  # their log probabilities
    contexts: list[np.ndarray]
    gammas: list[np.ndarray]  # logs of back-off weights

    def table(self) -> np.ndarray:
        """Log probability of every 4-gram, order by order: a seen one has its own, others back off."""
        value = np.full(SYMBOLS, -np.log(SYMBOLS), np.float32)
        for k in range(ORDER):
            if k:
                value = np.tile(value, SYMBOLS)
            back = np.zeros(SYMBOLS**k, np.float32)
            back[self.contexts[k]] = self.gammas[k]
            value += np.repeat(back, SYMBOLS)
            value[self.grams[k]] = self.logs[k]
        return value


def train(trusted: DataFrame) -> Model:
    """A model of the `text`s; all of them are counted. Without any, every symbol is as likely as the others."""
    stages = Stages(trusted.sparkSession, "perplexity")
    top = stages.keep(gram_counts(trusted), "counts")
    counts = {ORDER: top}
    for k in range(ORDER - 1, 0, -1):  # of lower orders: by how many different symbols a gram is preceded
        counts[k] = stages.keep(counts[k + 1].groupBy(F.col("g").bitwiseAND((1 << (BITS * k)) - 1).alias("g")).agg(F.count("*").alias("c")), "counts")
    parts: list[list[np.ndarray]] = [[], [], [], []]
    below = None
    for k in range(1, ORDER + 1):
        table, gammas = smoothed(counts[k], None if below is None else (below, (1 << (BITS * (k - 1))) - 1), stages)
        below = table
        made, back = table.toArrow().sort_by("g"), gammas.toArrow().sort_by("context")
        parts[0].append(made.column("g").to_numpy())
        parts[1].append(np.log(made.column("p").to_numpy().astype(np.float64)).astype(np.float32))
        parts[2].append(back.column("context").to_numpy())
        parts[3].append(np.log(np.clip(back.column("gamma").to_numpy().astype(np.float64), 1e-9, 1)).astype(np.float32))
    return Model(*parts)


_tables: dict[int, np.ndarray] = {}


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """docs without its text, with n_scored (characters) and `perplexity` per character (null for empty and null texts)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most 2**24 grams
    number = id(shared)
    kept = [c for c in docs.columns if c not in ("text", "n_scored", "perplexity")]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if number not in _tables:
            _tables.clear()
            _tables[number] = shared.value.table()
        logs = _tables[number]
        for part in tx.slices(batches):
            code, owner = grams(part.column("text"))
            n = np.bincount(owner, minlength=part.num_rows)
            total = np.bincount(owner, logs[code].astype(np.float64), minlength=part.num_rows)
            value = np.exp(-total / np.maximum(n, 1))
            out = pa.array(value, pa.float64(), mask=n == 0)
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], pa.array(n.astype(np.int64)), out], [*kept, "n_scored", "perplexity"])

    schema = T.StructType([*docs.select(*[F.col(f"`{c}`") for c in kept]).schema.fields, T.StructField("n_scored", T.LongType()), T.StructField("perplexity", T.DoubleType())])
    return docs.select(*[F.col(f"`{c}`") for c in kept], "text").mapInArrow(apply, schema)


def judged(values: DataFrame, ids: DataFrame, quantile: float) -> DataFrame:
    """(doc_id, lang, perplexity, threshold, keep) from (doc_id, lang, perplexity) and the distinct `trusted_id`s.

    threshold: that quantile of the perplexities of trusted texts of the row's language (null is a language of its
    own), or of all of them where a language has none, or none at all, which keeps everything. A text is kept if its
    perplexity is not above it; an empty or null one is not kept.
    """
    good = values.join(ids, F.col("doc_id") == F.col("trusted_id"), "left_semi").where("perplexity is not null")
    at: Column = F.percentile_approx("perplexity", F.lit(quantile), F.lit(10_000))
    limits = good.groupBy("lang").agg(at.alias("own"))
    whole = good.agg(at.alias("whole")).first()[0]
    told = values.alias("v").join(limits.alias("l"), F.col("v.lang").eqNullSafe(F.col("l.lang")), "left")
    threshold = F.coalesce(F.col("own"), F.lit(whole).cast("double"))
    keep = F.coalesce(F.col("perplexity") <= F.coalesce(threshold, F.lit(float("inf"))), F.lit(False))
    return told.select("doc_id", F.col("v.lang").alias("lang"), "perplexity", threshold.alias("threshold"), keep.alias("keep"))


def assess(docs: DataFrame, trusted_ids: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """(doc_id, lang, perplexity, threshold, keep) for every row of docs (doc_id, text, lang), see `judged`.

    trusted_ids: doc_id of trusted texts.
    """
    stages = Stages(docs.sparkSession, "perplexity")
    ids = trusted_ids.select(F.col("doc_id").cast("bigint").alias("trusted_id")).where("trusted_id is not null").distinct()
    # The ids grow with the table: the same join at every size, rather than a broadcast while they are few.
    trusted = docs.select("doc_id", "text").join(ids.hint("merge"), F.col("doc_id") == F.col("trusted_id"), "left_semi")
    model = train(trusted)
    return judged(stages.keep(scored(docs.select("doc_id", "lang", "text"), model), "scored"), ids, quantile)
