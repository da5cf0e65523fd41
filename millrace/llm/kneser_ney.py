"""Document quality by perplexity under an interpolated modified Kneser-Ney model of code points, made and asked by joins.

The alphabet is all code points; nothing is folded. An n-gram of up to six of them is two numbers, `hi` and `lo`, of
three code points (plus one) of 21 bits each; 0 stands before a text. A block is the rows of one task of the input. It
gives its distinct n-grams and how often each occurs in its trusted texts (0 where only others have it). From these the
counts are summed, and the probabilities of all n-grams asked for are made order by order by joins with the order below and with
the totals of contexts, all as Spark tables. Each block then gets the probabilities of its own n-grams and scores its texts.
So no n-gram is in more rows than there are blocks, and no table of n-grams passes the driver or is broadcast.

Trusted rows are marked by one bit a row, which is broadcast, so that texts are counted where they are read. The texts
move once, compressed, to meet their block's probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import text as tx
from millrace.llm.perplexity import QUANTILE, discounts, judged
from millrace.llm.store import Stages

ORDER = 4
LONGEST = 6
POINT = 21  # bits of a code point plus one
HALF = 3  # code points of a number
POINTS = 0x110000  # equally likely before anything is known
GRAM = ["hi", "lo"]
HELD = 1 << 21
PIECE = 4 << 20  # bytes of text that are compressed together
CODEC = 6


class Grams:
    """The n-grams that end at each character of some texts: distinct ones, the number of each character's, and its text."""

    def __init__(self, texts: pa.Array, order: int):
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        self.lengths = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        data, _ = tx.flat(texts)
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32).astype(np.int64) + 1
        place = np.arange(len(points)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        half = [np.zeros(len(points), np.int64), points.copy()]
        for back in range(1, order):
            earlier = np.zeros(len(points), np.int64)
            earlier[back:] = points[: len(points) - back]
            earlier[place < back] = 0
            half[back < HALF] |= earlier << (POINT * (back % HALF))
        (self.hi, first), (self.lo, second) = (numbered(h) for h in half)
        codes, self.at = numbered(first * max(len(self.lo), 1) + second)
        self.hi, self.lo = self.hi[codes // max(len(self.lo), 1)], self.lo[codes % max(len(self.lo), 1)]
        self.owner = np.repeat(np.arange(len(self.lengths)), self.lengths)


def numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in any order, and the place of each value among them."""
    coded = pa.array(values).dictionary_encode()
    return coded.dictionary.to_numpy(), coded.indices.to_numpy().astype(np.int64)


def block_grams(marked: DataFrame, order: int, most: int = HELD) -> DataFrame:
    """(block, hi, lo, c) from (block, text, trusted): each block's distinct n-grams and their number in its trusted texts.

    most: n-grams of slices that a task holds before it sums them.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        block = 0

        def summed() -> pa.Table:
            return pa.concat_tables(held).group_by(GRAM).aggregate([("c", "sum")]).select([*GRAM, "c_sum"]).rename_columns([*GRAM, "c"])

        for part in tx.slices(batches):
            block = part.column("block")[0].as_py()
            found = Grams(part.column("text"), order)
            good = part.column("trusted").to_numpy(zero_copy_only=False).astype(bool)
            times = np.bincount(found.at[np.repeat(good, found.lengths)], minlength=len(found.lo))
            held.append(pa.table({"hi": found.hi, "lo": found.lo, "c": times.astype(np.int64)}))
            if sum(len(h) for h in held[1:]) > max(most, len(held[0])):
                held = [summed()]
        if held:
            whole = summed().sort_by([("hi", "ascending"), ("lo", "ascending")])
            for piece in whole.to_batches(max_chunksize=1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(piece.num_rows, block, np.int32)), *piece.columns], ["block", *GRAM, "c"])

    return marked.select("block", "text", "trusted").mapInArrow(tx.worker(count), "block int, hi bigint, lo bigint, c bigint")


def shorter(order: int) -> dict[str, Column]:
    """An n-gram of that order without its first code point."""
    kept = order - 1
    lo = F.col("lo").bitwiseAND((1 << (POINT * kept)) - 1) if kept < HALF else F.col("lo")
    hi = F.col("hi").bitwiseAND((1 << (POINT * (kept - HALF))) - 1) if kept > HALF else F.lit(0).cast("bigint")
    return {"hi": hi, "lo": lo}


def context() -> dict[str, Column]:
    """An n-gram without its last code point."""
    moved = F.shiftleft(F.col("hi").bitwiseAND((1 << POINT) - 1), POINT * (HALF - 1))
    return {"c_hi": F.shiftright("hi", POINT), "c_lo": F.shiftright("lo", POINT).bitwiseOR(moved)}


def smoothed(counts: DataFrame, order: int, below: DataFrame | None) -> DataFrame:
    """(hi, lo, p) of all n-grams (hi, lo, c) of one order, also of those with c = 0, from the order below."""
    row = counts.agg(*[F.count_if(F.col("c") == k) for k in (1, 2, 3, 4)]).first()
    d1, d2, d3 = discounts(*row)
    cut = F.when(F.col("c") == 0, 0.0).when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
    placed = counts.withColumns(context())
    totals = placed.groupBy("c_hi", "c_lo").agg(F.sum("c").alias("total"), F.sum(cut).alias("kept_back"))
    own = placed.join(totals, ["c_hi", "c_lo"])
    if below is None:
        own = own.withColumn("below", F.lit(1 / POINTS))
    else:
        own = own.withColumns({f"s_{name}": value for name, value in shorter(order).items()})
        own = own.join(below.withColumnsRenamed({"hi": "s_hi", "lo": "s_lo", "p": "below"}), ["s_hi", "s_lo"])
    p = (F.col("c") - cut + F.col("kept_back") * F.col("below")) / F.col("total")
    return own.select(*GRAM, F.when(F.col("total") > 0, p).otherwise(F.col("below")).alias("p"))


def probabilities(asked: DataFrame, order: int, stages: Stages) -> DataFrame:
    """(hi, lo, p) of all n-grams in `asked` (hi, lo, c), which may have a gram in several rows."""
    counts = {order: stages.keep(asked.groupBy(*GRAM).agg(F.sum("c").alias("c")), "counts")}
    for k in range(order - 1, 0, -1):  # of lower orders: by how many different code points a gram is preceded
        cut = counts[k + 1].select(*[value.alias(name) for name, value in shorter(k + 1).items()], "c")
        counts[k] = stages.keep(cut.groupBy(*GRAM).agg(F.count_if(F.col("c") > 0).alias("c")), "counts")
    below = None
    for k in range(1, order + 1):
        below = stages.keep(smoothed(counts[k], k, below), "grams")
    return below


def marks(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(bucket, bits): a bit for each row of docs, by its place in the input, that is set if its doc_id is in `ids`."""
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("at"))
    rows = rows.join(ids.hint("merge"), F.col("doc_id") == F.col("trusted_id"), "left_semi")
    bucket, place = F.bitmap_bucket_number("at").alias("bucket"), F.bitmap_bit_position("at")
    return rows.groupBy(bucket).agg(F.bitmap_construct_agg(place).alias("bits"))


def marked(docs: DataFrame, bits: DataFrame) -> DataFrame:
    """(block, text, trusted) of all rows, where they are read."""
    rows = docs.select("text", F.spark_partition_id().alias("block"), F.monotonically_increasing_id().alias("at"))
    rows = rows.withColumns({"bucket": F.bitmap_bucket_number("at"), "place": F.bitmap_bit_position("at")})
    byte = F.conv(F.hex(F.expr("substring(bits, cast(place div 8 as int) + 1, 1)")), 16, 10).cast("int")
    bit = F.bit_get(byte, (F.col("place") % 8).cast("int"))
    return rows.join(F.broadcast(bits), "bucket", "left").select("block", "text", F.coalesce(bit == 1, F.lit(False)).alias("trusted"))


def packed(docs: DataFrame, columns: list[str]) -> DataFrame:
    """(block, rows): the rows of each block, some megabytes at a time, as compressed Arrow."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        how = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=CODEC))
        waiting: list[pa.RecordBatch] = []

        def packet() -> pa.RecordBatch:
            block = waiting[0].column("block")[0].as_py()
            table = pa.Table.from_batches(waiting).drop_columns(["block"]).combine_chunks()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=how) as out:
                out.write_table(table)
            waiting.clear()
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["block", "rows"])

        size = 0
        for part in tx.slices(batches):
            waiting.append(part)
            size += pc.sum(pc.binary_length(part.column("text"))).as_py() or 0
            if size >= PIECE:
                yield packet()
                size = 0
        if waiting:
            yield packet()

    rows = docs.select(*[F.col(f"`{c}`") for c in columns], "text", F.spark_partition_id().alias("block"))
    return rows.mapInArrow(tx.worker(pack), "block int, rows binary")


class Lookup:
    """Log probabilities of a block's n-grams."""

    def __init__(self, table: pa.Table):
        hi, lo, logs = (table.column(c).to_numpy() for c in (*GRAM, "log_p"))
        self.hi, self.lo = np.unique(hi), np.unique(lo)
        codes = np.searchsorted(self.hi, hi) * len(self.lo) + np.searchsorted(self.lo, lo)
        order = np.argsort(codes)
        self.codes, self.logs, self.grams = codes[order], logs[order].astype(np.float64), (hi[order], lo[order])

    def of(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        if not len(hi):
            return np.zeros(0)
        at = np.searchsorted(self.codes, np.searchsorted(self.hi, hi) * len(self.lo) + np.searchsorted(self.lo, lo))
        at = np.minimum(at, len(self.codes) - 1)
        if at.min() < 0 or (self.grams[0][at] != hi).any() or (self.grams[1][at] != lo).any():
            raise RuntimeError("a block has other rows than when it was counted: the input must be a stored table")
        return self.logs[at]


def scored(docs: DataFrame, trusted_ids: DataFrame, order: int = ORDER) -> DataFrame:
    """docs without its text, with n_scored (characters) and `perplexity` per character (null for empty and null texts).

    trusted_ids: trusted_id, distinct. docs is read three times and must give the same rows in the same tasks each time,
    as a stored table does; if it does not, this is an error.
    """
    if not 1 <= order <= LONGEST:
        raise ValueError(f"order must be 1 to {LONGEST}")
    stages = Stages(docs.sparkSession, "kneser-ney")
    bits = stages.keep(marks(docs, trusted_ids), "marks")
    asked = stages.keep(block_grams(marked(docs, bits), order), "asked")
    table = probabilities(asked.select(*GRAM, "c"), order, stages)
    answers = asked.select("block", *GRAM).join(table, GRAM).select("block", *GRAM, F.log("p").cast("float").alias("log_p"))
    kept = [c for c in docs.columns if c not in ("text", "n_scored", "perplexity")]
    # docs may have columns of any name, also `block`; in a packet they are out of the way.
    named = [f"k{i}" for i in range(len(kept))]
    renamed = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(kept, named)], "text")

    def score(rows: pa.Table, logs: pa.Table) -> pa.Table:
        known = Lookup(logs)
        made: list[pa.RecordBatch] = []
        for packet in rows.column("rows"):
            for part in tx.slices(iter(pa.ipc.open_stream(packet.as_buffer()))):
                found = Grams(part.column("text"), order)
                n = found.lengths
                total = np.bincount(found.owner, known.of(found.hi, found.lo)[found.at], minlength=len(n))
                value = pa.array(np.exp(-total / np.maximum(n, 1)), pa.float64(), mask=n == 0)
                made.append(pa.RecordBatch.from_arrays([*[part.column(c) for c in named], pa.array(n), value], [*named, "n_scored", "perplexity"]))
        return pa.Table.from_batches(made)

    schema = T.StructType([*renamed.drop("text").schema.fields, T.StructField("n_scored", T.LongType()), T.StructField("perplexity", T.DoubleType())])
    parts = max(docs.select("doc_id").rdd.getNumPartitions(), 1)
    left = packed(renamed, named).repartition(parts, "block").groupBy("block")
    right = answers.repartition(parts, "block").groupBy("block")
    out = left.cogroup(right).applyInArrow(score, schema)
    return out.withColumnsRenamed(dict(zip(named, kept)))


def assess(docs: DataFrame, trusted_ids: DataFrame, quantile: float = QUANTILE, order: int = ORDER) -> DataFrame:
    """(doc_id, lang, perplexity, threshold, keep) for every row of docs (doc_id, text, lang), a stored table.

    trusted_ids: doc_id of trusted texts; order: code points of an n-gram, 1 to 6; thresholds as in `perplexity.judged`.
    """
    ids = trusted_ids.select(F.col("doc_id").cast("bigint").alias("trusted_id")).where("trusted_id is not null").distinct()
    stages = Stages(docs.sparkSession, "kneser-ney")
    return judged(stages.keep(scored(docs.select("doc_id", "lang", "text"), ids, order), "scored"), ids, quantile)
