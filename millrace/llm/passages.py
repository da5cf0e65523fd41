"""Repeated passages across documents: paragraph MinHash with banding, and runs of repeated sentences.

Paragraphs (lines) of enough words get a MinHash signature over their five-word shingles. Bands are tuned for
recall: at a Jaccard similarity of 0.8 a pair of paragraphs shares a band with a probability of at least 0.985.
Paragraphs that share a band are verified by exact Jaccard similarity and clustered by components. A passage
that starts or ends inside a line shows as sentences that occur elsewhere word for word; such sentences are
joined to runs, with small gaps bridged, and in runs of enough words they are passages too. Of every such sentence
one occurrence is kept, and what lies in the gaps belongs to no passage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import text as tx
from millrace.llm.components import SKETCH_BITS, SKETCH_LONGS, Checker, bit_sketches, linked_groups
from millrace.llm.store import Stages

U = np.uint64
SHINGLE = 5
SIMILARITY = 0.8
MIN_WORDS = 25  # of a paragraph or a run of sentences
SENTENCE_WORDS = 4
GAP = 10  # words between repeated sentences of one run
RECALL = 0.985
ROWS = 3
STEP = 0xD1B54A32D192ED03


def bands_for(recall: float, similarity: float = SIMILARITY, rows: int = ROWS) -> int:
    """The fewest bands of `rows` rows with which a pair of that similarity shares one with probability `recall`."""
    return int(np.ceil(np.log(1 - recall) / np.log(1 - similarity**rows)))


def minhashes(codes: np.ndarray, starts: np.ndarray, m: int) -> np.ndarray:
    """m minima for each run of codes that begins at `starts`; all runs have at least one code."""
    out = np.empty((len(starts), m), U)
    for k in range(m):
        out[:, k] = np.minimum.reduceat(tx.mix(codes ^ U((k + 1) * STEP & (2**64 - 1))), starts)
    return out


def pieces_of(texts: pa.Array) -> dict[str, np.ndarray]:
    """Words of the lower-cased texts: hash, text, start and end byte, sentence and line of each (numbered over all texts).

    A sentence ends after a word that ends in '.', '!' or '?', and at a line's end.
    """
    data, offsets = tx.flat(texts)
    hashes, owner, starts, ends = tx.words(data, offsets)
    n = len(hashes)
    lines_before = np.concatenate([[0], np.cumsum(data == 10)])
    new_line = np.ones(n, bool)
    new_line[1:] = (owner[1:] != owner[:-1]) | (lines_before[starts[1:]] != lines_before[ends[:-1]])
    stops = np.zeros(256, bool)
    stops[[33, 46, 63]] = True
    new_sentence = new_line.copy()
    new_sentence[1:] |= stops[data[ends[:-1] - 1]] if n else False
    return {"data": data, "offsets": offsets, "hash": hashes, "owner": owner, "start": starts, "end": ends, "line": np.cumsum(new_line) - 1, "sentence": np.cumsum(new_sentence) - 1}


def spans(p: dict[str, np.ndarray], kind: str) -> dict[str, np.ndarray]:
    """First and last word, text, hash, and whether the text has the same piece before, of each piece of a kind."""
    number = p[kind]
    n = len(number)
    first = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]])) if n else np.zeros(0, np.int64)
    last = np.append(first[1:], n) - 1 if n else first
    if n:
        up, down = tx.powers(n)
        key = tx.mix(np.add.reduceat(p["hash"] * up, first) * down[first] + (last - first + 1).astype(U))
    else:
        key = np.zeros(0, U)
    owner = p["owner"][first] if n else np.zeros(0, np.int64)
    order = np.lexsort((first, key, owner))
    again = np.zeros(len(first), bool)
    if len(first):
        same = (key[order][1:] == key[order][:-1]) & (owner[order][1:] == owner[order][:-1])
        again[order[1:]] = same
    return {"first": first, "last": last, "owner": owner, "key": key, "again": again}


def characters(p: dict[str, np.ndarray], at: np.ndarray) -> np.ndarray:
    """Number of code points of its text before each byte; each byte is given as (text, byte) in p's arrays."""
    heads = np.concatenate([[0], np.cumsum((p["data"] & 0xC0) != 0x80)])
    return heads[at]


def located(p: dict[str, np.ndarray], s: dict[str, np.ndarray], pick: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end in code points of the picked pieces, and the number of their first word in its text."""
    base = characters(p, p["offsets"][:-1][s["owner"][pick]])
    first_word = np.searchsorted(p["owner"], s["owner"][pick])
    return characters(p, p["start"][s["first"][pick]]) - base, characters(p, p["end"][s["last"][pick]]) - base, s["first"][pick] - first_word


def lowered(texts: pa.Array) -> pa.Array:
    """Lower-cased, letter by letter as far as the length in code points stays: the places found hold for the original."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    small = pc.utf8_lower(texts)
    return pc.if_else(pc.equal(pc.utf8_length(small), pc.utf8_length(texts)), small, texts)


def sentences(docs: DataFrame, least: int = SENTENCE_WORDS) -> DataFrame:
    """(key, doc, word, words, start, end, line) of every sentence of at least `least` words; line: where its line starts."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches):
            p = pieces_of(lowered(part.column("text")))
            s = spans(p, "sentence")
            pick = np.flatnonzero(s["last"] - s["first"] + 1 >= least)
            start, end, word = located(p, s, pick)
            line_first = np.searchsorted(p["line"], p["line"][s["first"][pick]])
            line = characters(p, p["start"][line_first]) - characters(p, p["offsets"][:-1][s["owner"][pick]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(s["key"][pick].view(np.int64)), part.column("doc").take(pa.array(s["owner"][pick])), pa.array(word.astype(np.int32)), pa.array((s["last"] - s["first"] + 1)[pick].astype(np.int32)), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32)), pa.array(line.astype(np.int32))],
                ["key", "doc", "word", "words", "start", "end", "line"],
            )

    return docs.mapInArrow(cut, "key bigint, doc bigint, word int, words int, start int, end int, line int")


def paragraphs(docs: DataFrame, least: int, k: int, bands: int, rows: int) -> DataFrame:
    """(key, doc, words, start, end, again, shingles, bands) of every line of at least `least` words.

    shingles: the distinct ones, sorted, as unsigned 32-bit integers; bands: a key for each.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches):
            p = pieces_of(lowered(part.column("text")))
            s = spans(p, "line")
            pick = np.flatnonzero(s["last"] - s["first"] + 1 >= max(least, k))
            start, end, _ = located(p, s, pick)
            n = int(p["line"][-1]) + 1 if len(p["line"]) else 0
            codes, who = tx.shingles(p["hash"], p["line"], n, k)
            wanted = np.zeros(n + 1, bool)
            wanted[pick] = True
            codes, who, _ = tx.distinct((codes & U(0xFFFFFFFF))[wanted[who]], who[wanted[who]])
            first = np.searchsorted(who, pick)
            edge = np.append(first, len(codes))
            if len(pick):
                mins = minhashes(codes, first, bands * rows).reshape(len(pick), bands, rows)
                key = np.zeros((len(pick), bands), U) + np.arange(1, bands + 1, dtype=U)[None, :] * U(STEP)
                for r in range(rows):
                    key = tx.mix(key * U(tx.BASE) + mins[:, :, r])
            else:
                key = np.zeros((0, bands), U)
            small = codes.astype("<u4")
            yield pa.RecordBatch.from_arrays(
                [pa.array(s["key"][pick].view(np.int64)), part.column("doc").take(pa.array(s["owner"][pick])), pa.array((s["last"] - s["first"] + 1)[pick].astype(np.int32)), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32)), pa.array(s["again"][pick]),
                 pa.array([small[a:b].tobytes() for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())], pa.binary()), pa.ListArray.from_arrays(np.arange(len(pick) + 1, dtype=np.int32) * bands, pa.array(key.view(np.int64).ravel()))],
                ["key", "doc", "words", "start", "end", "again", "shingles", "bands"],
            )

    return docs.mapInArrow(cut, "key bigint, doc bigint, words int, start int, end int, again boolean, shingles binary, bands array<bigint>")


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose shingle sets have a Jaccard similarity of at least `threshold`."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            keep = []
            for x, y in zip(part.column("x").to_pylist(), part.column("y").to_pylist()):
                a, b = np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4")
                shared = len(np.intersect1d(a, b, assume_unique=True)) if min(len(a), len(b)) >= threshold * max(len(a), len(b)) else 0
                keep.append(shared >= threshold * (len(a) + len(b) - shared) - 1e-9)
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([part.column("a").filter(keep), part.column("b").filter(keep)], ["a", "b"])

    side = lambda key, name: sets.select(F.col("key").alias(key), F.col("shingles").alias(name))
    return pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").select("a", "b", "x", "y").mapInArrow(check, "a bigint, b bigint")


def sketches(sets: DataFrame) -> DataFrame:
    """(key, sketch) of (key, shingles), see `components.Checker`."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for at in range(0, part.num_rows, 2048):
                piece = part.slice(at, 2048)
                own = [np.frombuffer(x, "<u4") for x in piece.column("shingles").to_pylist()]
                starts = np.concatenate([[0], np.cumsum([len(x) for x in own])])
                bits = bit_sketches(minhashes(tx.mix(np.concatenate(own).astype(U)), starts[:-1], SKETCH_BITS))
                ends = np.arange(len(own) + 1, dtype=np.int32) * SKETCH_LONGS
                yield pa.RecordBatch.from_arrays([piece.column("key"), pa.ListArray.from_arrays(ends, pa.array(bits.ravel()))], ["key", "sketch"])

    return sets.select("key", "shingles").mapInArrow(draw, "key bigint, sketch array<bigint>")


def repeats(docs: DataFrame, min_words: int = MIN_WORDS, k: int = SHINGLE, threshold: float = SIMILARITY, recall: float = RECALL, rows: int = ROWS) -> DataFrame:
    """(doc_id, kind, start, end, n_words, class_id, kept): the passages of `docs` (doc_id, text) that occur elsewhere too.

    kind 'paragraph': a line alike another line, near or exact; kind 'run': sentences in a row that all occur
    elsewhere and are all kept or all not; such rows are parts of runs of enough words, and may be shorter. start and
    end are in code points. class_id is the smallest doc_id among the documents that share the paragraph, or any
    sentence of the run. kept: this is the occurrence to keep (the first in that document; of a sentence, its first
    outside the lines that can be removed); all others can be removed. Documents without repeated passages
    have no row. Null and empty texts have none, rows without a doc_id are left out, and rows that repeat an id
    and its text count once; different texts under one id count as one document.
    """
    stages = Stages(docs.sparkSession, "passages")
    source = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("bigint").alias("doc"), "text")
    n_bands = bands_for(recall, threshold, rows)

    lines = stages.keep(paragraphs(source, min_words, k, n_bands, rows), "paragraphs")

    def verifier(keys: DataFrame):
        sets = stages.keep(lines.select("key", "shingles").join(keys, "key", "left_semi").groupBy("key").agg(F.first("shingles").alias("shingles")), "sets")
        return Checker(lambda pairs: verified(pairs, sets, threshold), lambda wanted: sketches(sets.join(wanted, "key", "left_semi")), threshold)

    roots = linked_groups(lines.select(F.explode("bands").alias("bucket"), "key").distinct(), verifier, stages)
    placed = lines.select("key", "doc", "words", "start", "end", "again").join(roots.withColumnRenamed("node", "key"), "key", "left")
    placed = placed.withColumn("class", F.coalesce("root", "key"))
    shared = placed.groupBy("class").agg(F.min("doc").alias("low"), F.max("doc").alias("high"), F.max("again").alias("twice")).where(F.col("low") < F.col("high")).select("class", "low")
    placed, shared = stages.keep(placed, "placed"), stages.keep(shared, "shared")
    near = placed.join(shared, "class").select("doc", F.lit("paragraph").alias("kind"), "start", "end", F.col("words").alias("n_words"), F.col("low").alias("class_id"), ((F.col("doc") == F.col("low")) & ~F.col("again")).alias("kept"))

    said = stages.keep(sentences(source), "sentences")
    common = said.groupBy("key").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where(F.col("low") < F.col("high")).select("key", "low")
    common = stages.keep(common, "common")
    cut_lines = near.where(~F.col("kept")).select("doc", F.col("start").alias("line"), F.lit(True).alias("cut")).distinct()
    found = said.join(common, "key").join(cut_lines, ["doc", "line"], "left")
    found = stages.keep(found.select("key", "doc", "word", "words", "start", "end", "low", F.coalesce("cut", F.lit(False)).alias("cut")).distinct(), "found")
    place = F.struct("cut", "doc", "word", "start")
    first = stages.keep(found.groupBy("key").agg(F.min(place).alias("first")), "first")  # outside the lines that are cut, if there is such a one
    found = found.join(first, "key").withColumn("kept", place == F.col("first"))
    order = Window.partitionBy("doc").orderBy("word", "end")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    since = F.col("word") - F.coalesce(F.max(F.col("word") + F.col("words")).over(before), F.lit(-1_000_000))
    marked = found.withColumns({"far": (since > GAP).cast("int"), "new": ((since > 0) | (F.col("kept") != F.lag("kept", 1, True).over(order))).cast("int")})
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    numbered = marked.withColumns({"run": F.sum("far").over(upto), "piece": F.sum("new").over(upto)})
    pieces = numbered.groupBy("doc", "run", "piece").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("words").cast("int").alias("n_words"), F.min("low").alias("class_id"), F.first("kept").alias("kept"))
    pieces = pieces.withColumn("whole", F.sum("n_words").over(Window.partitionBy("doc", "run")))
    runs = pieces.where(F.col("whole") >= min_words).select("doc", F.lit("run").alias("kind"), "start", "end", "n_words", "class_id", "kept")
    return near.unionByName(runs).distinct().withColumnRenamed("doc", "doc_id")


def without_repeats(docs: DataFrame, **options) -> DataFrame:
    """docs with the removable passages cut out of their texts; rows without such passages are as they are.

    Overlapping passages are cut as one. Other columns stay.
    """
    gone = repeats(docs, **options).where(~F.col("kept"))
    listed = gone.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_gone")).withColumnRenamed("doc_id", "_doc")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(acc, s):
        out = F.when(s["start"] > acc["at"], F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"]))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    rest = lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.char_length("text")))
    marked = docs.join(listed, docs["doc_id"].cast("bigint") == listed["_doc"], "left")
    text = F.when(F.col("_gone").isNotNull() & F.col("text").isNotNull(), F.aggregate("_gone", start, add, rest)).otherwise(F.col("text"))
    return marked.select(*[text.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])
