"""Spelling variants: words one inserted, deleted or replaced letter apart, found in sorted permuterm rotations.

A word w closed by a terminator has a rotation for each of its places. Take the rotation that ends with the letter
at place i: y$xc for w = xcy. Every word with another letter there has a rotation y$x and one more letter, and the
word xy without it has the rotation y$x itself. So all of them share the prefix y$x, and in the sorted rotations a
prefix is a range: words are sent once by each whole rotation and once by each without its last letter, sorted, and
ranges are scanned. A range holds each word once and at most one word a letter, plus one: its size is bounded by
the alphabet, whatever the table. Words of a range are near each other; nothing is emitted for pairs.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from math import ceil, log, log2

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import text as tx
from millrace.llm.store import Stages

TERMINATOR = "\u0001"
LEAST_LETTERS = 7
LEAST_COUNT = 2
RATIO = 10
EDIT_EVERY = 31
HELD_WORDS = 200_000
FLUSH_BYTES = 1 << 25

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LETTERS = np.zeros(256, bool)
LETTERS[65:91] = LETTERS[97:123] = True
LEAD = 0xC3  # of U+00C0 to U+00FF in UTF-8


def edited(word: bytes, h: int) -> bytes:
    """The word without its code point h mod its length."""
    letters = word.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def occurrences(docs: DataFrame, text: str = "text", id_: str = "doc_id", least_letters: int = LEAST_LETTERS, edit_every: int = EDIT_EVERY) -> DataFrame:
    """(word, n) for the words of all texts, partly summed: a word has a row for each task or more.

    A word is a maximal run of A-Z, a-z and U+00C0 to U+00FF with A-Z in lower case, `least_letters` code points or
    more. Of `<id>:<word>` the CRC-32 is taken, and where `edit_every` divides it the word loses the code point of
    that number modulo its length (0: no word is changed); a row without an id changes none. Null texts have no words.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        held_bytes = 0

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()).cast(pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for part in tx.slices(batches):
            data, offsets = tx.flat(part.column("text"))
            data = LOWER[data]
            lead = data == LEAD
            inside = LETTERS[data] | lead
            inside[1:] |= lead[:-1]
            starts, ends = tx.runs(data, offsets, inside)
            before = np.concatenate([[0], np.cumsum(lead)])
            long = ends - starts - (before[ends] - before[starts]) >= least_letters
            if not long.any():
                continue
            hashes = tx.span_hashes(data, starts, ends, inside)[long]
            starts, ends = starts[long], ends[long]
            owner = np.searchsorted(offsets, starts, "right") - 1
            order = np.lexsort((hashes, owner))
            new = np.ones(len(order), bool)
            new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
            first = np.flatnonzero(new)
            times = np.diff(np.append(first, len(order))).tolist()
            first = order[first]
            raw = data.tobytes()
            words = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
            if edit_every:
                seeds = [None if i is None else zlib.crc32(b"%d:" % i) for i in part.column("id").to_pylist()]
                for k, (o, w) in enumerate(zip(owner[first].tolist(), words)):
                    if (seed := seeds[o]) is not None and (h := zlib.crc32(w, seed)) % edit_every == 0:
                        words[k] = edited(w, h)
            for w, c in zip(words, times):
                held[w] += c
            held_bytes += len(raw)
            if len(held) > HELD_WORDS or held_bytes > FLUSH_BYTES:
                yield flush()
                held_bytes = 0
        yield flush()

    plain = docs.select(F.col(f"`{id_}`").cast("bigint").alias("id"), F.col(f"`{text}`").alias("text"))
    found = plain.mapInArrow(work, "word string, n bigint")
    return found.where(F.char_length("word") >= least_letters)


def counted(docs: DataFrame, least_count: int = LEAST_COUNT, **options) -> DataFrame:
    """(word, n): the words of `occurrences` that occur `least_count` times or more in all texts together."""
    return occurrences(docs, **options).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, letter, n): every rotation y$xc of each word, whole (letter null), and without its last letter c.

    The rotation that ends with the terminator is sent whole only. The word is xcy, or xy where it is whole.
    """
    size = F.char_length("word")
    at = F.explode(F.sequence(F.lit(0), size))  # letters of x and c; 0: the rotation ends with the terminator
    turned = words.select("n", "word", at.alias("at")).select(
        "n", F.concat(F.expr("substring(word, at + 1)"), F.lit(TERMINATOR), F.expr("substring(word, 1, at - 1)")).alias("short"), F.expr("substring(word, at, 1)").alias("c"), "at"
    )
    whole = F.struct(F.concat("short", F.when(F.col("at") > 0, F.col("c")).otherwise(F.lit(""))).alias("prefix"), F.lit(None).cast("string").alias("letter"))
    short = F.struct(F.col("short").alias("prefix"), F.col("c").alias("letter"))
    both = F.when(F.col("at") > 0, F.array(whole, short)).otherwise(F.array(whole))
    return turned.select("n", F.explode(both).alias("r")).select("r.prefix", "r.letter", "n")


def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each word of each range of sorted (prefix, letter, n): how many words it meets there, and the best of them.

    A word and the same with a letter more meet in as many ranges as that letter repeats; only the one that takes
    away the first of equal letters counts them, so that they count once.
    """
    rest: pa.Table | None = None

    def ranges(table: pa.Table) -> pa.RecordBatch:
        prefix = table.column("prefix").combine_chunks()
        new = np.ones(len(prefix), bool)
        new[1:] = pc.not_equal(prefix.slice(1), prefix.slice(0, len(prefix) - 1)).to_numpy(zero_copy_only=False)
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(prefix)))
        shared = table.filter(pa.array(np.repeat(size > 1, size)))
        prefixes, letters, numbers = (shared.column(c).to_pylist() for c in ("prefix", "letter", "n"))
        out: tuple[list, ...] = ([], [], [], [])
        at = 0
        for m in size[size > 1].tolist():
            y, x = prefixes[at].split(TERMINATOR)
            members = sorted((-n, x + (c or "") + y, c) for n, c in zip(numbers[at : at + m], letters[at : at + m]))
            firsts = sum(c is not None and not x.endswith(c) for _, _, c in members)
            longer = sum(c is not None for _, _, c in members)
            for k, (_, word, c) in enumerate(members):
                n, best, _ = members[k == 0]
                out[0].append(word)
                out[1].append(firsts if c is None else longer - 1 + (longer < m and not x.endswith(c)))
                out[2].append(-n)
                out[3].append(best)
            at += m
        return pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.string())], ["word", "met", "best_n", "best"])

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table]).combine_chunks()
        prefix = table.column("prefix").combine_chunks()
        last = pc.equal(prefix, prefix[len(prefix) - 1]).to_numpy(zero_copy_only=False)
        cut = int(np.argmax(last))  # the last range may go on in the next batch
        rest = table.slice(cut)
        if cut:
            yield ranges(table.slice(0, cut))
    if rest is not None:
        yield ranges(rest)


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, best, best_n) for the words of (word, n) that have a near word: how many, and the one of largest n.

    Two words are near if one inserted, deleted or replaced code point makes one of the other; ties of n go to the
    word that is smaller by code points. `words` holds each word once; null and empty words and any that holds U+0001
    take no part.
    """
    use = words.where((F.col("word") != "") & ~F.contains("word", F.lit(TERMINATOR))).select("word", "n")
    met = rotations(use).repartition("prefix").sortWithinPartitions("prefix").mapInArrow(scan, "word string, met bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    near = met.groupBy("word").agg(F.sum("met").alias("n_near"), best.alias("b"))
    return near.select("word", "n_near", F.col("b.word").alias("best"), (-F.col("b.n")).alias("best_n"))


def forms(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of (word, n).

    form is the near word of largest n if that is at least `ratio` times the word's own, else null; root is where
    following forms ends. n grows by `ratio` with each step, so a chain has no circle, and its length is bounded by
    the logarithm of the largest n: joins that double the steps taken reach every root. An empty table gives no rows.
    """
    stages = Stages(words.sparkSession, "spelling")
    words = stages.keep(words, "words")
    near = neighbours(words)
    taken = F.col("best_n") >= ratio * F.col("n")
    found = stages.keep(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), F.when(taken, F.col("best")).alias("form"), F.when(taken, F.col("best_n")).alias("form_n")
        ),
        "forms",
    )
    most = found.agg(F.max("n")).first()[0] or 1
    steps = max(1, ceil(log(most) / log(ratio)) + 1)
    ahead = found.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(ceil(log2(steps)) + 1):
        beyond = ahead.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ahead = stages.keep(ahead.join(beyond, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
    out = found.join(ahead, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame, **options) -> DataFrame:
    """`forms` of the words of all texts, see `counted`. Other columns are not read; repeated rows count again."""
    return forms(counted(docs, **options))
