"""Periodic runs of words, found on a grammar of each text, and texts with every run cut to its first period.

A run is a stretch of words with smallest period q, at least `min_length` and 2*q words long, that no neighbouring
word extends. The words of a text become numbers, which are compressed by Re-Pair: the most frequent pair of
neighbours becomes a new symbol until no pair occurs twice. A run crosses the boundary between the two halves of
the lowest node of the derivation that holds it, so only boundaries are searched, each symbol's once, however often
the symbol occurs. What is found is carried to all places of the symbol; pieces that a larger place extends are merged.

Texts are independent, so nothing is shuffled. Those of a slice are compressed together, each over its own numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import text as tx

MIN_LENGTH = 12
CANDIDATES = 1 << 20
U = np.uint64
RUN = "struct<start:bigint,length:bigint,period:bigint>"


def word_ids(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Numbers from 0 for words; words of different texts never share one."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    order = np.lexsort((hashes, owner))
    new = np.zeros(len(order), np.int64)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    ids = np.empty(len(order), np.int64)
    ids[order] = np.cumsum(new)
    return ids


@dataclass
class Grammar:
    """heads: where the symbols left at the end begin; rule i is `length[i]` words, the first `left[i]` its left half.

    rule, at: the place of every occurrence of a rule in the derivation, by rule, then place.
    """

    heads: np.ndarray
    left: np.ndarray
    length: np.ndarray
    rule: np.ndarray
    at: np.ndarray


def compress(ids: np.ndarray, owner: np.ndarray, least: int = 0) -> Grammar:
    """Re-Pair of all texts at once. Rules of fewer than `least` words are used, not returned.

    A pair that none of the pairs overlapping it outranks (by count, then by a hash) is not changed by any that are
    replaced before it, so all of these are replaced in one round, with the grammar that one at a time would give.
    Of equal neighbours every second pair counts. A pair that occurs once never occurs more often later: it is cut.
    """
    n = len(ids)
    head = np.ones(n, bool)
    size = np.ones(int(ids.max()) + 1 if n else 0, np.int64)
    symbol, place = ids.copy(), np.arange(n)
    cut = np.ones(n, bool)  # after each symbol
    cut[:-1] = owner[1:] != owner[:-1]
    lefts, lengths, rules, places, made = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    while len(i := np.flatnonzero(~cut)):
        first, second = symbol[i], symbol[i + 1]
        pairs, pair = np.unique(first * len(size) + second, return_inverse=True)
        touching = i[1:] == i[:-1] + 1
        starts = np.ones(len(i), bool)
        starts[1:] = ~(touching & (pair[1:] == pair[:-1]))
        since = np.arange(len(i)) - np.maximum.accumulate(np.where(starts, np.arange(len(i)), 0))
        counted = since % 2 == 0
        count = np.bincount(pair, weights=counted).astype(np.int64)
        alive = count[pair] >= 2
        rank = np.empty(len(pairs), np.int64)
        rank[np.lexsort((tx.mix(pairs.astype(U)), count))] = np.arange(len(pairs))
        own = np.where(alive, rank[pair], -1)
        outranked = np.zeros(len(pairs), bool)
        outranked[pair[:-1][touching & (own[1:] > own[:-1])]] = True
        outranked[pair[1:][touching & (own[:-1] > own[1:])]] = True
        take = np.flatnonzero(alive & counted & ~outranked[pair])
        cut[i[~alive]] = True

        chosen, rule = np.unique(pair[take], return_inverse=True)
        a, b = i[take], i[take] + 1
        some = np.zeros(len(chosen), np.int64)
        some[rule] = a
        left, length = size[symbol[some]], size[symbol[some]] + size[symbol[some + 1]]
        kept = length >= least
        number = np.cumsum(kept) - 1 + made
        held = kept[rule]
        lefts.append(left[kept])
        lengths.append(length[kept])
        rules.append(number[rule[held]])
        places.append(place[a[held]])
        made += int(kept.sum())
        head[place[b]] = False
        symbol[a] = len(size) + rule
        size = np.concatenate([size, length])
        cut[a] = cut[b]
        stays = np.ones(len(symbol), bool)
        stays[b] = False
        symbol, place, cut = symbol[stays], place[stays], cut[stays]
        before = np.ones(len(cut), bool)
        before[1:] = cut[:-1]
        stays = ~(cut & before)
        symbol, place, cut = symbol[stays], place[stays], cut[stays]
    rule, at = np.concatenate(rules), np.concatenate(places)
    order = np.lexsort((at, rule))
    return Grammar(np.flatnonzero(head), np.concatenate(lefts), np.concatenate(lengths), rule[order], at[order])


def top_boundaries(heads: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """lo, boundary, hi for every boundary between the final symbols of a text, as in a balanced tree over them."""
    n = len(owner)
    whose = owner[heads]
    opens = np.flatnonzero(np.append(True, whose[1:] != whose[:-1])) if len(heads) else np.zeros(0, np.int64)
    size = np.diff(np.append(opens, len(heads)))
    first = np.repeat(opens, size)
    nth = np.arange(len(heads)) - first
    ends = np.append(heads, n)
    inner = nth > 0
    first, nth, size = first[inner], nth[inner], np.repeat(size, size)[inner]
    reach = nth & -nth
    return heads[first + nth - reach], heads[first + nth], ends[first + np.minimum(nth + reach, size)]


class Equal:
    """Lengths of equal stretches, from hashes of prefixes of the row of word numbers."""

    def __init__(self, ids: np.ndarray):
        self.up = tx.powers(len(ids) + 1)[0]
        self.sums = np.zeros(len(ids) + 1, U)
        np.cumsum(tx.mix(ids.astype(U) + U(1)) * self.up[: len(ids)], out=self.sums[1:])

    def _same(self, i: np.ndarray, j: np.ndarray, length: np.ndarray) -> np.ndarray:
        return (self.sums[i + length] - self.sums[i]) * self.up[j - i] == self.sums[j + length] - self.sums[j]

    def reach(self, i: np.ndarray, j: np.ndarray, most: np.ndarray, back: bool = False) -> np.ndarray:
        """How many words from i on (or before i) equal those from j on (or before j), `most` at most; i < j."""
        have = np.zeros(len(i), np.int64)
        step = 1 << int(most.max(initial=0)).bit_length()
        while step := step // 2:
            more = have + step
            k = np.flatnonzero(more <= most)
            length = more[k]
            shift = length if back else 0
            k = k[self._same(i[k] - shift, j[k] - shift, length)]
            have[k] += step
        return have


def crossing(ids: np.ndarray, lo: np.ndarray, mid: np.ndarray, hi: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """node, start, end, period of the runs within [lo, hi) that cross `mid`, each with its smallest period.

    A run of period q holds the word before the boundary and again q later, or the word after it and q earlier:
    these places of equal words are the candidates, taken in blocks of bounded size.
    """
    n = len(ids)
    use = np.flatnonzero(hi - lo >= least)
    order = np.argsort(ids, kind="stable")
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    keys = ids[order] * (n + 1) + order
    lo, mid, hi = lo[use], mid[use], hi[use]
    later = (rank[mid - 1] + 1, np.searchsorted(keys, ids[mid - 1] * (n + 1) + hi))
    sooner = (np.searchsorted(keys, ids[mid] * (n + 1) + lo), rank[mid])
    equal = Equal(ids)
    found = [np.zeros((4, 0), np.int64)]
    for after, (begin, end) in ((True, later), (False, sooner)):
        some = np.flatnonzero(end > begin)
        upto = np.cumsum((end - begin)[some])
        at = 0
        while at < len(some):
            done = upto[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(upto, done + CANDIDATES, "right")))
            part = some[at:stop]
            count = (end - begin)[part]
            node = np.repeat(part, count)
            other = order[np.arange(count.sum()) + np.repeat(begin[part] - np.cumsum(count) + count, count)]
            i, j = (mid[node] - 1, other) if after else (other, mid[node])
            if least >= 12:  # then six words in a row agree at least: two before this one or three after it
                near = lambda d: (i + d >= lo[node]) & (j + d < hi[node]) & (ids.take(i + d, mode="clip") == ids.take(j + d, mode="clip"))  # noqa: B023, E731
                likely = np.flatnonzero((near(-1) & near(-2)) | (near(1) & near(2) & near(3)))
                node, i, j = node[likely], i[likely], j[likely]
            back = equal.reach(i, j, i - lo[node], back=True)
            on = equal.reach(i, j, hi[node] - j)
            period, length = j - i, back + on + j - i
            good = (back + on >= period) & (length >= least)
            found.append(np.stack([use[node[good]], (i - back)[good], (i - back + length)[good], period[good]]))
            at = stop
    node, start, end, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, end, start, node))
    node, start, end, period = node[order], start[order], end[order], period[order]
    new = np.ones(len(node), bool)
    new[1:] = (node[1:] != node[:-1]) | (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return node[new], start[new], end[new], period[new]


def find(ids: np.ndarray, owner: np.ndarray, least: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """start, end, period of every run, by start, then period; ids as of `word_ids`, owner the text of each word."""
    if len(ids) < least:
        return (np.zeros(0, np.int64),) * 3
    grammar = compress(ids, owner, least)
    rules = len(grammar.left)
    first = np.searchsorted(grammar.rule, np.arange(rules + 1))
    low = grammar.at[first[:-1]]
    top = top_boundaries(grammar.heads, owner)
    sides = [np.concatenate([a, b]) for a, b in zip((low, low + grammar.left, low + grammar.length), top)]
    node, start, end, period = crossing(ids, *sides, least)

    inner = np.flatnonzero(node < rules)
    times = (first[1:] - first[:-1])[node[inner]]
    which = np.repeat(inner, times)
    nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    moved = grammar.at[first[node[which]] + nth] - low[node[which]]
    outer = node >= rules
    start, end, period = (np.concatenate([x[outer], y]) for x, y in ((start, start[which] + moved), (end, end[which] + moved), (period, period[which])))

    order = np.lexsort((-end, start, period))
    start, end, period = start[order], end[order], period[order]
    far = period * (len(ids) + 1) + end
    inside = np.zeros(len(far), bool)
    inside[1:] = np.maximum.accumulate(far)[:-1] >= far[1:]
    start, end, period = start[~inside], end[~inside], period[~inside]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[new], end[new], period[new]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray, n: int) -> pa.Array:
    """Texts 0 to n-1 made of the given words, in order, with one space between."""
    length = ends - starts + 1
    upto = np.cumsum(length)
    source = np.arange(upto[-1] if len(upto) else 0) + np.repeat(starts - upto + length, length)
    out = data[np.minimum(source, len(data) - 1)] if len(source) else np.zeros(0, np.uint8)
    out[upto - 1] = 32
    last = np.searchsorted(owner, np.arange(n), "right")
    offsets = np.concatenate([[0], np.concatenate([[0], upto])[last]])
    closing = upto[last - 1][np.diff(np.concatenate([[0], last])) > 0] - 1 if len(upto) else np.zeros(0, np.int64)
    keep = np.ones(len(out), bool)
    keep[closing] = False  # no space after a text's last word
    gone = np.concatenate([[0], np.cumsum(~keep)])
    return pa.StringArray.from_buffers(n, pa.py_buffer((offsets - gone[offsets]).astype(np.int32)), pa.py_buffer(out[keep]))


def collapse(docs: DataFrame, text: str = "text", id_: str = "doc_id", min_length: int = MIN_LENGTH) -> DataFrame:
    """(id_, n_words, runs, collapsed) of every row: its runs by start, then period, and the words outside repetitions.

    A word is a run of bytes other than ASCII white space, words count from 0 and are equal byte for byte. A word
    goes if any run holds it after that run's first period; `collapsed` joins the rest by one space. Runs may
    overlap, and of two with the same words only that with the smaller period is one. A null or blank text has no words, no runs
    and an empty collapsed text; repeated rows and null ids give a row each; other columns are not read. A text
    is never cut: memory is bounded by the slice, or by the longest text if that is longer.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches):
            data, offsets = tx.flat(part.column("text"))
            hashes, owner, starts, ends = tx.words(data, offsets)
            n = part.num_rows
            start, end, period = find(word_ids(hashes, owner), owner, min_length)
            change = np.zeros(len(owner) + 1, np.int64)
            np.add.at(change, start + period, 1)
            np.add.at(change, end, -1)
            stays = np.cumsum(change)[:-1] == 0
            bounds = np.searchsorted(owner, np.arange(n + 1))
            whose = owner[start]
            runs = pa.StructArray.from_arrays([pa.array(x) for x in (start - bounds[whose], end - start, period)], ["start", "length", "period"])
            runs = pa.ListArray.from_arrays(np.searchsorted(whose, np.arange(n + 1)).astype(np.int32), runs)
            text_out = joined(data, starts[stays], ends[stays], owner[stays], n)
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(np.diff(bounds)), runs, text_out], ["id", "n_words", "runs", "collapsed"])

    kind = docs.schema[id_].dataType.simpleString()
    plain = docs.select(F.col(f"`{id_}`").alias("id"), F.col(f"`{text}`").alias("text"))
    return plain.mapInArrow(work, f"id {kind}, n_words bigint, runs array<{RUN}>, collapsed string").withColumnRenamed("id", id_)


def with_periodic_tail(docs: DataFrame, text: str = "text", id_: str = "doc_id") -> DataFrame:
    """(id_, text) of `docs`; the text of one id in ten has its words in place of it, with a tail that repeats a stretch of them.

    With h the CRC-32 of the id's digits and g = h div 10, a text of n words is changed if h mod 10 is 0: word i >= a
    becomes word a + (i - a) mod p, with a = g mod n and p = 1 + (n - a) div (3 + g mod 8). A null id changes nothing.
    """
    h = F.crc32(F.col("id").cast("string").cast("binary"))
    words = F.filter(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    out = docs.select(F.col(f"`{id_}`").alias("id"), F.col(f"`{text}`").alias("text")).withColumn("g", F.floor(h / 10).cast("bigint"))
    out = out.withColumn("words", F.when(F.pmod(h, F.lit(10)) == 0, words))
    out = out.withColumn("n", F.when(F.size("words") > 0, F.size("words"))).withColumn("a", F.expr("cast(pmod(g, n) as int)"))
    out = out.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    new = F.expr("concat(slice(words, 1, a), slice(flatten(array_repeat(slice(words, a + 1, p), cast(ceil((n - a) / p) as int))), 1, n - a))")
    return out.select(F.col("id").alias(id_), F.when(F.col("n").isNotNull(), F.array_join(new, " ")).otherwise(F.col("text")).alias(text))


def digests(collapsed: DataFrame, id_: str = "doc_id") -> DataFrame:
    """id_, n_runs, the longest run (smallest start, then period, among equals; nulls if none) and digests, from `collapse`."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return collapsed.withColumn("best", best).select(
        F.col(f"`{id_}`"),
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("(1000 * best.length) div (-best.period)").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
