"""Text as flat arrays: slices of Arrow batches, words and shingles as 64-bit hashes, all in numpy.

A word is a run of bytes other than ASCII white space, after lower-casing. Two words are equal when their
64-bit hashes and lengths agree.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True

_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def release() -> None:
    """Give memory that is free in this worker back to the system: workers are kept, and the next task may be another operator's."""
    _powers[:] = [np.ones(1, U), np.ones(1, U)]
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def worker(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`work`, a function for mapInArrow, with `release` when a task is done."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            release()

    return run


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse modulo 2**64 for i < n; grown on demand and kept until `release`."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for k, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            column = np.full(size, base, U)
            column[0] = 1
            _powers[k] = np.multiply.accumulate(column)
    return _powers[0][:n], _powers[1][:n]


BYTE_CODES = mix(np.arange(1, 257, dtype=U))


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row and the offsets of each (one more than texts); null is empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", budget: int = SLICE_BYTES, rows: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of a piece come to about `budget` bytes, `rows` texts at most; one text is never cut.

    Set `rows` where work on a text takes memory of its own, such as registers, however short the text is.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            upto = min(at + rows, max(at + 1, int(np.searchsorted(ends, done + budget, "right"))))
            yield batch.slice(at, upto - at)
            at = upto


def runs(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes for which `inside` holds; a run never crosses two texts."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, inside[1:]
    return np.flatnonzero(inside & (~before | cut[:n])), np.flatnonzero(inside & (~after | cut[1:])) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, inside: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of each span's bytes and length; spans are in order, bytes between them count as none."""
    if not len(starts):
        return np.zeros(0, U)
    up, down = powers(len(data))
    value = BYTE_CODES[data] * up
    if inside is not None:
        value[~inside] = 0
    sums = np.add.reduceat(value, starts)
    return mix(sums * down[starts] + (ends - starts).astype(U))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text number, start and end of every word."""
    inside = ~SPACES[data]
    starts, ends = runs(data, offsets, inside)
    return span_hashes(data, starts, ends, inside), np.searchsorted(offsets, starts, "right") - 1, starts, ends


def shingles(hashes: np.ndarray, owner: np.ndarray, n: int, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k words in a row and the text of each, in order; a text of 1 to k-1 words has one shingle of all of them.

    hashes, owner: of the words, in order; n: number of texts.
    """
    step = U(BASE)
    total = len(hashes)
    if total >= k:
        mixed = np.zeros(total - k + 1, U)
        for j in range(k):
            mixed = mixed * step + hashes[j : total - k + 1 + j]
        whole = owner[: total - k + 1] == owner[k - 1 :]
        codes, who = mix(mixed[whole]), owner[: total - k + 1][whole]
    else:
        codes, who = np.zeros(0, U), np.zeros(0, np.int64)
    counts = np.bincount(owner, minlength=n) if total else np.zeros(n, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        first = np.searchsorted(owner, short)
        few = np.zeros(len(short), U)
        for j in range(k - 1):
            has = counts[short] > j
            few[has] = few[has] * step + hashes[first[has] + j]
        codes, who = np.concatenate([codes, mix(few + counts[short].astype(U))]), np.concatenate([who, short])
        order = np.argsort(who, kind="stable")
        codes, who = codes[order], who[order]
    return codes, who


def distinct(codes: np.ndarray, who: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, code) in order of text and code, with their counts."""
    order = np.lexsort((codes, who))
    codes, who = codes[order], who[order]
    if not len(codes):
        return codes, who, np.zeros(0, np.int64)
    new = np.ones(len(codes), bool)
    new[1:] = (codes[1:] != codes[:-1]) | (who[1:] != who[:-1])
    at = np.flatnonzero(new)
    return codes[at], who[at], np.diff(np.append(at, len(codes)))
