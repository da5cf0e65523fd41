"""Token ids packed into rows of equal length by best-fit-decreasing.

Documents are encoded, texts longer than a row are split into pieces without loss, and pieces go, longest first,
to the open row with the least room that still holds them. That row is found in a segment tree over room sizes.
Rows of a group of documents are made together; a group ends at a bound of tokens, so memory is bounded by it
and by the longest document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm import bpe
from millrace.llm import text as tx

ROW = 2048
GROUP_TOKENS = 8_000_000
PAD = 50256


class Rooms:
    """Open rows by the room left in them; finds the smallest room of at least a size in O(log length)."""

    def __init__(self, length: int):
        self.leaves = 1
        while self.leaves < length + 1:
            self.leaves *= 2
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        node = room + self.leaves
        while node:
            self.count[node] += 1
            node //= 2

    def take(self, size: int) -> tuple[int, int] | None:
        """(room, row) of the tightest row with at least `size` left, removed from the tree; None if there is none."""
        if size >= len(self.rows):
            return None
        node = size + self.leaves
        if not self.count[node]:
            while node > 1 and (node % 2 or not self.count[node + 1]):
                node //= 2
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.leaves
        while node:
            self.count[node] -= 1
            node //= 2
        return room, self.rows[room].pop()


def split(lengths: np.ndarray, row: int) -> list[tuple[int, int, int]]:
    """(document, start, length) of pieces of at most `row` tokens that cover every document."""
    return [(i, s, min(row, n - s)) for i, n in enumerate(lengths.tolist()) for s in range(0, n, row)]


def best_fit_decreasing(sizes: list[int], row: int) -> list[list[int]]:
    """Numbers of the pieces in each row; equal sizes keep their order."""
    rooms, rows = Rooms(row), []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = rooms.take(sizes[i])
        if found is None:
            rows.append([])
            room, at = row, len(rows) - 1
        else:
            room, at = found
        rows[at].append(i)
        if room > sizes[i]:
            rooms.put(room - sizes[i], at)
    return rows


def packed_rows(doc_ids: list, ids: list[np.ndarray], row: int, pad: int) -> pa.RecordBatch:
    """Rows of one group of documents."""
    pieces = split(np.array([len(x) for x in ids], np.int64), row)
    rows = best_fit_decreasing([p[2] for p in pieces], row)
    matrix = np.full((len(rows), row), pad, "<u4")
    places = np.zeros((len(rows), row), "<u4")
    ends, owners, starts = [], [], []
    for r, members in enumerate(rows):
        at, own = 0, [0]
        for m in members:
            doc, start, n = pieces[m]
            matrix[r, at : at + n] = ids[doc][start : start + n]
            places[r, at : at + n] = np.arange(n)
            at += n
            own.append(at)
        if at < row:
            places[r, at:] = np.arange(row - at)
        ends.append(own)
        owners.append([doc_ids[pieces[m][0]] for m in members])
        starts.append([pieces[m][1] for m in members])
    return pa.RecordBatch.from_arrays(
        [
            pa.array([m.tobytes() for m in matrix], pa.binary()),
            pa.array([p.tobytes() for p in places], pa.binary()),
            pa.array(ends, pa.list_(pa.int32())),
            pa.array(owners, pa.list_(pa.int64())),
            pa.array(starts, pa.list_(pa.int64())),
            pa.array([e[-1] for e in ends], pa.int32()),
        ],
        ["input_ids", "position_ids", "cu_seqlens", "doc_ids", "doc_starts", "n_tokens"],
    )


SCHEMA = "input_ids binary, position_ids binary, cu_seqlens array<int>, doc_ids array<bigint>, doc_starts array<bigint>, n_tokens int"


def pack(docs: DataFrame, tokenizer: str, row: int = ROW, pad: int = PAD, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """Rows of `row` ids: input_ids and position_ids as little-endian unsigned 32-bit integers, cu_seqlens (0 and the
    end of each piece), doc_ids and doc_starts (the document of each piece and its first token there), n_tokens
    (without padding).

    Positions start anew at each piece, and at the padding, which is filled with `pad`. A document without tokens
    (null or empty text) is in no row; a null doc_id stays null; rows that repeat are packed as often. Documents
    are packed where they are read, so nothing is shuffled; each task closes its own last rows.
    """
    content = bpe.tokenizer_text(tokenizer)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = bpe.encoder(content)
        held_docs: list = []
        held: list[np.ndarray] = []
        tokens = 0

        def finished() -> Iterator[pa.RecordBatch]:
            made = packed_rows(held_docs, held, row, pad)
            for at in range(0, made.num_rows, 512):
                yield made.slice(at, 512)

        for part in tx.slices(batches, budget=4 * tx.SLICE_BYTES):
            data, offsets = tx.flat(part.column("text"))
            raw = data.tobytes()
            found = own.encode([raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())])
            held_docs += part.column("doc_id").to_pylist()
            held += found
            tokens += sum(map(len, found))
            if tokens >= group_tokens:
                yield from finished()
                held_docs, held, tokens = [], [], 0
        if tokens:
            yield from finished()

    return docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), "text").mapInArrow(apply, SCHEMA)


def write(packed: DataFrame, path: str) -> None:
    """Write packed rows as Parquet files, whose binary columns are the rows of the id and position matrices."""
    packed.write.mode("overwrite").parquet(path)
