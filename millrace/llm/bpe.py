"""Byte-level BPE: encoding with reuse of content-defined chunks, and decoding.

Text is cut where a rolling hash over the last 32 bytes says so, so that documents which share a passage share
the chunks in it. A chunk is encoded once in a task, however many documents hold it; documents with the same
smallest chunk are brought to the same task first. Cuts may fall anywhere between characters, also inside a
word, so the ids around a cut are repaired: a stretch around it is encoded anew, from a place before the cut
to one after it, both being places where the tokens of the chunks and of the new stretch agree in having a
boundary. If they do not agree, the stretch grows. Places that can serve are those where white space follows
another character: no token of this kind of tokenizer spans them, and the split into pieces before and after
them does not depend on the other side. The result is therefore that of encoding the whole text.
"""

from __future__ import annotations

import hashlib
import json
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from millrace.llm import text as tx

U = np.uint64
CUT_BITS = 10  # one cut in 1,024 bytes on average
SHORTEST, LONGEST = 256, 16_384
UNIT_BYTES = 48  # longer units are encoded one by one
CHUNK_MEMORY = 48 << 20
SLICE_IDS = 1 << 18  # decoded at a time
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_characters() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the rest from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def vocabulary(content: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Ids of byte strings, and of special tokens, from the JSON of a byte-level BPE tokenizer."""
    spec = json.loads(content)
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    code = byte_characters()
    return {bytes(code[c] for c in word): i for word, i in spec["model"]["vocab"].items() if word not in special}, special


def space_ends(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of units: first bytes of texts, and white space that follows a character which is none."""
    n = len(data)
    space = tx.SPACES[data]
    start = np.zeros(n, bool)
    start[1:] = space[1:] & ~space[:-1]
    at = np.flatnonzero(start)
    at = at[data[at - 1] >= 0x80]
    if len(at):  # the character before may be white space beyond ASCII
        padded = np.concatenate([np.zeros(2, np.uint8), data])
        a, b, c = padded[at - 1], padded[at], padded[at + 1]  # the three bytes before `at`
        wide = (b == 0xC2) & ((c == 0x85) | (c == 0xA0))
        wide |= (a == 0xE1) & (b == 0x9A) & (c == 0x80)
        wide |= (a == 0xE2) & (b == 0x80) & (((c >= 0x80) & (c <= 0x8A)) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
        wide |= (a == 0xE2) & (b == 0x81) & (c == 0x9F)
        wide |= (a == 0xE3) & (b == 0x80) & (c == 0x80)
        start[at[wide]] = False
    first = offsets[:-1]
    start[first[first < n]] = True
    return np.flatnonzero(start)


class Encoder:
    """Encodes byte strings to ids exactly as the whole-text tokenizer would."""

    def __init__(self, content: str):
        ranks, special = vocabulary(content)
        self.special = special
        self.core = tiktoken.Encoding("own", pat_str=PIECES, mergeable_ranks=ranks, special_tokens=special)
        size = max([*ranks.values(), *special.values()]) + 1
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self.bytes_of = [b""] * size
        for word, i in ranks.items():
            self.bytes_of[i] = word
        for word, i in special.items():
            self.bytes_of[i] = word.encode()
        self.lengths = np.array([len(b) for b in self.bytes_of], np.int64)
        self.table = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.table_starts = np.concatenate([[0], np.cumsum(self.lengths)])

    def plain(self, text: bytes) -> list[int]:
        text = text.decode("utf-8")
        if any(s in text for s in self.special):
            return self.core.encode(text, allowed_special="all")
        return self.core.encode_ordinary(text)

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text. Texts are cut to units at `space_ends`, and distinct units are encoded once.

        Units that start with white space and end with another character stand in a row without changing each
        other, so all distinct ones are encoded in one call; the rest are encoded one by one.
        """
        data = np.frombuffer(b"".join(texts), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
        if not len(data):
            return [np.zeros(0, self.dtype) for _ in texts]
        starts = space_ends(data, offsets)
        ends = np.append(starts[1:], len(data))
        closed = np.ones(len(starts), bool)  # ends without white space: all but the last unit of a text do
        final = np.searchsorted(starts, offsets[1:][np.diff(offsets) > 0]) - 1
        closed[final] = ~tx.SPACES[data[ends[final] - 1]] & (data[ends[final] - 1] < 0x80)
        plain = tx.SPACES[data[starts]] & closed & (ends - starts <= UNIT_BYTES)
        which = np.flatnonzero(plain)
        _, first, inverse = np.unique(tx.span_hashes(data, starts, ends)[which], return_index=True, return_inverse=True)
        at = which[first]
        raw = data.tobytes()
        ids = np.array(self.plain(b"".join([raw[s:e] for s, e in zip(starts[at].tolist(), ends[at].tolist())])), np.int64)
        upto = np.searchsorted(np.cumsum(self.lengths[ids]), np.cumsum(ends[at] - starts[at])) + 1
        store, base, size = [ids.astype(self.dtype)], np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        from_ = np.concatenate([[0], upto[:-1]]) if len(upto) else upto
        base[which], size[which] = from_[inverse], (upto - from_)[inverse]
        used = len(ids)
        for i in np.flatnonzero(~plain).tolist():
            own = self.plain(raw[starts[i] : ends[i]])
            store.append(np.array(own, self.dtype))
            base[i], size[i] = used, len(own)
            used += len(own)
        edges = np.concatenate([[0], np.cumsum(size)])
        out = np.concatenate(store)[np.repeat(base - edges[:-1], size) + np.arange(edges[-1])]
        owner = np.searchsorted(starts, offsets)
        return [out[edges[a] : edges[b]] for a, b in zip(owner[:-1], owner[1:])]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that the ids stand for."""
        sizes = self.lengths[ids]
        edges = np.cumsum(sizes)
        total = int(edges[-1]) if len(edges) else 0
        return self.table[np.repeat(self.table_starts[:-1][ids] - (edges - sizes), sizes) + np.arange(total)].tobytes()


_encoders: dict[str, Encoder] = {}


def encoder(content: str) -> Encoder:
    """The worker's encoder for a tokenizer."""
    key = hashlib.md5(content.encode()).hexdigest()
    if key not in _encoders:
        _encoders[key] = Encoder(content)
    return _encoders[key]


def cuts(data: np.ndarray, offsets: np.ndarray, bits: int = CUT_BITS) -> list[np.ndarray]:
    """Content-defined chunk bounds of each text, first and last included.

    A chunk has SHORTEST to LONGEST bytes (the last may be shorter, and a character is never cut).
    """
    n = len(data)
    rolling = tx.BYTE_CODES[data]
    for j in (1, 2, 4, 8, 16):
        rolling[j:] = rolling[j:] + (rolling[:-j] << U(j))
    head = (data & 0xC0) != 0x80
    marked = np.zeros(n + 1, bool)
    marked[1:n] = ((rolling >> U(32 - bits)) & U((1 << bits) - 1))[: n - 1] == 0
    marked[:n] &= head
    places = np.flatnonzero(marked)
    out = []
    for low, high in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        own = places[np.searchsorted(places, low) : np.searchsorted(places, high)]
        bounds = [low]
        while high - bounds[-1] > SHORTEST:
            i = np.searchsorted(own, bounds[-1] + SHORTEST)
            at = int(own[i]) if i < len(own) else high
            if at - bounds[-1] > LONGEST:
                at = bounds[-1] + LONGEST
                while not head[at]:
                    at -= 1
            if at >= high:
                break
            bounds.append(at)
        bounds.append(high)
        out.append(np.array(bounds, np.int64))
    return out


class Chunked:
    """Encodes texts chunk by chunk; ids of chunks are kept by content up to a bound of memory, oldest first out."""

    def __init__(self, encoder: Encoder, memory: int = CHUNK_MEMORY):
        self.encoder, self.memory, self.held = encoder, memory, 0
        self.kept: OrderedDict[bytes, np.ndarray] = OrderedDict()
        self.chunks = self.encoded = self.repaired = 0

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        if not len(data):
            return [np.zeros(0, self.encoder.dtype) for _ in offsets[1:]]
        raw = data.tobytes()
        bounds = cuts(data, offsets)
        keys = [[raw[a:b] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())] for edge in bounds]
        ids = {k: self.kept[k] for own in keys for k in own if k in self.kept}
        fresh = list(dict.fromkeys(k for own in keys for k in own if k not in ids))
        ids.update(zip(fresh, self.encoder.encode(fresh)))
        self.chunks += sum(map(len, keys))
        self.encoded += len(fresh)
        units = space_ends(data, offsets)
        plans = [self._plan(edge, [ids[k] for k in own], units) for edge, own in zip(bounds, keys)]
        gaps = [raw[a:b] for plan in plans for kind, a, b in plan if kind < 0]
        self.repaired += len(gaps)
        mended = iter(self.encoder.encode(gaps))
        out = []
        for plan, own in zip(plans, keys):
            parts = [next(mended) if kind < 0 else ids[own[kind]][a:b] for kind, a, b in plan]
            out.append(np.concatenate(parts) if parts else np.zeros(0, self.encoder.dtype))
        for k in fresh:
            self.kept[k] = ids[k]
            self.held += len(k) + ids[k].nbytes + 200
        while self.held > self.memory and self.kept:
            k, v = self.kept.popitem(last=False)
            self.held -= len(k) + v.nbytes + 200
        return out

    def _plan(self, edge: np.ndarray, ids: list[np.ndarray], units: np.ndarray) -> list[tuple[int, int, int]]:
        """(chunk, first id, last id) and, for stretches to encode anew, (-1, first byte, last byte), in order."""
        low, high = int(edge[0]), int(edge[-1])
        if len(ids) == 1:
            return [(0, 0, len(ids[0]))]
        tokens = [np.concatenate([[0], np.cumsum(self.encoder.lengths[x])]) + a for x, a in zip(ids, edge[:-1])]

        def bounded(at: int, side: int) -> bool:
            """Whether the tokens of the chunk that holds `at` (side 0: ends with it) have a boundary there."""
            if at in (low, high):
                return True
            k = int(np.searchsorted(edge, at, "right" if side else "left")) - 1
            i = np.searchsorted(tokens[k], at)
            return bool(i < len(tokens[k]) and tokens[k][i] == at)

        stretches: list[list[int]] = []
        for q in edge[1:-1].tolist():
            i = int(np.searchsorted(units, q, "right")) - 1
            if units[i] == q and bounded(q, 0) and bounded(q, 1):
                continue
            a = i if units[i] < q else i - 1
            while units[a] > low and not bounded(int(units[a]), 0):
                a -= 1
            b = i + 1
            while b < len(units) and units[b] < high and not bounded(int(units[b]), 1):
                b += 1
            first, last = max(low, int(units[a])), min(high, int(units[b])) if b < len(units) else high
            if stretches and first <= stretches[-1][1]:
                stretches[-1][1] = max(last, stretches[-1][1])
            else:
                stretches.append([first, last])
        plan: list[tuple[int, int, int]] = []

        def take(a: int, b: int) -> None:
            for k in range(len(ids)):
                s, e = max(a, int(edge[k])), min(b, int(edge[k + 1]))
                if s < e:
                    plan.append((k, int(np.searchsorted(tokens[k], s)), int(np.searchsorted(tokens[k], e))))

        at = low
        for first, last in stretches:
            take(at, first)
            plan.append((-1, first, last))
            at = last
        take(at, high)
        return plan


def tokenizer_text(path: str) -> str:
    """A tokenizer's JSON, read by the driver and sent to the tasks with the code."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def home(text: pa.Array) -> pa.Array:
    """The smallest hash of a chunk of each text: texts that share most chunks mostly share it."""
    out = []
    for part in tx.slices([pa.RecordBatch.from_arrays([text], ["text"])]):
        data, offsets = tx.flat(part.column("text"))
        if not len(data):
            out.append(np.zeros(part.num_rows, np.int64))
            continue
        bounds = cuts(data, offsets)
        full = [b for b in bounds if b[-1] > b[0]]
        starts = np.concatenate([b[:-1] for b in full])
        ends = np.concatenate([b[1:] for b in full])
        hashes = tx.span_hashes(data, starts, ends).view(np.int64)
        counts = np.array([len(b) - 1 if b[-1] > b[0] else 0 for b in bounds])
        least = np.zeros(part.num_rows, np.int64)
        least[counts > 0] = np.minimum.reduceat(hashes, np.concatenate([[0], np.cumsum(counts[counts > 0])[:-1]]))
        out.append(least)
    tx.release()
    return pa.array(np.concatenate(out) if out else np.zeros(0, np.int64))


def together(docs: DataFrame) -> DataFrame:
    """docs with rows of the same home side by side. A home with very many rows is spread over several tasks."""
    at = arrow_udf(home, "bigint")(F.col("text"))
    return docs.withColumn("_home", at).repartitionByRange(F.col("_home"), F.xxhash64("text", "doc_id")).drop("_home")


def _tasks(content: str, finish, names: list[str]):
    """A function for mapInArrow that encodes the texts and adds what `finish` makes of text, encoder and ids."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunked = Chunked(encoder(content))
        for part in tx.slices(batches, "_text"):
            data, offsets = tx.flat(part.column("_text"))
            ids = chunked.texts(data, offsets)
            rest = [c for c, f in zip(part.columns, part.schema.names) if f != "_text"]
            yield pa.RecordBatch.from_arrays([*rest, *finish(chunked.encoder, ids)], [*[f for f in part.schema.names if f != "_text"], *names])

    return tx.worker(apply)


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """docs with `ids` (array<int>) and `n_tokens`; columns of those names are replaced. Null and empty texts have no ids.

    tokenizer: path of a byte-level BPE tokenizer's JSON. A special token's string in a text is that token.
    """
    content = tokenizer_text(tokenizer)

    def finish(_, ids: list[np.ndarray]) -> list[pa.Array]:
        ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
        flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
        return [pa.ListArray.from_arrays(ends, pa.array(flat)), pa.array(np.diff(ends).astype(np.int64))]

    kept = [c for c in docs.columns if c not in ("ids", "n_tokens", "_text")]
    source = together(docs.select(*[F.col(f"`{c}`") for c in kept])).withColumn("_text", F.col("text"))
    schema = docs.select(*[F.col(f"`{c}`") for c in kept]).schema.add("ids", T.ArrayType(T.IntegerType())).add("n_tokens", "long")
    return source.mapInArrow(_tasks(content, finish, ["ids", "n_tokens"]), schema)


def decode(encoded: DataFrame, tokenizer: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """`encoded` with the text of its ids; bytes that are no UTF-8 become replacement characters. Null ids give null."""
    content = tokenizer_text(tokenizer)

    def text(values: pa.Array) -> pa.Array:
        own = encoder(content)
        edges, flat, valid = values.offsets.to_numpy(), values.values.to_numpy(), values.is_valid().to_pylist()
        out, at = [], 0
        while at < len(valid):  # a slice's Python strings at a time
            upto = max(at + 1, int(np.searchsorted(edges, int(edges[at]) + SLICE_IDS, "right")) - 1)
            rows = zip(edges[at:upto], edges[at + 1 : upto + 1], valid[at:upto])
            out.append(pa.array([own.decode(flat[a:b].astype(np.int64)).decode("utf-8", "replace") if v else None for a, b, v in rows], pa.string()))
            at = upto
        whole = pa.concat_arrays(out) if out else pa.array([], pa.string())
        del out
        tx.release()
        return whole

    return encoded.withColumn(into, arrow_udf(text, "string")(F.col(ids)))


def digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, n_bytes) for every row: encoded, then decoded in the same task."""
    content = tokenizer_text(tokenizer)

    def finish(own: Encoder, ids: list[np.ndarray]) -> list[pa.Array]:
        decoded = [own.decode(x).decode("utf-8", "replace").encode() for x in ids]
        return [
            pa.array([len(x) for x in ids], pa.int64()),
            pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids]),
            pa.array([hashlib.sha256(b).hexdigest() for b in decoded]),
            pa.array([len(b) for b in decoded], pa.int64()),
        ]

    source = together(docs.select("doc_id", "text")).withColumnRenamed("text", "_text")
    schema = docs.select("doc_id").schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string").add("n_bytes", "long")
    return source.mapInArrow(_tasks(content, finish, ["n_tokens", "ids_sha256", "decoded_sha256", "n_bytes"]), schema)
