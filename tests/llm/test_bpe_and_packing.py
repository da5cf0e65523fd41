import hashlib
import random
import struct

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import bpe, packing
from millrace.llm import text as tx
from millrace.llm.queries import default_tokenizer

tokenizers = pytest.importorskip("tokenizers")
PATH = default_tokenizer()


@pytest.fixture(scope="module")
def reference():
    return tokenizers.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.tokenizer_text(PATH))


def odd_texts(n, seed):
    rnd = random.Random(seed)
    parts = ["a", "B", " ", "  ", "\n", "é", "日本", " ", "　", "<|endoftext|>", "<|endof", "'s", "'ll", "12", "!?", "\U0001f600", "\t", "x" * 40, " ", "́", "\x1c", "\x85", "ab" * 300, "word", " the"]
    return ["".join(rnd.choice(parts) for _ in range(rnd.choice([0, 1, 5, 50, 700]))) for _ in range(n)]


def test_encoding_equals_the_library(reference, encoder):
    texts = odd_texts(150, 1) + ["", "a" * 20_000, " " * 9_000]
    for text, ids in zip(texts, encoder.encode([t.encode() for t in texts])):
        assert ids.tolist() == reference.encode(text, add_special_tokens=False).ids
        assert encoder.decode(ids) == text.encode()


@pytest.mark.parametrize("shortest,bits", [(1, 2), (3, 3), (40, 6)])
def test_chunks_are_repaired_to_the_ids_of_the_whole(reference, encoder, monkeypatch, shortest, bits):
    monkeypatch.setattr(bpe, "SHORTEST", shortest)
    monkeypatch.setattr(bpe.cuts, "__defaults__", (bits,))
    texts = odd_texts(200, 2 + bits)
    chunked = bpe.Chunked(encoder, memory=20_000)
    got = chunked.texts(*tx.flat(pa.array(texts)))
    assert chunked.repaired and chunked.encoded < chunked.chunks
    for text, ids in zip(texts, got):
        assert ids.tolist() == reference.encode(text, add_special_tokens=False).ids


def test_cuts_depend_on_content_only():
    rnd = random.Random(3)
    passage = "".join(rnd.choice("abcdefgh ") for _ in range(20_000))
    one, other = "x" * 777 + passage, passage
    bounds = bpe.cuts(*tx.flat(pa.array([one, other])))
    a = {one[s:e] for s, e in zip(bounds[0][:-1], bounds[0][1:])}
    shift = len(one)
    b = {other[s - shift : e - shift] for s, e in zip(bounds[1][:-1], bounds[1][1:])}
    assert len(a & b) >= 0.8 * len(b)


def test_digests(oddities, reference):
    rows = bpe.digests(oddities, PATH).collect()
    texts = [(r.doc_id, r.text or "") for r in oddities.collect()]
    want = []
    for i, t in texts:
        ids = reference.encode(t, add_special_tokens=False).ids
        back = reference.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    order = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows), key=order) == sorted(want, key=order)


def test_encode_and_decode_columns(oddities, nothing):
    both = bpe.decode(bpe.encode(oddities, PATH), PATH)
    assert both.where(F.coalesce("text", F.lit("")) != F.col("decoded")).count() == 0
    assert both.where(F.size("ids") != F.col("n_tokens")).count() == 0 and both.count() == oddities.count()
    assert set(oddities.columns) - {"_text"} <= set(both.columns)
    assert bpe.encode(nothing, PATH).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_best_fit_equals_a_plain_search(seed):
    rnd = random.Random(seed)
    row = rnd.choice([1, 7, 16, 100])
    sizes = [rnd.randint(1, row) for _ in range(300)]
    got = packing.best_fit_decreasing(sizes, row)
    room = []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [r for r in room if r >= sizes[i]]
        if fits:
            room.remove(min(fits))
            room.append(min(fits) - sizes[i])
        else:
            room.append(row - sizes[i])
    assert sorted(row - sum(sizes[i] for i in members) for members in got) == sorted(room)
    assert sorted(i for members in got for i in members) == list(range(len(sizes)))


def test_packed_rows_give_the_documents_back(frame, reference, words):
    rows = [(i, " ".join(words(3 + 40 * i, i)) if i % 5 else "", "en", "s", 0) for i in range(40)] + [(90, None, "en", "s", 0)]
    found = packing.pack(frame(rows), PATH, row=64, group_tokens=2_000).collect()
    pieces = {}
    for r in found:
        ids, places = np.frombuffer(r.input_ids, "<u4"), np.frombuffer(r.position_ids, "<u4")
        assert len(ids) == len(places) == 64 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens
        assert (ids[r.n_tokens :] == packing.PAD).all()
        for doc, start, a, b in zip(r.doc_ids, r.doc_starts, r.cu_seqlens, r.cu_seqlens[1:]):
            assert places[a:b].tolist() == list(range(b - a))
            pieces[doc, start] = ids[a:b].tolist()
    for i, t, *_ in rows:
        own = [x for (d, _), piece in sorted(pieces.items()) if d == i for x in piece]
        assert own == reference.encode(t or "", add_special_tokens=False).ids


def test_packing_takes_anything(oddities, nothing):
    assert packing.pack(oddities, PATH, row=128).count() > 0
    assert packing.pack(nothing, PATH).count() == 0
