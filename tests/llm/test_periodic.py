import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from millrace.llm import periodic as m
from millrace.llm.queries import QUERIES


def slow_runs(words, least=12):
    """(start, length, period) by trying every period at every place."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i < len(words) - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i < len(words) - q and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(least, 2 * q):
                found.setdefault((start, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def slow_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def split(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def sample(rnd):
    words = [f"w{rnd.randrange(k)}" for k in [rnd.choice([1, 2, 3, 5, 40])] for _ in range(rnd.randint(0, 60))]
    for _ in range(rnd.randint(0, 4) if words else 0):
        a, p = rnd.randrange(len(words)), rnd.randint(1, 20)
        block = words[a : a + p]
        words[a:a] = block * rnd.randint(1, 4) + block[: rnd.randrange(len(block) + 1)]
    return words


@pytest.mark.parametrize("least", [2, 5, 12, 20])
def test_runs_equal_brute_force(least):
    rnd = random.Random(least)
    for _ in range(60):
        docs = [sample(rnd) for _ in range(6)]
        names = {w: i for i, w in enumerate(sorted({w for d in docs for w in d}))}
        owner = np.repeat(np.arange(6), [len(d) for d in docs])
        ids = m.word_ids(np.array([names[w] for d in docs for w in d], np.uint64), owner)
        begins = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
        got = [[] for _ in docs]
        for s, e, q in zip(*m.find(ids, owner, least)):
            got[owner[s]].append((int(s - begins[owner[s]]), int(e - s), int(q)))
        assert [sorted(g) for g in got] == [slow_runs(d, least) for d in docs]


def test_grammar_is_re_pair():
    """Expanding it gives the words; no pair of symbols is left twice; places are where the rules' words are."""
    rnd = random.Random(3)
    words = np.array(sample(rnd) * 3 + [str(rnd.randrange(4)) for _ in range(200)])
    ids = m.word_ids(np.unique(words, return_inverse=True)[1].astype(np.uint64), np.zeros(len(words), np.int64))
    g = m.compress(ids, np.zeros(len(words), np.int64))
    symbols = [tuple(ids[a:b]) for a, b in zip(g.heads, np.append(g.heads[1:], len(ids)))]
    pairs = list(zip(symbols, symbols[1:]))
    left_over = [p for i, p in enumerate(pairs) if p in pairs[:i] and not (i and pairs[i - 1] == p)]
    assert not left_over
    for rule in range(len(g.left)):
        at = g.at[g.rule == rule]
        assert len(at) >= 2 and len({tuple(ids[a : a + g.length[rule]]) for a in at}) == 1


@pytest.mark.parametrize("words", [[0] * 200_000, [0, 1, 2] * 60_000, list(range(700)) * 200])
def test_long_repetitions_are_one_run(words):
    owner = np.zeros(len(words), np.int64)
    start, end, period = m.find(m.word_ids(np.array(words, np.uint64), owner), owner)
    assert (start.tolist(), end.tolist(), period.tolist()) == ([0], [len(words)], [len(set(words))])


def edited(doc_id, text):
    words = split(text)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def digest(x):
    return hashlib.sha256(x.encode()).hexdigest()


def test_query_on_the_given_documents(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, sf_dir).collect()}
    assert got.keys() == docs.keys()
    for i, text in docs.items():
        words = edited(i, text)
        if len(words) > 4000:
            continue
        runs, r = slow_runs(words), got[i]
        best = max(runs, key=lambda x: (x[1], -x[0], -x[2])) if runs else None
        assert (r.n_runs, r.runs_sha256) == (len(runs), digest("".join(f"{s},{n},{q}\n" for s, n, q in sorted(runs, key=lambda x: (x[0], x[2])))))
        assert r.collapsed_sha256 == digest(slow_collapsed(words, runs))
        assert (r.start, r.length, r.period, r.exponent_milli) == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
    assert sum(r.n_runs > 0 for r in got.values()) > 0.05 * len(docs)


def test_anything_goes(oddities, nothing, frame):
    got = m.collapse(oddities.withColumnsRenamed({"key": "runs", "seed": "id", "ids": "collapsed"}))
    rows = got.collect()
    assert got.columns == ["doc_id", "n_words", "runs", "collapsed"] and len(rows) == oddities.count()
    assert m.collapse(nothing).count() == 0 and m.digests(m.collapse(nothing)).count() == 0
    by_id = {r.doc_id: r for r in rows}
    assert by_id[0].collapsed == by_id[1].collapsed == by_id[2].collapsed == "" and not by_id[0].runs
    assert by_id[7].collapsed == "1 2 3" and [tuple(x) for x in by_id[7].runs] == [(0, 1200, 3)]
    assert m.digests(got).where("doc_id is null").count() == 2


def test_a_very_long_text(frame):
    rnd = random.Random(5)
    words = [f"{rnd.choice('abcdefgh')}{rnd.randrange(9000)}" for _ in range(800_000)]
    words[300_000:300_000] = words[:40_000] * 3
    words += ["x"] * 100_000
    (row,) = m.collapse(frame([(1, " ".join(words), None, None, None), (2, "a b c", None, None, None)])).where("doc_id = 1").collect()
    assert [tuple(r) for r in row.runs] == [(300_000, 120_000, 40_000), (920_000, 100_000, 1)]
    assert row.collapsed == " ".join(words[:340_000] + words[420_000:920_001])
