"""Language, toxicity, perplexity and fingerprints: accuracy on held-out rows, and plain Python beside them."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import fingerprint as fp
from millrace.llm import language as la
from millrace.llm import perplexity as px
from millrace.llm import toxicity as to

LETTERS = {"aa": "abcdefg ", "bb": "defghijk ", "cc": "xyzñéü "}


def tongue(lang, n, seed):
    r = random.Random(f"{lang}{seed}")
    return "".join(r.choice(LETTERS[lang]) for _ in range(n))


@pytest.fixture(scope="module")
def tongues(frame):
    rows = [(i, tongue(lang, 40 + i % 300, i), lang, "s", 0) for i in range(300) for lang in [sorted(LETTERS)[i % 3]]]
    return frame(rows + [(900, None, "aa", "s", 0), (901, "123 !?", "aa", "s", 0), (902, "", None, "s", 0)])


def test_language_accuracy(tongues):
    got = la.predict(tongues, la.fit(tongues, per_language=60)).withColumn("held", la.held_out(F.col("doc_id"))).collect()
    asked = [r for r in got if r.held and r.doc_id < 900]
    assert len(asked) > 30 and sum(r.lang == r.lang_pred for r in asked) >= 0.97 * len(asked)
    assert all(r.lang_pred == "und" and r.lang_score == 0 and r.lang_rejected for r in got if r.doc_id >= 900)
    assert all(0 <= r.lang_score <= 1 for r in got) and not any(r.lang_rejected for r in got if r.doc_id < 900)


def test_far_texts_are_rejected(tongues, frame):
    model = la.fit(tongues, per_language=60)
    odd = frame([(1, "日本語の文章はここにあります" * 20, "aa", "s", 0)])
    assert la.predict(odd, model).first().lang_rejected and la.identified(tongues).columns == tongues.columns


def test_language_takes_anything(oddities, nothing):
    model = la.fit(oddities)
    got = la.predict(oddities, model)
    assert got.count() == oddities.count() and set(oddities.columns) <= set(got.columns)
    empty = la.fit(nothing)
    assert la.predict(nothing, empty).count() == 0
    assert {r.lang_pred for r in la.predict(oddities, empty).collect()} == {"und"}


def test_toxicity_on_held_out_rows(frame, spark, words):
    bad = ["vile", "rotten", "filth"]
    rows, labels = [], []
    for i in range(900):
        w = words(60, i)
        toxic = i % 9 == 0
        if toxic:
            for k in range(3):
                w[(7 * i + 11 * k) % 60] = bad[(i + k) % 3]
        rows.append((i, " ".join(w), "en", "s", 0))
        if i % 2:
            labels.append((i, int(toxic)))
    docs, table = frame(rows + [(5000, None, None, None, None), (5001, "", None, None, None)]), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in to.score(docs, to.fit(docs, table)).collect()}
    assert len(got) == 902 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    held = [r.doc_id for r in docs.where(la.held_out(F.col("doc_id")) & (F.col("doc_id") < 5000)).collect()]
    wrong = sum(got[i].predicted != int(i % 9 == 0) for i in held)
    assert wrong <= 0.03 * len(held) and got[5000].score == got[5001].score < 0.5


@pytest.mark.parametrize("shift", [0.0, -4.0])
def test_toxicity_risk_and_its_slope(shift):
    """Against the definition, and against differences; where the clean part is negative the step goes up it."""
    rnd = np.random.default_rng(4)
    positive = np.arange(40) < 15
    z, prior = rnd.standard_normal(40) + shift + np.where(positive, 6, 0) * (shift < 0), 0.3
    loss = lambda x: 1 / (1 + np.exp(x))
    parts = lambda z: (prior * loss(z[positive]).mean(), loss(-z[~positive]).mean() - prior * loss(-z[positive]).mean())
    value, clean, slope = to.risk(z, positive, prior)
    toxic, want_clean = parts(z)
    assert (clean < 0) == (shift < 0)
    assert np.isclose(clean, want_clean) and np.isclose(value, toxic + max(0, want_clean))
    for i in range(40):
        up = z.copy()
        up[i] += 1e-6
        moved = (sum(parts(up)) - sum(parts(z))) / 1e-6 if clean >= 0 else -(parts(up)[1] - parts(z)[1]) / 1e-6
        assert np.isclose(slope[i], moved, atol=1e-5)


def test_toxicity_grams_equal_plain_python():
    import pyarrow as pa

    texts = [None, "", "Don't! über-Tag  don't", "a", "1 ab2cd", "x" * 50, "日本語 テキスト"]
    rows, slots, counts = to.gram_slots(pa.array(texts))
    got = defaultdict(list)
    for r, c in zip(rows, counts):
        got[int(r)].append(int(c))
    for i, t in enumerate(texts):
        words = "".join(c if c.isalpha() or c == "'" else " " for c in (t or "").lower()).split()
        want = Counter(g for w in words for n in to.ORDERS for g in [f" {w} "[j : j + n] for j in range(len(w) + 3 - n)])
        assert sorted(got[i]) == sorted(want.values())
    only = np.zeros(to.SLOTS, bool)
    only[slots[rows == 2][:5]] = True
    part = to.gram_slots(pa.array(texts), only)
    keep = only[slots]
    assert all((a == b[keep]).all() for a, b in zip(part, (rows, slots, counts)))


def test_toxicity_in_every_language_of_the_given_data(spark):
    """Held-out labels of the larger table: recall of 0.9 or more, hardly a false alarm."""
    root = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{root}/{n}.parquet") for n in ("documents", "labels"))
    found = to.score(docs, to.fit(docs, labels))
    rows = found.join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id").where(la.held_out(F.col("doc_id"))).select("lang", "toxic", "predicted").collect()
    hits = lambda lang: [r.predicted for r in rows if r.toxic == 1 and (lang is None or r.lang == lang)]
    assert sum(hits(None)) >= 0.9 * len(hits(None))
    for lang in ("en", "de", "fr", "es"):
        assert sum(hits(lang)) >= 0.9 * len(hits(lang)) > 4
    clean = [r.predicted for r in rows if r.toxic == 0]
    assert len(clean) > 600 and sum(clean) <= 0.01 * len(clean)


def test_toxicity_takes_anything(oddities, nothing, spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    some = spark.createDataFrame([(None, 1), (3, None), (4, 1), (5, 0), (4, 1)], "doc_id long, toxic int")
    for labels in (none, some):
        assert to.score(oddities, to.fit(oddities, labels)).count() == oddities.count()
    assert to.score(nothing, to.fit(nothing, some)).count() == 0


def kneser_ney(texts):
    """Log probability of a 4-gram of symbols, straight from the definition."""
    symbols = lambda t: [px.START] * 3 + [int(px.TABLE[ord(c) & 0xFFFF]) for c in t]
    counts = {4: Counter()}
    for t in texts:
        s = symbols(t)
        counts[4].update(tuple(s[i : i + 4]) for i in range(len(s) - 3))
    for k in (3, 2, 1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    cut = {k: px.discounts(*[sum(c == n for c in counts[k].values()) for n in (1, 2, 3, 4)]) for k in counts}
    total, kept = defaultdict(int), defaultdict(float)
    for k in counts:
        for g, c in counts[k].items():
            total[g[:-1], k] += c
            kept[g[:-1], k] += cut[k][min(c, 3) - 1]

    def p(g):
        if not g:
            return 1 / px.SYMBOLS
        k, context = len(g), g[:-1]
        if not total[context, k]:
            return p(g[1:])
        c = counts[k][g]
        return (max(c - cut[k][min(c, 3) - 1], 0) if c else 0) / total[context, k] + kept[context, k] / total[context, k] * p(g[1:])

    return lambda t: (lambda s: math.exp(-sum(math.log(p(tuple(s[i : i + 4]))) for i in range(len(s) - 3)) / len(t)))(symbols(t))


def test_perplexity_equals_the_definition(frame, words):
    rows = [(i, " ".join(words(30, i)) + (". Ok!\n" if i % 2 else ""), "en", "s", 0) for i in range(30)]
    rows += [(100, "ZZZ!! %% QQ", "en", "s", 0), (101, "été 1999", "fr", "s", 0), (102, "", "en", "s", 0), (103, None, None, "s", 0)]
    docs = frame(rows)
    value = kneser_ney([t for i, t, *_ in rows if i < 30])
    got = {r.doc_id: r for r in px.assess(docs, docs.where("doc_id < 30").select("doc_id")).collect()}
    for i, t, *_ in rows:
        if t:
            assert got[i].perplexity == pytest.approx(value(t), rel=1e-4)
    assert not got[100].keep and got[102].perplexity is None and not got[102].keep and not got[103].keep
    assert sum(got[i].keep for i in range(30)) >= 29


def test_probabilities_sum_to_one(frame, words):
    docs = frame([(i, " ".join(words(20, i)), "en", "s", 0) for i in range(8)])
    table = np.exp(px.train(docs).table().astype(np.float64)).reshape(-1, px.SYMBOLS).sum(axis=1)
    assert np.abs(table - 1).max() < 1e-3


def test_perplexity_takes_anything(oddities, nothing):
    none = oddities.limit(0).select("doc_id")
    for ids in (none, oddities.select("doc_id")):
        assert px.assess(oddities, ids).count() == oddities.count()
    assert px.assess(nothing, none).count() == 0


def entropy(window):
    return -sum(n / len(window) * math.log2(n / len(window)) for n in Counter(window).values())


def test_window_entropies():
    data = np.frombuffer(("abcab zz" * 40 + "".join(chr(65 + i * i % 57) for i in range(200))).encode(), np.uint8)
    got = fp.entropies(data)
    for i in range(0, len(got), 7):
        want = entropy(data[i : i + fp.WINDOW].tolist()) / 6 * fp.BINS
        assert abs(got[i] - min(want, fp.BINS - 1)) <= 1.001
    assert (fp.each_entropy(np.tile(data, 400)) == fp.entropies(np.tile(data, 400))).all()


def test_edits_and_neighbours(frame, words):
    rows = [(i, " ".join(words(5 + 60 * (i % 4), i)), "en", "s", 0) for i in range(40)] + [(60, "", "en", "s", 0), (61, None, "en", "s", 0), (62, "short é", "en", "s", 0), (63, "x", "en", "s", 0), (64, "x", "en", "s", 0)]
    docs = frame(rows)
    rank = fp.rarity(fp.entropy_counts(docs))
    got = {r.doc_id: r for r in fp.with_edits(docs, rank, 5).collect()}
    order = sorted((i for i, *_ in rows), reverse=True)
    text = {i: t or "" for i, t, *_ in rows}
    assert sorted(got) == sorted(order)
    for here, following in zip(order, order[1:] + order[:1]):
        half = len(text[here]) // 2
        edited = text[here][: len(text[here]) - half] + text[following][:half]
        r = got[here]
        assert r.n_chars == len(text[here]) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.near_next == fp.likeness(fp.fingerprint(np.frombuffer(text[here].encode(), np.uint8), rank), fp.fingerprint(np.frombuffer(text[following].encode(), np.uint8), rank))
        assert 0 <= r.near_edited <= 1
    long = [i for i in range(40) if i % 4 > 1]
    assert np.mean([got[i].near_edited for i in long]) > 0.25 > 0.1 > np.mean([got[i].near_next for i in long])
    assert got[64].near_next == 1 and got[64].fingerprint == got[63].fingerprint


def test_likeness():
    rng = np.random.default_rng(2)
    rank = fp.rarity([0] * fp.BINS)
    a, b = (rng.integers(97, 123, 30_000).astype(np.uint8) for _ in range(2))
    mixed = np.concatenate([a[:15_000], b[:15_000]])
    x, y, z = (fp.fingerprint(v, rank) for v in (a, b, mixed))
    assert fp.likeness(x, x) == 1 and fp.likeness(x, y) < 0.05 and 0.3 < fp.likeness(x, z) < 0.9
    assert fp.likeness(b"", x) == 0 and fp.likeness(b"", b"") == 1 and fp.likeness(x, z) == fp.likeness(z, x)


def test_fingerprints_take_anything(oddities, nothing):
    rank = fp.rarity(fp.entropy_counts(oddities))
    assert fp.fingerprints(oddities, rank).count() == fp.with_edits(oddities, rank, 3).count() == oddities.count()
    assert fp.with_edits(nothing, rank, 3).count() == 0 and fp.entropy_counts(nothing) == [0] * fp.BINS
