import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import minhash_dups as m
from millrace.llm.components import SKETCH_BITS, Checker, bit_sketches, components
from millrace.llm.store import Stages


def shingle_weights(text, k=5):
    w = text.lower().split()
    s = [tuple(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else ([tuple(w)] if w else [])
    return {x: 1 + math.log(n) for x, n in Counter(s).items()}


def probability_jaccard(a, b):
    keys = set(a) | set(b)
    return sum(1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in keys) for d in set(a) & set(b))


def changed(words, every, seed):
    return [f"new{seed}x{i}" if i % every == seed % every else w for i, w in enumerate(words)]


def test_similarity_is_the_probability_jaccard(words):
    for seed in range(8):
        base = words(60, seed)
        a = " ".join(base + base[:20] * (seed % 3))
        b = " ".join(changed(base, 15 + seed, seed) + base[5:12])
        codes, who, weight = m.weighted_shingles(pa.array([a, b]), 5)
        got = m.similarity((codes[who == 0], weight[who == 0]), (codes[who == 1], weight[who == 1]))
        assert got == pytest.approx(probability_jaccard(shingle_weights(a), shingle_weights(b)), abs=1e-9)


def test_signatures_estimate_it(words):
    base = words(200, 1)
    texts = [" ".join(base), " ".join(changed(base, 40, 3)), " ".join(changed(base, 12, 5)), "one", ""]
    codes, who, weight = m.weighted_shingles(pa.array(texts), 5)
    sign = m.probminhash(codes, who, weight, 5, 4096)
    for x, y in ((0, 1), (0, 2), (1, 2)):
        want = probability_jaccard(shingle_weights(texts[x]), shingle_weights(texts[y]))
        assert np.mean(sign[x] == sign[y]) == pytest.approx(want, abs=4 * math.sqrt(want * (1 - want) / 4096) + 1e-3)
    assert len(set(sign[3].tolist())) == 1 and not sign[4].any()


def classes_by_hand(texts):
    distinct = sorted(set(texts))
    parent = {t: t for t in distinct}

    def root(t):
        while parent[t] != t:
            t = parent[t]
        return t

    sets = {t: shingle_weights(t) for t in distinct}
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if sets[a] and sets[b] and probability_jaccard(sets[a], sets[b]) >= 0.8:
                parent[root(a)] = root(b)
    return {t: root(t) for t in distinct}


def test_classes_equal_brute_force(frame, words):
    texts = []
    for group in range(12):
        base = words(120, group)
        texts += [" ".join(base)] * (1 + group % 3)
        texts += [" ".join(changed(base, every, s)) for s, every in enumerate((9, 25, 40, 60, 110))]
        texts.append(" ".join(base[:60] + words(60, 1000 + group)))
    texts += ["", "one two", "one two"]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    by_hand = classes_by_hand(texts)
    smallest = {}
    for i, t in enumerate(texts):
        smallest.setdefault(by_hand[t], i)
    got = {r.doc_id: r.class_id for r in m.labelled(frame(rows)).collect()}
    assert got == {i: smallest[by_hand[t]] for i, t in enumerate(texts)}
    kept = m.deduplicated(frame(rows))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(smallest.values()) and kept.columns == frame(rows).columns


def test_a_group_that_holds_a_third_of_the_rows(frame, words):
    base = words(150, 99)
    rows = [(i, " ".join(changed(base, 150, i)), "en", "s", 0) for i in range(80)] + [(1000 + i, " ".join(words(80, 5000 + i)), "en", "s", 0) for i in range(160)]
    got = m.labelled(frame(rows)).collect()
    assert {r.class_id for r in got if r.doc_id < 1000} == {0} and len({r.class_id for r in got}) == 161


def test_anything_goes(oddities, nothing):
    got = m.labelled(oddities)
    assert got.count() == oddities.count() and set(oddities.columns) <= set(got.columns)
    kept = m.deduplicated(oddities)
    assert kept.columns == oddities.columns and kept.count() == oddities.select("text").na.fill("").distinct().count()
    assert m.deduplicated(nothing).count() == 0


def test_components(spark):
    links = [(1, 2), (2, 3), (10, 9), (9, 8), (8, 10), (5, 5)] + [(100 + i, 101 + i) for i in range(40)] + [(500, 500 + i) for i in range(1, 50)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long"), Stages(spark, "t")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8, 10: 8} | {i: 100 for i in range(100, 141)} | {i: 500 for i in range(500, 550)}


def test_sketches_differ_by_half_the_distance(words):
    base = words(150, 5)
    texts = [" ".join(base), " ".join(changed(base, 60, 1)), " ".join(changed(base, 25, 2))]
    codes, who, weight = m.weighted_shingles(pa.array(texts), 5)
    bits = np.unpackbits(bit_sketches(m.probminhash(codes, who, weight, 3, SKETCH_BITS)).view(np.uint8), axis=1)
    for x, y in ((0, 1), (0, 2), (1, 2)):
        p = (1 - probability_jaccard(shingle_weights(texts[x]), shingle_weights(texts[y]))) / 2
        assert np.mean(bits[x] != bits[y]) == pytest.approx(p, abs=4 * math.sqrt(p * (1 - p) / SKETCH_BITS))


def test_group_around_the_threshold(frame, words):
    base = words(140, 77)
    texts = [" ".join(changed(base, every, s)) for s, every in enumerate([18, 22, 26, 30, 35, 40, 50, 60, 70] * 5)]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    by_hand = classes_by_hand(texts)
    smallest = {}
    for i, t in enumerate(texts):
        smallest.setdefault(by_hand[t], i)
    assert len(smallest) > 2
    assert {r.doc_id: r.class_id for r in m.labelled(frame(rows)).collect()} == {i: smallest[by_hand[t]] for i, t in enumerate(texts)}


def test_links_of_short_texts_pass_the_sketch(words):
    limit = Checker(None, None, 0.8).most_different()
    for n in (8, 12, 16, 20, 28, 36, 48):
        texts = [" ".join(words(n, 10_000 * n + i) + tail) for i in range(60) for tail in ([], [f"w{i}x{j}" for j in range((n - 4) // 4)])]
        codes, who, weight = m.weighted_shingles(pa.array(texts), 5)
        bits = np.unpackbits(bit_sketches(m.probminhash(codes, who, weight, len(texts), SKETCH_BITS)).view(np.uint8), axis=1)
        for i in range(0, len(texts), 2):
            assert probability_jaccard(shingle_weights(texts[i]), shingle_weights(texts[i + 1])) >= 0.8 - 1e-9
            assert np.sum(bits[i] != bits[i + 1]) <= limit, n


def test_large_buckets_of_short_texts_equal_brute_force(frame, words):
    texts = []
    for n in (10, 16, 26, 46):
        base = words(n, 3000 + n)
        extra = words(n, 4000 + n)
        for s in range(40):
            a, b = s % 8, s // 8
            texts.append(" ".join(base[a * n // 60 :] + [f"{w}{a}" for w in extra[: max(1, b * n // 40)]]))
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    by_hand = classes_by_hand(texts)
    smallest = {}
    for i, t in enumerate(texts):
        smallest.setdefault(by_hand[t], i)
    assert {r.doc_id: r.class_id for r in m.labelled(frame(rows)).collect()} == {i: smallest[by_hand[t]] for i, t in enumerate(texts)}


def test_columns_of_any_name_are_kept(spark):
    rows = [(1, "one two three four five six", "k", "i", "r", "t", "c", 7), (2, "one two three four five six", "k2", "i2", "r2", "t2", "c2", 8), (3, "other words here", "k3", "i3", "r3", "t3", "c3", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _key string, _id string, _row string, text_key string, class_key string, class_size int")
    got = sorted(tuple(r) for r in m.deduplicated(df).collect())
    assert got == [rows[0], rows[2]]
    seen = m.labelled(df)
    assert [c for c in df.columns if c != "class_size"] == [c for c in seen.columns if c not in ("class_id", "class_size")]
    assert sorted((r.doc_id, r._key, r.text_key, r.class_key, r.class_id, r.class_size) for r in seen.collect()) == [(1, "k", "t", "c", 1, 2), (2, "k2", "t2", "c2", 1, 2), (3, "k3", "t3", "c3", 3, 1)]
