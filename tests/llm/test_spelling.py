import random
import re
import zlib
from collections import Counter

from millrace.llm import spelling as m
from millrace.llm.queries import QUERIES

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow_counts(docs, least=7):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = run.translate(LOW)
            h = zlib.crc32(f"{i}:{w}".encode())
            if i is not None and h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += len(w) >= least
    return {w: c for w, c in n.items() if c >= 2}


def slow_forms(n, letters, ratio=10):
    near = {}
    for w in n:
        edits = {w[:i] + w[i + 1 :] for i in range(len(w))} | {w[:i] + c + w[i + j :] for i in range(len(w) + 1) for c in letters for j in (0, 1)}
        near[w] = (edits & n.keys()) - {w}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= ratio * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def rows(df):
    return {tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect()}


def test_query_on_the_given_documents(spark, sf_dir):
    n = slow_counts([(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()])
    got = QUERIES["op13_permuterm_variants"](spark, sf_dir)
    assert got.count() == len(n) > 1000
    assert rows(got) == slow_forms(n, {c for w in n for c in w})


def test_small_alphabets_and_chains(spark):
    rnd = random.Random(4)
    n = {"".join(rnd.choice("abéÿ" if k % 2 else "ab") for _ in range(rnd.randint(1, 9))): 10 ** rnd.randint(0, 7) for k in range(500)}
    n |= {"q" * i: 10**i for i in range(1, 12)}
    got = m.forms(spark.createDataFrame(list(n.items()), "word string, n long"))
    assert rows(got) == slow_forms(n, set("abéÿq"))
    assert {r.root for r in got.where("word like 'qq%'").collect()} == {"q" * 11}


def test_ranges_go_on_over_batches(spark):
    words = [(a + b + "stem" + c, ord(a) * ord(c)) for a in "abcdefghijklmnopqrstuvwxyz" for b in "aeiou" for c in "xyzw"]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = rows(m.forms(spark.createDataFrame(words, "word string, n long"), 2))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == slow_forms(dict(words), set("abcdefghijklmnopqrstuvwxyz"), 2)


def test_words_and_edits(frame):
    docs = [(1, "Straße ÀÈÌÒÙÂÊ àèìòùâê x Abcdefg,abcdefg;ABCDEFG abcdef", "", "", 0), (2, None, "", "", 0), (None, "naïveté- naïveté_naïveté1 " * 40, "", "", 0), (3, "abcdefg " * 5000 + "z" * 4_000_000, "", "", 0), (3, "abcdefg " * 5000 + "z" * 4_000_000, "", "", 0)]
    docs += [(i, "sameword otherword", "", "", 0) for i in range(10, 400)]
    want = slow_counts([d[:2] for d in docs])
    got = {r.word: r.n for r in m.counted(frame(docs)).collect()}
    assert got == want and got["naïveté"] == 120 and any(len(w) == 7 and w in "sameword" or w != "sameword" and w.startswith("same") for w in got)


def test_anything_goes(oddities, nothing, spark):
    assert {r.word for r in m.variants(oddities.withColumnsRenamed({"key": "word", "seed": "n"})).collect()} == set()
    assert m.variants(nothing).count() == 0
    odd = spark.createDataFrame([("", 5), (None, 4), ("a\u0001b", 3), ("ab", 30), ("a", 2)], "word string, n long")
    got = {r.word: r for r in m.forms(odd).collect()}
    assert got["a"].form == "ab" and got[""].n_near == 0 and got["a\u0001b"].root == "a\u0001b"
