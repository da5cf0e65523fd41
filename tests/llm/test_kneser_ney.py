"""Perplexity over all code points: plain Python beside it, and texts that a folded alphabet cannot tell apart."""

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.llm import kneser_ney as kn
from millrace.llm.perplexity import discounts


def definition(texts, order):
    """Perplexity of a text, straight from the definition over code points."""
    points = lambda t: [-1] * (order - 1) + [ord(c) for c in t]
    counts = {order: Counter(tuple(s[i : i + order]) for t in texts for s in [points(t)] for i in range(len(t)))}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    cut = {k: discounts(*[sum(c == n for c in counts[k].values()) for n in (1, 2, 3, 4)]) for k in counts}
    total, kept = defaultdict(int), defaultdict(float)
    for k in counts:
        for g, c in counts[k].items():
            total[g[:-1], k] += c
            kept[g[:-1], k] += cut[k][min(c, 3) - 1]

    def p(g):
        if not g:
            return 1 / 0x110000
        k, context = len(g), g[:-1]
        if not total[context, k]:
            return p(g[1:])
        c = counts[k][g]
        return ((c - cut[k][min(c, 3) - 1] if c else 0) + kept[context, k] * p(g[1:])) / total[context, k]

    return lambda t: math.exp(-sum(math.log(p(tuple(s[i : i + order]))) for s in [points(t)] for i in range(len(t))) / len(t))


@pytest.mark.parametrize("order", [1, 3, 4, 6])
def test_equals_the_definition_over_code_points(frame, words, order):
    rows = [(i, " ".join(words(30, i)) + (". Ok!\n\x00" if i % 2 else " 日本語 \U0001f600 été"), "en", "s", 0) for i in range(24)]
    rows += [(100, "ZZZ!! %% QQ", "en", "s", 0), (101, "été 1999 \U0010ffff", "fr", "s", 0), (102, "", "en", "s", 0), (103, None, None, "s", 0), (104, "本日 語\U0001f601", "ja", "s", 0)]
    docs = frame(rows).repartition(5, "doc_id")
    value = definition([t for i, t, *_ in rows if i < 20], order)
    got = {r.doc_id: r for r in kn.assess(docs, docs.where("doc_id < 20").select("doc_id"), order=order).collect()}
    assert len(got) == len(rows)
    for i, t, *_ in rows:
        assert got[i].perplexity == pytest.approx(value(t), rel=1e-4) if t else got[i].perplexity is None and not got[i].keep


def test_no_two_characters_are_one(spark, tmp_path):
    """Capitals, digits and letters of other scripts are told apart by the query itself; a folded alphabet gives them one value."""
    from millrace.llm.queries import QUERIES

    clean = ["ABCABCABC 123123 日本日本 " * 5] * 40
    odd = ["CBBACAACB 331211 本本日日 " * 5, "DEFDEFDEF 456456 日本日本 ".replace("日", chr(0x65E5 + 23)) * 5]
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(clean + odd)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1 if i < 40 else 0) for i in range(42)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id: r for r in QUERIES["op9_kneser_ney"](spark, str(tmp_path)).collect()}
    assert all(got[i].keep for i in range(40)) and not got[40].keep and not got[41].keep
    assert min(got[40].perplexity, got[41].perplexity) > 3 * got[0].perplexity


def test_takes_anything(oddities, nothing):
    none = oddities.limit(0).select("doc_id")
    for ids in (none, oddities.select("doc_id")):
        assert kn.assess(oddities, ids).count() == oddities.count()
    assert kn.assess(nothing, none).count() == 0
    wide = kn.scored(oddities.withColumn("block", F.lit("b")), none.withColumnRenamed("doc_id", "trusted_id"))
    assert wide.count() == oddities.count() and {r.block for r in wide.collect()} == {"b"}


def test_sums_of_a_task_are_the_same_however_often_it_sums(spark, frame, words):
    docs = frame([(i, " ".join(words(20, i)), "en", "s", 0) for i in range(30)]).coalesce(1).select("doc_id", "text", F.lit(True).alias("trusted"), F.lit(0).alias("block"))
    want = sorted(map(tuple, kn.block_grams(docs, 4).collect()))
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, 2)  # fifteen slices
    try:
        assert sorted(map(tuple, kn.block_grams(docs, 4, most=1).collect())) == want
    finally:
        spark.conf.set(name, before)
