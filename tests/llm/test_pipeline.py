import re
import tracemalloc

import corpus_pipeline
import numpy as np
import pyarrow as pa
from millrace.llm import bpe, language
from millrace.llm import text as tx
from millrace.llm.queries import default_tokenizer
from pyspark.sql import functions as F


def test_stages_and_rows(spark, sf_dir):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontaminate", "private_data", "encode"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = corpus_pipeline.run(spark, sf_dir)
    rows = out.collect()
    ids = {r.doc_id for r in docs.collect()}
    assert {r.doc_id for r in rows} <= ids and len(rows) >= 0.7 * len(ids)
    assert all(r.n_tokens == len(r.ids) for r in rows)
    text = {r.doc_id: r.h for r in docs.select("doc_id", F.sha2("text", 256).alias("h")).collect()}
    assert sum(text[r.doc_id] == r.decoded_sha256 for r in rows) >= 0.7 * len(rows)


def test_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0


def test_no_task_holds_two_python_workers(spark, sf_dir):
    """Workers are kept with their memory: a stage that evaluates Python twice has two for each of its tasks."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        plan = stage(spark, docs, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"MapInArrow|ArrowEvalPython|FlatMapGroupsInArrow", plan)) <= 1


def test_one_dense_copy_of_training_texts():
    texts = [f"{i} some words of text number {'x' * (i % 7)}" for i in range(300)] + [None, "", "12 !"]
    batch = pa.record_batch([pa.array(texts)], ["text"])
    tracemalloc.start()
    vectors, letters = language.training_vectors([batch], np.ones(language.DIMENSIONS))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert vectors.shape == (300, language.DIMENSIONS) and len(letters) == 300 and peak < 1.5 * vectors.nbytes
    rows, slots, counts, _ = language.ngram_vectors(batch.column("text"))
    dense = np.zeros((len(texts), language.DIMENSIONS), np.float32)
    dense[rows, slots] = language.weighted(rows, slots, counts, len(texts), np.ones(language.DIMENSIONS))
    dense = dense[:300]
    assert (vectors == dense[np.lexsort(dense[:, :64].T[::-1])]).all()


def test_released_workers_keep_no_powers():
    tx.powers(1 << 18)
    tx.release()
    assert len(tx._powers[0]) == 1 and tx.powers(3)[0][2] == (tx.BASE * tx.BASE) % (1 << 64)


def test_decoded_slice_by_slice(spark, monkeypatch):
    monkeypatch.setattr(bpe, "SLICE_IDS", 4)
    texts = [None, "", "Grüße an alle!", "a", "x" * 500, "", "end of it"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    path = default_tokenizer()
    encoded = bpe.encode(docs, path).withColumn("ids", F.when(F.col("doc_id") != 3, F.col("ids")))
    got = {r.doc_id: r.decoded for r in bpe.decode(encoded, path).collect()}
    assert got == {i: None if i == 3 else t or "" for i, t in enumerate(texts)}
