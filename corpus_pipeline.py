"""A corpus pipeline of five stages over `documents`: each works on all that the one before it kept.

1. language: rows whose language cannot be told are dropped.
2. near_duplicates: one row of each class of near-duplicates stays.
3. decontaminate: rows that hold a benchmark item are dropped.
4. private_data: personal data in the texts is replaced by its kind.
5. encode: texts become token ids; the rows carry the ids in place of the text, and a digest of what they decode to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, decontaminate, language, minhash_dups, private_data
from millrace.llm.queries import default_tokenizer
from millrace.llm.store import Stages


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.identified(docs)


def keep_one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_dups.deduplicated(docs)


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return private_data.redacted(docs, private_data.fit(docs))


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids, decoded_sha256 (of the text that the ids decode to).

    The ids are written before they are decoded: in one stage, a task would hold a Python worker for each of the two.
    """
    path = default_tokenizer()
    encoded = Stages(spark, "encode").keep(bpe.encode(docs, path).drop("text"), "ids")
    decoded = bpe.decode(encoded, path)
    return decoded.select("doc_id", "lang", "source", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language", keep_known_languages),
    ("near_duplicates", keep_one_of_each_class),
    ("decontaminate", drop_benchmark_copies),
    ("private_data", redact_personal_data),
    ("encode", encode_texts),
]

ORACLE_SQL = None  # learned centroids, signatures and trees have no SQL; tests/llm holds the stages against plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. What a stage returns is written to the shared folder and read by the next."""
    stages = Stages(spark, "corpus")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stages.keep(stage(spark, docs, sf_dir), name)
    return docs
