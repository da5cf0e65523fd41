"""The numbered queries over the given tables, and their SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, collisions, decontaminate, fingerprint, kneser_ney, language, minhash_dups, packing, passages, periodic, private_data, spelling, toxicity
from millrace.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def default_tokenizer() -> str:
    """Path of the tokenizer that the queries use, as installed on the driver; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def query(name: str, sql: str | None = None):
    def add(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            SQL[name] = sql.strip()
        return fn

    return add


@query("op1_packed_rows")
def op1(t: Tables) -> DataFrame:
    """Every document's ids in packed rows."""
    return packing.pack(t.documents, default_tokenizer())


@query("op2_bpe_chunks")
def op2(t: Tables) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    return bpe.digests(t.documents, default_tokenizer()).drop("n_bytes")


@query("op3_improbable_features")
def op3(t: Tables) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are."""
    rank = fingerprint.rarity(fingerprint.entropy_counts(t.documents))
    parts = 2 * int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    return fingerprint.with_edits(t.documents, rank, parts)


@query(
    "op4_spaced_seeds",
    """
    WITH doc AS (
        SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS w FROM documents
    ), item AS (
        SELECT DISTINCT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS w FROM benchmark
    ), mask(number, bits) AS (
        VALUES (0, [0, 1, 3, 4, 6]), (1, [0, 1, 2, 5, 7]), (2, [0, 2, 3, 7, 8])
    ), doc_at AS (SELECT doc_id, w, unnest(range(len(w) - 6)) AS p FROM doc WHERE len(w) >= 7),
    item_at AS (SELECT item_id, w, unnest(range(len(w) - 6)) AS p FROM item WHERE len(w) >= 7),
    doc_seed AS (SELECT DISTINCT doc_id, p, number, list_transform(bits, lambda b: w[p + b + 1]) AS seed FROM doc_at, mask WHERE p + bits[5] < len(w)),
    item_seed AS (SELECT DISTINCT item_id, p, number, list_transform(bits, lambda b: w[p + b + 1]) AS seed FROM item_at, mask WHERE p + bits[5] < len(w)),
    hit AS (SELECT DISTINCT doc_id, item_id, d.p - i.p AS shift FROM doc_seed d JOIN item_seed i USING (number, seed)),
    cell AS (
        SELECT h.doc_id, h.item_id, h.shift, len(i.w) AS n, j, CASE WHEN d.w[h.shift + j + 1] = i.w[j + 1] THEN 1 ELSE -1 END AS step
        FROM hit h JOIN doc d USING (doc_id) JOIN item i USING (item_id), LATERAL (SELECT unnest(range(len(i.w))) AS j)
        WHERE h.shift + j >= 0 AND h.shift + j < len(d.w)
    ), total AS (
        SELECT *, sum(step) OVER (PARTITION BY doc_id, item_id, shift ORDER BY j) AS s FROM cell
    ), best AS (
        SELECT doc_id, item_id, n, s - least(0, min(s) OVER (PARTITION BY doc_id, item_id, shift ORDER BY j)) AS score FROM total
    )
    SELECT doc_id, item_id, CAST(max(score) AS INTEGER) AS score FROM best
    WHERE score >= least(10, CAST(ceil(n / 2) AS INTEGER)) GROUP BY doc_id, item_id
    """,
)
def op4(t: Tables) -> DataFrame:
    """Documents that hold a benchmark item, with the best score of their overlap."""
    return decontaminate.contaminated(t.documents, t.benchmark)


@query("op5_private_spans")
def op5(t: Tables) -> DataFrame:
    """Personal data of every document."""
    return private_data.report(t.documents, private_data.fit(t.documents))


@query("op6_paragraph_bands")
def op6(t: Tables) -> DataFrame:
    """Passages that occur in several documents."""
    return passages.repeats(t.documents)


@query("op7_nnpu_toxicity")
def op7(t: Tables) -> DataFrame:
    """Toxicity of every document."""
    found = toxicity.score(t.documents, toxicity.fit(t.documents, t.labels))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query("op8_nearest_centroid")
def op8(t: Tables) -> DataFrame:
    """Language of every document."""
    found = language.predict(t.documents.select("doc_id", "text"), language.fit(t.documents))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), F.col("lang_rejected").alias("rejected"))


@query("op9_kneser_ney")
def op9(t: Tables) -> DataFrame:
    """Perplexity of every document under a model of the trusted ones, and whether it is kept."""
    return kneser_ney.assess(t.documents, t.labels.where("quality = 1"))


@query("op10_prob_minhash")
def op10(t: Tables) -> DataFrame:
    """Class of every document among near-duplicates."""
    return minhash_dups.labelled(t.documents.select("doc_id", "text")).select("doc_id", "class_id", "class_size")


@query("op11_periodic_runs")
def op11(t: Tables) -> DataFrame:
    """Periodic runs of words of every document, as digests; one document in ten has a periodic tail."""
    return periodic.digests(periodic.collapse(periodic.with_periodic_tail(t.documents)))


@query("op12_collision_counting")
def op12(t: Tables) -> DataFrame:
    """The five nearest other vectors of every vector whose id is divisible by 50."""
    return collisions.nearest(t.embeddings, F.col("vec_id") % 50 == 0)


@query("op13_permuterm_variants")
def op13(t: Tables) -> DataFrame:
    """Words of all documents, how many are near, and the more frequent forms that they vary."""
    return spelling.variants(t.documents)
