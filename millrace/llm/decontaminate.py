"""Benchmark decontamination by spaced seeds, in DataFrame functions only.

A mask such as 1101101 keeps some of the words under it and ignores the others, so that two passages share a
seed in spite of substituted words at the ignored places. Seeds of documents and benchmark items are joined;
a hit fixes how the two texts are aligned, and on that alignment the stretch with the best score (+1 for an
equal word, -1 for another) is taken. A document is contaminated by an item when that score is high enough.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.store import Stages
from millrace.operators.sizing import hint_small

MASKS = ("1101101", "11100101", "101100011")
SCORE = 10
BROADCAST_BYTES = 16 * 1024 * 1024


def words(text: Column) -> Column:
    """Lower-cased words between ASCII white space; null and blank texts have none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[ \t\n\x0B\f\r]+"), lambda w: w != "")


def seeds(df: DataFrame, masks: tuple[str, ...]) -> DataFrame:
    """df has `words`; its other columns, with (at, seed) for each mask at each place where it starts and at least the shortest fits.

    A mask that reaches beyond the end gives no seed there. Places are made inside one projection, so that the
    words are read where they are and are not copied for each place.
    """
    shortest = min(map(len, masks))
    placed = df.where(F.size("words") >= shortest).withColumn("at", F.explode(F.sequence(F.lit(0), F.size("words") - shortest)))

    def seed(number: int, mask: str) -> Column:
        value = F.xxhash64(F.lit(number), *[F.get("words", F.col("at") + i) for i, bit in enumerate(mask) if bit == "1"])
        return value if len(mask) == shortest else F.when(F.col("at") + len(mask) <= F.size("words"), value)

    keep = [c for c in df.columns if c != "words"]
    made = placed.select(*keep, "at", F.array(*[seed(i, m) for i, m in enumerate(masks)]).alias("made"))
    return made.select(*keep, "at", F.explode("made").alias("seed")).where(F.col("seed").isNotNull())


def aligned_score(doc: Column, item: Column, shift: Column) -> Column:
    """Best score of a stretch of `item` laid over `doc` from word `shift` on."""
    low = F.greatest(F.lit(0), -shift)
    length = F.least(F.size(item), F.size(doc) - shift) - low
    steps = F.zip_with(F.slice(doc, shift + low + 1, length), F.slice(item, low + 1, length), lambda x, y: F.when(x == y, F.lit(1)).otherwise(F.lit(-1)))
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("best"))

    def add(acc: Column, step: Column) -> Column:
        now = F.greatest(F.lit(0), acc["now"] + step)
        return F.struct(now.alias("now"), F.greatest(acc["best"], now).alias("best"))

    return F.when(length > 0, F.aggregate(steps, start, add, lambda acc: acc["best"])).otherwise(F.lit(0))


def matches(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS, score: int = SCORE) -> DataFrame:
    """(text_key, item_id, score): each distinct text of `docs` and each benchmark item that it holds.

    docs: text; benchmark: item_id, text; further columns are ignored. text_key is the MD5 of the text. The
    score to reach is `score`, or half the item's words if that is less. Items with fewer words than the
    shortest mask match nothing, nor do null, blank or shorter documents. Items that repeat an id count as one
    with the better score. Seeds that many documents share are joined to the benchmark's, of which there are
    few and which are distinct by seed, item and place. Either table may be empty.
    """
    stages = Stages(docs.sparkSession, "decontaminate")
    items = stages.keep(benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct().select("item_id", F.md5("text").alias("item"), words(F.col("text")).alias("words")), "items")
    item_seeds = seeds(items.select("item", "words").dropDuplicates(["item"]), masks).select("item", F.col("at").alias("item_at"), "seed")
    item_seeds = hint_small(stages.keep(item_seeds, "item-seeds"), BROADCAST_BYTES)
    keyed = docs.select(F.md5(F.coalesce("text", F.lit(""))).alias("text_key"), words(F.col("text")).alias("words"))
    hits = seeds(keyed, masks).join(item_seeds, "seed").select("text_key", "item", (F.col("at") - F.col("item_at")).alias("shift"))
    hits = stages.keep(hits.distinct(), "hits")
    laid = hits.join(hint_small(items.select("item_id", "item", F.col("words").alias("item_words")), BROADCAST_BYTES), "item")
    laid = hint_small(stages.keep(laid, "laid"), BROADCAST_BYTES)
    tested = keyed.join(laid, "text_key").select(
        "text_key", "item_id", F.size("item_words").alias("n"), aligned_score(F.col("words"), F.col("item_words"), F.col("shift")).alias("score")
    )
    passed = tested.where(F.col("score") >= F.least(F.lit(score), F.ceil(F.col("n") / 2).cast("int")))
    return passed.groupBy("text_key", "item_id").agg(F.max("score").alias("score"))


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """(doc_id, item_id, score) for each document and benchmark item that it holds; rows that repeat are one."""
    found = matches(docs, benchmark, **options)
    return docs.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("text_key")).join(found, "text_key").select("doc_id", "item_id", "score").distinct()


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of `docs` whose text holds no benchmark item, as they are (null and blank texts stay)."""
    spark = docs.sparkSession
    bad = Stages(spark, "decontaminate-bad").keep(matches(docs, benchmark, **options).select("text_key").distinct(), "bad")
    return docs.join(hint_small(bad, BROADCAST_BYTES), F.md5(F.coalesce(docs["text"], F.lit(""))) == bad["text_key"], "left_anti")
