"""Rows whose text matches none of a table of LIKE patterns, of any number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAM = 3
OPEN, CLOSE = "\u0002", "\u0003"


def _stretches(text: Column, k: int) -> Column:
    """Every stretch of k characters; a shorter text has itself."""
    return F.transform(F.sequence(F.lit(1), F.greatest(F.char_length(text) - (k - 1), F.lit(1))), lambda i: F.substring(text, i, F.lit(k)))


def _grams(text: Column) -> Column:
    """Distinct stretches of one to GRAM characters of a text."""
    return F.array_distinct(F.flatten(F.array(*[_stretches(text, k) for k in range(1, GRAM + 1)])))


def literal_grams(pattern: Column) -> Column:
    """Stretches of the literal parts of a LIKE pattern, with marks at its two ends: GRAM characters, or the whole of a shorter part.

    A backslash takes the next character literally. Parts of GRAM characters or more make the rest needless.
    """
    marked = F.concat(F.lit(OPEN), pattern, F.lit(CLOSE))
    found = F.regexp_extract_all(marked, F.lit(r"((?:\\[\s\S]|[^%_\\])+)"), F.lit(1))
    parts = F.transform(found, lambda p: F.regexp_replace(p, r"\\([\s\S])", "$1"))
    long = F.filter(parts, lambda p: F.char_length(p) >= GRAM)
    longest = F.array_max(F.transform(parts, lambda p: F.char_length(p)))
    return F.when(F.size(long) > 0, F.array_distinct(F.flatten(F.transform(long, lambda p: _stretches(p, GRAM))))).otherwise(F.array_distinct(F.filter(parts, lambda p: F.char_length(p) == longest)))


def matching(texts: DataFrame, patterns: DataFrame, text: str = "_text", pattern: str = "_pattern") -> DataFrame:
    """The distinct values of `text` that match one of the patterns or more; nulls match nothing.

    A pattern is looked up by the rarest stretch of its literal parts in an index of the stretches of the texts,
    and what is found is held against it. A pattern of wildcards alone asks for a length, or a least length.
    """
    every = texts.select(F.col(text).alias("_t")).where("_t is not null").distinct()
    asked = patterns.select(F.col(pattern).alias("_p")).where("_p is not null").distinct()
    bare = F.col("_p").rlike("^[%_]+$")
    size = F.char_length(F.translate("_p", "%", ""))
    lengths = asked.where(bare).select(size.alias("_size"), F.contains("_p", F.lit("%")).alias("_more"))
    exact = lengths.where("not _more").select("_size").distinct()
    least = lengths.where("_more").agg(F.min("_size").alias("_size")).scalar()
    sized = every.withColumn("_size", F.char_length("_t"))
    by_size = sized.join(exact, "_size", "left_semi").select("_t").unionByName(sized.where(F.col("_size") >= least).select("_t"))

    held = asked.where(~bare).select("_p", F.explode(literal_grams(F.col("_p"))).alias("_g"))
    index = every.select("_t", F.explode(_grams(F.concat(F.lit(OPEN), "_t", F.lit(CLOSE)))).alias("_g")).join(held.select("_g").distinct(), "_g", "left_semi")
    seen = index.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"))
    rarest = held.join(seen, "_g", "left").groupBy("_p").agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_g").alias("g"))).alias("_r"))
    tried = rarest.where("_r.n > 0").select("_p", F.col("_r.g").alias("_g"))
    by_part = index.join(tried, "_g").where(F.expr("_t like _p")).select("_t")
    return by_size.unionByName(by_part).distinct().withColumnRenamed("_t", text)


def drop_like(df: DataFrame, col: str, patterns: DataFrame, pattern: str = "pattern") -> DataFrame:
    """Rows whose text matches none of the LIKE patterns of a table; a null text stays, null patterns match nothing."""
    hit = matching(df.select(F.col(col).alias("_text")), patterns.select(F.col(pattern).alias("_pattern")))
    return df.join(hit, df[col] == hit["_text"], "left_anti")
