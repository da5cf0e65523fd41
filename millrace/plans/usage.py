"""Usage reports: by media category, for a list of lines, dwell and movement between cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators import dwell, join_eq, movement, pre_aggregate_join


def by_category(log: DataFrame, domains: DataFrame) -> DataFrame:
    """Volume and count per line, date and media category; summed per domain before the domain is looked up."""
    volume = log.select("subr_num", "accs_date", "domain", (F.col("uload_size").cast("bigint") + F.col("dnld_size")).alias("sum_vol"))
    by = ["subr_num", "accs_date", "media_category_name", "media_sub_category_name"]
    return pre_aggregate_join(volume, domains, ["domain"], by, ["sum_vol"])


def for_lines(log: DataFrame, lines: DataFrame, key: str = "subr_num") -> DataFrame:
    """Rows of the listed lines."""
    return join_eq(log, lines.select(key), key, "left_semi", small=True)


def cell_dwell(sightings: DataFrame, bin_: Column | None = None) -> DataFrame:
    """Stay of each subscriber per cell; times are seconds or timestamps and compared by value."""
    return dwell(_timed(sightings), "imsi", "time", "eci", bin_)


def cell_movement(sightings: DataFrame, bin_: Column | None = None) -> DataFrame:
    """Cells in order with the next cell and the time it was entered; at the end time `0` and no cell."""
    out = movement(_timed(sightings), "imsi", "time", "eci", bin_)
    return out.select(
        "imsi", "time", "eci", F.coalesce(F.col("timeout").cast("string"), F.lit("0")).alias("timeout"), F.coalesce("eci_out", F.lit("")).alias("eciout")
    )


def _timed(df: DataFrame) -> DataFrame:
    if dict(df.dtypes)["time"] == "string":
        df = df.withColumn("time", F.timestamp_micros((F.col("time").try_cast("decimal(20,6)") * 1000000).cast("bigint")))
    return df
