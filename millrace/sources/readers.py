"""Readers for delimited, fixed-width, JSON, Parquet and wide-column data."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.exprs import json_number, literal

Paths = str | Sequence[str]


def _strings(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Column names and widths of the record feeds.
FIREWALL_RAW = ["batchno", "send_volume", "receive_volume", "start_datetime", "service", "src", "dst"]
FIREWALL_KEYED = ["row_key", "start_datetime", "src", "send_volume", "receive_volume", "service", "dst"]
FIREWALL_LOADER = ["rowkey", "ts", "srcip", "dstip", "add"]
FORWARD_WIDTHS = [
    ("record_type", 2), ("imsi", 15), ("dial_digit", 24), ("remark0", 35), ("call_start_date", 6),
    ("call_start_time", 6), ("duration", 6), ("remark1", 62), ("forward_no", 18), ("caller_no", 18),
    ("remark2", 90), ("msisdn", 18),
]
USAGE_LOG = (
    "subr_num string, subr_url string, uload_size int, dnld_size int, call_dur int, charging_id string, "
    "accs_type_cd string, accs_point_name string, sgsn_ip_addr string, radio_accs_type_cd string, "
    "src_ip_addr string, imsi string, accs_date string, accs_time string, status string, user_agent string, "
    "statuscode string, imei string, dialleddigit string, domain string, content_type string, part_key int"
)
DOMAIN_REF = "domain string, media_category_name string, media_sub_category_name int, media_provider_name int"


def read_delimited(
    spark: SparkSession, paths: Paths, schema: T.StructType | str | Sequence[str] | None = None, sep: str = "|",
    header: bool = False, **options,
) -> DataFrame:
    """Separated text with a schema (names alone mean strings) or a header. Globs are allowed."""
    reader = spark.read.options(sep=sep, header=header, **options)
    if schema is not None:
        reader = reader.schema(schema if isinstance(schema, (str, T.StructType)) else _strings(schema))
    return reader.csv(paths)


def read_positional(spark: SparkSession, paths: Paths, sep: str = ",") -> DataFrame:
    """Columns named by place: _c0, _c1, ..."""
    return spark.read.csv(paths, sep=sep)


def read_parquet(spark: SparkSession, paths: Paths, schema: T.StructType | str | None = None) -> DataFrame:
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*paths)


def read_json(spark: SparkSession, paths: Paths, schema: T.StructType | str | None = None) -> DataFrame:
    """Nested JSON; give a schema for large data, as inference reads it all once more."""
    return (spark.read if schema is None else spark.read.schema(schema)).json(paths)


def read_lines(spark: SparkSession, paths: Paths, **keys: Column) -> DataFrame:
    """Raw lines with key columns computed from `value`."""
    lines = spark.read.text(paths)
    return lines.withColumns(keys) if keys else lines


def parse_fixed(lines: DataFrame, spec: Sequence[tuple[str, int]], skip_types: Sequence[str] = ("10", "90"), legacy: bool = False) -> DataFrame:
    """Cut `value` into trimmed fields by width, without header and trailer lines.

    `legacy` skips every line that begins with 0, 1 or 9, as an older loader did.
    """
    value = F.col("value")
    kind = F.substring(value, 1, 2)
    skip = F.substring(value, 1, 1).isin("0", "1", "9") if legacy else kind.isin(*skip_types)
    fields, at = [], 1
    for name, width in spec:
        fields.append(F.trim(F.substring(value, at, width)).alias(name))
        at += width
    return lines.where(~skip).select(*fields)


def read_fixed_width(
    spark: SparkSession, paths: Paths, spec: Sequence[tuple[str, int]] = FORWARD_WIDTHS,
    skip_types: Sequence[str] = ("10", "90"), legacy: bool = False,
) -> DataFrame:
    return parse_fixed(read_lines(spark, paths), spec, skip_types, legacy)


def parse_pipe(df: DataFrame, col: str, names: Sequence[str], sep: str = "|") -> DataFrame:
    """Quotes removed, then split into named fields; missing trailing fields are null."""
    parts = F.split(F.regexp_replace(F.col(col), '"', ""), literal(sep))
    return df.withColumn("_p", parts).select(*[F.get("_p", i).alias(n) for i, n in enumerate(names)])


def with_file_attrs(df: DataFrame, pattern: str, names: Sequence[str]) -> DataFrame:
    """Columns from the groups of a pattern on the file name of each row."""
    name = F.col("_metadata.file_name")
    return df.select("*", *[F.regexp_extract(name, pattern, i + 1).alias(n) for i, n in enumerate(names)])


# Date in characters 2-9 of the first part, event id in the third part up to a colon or a dot.
TRACE_NAME = r"^.([0-9]{8})[^_]*_[^_]*_([^:_.]*)"


def read_partitioned(spark: SparkSession, root: str, view: str | None = None, strings: bool = True) -> DataFrame:
    """A partitioned folder with its directory columns, optionally registered as a view.

    Directory values are read as text when `strings` is set, so that a date stays as written.
    """
    before = spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled")
    if strings:
        spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    try:
        df = spark.read.parquet(root)
    finally:
        spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", before)
    if view:
        df.createOrReplaceTempView(view)
    return df


def wide_column_view(dfs: Sequence[DataFrame], json_col: str = "json_value") -> DataFrame:
    """Key and column-family maps of several tables as one flat view."""

    def flat(df: DataFrame) -> DataFrame:
        cf = F.col("cf")
        return df.select(
            "row_key",
            F.try_element_at(cf, F.lit("src")).alias("src"),
            F.try_to_timestamp(F.try_element_at(cf, F.lit("start_datetime"))).alias("start_datetime"),
            json_number(F.try_element_at(cf, F.lit(json_col)), "send_volume").alias("send_volume"),
            json_number(F.try_element_at(cf, F.lit(json_col)), "receive_volume").alias("receive_volume"),
            F.try_element_at(cf, F.lit("service")).alias("service"),
            F.try_element_at(cf, F.lit("dst")).alias("dst"),
        )

    return reduce(DataFrame.unionByName, [flat(df) for df in dfs])


def key_lookup(df: DataFrame, key: str = "row_key", equal: str | None = None, low: str | None = None, high: str | None = None, prefix: str | None = None, **also: str) -> DataFrame:
    """Rows by key, key range or key prefix; plain comparisons, so they reach the file scan."""
    if equal is not None:
        df = df.where(F.col(key) == equal)
    if low is not None:
        df = df.where(F.col(key) >= low)
    if high is not None:
        df = df.where(F.col(key) <= high)
    if prefix is not None:
        df = df.where(F.col(key).startswith(prefix))
    for column, value in also.items():
        df = df.where(F.col(column) == value)
    return df


def json_struct(**columns: Column | str) -> Column:
    """Columns as JSON text."""
    return F.to_json(F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()]))


