"""Record feeds: firewall, call-forward and trace records, and key lookups over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.functions import ip_long, is_date_text, nth_segment, octet_bucket, row_key
from millrace.sources import readers as R
from millrace.sources import writers as Wr
from millrace.sources.placement import ROWS_PER_TASK, place


def firewall_keyed(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Raw pipe lines to keyed rows; rows without a valid date go to the second frame, as JSON."""
    rows = R.parse_pipe(lines, "value", R.FIREWALL_RAW)
    rows = rows.withColumn("row_key", row_key("src", "start_datetime", "dst"))
    good, bad = Wr.split_valid(rows, is_date_text(F.substring("start_datetime", 1, 10)))
    packed = R.json_struct(send_volume="send_volume", receive_volume="receive_volume", service="service", dst="dst")
    return good.select(*R.FIREWALL_KEYED), bad.select("row_key", "start_datetime", "src", packed.alias("json_value"))


def firewall_columns(rows: DataFrame) -> DataFrame:
    """Loader rows of either feed version to the partitioned table's columns."""
    if "add" in rows.columns:
        rows = rows.select(
            "ts", "srcip", "dstip", nth_segment("add", "-", 1).alias("send_vol"), nth_segment("add", "-", 2).alias("recv_vol"), nth_segment("add", "-", -1).alias("srv")
        )
    else:
        rows = rows.select(
            F.col("start_datetime").alias("ts"), F.col("src").alias("srcip"), F.col("dst").alias("dstip"),
            F.col("send_volume").alias("send_vol"), F.col("receive_volume").alias("recv_vol"), F.col("service").alias("srv"),
        )
    third = octet_bucket("srcip", 3)
    return rows.select(
        F.translate(F.substring("ts", 1, 10), "-", "").alias("trx_date"), third.alias("pkey"), third.alias("srcip_3rd"),
        ip_long("srcip").alias("srcip_num"), "ts", "srcip", "dstip", "send_vol", "recv_vol", "srv",
    )


def _load(good: DataFrame, rejected: DataFrame, dst: str, bad: str, by: list[str], sort: list[str], rows_per_task: int, fmt: str = "parquet", **options) -> dict[str, int]:
    """Write both kinds of rows and return how many of each there were, as counted while they were written."""
    counts = {name: Observation(name) for name in ("accepted", "rejected")}
    placed = place(good, by, rows_per_task, sort).observe(counts["accepted"], F.count(F.lit(1)).alias("n"))
    placed.write.mode("append").partitionBy(*by).options(**options).format(fmt).save(dst)
    refused = rejected.observe(counts["rejected"], F.count(F.lit(1)).alias("n"))
    refused.write.mode("append").options(sep="|", compression="gzip").csv(bad)
    return {name: c.get["n"] for name, c in counts.items()}


def load_firewall(spark: SparkSession, src: str, dst: str, bad: str, rows_per_task: int = ROWS_PER_TASK) -> dict[str, int]:
    """Raw files to the partitioned table; each address range is sorted inside its files. Rejected rows go to `bad`.

    Returns the numbers of accepted and rejected rows. A large partition is spread over tasks, see `place`.
    """
    good, rejected = firewall_keyed(R.read_lines(spark, src))
    return _load(firewall_columns(good), rejected, dst, bad, ["trx_date", "pkey"], ["srcip_num"], rows_per_task, compression="zstd")


def lookup_ip(table: DataFrame, ip: str, first_date: str | None = None, last_date: str | None = None) -> DataFrame:
    """Rows of one source address: the partition of its third part is read, and of that the matching blocks."""
    parts = ip.split(".")
    number = int("".join(p.rjust(3, "0") for p in parts))
    rows = table.where((F.col("pkey") == parts[2]) & (F.col("srcip_num") == number))
    if first_date:
        rows = rows.where(F.col("trx_date") >= first_date)
    if last_date:
        rows = rows.where(F.col("trx_date") <= last_date)
    return rows


# The fields kept of a call-forward record.
FORWARD_KEPT = ["record_type", "imsi", "dial_digit", "call_start_date", "call_start_time", "duration", "forward_no", "caller_no", "msisdn"]


def forward_records(lines: DataFrame, legacy: bool = False) -> tuple[DataFrame, DataFrame]:
    """Fixed-width lines to records with a date partition; others to the second frame."""
    rows = R.parse_fixed(lines, R.FORWARD_WIDTHS, legacy=legacy)
    good, bad = Wr.split_valid(rows, F.length("call_start_date") == 6)
    return good.select(*FORWARD_KEPT, F.concat(F.lit("20"), "call_start_date").alias("part_key")), bad.select(*FORWARD_KEPT)


def load_forward(
    spark: SparkSession, src: str, dst: str, bad: str, max_rows_per_file: int = 200_000_000, rows_per_task: int = ROWS_PER_TASK, legacy: bool = False
) -> dict[str, int]:
    """Fixed-width files to pipe-separated files by date, rolled after a number of rows; returns the two counts."""
    good, rejected = forward_records(R.read_lines(spark, src), legacy)
    kept = {"sep": "|", "compression": "gzip", "maxRecordsPerFile": max_rows_per_file}
    return _load(good, rejected, dst, bad, ["part_key"], [], rows_per_task, "csv", **kept)


def trace_records(spark: SparkSession, src: str, sep: str = ",") -> DataFrame:
    """Trace files with a header line; date and event come from the file name."""
    rows = R.read_delimited(spark, src, sep=sep, header=True)
    return R.with_file_attrs(rows, R.TRACE_NAME, ["trx_date", "event_id"])


def load_trace(spark: SparkSession, src: str, dst: str, bad: str, rows_per_task: int = ROWS_PER_TASK) -> dict[str, int]:
    """Trace files to the table by date and event; rows of files whose name gives neither are rejected."""
    good, rejected = Wr.split_valid(trace_records(spark, src), (F.col("trx_date") != "") & (F.col("event_id") != ""))
    return _load(good, rejected, dst, bad, ["trx_date", "event_id"], [], rows_per_task, compression="zstd")
