"""Reports that go through files: each writes to a fresh scratch folder and reads it back."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import is_date_text, money, year2_date
from millrace.reports.common import fixed_lines, orders, total
from millrace.reports.registry import report
from millrace.sources import readers as R
from millrace.sources import writers as Wr
from millrace.storage import children, scratch_dir, touch
from millrace.sources.tables import Tables
from millrace.streaming import ledger
from millrace.streaming.ingest import ingest_incremental


@report("fixed_width_parse", """
SELECT 'good' AS outcome, CAST(o_custkey AS VARCHAR) AS imsi, strftime(o_orderdate, '%y%m%d') AS call_start_date, CAST(strptime('20' || strftime(o_orderdate, '%y%m%d'), '%Y%m%d') AS DATE) AS call_day,
  CAST(o_orderkey AS VARCHAR) AS caller_no, o_orderpriority AS dial_digit FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'bad', CAST(o_custkey AS VARCHAR), strftime(o_orderdate, '%y%m'), NULL, CAST(o_orderkey AS VARCHAR), o_orderpriority FROM orders WHERE o_orderstatus = 'O'
""")
def fixed_width_parse(t: Tables) -> DataFrame:
    """Fixed-width lines with header records to skip and short dates to reject."""
    path = scratch_dir(t.spark, "fixed")
    fixed_lines(t).write.text(path)
    parsed = R.read_fixed_width(t.spark, path)
    good, bad = Wr.split_valid(parsed, F.length("call_start_date") == 6)

    def shown(df: DataFrame, outcome: str) -> DataFrame:
        return df.select(F.lit(outcome).alias("outcome"), "imsi", "call_start_date", year2_date("call_start_date").alias("call_day"), "caller_no", "dial_digit")

    return shown(good, "good").unionByName(shown(bad, "bad"))


@report("line_key_parse", """
SELECT CAST(o_custkey % 251 AS INTEGER) AS k, count(*) AS cnt, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amt FROM orders GROUP BY 1
""")
def line_key_parse(t: Tables) -> DataFrame:
    """Raw lines keyed by character offset, then split with quotes removed."""
    k = F.lpad(F.pmod("o_custkey", F.lit(251)).cast("string"), 3, "0")
    line = F.concat(F.lit("10.000."), k, F.lit('|"'), F.col("o_orderkey"), F.lit('"|"'), money("o_totalprice").cast("string"), F.lit('"'))
    path = scratch_dir(t.spark, "lines")
    t.orders.select(line.alias("value")).write.text(path)
    rows = R.read_lines(t.spark, path, k=F.substring("value", 8, 3).cast("int"))
    parsed = R.parse_pipe(rows, "value", ["ip", "orderkey", "amt"])
    keyed = parsed.withColumn("k", F.substring("ip", 8, 3).cast("int"))
    return keyed.groupBy("k").agg(F.count(F.lit(1)).alias("cnt"), F.sum(F.col("amt").cast("decimal(18,2)")).cast("double").alias("amt"))


@report("delimited_roundtrip", """
SELECT src, o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders CROSS JOIN (VALUES ('pipe'), ('tab'), ('semi')) v(src)
""")
def delimited_roundtrip(t: Tables) -> DataFrame:
    """Pipe, tab and semicolon files, with and without header and schema, read by glob and brace set."""
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    root = scratch_dir(t.spark, "delimited")
    Wr.write_csv(rows, f"{root}/pipe/a", sep="|", mode="overwrite")
    Wr.unload(rows.withColumn("o_orderstatus", F.concat(F.lit(" "), "o_orderstatus", F.lit(" "))), f"{root}/tab", sep="\t", trim="both")
    Wr.export_report(rows, f"{root}/semi/x1", sep=";", files=None)
    schema = "o_orderkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"
    pipe = R.read_delimited(t.spark, f"{root}/pipe/*/*.gz", schema)
    tab = R.read_delimited(t.spark, f"{root}/tab", schema, sep="\t")
    semi = R.read_delimited(t.spark, root + "/semi/{x1,x2}", schema, sep=";", header=True)
    parts = {"pipe": pipe, "tab": tab, "semi": semi}
    first, *rest = [df.withColumn("src", F.lit(n)) for n, df in parts.items()]
    for df in rest:
        first = first.unionByName(df)
    return first


@report("positional_read", "SELECT CAST(c_custkey AS VARCHAR) AS _c0, c_name AS _c1, c_mktsegment AS _c2 FROM customer")
def positional_read(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "positional")
    Wr.write_csv(t.customer.select("c_custkey", "c_name", "c_mktsegment"), path, mode="overwrite")
    return R.read_positional(t.spark, path)


@report("dated_unload", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, strftime(o_orderdate, '%Y%m%d') AS on_date, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS at, replace('a,b,' || o_orderstatus, ',', '|') AS remark FROM orders
""")
def dated_unload(t: Tables) -> DataFrame:
    """Unload with fixed date formats; commas inside the remark become pipes."""
    rows = t.orders.select(
        "o_orderkey", F.to_date("o_orderdate").alias("on_date"), F.col("o_orderdate").alias("at"),
        F.translate(F.concat(F.lit("a,b,"), "o_orderstatus"), ",", "|").alias("remark"),
    )
    path = scratch_dir(t.spark, "unload")
    Wr.unload(rows, path, trim="right", date_format="yyyyMMdd", timestamp_format="yyyy-MM-dd HH:mm:ss", header=True)
    return R.read_delimited(t.spark, path, sep=",", header=True, inferSchema=False)


@report("json_parquet_roundtrip", """
SELECT 'json' AS src, o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders UNION ALL SELECT 'parquet', o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
""")
def json_parquet_roundtrip(t: Tables) -> DataFrame:
    """Nested JSON with an inferred schema, and Parquet with a codec and a block size."""
    nested = t.orders.select("o_orderkey", F.struct("o_custkey", F.struct("o_orderstatus", "o_totalprice").alias("d")).alias("c"))
    root = scratch_dir(t.spark, "nested")
    nested.write.json(f"{root}/json")
    Wr.write_parquet(nested, f"{root}/parquet", block_mb=100)
    found = {"json": R.read_json(t.spark, f"{root}/json"), "parquet": R.read_parquet(t.spark, f"{root}/parquet", nested.schema)}
    flat = [
        df.select(F.lit(n).alias("src"), "o_orderkey", "c.o_custkey", "c.d.o_orderstatus", "c.d.o_totalprice") for n, df in found.items()
    ]
    return flat[0].unionByName(flat[1])


@report("partitioned_write", """
SELECT strftime(o_orderdate, '%Y') AS yr, CAST(o_custkey % 4 AS VARCHAR) AS pkey, count(*) AS cnt, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amt
FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01' GROUP BY 1, 2
""")
def partitioned_write(t: Tables) -> DataFrame:
    """Appended in two steps by year and bucket, old years dropped, read as a view."""
    rows = t.orders.select(
        "o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyy").alias("yr"), F.pmod("o_custkey", F.lit(4)).cast("int").alias("pkey"), "o_orderstatus"
    )
    root = scratch_dir(t.spark, "partitioned")
    for part in (F.col("o_orderstatus") == "F", F.col("o_orderstatus") != "F"):
        Wr.write_partitioned(rows.where(part), root, ["yr", "pkey"], sort=["o_orderkey"], codec="gzip")
    Wr.drop_folders_before(t.spark, root, "yr", "2000")
    seen = R.read_partitioned(t.spark, root)
    return seen.groupBy("yr", "pkey").agg(F.count(F.lit(1)).alias("cnt"), total("o_totalprice").alias("amt"))


@report("catalog_partitions", """
SELECT o_orderstatus AS st, count(*) AS cnt FROM orders WHERE o_orderstatus IN ('O', 'P') GROUP BY 1
""")
def catalog_partitions(t: Tables) -> DataFrame:
    """Folders registered as partitions of a catalog table; the older one is dropped again."""
    root = scratch_dir(t.spark, "catalog")
    name = "millrace_" + root.rsplit("-", 1)[1]
    t.orders.select("o_orderkey", F.col("o_orderstatus").alias("st")).write.partitionBy("st").parquet(root + "/data")
    t.spark.sql(f"CREATE TABLE {name} (o_orderkey BIGINT, st STRING) USING parquet PARTITIONED BY (st) LOCATION '{root}/table'")
    for st in ("F", "O", "P"):
        Wr.add_partition(t.spark, name, {"st": st}, f"{root}/data/st={st}")
        Wr.add_partition(t.spark, name, {"st": st}, f"{root}/data/st={st}")
    Wr.drop_partitions_before(t.spark, name, "st", "O")
    return t.spark.table(name).groupBy("st").agg(F.count(F.lit(1)).alias("cnt"))


@report("resplit_text", "SELECT count(*) AS cnt, CAST(4 AS BIGINT) AS files FROM orders")
def resplit_text(t: Tables) -> DataFrame:
    """Text that cannot be split, in one file, rewritten as four."""
    root = scratch_dir(t.spark, "resplit")
    t.orders.select(F.col("o_orderkey").cast("string")).coalesce(1).write.option("compression", "gzip").text(f"{root}/one")
    Wr.resplit(t.spark, f"{root}/one", 4, f"{root}/four")
    rows = t.spark.read.text(f"{root}/four").select("value", F.col("_metadata.file_name").alias("f"))
    return rows.agg(F.count(F.lit(1)).alias("cnt"), F.count_distinct("f").alias("files"))


@report("file_name_attrs", """
SELECT strftime(ts, '%Y%m%d') AS trx_date, event_type AS event_id, count(*) AS cnt, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS amt
FROM events GROUP BY 1, 2
""")
def file_name_attrs(t: Tables) -> DataFrame:
    """Files named by date and event, with a header line, rolled by row count; attributes come from the name."""
    root = scratch_dir(t.spark, "named")
    rows = t.events.select("event_id", "value", F.date_format("ts", "yyyyMMdd").alias("d"), F.col("event_type").alias("e"))
    rows.repartition("d").write.partitionBy("d", "e").option("maxRecordsPerFile", 50).options(header=True).csv(f"{root}/in")
    flat = t.spark.read.options(header=True, recursiveFileLookup=True).schema("event_id bigint, value double").csv(f"{root}/in")
    seen = flat.select("value", F.regexp_replace("_metadata.file_path", "^.*/d=([0-9]+)/e=([a-z]+)/part-([^/]*)$", "A$1_x_$2:$3").alias("name"))
    named = seen.select(
        "value", F.regexp_extract("name", R.TRACE_NAME, 1).alias("trx_date"), F.regexp_extract("name", R.TRACE_NAME, 2).alias("event_id")
    )
    return named.groupBy("trx_date", "event_id").agg(F.count(F.lit(1)).alias("cnt"), total("value").alias("amt"))


@report("refresh_window", """
SELECT strftime(o_orderdate, '%Y%m') AS mth, count(*) AS cnt, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amt FROM orders
WHERE strftime(o_orderdate, '%Y%m') <> '199803' GROUP BY 1
""")
def refresh_window(t: Tables) -> DataFrame:
    """One month recomputed twice and another emptied; all else is as before."""
    rows = t.orders.select("o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyyMM").alias("mth"))
    root = scratch_dir(t.spark, "refresh")
    rows.repartition("mth").write.partitionBy("mth").parquet(root)
    for _ in range(2):
        Wr.refresh_window(t.spark, rows.where("mth = '199802'"), root, "mth", ["199802", "199803"])
    Wr.mark_complete(t.spark, root, "_run")
    assert "_run.complete" in children(t.spark, root)
    return R.read_partitioned(t.spark, root).groupBy("mth").agg(F.count(F.lit(1)).alias("cnt"), total("o_totalprice").alias("amt"))


@report("stage_reload", "SELECT o_orderstatus, count(*) AS cnt FROM orders GROUP BY 1")
def stage_reload(t: Tables) -> DataFrame:
    """A stage written twice holds the last run only."""
    path = scratch_dir(t.spark, "stage")
    Wr.stage(t.orders.select("o_orderstatus").where("o_orderstatus = 'F'"), path)
    staged = t.put("order_stage", Wr.stage(t.orders.select("o_orderstatus"), path))
    t.register("order_stage")
    assert staged.sparkSession is t.spark
    return t.spark.sql("select o_orderstatus, count(*) as cnt from order_stage group by o_orderstatus")


@report("incremental_ingest", """
SELECT event_type, count(*) AS cnt, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS amt FROM events GROUP BY 1
""")
def incremental_ingest(t: Tables) -> DataFrame:
    """Files dropped in two rounds, a few per batch; each is read once, also when nothing is new."""
    root = scratch_dir(t.spark, "ingest")
    rows = t.events.select("event_id", "value", "event_type")
    for half in (F.col("value") <= 20, F.col("value") > 20):
        Wr.write_csv(rows.where(half).repartition(3), f"{root}/in", sep="|")
        for _ in range(2):
            ingest_incremental(
                t.spark, f"{root}/in", f"{root}/out", "event_id bigint, value double, event_type string", f"{root}/state",
                max_files=2, options={"sep": "|"}, partition_by=["event_type"],
            )
    return t.spark.read.parquet(f"{root}/out").groupBy("event_type").agg(F.count(F.lit(1)).alias("cnt"), total("value").alias("amt"))


@report("write_reconciled", """
SELECT count(*) AS part_cnt, count(*) AS whole_cnt, 'Y' AS balanced FROM orders
""")
def write_reconciled(t: Tables) -> DataFrame:
    """Rows of accepted and rejected files against the rows of the source."""
    from millrace.operators import reconcile

    root = scratch_dir(t.spark, "reconcile")
    text = orders(t).withColumn("d", F.when(F.col("o_orderstatus") == "P", F.lit("bad")).otherwise(F.col("o_orderdate").cast("string")))
    good, bad = Wr.split_valid(text.select("o_orderkey", "d"), is_date_text("d") | (F.substring("d", 1, 2) == "19"))
    Wr.write_csv(good, f"{root}/good", mode="overwrite")
    Wr.write_csv(bad, f"{root}/bad", mode="overwrite")
    touch(t.spark, f"{root}/reconcile.complete")
    schema = "o_orderkey bigint, d string"
    parts = {n: R.read_delimited(t.spark, f"{root}/{n}", schema, sep=",") for n in ("good", "bad")}
    return reconcile(parts, t.orders)


@report("ordered_export", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS d, replace('x,' || o_orderpriority, ',', '|') AS remark, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS line FROM orders
""")
def ordered_export(t: Tables) -> DataFrame:
    """A report in order of date as numbered files, read back by file name and place in the file."""
    root = scratch_dir(t.spark, "ordered")
    rows = orders(t).select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"), F.concat(F.lit("x,"), "o_orderpriority").alias("remark"))
    Wr.export_ordered(rows, root, ["d", "o_orderkey"], remark=["remark"])
    text = t.spark.read.text(root).select("value", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("nth"))
    body = text.where("file > '000000.csv'")
    sizes = body.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("file", F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))  # a row a file
    placed = body.withColumn("in_file", F.row_number().over(Window.partitionBy("file").orderBy("at", "nth"))).join(before, "file")
    parts = F.split("value", ",")
    return placed.select(parts[0].cast("bigint").alias("o_orderkey"), parts[1].alias("d"), parts[2].alias("remark"), (F.col("before") + F.col("in_file")).cast("bigint").alias("line"))


@report("checked_ingest", """
WITH e AS (SELECT event_type, value, CASE WHEN value > 20 THEN 'accepted' ELSE 'rejected' END AS outcome FROM events)
SELECT outcome, event_type, count(*) AS cnt, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS amt FROM e GROUP BY 1, 2
UNION ALL SELECT 'ledger_' || outcome, NULL, count(*), NULL FROM e GROUP BY 1
UNION ALL SELECT 'ledger_read', NULL, count(*), NULL FROM e
""")
def checked_ingest(t: Tables) -> DataFrame:
    """Files taken in two rounds, rows accepted or rejected, against the account of the batches."""
    root = scratch_dir(t.spark, "checked")
    rows = t.events.select("event_id", "value", "event_type")
    schema = "event_id bigint, value double, event_type string"
    for half in (F.col("event_id") % 2 == 0, F.col("event_id") % 2 == 1):
        Wr.write_csv(rows.where(half).repartition(3), f"{root}/in", sep="|")
        for _ in range(2):
            ledger.ingest_checked(t.spark, f"{root}/in", f"{root}/out", schema, lambda df: F.col("value") > 20, max_files=2, options={"sep": "|"})
    kinds = [ledger.loaded(t.spark, f"{root}/out", schema, k).withColumn("outcome", F.lit(k)) for k in ("accepted", "rejected")]
    found = kinds[0].unionByName(kinds[1]).groupBy("outcome", "event_type").agg(F.count(F.lit(1)).alias("cnt"), total("value").alias("amt"))
    kept = ledger.ledger(t.spark, f"{root}/out").agg(*[F.sum(f"{k}_cnt").alias(k) for k in ("accepted", "rejected", "read")])
    pairs = F.explode(F.array(*[F.struct(F.lit(f"ledger_{k}").alias("outcome"), F.col(k).alias("cnt")) for k in ("accepted", "rejected", "read")]))
    account = kept.select(pairs.alias("p")).select("p.outcome", F.lit(None).cast("string").alias("event_type"), "p.cnt", F.lit(None).cast("double").alias("amt"))
    return found.unionByName(account)
