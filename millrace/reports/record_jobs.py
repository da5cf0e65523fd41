"""Record, usage, billing and audit plans on the driver's tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import money
from millrace.operators import constant_rows
from millrace.plans import audit, billing, records, usage
from millrace.reports.common import day, fixed_lines, orders
from millrace.reports.registry import report
from millrace.reports.warehouse import Warehouse, with_tables
from millrace.sources import writers as Wr
from millrace.sources.readers import read_partitioned
from millrace.storage import scratch_dir
from millrace.sources.tables import Tables

_IP = "'10.0.' || CAST((user_id * 7) % 200 AS VARCHAR) || '.' || CAST(user_id % 250 AS VARCHAR)"


def _firewall_lines(t: Tables, ranges: int = 200) -> DataFrame:
    """Events as raw firewall lines from a number of address ranges; those of one type carry a broken date."""
    u = F.col("user_id")
    ip = F.concat_ws(".", F.lit("10"), F.lit("0"), (u * 7 % ranges).cast("string"), (u % 250).cast("string"))
    ts = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    ts = F.when(F.col("event_type") == "error", F.concat(F.lit("19"), F.substring(ts, 3, 17))).otherwise(ts)
    volume = F.get_json_object("props", "$.k")
    fields = [F.col("event_id").cast("string"), volume, (F.col("event_id") % 9).cast("string"), ts, F.col("event_type"), ip, F.lit("192.0.2.1")]
    quoted = [F.concat(F.lit('"'), f, F.lit('"')) for f in fields]
    return t.events.select(F.concat_ws("|", *quoted).alias("value"))


_KEY = f"""lpad('10', 3, '0') || '.000.' || lpad(CAST((user_id * 7) % 200 AS VARCHAR), 3, '0') || '.' || lpad(CAST(user_id % 250 AS VARCHAR), 3, '0')"""


@report("firewall_records", f"""
SELECT 'good' AS outcome, {_KEY} || '_' || strftime(ts, '%Y%m%d%H%M%S') || '_192.0.2.1' AS row_key, strftime(ts, '%Y-%m-%d %H:%M:%S') AS start_datetime, {_IP} AS src, json_extract_string(props, '$.k') AS extra FROM events WHERE event_type <> 'error'
UNION ALL SELECT 'bad', {_KEY} || '_' || '19' || strftime(ts, '%y%m%d%H%M%S') || '_192.0.2.1', '19' || strftime(ts, '%y-%m-%d %H:%M:%S'), {_IP},
  '{{"send_volume":"' || json_extract_string(props, '$.k') || '","receive_volume":"' || CAST(event_id % 9 AS VARCHAR) || '","service":"error","dst":"192.0.2.1"}}' FROM events WHERE event_type = 'error'
""")
def firewall_records(t: Tables) -> DataFrame:
    """Raw lines to keyed records, and those with a broken date as JSON."""
    good, bad = records.firewall_keyed(_firewall_lines(t))
    a = good.select(F.lit("good").alias("outcome"), "row_key", "start_datetime", "src", F.col("send_volume").alias("extra"))
    return a.unionByName(bad.select(F.lit("bad").alias("outcome"), "row_key", "start_datetime", "src", F.col("json_value").alias("extra")))


@report("firewall_load", f"""
SELECT strftime(ts, '%Y%m%d') AS trx_date, CAST((user_id * 7) % 200 AS VARCHAR) AS pkey, count(*) AS cnt, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS vol,
  min(10000000000 + ((user_id * 7) % 200) * 1000 + user_id % 250) AS lo_ip
FROM events WHERE event_type <> 'error' AND {_IP} = '10.0.49.7' AND strftime(ts, '%Y%m%d') BETWEEN '20240105' AND '20240125' GROUP BY 1, 2
""")
def firewall_load(t: Tables) -> DataFrame:
    """Records loaded to the partitioned table, then one address looked up over some days."""
    root = scratch_dir(t.spark, "firewall")
    good, _ = records.firewall_keyed(_firewall_lines(t))
    rows = records.firewall_columns(good)
    Wr.write_partitioned(rows.withColumn("pkey", F.col("pkey").cast("string")), root, ["pkey"], sort=["srcip_num"])
    table = read_partitioned(t.spark, root, "firewall_view")
    found = records.lookup_ip(table, "10.0.49.7", "20240105", "20240125")
    return found.groupBy("trx_date", "pkey").agg(F.count(F.lit(1)).alias("cnt"), F.sum(F.col("send_vol").cast("bigint")).alias("vol"), F.min("srcip_num").alias("lo_ip"))


@report("firewall_load_job", """
SELECT 'accepted' AS outcome, strftime(ts, '%Y%m%d') AS trx_date, CAST((user_id * 7) % 4 AS VARCHAR) AS pkey, count(*) AS cnt, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS vol FROM events WHERE event_type <> 'error' GROUP BY 2, 3
UNION ALL SELECT 'rejected', NULL, NULL, count(*), NULL FROM events WHERE event_type = 'error'
UNION ALL SELECT 'counted_' || CASE WHEN event_type = 'error' THEN 'rejected' ELSE 'accepted' END, NULL, NULL, count(*), NULL FROM events GROUP BY 1
""")
def firewall_load_job(t: Tables) -> DataFrame:
    """Raw files loaded to the table by date and address range; what is in the table, in the rejects, and what the job counted."""
    root = scratch_dir(t.spark, "firewall-job")
    _firewall_lines(t, 4).write.text(f"{root}/in")
    counts = records.load_firewall(t.spark, f"{root}/in", f"{root}/table", f"{root}/bad", rows_per_task=LOAD_ROWS)
    table = read_partitioned(t.spark, f"{root}/table")
    kept = table.groupBy("trx_date", "pkey").agg(F.count(F.lit(1)).alias("cnt"), F.sum(F.col("send_vol").cast("bigint")).alias("vol"))
    none = F.lit(None).cast("string")
    refused = t.spark.read.text(f"{root}/bad").agg(F.count(F.lit(1)).alias("cnt"))
    extra = refused.select(F.lit("rejected").alias("outcome"), none.alias("trx_date"), none.alias("pkey"), "cnt", F.lit(None).cast("bigint").alias("vol"))
    return kept.select(F.lit("accepted").alias("outcome"), "trx_date", "pkey", "cnt", "vol").unionByName(extra).unionByName(_counted(t, counts, ["trx_date", "pkey"], ["vol"]))


LOAD_ROWS = 20_000


def _counted(t: Tables, counts: dict[str, int], texts: list[str], numbers: list[str]) -> DataFrame:
    """What a load counted, one row for each outcome with rows."""
    rows = constant_rows(t.spark, [(f"counted_{k}", n) for k, n in counts.items()], "outcome string, cnt bigint").where("cnt > 0")
    return rows.withColumns({**{c: F.lit(None).cast("string") for c in texts}, **{c: F.lit(None).cast("bigint") for c in numbers}})


@report("forward_load_job", """
SELECT 'accepted' AS outcome, '20' || strftime(o_orderdate, '%y%m') || '01' AS part_key, count(*) AS cnt, CAST(sum(o_orderkey) AS BIGINT) AS total FROM orders WHERE o_orderstatus = 'F' GROUP BY 2
UNION ALL SELECT 'rejected', NULL, count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT CASE o_orderstatus WHEN 'F' THEN 'counted_accepted' ELSE 'counted_rejected' END, NULL, count(*), NULL FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1
""")
def forward_load_job(t: Tables) -> DataFrame:
    """Fixed-width files loaded by date, rolled by row count; header lines are skipped, short dates rejected."""
    root = scratch_dir(t.spark, "forward-job")
    fixed_lines(t, "'01'").write.text(f"{root}/in")
    counts = records.load_forward(t.spark, f"{root}/in", f"{root}/table", f"{root}/bad", max_rows_per_file=5_000, rows_per_task=LOAD_ROWS)
    schema = ", ".join(f"{c} string" for c in records.FORWARD_KEPT)
    before = t.spark.read.options(sep="|", recursiveFileLookup=True).schema(schema)
    sums = [F.count(F.lit(1)).alias("cnt"), F.sum(F.col("caller_no").cast("bigint")).alias("total")]
    kept = before.csv(f"{root}/table").withColumn("part_key", F.regexp_extract(F.col("_metadata.file_path"), "part_key=([0-9]+)", 1)).groupBy("part_key").agg(*sums)
    bad = before.csv(f"{root}/bad").agg(*sums).withColumn("part_key", F.lit(None).cast("string"))
    cols = ["part_key", "cnt", "total"]
    both = kept.select(F.lit("accepted").alias("outcome"), *cols).unionByName(bad.select(F.lit("rejected").alias("outcome"), *cols))
    return both.unionByName(_counted(t, counts, ["part_key"], ["total"]))


@report("trace_load_job", """
SELECT 'accepted' AS outcome, strftime(ts, '%Y%m%d') AS trx_date, event_type AS event_id, count(*) AS cnt, CAST(sum(event_id) AS BIGINT) AS total FROM events WHERE event_type <> 'error' GROUP BY 2, 3
UNION ALL SELECT 'counted_' || CASE WHEN event_type = 'error' THEN 'rejected' ELSE 'accepted' END, NULL, NULL, count(*), NULL FROM events GROUP BY 1
""")
def trace_load_job(t: Tables) -> DataFrame:
    """Files with a header line, named by date and event, loaded by both; files of another name are rejected."""
    root = scratch_dir(t.spark, "trace-job")
    rows = t.events.select(F.col("event_id").alias("number"), "value", F.date_format("ts", "yyyyMMdd").alias("d"), F.col("event_type").alias("e"))
    Wr.write_named(rows, f"{root}/in", ["d", "e"], lambda d, e: "unknown" if e == "error" else f"A{d}_x_{e}", header=True)
    counts = records.load_trace(t.spark, f"{root}/in", f"{root}/table", f"{root}/bad", rows_per_task=LOAD_ROWS)
    table = read_partitioned(t.spark, f"{root}/table").withColumn("number", F.col("number").cast("bigint"))
    kept = table.groupBy("trx_date", "event_id").agg(F.count(F.lit(1)).alias("cnt"), F.sum("number").alias("total"))
    return kept.select(F.lit("accepted").alias("outcome"), "trx_date", "event_id", "cnt", "total").unionByName(_counted(t, counts, ["trx_date", "event_id"], ["total"]))


@report("usage_by_line", """
SELECT 'S' || user_id AS subr_num, strftime(ts, '%Y%m%d') AS accs_date, CASE event_type WHEN 'view' THEN 'web' WHEN 'click' THEN 'web' WHEN 'purchase' THEN 'shop' END AS media_category_name,
  CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 1 WHEN 'purchase' THEN 2 END AS media_sub_category_name, count(*) AS cnt, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT) + 5) AS BIGINT) AS sum_vol
FROM events GROUP BY ALL
""")
def usage_by_line(t: Tables) -> DataFrame:
    """Volume per line, date and media category; unknown domains have no category."""
    log = t.events.select(
        F.concat(F.lit("S"), "user_id").alias("subr_num"), F.date_format("ts", "yyyyMMdd").alias("accs_date"), F.col("event_type").alias("domain"),
        F.get_json_object("props", "$.k").cast("int").alias("uload_size"), F.lit(5).alias("dnld_size"),
    )
    domains = constant_rows(t.spark, [("view", "web", 1), ("click", "web", 1), ("purchase", "shop", 2)], "domain string, media_category_name string, media_sub_category_name int")
    return usage.by_category(log, domains)


@report("usage_for_lines", """
SELECT event_id, user_id AS subr_num, event_type FROM events WHERE user_id IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)
""")
def usage_for_lines(t: Tables) -> DataFrame:
    """Usage rows of listed lines only."""
    log = t.events.select("event_id", F.col("user_id").alias("subr_num"), "event_type")
    return usage.for_lines(log, t.orders.where("o_totalprice > 400000").select(F.col("o_custkey").alias("subr_num")))


@report("cell_movement", """
WITH a AS (SELECT user_id, ts, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_type) AS prev FROM events),
r AS (SELECT * FROM a WHERE prev IS NULL OR prev <> event_type)
SELECT user_id AS imsi, ts AS time, event_type AS eci, coalesce(CAST(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_type) AS VARCHAR), '0') AS timeout, coalesce(lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_type), '') AS eciout FROM r
""")
def cell_movement(t: Tables) -> DataFrame:
    """Cells in order with the next one; the last has time `0` and no next cell."""
    seen = t.events.select(F.col("user_id").alias("imsi"), F.col("ts").alias("time"), F.col("event_type").alias("eci"))
    return usage.cell_movement(seen).select("imsi", "time", "eci", "timeout", "eciout")


class _Bills:
    """Bills from orders, bill transactions from lines."""

    def __init__(self, t: Tables):
        self.t = t

    def __getitem__(self, name: str) -> DataFrame:
        t = self.t
        if name == "bill":
            return t.orders.select(F.col("o_orderkey").alias("bill_reference"), F.col("o_custkey").alias("customer_reference"), day("o_orderdate").alias("actual_bill_date"))
        if name == "bill_trans":
            q = F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity")).cast("decimal(12,2)")
            return t.lineitem.select(F.col("l_orderkey").alias("bill_reference"), F.concat(F.lit("MTH"), F.lit("0"), F.when(F.col("l_linestatus") == "F", "1").otherwise("2")).alias("payment_method_name"), q.alias("transaction_amount"))
        return constant_rows(t.spark, [("MTH01-ADJ",), ("MTH02-PAY",)], "payment_method_name string")


_BILLS_SQL = """
d AS (SELECT m.o_orderkey AS main, s.o_orderkey AS bill, CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS q
  FROM orders m JOIN orders s ON m.o_custkey = s.o_custkey AND m.o_orderdate = s.o_orderdate JOIN lineitem ON l_orderkey = s.o_orderkey WHERE l_linestatus = 'F'),
p AS (SELECT main, abs(q) AS a FROM d GROUP BY 1, 2 HAVING count(*) = 2 AND sum(q) = 0)
"""


@report("bill_offsets", f"WITH {_BILLS_SQL} SELECT main AS bill_reference, CAST(sum(a) AS DOUBLE) AS offset_amt FROM p GROUP BY 1")
def bill_offsets(t: Tables) -> DataFrame:
    """Sum of adjustments that cancel out, per bill."""
    b = _Bills(t)
    return billing.offsets(b, b["bill"]).withColumn("offset_amt", F.col("offset_amt").cast("double"))


@report("bill_standing", f"WITH {_BILLS_SQL} SELECT bill AS bill_reference, CAST(q AS DOUBLE) AS transaction_amount FROM d WHERE main = bill AND (main, abs(q)) NOT IN (SELECT (main, a) FROM p)")
def bill_standing(t: Tables) -> DataFrame:
    """Own adjustments that nothing cancels."""
    b = _Bills(t)
    return billing.standing(b, b["bill"]).withColumn("transaction_amount", F.col("transaction_amount").cast("double"))


@report("latest_contracts", with_tables("pos_inv_header", "subr_ld_hist", "mkt_ref_vw") + """,
x AS (SELECT *, rank() OVER (PARTITION BY cust_num, subr_num ORDER BY ld_expired_date DESC) AS rk FROM w_subr_ld_hist WHERE DATE '1999-05-31' BETWEEN start_date AND end_date AND DATE '1999-05-31' BETWEEN ld_start_date AND ld_expired_date
  AND ld_start_date >= DATE '1998-12-01' AND mkt_cd IN (SELECT mkt_cd FROM w_mkt_ref_vw WHERE ld_revenue = 'P'))
SELECT cust_num, subr_num, max(inv_num) AS inv_num, max(ld_cd) AS ld_cd, max(CAST(substr(ld_cd, 4, 2) AS INTEGER)) AS months FROM x WHERE rk = 1 GROUP BY 1, 2
""")
def latest_contracts(t: Tables) -> DataFrame:
    """The plan contract of each line that runs at a month end and ends last."""
    return billing.latest_contracts(Warehouse(t), date(1999, 5, 31))


@report("extra_costs", """
WITH e AS (SELECT o_custkey, CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS cost FROM orders WHERE o_orderstatus = 'F'),
m AS (SELECT 'S' || o_custkey AS s, cost FROM e UNION ALL SELECT 'S' || (o_custkey + 1), cost FROM e)
SELECT s AS subr_num, CAST(sum(cost) AS DOUBLE) AS extra_cost FROM m WHERE s IN (SELECT 'S' || c_custkey FROM customer) GROUP BY 1
""")
def extra_costs(t: Tables) -> DataFrame:
    """Extra costs given for lists of lines, text that is no number counting as 0."""
    cost = F.when(F.col("o_orderpriority") == "5-LOW", "n/a").otherwise(F.concat(F.lit("$"), F.format_number(money("o_totalprice"), 2)))
    listed = F.concat(F.lit("S"), "o_custkey", F.lit(", S"), (F.col("o_custkey") + 1).cast("string"))
    frames = {
        "extra_cost": t.orders.select(listed.alias("subr_num"), F.when(F.col("o_orderstatus") == "F", "New").otherwise("Old").alias("order_type"), cost.alias("extra_cost")),
        "lines": t.customer.select(F.concat(F.lit("S"), "c_custkey").alias("subr_num")),
    }
    return billing.extra_costs(frames).withColumn("extra_cost", F.col("extra_cost").cast("double"))


_SUPPLIERS = ["sup_a", "sup_b", "sup_c"]


@report("cost_sheet", """
SELECT CAST(p_partkey AS VARCHAR) AS bill_cd, CAST(p_size * 1000 AS VARCHAR) AS oneoff_cost, '0' AS add_oneoff_cost, '0' AS monthly_cost,
  '0-12:' || p_size || '|13-24:0|25-36:' || p_size * 1000 AS sup_a_mthly, '0-12:' || p_size || '|13-24:0|25-36:' || p_size * 1000 AS sup_b_mthly, '0-12:' || p_size || '|13-24:0|25-36:' || p_size * 1000 AS sup_c_mthly,
  '0-36:' || p_size * 1000 AS sup_a_oneoff, '0-36:0' AS sup_b_oneoff, '0-12:' || p_size || '|13-36:0' AS sup_c_oneoff FROM part
""")
def cost_sheet(t: Tables) -> DataFrame:
    """Cost sheet with money text cleaned and tier texts built."""
    one, big = F.concat(F.lit("$"), F.col("p_size")), F.concat(F.lit("$"), F.format_number(F.col("p_size") * 1000, 0))
    cols = {"bill_cd": F.col("p_partkey").cast("string"), "oneoff_cost": big, "add_oneoff_cost": F.lit(" "), "monthly_cost": F.lit(None).cast("string"), "sup_a_oneoff": big, "sup_b_oneoff": F.lit("$0"), "sup_c_oneoff_12": one}
    for s in _SUPPLIERS:
        cols |= {f"{s}_mthly_12": one, f"{s}_mthly_24": F.lit(" "), f"{s}_mthly_36": big}
    return billing.cost_sheet(t.part.select(*[c.alias(n) for n, c in cols.items()]), _SUPPLIERS, "sup_c")


@report("key_candidates", """
SELECT 'order' AS candidate, count(*) AS row_cnt, count(DISTINCT l_orderkey) AS key_cnt, count(*) - count(DISTINCT l_orderkey) AS dup_cnt FROM lineitem
UNION ALL SELECT 'order_line', count(*), count(DISTINCT (l_orderkey, l_linenumber)), count(*) - count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem
""")
def key_candidates(t: Tables) -> DataFrame:
    """How far each key candidate is from unique."""
    return audit.key_candidates(t.lineitem, {"order": ["l_orderkey"], "order_line": ["l_orderkey", "l_linenumber"]})


@report("load_balance", "SELECT count(*) AS part_cnt, count(*) AS whole_cnt, 'Y' AS balanced FROM events")
def load_balance(t: Tables) -> DataFrame:
    """Records loaded and rejected against records read."""
    good, bad = records.firewall_keyed(_firewall_lines(t))
    return audit.load_balance(t.events, good, bad)


@report("arrivals_per_day", "SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS cnt FROM orders GROUP BY 1")
def arrivals_per_day(t: Tables) -> DataFrame:
    return audit.arrivals(orders(t), "o_orderdate")
