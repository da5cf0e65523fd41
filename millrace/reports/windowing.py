"""Reports on row choice, ranks and row-to-row operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import drop_repeats, dwell, list_agg, movement, nth_row, pick_rank, ranked
from millrace.reports.common import orders
from millrace.reports.registry import report
from millrace.sources.tables import Tables

_CHOSEN = "o_custkey, o_orderkey, o_totalprice, o_orderstatus"


def _nth_sql(order: str, n: int) -> str:
    return f"SELECT {_CHOSEN} FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY {order}) AS rn FROM orders) WHERE rn = {n}"


def _slim(t: Tables) -> DataFrame:
    return t.orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus", "o_orderdate")


@report("dedup_latest", _nth_sql("o_orderdate DESC, o_totalprice DESC, o_orderkey DESC", 1))
def dedup_latest(t: Tables) -> DataFrame:
    order = [F.col(c).desc_nulls_last() for c in ("o_orderdate", "o_totalprice", "o_orderkey")]
    return nth_row(_slim(t), "o_custkey", order).drop("o_orderdate")


@report("first_row", _nth_sql("o_orderdate, o_orderkey", 1))
def first_row(t: Tables) -> DataFrame:
    return nth_row(_slim(t), "o_custkey", ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@report("second_row", _nth_sql("o_orderdate DESC, o_orderkey DESC", 2))
def second_row(t: Tables) -> DataFrame:
    return nth_row(_slim(t), "o_custkey", [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()], 2).drop("o_orderdate")


@report("nested_dedup", """
WITH a AS (SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_extendedprice DESC, l_partkey) AS rn FROM lineitem),
b AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC) AS r2 FROM a WHERE rn = 1)
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM b WHERE r2 = 1
""")
def nested_dedup(t: Tables) -> DataFrame:
    """One row per order line, then one line per order."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    one = nth_row(rows, ["l_orderkey", "l_linenumber"], [F.col("l_extendedprice").desc(), "l_partkey"])
    return nth_row(one, "l_orderkey", [F.col("l_linenumber").desc()])


@report("rank_ties", """
WITH r AS (SELECT l_orderkey, l_partkey, l_linenumber, CAST(l_shipdate AS DATE) AS d, rank() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS rnk FROM lineitem),
f AS (SELECT * FROM r WHERE rnk <= 4),
p AS (SELECT l_orderkey, max(CASE WHEN rnk = 4 THEN (l_partkey, d) END) AS r4, max(CASE WHEN rnk = 3 THEN (l_partkey, d) END) AS r3 FROM f GROUP BY 1),
l AS (SELECT l_orderkey, string_agg('[' || CAST(l_partkey AS VARCHAR) || ']-' || strftime(d, '%Y%m%d'), ';' ORDER BY rnk, l_partkey, d) AS bill_list FROM f GROUP BY 1)
SELECT l_orderkey, coalesce(r4, r3)[1] AS part_at, coalesce(r4, r3)[2] AS ship_at, bill_list FROM p JOIN l USING (l_orderkey)
""")
def rank_ties(t: Tables) -> DataFrame:
    """Lines ranked with ties; the values at rank 4, else rank 3, and the list of the first four."""
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", F.to_date("l_shipdate").alias("d"))
    first = ranked(rows, "l_orderkey", ["l_linenumber"], 4)
    at = pick_rank(first, "l_orderkey", "rnk", [4, 3], ["l_partkey", "d"])
    text = F.concat(F.lit("["), F.col("l_partkey").cast("string"), F.lit("]-"), F.date_format("d", "yyyyMMdd"))
    listed = list_agg(first.withColumn("bill", text), "l_orderkey", "bill", ["rnk", "l_partkey", "d"], ";", name="bill_list", repeats=False)
    return at.join(listed, "l_orderkey").select("l_orderkey", F.col("l_partkey").alias("part_at"), F.col("d").alias("ship_at"), "bill_list")


_RUNS_SQL = """
a AS (SELECT user_id, ts, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_type) AS prev FROM events),
b AS (SELECT *, sum(CASE WHEN prev IS NULL OR prev <> event_type THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_type) AS run FROM a),
r AS (SELECT user_id, run, event_type, min(ts) AS ts, max(ts) AS last FROM b GROUP BY 1, 2, 3)
"""


@report("dwell_time", f"WITH {_RUNS_SQL} SELECT user_id, ts, event_type, last AS timeout, (epoch_us(last) - epoch_us(ts)) / 1000000.0 AS dwell_time FROM r")
def dwell_time(t: Tables) -> DataFrame:
    return dwell(t.events, "user_id", "ts", "event_type")


@report("movement_path", f"""
WITH {_RUNS_SQL} SELECT user_id, ts, event_type, lead(ts) OVER (PARTITION BY user_id ORDER BY run) AS timeout, lead(event_type) OVER (PARTITION BY user_id ORDER BY run) AS event_type_out FROM r
""")
def movement_path(t: Tables) -> DataFrame:
    return movement(t.events, "user_id", "ts", "event_type")


@report("drop_repeats", """
SELECT event_id, user_id, event_type FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events) WHERE prev IS NULL OR prev <> event_type
""")
def repeats_dropped(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "user_id", "event_type", "ts")
    return drop_repeats(rows, "user_id", ["ts", "event_id"], "event_type").drop("ts")


@report("dwell_by_day", f"""
WITH {_RUNS_SQL} SELECT event_type, count(*) AS stays, round(max((epoch_us(last) - epoch_us(ts)) / 1000000.0), 3) AS longest FROM r GROUP BY 1
""")
def dwell_by_day(t: Tables) -> DataFrame:
    """The same stays cut into days instead of ten minutes, for sparse keys; results do not change."""
    stays = dwell(t.events, "user_id", "ts", "event_type", F.to_date("_ts"))
    return stays.groupBy("event_type").agg(F.count(F.lit(1)).alias("stays"), F.round(F.max("dwell_time"), 3).alias("longest"))


@report("first_activation", """
SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS on_date FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
WHERE rn = 1 AND o_orderdate BETWEEN TIMESTAMP '1995-03-01' AND TIMESTAMP '1995-12-31'
""")
def first_activation(t: Tables) -> DataFrame:
    """Customers whose very first order falls in the window; the window is applied after the choice."""
    rows = orders(t).select("o_custkey", "o_orderkey", F.col("o_orderdate").alias("on_date"))
    first = nth_row(rows, "o_custkey", ["on_date", "o_orderkey"])
    return first.where("on_date between date'1995-03-01' and date'1995-12-31'")
