"""Reports on joins: history, range, tolerance, membership, grids and waterfalls."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import money, month_start
from millrace.operators import (
    allocate, constant_rows, drop_in, drop_like, fill_grid, grid, join_asof, join_eq, join_list_member, join_on_expr, join_overlap,
    join_range, join_siblings, join_within, keep_first, keep_in, list_agg, match_fallback, offset_pairs, snapshot,
    waterfall, with_scalar,
)
from millrace.params import OPEN_DATE
from millrace.reports.common import HISTORY_SQL, YEARS, cents, day, from_cents, from_revenue, lines, orders, priority_history, revenue, total
from millrace.reports.registry import report
from millrace.sources.tables import Tables


@report("list_filter_join", """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders JOIN customer ON o_custkey = c_custkey
WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
""")
def list_filter_join(t: Tables) -> DataFrame:
    """A large table cut down to a list of keys; the list is broadcast only if its size allows."""
    wanted = t.customer.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select(F.col("c_custkey").alias("o_custkey"))
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    return join_eq(rows, wanted, "o_custkey", "left_semi", small=True)


@report("left_join_chain", """
SELECT s_suppkey, s_name, n_name, r_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey AND r_name <> 'ASIA'
""")
def left_join_chain(t: Tables) -> DataFrame:
    nation = t.nation.withColumnRenamed("n_nationkey", "s_nationkey")
    region = t.region.where("r_name <> 'ASIA'").withColumnRenamed("r_regionkey", "n_regionkey")
    out = join_eq(join_eq(t.supplier, nation, "s_nationkey", "left"), region, "n_regionkey", "left")
    return out.select("s_suppkey", "s_name", "n_name", "r_name")


@report("salted_join", """
SELECT o_orderstatus, n_name, count(*) AS cnt FROM orders JOIN (VALUES ('O', 'open'), ('F', 'done'), ('P', 'part')) v(st, n_name) ON o_orderstatus = st GROUP BY 1, 2
""")
def salted_join(t: Tables) -> DataFrame:
    """A reference join on a key of which one value holds a third of the rows, spread by salt."""
    names = constant_rows(t.spark, [("O", "open"), ("F", "done"), ("P", "part")], "o_orderstatus string, n_name string")
    joined = join_eq(t.orders.select("o_orderkey", "o_orderstatus"), names, "o_orderstatus", salt=8)
    return joined.groupBy("o_orderstatus", "n_name").agg(F.count(F.lit(1)).alias("cnt"))


@report("not_in_returns", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
""")
def not_in_returns(t: Tables) -> DataFrame:
    returned = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return drop_in(t.orders.select("o_orderkey", "o_totalprice"), returned, "o_orderkey")


@report("tuple_anti", """
WITH o AS (SELECT *, CAST(date_trunc('month', o_orderdate) AS DATE) AS mth FROM orders),
tot AS (SELECT o_custkey, mth, count(*) AS month_orders FROM o GROUP BY 1, 2)
SELECT o_orderkey, o.o_custkey, o.mth, month_orders FROM o JOIN tot ON o.o_custkey = tot.o_custkey AND o.mth = tot.mth
WHERE o_orderstatus = 'O' AND (o.o_custkey, o.mth) NOT IN (SELECT (o_custkey, mth) FROM o WHERE o_orderstatus = 'F')
""")
def tuple_anti(t: Tables) -> DataFrame:
    o = orders(t).select("o_orderkey", "o_custkey", "o_orderstatus", month_start("o_orderdate").alias("mth"))
    keys = ["o_custkey", "mth"]
    totals = o.groupBy(*keys).agg(F.count(F.lit(1)).alias("month_orders"))
    open_ = drop_in(o.where("o_orderstatus = 'O'"), o.where("o_orderstatus = 'F'"), keys)
    return join_eq(open_.drop("o_orderstatus"), totals, keys)


PATTERNS = ["red %", "% ring", "%old%", "h_t b%"]


@report("like_pattern_anti", """
SELECT p_partkey, p_name FROM part WHERE NOT EXISTS (
  SELECT 1 FROM (VALUES ('red %'), ('% ring'), ('%old%'), ('h_t b%')) v(p) WHERE p_name LIKE p)
""")
def like_pattern_anti(t: Tables) -> DataFrame:
    patterns = constant_rows(t.spark, [(p,) for p in PATTERNS], "pattern string")
    return drop_like(t.part.select("p_partkey", "p_name"), "p_name", patterns)


@report("exists_semi", """
SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)
""")
def exists_semi(t: Tables) -> DataFrame:
    big = t.orders.where("o_totalprice > 450000").select(F.col("o_custkey").alias("c_custkey"))
    return keep_in(t.customer.select("c_custkey", "c_name"), big, "c_custkey")


@report("asof_history", f"""
WITH {HISTORY_SQL},
l AS (SELECT l_orderkey, l_linenumber, l_partkey, o_custkey, CAST(l_shipdate AS DATE) AS d FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT l_orderkey, l_linenumber, l_partkey, d AS ship_date, h.plan AS plan_at, g.plan AS plan_before
FROM l LEFT JOIN hist h ON l.o_custkey = h.o_custkey AND d BETWEEN h.start_date AND h.end_date
LEFT JOIN hist g ON l.o_custkey = g.o_custkey AND d - 1 BETWEEN g.start_date AND g.end_date
""")
def asof_history(t: Tables) -> DataFrame:
    hist = priority_history(t)
    o = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    sent = lines(t).select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_shipdate").alias("ship_date")).join(o, "l_orderkey")
    at = join_asof(sent, hist.withColumnRenamed("plan", "plan_at"), "o_custkey", "ship_date", years=YEARS).drop("start_date", "end_date")
    both = join_asof(at, hist.withColumnRenamed("plan", "plan_before"), "o_custkey", "ship_date", offset_days=-1, years=YEARS)
    return both.select("l_orderkey", "l_linenumber", "l_partkey", "ship_date", "plan_at", "plan_before")


@report("history_snapshot", f"""
WITH {HISTORY_SQL}
SELECT c_custkey, plan FROM customer LEFT JOIN (SELECT * FROM hist WHERE DATE '1998-01-01' BETWEEN start_date AND end_date) h ON c_custkey = h.o_custkey
""")
def history_snapshot(t: Tables) -> DataFrame:
    at = snapshot(priority_history(t), F.to_date(F.lit("1998-01-01")))
    return join_eq(t.customer.select("c_custkey"), at.select(F.col("o_custkey").alias("c_custkey"), "plan"), "c_custkey", "left")


@report("history_starts_only", f"""
WITH {HISTORY_SQL}
SELECT o.o_orderkey, coalesce(h.plan, 'ref') AS entitlement
FROM orders o LEFT JOIN hist h ON o.o_custkey = h.o_custkey AND h.start_date = CAST(o.o_orderdate AS DATE) + CAST(CAST(substr(o_orderpriority, 1, 1) AS INTEGER) % 2 AS INTEGER)
""")
def history_starts_only(t: Tables) -> DataFrame:
    """Entitlement from history only where an interval starts on the effective date, else the default."""
    o = orders(t).withColumn("eff", F.expr("date_add(o_orderdate, cast(substring(o_orderpriority, 1, 1) as int) % 2)"))
    found = join_asof(o.select("o_orderkey", "o_custkey", "eff"), priority_history(t), "o_custkey", "eff", starts_only=True)
    return found.select("o_orderkey", F.coalesce("plan", F.lit("ref")).alias("entitlement"))


@report("interval_overlap", """
WITH s AS (SELECT l_orderkey, min(CAST(l_shipdate AS DATE)) AS s1, max(CAST(l_shipdate AS DATE)) AS e1 FROM lineitem GROUP BY 1),
q AS (SELECT o_orderstatus, s1, e1 FROM s JOIN orders ON l_orderkey = o_orderkey),
m AS (SELECT DISTINCT o_orderstatus, CAST(date_trunc('month', o_orderdate) AS DATE) AS s2 FROM orders)
SELECT q.o_orderstatus, m.s2 AS mth, count(*) AS active_orders
FROM q JOIN m ON q.o_orderstatus = m.o_orderstatus AND s1 <= last_day(s2) AND e1 >= s2 GROUP BY 1, 2
""")
def interval_overlap(t: Tables) -> DataFrame:
    """Orders whose first-to-last shipping span touches a month, per status and month."""
    span = lines(t).groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_shipdate").alias("s1"), F.max("l_shipdate").alias("e1"))
    active = span.join(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderkey")
    months = orders(t).select("o_orderstatus", month_start("o_orderdate").alias("s2")).distinct().withColumn("e2", F.last_day("s2"))
    pairs = join_overlap(active, months, "o_orderstatus", "s1", "e1", "s2", "e2")
    return pairs.groupBy("o_orderstatus", F.col("s2").alias("mth")).agg(F.count(F.lit(1)).alias("active_orders"))


CODE_RANGES = [("Brand#1", "Brand#14", "north"), ("Brand#15", "Brand#2", "south"), ("Brand#20", "Brand#23", "east"), ("Brand#4", "Brand#7", "west")]


@report("code_range_join", """
WITH r(lo, hi, nature) AS (VALUES ('Brand#1', 'Brand#14', 'north'), ('Brand#15', 'Brand#2', 'south'), ('Brand#20', 'Brand#23', 'east'), ('Brand#4', 'Brand#7', 'west'))
SELECT nature, count(*) AS cnt, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amt
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN r ON p_brand BETWEEN lo AND hi GROUP BY 1
""")
def code_range_join(t: Tables) -> DataFrame:
    """Cost codes into text ranges. Lines are summed per code first."""
    ranges = constant_rows(t.spark, CODE_RANGES, "lo string, hi string, nature string")
    per_part = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count(F.lit(1)).alias("cnt"), F.sum(cents("l_extendedprice")).alias("amt"))
    per_code = per_part.join(t.part.select("p_partkey", "p_brand"), "p_partkey").groupBy("p_brand").agg(F.sum("cnt").alias("cnt"), F.sum("amt").alias("amt"))
    hit = join_range(per_code, ranges, "p_brand", "lo", "hi")
    return hit.groupBy("nature").agg(F.sum("cnt").alias("cnt"), from_cents(F.sum("amt")).alias("amt"))


PRICE_BANDS = [(900.0, 924.99, "A"), (925.0, 949.99, "B"), (950.0, 974.99, "C"), (960.0, 999.99, "D")]


@report("price_range_join", """
WITH r(lo, hi, band) AS (VALUES (900.0, 924.99, 'A'), (925.0, 949.99, 'B'), (950.0, 974.99, 'C'), (960.0, 999.99, 'D'))
SELECT p_partkey, band FROM part LEFT JOIN r ON p_retailprice BETWEEN lo AND hi
""")
def price_range_join(t: Tables) -> DataFrame:
    """Numbers into ranges, both cut into bins so that the join has an equality key."""
    bands = constant_rows(t.spark, PRICE_BANDS, "lo double, hi double, band string")
    return join_range(t.part.select("p_partkey", "p_retailprice"), bands, "p_retailprice", "lo", "hi", width=10, how="left").select("p_partkey", "band")


@report("tolerance_join", """
WITH p AS (SELECT event_id, user_id, CAST(ts AS DATE) AS d, json_extract_string(props, '$.k') AS id FROM events WHERE event_type = 'purchase'),
c AS (SELECT user_id, CAST(ts AS DATE) AS d, CASE WHEN value < 20 THEN ' ' ELSE json_extract_string(props, '$.k') END AS id,
  CAST(value AS DECIMAL(18,2)) AS v FROM events WHERE event_type IN ('click', 'view'))
SELECT event_id, count(*) AS hits, CAST(sum(v) AS DOUBLE) AS amt, CAST(max(v) AS DOUBLE) AS top
FROM p JOIN c ON p.user_id = c.user_id AND abs(p.d - c.d) <= 1 AND (p.id = c.id OR trim(c.id) = '') GROUP BY 1
""")
def tolerance_join(t: Tables) -> DataFrame:
    """Clicks and views of the same user within a day, of the same id or of none, per purchase."""
    key = F.get_json_object("props", "$.k")
    e = t.events.withColumn("d", day("ts"))
    bought = e.where("event_type = 'purchase'").select("event_id", "user_id", "d", key.alias("id"))
    seen = e.where("event_type in ('click', 'view')").select(
        "user_id", F.col("d").alias("d2"), F.when(F.col("value") < 20, F.lit(" ")).otherwise(key).alias("rid"), cents("value").alias("v")
    )
    aggs = {"hits": ("count", "v"), "amt": ("sum", "v"), "top": ("max", "v")}
    near = join_within(bought, seen, "user_id", "d", "d2", 1, aggs, residual=("id", "rid"))
    return near.select("event_id", "hits", from_cents("amt").alias("amt"), from_cents("top").alias("top"))


@report("computed_key_join", """
SELECT n_name, upper(p_type) AS type_cd, count(*) AS cnt FROM part JOIN nation ON CAST(split_part(p_brand, '#', 2) AS INTEGER) = n_nationkey GROUP BY 1, 2
""")
def computed_key_join(t: Tables) -> DataFrame:
    brand_no = F.split_part("p_brand", F.lit("#"), F.lit(2)).cast("int")
    counted = t.part.groupBy("p_brand", F.upper("p_type").alias("type_cd")).agg(F.count(F.lit(1)).alias("cnt"))
    joined = join_on_expr(counted, t.nation, brand_no, F.col("n_nationkey"))
    return joined.groupBy("n_name", "type_cd").agg(F.sum("cnt").alias("cnt"))


@report("list_membership_join", """
WITH c AS (SELECT n_regionkey, count(*) AS cnt, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS bal FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1),
n AS (SELECT n_regionkey, string_agg(CAST(n_nationkey AS VARCHAR), ',' ORDER BY n_nationkey) AS members FROM nation GROUP BY 1)
SELECT n_regionkey, members, cnt, bal FROM n JOIN c USING (n_regionkey)
""")
def list_membership_join(t: Tables) -> DataFrame:
    lists = list_agg(t.nation, "n_regionkey", "n_nationkey", name="members")
    per_nation = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("cnt"), F.sum(cents("c_acctbal")).alias("bal"))
    found = join_list_member(lists, "members", per_nation, "c_nationkey")
    return found.groupBy("n_regionkey", "members").agg(F.sum("cnt").alias("cnt"), from_cents(F.sum("bal")).alias("bal"))


@report("self_join_same_day", """
SELECT a.o_orderkey, min(b.o_orderkey) AS other_key, count(*) AS other_cnt, CAST(sum(CAST(b.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS other_amt
FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND a.o_orderdate = b.o_orderdate AND b.o_orderstatus <> 'P'
WHERE a.o_orderstatus = 'P' GROUP BY 1
""")
def self_join_same_day(t: Tables) -> DataFrame:
    """Orders of one status with those of other statuses of the same customer and day.

    The other side is reduced to one row per customer and day, so no pairs are formed.
    """
    keys = ["o_custkey", "o_orderdate"]
    others = t.orders.where("o_orderstatus <> 'P'").groupBy(*keys).agg(
        F.min("o_orderkey").alias("other_key"), F.count(F.lit(1)).alias("other_cnt"), total("o_totalprice").alias("other_amt")
    )
    own = t.orders.where("o_orderstatus = 'P'").select("o_orderkey", *keys)
    return join_eq(own, others, keys).drop(*keys)


@report("scalar_factor", """
WITH f AS (SELECT CAST(sum(CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) / count(*) AS avg_disc FROM lineitem)
SELECT l_returnflag, round(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) * (SELECT avg_disc FROM f), 2) AS expected_discount FROM lineitem GROUP BY 1
""")
def scalar_factor(t: Tables) -> DataFrame:
    factor = t.lineitem.agg((from_cents(F.sum(cents("l_discount"))) / F.count(F.lit(1))).alias("avg_disc"))
    sums = t.lineitem.groupBy("l_returnflag").agg(total("l_extendedprice").alias("amt"))
    return with_scalar(sums, factor).select("l_returnflag", F.round(F.col("amt") * F.col("avg_disc"), 2).alias("expected_discount"))


@report("dense_grid", """
WITH f AS (SELECT c_nationkey, c_mktsegment, count(*) AS cnt, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS bal FROM customer WHERE c_acctbal > 9000 GROUP BY 1, 2)
SELECT n_name, s.c_mktsegment, coalesce(cnt, 0) AS cnt, coalesce(bal, 0) AS bal
FROM nation CROSS JOIN (SELECT DISTINCT c_mktsegment FROM customer) s
LEFT JOIN f ON f.c_nationkey = n_nationkey AND f.c_mktsegment = s.c_mktsegment
""")
def dense_grid(t: Tables) -> DataFrame:
    cells = grid(t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), t.customer.select("c_mktsegment"))
    facts = t.customer.where("c_acctbal > 9000").groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("cnt"), total("c_acctbal").alias("bal"))
    return fill_grid(cells, facts, ["c_nationkey", "c_mktsegment"], {"cnt": 0, "bal": 0.0}).select("n_name", "c_mktsegment", "cnt", "bal")


@report("waterfall_sources", """
WITH s AS (
  SELECT l_orderkey, 1 AS p, 'RETURN' AS source, CAST(l_extendedprice AS DECIMAL(18,2)) AS amt FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'O'
  UNION ALL SELECT l_orderkey, 2, 'BULK', CAST(l_extendedprice AS DECIMAL(18,2)) FROM lineitem WHERE l_quantity >= 45
  UNION ALL SELECT l_orderkey, 3, 'FINAL', CAST(l_extendedprice AS DECIMAL(18,2)) FROM lineitem WHERE l_linestatus = 'F'),
m AS (SELECT l_orderkey, min(p) AS p FROM s GROUP BY 1)
SELECT l_orderkey, source, count(*) AS cnt, CAST(sum(amt) AS DOUBLE) AS amt FROM s JOIN m USING (l_orderkey, p) GROUP BY 1, 2
""")
def waterfall_sources(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_quantity", "l_returnflag", "l_linestatus", cents("l_extendedprice").alias("amt"))
    taken = waterfall(
        [
            ("RETURN", rows.where("l_returnflag = 'R' and l_linestatus = 'O'")),
            ("BULK", rows.where("l_quantity >= 45")),
            ("FINAL", rows.where("l_linestatus = 'F'")),
        ],
        ["l_orderkey"],
    )
    return taken.groupBy("l_orderkey", "source").agg(F.count(F.lit(1)).alias("cnt"), from_cents(F.sum("amt")).alias("amt"))


@report("match_fallback", """
WITH l AS (SELECT l_orderkey, CAST(l_shipdate AS DATE) AS d, l_partkey, l_linestatus, CAST(o_orderdate AS DATE) AS od FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
a AS (SELECT l_orderkey, min(d) AS d FROM l WHERE d = od + 1 AND l_linestatus = 'F' GROUP BY 1),
a2 AS (SELECT l.l_orderkey, l.d, max(l_partkey) AS pk FROM l JOIN a ON l.l_orderkey = a.l_orderkey AND l.d = a.d WHERE l_linestatus = 'F' GROUP BY 1, 2),
b AS (SELECT l_orderkey, min(d) AS d FROM l WHERE d BETWEEN od AND od + 60 GROUP BY 1),
b2 AS (SELECT l.l_orderkey, l.d, max(l_partkey) AS pk FROM l JOIN b ON l.l_orderkey = b.l_orderkey AND l.d = b.d GROUP BY 1, 2)
SELECT o_orderkey, CASE WHEN a2.d IS NOT NULL THEN 'EXACT' WHEN b2.d IS NOT NULL THEN 'EARLIEST' ELSE 'NONE' END AS "match",
  coalesce(a2.d, b2.d, DATE '2999-12-31') AS ship, CASE WHEN a2.d IS NOT NULL THEN a2.pk WHEN b2.d IS NOT NULL THEN b2.pk ELSE -1 END AS part
FROM orders LEFT JOIN a2 ON o_orderkey = a2.l_orderkey LEFT JOIN b2 ON o_orderkey = b2.l_orderkey
""")
def match_stages(t: Tables) -> DataFrame:
    """Exact match, else the earliest in a window, else a default."""
    o = orders(t).select("o_orderkey", "o_orderdate")
    sent = lines(t).select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_shipdate").alias("ship"), F.col("l_partkey").alias("part"), "l_linestatus").join(o, "o_orderkey")
    gap = F.datediff("ship", "o_orderdate")
    exact = keep_first(sent.where((gap == 1) & (F.col("l_linestatus") == "F")), "o_orderkey", "ship", ["ship", "part"])
    early = keep_first(sent.where(gap.between(0, 60)), "o_orderkey", "ship", ["ship", "part"])
    return match_fallback(o.select("o_orderkey"), "o_orderkey", [("EXACT", exact), ("EARLIEST", early)], {"ship": OPEN_DATE, "part": -1})


@report("offset_pairs", """
WITH h AS (SELECT o_custkey, o_orderdate, min(o_orderkey) AS main_key FROM orders GROUP BY 1, 2),
d AS (SELECT main_key, CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS q
  FROM h JOIN orders s ON h.o_custkey = s.o_custkey AND h.o_orderdate = s.o_orderdate JOIN lineitem ON s.o_orderkey = l_orderkey)
SELECT main_key, abs(q) AS abs_q FROM d GROUP BY 1, 2 HAVING count(*) = 2 AND sum(q) = 0
""")
def offset_rows(t: Tables) -> DataFrame:
    """Amounts of the same customer and day that cancel out in exactly two rows."""
    header = t.orders.groupBy("o_custkey", "o_orderdate").agg(F.min("o_orderkey").alias("o_orderkey"))
    q = F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity"))
    details = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), q.alias("q"))
    rows = join_siblings(header, t.orders, details, ["o_custkey", "o_orderdate"], "o_orderkey")
    return offset_pairs(rows.withColumnRenamed("main_o_orderkey", "main_key"), "main_key", "q")


@report("allocate_shared_pool", """
WITH w AS (SELECT n_name, count(*) AS heads FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1),
p AS (SELECT CAST(sum(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS pool FROM supplier)
SELECT n_name, heads, round(heads * (SELECT pool FROM p) / (SELECT sum(heads) FROM w), 1) AS allocated FROM w
""")
def allocate_shared_pool(t: Tables) -> DataFrame:
    heads = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("heads"))
    named = join_eq(heads, t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey")
    pool = t.supplier.select(money("s_acctbal").alias("cost"))
    split = allocate(named, "heads", pool, "cost")
    return split.select("n_name", "heads", F.round("allocated", 1).cast("double").alias("allocated"))


@report("revenue_by_region", """
SELECT r_name, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS rev
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1
""")
def revenue_by_region(t: Tables) -> DataFrame:
    """Facts summed per supplier before three reference joins."""
    per_supp = t.lineitem.groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.sum(revenue()).alias("rev"))
    places = t.supplier.join(t.nation, t.supplier.s_nationkey == t.nation.n_nationkey).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return per_supp.join(places.select("s_suppkey", "r_name"), "s_suppkey").groupBy("r_name").agg(from_revenue(F.sum("rev")).alias("rev"))
