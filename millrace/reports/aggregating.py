"""Reports on aggregates: keep-first, lists, subtotals, KPIs, pivots, signed and weighted totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import money, month_start, pct_text, ratio
from millrace.operators import (
    constant_rows, drop_in, duplicate_keys, join_eq, keep_first, list_agg, list_pieces, per_day, pivot_report, pre_aggregate_join,
    printable, ready, reconcile, regroup, share, signed_total, split_rows, stack, summarise, weighted_total,
    with_header_rows, with_subtotals,
)
from millrace.operators.lists import number_rows
from millrace.reports.common import cents, from_cents, from_revenue, orders, revenue, total
from millrace.reports.registry import report
from millrace.sources.tables import Tables
from millrace.sources.writers import split_valid


@report("usage_by_category", """
SELECT c_mktsegment, CAST(date_trunc('month', o_orderdate) AS DATE) AS mth, p_type, count(*) AS cnt, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS volume
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey LEFT JOIN part ON l_partkey = p_partkey
GROUP BY 1, 2, 3
""")
def usage_by_category(t: Tables) -> DataFrame:
    """Usage by customer group, month and category.

    Items are nearly as many as usage rows per month here, so a sum per item before the join would
    save nothing; the join carries three narrow columns and the sum combines before its shuffle.
    """
    owner = t.orders.select("o_orderkey", "o_custkey", month_start(F.to_date("o_orderdate")).alias("mth")).join(
        t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey"
    ).drop("o_custkey")
    usage = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("p_partkey"), F.col("l_quantity").cast("bigint").alias("volume"))
    facts = usage.join(owner, "o_orderkey").join(t.part.select("p_partkey", "p_type"), "p_partkey", "left")
    return facts.groupBy("c_mktsegment", "mth", "p_type").agg(F.count(F.lit(1)).alias("cnt"), F.sum("volume").cast("double").alias("volume"))


@report("usage_by_type", """
SELECT l_returnflag, p_type, count(*) AS cnt, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS volume
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1, 2
""")
def usage_by_type(t: Tables) -> DataFrame:
    """Usage summed per item before the item reference is joined: one row per item and flag meets it."""
    usage = t.lineitem.select("l_returnflag", F.col("l_partkey").alias("p_partkey"), F.col("l_quantity").cast("bigint").alias("volume"))
    out = pre_aggregate_join(usage, t.part.select("p_partkey", "p_type"), ["p_partkey"], ["l_returnflag", "p_type"], ["volume"])
    return out.select("l_returnflag", "p_type", "cnt", F.col("volume").cast("double").alias("volume"))


@report("group_sums", """
SELECT l_returnflag, l_linestatus, count(*) AS cnt, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS qty,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS rev,
  min(l_extendedprice) AS lo, max(l_extendedprice) AS hi
FROM lineitem GROUP BY 1, 2
""")
def group_sums(t: Tables) -> DataFrame:
    return summarise(
        t.lineitem, ["l_returnflag", "l_linestatus"],
        {
            "cnt": F.count(F.lit(1)), "qty": total("l_quantity"), "rev": from_revenue(F.sum(revenue())),
            "lo": F.min("l_extendedprice"), "hi": F.max("l_extendedprice"),
        },
    )


@report("moving_average_units", """
WITH m AS (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS mth, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amt FROM orders GROUP BY 1, 2),
s AS (SELECT o_custkey, CAST(mth + n * INTERVAL 1 MONTH AS DATE) AS mth, amt FROM m CROSS JOIN (VALUES (0), (1), (2)) v(n))
SELECT o_custkey, mth, round(sum(amt) / 3, 2) AS avg3, round(sum(amt) / 3 / 1000, 5) AS avg3_thousand FROM s GROUP BY 1, 2
""")
def moving_average_units(t: Tables) -> DataFrame:
    """Average of a month and the two before it, absent months counting as zero."""
    monthly = orders(t).groupBy("o_custkey", month_start("o_orderdate").alias("m0")).agg(F.sum(cents("o_totalprice")).alias("amt"))
    spread = monthly.withColumn("mth", F.explode(F.array(*[F.add_months("m0", n) for n in range(3)])))
    avg3 = from_cents(F.sum("amt")) / 3
    return spread.groupBy("o_custkey", "mth").agg(F.round(avg3, 2).alias("avg3"), F.round(avg3 / 1000, 5).alias("avg3_thousand"))


@report("product_sales", """
WITH ok AS (SELECT * FROM lineitem WHERE l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')),
x AS (SELECT l_orderkey, CASE WHEN p_type IN ('SMALL', 'ECONOMY') THEN 'HANDSET' WHEN p_type IN ('PROMO') THEN 'VOUCHER' WHEN p_name LIKE '%ring' THEN 'ACCESSORY' ELSE 'OTHER' END AS cls,
  p_name, CAST(l_extendedprice AS DECIMAL(18,2)) AS amt, CAST(l_quantity AS BIGINT) AS q FROM ok JOIN part ON l_partkey = p_partkey)
SELECT l_orderkey, cls, CAST(sum(amt) AS DOUBLE) AS rev, CAST(sum(q) AS BIGINT) AS qty, string_agg(p_name, ',' ORDER BY p_name) AS products FROM x GROUP BY 1, 2
""")
def product_sales(t: Tables) -> DataFrame:
    kept = drop_in(t.lineitem, t.lineitem.where("l_returnflag = 'R'"), "l_orderkey")
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_type")
    cls = (
        F.when(F.col("p_type").isin("SMALL", "ECONOMY"), "HANDSET")
        .when(F.col("p_type").isin("PROMO"), "VOUCHER")
        .when(F.col("p_name").like("%ring"), "ACCESSORY")
        .otherwise("OTHER")
    )
    rows = join_eq(kept, parts, "l_partkey").select(
        "l_orderkey", cls.alias("cls"), "p_name", cents("l_extendedprice").alias("amt"), F.col("l_quantity").cast("bigint").alias("q")
    )
    by = ["l_orderkey", "cls"]
    sums = rows.groupBy(*by).agg(from_cents(F.sum("amt")).alias("rev"), F.sum("q").alias("qty"))
    return sums.join(list_agg(rows, by, "p_name", name="products"), by)


@report("keep_first_last", """
WITH x AS (SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) AS rl, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS rf,
  rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS rp FROM orders)
SELECT o_custkey, max(CASE WHEN rl = 1 THEN o_totalprice END) AS last_price, max(CASE WHEN rl = 1 THEN o_orderstatus END) AS last_status,
  max(CASE WHEN rf = 1 THEN o_totalprice END) AS first_price, max(CASE WHEN rf = 1 THEN o_orderstatus END) AS first_status,
  max(CASE WHEN rp = 1 THEN o_totalprice END) AS top_prio_price
FROM x GROUP BY 1
""")
def keep_first_last(t: Tables) -> DataFrame:
    def kept(order: str, desc: bool, **names: str) -> DataFrame:
        out = keep_first(t.orders, "o_custkey", order, list(names.values()), desc)
        return out.select("o_custkey", *[F.col(c).alias(n) for n, c in names.items()])

    last = kept("o_orderdate", True, last_price="o_totalprice", last_status="o_orderstatus")
    first = kept("o_orderdate", False, first_price="o_totalprice", first_status="o_orderstatus")
    prio = kept("o_orderpriority", False, top_prio_price="o_totalprice")
    return last.join(first, "o_custkey").join(prio, "o_custkey")


@report("listagg_ordered", """
SELECT o_custkey, string_agg(o_orderpriority, ';' ORDER BY o_orderdate, o_orderkey) AS priorities FROM orders GROUP BY 1
""")
def listagg_ordered(t: Tables) -> DataFrame:
    return list_agg(t.orders, "o_custkey", "o_orderpriority", ["o_orderdate", "o_orderkey"], ";", name="priorities", repeats=False)


@report("listagg_distinct", """
SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS priorities FROM orders GROUP BY 1
""")
def listagg_distinct(t: Tables) -> DataFrame:
    return list_agg(t.orders, "o_custkey", "o_orderpriority", distinct=True, name="priorities")


WORD_CODES = [("red", "C1"), ("blue", "C2"), ("hot", "T1"), ("cold", "T2"), ("ring", "S1"), ("bolt", "S2"), ("rod", "S3")]


@report("split_regroup", """
WITH w(item, code) AS (VALUES ('red', 'C1'), ('blue', 'C2'), ('hot', 'T1'), ('cold', 'T2'), ('ring', 'S1'), ('bolt', 'S2'), ('rod', 'S3')),
s AS (SELECT p_partkey, 1 AS pos, split_part(p_name, ' ', 1) AS item FROM part UNION ALL SELECT p_partkey, 2, split_part(p_name, ' ', 2) FROM part)
SELECT p_partkey, string_agg(code, ',' ORDER BY pos) AS codes FROM s JOIN w USING (item) GROUP BY 1
""")
def split_regroup(t: Tables) -> DataFrame:
    """List text split to items, each looked up, and listed again. Distinct texts are worked once."""
    words = constant_rows(t.spark, WORD_CODES, "word string, code string")
    texts = t.part.select(F.translate("p_name", " ", ",").alias("items")).distinct()
    coded = regroup(texts.withColumn("k", F.col("items")), ["k"], "items", words, "word", "code", name="codes")
    return t.part.select("p_partkey", F.translate("p_name", " ", ",").alias("k")).join(coded.where("codes is not null"), "k").drop("k")


@report("split_rows", """
SELECT o_orderkey, CAST(pos AS INTEGER) AS pos, split_part(o_orderpriority || '-' || o_orderstatus, '-', CAST(pos AS INTEGER)) AS item
FROM orders CROSS JOIN (VALUES (1), (2), (3)) v(pos)
""")
def split_to_rows(t: Tables) -> DataFrame:
    listed = t.orders.select("o_orderkey", F.concat_ws("-", "o_orderpriority", "o_orderstatus").alias("items"))
    return split_rows(listed, "items", "-").select("o_orderkey", "pos", "item")


@report("number_generator", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, n FROM lineitem, LATERAL (SELECT unnest(generate_series(1, l_linenumber)) AS n)
""")
def number_generator(t: Tables) -> DataFrame:
    out = number_rows(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity"), "l_linenumber")
    return out.withColumn("n", F.col("n").cast("bigint"))


@report("count_distinct_mix", """
SELECT l_returnflag, count(*) AS row_cnt, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_orderkey) AS orders,
  round(CAST(count(*) AS DOUBLE) / count(DISTINCT l_orderkey), 6) AS per_order FROM lineitem GROUP BY 1
""")
def count_distinct_mix(t: Tables) -> DataFrame:
    out = t.lineitem.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("row_cnt"), F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_orderkey").alias("orders")
    )
    return out.withColumn("per_order", F.round(F.col("row_cnt").cast("double") / F.col("orders"), 6))


@report("duplicate_keys", """
SELECT CAST(sum(n) AS BIGINT) AS row_cnt, count(*) AS key_cnt, CAST(sum(n - 1) AS BIGINT) AS dup_cnt FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
""")
def duplicate_key_audit(t: Tables) -> DataFrame:
    return duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@report("subtotals_averages", """
WITH d AS (SELECT n_name, c_mktsegment, CAST(sum(CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT)) AS BIGINT) AS v, count(*) AS c
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2),
s AS (SELECT n_name, CAST(sum(v) AS BIGINT) AS v, CAST(sum(c) AS BIGINT) AS c, count(*) AS n FROM d GROUP BY 1),
a AS (SELECT CAST(sum(v) AS BIGINT) AS v, CAST(sum(c) AS BIGINT) AS c, count(*) AS n FROM s)
SELECT n_name, c_mktsegment, v / 100.0 AS amt, CAST(c AS DOUBLE) AS cnt, 'N' AS summ_fig FROM d
UNION ALL SELECT n_name, n_name || ' Total', v / 100.0, CAST(c AS DOUBLE), 'Y' FROM s
UNION ALL SELECT n_name, n_name || ' Average', ((v * 20 + n) // (2 * n)) / 1000.0, ((c * 2000 + n) // (2 * n)) / 1000.0, 'Y' FROM s
UNION ALL SELECT 'All', 'All Total', v / 100.0, CAST(c AS DOUBLE), 'Y' FROM a
UNION ALL SELECT 'All', 'All Average', ((v * 20 + n) // (2 * n)) / 1000.0, ((c * 2000 + n) // (2 * n)) / 1000.0, 'Y' FROM a
""")
def subtotals_averages(t: Tables) -> DataFrame:
    per_cust = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg((F.sum(cents("o_totalprice")).cast("decimal(20,0)") * F.lit(0.01).cast("decimal(3,2)")).alias("amt"), F.count(F.lit(1)).alias("cnt"))
    who = t.customer.join(t.nation, t.customer.c_nationkey == t.nation.n_nationkey).select("c_custkey", "n_name", "c_mktsegment")
    out = with_subtotals(per_cust.join(who, "c_custkey"), "n_name", "c_mktsegment", ["amt", "cnt"])
    return out.withColumns({m: F.col(m).cast("double") for m in ("amt", "cnt")})


@report("conditional_kpis", """
SELECT c_mktsegment, count(*) AS reach, count(*) FILTER (WHERE o_totalprice > 250000) AS hit,
  CAST(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS done_amt,
  round(count(*) FILTER (WHERE o_totalprice > 250000) / CAST(count(*) AS DOUBLE), 6) AS hit_rate,
  CASE WHEN count(*) FILTER (WHERE o_totalprice < 0) = 0 THEN 0.0::DOUBLE ELSE 1 / count(*) END AS no_rate
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1
""")
def conditional_kpis(t: Tables) -> DataFrame:
    seg = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    price = F.col("o_totalprice")
    out = join_eq(t.orders, seg, "o_custkey").groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("reach"), F.count_if(price > 250000).alias("hit"),
        from_cents(F.sum(F.when(F.col("o_orderstatus") == "F", cents("o_totalprice")).otherwise(0))).alias("done_amt"),
        F.count_if(price < 0).alias("none"),
    )
    return out.select(
        "c_mktsegment", "reach", "hit", "done_amt", F.round(ratio("hit", F.col("reach").cast("double")), 6).alias("hit_rate"),
        ratio("reach", "none").cast("double").alias("no_rate"),
    )


_KPI_SQL = """
b AS (SELECT c_mktsegment AS seg, count(*) AS reach, count(*) FILTER (WHERE o_totalprice > 250000) AS hit FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1),
a AS (SELECT * FROM b UNION ALL SELECT 'Total', CAST(sum(reach) AS BIGINT), CAST(sum(hit) AS BIGINT) FROM b),
k AS (SELECT *, (hit * 20000 + reach) // (2 * reach) AS p FROM a),
c AS (
  SELECT 0 AS row_num, 'Segment' AS label, seg, seg AS val FROM k
  UNION ALL SELECT 1, 'Reach', seg, CAST(reach AS VARCHAR) FROM k
  UNION ALL SELECT 2, 'Hit', seg, CAST(hit AS VARCHAR) FROM k
  UNION ALL SELECT 3, 'Hit rate', seg, CAST(p // 100 AS VARCHAR) || '.' || lpad(CAST(p % 100 AS VARCHAR), 2, '0') || '%' FROM k)
"""


@report("kpi_matrix_pivot", f"""
WITH {_KPI_SQL}
SELECT row_num, label, max(CASE WHEN seg = 'AUTOMOBILE' THEN val END) AS "AUTOMOBILE", max(CASE WHEN seg = 'BUILDING' THEN val END) AS "BUILDING",
  max(CASE WHEN seg = 'FURNITURE' THEN val END) AS "FURNITURE", max(CASE WHEN seg = 'HOUSEHOLD' THEN val END) AS "HOUSEHOLD",
  max(CASE WHEN seg = 'MACHINERY' THEN val END) AS "MACHINERY", max(CASE WHEN seg = 'Total' THEN val END) AS "Total"
FROM c GROUP BY 1, 2
""")
def kpi_matrix_pivot(t: Tables) -> DataFrame:
    """KPI lines by segment and Total, as text cells; the columns are found in the data."""
    seg = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("seg"))
    base = join_eq(t.orders, seg, "o_custkey").groupBy("seg").agg(
        F.count(F.lit(1)).alias("reach"), F.count_if(F.col("o_totalprice") > 250000).alias("hit")
    )
    whole = base.agg(F.sum("reach").alias("reach"), F.sum("hit").alias("hit")).withColumn("seg", F.lit("Total"))
    facts = stack(base, whole)
    cells = facts.select(
        "seg",
        F.explode(
            F.array(
                F.struct(F.lit(1).alias("row_num"), F.lit("Reach").alias("label"), F.col("reach").cast("string").alias("val")),
                F.struct(F.lit(2).alias("row_num"), F.lit("Hit").alias("label"), F.col("hit").cast("string").alias("val")),
                F.struct(F.lit(3).alias("row_num"), F.lit("Hit rate").alias("label"), pct_text(ratio(F.col("hit").cast("decimal(20,0)"), F.col("reach"))).alias("val")),
            )
        ).alias("c"),
    ).select("seg", "c.*")
    heads = facts.select("seg", F.lit(0).alias("row_num"), F.lit("Segment").alias("label"), F.col("seg").alias("val"))
    return pivot_report(stack(heads, cells), ["row_num", "label"], "seg", "val")


@report("static_pivot", """
SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS "F", count(*) FILTER (WHERE o_orderstatus = 'O') AS "O", count(*) FILTER (WHERE o_orderstatus = 'P') AS "P" FROM orders GROUP BY 1
""")
def static_pivot(t: Tables) -> DataFrame:
    counted = t.orders.groupBy("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("cnt"))
    return pivot_report(counted, ["o_orderpriority"], "o_orderstatus", "cnt", ["F", "O", "P"])


@report("printable_report", f"""
WITH {_KPI_SQL}
SELECT 0 AS part_ord, -1 AS row_num, 'KPI' AS label, NULL::VARCHAR AS seg, NULL::VARCHAR AS val
UNION ALL SELECT 1, row_num, label, seg, val FROM c WHERE row_num IN (1, 2) AND seg <> 'Total'
UNION ALL SELECT 2, 99, 'End', NULL, NULL
""")
def printable_report(t: Tables) -> DataFrame:
    seg = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("seg"))
    rows = join_eq(t.orders, seg, "o_custkey").groupBy("seg").agg(
        F.count(F.lit(1)).alias("reach"), F.count_if(F.col("o_totalprice") > 250000).alias("hit")
    )
    pairs = F.array(
        F.struct(F.lit(1).alias("row_num"), F.lit("Reach").alias("label"), F.col("reach").cast("string").alias("val")),
        F.struct(F.lit(2).alias("row_num"), F.lit("Hit").alias("label"), F.col("hit").cast("string").alias("val")),
    )
    body = rows.select("seg", F.explode(pairs).alias("c")).select("seg", "c.*")
    head = constant_rows(t.spark, [(-1, "KPI")], "row_num int, label string")
    foot = constant_rows(t.spark, [(99, "End")], "row_num int, label string")
    return printable(head, body, foot).select("part_ord", "row_num", "label", "seg", "val")


@report("plan_mix_share", """
WITH d AS (SELECT p_brand, p_type, count(*) AS cnt FROM part GROUP BY 1, 2),
a AS (SELECT * FROM d UNION ALL SELECT 'TOTAL', p_type, CAST(sum(cnt) AS BIGINT) FROM d GROUP BY 2),
s AS (SELECT *, round(cnt / CAST(sum(cnt) OVER (PARTITION BY p_brand) AS DOUBLE), 6) AS share, CAST(dense_rank() OVER (PARTITION BY p_brand ORDER BY p_type) AS INTEGER) AS ord FROM a),
h AS (SELECT DISTINCT p_brand FROM a)
SELECT 1 AS row_ord, p_brand, p_type, cnt, share, ord FROM s UNION ALL SELECT 0, p_brand, 'HEADER', NULL, NULL, NULL FROM h
""")
def plan_mix_share(t: Tables) -> DataFrame:
    """Share of each type within its brand and in TOTAL, with a header line per brand."""
    from millrace.operators import label_order

    mix = t.part.groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("cnt"))
    whole = mix.groupBy("p_type").agg(F.sum("cnt").alias("cnt")).withColumn("p_brand", F.lit("TOTAL"))
    every = stack(mix, whole)
    shared = share(every.withColumn("c", F.col("cnt").cast("double")), "c", "p_brand").withColumn("share", F.round("share", 6)).drop("c")
    detail = label_order(shared, ["p_brand"], "p_type")
    heads = every.select("p_brand").distinct().withColumn("p_type", F.lit("HEADER"))
    return with_header_rows(detail, heads).select("row_ord", "p_brand", "p_type", "cnt", "share", "ord")


@report("whole_set_share", """
SELECT n_name, cnt, round(cnt / CAST(sum(cnt) OVER () AS DOUBLE), 8) AS share FROM (SELECT n_name, count(*) AS cnt FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)
""")
def whole_set_share(t: Tables) -> DataFrame:
    heads = t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("cnt"))
    named = heads.join(t.nation, "n_nationkey").select("n_name", "cnt").withColumn("c", F.col("cnt").cast("double"))
    return share(named, "c").select("n_name", "cnt", F.round("share", 8).alias("share"))


RATES = [("1-URGENT", 0.9), ("2-HIGH", 0.8), ("3-MEDIUM", 0.5)]


@report("signed_contribution", """
WITH r(prio, rate) AS (VALUES ('1-URGENT', 0.90), ('2-HIGH', 0.80), ('3-MEDIUM', 0.50)),
w AS (SELECT n_name, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2)) * coalesce(rate, 1)) AS DOUBLE) AS v FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey LEFT JOIN r ON o_orderpriority = prio GROUP BY 1),
c AS (SELECT n_name, CAST(sum(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS v FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1)
SELECT n_name, round(w.v, 2) AS revenue, round(w.v - coalesce(c.v, 0), 2) AS contribution FROM w LEFT JOIN c USING (n_name)
""")
def signed_contribution(t: Tables) -> DataFrame:
    """Revenue by channel rate less costs, from signed report lines."""
    rates = constant_rows(t.spark, RATES, "o_orderpriority string, rate double").withColumn("rate", F.col("rate").cast("decimal(4,2)"))
    home = t.customer.join(t.nation, t.customer.c_nationkey == t.nation.n_nationkey).select(F.col("c_custkey").alias("o_custkey"), "n_name")
    sold = t.orders.groupBy("o_custkey", "o_orderpriority").agg(F.sum(money("o_totalprice")).alias("amt")).join(home, "o_custkey")
    income = weighted_total(sold, rates, "o_orderpriority", "amt", "rate", ["n_name"], "v")
    costs = t.supplier.join(t.nation, t.supplier.s_nationkey == t.nation.n_nationkey).groupBy("n_name").agg(F.sum(money("s_acctbal")).alias("v"))
    lines = stack(
        income.select("n_name", F.lit("2").alias("line"), F.col("v").cast("decimal(28,4)").alias("v")),
        costs.select("n_name", F.lit("3").alias("line"), F.col("v").cast("decimal(28,4)").alias("v")),
    )
    net = signed_total(lines, "n_name", "line", "v", ["2"], ["3"])
    out = net.join(income, "n_name")
    return out.select("n_name", F.round(F.col("v").cast("double"), 2).alias("revenue"), F.round(F.col("contribution").cast("double"), 2).alias("contribution"))


@report("events_per_day", "SELECT CAST(ts AS DATE) AS day, count(*) AS cnt FROM events GROUP BY 1")
def events_per_day(t: Tables) -> DataFrame:
    return per_day(t.events, "ts")


@report("reconcile_counts", """
SELECT count(*) AS part_cnt, count(*) AS whole_cnt, 'Y' AS balanced, count(*) FILTER (WHERE value > 10) AS good_cnt FROM events
""")
def reconcile_counts(t: Tables) -> DataFrame:
    """Accepted and rejected rows add up to the rows read."""
    good, bad = split_valid(t.events, F.col("value") > 10)
    kept = good.agg(F.count(F.lit(1)).alias("good_cnt"))
    return reconcile({"good": good, "bad": bad}, t.events).withColumn("good_cnt", kept.scalar())


@report("data_ready", """
SELECT count(DISTINCT date_trunc('year', o_orderdate)) AS periods, count(*) AS row_cnt, 'Y' AS ready FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'
""")
def data_ready(t: Tables) -> DataFrame:
    o = orders(t).withColumn("year", F.trunc("o_orderdate", "YEAR"))
    inside = (F.col("o_orderdate") >= F.to_date(F.lit("1996-01-01"))) & (F.col("o_orderdate") < F.to_date(F.lit("1997-01-01")))
    return ready(o, inside, "year")


@report("listagg_pieces", """
WITH n AS (SELECT o_orderstatus, o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderpriority, o_orderkey) - 1 AS pos FROM orders)
SELECT o_orderstatus, pos // 500 AS piece, CAST(count(*) AS BIGINT) AS items, string_agg(CAST(o_orderkey AS VARCHAR), ';' ORDER BY pos) AS order_list FROM n GROUP BY 1, 2
""")
def listagg_pieces(t: Tables) -> DataFrame:
    """Ordered lists of a few groups that hold all rows, as pieces of 500 values."""
    return list_pieces(t.orders, ["o_orderstatus"], "o_orderkey", ["o_orderpriority", "o_orderkey"], ";", 500, name="order_list")


@report("listagg_repeats", """
WITH n AS (SELECT l_linestatus, l_returnflag, row_number() OVER (PARTITION BY l_linestatus ORDER BY l_returnflag) - 1 AS pos FROM lineitem)
SELECT l_linestatus, pos // 1000 AS piece, CAST(count(*) AS BIGINT) AS items, string_agg(l_returnflag, '' ORDER BY pos) AS flags FROM n GROUP BY 1, 2
""")
def listagg_repeats(t: Tables) -> DataFrame:
    """The same where a group is a few values, each repeated many times."""
    return list_pieces(t.lineitem, ["l_linestatus"], "l_returnflag", ["l_returnflag"], "", 1000, name="flags")
