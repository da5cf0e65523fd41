"""Reports on predicates, projections, scalar functions and ordered rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace import functions as X
from millrace.operators import (
    apply_match, apply_rules, cluster, drop_where, modulo_parts, previous_row, select_where, stack, top,
    update_from_agg,
)
from millrace.params import NO_DATE, OPEN_DATE
from millrace.reports.common import day, lines, orders, priority_history, total
from millrace.reports.registry import report
from millrace.sources.readers import json_struct, key_lookup, wide_column_view
from millrace.sources.tables import Tables


@report("predicates", """
SELECT p_partkey, p_name, p_brand, p_type, p_size FROM part
WHERE p_size BETWEEN 5 AND 40 AND (p_name LIKE 'red %' OR p_name LIKE '%o%t%' OR p_name LIKE '%ring')
  AND p_type IN ('PROMO', 'STANDARD', 'SMALL') AND p_type NOT IN ('LARGE')
  AND regexp_matches(p_brand, '^Brand#[0-9]{2}$') AND upper(p_name) <> 'RED BOLT'
""")
def predicates(t: Tables) -> DataFrame:
    name = F.col("p_name")
    return select_where(
        t.part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size"),
        F.col("p_size").between(5, 40)
        & (name.startswith("red ") | name.like("%o%t%") | name.endswith("ring"))
        & F.col("p_type").isin("PROMO", "STANDARD", "SMALL")
        & ~F.col("p_type").isin("LARGE")
        & F.col("p_brand").rlike("^Brand#[0-9]{2}$")
        & (F.upper(name) != "RED BOLT"),
    )


@report("union_distinct", """
SELECT o_custkey, o_orderstatus FROM orders WHERE o_totalprice > 300000
UNION SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderpriority = '1-URGENT'
""")
def union_distinct(t: Tables) -> DataFrame:
    rich = t.orders.where("o_totalprice > 300000").select("o_custkey", "o_orderstatus")
    urgent = t.orders.where("o_orderpriority = '1-URGENT'").select("o_custkey", "o_orderstatus")
    return stack(rich, urgent, distinct=True)


@report("union_all_sources", """
SELECT 'PENDING' AS origin, o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT 'COMPLETE', o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'
""")
def union_all_sources(t: Tables) -> DataFrame:
    def part(label: str, status: str) -> DataFrame:
        return t.orders.where(F.col("o_orderstatus") == status).select(F.lit(label).alias("origin"), "o_orderkey", "o_custkey")

    return stack(part("PENDING", "P"), part("COMPLETE", "F"))


PLAN_LABELS = {
    "ECONOMY": "05. Low tier",
    "STANDARD": "03. Mid tier",
    "MEDIUM": "03. Mid tier",
    "LARGE": "02. High tier",
    "PROMO": "01. Unlimited",
}


@report("plan_group_case", """
SELECT p_partkey,
  CASE p_type WHEN 'ECONOMY' THEN '05. Low tier' WHEN 'STANDARD' THEN '03. Mid tier' WHEN 'MEDIUM' THEN '03. Mid tier'
    WHEN 'LARGE' THEN '02. High tier' WHEN 'PROMO' THEN '01. Unlimited' ELSE '12. Other plans' END AS plan_grp,
  CASE p_type WHEN 'ECONOMY' THEN 5 WHEN 'STANDARD' THEN 3 WHEN 'MEDIUM' THEN 3 WHEN 'LARGE' THEN 2 WHEN 'PROMO' THEN 1 ELSE 12 END AS tier,
  CASE WHEN p_size > 40 THEN 'XL' WHEN p_size > 25 AND p_name LIKE 'hot%' THEN 'HOT' WHEN p_size > 10 THEN 'M' ELSE 'S' END AS size_cd
FROM part
""")
def plan_group_case(t: Tables) -> DataFrame:
    label = X.plan_group("p_type", PLAN_LABELS, "12. Other plans")
    size = F.col("p_size")
    return t.part.select(
        "p_partkey",
        label.alias("plan_grp"),
        X.plan_tier(label).alias("tier"),
        X.first_match([(size > 40, "XL"), ((size > 25) & F.col("p_name").like("hot%"), "HOT"), (size > 10, "M")], "S").alias("size_cd"),
    )


@report("decode_nvl", """
SELECT o_orderkey,
  CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'open' ELSE 'other' END AS status_nm,
  coalesce(nullif(o_orderpriority, '5-LOW'), 'none') AS prio,
  CASE WHEN nullif(o_orderstatus, 'P') IS NULL THEN 'was null' WHEN o_orderstatus = 'O' THEN 'o' ELSE 'x' END AS null_match,
  CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN substr(o_orderpriority, 3) ELSE o_orderstatus END AS shown,
  CASE WHEN regexp_matches(substr(o_orderpriority, 3), '^[0-9.]+$') THEN 1.0 ELSE 0.0 END + CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS num
FROM orders
""")
def decode_nvl(t: Tables) -> DataFrame:
    prio = F.col("o_orderpriority")
    high = F.when(F.substring(prio, 1, 1).isin("1", "2"), F.substr(prio, F.lit(3))).otherwise(F.lit(" "))
    return t.orders.select(
        "o_orderkey",
        X.decode("o_orderstatus", ("F", "done"), ("O", "open"), default="other").alias("status_nm"),
        F.coalesce(F.nullif(prio, F.lit("5-LOW")), F.lit("none")).alias("prio"),
        X.decode(F.nullif("o_orderstatus", F.lit("P")), (None, "was null"), ("O", "o"), default="x").alias("null_match"),
        X.override(high, "o_orderstatus").alias("shown"),
        (X.clean_number(F.substr(prio, F.lit(3))) + X.clean_number(F.substring(prio, 1, 1))).cast("double").alias("num"),
    )


@report("blank_sentinels", """
SELECT o_orderkey, o_orderstatus = 'P' AS is_blank, o_orderstatus IN ('P', 'F') AS is_no_code,
  o_orderstatus <> 'O' AS is_no_date,
  CASE WHEN o_orderstatus = 'P' THEN ' ' ELSE o_orderstatus END AS shown
FROM orders
""")
def blank_sentinels(t: Tables) -> DataFrame:
    status = F.col("o_orderstatus")
    code = F.when(status == "P", F.lit("  ")).when(status == "F", F.lit("NA")).otherwise(status)
    when = F.when(status == "P", F.lit(NO_DATE)).when(status == "F", F.lit(OPEN_DATE)).otherwise(day("o_orderdate"))
    return t.orders.select(
        "o_orderkey",
        X.blank(code).alias("is_blank"),
        X.no_code(code).alias("is_no_code"),
        X.no_date(when).alias("is_no_date"),
        X.nvl_blank(F.nullif(status, F.lit("P"))).alias("shown"),
    )


@report("update_rules", """
WITH a AS (
  SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice,
    CASE WHEN l_returnflag = 'R' THEN 'RETURN' ELSE 'SALE' END AS k0
  FROM lineitem WHERE NOT (l_linestatus = 'O' AND l_quantity < 3)),
b AS (SELECT *, CASE WHEN k0 = 'SALE' AND l_quantity >= 40 THEN 'BULK' ELSE k0 END AS kind FROM a),
m AS (SELECT l_partkey, min(l_quantity) AS q FROM lineitem GROUP BY 1)
SELECT b.l_orderkey, b.l_partkey, b.l_linenumber, kind,
  CASE kind WHEN 'BULK' THEN 'B' WHEN 'RETURN' THEN 'R' ELSE 'S' END || CASE WHEN p_type = 'PROMO' THEN '+' ELSE '' END AS code,
  CASE WHEN kind = 'BULK' THEN m.q ELSE b.l_quantity END AS qty
FROM b JOIN m USING (l_partkey) JOIN part ON b.l_partkey = p_partkey
""")
def update_rules(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus")
    rows = drop_where(rows, (F.col("l_linestatus") == "O") & (F.col("l_quantity") < 3))
    rows = rows.withColumns({"kind": F.lit("SALE"), "code": F.lit("S"), "qty": F.col("l_quantity")})
    rows = apply_rules(
        rows,
        [
            ("l_returnflag = 'R'", {"kind": F.lit("RETURN")}),
            ("kind = 'SALE' and l_quantity >= 40", {"kind": F.lit("BULK")}),
            ("kind = 'BULK'", {"code": F.lit("B")}),
            ("kind = 'RETURN'", {"code": F.lit("R")}),
        ],
    )
    rows = update_from_agg(rows, t.lineitem, ["l_partkey"], {"qty": F.min("l_quantity")}, F.col("kind") == "BULK")
    promo = t.part.where("p_type = 'PROMO'").select(F.col("p_partkey").alias("l_partkey"), F.lit("+").alias("mark"))
    rows = apply_match(rows, promo, ["l_partkey"], {"code": F.concat("code", "m_mark")})
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", "kind", "code", "qty")


@report("date_repair", """
WITH a AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) * 6 AS n, o_orderstatus AS s FROM orders),
b AS (
  SELECT *, CASE s WHEN 'O' THEN DATE '1900-01-01' ELSE d END AS start0, CASE s WHEN 'F' THEN DATE '2999-12-31' WHEN 'P' THEN NULL ELSE d END AS end0 FROM a),
c AS (
  SELECT *, CAST(d - n * INTERVAL 1 MONTH AS DATE) AS back, CAST(d + n * INTERVAL 1 MONTH AS DATE) AS forth FROM b)
SELECT o_orderkey,
  CASE WHEN s = 'O' THEN CASE WHEN d = last_day(d) THEN last_day(back) ELSE back END + 1 ELSE start0 END AS ld_start,
  CASE WHEN s <> 'O' THEN CASE WHEN d = last_day(d) THEN last_day(forth) ELSE forth END - 1 ELSE end0 END AS ld_end,
  CAST(date_trunc('month', d) AS DATE) AS month_start, last_day(d) AS month_end, d + 7 AS week_later,
  CAST(d - DATE '1995-01-01' AS INTEGER) AS days_in, greatest(d, DATE '1998-06-15') AS later_of
FROM c
""")
def date_repair(t: Tables) -> DataFrame:
    d, status = F.col("o_orderdate"), F.col("o_orderstatus")
    months = F.substring("o_orderpriority", 1, 1).cast("int") * 6
    rows = orders(t).select(
        "o_orderkey",
        d.alias("d"),
        F.when(status == "O", F.lit(NO_DATE)).otherwise(d).alias("s0"),
        F.when(status == "F", F.lit(OPEN_DATE)).when(status == "P", F.lit(None)).otherwise(d).alias("e0"),
        F.concat(F.lit("LDC"), F.lpad(months.cast("string"), 2, "0"), F.lit("X")).alias("code"),
    )
    return rows.select(
        "o_orderkey",
        X.repair_start("s0", "e0", "code").alias("ld_start"),
        X.repair_end("s0", "e0", "code").alias("ld_end"),
        X.month_start("d").alias("month_start"),
        F.last_day("d").alias("month_end"),
        F.date_add("d", 7).alias("week_later"),
        F.datediff("d", F.to_date(F.lit("1995-01-01"))).alias("days_in"),
        X.greatest_strict("d", F.to_date(F.lit("1998-06-15"))).alias("later_of"),
    )


def _contracts(t: Tables) -> DataFrame:
    """Orders read as contracts: the one before of the same customer is the one replaced."""
    rows = orders(t).select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").alias("start"),
        F.add_months("o_orderdate", F.substring("o_orderpriority", 1, 1).cast("int") * 6).alias("end"),
        F.round(X.money("o_totalprice") / 1000, 2).cast("decimal(12,2)").alias("bill"),
        F.when(F.col("o_orderstatus") == "F", "INV_REBATE").when(F.col("o_orderstatus") == "O", "MKT_REBATE").otherwise(" ").alias("flag"),
        F.when(F.col("o_orderstatus") == "P", F.lit(0)).otherwise(F.lit(-25)).cast("decimal(12,2)").alias("rebate"),
        (F.substring("o_orderpriority", 1, 1).cast("int") * 100).cast("decimal(12,2)").alias("subsidy"),
    )
    cols = ["start", "end", "bill", "flag", "rebate", "subsidy", "o_orderkey"]
    return previous_row(rows, "o_custkey", ["start", "o_orderkey"], cols, prefix="old_")


@report("contract_value", """
WITH a AS (
  SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS st, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS p,
    o_orderstatus AS s, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS cents FROM orders),
b AS (
  SELECT o_orderkey, o_custkey, st, CAST(st + p * 6 * INTERVAL 1 MONTH AS DATE) AS en,
    (cents + 500) // 1000 AS bill, CASE s WHEN 'F' THEN 'I' WHEN 'O' THEN 'M' ELSE ' ' END AS flag,
    CASE s WHEN 'P' THEN 0 ELSE -2500 END AS reb, p * 10000 AS sub FROM a),
c AS (
  SELECT *, lag(o_orderkey) OVER w AS ok, lag(st) OVER w AS ost, lag(en) OVER w AS oen, lag(bill) OVER w AS obill,
    lag(flag) OVER w AS oflag, lag(reb) OVER w AS oreb, lag(sub) OVER w AS osub
  FROM b WINDOW w AS (PARTITION BY o_custkey ORDER BY st, o_orderkey)),
d AS (
  SELECT *, CAST(round((en - st + 1) * 120 / 365.0) AS BIGINT) AS m,
    CASE WHEN ok IS NOT NULL AND oen <> ost THEN CAST(round((oen - ost + 1) * 120 / 365.0) AS BIGINT) ELSE 10 END AS om,
    CASE WHEN coalesce(oen > st, false) THEN 'Y' ELSE 'N' END AS chg,
    CASE WHEN coalesce(oen > st, false) THEN CAST(round((oen - st + 1) * 120 / 365.0) AS BIGINT) ELSE 0 END AS r FROM c),
e AS (
  SELECT *,
    CAST((bill + CASE flag WHEN 'I' THEN reb ELSE 0 END) * m - sub * 10 + CASE flag WHEN 'M' THEN reb * 10 ELSE 0 END
      - CASE WHEN ok IS NULL THEN 0 ELSE (obill + CASE oflag WHEN 'I' THEN oreb ELSE 0 END) * r END AS HUGEINT) AS whole,
    CAST(CASE WHEN ok IS NULL THEN 0 ELSE (CASE WHEN oflag = 'M' AND r > 0 THEN oreb ELSE 0 END - osub) * r END AS HUGEINT) AS num FROM d),
f AS (SELECT *, whole * om - 10 * num AS n, CAST(10 * om AS HUGEINT) AS dn FROM e)
SELECT o_orderkey, m / 10.0 AS contract_mth, om / 10.0 AS old_contract_mth, chg AS chg_plan_flg, r / 10.0 AS remain_contract_mth,
  CAST(sign(n) * ((2 * abs(n) + dn) // (2 * dn)) AS BIGINT) / 100.0 AS tcv
FROM f
""")
def contract_value(t: Tables) -> DataFrame:
    value = X.contract_value(
        start="start", end="end", old_start="old_start", old_end="old_end",
        old_invoice=F.col("old_o_orderkey").cast("string"), bill_rate="bill", rebate="rebate", rebate_flag="flag",
        subsidy="subsidy", old_bill_rate="old_bill", old_rebate="old_rebate", old_rebate_flag="old_flag",
        old_subsidy="old_subsidy",
    )
    shown = {n: c if n == "chg_plan_flg" else c.cast("double") for n, c in value.items()}
    return _contracts(t).select("o_orderkey", *[c.alias(n) for n, c in shown.items()])


@report("retention_upgrade", """
WITH a AS (
  SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS d,
    lead(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS nd FROM orders)
SELECT o_orderkey, date_diff('month', date_trunc('month', d), date_trunc('month', nd)) AS gap_months,
  CASE WHEN nd IS NULL THEN 'RETENTION'
    WHEN date_diff('month', date_trunc('month', d), date_trunc('month', nd)) <= 3 THEN 'RETENTION' ELSE 'UPGRADE' END AS trx_type
FROM a
""")
def retention_upgrade(t: Tables) -> DataFrame:
    from millrace.operators import next_row

    rows = orders(t).select("o_orderkey", "o_custkey", F.col("o_orderdate").alias("d"))
    nxt = next_row(rows, "o_custkey", ["d", "o_orderkey"], ["d"], prefix="n_")
    gap = F.months_between(X.month_start("n_d"), X.month_start("d"))
    return nxt.select(
        "o_orderkey",
        X.month_gap("n_d", "d").cast("bigint").alias("gap_months"),
        F.when(F.col("n_d").isNull() | (gap <= 3), "RETENTION").otherwise("UPGRADE").alias("trx_type"),
    )


def _addresses(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    return t.customer.select(
        "c_custkey",
        F.concat_ws(".", F.lit("10"), F.pmod(F.floor(k / 62500), F.lit(250)).cast("string"), F.pmod(F.floor(k / 250), F.lit(250)).cast("string"), F.pmod(k, F.lit(250)).cast("string")).alias("ip"),
    )


_ADDRESSES_SQL = """
a AS (SELECT c_custkey, '10.' || CAST((c_custkey // 62500) % 250 AS VARCHAR) || '.' || CAST((c_custkey // 250) % 250 AS VARCHAR) || '.' || CAST(c_custkey % 250 AS VARCHAR) AS ip FROM customer)
"""


@report("ip_key", f"""
WITH {_ADDRESSES_SQL},
b AS (SELECT *, lpad(split_part(ip, '.', 1), 3, '0') AS p1, lpad(split_part(ip, '.', 2), 3, '0') AS p2, lpad(split_part(ip, '.', 3), 3, '0') AS p3, lpad(split_part(ip, '.', 4), 3, '0') AS p4 FROM a)
SELECT c_custkey, ip, p1 || '.' || p2 || '.' || p3 || '.' || p4 AS ip_key, CAST(p1 || p2 || p3 || p4 AS BIGINT) AS ip_num, ip AS ip_back,
  CAST(split_part(ip, '.', 3) AS INTEGER) AS octet3, CAST(split_part(ip, '.', 4) AS INTEGER) // 26 AS bucket
FROM b
""")
def ip_key(t: Tables) -> DataFrame:
    key = X.ip_key("ip")
    return _addresses(t).select(
        "c_custkey", "ip", key.alias("ip_key"), X.ip_long("ip").alias("ip_num"),
        X.ip_from_key(F.translate(key, ".", "")).alias("ip_back"),
        X.octet_bucket("ip", 3).alias("octet3"), X.octet_bucket("ip", 4, 26).alias("bucket"),
    )


@report("row_key", """
SELECT event_id, lpad('10', 3, '0') || '.000.' || lpad(CAST((user_id // 250) % 250 AS VARCHAR), 3, '0') || '.' || lpad(CAST(user_id % 250 AS VARCHAR), 3, '0')
  || '_' || strftime(ts, '%Y%m%d%H%M%S') || '_' || event_type AS row_key,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS start_datetime,
  regexp_matches(strftime(ts, '%Y-%m-%d'), '^20[0-9]{2}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])$') AS date_ok
FROM events
""")
def row_key(t: Tables) -> DataFrame:
    u = F.col("user_id")
    ip = F.concat_ws(".", F.lit("10"), F.lit("0"), F.pmod(F.floor(u / 250), F.lit(250)).cast("string"), F.pmod(u, F.lit(250)).cast("string"))
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return t.events.select(
        "event_id", X.row_key(ip, text, "event_type").alias("row_key"), text.alias("start_datetime"),
        X.is_date_text(F.substring(text, 1, 10)).alias("date_ok"),
    )


@report("text_clean", """
SELECT c_custkey, substr(c_name, 10) AS tail, right(c_name, 3) AS last3, replace(c_name, '#', ':') AS swapped,
  upper(c_mktsegment) || '-' || CAST(c_custkey AS VARCHAR) AS id, CAST(length(c_name) AS INTEGER) AS len,
  split_part(c_name, '#', 2) AS seg2, split_part(c_name, '#', 1) AS seg1,
  CAST(CASE WHEN regexp_matches(split_part(c_name, '#', 2), '^[0-9]+$') THEN CAST(split_part(c_name, '#', 2) AS BIGINT) ELSE 0 END AS BIGINT) AS num,
  CAST(0 AS BIGINT) AS not_num, 'Cust' || 'mer' AS cut, CAST(2 AS INTEGER) AS tokens, c_mktsegment AS token2,
  CAST(round(abs(c_acctbal)) AS BIGINT) AS bal, make_date(CAST(2000 + c_nationkey AS BIGINT), 3, 7) AS from_yy,
  'x' || trim('  ' || c_mktsegment || ' ') AS trimmed
FROM customer
""")
def text_clean(t: Tables) -> DataFrame:
    name = F.col("c_name")
    listed = F.concat_ws(",", name, "c_mktsegment")
    return t.customer.select(
        "c_custkey",
        F.substr(name, F.lit(10)).alias("tail"),
        F.substring(name, -3, 3).alias("last3"),
        F.replace(name, F.lit("#"), F.lit(":")).alias("swapped"),
        X.composite_id(F.upper("c_mktsegment"), "c_custkey").alias("id"),
        F.length(name).alias("len"),
        X.nth_segment(name, "#", 2).alias("seg2"),
        F.substring_index(name, "#", 1).alias("seg1"),
        X.clean_int(X.nth_segment(name, "#", 2)).alias("num"),
        X.clean_int(name).alias("not_num"),
        F.regexp_replace(F.substring_index(name, "#", 1), "o", "").alias("cut"),
        X.token_count(listed).cast("int").alias("tokens"),
        X.nth_token(listed, 2).alias("token2"),
        F.round(F.abs("c_acctbal")).cast("bigint").alias("bal"),
        X.year2_date(F.concat(F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), F.lit("0307"))).alias("from_yy"),
        X.concat_text(F.lit("x"), F.lit(None), F.trim(F.concat(F.lit("  "), "c_mktsegment", F.lit(" ")))).alias("trimmed"),
    )


@report("tier_string", """
SELECT p_partkey, '0-12:' || CAST(p_size * 1000 AS VARCHAR) || '|13-24:' || CASE WHEN p_size > 25 THEN '0' ELSE CAST(p_size AS VARCHAR) END || '|25-36:0' AS tiers
FROM part
""")
def tier_string(t: Tables) -> DataFrame:
    size = F.col("p_size")
    text = t.part.select(
        "p_partkey",
        F.concat(F.lit("$"), F.format_number(size * 1000, 0)).alias("y1"),
        F.when(size > 25, F.lit(" ")).otherwise(F.concat(F.lit("$"), size.cast("string"))).alias("y2"),
        F.lit(None).cast("string").alias("y3"),
    )
    return text.select("p_partkey", X.tier_string(("0-12", "y1"), ("13-24", "y2"), ("25-36", "y3")).alias("tiers"))


@report("json_fields", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, CAST(0 AS DOUBLE) AS absent,
  '{"event_type":"' || event_type || '","user_id":' || CAST(user_id AS VARCHAR) || '}' AS packed
FROM events
""")
def json_fields(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id",
        X.json_number("props", "k").cast("double").alias("k"),
        X.json_number("props", "missing").cast("double").alias("absent"),
        json_struct(event_type="event_type", user_id="user_id").alias("packed"),
    )


def _wide(t: Tables, kind: str) -> DataFrame:
    rows = t.events.where(F.col("event_type") == kind)
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return rows.select(
        F.concat_ws("_", F.lpad(F.col("user_id").cast("string"), 9, "0"), X.compact_time(text)).alias("row_key"),
        F.create_map(
            F.lit("src"), F.col("user_id").cast("string"), F.lit("start_datetime"), text, F.lit("service"), "event_type",
            F.lit("json_value"), json_struct(send_volume=F.get_json_object("props", "$.k")),
        ).alias("cf"),
    )


_WIDE_SQL = """
v AS (SELECT lpad(CAST(user_id AS VARCHAR), 9, '0') || '_' || strftime(ts, '%Y%m%d%H%M%S') AS row_key, CAST(user_id AS VARCHAR) AS src,
    date_trunc('second', ts) AS start_datetime, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS send_volume, CAST(0 AS DOUBLE) AS receive_volume, event_type AS service
  FROM events)
"""


def _flat(t: Tables) -> DataFrame:
    v = wide_column_view([_wide(t, k) for k in ("view", "click", "purchase", "signup", "error")])
    return v.select(
        "row_key", "src", F.col("start_datetime").cast("timestamp_ntz").alias("start_datetime"),
        F.col("send_volume").cast("double").alias("send_volume"), F.col("receive_volume").cast("double").alias("receive_volume"), "service",
    )


@report("wide_column_view", f"WITH {_WIDE_SQL} SELECT * FROM v")
def wide_view(t: Tables) -> DataFrame:
    return _flat(t)


@report("key_prefix_lookup", f"""
WITH {_WIDE_SQL}
SELECT 'prefix' AS lookup, * FROM v WHERE row_key LIKE '000000007\\_%' ESCAPE '\\' AND src = '7'
UNION ALL SELECT 'range', * FROM v WHERE row_key >= '000000020_20240110000000' AND row_key <= '000000024_20240120000000'
""")
def key_prefix_lookup(t: Tables) -> DataFrame:
    v = _flat(t)
    near = key_lookup(v, prefix="000000007_", src="7").select(F.lit("prefix").alias("lookup"), "*")
    span = key_lookup(v, low="000000020_20240110000000", high="000000024_20240120000000").select(F.lit("range").alias("lookup"), "*")
    return stack(near, span)


@report("pick_latest", """
WITH a AS (SELECT o_custkey, max(o_orderdate) AS ad, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS ak FROM orders WHERE o_orderstatus = 'O' GROUP BY 1),
b AS (SELECT o_custkey, max(o_orderdate) AS bd, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS bk FROM orders WHERE o_orderstatus = 'P' GROUP BY 1)
SELECT c_custkey, CASE WHEN bk IS NULL THEN CAST(ak AS VARCHAR) WHEN ak IS NULL THEN CAST(bk AS VARCHAR)
  WHEN ad > bd OR (ad = bd AND ak >= bk) THEN CAST(ak AS VARCHAR) ELSE CAST(bk AS VARCHAR) END AS latest
FROM customer LEFT JOIN a ON c_custkey = a.o_custkey LEFT JOIN b ON c_custkey = b.o_custkey
""")
def pick_latest(t: Tables) -> DataFrame:
    def last(status: str, p: str) -> DataFrame:
        top_row = F.max(F.struct("o_orderdate", "o_orderkey"))
        rows = t.orders.where(F.col("o_orderstatus") == status).groupBy(F.col("o_custkey").alias("c_custkey")).agg(top_row.alias("m"))
        return rows.select("c_custkey", F.col("m.o_orderdate").alias(p + "d"), F.col("m.o_orderkey").alias(p + "k"))

    both = t.customer.select("c_custkey").join(last("O", "a"), "c_custkey", "left").join(last("P", "b"), "c_custkey", "left")
    a, b = F.col("ak").cast("string"), F.col("bk").cast("string")
    return both.select("c_custkey", X.pick_latest(a, b, ["ad", "ak"], ["bd", "bk"]).alias("latest"))


@report("sort_limit", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY CAST(substr(o_orderpriority, 1, 1) AS INTEGER), o_totalprice DESC, o_orderkey LIMIT 25
""")
def sort_limit(t: Tables) -> DataFrame:
    keys = [F.substring("o_orderpriority", 1, 1).cast("int"), F.col("o_totalprice").desc(), F.col("o_orderkey")]
    return top(t.orders, keys, 25).select("o_orderkey", "o_totalprice")


@report("sort_within_partitions", """
SELECT l_suppkey % 17 AS part_no, count(*) AS cnt, CAST(0 AS BIGINT) AS out_of_order FROM lineitem GROUP BY 1
""")
def sort_within_partitions(t: Tables) -> DataFrame:
    """Rows placed by key modulo and sorted; the result shows that each part is in order and whole."""
    placed = modulo_parts(t.lineitem.select("l_suppkey"), "l_suppkey", 17)
    placed = placed.withColumns({"pid": F.spark_partition_id(), "seq": F.monotonically_increasing_id()})
    seen = previous_row(placed.withColumn("part_no", F.pmod("l_suppkey", F.lit(17))), ["part_no", "pid"], ["seq"], ["l_suppkey"], F.floor(F.col("seq") / 100000), "p_")
    return seen.groupBy("part_no").agg(
        F.count(F.lit(1)).alias("cnt"), F.count_if(F.col("p_l_suppkey") > F.col("l_suppkey")).alias("out_of_order")
    )


@report("cluster_by_key", """
SELECT o_orderstatus, count(*) AS cnt, round(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE), 2) AS amt FROM orders GROUP BY 1
""")
def cluster_by_key(t: Tables) -> DataFrame:
    """A hot key (a third of the rows per status) spread over salted parts, and still whole."""
    placed = cluster(t.orders.select("o_orderstatus", "o_totalprice", "o_orderkey"), ["o_orderstatus"], sort=["o_orderstatus", "o_orderkey"], salt=8)
    return placed.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("cnt"), total("o_totalprice").alias("amt"))


@report("unit_conversion", """
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate::DATE AS d, l_quantity * 1048576 / 1073741824.0 AS gb, abs(l_quantity - 25) AS dist,
  CASE WHEN l_quantity - 25 = 0 THEN 0 ELSE l_tax / (l_quantity - 25) END AS per_unit FROM lineitem
""")
def unit_conversion(t: Tables) -> DataFrame:
    return lines(t).select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_shipdate").alias("d"),
        X.to_gb(F.col("l_quantity") * 1048576).alias("gb"), F.abs(F.col("l_quantity") - 25).alias("dist"),
        X.ratio("l_tax", F.col("l_quantity") - 25).alias("per_unit"),
    )


@report("history_backfill", """
WITH h AS (SELECT o_custkey, plan, d AS start_date, coalesce(lead(d) OVER (PARTITION BY o_custkey ORDER BY d) - 1, DATE '2999-12-31') AS end_date
  FROM (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, max(o_orderpriority) AS plan FROM orders GROUP BY 1, 2))
SELECT o_custkey, plan, start_date, end_date, CASE WHEN end_date = DATE '2999-12-31' THEN c_mktsegment ELSE ' ' END AS segment FROM h LEFT JOIN customer ON o_custkey = c_custkey
""")
def history_backfill(t: Tables) -> DataFrame:
    """A new column filled by key, on the open row of each history only."""
    hist = priority_history(t).withColumn("segment", F.lit(" "))
    ref = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return apply_match(hist, ref, ["o_custkey"], {"segment": "m_c_mktsegment"}, guard=F.col("end_date") == F.lit(OPEN_DATE))
