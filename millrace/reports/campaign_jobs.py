"""Campaign plans on lines derived from customers and their orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import money, month_start
from millrace.operators import constant_rows
from millrace.plans import campaign
from millrace.reports.common import orders
from millrace.reports.registry import report
from millrace.reports.warehouse import Warehouse, with_tables
from millrace.storage import settle
from millrace.sources.tables import Tables


def _labelled(t: Tables) -> DataFrame:
    """Orders as campaign lines: tier by segment, state by priority, prices before and after."""
    p = F.substring("o_orderpriority", 1, 1).cast("int")
    status = F.col("o_orderstatus")
    seg = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("shk_tier"), F.col("c_nationkey"))
    rows = t.orders.join(seg, "o_custkey").select(
        F.lit("B1").alias("batch_id"), "shk_tier", F.col("o_orderkey").cast("string").alias("subr_num"),
        F.when(F.col("c_nationkey") > 12, "5G_POTENTIAL").otherwise(" ").alias("shk_sale_tag"),
        F.when(p == 1, "Accept Offer").when(p == 2, "Consider").when(p == 3, "Busy").otherwise(" ").alias("pr_final_status"),
        F.when(status == "F", "Outbound").when(status == "O", "Inbound").otherwise(" ").alias("af_channel_effort"),
        F.when(p == 4, "R1").when(p == 2, "R2").otherwise(" ").alias("ru_rule_id"),
        F.when(p == 4, "N1").when(p == 2, "N2").otherwise(" ").alias("ru_plan_mix_nature"),
        F.when(p == 4, "a").when(status == "F", "b").otherwise(" ").alias("ru_plan_mix_sub_nature"),
        F.floor(F.col("o_totalprice") / 1000).cast("decimal(18,2)").alias("bf_avg_net_rev"),
        F.when(status == "P", F.floor(F.col("o_totalprice") / 1000)).when(status == "F", 100).otherwise(400).cast("decimal(18,2)").alias("af_net_price"),
        (p * 100).cast("decimal(18,2)").alias("bf_plan_tariff"), (p * 90 + 10).cast("decimal(18,2)").alias("af_plan_tariff"),
    )
    return campaign.labels(rows)


_LINES = """
src AS (SELECT c_mktsegment AS tier, c_nationkey AS nk, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS p, o_orderstatus AS s, floor(o_totalprice / 1000) AS was FROM orders JOIN customer ON o_custkey = c_custkey),
s2 AS (SELECT *, CASE s WHEN 'P' THEN was WHEN 'F' THEN 100 ELSE 400 END AS now, p IN (2, 4) AS ruled, CASE s WHEN 'F' THEN 'OUTBOUND' WHEN 'O' THEN 'INBOUND' ELSE ' ' END AS ch FROM src),
h AS (SELECT *, CASE WHEN ruled AND was > now THEN 'DOWN_SELL' WHEN ruled AND was = now THEN 'FLAT_SELL' WHEN ruled AND was < now THEN 'UP_SELL' ELSE ' ' END AS sale,
    CASE WHEN p IN (1, 2) THEN 'REACH' ELSE 'NON_REACH' END AS reach,
    CASE WHEN p = 1 AND s = 'F' THEN 'HIT:OUTBOUND' WHEN p = 1 AND s = 'O' THEN 'HIT:INBOUND' WHEN ruled THEN 'HIT:' || ch ELSE ' ' END AS hit,
    CASE WHEN NOT ruled AND ch <> ' ' THEN 'EXCEPT_RULE_UNMAP' ELSE ' ' END AS except_cd FROM s2)"""


@report("campaign_labels", f"WITH {_LINES} SELECT tier AS shk_tier, sale AS cl_sale_type, reach AS cl_reach, hit AS cl_hit, except_cd AS cl_except, count(*) AS cnt FROM h GROUP BY ALL")
def campaign_labels(t: Tables) -> DataFrame:
    by = ["shk_tier", "cl_sale_type", "cl_reach", "cl_hit", "cl_except"]
    return _labelled(t).groupBy(*by).agg(F.count(F.lit(1)).alias("cnt"))


def _pct(n: str, d: str) -> str:
    """Text of n / d as a percentage, rounded half up on integers."""
    return f"""CASE WHEN {d} = 0 THEN '0.00%' ELSE (SELECT CASE WHEN x < 0 THEN '-' ELSE '' END || CAST(abs(x) // 100 AS VARCHAR) || '.' || lpad(CAST(abs(x) % 100 AS VARCHAR), 2, '0') || '%'
      FROM (SELECT CAST(sign({n}) * ((CAST(abs({n}) AS HUGEINT) * 20000 + {d}) // (2 * CAST({d} AS HUGEINT))) AS BIGINT) AS x)) END"""


@report("campaign_kpi_matrix", f"""
WITH {_LINES},
g AS (SELECT tier, count(*) AS size, count(*) FILTER (WHERE nk > 12) AS size_pot, count(*) FILTER (WHERE reach = 'REACH') AS reached, count(*) FILTER (WHERE hit LIKE 'HIT%') AS hits,
  count(*) FILTER (WHERE sale = 'UP_SELL') AS up, count(*) FILTER (WHERE sale = 'FLAT_SELL') AS flat, count(*) FILTER (WHERE sale = 'DOWN_SELL') AS down, count(*) FILTER (WHERE sale LIKE '%SELL') AS sold,
  CAST(sum(CASE WHEN sale = 'DOWN_SELL' THEN p * 100 ELSE 0 END) AS BIGINT) AS bdown, CAST(sum(CASE WHEN sale LIKE '%SELL' THEN p * 100 ELSE 0 END) AS BIGINT) AS bsold, CAST(sum(CASE WHEN sale LIKE '%SELL' THEN p * 90 + 10 ELSE 0 END) AS BIGINT) AS asold
  FROM h GROUP BY 1),
a AS (SELECT * FROM g UNION ALL SELECT 'Total', CAST(sum(size) AS BIGINT), CAST(sum(size_pot) AS BIGINT), CAST(sum(reached) AS BIGINT), CAST(sum(hits) AS BIGINT), CAST(sum(up) AS BIGINT), CAST(sum(flat) AS BIGINT), CAST(sum(down) AS BIGINT), CAST(sum(sold) AS BIGINT), CAST(sum(bdown) AS BIGINT), CAST(sum(bsold) AS BIGINT), CAST(sum(asold) AS BIGINT) FROM g),
c AS (
  SELECT 1 AS row_num, 'KPI' AS label, tier, tier AS v FROM a UNION ALL SELECT 3, 'Target(Plan)', tier, '50%' FROM a
  UNION ALL SELECT 5, 'PTD(Plan)', tier, {_pct('hits', 'size')} FROM a UNION ALL SELECT 6, 'Size', tier, CAST(size AS VARCHAR) FROM a
  UNION ALL SELECT 7, 'Size (5G potential customer)', tier, CAST(size_pot AS VARCHAR) FROM a UNION ALL SELECT 8, 'Reached', tier, CAST(reached AS VARCHAR) FROM a
  UNION ALL SELECT 9, 'Reach %', tier, {_pct('reached', 'size')} FROM a UNION ALL SELECT 10, 'Hit', tier, CAST(hits AS VARCHAR) FROM a
  UNION ALL SELECT 11, 'Hit/Reach%', tier, {_pct('hits', 'reached')} FROM a
  UNION ALL SELECT 23, 'Upsell(%)', tier, {_pct('up', 'sold')} FROM a UNION ALL SELECT 28, 'Upsell(count)', tier, CAST(up AS VARCHAR) FROM a
  UNION ALL SELECT 31, 'Total(count)', tier, CAST(sold AS VARCHAR) FROM a
  UNION ALL SELECT 34, 'Downsell magnitude', tier, {_pct('-bdown', 'asold')} FROM a UNION ALL SELECT 35, 'Overall magnitude', tier, {_pct('bsold', 'asold')} FROM a)
SELECT row_num, label, max(v) FILTER (WHERE tier = 'AUTOMOBILE') AS "AUTOMOBILE", max(v) FILTER (WHERE tier = 'BUILDING') AS "BUILDING", max(v) FILTER (WHERE tier = 'FURNITURE') AS "FURNITURE",
  max(v) FILTER (WHERE tier = 'HOUSEHOLD') AS "HOUSEHOLD", max(v) FILTER (WHERE tier = 'MACHINERY') AS "MACHINERY", max(v) FILTER (WHERE tier = 'Total') AS "Total" FROM c GROUP BY 1, 2
""")
def campaign_kpi_matrix(t: Tables) -> DataFrame:
    """Lines of the KPI matrix that SQL can state exactly; the plan computes all 35."""
    lines = [1, 3, 5, 6, 7, 8, 9, 10, 11, 23, 28, 31, 34, 35]
    return campaign.kpi_matrix(settle(_labelled(t), "campaign_lines"), SEGMENTS).where(F.col("row_num").isin(lines))


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _r10(n: str, d: str) -> str:
    """n / d in units of 10**-10, rounded half up; 0 for d = 0."""
    return f"(CASE WHEN {d} = 0 THEN 0 ELSE (2 * CAST(10000000000 AS HUGEINT) * CAST({n} AS HUGEINT) + {d}) // (2 * CAST({d} AS HUGEINT)) END)"


def _pct10(x: str) -> str:
    """Text of a fraction in units of 10**-10 as a percentage."""
    return f"""(SELECT CASE WHEN {x} < 0 AND k <> 0 THEN '-' ELSE '' END || CAST(k // 100 AS VARCHAR) || '.' || lpad(CAST(k % 100 AS VARCHAR), 2, '0') || '%' FROM (SELECT CAST((2 * abs({x}) + 1000000) // 2000000 AS BIGINT) AS k))"""


def _cents(x: str) -> str:
    return f"(CAST({x} // 100 AS VARCHAR) || '.' || lpad(CAST({x} % 100 AS VARCHAR), 2, '0'))"


_KPI_LINES = {
    1: ("KPI", "tier"), 2: ("Recontract Plan Rate", "' '"), 3: ("Target(Plan)", "'50%'"), 4: ("Gap(Plan)", _pct10(f"({_r10('hits', 'size')} - 5000000000)")),
    5: ("PTD(Plan)", _pct10(_r10("hits", "size"))), 6: ("Size", "CAST(size AS VARCHAR)"), 7: ("Size (5G potential customer)", "CAST(size_pot AS VARCHAR)"),
    8: ("Reached", "CAST(reached AS VARCHAR)"), 9: ("Reach %", _pct10(_r10("reached", "size"))), 10: ("Hit", "CAST(hits AS VARCHAR)"),
    11: ("Hit/Reach%", _pct10(_r10("hits", "reached"))), 12: ("Hit (from 5G potential customer)", "CAST(hit_pot AS VARCHAR)"), 13: ("Recontract Revenue Rate", "' '"),
    14: ("Target(Revenue)", "'50%'"), 15: ("Gap(Revenue)", _pct10("(rev10 - 5000000000)")), 16: ("PTD(Revenue)", _pct10("rev10")),
    17: ("Net service revenue1 (before)", _cents("((was6 + 5000) // 10000)")), 18: ("Net service revenue (after)", _cents("((now6 + 5000) // 10000)")),
    19: ("Avg Net Service Revenue Per User", "' '"), 20: ("Before", _cents("((was10 + 50000000) // 100000000)")), 21: ("After (accept order)", _cents("((now10 + 50000000) // 100000000)")),
    22: ("Sales status (%)", "' '"), 23: ("Upsell(%)", _pct10(_r10("up", "sold"))), 24: ("Flatsell(%)", _pct10(_r10("flat", "sold"))), 25: ("Downsell(%)", _pct10(_r10("down", "sold"))),
    26: ("Total(%)", "' '"), 27: ("Sales status (count)", "' '"), 28: ("Upsell(count)", "CAST(up AS VARCHAR)"), 29: ("Flatsell(count)", "CAST(flat AS VARCHAR)"),
    30: ("Downsell(count)", "CAST(down AS VARCHAR)"), 31: ("Total(count)", "CAST(sold AS VARCHAR)"), 32: ("Magnitude", "' '"), 33: ("Upsell magnitude", _pct10(_r10("bup", "asold"))),
    34: ("Downsell magnitude", _pct10(f"(-{_r10('bdown', 'asold')})")), 35: ("Overall magnitude", _pct10(_r10("bsold", "asold"))),
}
_SUMS = ["size", "size_pot", "reached", "hits", "hit_pot", "bf", "af", "up", "flat", "down", "sold", "bup", "bdown", "bsold", "asold"]
_KPI_SQL = f"""{_LINES},
g AS (SELECT tier, count(*) AS size, count(*) FILTER (WHERE nk > 12) AS size_pot, count(*) FILTER (WHERE reach = 'REACH') AS reached, count(*) FILTER (WHERE hit LIKE 'HIT%') AS hits, count(*) FILTER (WHERE hit LIKE 'HIT%' AND nk > 12) AS hit_pot,
  coalesce(sum(CAST(was AS BIGINT)) FILTER (WHERE hit LIKE 'HIT%'), 0) AS bf, coalesce(sum(CAST(now AS BIGINT)) FILTER (WHERE hit LIKE 'HIT%'), 0) AS af,
  count(*) FILTER (WHERE sale = 'UP_SELL') AS up, count(*) FILTER (WHERE sale = 'FLAT_SELL') AS flat, count(*) FILTER (WHERE sale = 'DOWN_SELL') AS down, count(*) FILTER (WHERE sale LIKE '%SELL') AS sold,
  sum(CASE WHEN sale = 'UP_SELL' THEN p * 100 ELSE 0 END) AS bup, sum(CASE WHEN sale = 'DOWN_SELL' THEN p * 100 ELSE 0 END) AS bdown, sum(CASE WHEN sale LIKE '%SELL' THEN p * 100 ELSE 0 END) AS bsold, sum(CASE WHEN sale LIKE '%SELL' THEN p * 90 + 10 ELSE 0 END) AS asold
  FROM h GROUP BY 1),
a AS (SELECT tier, {', '.join(_SUMS)}, 3 + row_number() OVER (ORDER BY tier) AS col_num FROM g UNION ALL SELECT 'Total', {', '.join(f'sum({c})' for c in _SUMS)}, 3 FROM g),
b AS (SELECT *, {_r10('bf', 'hits')} AS was10, {_r10('af', 'hits')} AS now10 FROM a),
d AS (SELECT *, (size * was10 + 5000) // 10000 AS was6, (hits * now10 + 5000) // 10000 AS now6 FROM b),
e AS (SELECT *, {_r10('was6', 'now6')} AS rev10 FROM d)"""
_KPI_CELLS = " UNION ALL ".join(f"SELECT {n} AS row_num, '{label}' AS label, tier AS col_key, CAST(col_num AS BIGINT) AS col_num, {v} AS disp_val FROM e" for n, (label, v) in _KPI_LINES.items())


@report("campaign_kpi_full", f"WITH {_KPI_SQL} {_KPI_CELLS}")
def campaign_kpi_full(t: Tables) -> DataFrame:
    """All 35 lines as cells with the number of their column."""
    return campaign.kpi_long(settle(_labelled(t), "campaign_lines")).select("row_num", "label", "col_key", "col_num", "disp_val")


@report("campaign_kpi_blocks", f"WITH {_KPI_SQL}, cells AS ({_KPI_CELLS})" + """
SELECT row_num, label, CAST((col_num - 3) // 4 AS INTEGER) AS block, max(disp_val) FILTER (WHERE (col_num - 3) % 4 = 0) AS c0, max(disp_val) FILTER (WHERE (col_num - 3) % 4 = 1) AS c1,
  max(disp_val) FILTER (WHERE (col_num - 3) % 4 = 2) AS c2, max(disp_val) FILTER (WHERE (col_num - 3) % 4 = 3) AS c3 FROM cells GROUP BY 1, 2, 3
""")
def campaign_kpi_blocks(t: Tables) -> DataFrame:
    """The matrix as tables of four columns each, side by side the whole."""
    return campaign.kpi_blocks(settle(_labelled(t), "campaign_lines"), width=4)


@report("campaign_plan_mix", f"""
WITH {_LINES},
n AS (SELECT tier, CASE p WHEN 4 THEN 'N1' WHEN 2 THEN 'N2' ELSE 'UNMAP' END AS nat, CASE WHEN p = 4 THEN 'a' WHEN s = 'F' THEN 'b' ELSE 'UNMAP' END AS sub FROM h WHERE hit LIKE 'HIT%'),
g AS (SELECT tier, nat, sub, count(*) AS cnt FROM n GROUP BY ALL UNION ALL SELECT 'TOTAL', nat, sub, count(*) FROM n GROUP BY ALL),
s AS (SELECT *, CAST(sum(cnt) OVER (PARTITION BY tier) AS BIGINT) AS total FROM g),
k AS (SELECT DISTINCT nat, sub FROM n),
r AS (SELECT nat, sub, CAST(dense_rank() OVER (ORDER BY nat) AS INTEGER) AS rn, CAST(dense_rank() OVER (PARTITION BY nat ORDER BY sub) AS INTEGER) AS rs FROM k),
tiers AS (SELECT DISTINCT tier FROM h UNION SELECT 'TOTAL')
SELECT tier AS shk_tier, r.nat AS ru_plan_mix_nature, r.sub AS ru_plan_mix_sub_nature, rn AS rnk_nature, rs AS rnk_sub_nature, r.sub AS display_nature,
  coalesce({_pct('s.cnt', 's.total')}, '0.00%') AS ptg
FROM r CROSS JOIN tiers LEFT JOIN s USING (tier, nat, sub)
UNION ALL SELECT DISTINCT tier, nat, ' ', rn, 0, nat, ' ' FROM r CROSS JOIN tiers
""")
def campaign_plan_mix(t: Tables) -> DataFrame:
    cells = campaign.plan_mix_cells(settle(_labelled(t), "campaign_lines"))
    return cells.select("shk_tier", "ru_plan_mix_nature", "ru_plan_mix_sub_nature", "rnk_nature", "rnk_sub_nature", "display_nature", "ptg")


@report("campaign_plan_mix_matrix", f"""
WITH {_LINES},
n AS (SELECT tier, CASE p WHEN 4 THEN 'N1' WHEN 2 THEN 'N2' ELSE 'UNMAP' END AS nat, CASE WHEN p = 4 THEN 'a' WHEN s = 'F' THEN 'b' ELSE 'UNMAP' END AS sub FROM h WHERE hit LIKE 'HIT%'),
g AS (SELECT tier, nat, sub, count(*) AS cnt FROM n GROUP BY ALL UNION ALL SELECT 'TOTAL', nat, sub, count(*) FROM n GROUP BY ALL),
s AS (SELECT *, CAST(sum(cnt) OVER (PARTITION BY tier) AS BIGINT) AS total FROM g),
k AS (SELECT DISTINCT nat, sub FROM n),
r AS (SELECT nat, sub, CAST(dense_rank() OVER (ORDER BY nat) AS INTEGER) AS rn, CAST(dense_rank() OVER (PARTITION BY nat ORDER BY sub) AS INTEGER) AS rs FROM k),
tiers AS (SELECT DISTINCT tier FROM h UNION SELECT 'TOTAL'),
cells AS (SELECT tier, rn, rs, r.sub AS disp, coalesce({_pct('s.cnt', 's.total')}, '0.00%') AS ptg FROM r CROSS JOIN tiers LEFT JOIN s USING (tier, nat, sub)
  UNION ALL SELECT DISTINCT tier, rn, 0, nat, ' ' FROM r CROSS JOIN tiers)
SELECT 'B1' AS batch_id, rn AS rnk_nature, rs AS rnk_sub_nature, disp AS display_nature, max(ptg) FILTER (WHERE tier = 'TOTAL') AS "TOTAL", {', '.join(f"max(ptg) FILTER (WHERE tier = '{x}') AS {x}" for x in SEGMENTS)} FROM cells GROUP BY 1, 2, 3, 4
""")
def campaign_plan_mix_matrix(t: Tables) -> DataFrame:
    """Plan mix with tiers as columns."""
    return campaign.plan_mix_matrix(settle(_labelled(t), "campaign_lines"), SEGMENTS)


_AVG_COLS = {n: i for i, n in enumerate(campaign.AVERAGES)}


@report("campaign_averages", f"""
WITH o AS (SELECT 'C' || o_custkey AS c, CAST(o_orderdate AS DATE) AS d, CAST(o_totalprice AS DECIMAL(18,2)) AS amt FROM orders),
x AS (SELECT c, CAST(min(d) + INTERVAL 12 MONTH AS DATE) AS cd FROM o GROUP BY c),
m AS (SELECT c, CAST(date_trunc('month', d) AS DATE) AS mth, sum(amt) AS r FROM o GROUP BY 1, 2)
SELECT 'T' || substr(x.c, 2) AS trx_id, {', '.join(f"CAST(round(CAST(r AS DOUBLE) * {i + 1} + 1, 2) AS DOUBLE) AS {n}" if n != 'avg_usage_gb' else f"CAST(round((CAST(r AS DOUBLE) * {i + 1} + 1) / 1048576, 2) AS DOUBLE) AS {n}" for n, i in _AVG_COLS.items())}
FROM x JOIN m ON m.c = x.c AND m.mth = CAST(date_trunc('month', cd) - INTERVAL 1 MONTH AS DATE)
""")
def campaign_averages(t: Tables) -> DataFrame:
    """The ten averages of the three months before a contact."""
    inputs = _Inputs(t)
    summary = inputs["master_summ"]
    figures = {}
    for n, c in campaign.AVERAGES.items():
        whole = F.col("net_rev_1").cast("double") * (_AVG_COLS[n] + 1)
        figures |= {f"{c}_1": whole, f"{c}_2": whole + 1, f"{c}_3": whole + 2}
    base = summary.select("cust_num", "subr_num", "trx_month", "ld_exp_date", "rate_plan_cd", "plan_tariff", "subr_sw_on_date", "nomination_flg", *[v.alias(k) for k, v in figures.items()])
    out = campaign.before({"campaign": inputs["campaign"], "master_summ": base})
    return out.select("trx_id", *[F.round(n, 2).alias(n) for n in campaign.AVERAGES])


class _Inputs:
    """Campaign tables: each customer is contacted at the date of its first order, plus a year."""

    def __init__(self, t: Tables):
        self.t, self.w = t, Warehouse(t)

    def __getitem__(self, name: str) -> DataFrame:
        t = self.t
        line = [F.concat(F.lit("C"), "o_custkey").alias("cust_num"), F.concat(F.lit("S"), "o_custkey").alias("subr_num")]
        p = F.substring("o_orderpriority", 1, 1)
        o = orders(t)
        if name == "campaign":
            first = o.groupBy("o_custkey").agg(F.add_months(F.min("o_orderdate"), 12).alias("contact_start_date"))
            return first.select(F.concat(F.lit("T"), "o_custkey").alias("trx_id"), *line, "contact_start_date")
        if name == "dict_ref":
            rows = [("PRG_ID:PR", "PRA", "1990-01-01", "2999-12-31"), ("MKT_CD:BF-FUP", "M3", "1990-01-01", "2999-12-31"), ("MKT_CD:AF-FUP", "M1", "1990-01-01", "2999-12-31"), ("MKT_CD:AF-HS", "M2", "1990-01-01", "2999-12-31")]
            ref = constant_rows(t.spark, rows, "dict_grp string, dict_val string, eff_start_date string, eff_end_date string")
            return ref.withColumns({c: F.to_date(c) for c in ("eff_start_date", "eff_end_date")})
        if name == "pr_status":
            state = F.when(p == "1", "Accept Offer").when(p == "2", "Consider").otherwise("Busy")
            prog = F.when(F.col("o_orderstatus") == "F", "PRA").when(F.col("o_orderstatus") == "O", "PRS1").otherwise("ZZZ")
            return o.select(*line, F.col("o_orderdate").alias("lst_mod_date"), state.alias("pr_status"), F.lit("U1").alias("comm_by"), prog.alias("program_id"))
        if name == "master_summ":
            rev = o.groupBy("o_custkey", month_start("o_orderdate").alias("trx_month")).agg(F.sum(money("o_totalprice")).cast("decimal(18,2)").alias("r"))
            three = {f"net_rev_{i}": F.col("r") for i in (1, 2, 3)}
            return rev.withColumns(three).select(
                *line, "trx_month", *three, *[F.lit(1048576).alias(f"vol_kb_{i}") for i in (1, 2, 3)], F.last_day("trx_month").alias("ld_exp_date"),
                F.lit("RPX").alias("rate_plan_cd"), F.lit(99).alias("plan_tariff"), F.col("trx_month").alias("subr_sw_on_date"), F.lit("N").alias("nomination_flg"),
            )
        if name == "bill_servs":
            code = F.when(p == "1", "FUP12").when(p == "2", "FUPX1").otherwise("V1")
            return o.select(*line, code.alias("bill_serv_cd"), p.cast("int").alias("bill_rate"), F.col("o_orderdate").alias("bill_start_date"))
        if name == "ld_post_paygo":
            return self.w["subr_ld_hist"].select("cust_num", "subr_num", "mkt_cd", "inv_num", F.col("ld_start_date").alias("inv_date"), "ld_expired_date")
        if name == "activity":
            kind = F.when(F.col("o_orderstatus") == "F", "RETENTION").when(F.col("o_orderstatus") == "O", "UPGRADE").otherwise("NEW")
            return o.select(
                *line, F.col("o_orderdate").alias("inv_date"), kind.alias("trx_type"), F.when(p == "1", "Outbound").otherwise("Store").alias("channel_effort"), F.lit("N").alias("online_inv"),
                F.lit("ST1").alias("store_cd"), F.concat(F.lit("M"), p).alias("mkt_cd"), F.concat(F.lit("RP"), p).alias("new_rate_plan_cd"), F.lit("LDC12X").alias("new_ld_cd"),
            )
        if name == "om_chg_plan":
            return o.where("o_orderstatus = 'P'").select(*line, F.col("o_orderdate").alias("create_date"), F.concat(F.lit("O"), "o_orderkey").alias("case_id"), F.concat(F.lit("M"), p).alias("mkt_cd"))
        if name == "rule_ref":
            rows = [("R1", "RP1", "M1", "M2", " ", "M1", " ", " ", 300, "N1", "a"), ("R2", "RP2", "M2", "M1", " ", " ", " ", " ", 90000, "N1", "b"), ("R3", "RP1", "M1", " ", "M1", " ", " ", " ", 150000, "N2", "c"), ("R4", "RP1", "M1", " ", " ", "M2", " ", " ", 70000, "N2", "d")]
            names = ["hs_mkt_cd", "fup_mkt_cd", "vas_mkt_cd", "vas2_mkt_cd", "vas3_mkt_cd"]
            schema = "rule_id string, plan_cd string, plan_mkt_cd string, " + ", ".join(n + " string" for n in names) + ", net_price int, plan_mix_nature string, plan_mix_sub_nature string"
            return constant_rows(t.spark, rows, schema)
        return self.w[name]


@report("campaign_classify", with_tables("pos_inv_header", "subr_ld_hist") + """,
o AS (SELECT 'C' || o_custkey AS c, 'S' || o_custkey AS s, CAST(o_orderdate AS DATE) AS d, substr(o_orderpriority, 1, 1) AS p, o_orderstatus AS st, CAST(o_totalprice AS DECIMAL(18,2)) AS amt, o_orderkey FROM orders),
x AS (SELECT 'T' || substr(c, 2) AS trx_id, c, s, CAST(min(d) + INTERVAL 12 MONTH AS DATE) AS cd FROM o GROUP BY c, s),
prj AS (SELECT trx_id, CASE p WHEN '1' THEN 'Accept Offer' WHEN '2' THEN 'Consider' ELSE 'Busy' END AS v, rank() OVER (PARTITION BY trx_id ORDER BY d DESC) AS rk FROM x JOIN o USING (c, s) WHERE d >= cd AND st IN ('F', 'O')),
pr AS (SELECT trx_id, max(v) AS pr FROM prj WHERE rk = 1 GROUP BY 1),
bf AS (SELECT trx_id, CAST(sum(amt) AS DOUBLE) AS rev FROM x JOIN o USING (c, s) WHERE date_trunc('month', d) = date_trunc('month', cd) - INTERVAL 1 MONTH GROUP BY 1),
fupj AS (SELECT trx_id, rank() OVER (PARTITION BY trx_id ORDER BY d DESC) AS rk FROM x JOIN o USING (c, s) WHERE d < cd AND p = '1'),
fup AS (SELECT DISTINCT trx_id, 'FUP12' AS cd, 1 AS amt, 'BILL_CD' AS src FROM fupj WHERE rk = 1),
ldj AS (SELECT trx_id FROM x JOIN w_subr_ld_hist l ON l.cust_num = c AND l.subr_num = s WHERE l.mkt_cd = 'M3' AND l.ld_start_date < cd),
ld AS (SELECT DISTINCT trx_id, 'M3' AS cd, 0 AS amt, 'MKT_CD' AS src FROM ldj),
oth AS (SELECT trx_id, string_agg(cd, ',' ORDER BY src) AS lst, CAST(sum(amt) AS DOUBLE) AS amt FROM (SELECT * FROM fup UNION ALL SELECT * FROM ld) GROUP BY 1),
rj AS (SELECT trx_id, p, rank() OVER (PARTITION BY trx_id ORDER BY d DESC) AS rk FROM x JOIN o USING (c, s) WHERE d >= cd AND st IN ('F', 'O')),
rn AS (SELECT trx_id, max(CASE WHEN p = '1' THEN 'Outbound' ELSE 'Store' END) AS ch, max('RP' || p) AS plan, max('M' || p) AS mkt, max(CAST(p AS INTEGER)) * 100 AS tariff FROM rj WHERE rk = 1 GROUP BY 1),
ad AS (SELECT trx_id, string_agg(DISTINCT 'M' || p, ',' ORDER BY 'M' || p) AS addons FROM x JOIN o USING (c, s) WHERE d >= cd AND st = 'P' AND p IN ('1', '2') GROUP BY 1),
ru(rule_id, plan, mkt, addons, price) AS (VALUES ('R1', 'RP1', 'M1', 'M1,M2', 300), ('R2', 'RP2', 'M2', 'M1', 90000), ('R3', 'RP1', 'M1', 'M1', 150000), ('R4', 'RP1', 'M1', 'M2', 70000)),
j AS (SELECT x.trx_id, coalesce(pr, ' ') AS pr, coalesce(rev, 0) AS rev, coalesce(lst, ' ') AS lst, coalesce(oth.amt, 0) AS oamt, coalesce(ch, ' ') AS ch, coalesce(tariff, 0) AS tariff, coalesce(ad.addons, ' ') AS addons, coalesce(ru.rule_id, ' ') AS rule, ru.price
  FROM x LEFT JOIN pr USING (trx_id) LEFT JOIN bf USING (trx_id) LEFT JOIN oth USING (trx_id) LEFT JOIN rn USING (trx_id) LEFT JOIN ad USING (trx_id) LEFT JOIN ru ON rn.plan = ru.plan AND rn.mkt = ru.mkt AND ad.addons = ru.addons),
k AS (SELECT *, CASE WHEN rule <> ' ' THEN price ELSE tariff END AS net FROM j)
SELECT trx_id, pr AS pr_final_status, round(rev, 2) AS bf_avg_net_rev, lst AS bf_other_lst, oamt AS bf_other_amt, ch AS af_channel_effort, addons AS af_addon_map_mkt_lst, rule AS ru_rule_id, CAST(net AS DOUBLE) AS af_net_price,
  CASE WHEN rule = ' ' THEN ' ' WHEN rev > net THEN 'DOWN_SELL' WHEN rev = net THEN 'FLAT_SELL' ELSE 'UP_SELL' END AS cl_sale_type,
  CASE WHEN pr IN ('Accept Offer', 'Consider') THEN 'REACH' ELSE 'NON_REACH' END AS cl_reach,
  CASE WHEN pr = 'Accept Offer' AND ch = 'Outbound' THEN 'HIT:OUTBOUND' WHEN rule <> ' ' THEN 'HIT:' || upper(ch) ELSE ' ' END AS cl_hit,
  CASE WHEN rule = ' ' AND ch <> ' ' THEN 'EXCEPT_RULE_UNMAP' ELSE ' ' END AS cl_except
FROM k
""")
def campaign_classify(t: Tables) -> DataFrame:
    """Campaign lines with what was held before, taken after, the offer rule met and the labels."""
    out = campaign.classify(_Inputs(t), F.to_date(F.lit("2002-01-01")))
    sums = ["bf_avg_net_rev", "bf_other_amt", "af_net_price"]
    texts = ["pr_final_status", "bf_other_lst", "af_channel_effort", "af_addon_map_mkt_lst", "ru_rule_id", "cl_sale_type", "cl_reach", "cl_hit", "cl_except"]
    return out.select("trx_id", *texts, *[F.round(c, 2).cast("double").alias(c) for c in sums])
