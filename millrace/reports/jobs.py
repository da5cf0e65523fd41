"""The report plans, run on warehouse-shaped tables derived from the driver's tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.params import CommissionWindow
from millrace.plans import commission
from millrace.reports.registry import report
from millrace.reports.warehouse import COMM_MONTH, LAST, Warehouse, with_tables
from millrace.sources.tables import Tables

# All invoices after the first year, so that there are contracts from before the window.
COMM = CommissionWindow(date(1996, 1, 1), LAST, COMM_MONTH)

_CASES_SQL = """
inv AS (SELECT * FROM w_pos_inv_header WHERE inv_date BETWEEN DATE '1996-01-01' AND DATE '2001-12-31' AND salesman_cd IN (SELECT salesman_cd FROM w_retent_salesman)
  AND inv_num NOT IN (SELECT inv_num FROM w_pos_return_header WHERE trx_date BETWEEN DATE '1996-01-01' AND DATE '2001-12-31')),
b0 AS (SELECT inv_num || '-' || subr_num AS case_id, cust_num, subr_num, inv_num AS pos_inv_num, mkt_cd AS pos_mkt_cd, ld_cd AS pos_ld_cd, inv_date AS pos_inv_date FROM inv WHERE ld_cd <> ' '),
cases AS (
  SELECT *, 'CSTPN_LD' AS tag FROM b0 WHERE pos_mkt_cd = 'CSTPN'
  UNION ALL SELECT *, 'NORMAL_MASS' FROM b0 WHERE pos_mkt_cd IN ('M1', 'M2', 'M3')
  UNION ALL SELECT case_id, cust_num, subr_num, pos_inv_num, overr_mkt_cd, pos_ld_cd, pos_inv_date, 'NORMAL_MASS' FROM b0 JOIN w_comm_overr_hist o ON pos_inv_num = o.inv_num),
ld AS (SELECT * FROM w_subr_ld_hist WHERE DATE '2001-12-31' BETWEEN start_date AND end_date),
m1 AS (SELECT c.*, 'INVOICE' AS how, l.inv_num AS ld_inv_num, l.ld_cd, l.mkt_cd AS ld_mkt_cd, l.ld_start_date, l.ld_expired_date FROM cases c JOIN ld l ON c.pos_inv_num = l.inv_num),
m2j AS (SELECT c.*, l.inv_num, l.ld_cd, l.mkt_cd, l.ld_start_date, l.ld_expired_date, rank() OVER (PARTITION BY c.case_id, c.tag, c.pos_mkt_cd ORDER BY l.ld_start_date) AS rk
  FROM cases c JOIN ld l ON c.cust_num = l.cust_num AND c.subr_num = l.subr_num AND c.pos_ld_cd = l.ld_cd AND l.ld_start_date BETWEEN c.pos_inv_date AND DATE '2001-12-31'
  WHERE c.case_id NOT IN (SELECT case_id FROM m1)),
m2 AS (SELECT case_id, cust_num, subr_num, pos_inv_num, pos_mkt_cd, pos_ld_cd, pos_inv_date, tag, 'EARLIEST' AS how, max(inv_num) AS ld_inv_num, max(ld_cd) AS ld_cd, max(mkt_cd) AS ld_mkt_cd, max(ld_start_date) AS ld_start_date, max(ld_expired_date) AS ld_expired_date
  FROM m2j WHERE rk = 1 GROUP BY ALL),
m3 AS (SELECT *, 'NONE', ' ', pos_ld_cd, pos_mkt_cd, pos_inv_date, DATE '2999-12-31' FROM cases WHERE case_id NOT IN (SELECT case_id FROM m1) AND case_id NOT IN (SELECT case_id FROM m2)),
m AS (SELECT * FROM m1 UNION ALL SELECT * FROM m2 UNION ALL SELECT * FROM m3),
prof AS (SELECT m.* EXCLUDE (ld_expired_date), coalesce(s.ld_expired_date, m.ld_expired_date) AS ld_expired_date, coalesce(i.rate_plan_cd, ' ') AS rate_plan_cd
  FROM m LEFT JOIN w_subr_ld_hist s ON m.ld_inv_num = s.inv_num AND m.ld_start_date BETWEEN s.start_date AND s.end_date
  LEFT JOIN w_subr_info_hist i ON s.cust_num = i.cust_num AND s.subr_num = i.subr_num AND s.ld_start_date BETWEEN i.start_date AND i.end_date),
oj AS (SELECT p.case_id, o.*, rank() OVER (PARTITION BY p.case_id ORDER BY o.ld_expired_date DESC) AS rk FROM prof p JOIN w_subr_ld_hist o ON p.cust_num = o.cust_num AND p.subr_num = o.subr_num
  WHERE DATE '{eve}' BETWEEN o.ld_start_date AND o.ld_expired_date AND o.mkt_cd IN (SELECT mkt_cd FROM w_mkt_ref_vw WHERE ld_revenue = 'P')
  AND p.ld_mkt_cd NOT IN (SELECT mkt_cd FROM w_comm_mkt_ref WHERE upper(bm_cat) = 'OTHERS')),
o1 AS (SELECT case_id, max(inv_num) AS oinv, max(mkt_cd) AS omkt, max(ld_start_date) AS ostart, max(cust_num) AS oc, max(subr_num) AS os, max(end_date) AS oend FROM oj WHERE rk = 1 GROUP BY 1),
o2 AS (SELECT o1.*, coalesce(s.ld_expired_date, DATE '1900-01-01') AS oexp, coalesce(i.rate_plan_cd, ' ') AS oplan FROM o1
  LEFT JOIN w_subr_info_hist i ON oc = i.cust_num AND os = i.subr_num AND oend BETWEEN i.start_date AND i.end_date
  LEFT JOIN w_subr_ld_hist s ON oinv = s.inv_num AND ostart BETWEEN s.start_date AND s.end_date),
base AS (SELECT p.*, coalesce(oinv, ' ') AS old_ld_inv_num, coalesce(omkt, ' ') AS old_ld_mkt_cd, coalesce(ostart, DATE '1900-01-01') AS old_ld_start_date, coalesce(oexp, DATE '1900-01-01') AS old_ld_expired_date,
    coalesce(rn.bill_rate, 0) AS bill_rate, coalesce(ro.bill_rate, 0) AS old_bill_rate,
    CASE WHEN v.ld_revenue NOT IN ('V', 'O') AND p.pos_mkt_cd <> 'CSTPN' THEN 'NON_PLAN_MKT' ELSE 'PLAN_MKT' END AS pos_mkt_type
  FROM prof p LEFT JOIN o2 ON p.case_id = o2.case_id LEFT JOIN w_bill_serv_ref rn ON p.rate_plan_cd = rn.bill_serv_cd LEFT JOIN w_bill_serv_ref ro ON o2.oplan = ro.bill_serv_cd
  LEFT JOIN w_mkt_ref_vw v ON p.pos_mkt_cd = v.mkt_cd)
"""
_COMM_TABLES = (
    "hist", "pos_inv_header", "pos_return_header", "subr_info_hist", "subr_ld_hist", "retent_salesman", "comm_mkt_ref", "comm_overr_hist", "mkt_ref_vw", "bill_serv_ref",
)


@report("commission_base", with_tables(*_COMM_TABLES) + "," + _CASES_SQL.replace("{eve}", "1995-12-31") + """
SELECT case_id, tag, how AS ld_match, ld_inv_num, ld_mkt_cd, ld_start_date, ld_expired_date, old_ld_inv_num, old_ld_expired_date, CAST(bill_rate AS DOUBLE) AS bill_rate, CAST(old_bill_rate AS DOUBLE) AS old_bill_rate, pos_mkt_type FROM base
""")
def commission_base(t: Tables) -> DataFrame:
    """Commission cases with their contract and the one replaced, all invoices at once."""
    w = Warehouse(t)
    rows = commission.prepared(w, COMM)
    return rows.select(
        "case_id", F.col("pos_inv_tag").alias("tag"), "ld_match", "ld_inv_num", "ld_mkt_cd", "ld_start_date", "ld_expired_date", "old_ld_inv_num", "old_ld_expired_date",
        F.col("bill_rate").cast("double").alias("bill_rate"), F.col("old_bill_rate").cast("double").alias("old_bill_rate"), "pos_mkt_type",
    )


def _market_sql(name: str, inv: str, mkt: str, day: str, src: str) -> str:
    return f"""
{name}_a AS (SELECT b.case_id, s.credit_back_cd, max(s.credit_back_amt) AS amt FROM {src} b JOIN w_srvcb s ON b.{mkt} = s.mkt_cd
  JOIN w_pos_crbk_detail p ON p.cust_num = b.cust_num AND p.subr_num = b.subr_num AND p.credit_cd = s.credit_back_cd AND abs(b.{day} - p.crbk_date) <= 1 AND (p.inv_num = b.{inv} OR p.inv_num = ' ') GROUP BY 1, 2),
{name}_b AS (SELECT b.case_id, h.credit_back_cd, sum(h.credit_back_amt * d.qty) AS amt FROM {src} b JOIN w_pos_inv_detail d ON b.{inv} = d.inv_num JOIN w_fes_hs_bonus_hist h ON b.{mkt} = h.mkt_cd AND d.pos_prod_cd = h.prod_cd GROUP BY 1, 2),
{name} AS (SELECT case_id, -sum(amt) AS cb FROM (SELECT * FROM {name}_a UNION ALL SELECT * FROM {name}_b) GROUP BY 1)"""


def _bills_sql(name: str, inv: str, third: bool, windowed: bool) -> str:
    at3 = f"max(CASE WHEN rnk = 3 THEN (bill, d, subr, cust) END)" if third else "NULL"
    during = "AND day BETWEEN DATE '1996-01-01' AND DATE '1996-06-01'" if windowed else ""
    return f"""
{name}_r AS (SELECT b.case_id, h.inv_num AS bill, h.inv_date AS d, h.subr_num AS subr, h.cust_num AS cust, rank() OVER (PARTITION BY b.case_id ORDER BY h.inv_date) AS rnk
  FROM base b JOIN w_subr_ld_hist s ON b.{inv} = s.inv_num AND s.start_date <= DATE '2002-01-01' JOIN w_inv_header h ON s.subr_num = h.subr_num AND s.cust_num = h.cust_num
  WHERE h.inv_date <= DATE '2002-01-31' AND h.inv_date BETWEEN s.start_date AND s.end_date AND h.inv_date BETWEEN s.ld_start_date AND s.ld_expired_date),
{name}_at AS (SELECT case_id, coalesce(max(CASE WHEN rnk = 4 THEN (bill, d, subr, cust) END), {at3}) AS r FROM {name}_r WHERE rnk <= 4 GROUP BY 1),
{name} AS (SELECT a.case_id, sum(l.amt) AS amt FROM {name}_at a JOIN ledger l ON l.subr_num = a.r[3] AND l.cust_num = a.r[4] AND l.mth = date_trunc('month', a.r[2]) {during} GROUP BY 1)"""


_RESULT_SQL = f"""
ledger AS (SELECT * FROM (SELECT cust_num, subr_num, mth, mth AS day, kind, amt FROM w_sal_led_history UNION ALL SELECT cust_num, subr_num, CAST(date_trunc('month', trx_date) AS DATE), trx_date, kind, amt FROM w_sal_led) WHERE kind LIKE 'PAY%' AND kind NOT LIKE 'PAY3%'),
olds AS (SELECT b.*, h.inv_date AS old_inv_date FROM base b JOIN w_pos_inv_header h ON b.old_ld_inv_num = h.inv_num),
{_market_sql('mk', 'pos_inv_num', 'pos_mkt_cd', 'pos_inv_date', 'base')},
{_market_sql('omk', 'old_ld_inv_num', 'old_ld_mkt_cd', 'old_inv_date', 'olds')},
{_bills_sql('bl', 'ld_inv_num', True, True)},
{_bills_sql('obl', 'old_ld_inv_num', False, False)},
cat AS (SELECT b.case_id, max(r.bm_cat) AS c FROM base b JOIN w_pos_inv_header h ON b.ld_inv_num = h.inv_num JOIN w_comm_mkt_ref r ON b.ld_mkt_cd = r.mkt_cd AND h.inv_date BETWEEN r.eff_s_date AND r.eff_e_date GROUP BY 1),
j AS (SELECT b.*, mk.cb, omk.cb AS ocb, coalesce(bl.amt, 0) AS ib, coalesce(obl.amt, 0) AS oib, coalesce(hs.net_subsidy_amt, 0) AS sub, coalesce(ohs.net_subsidy_amt, 0) AS osub,
    coalesce(ov.salesman_cd, h.salesman_cd) AS salesman_cd, coalesce(cat.c, pc.bm_cat, ' ') AS bm_cat, f.overr_rebate_amt AS fr, f.overr_bill_rate AS fb
  FROM base b LEFT JOIN mk USING (case_id) LEFT JOIN omk USING (case_id) LEFT JOIN bl USING (case_id) LEFT JOIN obl USING (case_id)
  LEFT JOIN w_hs_subsidy hs ON b.ld_inv_num = hs.inv_num LEFT JOIN w_hs_subsidy ohs ON b.old_ld_inv_num = ohs.inv_num
  LEFT JOIN w_pos_inv_header h ON b.ld_inv_num = h.inv_num LEFT JOIN w_comm_overr_hist ov ON b.ld_inv_num = ov.inv_num LEFT JOIN cat USING (case_id)
  LEFT JOIN w_comm_mkt_ref pc ON b.pos_mkt_cd = pc.mkt_cd LEFT JOIN w_comm_mkt_ref f ON b.ld_mkt_cd = f.mkt_cd AND f.override_flg = 'Y'),
k AS (SELECT *, CASE WHEN fr IS NOT NULL THEN fr WHEN pos_mkt_type = 'NON_PLAN_MKT' OR cb IS NOT NULL THEN coalesce(cb, 0) ELSE ib END AS reb,
    CASE WHEN fr IS NOT NULL THEN fr WHEN pos_mkt_type = 'NON_PLAN_MKT' OR ocb IS NOT NULL THEN coalesce(ocb, 0) ELSE oib END AS oreb,
    CASE WHEN fr IS NULL AND (pos_mkt_type = 'NON_PLAN_MKT' OR cb IS NOT NULL) THEN 'MKT_REBATE' ELSE 'INV_REBATE' END AS flg,
    CASE WHEN fr IS NULL AND (pos_mkt_type = 'NON_PLAN_MKT' OR ocb IS NOT NULL) THEN 'MKT_REBATE' ELSE 'INV_REBATE' END AS oflg,
    CAST(coalesce(fb, bill_rate) * 100 AS BIGINT) AS bc, CAST(coalesce(fb, old_bill_rate) * 100 AS BIGINT) AS obc, CASE WHEN fr IS NOT NULL THEN 'X' ELSE old_ld_inv_num END AS oinv2
  FROM j WHERE salesman_cd IS NOT NULL),
l AS (SELECT *, CASE WHEN round((ld_expired_date - ld_start_date + 1) * 120 / 365.0) = 0 THEN 10 ELSE CAST(round((ld_expired_date - ld_start_date + 1) * 120 / 365.0) AS BIGINT) END AS m,
    CASE WHEN oinv2 <> ' ' AND old_ld_expired_date <> old_ld_start_date THEN CAST(round((old_ld_expired_date - old_ld_start_date + 1) * 120 / 365.0) AS BIGINT) ELSE 10 END AS om,
    old_ld_expired_date > ld_start_date AS chg, CASE WHEN old_ld_expired_date > ld_start_date AND oinv2 <> ' ' THEN CAST(round((old_ld_expired_date - ld_start_date + 1) * 120 / 365.0) AS BIGINT) ELSE 0 END AS r,
    CAST(reb * 100 AS BIGINT) AS rc, CAST(oreb * 100 AS BIGINT) AS orc, CAST(sub * 100 AS BIGINT) AS sc, CAST(osub * 100 AS BIGINT) AS osc FROM k),
n AS (SELECT *, CAST((bc + CASE flg WHEN 'INV_REBATE' THEN rc ELSE 0 END) * m - sc * 10 + CASE flg WHEN 'MKT_REBATE' THEN rc * 10 ELSE 0 END
      - CASE WHEN oinv2 = ' ' THEN 0 ELSE (obc + CASE oflg WHEN 'INV_REBATE' THEN orc ELSE 0 END) * r END AS HUGEINT) AS whole,
    CAST(CASE WHEN oinv2 = ' ' THEN 0 ELSE (CASE WHEN oflg = 'MKT_REBATE' AND r > 0 THEN orc ELSE 0 END - osc) * r END AS HUGEINT) AS num FROM l),
z AS (SELECT *, whole * om - 10 * num AS nn, CAST(10 * om AS HUGEINT) AS dn FROM n)
SELECT z.case_id, coalesce(s.sale_team, ' ') AS sales_team, bm_cat, CAST(reb AS DOUBLE) AS rebate_amt, CAST(oreb AS DOUBLE) AS old_rebate_amt, flg AS rebate_flg, oflg AS old_rebate_flg,
  CAST(sub AS DOUBLE) AS hs_subsidy_amt, m / 10.0 AS contract_mth, om / 10.0 AS old_contract_mth, CASE WHEN chg THEN 'Y' ELSE 'N' END AS chg_plan_flg, r / 10.0 AS remain_contract_mth,
  CAST(sign(nn) * ((2 * abs(nn) + dn) // (2 * dn)) AS BIGINT) / 100.0 AS tcv
FROM z LEFT JOIN w_retent_salesman s ON z.salesman_cd = s.salesman_cd
"""
_MORE_TABLES = ("inv_header", "sal_led", "sal_led_history", "hs_subsidy", "pos_crbk_detail", "srvcb", "fes_hs_bonus_hist", "pos_inv_detail")


@report("commission_value", with_tables(*_COMM_TABLES, *_MORE_TABLES) + "," + _CASES_SQL.replace("{eve}", "1995-12-31") + "," + _RESULT_SQL)
def commission_value(t: Tables) -> DataFrame:
    """Rebates, subsidies and contract value of every commission case."""
    w = Warehouse(t)
    out = commission.result(w, COMM, commission.prepared(w, COMM))
    sums = ["rebate_amt", "old_rebate_amt", "hs_subsidy_amt", "contract_mth", "old_contract_mth", "remain_contract_mth", "tcv"]
    return out.select("case_id", "sales_team", "bm_cat", "rebate_flg", "old_rebate_flg", "chg_plan_flg", *[F.col(c).cast("double").alias(c) for c in sums])


@report("commission_bills", with_tables(*_COMM_TABLES, *_MORE_TABLES) + "," + _CASES_SQL.replace("{eve}", "1995-12-31") + "," + _RESULT_SQL.split(",\nolds AS")[0].strip().rstrip(",") + "," + _bills_sql("bl", "ld_inv_num", True, True) + """,
lst AS (SELECT case_id, string_agg('[' || bill || ']-' || strftime(d, '%Y%m%d'), ';' ORDER BY rnk, bill) AS bills FROM bl_r WHERE rnk <= 4 GROUP BY 1),
prt AS (SELECT a.case_id, string_agg(split_part(l.kind, '-', 1) || '=' || CAST(CAST(l.amt AS DECIMAL(12,2)) AS VARCHAR), ';' ORDER BY l.kind, l.amt) AS parts
  FROM bl_at a JOIN ledger l ON l.subr_num = a.r[3] AND l.cust_num = a.r[4] AND l.mth = date_trunc('month', a.r[2]) AND day BETWEEN DATE '1996-01-01' AND DATE '1996-06-01' GROUP BY 1)
SELECT bl_at.case_id, bills AS bill_inv_list, CAST(bl.amt AS DOUBLE) AS inv_cb_amt, ',"INV_REBTE":"' || parts || '"' AS inv_note FROM bl_at JOIN lst USING (case_id) LEFT JOIN bl USING (case_id) LEFT JOIN prt USING (case_id)
""")
def commission_bills(t: Tables) -> DataFrame:
    """The first four bills under each case's contract, as a list, and the rebates in the month of the fourth."""
    w = Warehouse(t)
    found = commission.bill_rebates(w, COMM, commission.prepared(w, COMM), "ld_inv_num", "INV_REBTE", [4, 3], True)
    return found.withColumn("inv_cb_amt", F.col("inv_cb_amt").cast("double"))


@report("commission_exceptions", with_tables("pos_inv_header", "pos_return_header", "retent_salesman") + """
SELECT inv_num, inv_date, mkt_cd, ld_cd, salesman_cd FROM w_pos_inv_header
WHERE inv_date BETWEEN DATE '1996-01-01' AND DATE '2001-12-31' AND salesman_cd IN (SELECT salesman_cd FROM w_retent_salesman)
  AND inv_num NOT IN (SELECT inv_num FROM w_pos_return_header WHERE trx_date BETWEEN DATE '1996-01-01' AND DATE '2001-12-31')
  AND (ld_cd = ' ' OR mkt_cd IN ('M4', 'M5') AND inv_num NOT IN (SELECT CASE WHEN o_orderkey % 5 = 0 THEN 'F' ELSE 'I' END || o_orderkey FROM orders WHERE o_totalprice > 450000 AND o_orderpriority LIKE '4%'))
""")
def commission_exceptions(t: Tables) -> DataFrame:
    """Invoices of commissioned staff that led to no case."""
    w = Warehouse(t)
    found = commission.cases(w, COMM)
    return commission.exceptions(w, COMM, found).select("inv_num", "inv_date", "mkt_cd", "ld_cd", "salesman_cd")
