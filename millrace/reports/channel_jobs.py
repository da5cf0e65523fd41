"""Channel, revenue and contribution plans on warehouse-shaped tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import money
from millrace.operators import previous_row
from millrace.params import Window
from millrace.plans import channel, contribution, revenue
from millrace.reports.common import orders
from millrace.reports.registry import report
from millrace.reports.warehouse import FIRST, LAST, Warehouse, with_tables
from millrace.storage import settle
from millrace.sources.tables import Tables

# Two windows, so that both new and old lines occur, and the ledger's period in the second.
SPAN = Window(date(1996, 1, 1), LAST)
WHOLE = Window(FIRST, LAST)
_IN = "BETWEEN DATE '1996-01-01' AND DATE '2001-12-31'"

_CHANNEL_TABLES = ("hist", "pos_inv_header", "pos_return_header", "subr_info_hist", "mkt_ref_vw", "stores", "fes_usr_info", "om_pending", "om_complete", "fl_om_pending", "fl_om_complete", "prepd_postpaid_subr")
_TRX_SQL = f"""
newl AS (SELECT cust_num, subr_num FROM (SELECT *, row_number() OVER (PARTITION BY cust_num, subr_num ORDER BY start_date) AS rn FROM w_subr_info_hist) WHERE rn = 1 AND start_date {_IN}),
inv AS (SELECT i.cust_num, i.subr_num, i.pos_shop_cd AS store_cd, h.rate_plan_cd, i.inv_num AS order_num, i.inv_date, i.mkt_cd, 'Invoice' AS ref, i.online_inv_flg AS online_inv, m.ld_revenue, h.subr_stat_cd, i.ld_cd, ' ' AS add_vas, i.inv_date AS eff_date
  FROM w_pos_inv_header i JOIN w_subr_info_hist h ON i.cust_num = h.cust_num AND i.subr_num = h.subr_num AND i.inv_date BETWEEN h.start_date AND h.end_date JOIN w_mkt_ref_vw m ON i.mkt_cd = m.mkt_cd
  WHERE i.inv_date {_IN} AND i.pos_shop_cd IN (SELECT store_cd FROM w_stores) AND i.inv_num NOT IN (SELECT inv_num FROM w_pos_return_header WHERE trx_date >= DATE '1996-01-01')),
om0 AS (SELECT * FROM w_om_pending UNION SELECT * FROM w_om_complete), om1 AS (SELECT * FROM om0 WHERE create_date {_IN}),
om2 AS (SELECT cust_num, subr_num, create_date, max((create_time, case_id, new_plan_cd, add_vas)) AS n, max(eff_date) AS le FROM om1 GROUP BY 1, 2, 3),
om AS (SELECT o.cust_num, o.subr_num, case_id, o.create_date, create_by, mkt_cd, ld_cd, greatest(eff_date, le) AS eff_date,
    CASE WHEN trim(n[3]) = '' THEN new_plan_cd WHEN trim(new_plan_cd) = '' THEN n[3] WHEN create_time >= n[1] THEN new_plan_cd ELSE n[3] END AS new_plan_cd,
    CASE WHEN trim(n[4]) = '' THEN add_vas WHEN trim(add_vas) = '' THEN n[4] WHEN create_time >= n[1] THEN add_vas ELSE n[4] END AS add_vas
  FROM om1 o JOIN om2 USING (cust_num, subr_num, create_date)),
usr AS (SELECT usr_name, pos_shop_cd FROM w_fes_usr_info WHERE pos_shop_cd IN (SELECT store_cd FROM w_stores)),
omld AS (SELECT o.cust_num, o.subr_num, u.pos_shop_cd, CASE WHEN trim(o.new_plan_cd) <> '' THEN o.new_plan_cd ELSE h.rate_plan_cd END, case_id, create_date, o.mkt_cd, 'Add ld - OM Order', 'N', m.ld_revenue, h.subr_stat_cd, o.ld_cd, add_vas, eff_date
  FROM om o JOIN usr u ON create_by = usr_name JOIN w_subr_info_hist h ON o.cust_num = h.cust_num AND o.subr_num = h.subr_num AND create_date BETWEEN h.start_date AND h.end_date JOIN w_mkt_ref_vw m ON o.mkt_cd = m.mkt_cd WHERE trim(o.ld_cd) <> '' AND m.ld_revenue IN ('P', 'V')),
fl0 AS (SELECT * FROM w_fl_om_pending UNION SELECT * FROM w_fl_om_complete),
fl AS (SELECT o.cust_num, o.subr_num, u.pos_shop_cd, h.rate_plan_cd, case_id, create_date, o.mkt_cd, 'Add ld - FL Order', 'N', m.ld_revenue, h.subr_stat_cd, o.ld_cd, add_vas, eff_date
  FROM fl0 o JOIN usr u ON create_by = usr_name JOIN w_subr_info_hist h ON o.cust_num = h.cust_num AND o.subr_num = h.subr_num AND create_date BETWEEN h.start_date AND h.end_date JOIN w_mkt_ref_vw m ON o.mkt_cd = m.mkt_cd WHERE create_date {_IN} AND m.ld_revenue IN ('P', 'V')),
pc AS (SELECT o.cust_num, o.subr_num, u.pos_shop_cd, o.new_plan_cd, case_id, create_date, o.mkt_cd, 'Chg plan only', 'N', ' ', h.subr_stat_cd, o.ld_cd, add_vas, eff_date
  FROM om o JOIN usr u ON create_by = usr_name JOIN w_subr_info_hist h ON o.cust_num = h.cust_num AND o.subr_num = h.subr_num AND create_date - 1 BETWEEN h.start_date AND h.end_date
  WHERE trim(o.new_plan_cd) <> '' AND o.new_plan_cd <> h.rate_plan_cd AND h.subr_stat_cd = 'OK' AND (o.cust_num, o.subr_num) NOT IN (SELECT (cust_num, subr_num) FROM newl)),
every AS (
  SELECT 1 AS pr, 'INVOICE' AS source, * FROM inv WHERE ld_revenue IN ('P', 'V') AND order_num LIKE 'I%'
  UNION ALL SELECT 2, 'NEW_LINE', * FROM inv WHERE ld_revenue IN ('P', 'V') AND order_num LIKE 'F%' AND (cust_num, subr_num) IN (SELECT (cust_num, subr_num) FROM newl)
  UNION ALL SELECT 3, 'PREPAID', * FROM inv WHERE ld_revenue NOT IN ('P', 'V') AND (cust_num, subr_num) IN (SELECT (cust_num, subr_num) FROM w_prepd_postpaid_subr)
  UNION ALL SELECT 4, 'OM_ORDER', * FROM omld UNION ALL SELECT 5, 'FL_ORDER', * FROM fl UNION ALL SELECT 6, 'PLAN_CHANGE', * FROM pc),
trx AS (SELECT DISTINCT * EXCLUDE (pr) FROM every JOIN (SELECT cust_num, subr_num, min(pr) AS pr FROM every GROUP BY 1, 2) USING (cust_num, subr_num, pr))
"""


@report("channel_transactions", with_tables(*_CHANNEL_TABLES) + "," + _TRX_SQL + "SELECT * FROM trx")
def channel_transactions(t: Tables) -> DataFrame:
    """Transactions of each line from the first of six sources that knows it."""
    return channel.transactions(Warehouse(t), SPAN)


_DETAIL_SQL = """
terms AS (SELECT h.*, m.ld_revenue FROM w_subr_ld_hist h JOIN w_mkt_ref_vw m ON h.mkt_cd = m.mkt_cd WHERE m.ld_revenue IN ('P', 'V') AND h.inv_num NOT IN (SELECT inv_num FROM w_pos_return_header)),
held AS (SELECT x.cust_num, x.subr_num, x.order_num, l.ld_cd AS oc, l.ld_expired_date AS oe, l.ld_revenue, row_number() OVER (PARTITION BY x.cust_num, x.subr_num, x.order_num ORDER BY l.ld_expired_date DESC, l.ld_cd DESC) AS rn
  FROM trx x JOIN terms l ON x.cust_num = l.cust_num AND x.subr_num = l.subr_num AND x.inv_date - 1 BETWEEN l.start_date AND l.end_date),
det AS (SELECT x.* EXCLUDE (ld_cd, ld_revenue), coalesce(p.rate_plan_cd, 'NA') AS orig_rate_plan_cd, coalesce(c.oc, 'NA') AS orig_ld_cd, coalesce(c.oe, DATE '2999-12-31') AS orig_ld_exp_date,
    CASE WHEN trim(x.ld_cd) <> '' THEN x.ld_cd ELSE coalesce(i.ld_cd, 'NA') END AS new_ld_cd, coalesce(i.ld_expiry_date, DATE '1900-01-01') AS new_ld_exp_date,
    CASE WHEN i.rate_plan_cd IS NOT NULL THEN i.rate_plan_cd ELSE x.rate_plan_cd END AS new_rate_plan_cd, CASE WHEN c.oc IS NOT NULL THEN x.ld_revenue ELSE ' ' END AS orig_ld_revenue, x.ld_revenue AS new_ld_revenue, i.salesman_cd, i.usr_id
  FROM trx x LEFT JOIN w_subr_info_hist p ON x.cust_num = p.cust_num AND x.subr_num = p.subr_num AND x.inv_date - 1 BETWEEN p.start_date AND p.end_date
  LEFT JOIN held c ON c.rn = 1 AND x.cust_num = c.cust_num AND x.subr_num = c.subr_num AND x.order_num = c.order_num AND x.ld_revenue = c.ld_revenue
  LEFT JOIN w_pos_inv_header i ON x.cust_num = i.cust_num AND x.subr_num = i.subr_num AND x.order_num = i.inv_num),
ord AS (SELECT cust_num, subr_num, create_date, add_vas, end_vas FROM w_om_pending UNION ALL SELECT cust_num, subr_num, create_date, add_vas, end_vas FROM w_om_complete),
mat AS (SELECT x.cust_num, x.subr_num, x.store_cd, x.order_num, o.add_vas, o.end_vas FROM trx x JOIN ord o ON x.cust_num = o.cust_num AND x.subr_num = o.subr_num AND x.inv_date = o.create_date),
addi AS (SELECT DISTINCT cust_num, subr_num, store_cd, order_num, unnest(string_split(add_vas, ',')) AS item FROM mat), addk AS (SELECT * FROM addi WHERE item IN ('V1', 'V2')),
endi AS (SELECT DISTINCT cust_num, subr_num, store_cd, order_num, unnest(string_split(end_vas, ',')) AS item FROM mat), endk AS (SELECT * FROM endi WHERE item IN ('V1', 'V2')),
act AS (SELECT DISTINCT x.cust_num, x.subr_num, x.store_cd, x.order_num, b.bill_serv_cd AS item FROM trx x JOIN (SELECT * FROM w_bill_servs UNION ALL SELECT * FROM w_bill_servs_pend) b ON x.cust_num = b.cust_num AND x.subr_num = b.subr_num AND x.inv_date < b.bill_end_date),
la AS (SELECT cust_num, subr_num, store_cd, order_num, string_agg(item, ',' ORDER BY item) AS l, count(*) AS n FROM addk GROUP BY 1, 2, 3, 4),
le AS (SELECT cust_num, subr_num, store_cd, order_num, string_agg(item, ',' ORDER BY item) AS l, count(*) AS n FROM endk GROUP BY 1, 2, 3, 4),
lc AS (SELECT cust_num, subr_num, store_cd, order_num, string_agg(item, ',' ORDER BY item) AS l, count(*) AS n FROM act GROUP BY 1, 2, 3, 4),
asked AS (SELECT DISTINCT cust_num, subr_num, store_cd, order_num, inv_date, rate_plan_cd FROM trx),
addons AS (SELECT a.cust_num, a.subr_num, a.store_cd, a.order_num, coalesce(la.l, ' ') AS add_vas_list, coalesce(le.l, ' ') AS end_vas_list, coalesce(lc.l, ' ') AS active_vas_list,
    CASE WHEN coalesce(la.n, 0) + coalesce(lc.n, 0) > coalesce(le.n, 0) AND rate_plan_cd IN ('RP1', 'RP3') THEN 'Y' ELSE 'N' END AS bolt_on_flg
  FROM asked a LEFT JOIN la USING (cust_num, subr_num, store_cd, order_num) LEFT JOIN le USING (cust_num, subr_num, store_cd, order_num) LEFT JOIN lc USING (cust_num, subr_num, store_cd, order_num))
"""
_DETAIL_TABLES = (*_CHANNEL_TABLES, "subr_ld_hist", "bill_servs", "bill_servs_pend")


@report("channel_addons", with_tables(*_DETAIL_TABLES) + "," + _TRX_SQL + "," + _DETAIL_SQL + "SELECT * FROM addons")
def channel_addons(t: Tables) -> DataFrame:
    """Add-ons ordered, ended and active per transaction, as lists, and the add-on flag."""
    w = Warehouse(t)
    return channel.addon_lists(w, settle(channel.transactions(w, SPAN), "channel_rows"), SPAN)


GROUPS = {"E1": "01. Unlimited", "E2": "02. High", "E3": "03. Mid", "PACK": "03. High with pack"}


def _typed(t: Tables) -> DataFrame:
    w = Warehouse(t)
    rows = settle(channel.transactions(w, SPAN), "channel_rows")
    full = channel.with_lists(channel.detail(w, rows, SPAN), channel.addon_lists(w, rows, SPAN))
    return channel.typed(w, full, GROUPS, years=SPAN.years)


@report("channel_typing", with_tables(*_DETAIL_TABLES, "data_entitle_hist", "rate_plan_ref") + "," + _TRX_SQL + "," + _DETAIL_SQL + """
SELECT d.cust_num, d.order_num, d.store_cd, d.orig_ld_cd, d.orig_ld_exp_date, d.new_ld_cd, d.new_ld_exp_date, d.orig_rate_plan_cd, d.new_rate_plan_cd, d.orig_ld_revenue,
  CASE WHEN d.ref = 'Chg plan only' THEN 'UPGRADE' WHEN trim(d.orig_ld_cd) IN ('', 'NA') OR d.orig_ld_exp_date IN (DATE '1900-01-01', DATE '2999-12-31') THEN 'RETENTION'
    WHEN date_diff('month', date_trunc('month', d.inv_date), date_trunc('month', d.orig_ld_exp_date)) > 3 THEN 'UPGRADE' ELSE 'RETENTION' END AS trx_type,
  coalesce(CASE WHEN a.bolt_on_flg = 'Y' AND a.active_vas_list <> ' ' THEN 'PACK' END, e.free_data_entitle, r.free_data_entitle, ' ') AS free_data_entitle,
  CASE coalesce(CASE WHEN a.bolt_on_flg = 'Y' AND a.active_vas_list <> ' ' THEN 'PACK' END, e.free_data_entitle, r.free_data_entitle, ' ') WHEN 'E1' THEN '01. Unlimited' WHEN 'E2' THEN '02. High' WHEN 'E3' THEN '03. Mid' WHEN 'PACK' THEN '03. High with pack' ELSE '12. Other plans' END AS rate_plan_grp,
  coalesce(CASE WHEN u.salesman_flg = 'Y' THEN d.salesman_cd ELSE d.usr_id END, ' ') AS create_by
FROM det d LEFT JOIN addons a USING (cust_num, subr_num, store_cd, order_num) LEFT JOIN w_data_entitle_hist e ON d.cust_num = e.cust_num AND d.subr_num = e.subr_num AND d.eff_date BETWEEN e.start_date AND e.end_date
LEFT JOIN w_rate_plan_ref r ON d.rate_plan_cd = r.rate_plan_cd LEFT JOIN w_fes_usr_info u ON d.salesman_cd = u.usr_name
""")
def channel_typing(t: Tables) -> DataFrame:
    """Old and new contract, type, plan group and creator of each transaction."""
    cols = ["cust_num", "order_num", "store_cd", "orig_ld_cd", "orig_ld_exp_date", "new_ld_cd", "new_ld_exp_date", "orig_rate_plan_cd", "new_rate_plan_cd", "orig_ld_revenue", "trx_type", "free_data_entitle", "rate_plan_grp", "create_by"]
    return _typed(t).select(*cols)


class _CallTables:
    """Warehouse tables plus calls, redemptions and portal transactions from orders."""

    def __init__(self, t: Tables):
        self.t, self.w = t, Warehouse(t)

    def __getitem__(self, name: str) -> DataFrame:
        line = [F.concat(F.lit("C"), "o_custkey").alias("cust_num"), F.concat(F.lit("S"), "o_custkey").alias("subr_num")]
        p = F.substring("o_orderpriority", 1, 1)
        o = orders(self.t)
        if name == "pr_status":
            who = F.when(p == "1", "SM3").when(p == "2", "ADMIN").when(p == "3", "CA9").otherwise("SM4")
            return o.where("o_orderstatus = 'F'").select(
                *line, F.concat(F.lit("PRR"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("program_id"), who.alias("comm_by"), F.lit("AO").alias("pr_status"),
                F.col("o_orderdate").alias("lst_mod_date"), F.col("o_orderdate").alias("create_date"), F.col("o_orderdate").alias("start_date"), F.lit(date(2999, 12, 31)).alias("end_date"),
            )
        if name == "redemption":
            return o.where("o_orderstatus = 'P'").select(*line, F.add_months("o_orderdate", 12).alias("redem_end_date"))
        if name == "portal_trans":
            return o.where("o_totalprice > 400000").select(
                *line, F.col("o_orderdate").alias("submission_date"), F.concat(F.lit("RP"), p).alias("renewed_plan_cd"), F.lit("ST3").alias("store_cd"), F.lit("SM5").alias("salesman_cd")
            )
        return self.w[name]


_ATTRIBUTION_SQL = """
typ AS (SELECT d.*, CASE WHEN d.ref = 'Chg plan only' THEN 'UPGRADE' WHEN trim(d.orig_ld_cd) IN ('', 'NA') OR d.orig_ld_exp_date IN (DATE '1900-01-01', DATE '2999-12-31') THEN 'RETENTION'
    WHEN date_diff('month', date_trunc('month', d.inv_date), date_trunc('month', d.orig_ld_exp_date)) > 3 THEN 'UPGRADE' ELSE 'RETENTION' END AS trx_type,
    coalesce(CASE WHEN u.salesman_flg = 'Y' THEN d.salesman_cd ELSE d.usr_id END, ' ') AS create_by FROM det d LEFT JOIN w_fes_usr_info u ON d.salesman_cd = u.usr_name),
cl AS (SELECT 'C' || o_custkey AS cust_num, 'S' || o_custkey AS subr_num, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'SM3' WHEN '2' THEN 'ADMIN' WHEN '3' THEN 'CA9' ELSE 'SM4' END AS comm_by,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, CASE WHEN o_orderpriority LIKE '2%' THEN 0 ELSE 1 END DESC, o_orderkey) AS rn FROM orders WHERE o_orderstatus = 'F'),
call AS (SELECT * FROM cl WHERE rn = 1 AND (cust_num, subr_num) NOT IN (SELECT (cust_num, subr_num) FROM newl)),
red AS (SELECT 'C' || o_custkey AS cust_num, max(CAST(o_orderdate + INTERVAL 12 MONTH AS DATE)) AS rd FROM orders WHERE o_orderstatus = 'P' GROUP BY 1),
tt AS (SELECT h.*, m.ld_revenue, row_number() OVER (PARTITION BY cust_num, subr_num ORDER BY ld_start_date DESC, ld_expired_date DESC, inv_num) AS rn FROM w_subr_ld_hist h JOIN w_mkt_ref_vw m ON h.mkt_cd = m.mkt_cd WHERE m.ld_revenue IN ('P', 'V')),
a1 AS (SELECT t.*, call.comm_by, coalesce(t.inv_date > rd, false) AS late, t.store_cd IN ('ST1', 'ST3', 'ST5', 'ST7') AS own,
    coalesce(o2.ld_start_date, DATE '1900-01-01') AS os0, CASE WHEN order_num LIKE 'ORDER%' AND t.ref <> 'Chg plan only' AND n1.ld_start_date IS NULL THEN t.eff_date ELSE coalesce(n1.ld_start_date, DATE '1900-01-01') END AS ns0
  FROM typ t LEFT JOIN call USING (cust_num, subr_num) LEFT JOIN red ON t.cust_num = red.cust_num
  LEFT JOIN tt o2 ON o2.rn = 2 AND o2.cust_num = t.cust_num AND o2.ld_revenue = t.orig_ld_revenue LEFT JOIN tt n1 ON n1.rn = 1 AND n1.cust_num = t.cust_num AND n1.ld_revenue = t.new_ld_revenue),
a2 AS (SELECT *, CASE WHEN comm_by IS NULL OR comm_by = 'ADMIN' OR late THEN create_by ELSE comm_by END AS who FROM a1),
a3 AS (SELECT *, CASE WHEN who = 'SM3' THEN 'Cold call' WHEN who LIKE 'CA%' THEN 'BM' WHEN online_inv IN ('Y', 'B') THEN 'Online' WHEN who LIKE 'FA%' THEN 'Street fighter' WHEN own THEN 'RBD' ELSE 'Others' END AS ch,
    CASE WHEN ns0 = DATE '1900-01-01' AND new_ld_exp_date NOT IN (DATE '1900-01-01', DATE '2999-12-31') AND trim(new_ld_cd) NOT IN ('', 'NA') THEN CASE WHEN new_ld_exp_date = last_day(new_ld_exp_date) THEN last_day(CAST(new_ld_exp_date - CAST(substr(new_ld_cd, 4, 2) AS INTEGER) * INTERVAL 1 MONTH AS DATE)) ELSE CAST(new_ld_exp_date - CAST(substr(new_ld_cd, 4, 2) AS INTEGER) * INTERVAL 1 MONTH AS DATE) END + 1 ELSE ns0 END AS ns,
    CASE WHEN os0 = DATE '1900-01-01' AND orig_ld_exp_date NOT IN (DATE '1900-01-01', DATE '2999-12-31') AND trim(orig_ld_cd) NOT IN ('', 'NA') THEN CASE WHEN orig_ld_exp_date = last_day(orig_ld_exp_date) THEN last_day(CAST(orig_ld_exp_date - CAST(substr(orig_ld_cd, 4, 2) AS INTEGER) * INTERVAL 1 MONTH AS DATE)) ELSE CAST(orig_ld_exp_date - CAST(substr(orig_ld_cd, 4, 2) AS INTEGER) * INTERVAL 1 MONTH AS DATE) END + 1 ELSE os0 END AS os FROM a2),
a4 AS (SELECT *, CASE WHEN new_ld_exp_date IN (DATE '1900-01-01', DATE '2999-12-31') AND ns NOT IN (DATE '1900-01-01', DATE '2999-12-31') AND trim(new_ld_cd) NOT IN ('', 'NA') THEN CASE WHEN ns = last_day(ns) THEN last_day(CAST(ns + CAST(substr(new_ld_cd, 4, 2) AS INTEGER) * INTERVAL 1 MONTH AS DATE)) ELSE CAST(ns + CAST(substr(new_ld_cd, 4, 2) AS INTEGER) * INTERVAL 1 MONTH AS DATE) END - 1 ELSE new_ld_exp_date END AS ne,
    CASE WHEN orig_ld_exp_date IN (DATE '1900-01-01', DATE '2999-12-31') AND os NOT IN (DATE '1900-01-01', DATE '2999-12-31') AND trim(orig_ld_cd) NOT IN ('', 'NA') THEN CASE WHEN os = last_day(os) THEN last_day(CAST(os + CAST(substr(orig_ld_cd, 4, 2) AS INTEGER) * INTERVAL 1 MONTH AS DATE)) ELSE CAST(os + CAST(substr(orig_ld_cd, 4, 2) AS INTEGER) * INTERVAL 1 MONTH AS DATE) END - 1 ELSE orig_ld_exp_date END AS oe,
    (cust_num, subr_num) IN (SELECT (cust_num, subr_num) FROM newl) AS act,
    ch = 'Online' AND (cust_num, rate_plan_cd, inv_date) IN (SELECT ('C' || o_custkey, 'RP' || substr(o_orderpriority, 1, 1), CAST(o_orderdate AS DATE)) FROM orders WHERE o_totalprice > 400000 AND date_trunc('month', o_orderdate) = DATE '1996-01-01') AS por FROM a3)
SELECT cust_num, order_num, CASE WHEN por THEN 'ST3' ELSE store_cd END AS store_cd, CASE WHEN act THEN 'NEW ACTIVATION' ELSE trx_type END AS trx_type, CASE WHEN act THEN 'NEW ACTIVATION' ELSE ref END AS ref,
  CASE WHEN por THEN 'SM5' ELSE create_by END AS create_by, CASE WHEN por THEN 'RBD' ELSE ch END AS channel_effort, os AS orig_ld_start_date, oe AS orig_ld_exp_date, ns AS new_ld_start_date, ne AS new_ld_exp_date,
  CASE WHEN act THEN 'Y' ELSE 'N' END AS new_activation_flg,
  CASE WHEN ns IN (DATE '1900-01-01', DATE '2999-12-31') OR oe IN (DATE '1900-01-01', DATE '2999-12-31') THEN 'N' WHEN date_trunc('month', ns) = date_trunc('month', os) AND date_trunc('month', ne) = date_trunc('month', oe) THEN 'N' WHEN date_trunc('month', ns) <= date_trunc('month', oe) THEN 'Y' ELSE 'N' END AS replace_old_ld
FROM a4
"""


@report("channel_attribution", with_tables(*_DETAIL_TABLES) + "," + _TRX_SQL + "," + _DETAIL_SQL + "," + _ATTRIBUTION_SQL)
def channel_attribution(t: Tables) -> DataFrame:
    """Channel, repaired contract dates and activation flag of each transaction."""
    out = channel.attributed(_CallTables(t), settle(_typed(t), "channel_typed"), SPAN)
    cols = ["cust_num", "order_num", "store_cd", "trx_type", "ref", "create_by", "channel_effort", "orig_ld_start_date", "orig_ld_exp_date", "new_ld_start_date", "new_ld_exp_date", "new_activation_flg", "replace_old_ld"]
    return out.select(*cols)


# --- revenue ------------------------------------------------------------------------------

def _services(t: Tables) -> DataFrame:
    """Each order as a renewal of the one before, in the shape the revenue rules take."""
    p = F.substring("o_orderpriority", 1, 1)
    code = F.concat(F.lit("LDC"), F.lpad((p.cast("int") * 6).cast("string"), 2, "0"), F.lit("X"))
    rows = orders(t).select(
        "o_custkey", "o_orderkey", "o_orderstatus", F.col("o_orderdate").alias("d"), code.alias("code"), F.concat(F.lit("RP"), p).alias("plan"),
        F.add_months("o_orderdate", p.cast("int") * 6).alias("end"), p.alias("p"),
    )
    both = previous_row(rows, "o_custkey", ["d", "o_orderkey"], ["d", "code", "plan", "end"], prefix="o_")
    return both.select(
        F.concat(F.lit("C"), "o_custkey").alias("cust_num"), F.concat(F.lit("S"), "o_custkey").alias("subr_num"),
        F.concat(F.when(F.col("o_orderkey") % 5 == 0, "F").otherwise("I"), "o_orderkey").alias("order_num"), F.concat(F.lit("ST"), (F.col("o_custkey") % 9).cast("string")).alias("store_cd"),
        F.col("d").alias("inv_date"), F.concat(F.lit("M"), "p").alias("mkt_cd"), F.col("plan").alias("rate_plan_cd"), F.col("plan").alias("new_rate_plan_cd"),
        F.coalesce("o_plan", F.lit("NA")).alias("orig_rate_plan_cd"), F.concat(F.lit("E"), "p").alias("free_data_entitle"),
        F.when(F.col("o_orderstatus") == "P", "Chg plan only").otherwise("Invoice").alias("ref"), F.coalesce("o_code", F.lit("NA")).alias("orig_ld_cd"), F.col("code").alias("new_ld_cd"),
        F.coalesce("o_end", F.lit(date(2999, 12, 31))).alias("orig_ld_exp_date"), F.coalesce("o_d", F.lit(date(1900, 1, 1))).alias("orig_ld_start_date"),
        F.when(F.col("p") == "5", "V").otherwise("P").alias("new_ld_revenue"), F.when(F.col("o_end") >= F.col("d"), "Y").otherwise("N").alias("replace_old_ld"),
        F.concat(F.lit("SM"), (F.col("o_orderkey") % 11).cast("string")).alias("create_by"), F.date_add("d", 5).alias("eff_date"),
    )


_SERVICES_SQL = """
so AS (SELECT o_custkey, o_orderkey, o_orderstatus AS st, CAST(o_orderdate AS DATE) AS d, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS p FROM orders),
sl AS (SELECT *, lag(p) OVER w AS op, lag(d) OVER w AS od, lag(CAST(d + p * 6 * INTERVAL 1 MONTH AS DATE)) OVER w AS oe FROM so WINDOW w AS (PARTITION BY o_custkey ORDER BY d, o_orderkey)),
rebates AS (SELECT 'M1' AS mkt, 'RP1' AS vas, 3 * 5 + 11 AS amt UNION ALL SELECT 'M1', 'RP4', 3 * 5 + 11 UNION ALL SELECT 'M2', 'V1', 3 * 4),
sv AS (SELECT *, p * 100 AS nr, coalesce(op * 100, 0) AS orr, CASE WHEN p IN (1, 3) AND p <> 5 THEN 18 ELSE 0 END AS na, CASE WHEN op IN (1, 3) AND p <> 5 THEN 18 ELSE 0 END AS oa,
    coalesce(r.amt, 0) AS reb, coalesce(hs.net_subsidy_amt, 0) AS sub, CASE WHEN op IS NULL THEN 0 ELSE op * 6 END AS olp, CASE WHEN st = 'P' THEN 1 ELSE p * 6 END AS nlp,
    CASE WHEN coalesce(oe >= d, false) AND NOT date_trunc('month', od) > date_trunc('month', d) THEN greatest(date_diff('month', date_trunc('month', d), date_trunc('month', oe)), 0) ELSE 0 END AS ml
  FROM sl LEFT JOIN rebates r ON r.mkt = 'M' || p AND r.vas = 'RP' || p LEFT JOIN w_hs_subsidy hs ON hs.inv_num = CASE WHEN o_orderkey % 5 = 0 THEN 'F' ELSE 'I' END || o_orderkey),
sc AS (SELECT *, nlp * (nr + na) AS rev, CASE WHEN ml > 0 THEN ml * oa + ml * orr ELSE 0 END AS chg FROM sv),
se AS (SELECT *, CASE WHEN p = 5 THEN 0 WHEN st = 'P' THEN (nr - orr + na - oa) * abs(olp - nlp) ELSE rev - reb - chg - sub END AS val FROM sc)
"""


@report("service_revenue", with_tables("hs_subsidy") + "," + _SERVICES_SQL + """
SELECT CASE WHEN o_orderkey % 5 = 0 THEN 'F' ELSE 'I' END || o_orderkey AS order_num, CAST(ml AS BIGINT) AS months_left, CAST(CASE WHEN p = 5 THEN 0 ELSE rev END AS DOUBLE) AS new_revenue,
  CAST(CASE WHEN p IN (1, 4) THEN val ELSE 0 END AS DOUBLE) AS super_care_plan, CAST(CASE WHEN p IN (1, 4) THEN 0 ELSE val END AS DOUBLE) AS other_service_plan, CAST(val AS DOUBLE) AS total_service_revenue
FROM se
""")
def service_revenue(t: Tables) -> DataFrame:
    """Contract revenue per renewal by the ordered rules."""
    out = revenue.service_revenue(Warehouse(t), _services(t), "Premium plans")
    sums = ["new_revenue", "super_care_plan", "other_service_plan", "total_service_revenue"]
    return out.select("order_num", F.col("months_left").cast("bigint").alias("months_left"), *[F.col(c).cast("double").alias(c) for c in sums])


@report("addon_fees", with_tables("pos_inv_header", "subr_ld_hist", "bill_servs", "mkt_ref_vw") + """,
ask AS (SELECT 'C' || o_custkey AS cust_num, 'S' || o_custkey AS subr_num, CASE WHEN o_orderkey % 5 = 0 THEN 'F' ELSE 'I' END || o_orderkey AS order_num, 'ST' || (o_custkey % 9) AS store_cd, CAST(o_orderdate AS DATE) AS d,
  CASE WHEN o_orderpriority LIKE '5%' THEN 'V' ELSE 'P' END AS nlr, CAST(o_orderdate AS DATE) + 5 AS eff FROM orders),
sv AS (SELECT DISTINCT cust_num, subr_num, bill_serv_cd, bill_start_date FROM w_bill_servs WHERE bill_start_date BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'),
l1 AS (SELECT a.*, s.bill_serv_cd, coalesce(s.bill_start_date, eff) AS fs FROM ask a LEFT JOIN sv s ON a.cust_num = s.cust_num AND a.subr_num = s.subr_num AND a.d <= s.bill_start_date),
l2 AS (SELECT DISTINCT l.cust_num, l.subr_num, l.order_num, l.store_cd, l.d, l.nlr, l.fs, h.inv_num, h.mkt_cd, h.ld_cd, h.ld_expired_date AS fe, m.ld_revenue, m.ld_bill_cd, coalesce(l.bill_serv_cd, m.ld_bill_cd) AS vas
  FROM l1 l JOIN w_subr_ld_hist h ON l.cust_num = h.cust_num AND l.subr_num = h.subr_num AND l.fs BETWEEN h.start_date AND h.end_date JOIN w_mkt_ref_vw m ON h.mkt_cd = m.mkt_cd),
l3 AS (SELECT *, CASE vas WHEN 'V1' THEN 30 ELSE 12 END AS rate, abs(date_diff('month', date_trunc('month', fs), date_trunc('month', fe + 1))) AS per, CASE WHEN mkt_cd = 'M2' AND vas = 'V1' THEN 12 ELSE 0 END AS reb
  FROM l2 WHERE vas IN ('V1', 'V2') AND date_trunc('month', fe) > date_trunc('month', d)),
s AS (SELECT 1 AS pr, 'ADDON' AS fee_source, * FROM l3 WHERE nlr = 'V' AND ld_revenue <> 'P' AND (ld_bill_cd = vas OR (ld_bill_cd = ' ' AND ld_revenue = 'V'))
  UNION ALL SELECT 2, 'PLAN', * FROM l3 WHERE nlr = 'P' AND ld_revenue = 'P'
  UNION ALL SELECT 3, 'OTHER', * FROM l3 WHERE ld_revenue <> 'P' AND (ld_bill_cd = vas OR (ld_bill_cd = ' ' AND ld_revenue = 'V')))
SELECT fee_source, vas AS vas_cd, store_cd, count(*) AS cnt, CAST(sum(rate * per - reb) AS DOUBLE) AS vas_fee FROM s JOIN (SELECT cust_num, subr_num, min(pr) AS pr FROM s GROUP BY 1, 2) USING (cust_num, subr_num, pr) GROUP BY 1, 2, 3
""")
def addon_fees(t: Tables) -> DataFrame:
    """Add-on fee lines per renewal by source, and their sum per transaction."""
    w = Warehouse(t)
    rows = settle(_services(t), "services")
    fees = revenue.addon_fees(w, rows, WHOLE)
    return fees.groupBy("fee_source", "vas_cd", "store_cd").agg(F.count(F.lit(1)).alias("cnt"), F.sum("vas_fee").cast("double").alias("vas_fee"))


_FEES_SQL = """
ask AS (SELECT 'C' || o_custkey AS cust_num, 'S' || o_custkey AS subr_num, CASE WHEN o_orderkey % 5 = 0 THEN 'F' ELSE 'I' END || o_orderkey AS order_num, 'ST' || (o_custkey % 9) AS store_cd, CAST(o_orderdate AS DATE) AS d,
  CASE WHEN o_orderpriority LIKE '5%' THEN 'V' ELSE 'P' END AS nlr, CAST(o_orderdate AS DATE) + 5 AS eff FROM orders),
fv AS (SELECT DISTINCT cust_num, subr_num, bill_serv_cd, bill_start_date FROM w_bill_servs WHERE bill_start_date BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'),
f1 AS (SELECT a.*, s.bill_serv_cd, coalesce(s.bill_start_date, eff) AS fs FROM ask a LEFT JOIN fv s ON a.cust_num = s.cust_num AND a.subr_num = s.subr_num AND a.d <= s.bill_start_date),
f2 AS (SELECT DISTINCT l.cust_num, l.subr_num, l.order_num, l.store_cd, l.d, l.nlr, l.fs, h.inv_num, h.mkt_cd, h.ld_cd, h.ld_expired_date AS fe, m.ld_revenue, m.ld_bill_cd, coalesce(l.bill_serv_cd, m.ld_bill_cd) AS vas
  FROM f1 l JOIN w_subr_ld_hist h ON l.cust_num = h.cust_num AND l.subr_num = h.subr_num AND l.fs BETWEEN h.start_date AND h.end_date JOIN w_mkt_ref_vw m ON h.mkt_cd = m.mkt_cd),
f3 AS (SELECT *, CASE vas WHEN 'V1' THEN 30 ELSE 12 END AS rate, abs(date_diff('month', date_trunc('month', fs), date_trunc('month', fe + 1))) AS per, CASE WHEN mkt_cd = 'M2' AND vas = 'V1' THEN 12 ELSE 0 END AS freb
  FROM f2 WHERE vas IN ('V1', 'V2') AND date_trunc('month', fe) > date_trunc('month', d)),
f4 AS (SELECT 1 AS pr, * FROM f3 WHERE nlr = 'V' AND ld_revenue <> 'P' AND (ld_bill_cd = vas OR (ld_bill_cd = ' ' AND ld_revenue = 'V'))
  UNION ALL SELECT 2, * FROM f3 WHERE nlr = 'P' AND ld_revenue = 'P'
  UNION ALL SELECT 3, * FROM f3 WHERE ld_revenue <> 'P' AND (ld_bill_cd = vas OR (ld_bill_cd = ' ' AND ld_revenue = 'V'))),
fee AS (SELECT cust_num, order_num, store_cd, sum(rate * per - freb) AS fee FROM f4 JOIN (SELECT cust_num, subr_num, min(pr) AS pr FROM f4 GROUP BY 1, 2) USING (cust_num, subr_num, pr) GROUP BY 1, 2, 3),
wf AS (SELECT e.o_custkey, e.o_orderkey, e.d, e.p, e.val, a.order_num, a.store_cd, CASE WHEN p <> 5 AND max(CASE WHEN p = 5 THEN 1 ELSE 0 END) OVER (PARTITION BY e.o_custkey) = 1 THEN 0 ELSE coalesce(fee, 0) END AS vas_fee
  FROM se e JOIN ask a ON a.order_num = CASE WHEN e.o_orderkey % 5 = 0 THEN 'F' ELSE 'I' END || e.o_orderkey LEFT JOIN fee USING (cust_num, order_num, store_cd))
"""


def _charged(t: Tables, w: Warehouse) -> DataFrame:
    """Renewals with their contract revenue and the fees of their add-ons."""
    rows = settle(_services(t), "services")
    return revenue.with_fees(revenue.service_revenue(w, rows, "Premium plans"), revenue.addon_fees(w, rows, WHOLE))


@report("services_with_fees", with_tables("hs_subsidy", "pos_inv_header", "subr_ld_hist", "bill_servs", "mkt_ref_vw") + "," + _SERVICES_SQL + "," + _FEES_SQL + """
SELECT order_num, store_cd, CAST(vas_fee AS DOUBLE) AS vas_fee, CAST(val AS DOUBLE) AS total_service_revenue FROM wf
""")
def services_with_fees(t: Tables) -> DataFrame:
    """Fees merged into service revenue; a plan line gives its fee up where the line has other lines too."""
    out = _charged(t, Warehouse(t))
    return out.select("order_num", "store_cd", F.col("vas_fee").cast("double").alias("vas_fee"), F.col("total_service_revenue").cast("double").alias("total_service_revenue"))


_PRODUCTS_TABLES = ("pos_inv_header", "pos_inv_detail", "pos_return_header", "stores", "fes_usr_info", "pos_prod_ref", "hs_subsidy", "coupons")
_PRODUCTS_SQL = """
pi AS (SELECT i.*, coalesce(CASE WHEN u.salesman_flg = 'Y' THEN i.salesman_cd ELSE i.usr_id END, ' ') AS salesman FROM w_pos_inv_header i LEFT JOIN w_fes_usr_info u ON i.salesman_cd = u.usr_name
  WHERE i.inv_num LIKE 'I%' AND i.salesman_cd NOT LIKE 'CA%' AND i.pos_shop_cd IN (SELECT store_cd FROM w_stores) AND i.inv_num NOT IN (SELECT inv_num FROM w_pos_return_header WHERE trx_date >= DATE '1995-01-01')),
pd AS (SELECT d.*, r.item_cat FROM w_pos_inv_detail d LEFT JOIN w_pos_prod_ref r USING (pos_prod_cd)),
pl AS (
  SELECT 'HANDSET' AS cls, * FROM pd WHERE (warehouse = 'AH' OR (warehouse = 'AA' AND pos_prod_cd = 'CRPP')) AND pos_prod_cd <> 'LDFD'
  UNION ALL SELECT 'SIM', * FROM pd WHERE warehouse IN ('AP', 'PP') AND item_cat NOT IN ('OTHER', 'ACC', 'FIXED', 'PC3') AND pos_prod_cd NOT IN ('CRPP', 'LDFD')
  UNION ALL SELECT 'ACCESSORY', * FROM pd WHERE warehouse = 'AA' AND item_cat IN ('ACC', 'FIXED') AND pos_prod_cd NOT IN ('CRPP', 'LDFD')
  UNION ALL SELECT 'VOUCHER', * FROM pd WHERE item_cat = 'PC3' AND pos_prod_cd NOT IN ('CRPP', 'LDFD')
  UNION ALL SELECT 'OTHER', * FROM pd WHERE item_cat = 'OTHER' AND pos_prod_cd NOT IN ('CRPP', 'LDFD')),
pg AS (SELECT inv_num, cls, sum(net_amt) AS amt, sum(trade_in_amt) AS trade, CAST(sum(CASE WHEN cls = 'HANDSET' AND pos_prod_cd = 'CRPP' THEN 0 ELSE qty END) AS BIGINT) AS qty, string_agg(pos_prod_cd, ', ' ORDER BY pos_prod_cd, warehouse) AS products,
  coalesce(string_agg(warehouse, ', ' ORDER BY pos_prod_cd, warehouse), '') AS warehouses, coalesce(string_agg(item_cat, ', ' ORDER BY pos_prod_cd, warehouse), '') AS item_cats FROM pl GROUP BY 1, 2),
rb AS (SELECT inv_num, sum(net_amt) AS rebate FROM w_pos_inv_detail WHERE common_desc LIKE '%HANDSET%REBATE%' GROUP BY 1),
ps AS (SELECT cls, i.pos_shop_cd AS store_cd, g.inv_num, i.inv_date, i.online_inv_flg, i.salesman, coalesce(n.full_name, ' ') AS staff_name,
    amt - CASE WHEN cls = 'HANDSET' THEN coalesce(s.net_subsidy_amt, 0) + coalesce(c.coupon_amt, 0) ELSE 0 END AS pos_amt, trade AS trade_in_amt, CASE WHEN cls IN ('HANDSET', 'ACCESSORY') THEN coalesce(c.coupon_amt, 0) ELSE 0 END AS coupon_amt, CASE WHEN cls = 'HANDSET' THEN coalesce(rb.rebate, 0) ELSE 0 END AS rebate_amt, qty, products, warehouses, item_cats,
    CASE WHEN i.salesman_cd LIKE 'FA%' OR i.usr_id LIKE 'FA%' THEN 'Y' ELSE 'N' END AS fa_inv_flg
  FROM pi i JOIN pg g ON i.inv_num = g.inv_num LEFT JOIN rb ON i.inv_num = rb.inv_num LEFT JOIN w_hs_subsidy s ON i.inv_num = s.inv_num LEFT JOIN w_coupons c ON i.inv_num = c.inv_num
  LEFT JOIN (SELECT u.usr_name, f.full_name FROM w_fes_usr_info u JOIN (SELECT staff_id, arg_min(full_name, pos_shop_cd || lpad(CAST(create_ts AS VARCHAR), 4, '0')) AS full_name FROM w_fes_usr_info WHERE upper(full_name) NOT LIKE '%TEST%' GROUP BY 1) f USING (staff_id) WHERE upper(u.full_name) NOT LIKE '%TEST%') n ON i.salesman = n.usr_name)
"""


@report("product_class_sales", with_tables(*_PRODUCTS_TABLES) + "," + _PRODUCTS_SQL + """
SELECT cls, store_cd, inv_num, inv_date, salesman, staff_name, CAST(pos_amt AS DOUBLE) AS pos_amt, CAST(trade_in_amt AS DOUBLE) AS trade_in_amt, CAST(coupon_amt AS DOUBLE) AS coupon_amt, CAST(rebate_amt AS DOUBLE) AS rebate_amt, qty, products, warehouses, item_cats, fa_inv_flg FROM ps
""")
def product_class_sales(t: Tables) -> DataFrame:
    """Sales per invoice and product class in one pass over the invoice lines."""
    out = revenue.product_sales(Warehouse(t), WHOLE)
    sums = [F.col(c).cast("double").alias(c) for c in ("pos_amt", "trade_in_amt", "coupon_amt", "rebate_amt")]
    return out.select("cls", "store_cd", "inv_num", "inv_date", "salesman", "staff_name", *sums, "qty", "products", "warehouses", "item_cats", "fa_inv_flg")


def _simple_services(t: Tables) -> DataFrame:
    p = F.substring("o_orderpriority", 1, 1)
    tier = F.when(p == "1", "01. Unlimited").when(p == "2", "03. Mid").when(p == "3", "13. Fibre").when(p == "4", "17. Phone").otherwise("12. Other plans")
    amount = money("o_totalprice")
    chan = F.when(p == "1", "RBD").when(p == "2", "online").when(p == "3", "BM").otherwise("Cold call")
    return orders(t).select(
        F.concat(F.lit("ST"), (F.col("o_custkey") % 9).cast("string")).alias("store_cd"), F.concat(F.lit("NAME "), (F.col("o_orderkey") % 4).cast("string")).alias("staff_name"),
        F.col("o_orderdate").alias("inv_date"), F.concat(F.lit("I"), "o_orderkey").alias("order_num"), tier.alias("rate_plan_grp"), chan.alias("channel_effort"),
        F.when(F.col("o_orderstatus") == "F", amount).otherwise(0).cast("decimal(18,2)").alias("super_care_plan"), F.when(F.col("o_orderstatus") == "O", amount).otherwise(0).cast("decimal(18,2)").alias("other_service_plan"),
        F.when(F.col("o_orderstatus") == "P", F.lit(9)).otherwise(0).cast("decimal(18,2)").alias("vas_fee"), F.when(F.col("o_orderstatus") == "P", F.lit(0)).otherwise(amount).cast("decimal(18,2)").alias("total_service_revenue"),
        F.when(F.col("o_orderkey") % 13 == 0, "FA1").otherwise(F.concat(F.lit("SM"), (F.col("o_orderkey") % 11).cast("string"))).alias("create_by"), F.concat(F.lit("SM"), (F.col("o_orderkey") % 7).cast("string")).alias("usr_id"),
    )


_SIMPLE_SQL = """
ss AS (SELECT 'ST' || (o_custkey % 9) AS store_cd, 'NAME ' || (o_orderkey % 4) AS staff_name, CAST(o_orderdate AS DATE) AS inv_date, 'I' || o_orderkey AS order_num, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS p, o_orderstatus AS st, CAST(o_totalprice AS DECIMAL(18,2)) AS amt,
  CASE WHEN o_orderkey % 13 = 0 THEN 'FA1' ELSE 'SM' || (o_orderkey % 11) END AS create_by, 'SM' || (o_orderkey % 7) AS usr_id FROM orders)
"""


_MEASURES = [*revenue.ITEMS, "total"]


def _each(pattern: str, names: list[str] = _MEASURES) -> str:
    return ", ".join(pattern.replace("@", n) for n in names)


_SIMPLE_ITEMS = {"super_care_plan": "CASE WHEN st = 'F' THEN amt ELSE 0 END", "other_service_plan": "CASE WHEN st = 'O' THEN amt ELSE 0 END", "non_service_plan": "CASE WHEN st = 'P' THEN 9 ELSE 0 END"}


def _summary_sql(service: dict[str, str] = _SIMPLE_ITEMS) -> str:
    """Cents are summed; an average is rounded half away from zero to a tenth of a cent."""
    product = {item: f"CASE WHEN cls = '{cls}' THEN v ELSE 0 END" for cls, item in (("HANDSET", "handset"), ("SIM", "prepaid_sim"), ("ACCESSORY", "accessories"), ("VOUCHER", "prepaid_voucher"), ("OTHER", "other"))}
    pick = lambda have: ", ".join(f"{have.get(i, '0')} AS {i}" for i in revenue.ITEMS)
    average = "sign(@) * ((abs(@) * 20 + m) // (2 * m)) / 1000.0 AS @"
    return f"""
u AS (SELECT inv_date, store_cd, staff_name, {pick(service)}, 'S' || order_num AS doc, 'S' AS k FROM ss
  UNION ALL SELECT inv_date, store_cd, staff_name, {pick(product)}, inv_num, cls FROM (SELECT *, pos_amt + CASE cls WHEN 'HANDSET' THEN trade_in_amt WHEN 'ACCESSORY' THEN coupon_amt ELSE 0 END AS v FROM ps)),
v AS (SELECT *, {" + ".join(revenue.ITEMS)} AS total FROM u WHERE store_cd IN (SELECT store_cd FROM w_stores WHERE daily_sales_sms = 'Y')),
c AS (SELECT inv_date, store_cd, staff_name, CAST(sum(n) AS BIGINT) AS n FROM (SELECT inv_date, store_cd, staff_name, k, count(DISTINCT doc) AS n FROM v GROUP BY ALL) GROUP BY 1, 2, 3),
d AS (SELECT inv_date, store_cd, staff_name, {_each("CAST(sum(@) * 100 AS BIGINT) AS @")}, any_value(n) AS n FROM v JOIN c USING (inv_date, store_cd, staff_name) GROUP BY 1, 2, 3),
s AS (SELECT inv_date, store_cd, {_each("CAST(sum(@) AS BIGINT) AS @")}, CAST(sum(n) AS BIGINT) AS n, count(*) AS m FROM d GROUP BY 1, 2),
a AS (SELECT inv_date, {_each("CAST(sum(@) AS BIGINT) AS @")}, CAST(sum(n) AS BIGINT) AS n, count(*) AS m FROM s GROUP BY 1)
SELECT inv_date, store_cd, staff_name, {_each("@ / 100.0 AS @")}, CAST(n AS DOUBLE) AS inv_cnt, 'N' AS summ_fig FROM d
UNION ALL SELECT inv_date, store_cd, store_cd || ' Total', {_each("@ / 100.0 AS @")}, CAST(n AS DOUBLE), 'Y' FROM s
UNION ALL SELECT inv_date, store_cd, store_cd || ' Average', {_each(average)}, ((n * 2000 + m) // (2 * m)) / 1000.0, 'Y' FROM s
UNION ALL SELECT inv_date, 'All RBD', 'All RBD Total', {_each("@ / 100.0 AS @")}, CAST(n AS DOUBLE), 'Y' FROM a
UNION ALL SELECT inv_date, 'All RBD', 'All RBD Average', {_each(average)}, ((n * 2000 + m) // (2 * m)) / 1000.0, 'Y' FROM a
"""


@report("store_staff_summary", with_tables(*_PRODUCTS_TABLES) + "," + _PRODUCTS_SQL + "," + _SIMPLE_SQL + "," + _summary_sql())
def store_staff_summary(t: Tables) -> DataFrame:
    """Revenue by day, store and staff with totals and averages, every measure."""
    w = Warehouse(t)
    out = revenue.store_staff_summary(w, _simple_services(t), settle(revenue.product_sales(w, WHOLE), "products"))
    return out.select("inv_date", "store_cd", "staff_name", *[F.col(c).cast("double").alias(c) for c in (*_MEASURES, "inv_cnt")], "summ_fig")


_CHAIN_SQL = """
names AS (SELECT u.usr_name, f.full_name FROM w_fes_usr_info u JOIN (SELECT staff_id, arg_min(full_name, pos_shop_cd || lpad(CAST(create_ts AS VARCHAR), 4, '0')) AS full_name FROM w_fes_usr_info WHERE upper(full_name) NOT LIKE '%TEST%' GROUP BY 1) f USING (staff_id) WHERE upper(u.full_name) NOT LIKE '%TEST%'),
ss AS (SELECT store_cd, coalesce(n.full_name, ' ') AS staff_name, d AS inv_date, order_num, CASE WHEN p IN (1, 4) THEN val ELSE 0 END AS care, CASE WHEN p IN (1, 4) THEN 0 ELSE val END AS plain, vas_fee
  FROM wf LEFT JOIN (SELECT DISTINCT * FROM names) n ON n.usr_name = 'SM' || (o_orderkey % 11))
"""


@report("store_staff_chain", with_tables(*_PRODUCTS_TABLES, "subr_ld_hist", "bill_servs", "mkt_ref_vw") + "," + _PRODUCTS_SQL + "," + _SERVICES_SQL + "," + _FEES_SQL + "," + _CHAIN_SQL + ","
        + _summary_sql({"super_care_plan": "care", "other_service_plan": "plain", "non_service_plan": "vas_fee"}))
def store_staff_chain(t: Tables) -> DataFrame:
    """The summary made from the revenue and fee steps before it: renewals to revenue, fees, sellers, then store and staff."""
    w = Warehouse(t)
    names = channel.staff_names(w).select(F.col("usr_name").alias("create_by"), F.col("full_name").alias("staff_name")).distinct()
    services = _charged(t, w).join(names, "create_by", "left").withColumn("staff_name", F.coalesce("staff_name", F.lit(" ")))
    out = revenue.store_staff_summary(w, services, settle(revenue.product_sales(w, WHOLE), "products"))
    return out.select("inv_date", "store_cd", "staff_name", *[F.col(c).cast("double").alias(c) for c in (*_MEASURES, "inv_cnt")], "summ_fig")


_RATED_SQL = """
own AS (SELECT store_cd FROM w_stores WHERE daily_sales_sms = 'Y'),
sr AS (SELECT s.*, CASE WHEN p IN (1, 2, 5) THEN 'postpaid' WHEN p = 3 THEN 'fbb' ELSE 'hp' END AS kind, CASE st WHEN 'P' THEN 9 ELSE amt END AS v, CASE p WHEN 1 THEN 0.9 WHEN 2 THEN 0.5 WHEN 3 THEN 1 ELSE 0.6 END AS rate, CASE p WHEN 1 THEN 0.6 WHEN 2 THEN 0.4 WHEN 5 THEN 0.3 END AS margin FROM ss s),
pr AS (SELECT *, CASE WHEN salesman LIKE 'FA%' THEN 0.7 WHEN online_inv_flg IN ('Y', 'B') THEN 0.5 WHEN store_cd IN (SELECT store_cd FROM own) THEN 0.9 ELSE 0.4 END AS chan_rate,
    CASE cls WHEN 'HANDSET' THEN 'handset' WHEN 'ACCESSORY' THEN 'accessory' WHEN 'OTHER' THEN 'others' ELSE 'prepaid' END AS kind, pos_amt + CASE cls WHEN 'HANDSET' THEN trade_in_amt + rebate_amt WHEN 'ACCESSORY' THEN coupon_amt ELSE 0 END AS v FROM ps)
"""


_MINUS_SQL = "'3', '3.1', '3.2', '4', '5', '6', '7', '8', '8.1', '8.2', '8.3'"


@report("contribution_by_store", with_tables(*_PRODUCTS_TABLES, "channel_cost", "headcount", "cost_codes", "cost_centres", "store_orders", "sim_cost", "depreciation", "locations") + "," + _PRODUCTS_SQL + "," + _SIMPLE_SQL + "," + _RATED_SQL + f""",
rv AS (SELECT store_cd, kind, CAST(sum(v * rate) AS DECIMAL(28,6)) AS rev FROM sr GROUP BY 1, 2 UNION ALL SELECT store_cd, kind, CAST(sum(v * CASE WHEN kind = 'others' THEN 1 ELSE chan_rate END) AS DECIMAL(28,6)) FROM pr GROUP BY 1, 2),
mg AS (SELECT store_cd, CAST(sum(v * margin) AS DECIMAL(28,6)) AS c FROM sr WHERE margin IS NOT NULL GROUP BY 1 UNION ALL SELECT store_cd, CAST(sum(rev * CASE kind WHEN 'handset' THEN 0.1 WHEN 'accessory' THEN 0.25 WHEN 'prepaid' THEN 0.2 WHEN 'others' THEN 0.15 END) AS DECIMAL(28,6)) FROM rv
  WHERE kind IN ('handset', 'accessory', 'prepaid') OR (kind = 'others' AND store_cd IN (SELECT store_code FROM w_cost_centres)) GROUP BY 1),
lg AS (SELECT 'ST' || substr(cost_center, 3) AS store_cd, account_cd, net_trx_amt FROM w_channel_cost WHERE cost_center IN (SELECT cost_center_code FROM w_cost_centres)),
ln AS (
  SELECT store_cd, '1' AS line, CAST(sum(rev) AS DOUBLE) AS amt FROM rv GROUP BY 1 UNION ALL SELECT store_cd, '2', sum(c) FROM mg GROUP BY 1
  UNION ALL SELECT c.store_code, x.line, coalesce((SELECT sum(net_trx_amt) FROM lg WHERE lg.store_cd = c.store_code AND account_cd BETWEEN x.lo AND x.hi), 0) FROM w_cost_centres c CROSS JOIN (VALUES ('3', 'A00', 'A19'), ('5', 'A20', 'A49'), ('6', 'A50', 'A69'), ('7', 'A70', 'A99')) x(line, lo, hi)
  UNION ALL SELECT store_code, '3.2', 0 FROM w_cost_centres
  UNION ALL SELECT c.store_code, '8.1', (SELECT count(*) FROM w_store_orders o WHERE o.store_cd = c.store_code AND mobile_type = 'Mobile' AND connection_type = 'New Activation' AND report_date BETWEEN DATE '1995-01-01' AND DATE '1995-01-31') * 12.5 FROM w_cost_centres c
  UNION ALL SELECT l.store_cd, '8.3', sum(deprn_amt) FROM w_depreciation d JOIN w_locations l ON d.location_code = l.location WHERE account_cd BETWEEN 'B00' AND 'B99' GROUP BY 1
  UNION ALL SELECT c.store_code, '8.2', (SELECT sum(CASE WHEN is_general AND (account_cd BETWEEN 'A00' AND 'A49') THEN net_trx_amt WHEN cost_center IN ('CC8', 'CC9') AND is_project AND account_cd BETWEEN 'A50' AND 'A69' THEN net_trx_amt WHEN cost_center IN ('CC8', 'CC9') AND account_cd BETWEEN 'A70' AND 'A99' THEN net_trx_amt ELSE 0 END) FROM w_channel_cost)
    * (SELECT count(*) FROM w_headcount WHERE split_part(acct_flexfield, '.', 2) = c.cost_center_code) / (SELECT CAST(count(*) AS DOUBLE) FROM w_headcount) FROM w_cost_centres c),
ld AS (SELECT store_cd, line, CAST(amt AS DOUBLE) AS amt FROM ln)
SELECT store_cd, line, round(amt, 2) AS amt FROM ld
UNION ALL SELECT store_cd, '9', round(coalesce(sum(CASE WHEN line = '2' THEN amt WHEN line IN ({_MINUS_SQL}) THEN -amt END), 0), 2) FROM ld GROUP BY 1
""")
def contribution_by_store(t: Tables) -> DataFrame:
    """Every line of the store report: revenue, margin, each cost, the share of the overhead, and (9) what is left."""
    w = Warehouse(t)
    out = contribution.by_store(w, _simple_services(t), settle(revenue.product_sales(w, WHOLE), "products"), WHOLE)
    return _with_result(out, ["store_cd"])


def _with_result(out: dict[str, DataFrame], by: list[str]) -> DataFrame:
    """The lines (settled, as the result is made of them) and line 9."""
    lines = out["lines"].where("line <> '-1'").select(*by, "line", "amt")
    left = out["contribution"].select(*by, F.lit("9").alias("line"), F.col("contribution").alias("amt"))
    return lines.unionByName(left).withColumn("amt", F.round("amt", 2).cast("double"))


@report("contribution_by_staff", with_tables(*_PRODUCTS_TABLES, "cost_centres", "staff_commission", "staff_list") + "," + _PRODUCTS_SQL + "," + _SIMPLE_SQL + "," + _RATED_SQL + f""",
ids AS (SELECT DISTINCT usr_name, staff_id FROM w_fes_usr_info WHERE upper(full_name) NOT LIKE '%TEST%'),
su AS (SELECT s.*, CASE WHEN create_by LIKE 'FA%' AND usr_id NOT LIKE 'FA%' AND store_cd IN (SELECT store_cd FROM own) THEN usr_id ELSE create_by END AS usr FROM sr s),
sx AS (SELECT s.*, coalesce(i.staff_id, ' ') AS staff_id FROM su s LEFT JOIN ids i ON i.usr_name = s.usr),
px AS (SELECT p.*, coalesce(i.staff_id, ' ') AS staff_id FROM pr p LEFT JOIN ids i ON i.usr_name = p.salesman),
rv AS (SELECT store_cd, staff_id, kind, CAST(sum(v * rate) AS DECIMAL(28,6)) AS rev FROM sx GROUP BY 1, 2, 3 UNION ALL SELECT store_cd, staff_id, kind, CAST(sum(v * CASE WHEN kind = 'others' THEN 1 ELSE chan_rate END) AS DECIMAL(28,6)) FROM px GROUP BY 1, 2, 3),
mg AS (SELECT store_cd, staff_id, CAST(sum(v * margin) AS DECIMAL(28,6)) AS c FROM sx WHERE margin IS NOT NULL GROUP BY 1, 2 UNION ALL SELECT store_cd, staff_id, CAST(sum(rev * CASE kind WHEN 'handset' THEN 0.1 WHEN 'accessory' THEN 0.25 WHEN 'prepaid' THEN 0.2 END) AS DECIMAL(28,6)) FROM rv WHERE kind IN ('handset', 'accessory', 'prepaid') GROUP BY 1, 2),
mem AS (SELECT store_cd, staff_id, sum(rev) AS r FROM rv GROUP BY 1, 2),
deal AS (SELECT DISTINCT * FROM (
  SELECT store_cd, staff_id, usr, order_num AS inv_num, CASE p WHEN 1 THEN 0.9 WHEN 2 THEN 0.5 WHEN 3 THEN NULL ELSE 0.6 END AS rate FROM sx
  UNION ALL SELECT store_cd, staff_id, salesman, inv_num, CASE WHEN fa_inv_flg = 'Y' THEN 0.7 ELSE chan_rate END FROM px)),
gd AS (SELECT inv_num, sum(CASE pos_prod_cd WHEN 'P4' THEN 1.25 WHEN 'P7' THEN 0.5 END) AS c FROM w_pos_inv_detail WHERE pos_prod_cd IN ('P4', 'P7') GROUP BY 1),
ln AS (
  SELECT store_cd, staff_id, '1' AS line, CAST(r AS DECIMAL(28,6)) AS amt FROM mem
  UNION ALL SELECT store_cd, staff_id, '2', CAST(sum(c) AS DECIMAL(28,6)) FROM mg GROUP BY 1, 2
  UNION ALL SELECT m.store_cd, m.staff_id, '3', CAST(coalesce((SELECT sum(commission_payable) FROM w_staff_commission q WHERE q.shop_cd = m.store_cd AND q.staff_code = m.staff_id), 0) AS DECIMAL(28,6)) FROM mem m
  UNION ALL SELECT m.store_cd, m.staff_id, '4', CAST(coalesce(g.c, 0) AS DECIMAL(28,6)) FROM mem m LEFT JOIN (SELECT store_cd, staff_id, sum(gd.c * rate) AS c FROM deal JOIN gd USING (inv_num) GROUP BY 1, 2) g USING (store_cd, staff_id)
  UNION ALL SELECT m.store_cd, m.staff_id, '5', coalesce(k.total_package, 0) FROM mem m LEFT JOIN (SELECT DISTINCT store_code AS store_cd, staff_no AS staff_id, total_package FROM w_staff_list JOIN w_cost_centres ON dept_code = cost_center_code) k USING (store_cd, staff_id)),
ld AS (SELECT store_cd, staff_id, line, CAST(amt AS DECIMAL(28,6)) AS amt FROM ln)
SELECT store_cd, staff_id, line, CAST(round(amt, 2) AS DOUBLE) AS amt FROM ld
UNION ALL SELECT store_cd, staff_id, '9', CAST(round(coalesce(sum(CASE WHEN line = '2' THEN amt WHEN line IN ({_MINUS_SQL}) THEN -amt END), 0), 2) AS DOUBLE) FROM ld GROUP BY 1, 2
""")
def contribution_by_staff(t: Tables) -> DataFrame:
    """Every line of the staff report: revenue, margin, commission, premium goods, manpower, and (9) what is left."""
    w = Warehouse(t)
    products = settle(revenue.product_sales(w, WHOLE), "products")
    return _with_result(contribution.by_staff(w, _simple_services(t), products, channel.staff_names(w), WHOLE), ["store_cd", "staff_id"])
