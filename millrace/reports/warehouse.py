"""Warehouse-shaped tables derived from the driver's tables, in Spark and as SQL text.

They give the report plans inputs of the right shape and of the driver tables' size: orders stand
for invoices, lines for invoice details, a customer's successive orders for its history.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import money, month_start
from millrace.operators import constant_rows
from millrace.params import OPEN_DATE
from millrace.reports.common import lines, orders, priority_history
from millrace.storage import settle
from millrace.sources.tables import Tables

COMM_MONTH = date(2002, 1, 1)
FIRST, LAST = date(1995, 1, 1), date(2001, 12, 31)
AMT = "decimal(12,2)"


def _p() -> Column:
    return F.substring("o_orderpriority", 1, 1).cast("int")


def _text(prefix: str, c: Column | str) -> Column:
    return F.concat(F.lit(prefix), (F.col(c) if isinstance(c, str) else c).cast("string"))


def _inv(key: str) -> Column:
    return F.concat(F.when(F.pmod(key, F.lit(5)) == 0, "F").otherwise("I"), F.col(key).cast("string"))


def _line() -> list[Column]:
    return [_text("C", "o_custkey").alias("cust_num"), _text("S", "o_custkey").alias("subr_num")]


def pos_inv_header(t: Tables) -> DataFrame:
    p, key = _p(), F.col("o_orderkey")
    return orders(t).select(
        _inv("o_orderkey").alias("inv_num"), F.col("o_orderdate").alias("inv_date"), *_line(),
        F.when((F.col("o_orderstatus") == "P") & (p == 5), "CSTPN").otherwise(_text("M", p)).alias("mkt_cd"),
        F.when((F.col("o_orderstatus") == "F") & (p == 4), " ").otherwise(F.concat(F.lit("LDC"), F.lpad((p * 6).cast("string"), 2, "0"), F.lit("X"))).alias("ld_cd"),
        F.add_months("o_orderdate", p * 6).alias("ld_expiry_date"), _text("RP", p).alias("rate_plan_cd"),
        _text("ST", F.pmod("o_custkey", F.lit(9))).alias("pos_shop_cd"),
        F.when(F.pmod(key, F.lit(13)) == 0, "FA1").when(F.pmod(key, F.lit(17)) == 0, "CA1").otherwise(_text("SM", F.pmod(key, F.lit(11)))).alias("salesman_cd"),
        _text("SM", F.pmod(key, F.lit(7))).alias("usr_id"),
        F.when(F.col("o_totalprice") > 400000, "Y").otherwise("N").alias("online_inv_flg"),
    )


def pos_inv_detail(t: Tables) -> DataFrame:
    part = F.col("l_partkey")
    return t.lineitem.select(
        _inv("l_orderkey").alias("inv_num"),
        F.when(F.pmod(part, F.lit(40)) == 0, "CRPP").when(F.pmod(part, F.lit(41)) == 0, "LDFD").otherwise(_text("P", F.pmod(part, F.lit(10)))).alias("pos_prod_cd"),
        F.when(F.col("l_returnflag") == "A", "AH").when(F.col("l_returnflag") == "N", "AA").otherwise("AP").alias("warehouse"),
        money("l_extendedprice").alias("net_amt"), money(F.col("l_tax") * 100).alias("trade_in_amt"), F.col("l_quantity").cast("bigint").alias("qty"),
        F.when(F.pmod(part, F.lit(23)) == 0, "HANDSET CASH REBATE").otherwise("ITEM").alias("common_desc"),
    )


def pos_return_header(t: Tables) -> DataFrame:
    return lines(t).where("l_returnflag = 'R' and l_quantity = 50").select(_inv("l_orderkey").alias("inv_num"), F.col("l_shipdate").alias("trx_date"))


def _history(t: Tables) -> DataFrame:
    """The history that takes a window and a join to make, written once for all tables made of it."""
    return t.stage("priority_history", lambda: settle(priority_history(t), "priority_history"))


def subr_info_hist(t: Tables) -> DataFrame:
    digit = F.substring("plan", 1, 1)
    return _history(t).select(
        *_line(), F.when(digit == "5", "PE").otherwise("OK").alias("subr_stat_cd"), F.concat(F.lit("RP"), digit).alias("rate_plan_cd"), F.lit(1).alias("bill_cycle"),
        F.lit(OPEN_DATE).alias("subr_sw_on_date"), F.lit(OPEN_DATE).alias("subr_sw_off_date"), "start_date", "end_date",
    )


def subr_ld_hist(t: Tables) -> DataFrame:
    h = pos_inv_header(t).where("ld_cd <> ' ' and inv_num like 'I%'")
    return h.select(
        "inv_num", "cust_num", "subr_num", "ld_cd", "mkt_cd", F.col("inv_date").alias("ld_start_date"), F.col("ld_expiry_date").alias("ld_expired_date"),
        *[F.lit("N").alias(c) for c in ("void_flg", "waived_flg", "billed_flg")], F.col("inv_date").alias("start_date"), F.lit(OPEN_DATE).alias("end_date"),
    )


def inv_header(t: Tables) -> DataFrame:
    return orders(t).select(_text("B", "o_orderkey").alias("inv_num"), *_line(), F.date_add("o_orderdate", 20).alias("inv_date"))


def sal_led(t: Tables) -> DataFrame:
    p = _p()
    return orders(t).where("o_orderstatus = 'F'").select(
        *_line(), F.date_add("o_orderdate", 25).alias("trx_date"), F.concat(F.lit("PAY"), p.cast("string"), F.lit("-X")).alias("sal_trx_type_cd"), (p * -10).cast(AMT).alias("sal_led_amt")
    )


def sal_led_history(t: Tables) -> DataFrame:
    p = _p()
    return orders(t).where("o_orderstatus = 'O'").select(
        *_line(), month_start(F.date_add("o_orderdate", 20)).alias("trx_hist_month"), F.concat(F.lit("PAYH-"), p.cast("string")).alias("transaction_type"), (-p).cast(AMT).alias("transaction_amount")
    )


def hs_subsidy(t: Tables) -> DataFrame:
    per = t.lineitem.where("l_returnflag = 'A'").groupBy("l_orderkey").agg(F.sum(F.col("l_discount").cast("decimal(4,2)")).alias("d"))
    return per.select(_inv("l_orderkey").alias("inv_num"), (F.col("d") * 100).cast(AMT).alias("net_subsidy_amt"))


def pos_crbk_detail(t: Tables) -> DataFrame:
    p = _p()
    return orders(t).where("o_orderstatus <> 'O'").select(
        *_line(), F.date_add("o_orderdate", F.when(F.col("o_orderstatus") == "F", 1).otherwise(2)).alias("crbk_date"), _text("CR", p).alias("credit_cd"),
        F.when(p == 2, _inv("o_orderkey")).otherwise(F.lit(" ")).alias("inv_num"),
    )


def comm_overr_hist(t: Tables) -> DataFrame:
    rows = t.orders.where("o_totalprice > 450000 and substring(o_orderpriority, 1, 1) = '4'")
    return rows.select(
        _inv("o_orderkey").alias("inv_num"), F.lit(COMM_MONTH).alias("comm_mth"), F.lit("M1").alias("overr_mkt_cd"), F.lit(" ").alias("overr_ld_cd"), F.lit("SM1").alias("salesman_cd")
    )


def changes(state: str, kind: str) -> Callable[[Tables], DataFrame]:
    """Change orders: those of one order status stand for pending or completed ones."""

    def make(t: Tables) -> DataFrame:
        p = _p()
        rows = orders(t).where(F.col("o_orderstatus") == state)
        prefix = "FL" if kind == "fl_om" else "ORDER"
        return rows.select(
            *_line(), _text(prefix, "o_orderkey").alias("case_id"), F.date_add("o_orderdate", 3).alias("create_date"),
            F.lpad(F.pmod("o_orderkey", F.lit(240000)).cast("string"), 6, "0").alias("create_time"), _text("SM", F.pmod("o_orderkey", F.lit(7))).alias("create_by"), _text("M", p).alias("mkt_cd"),
            F.when(p == 1, " ").otherwise(F.concat(F.lit("LDC"), F.lpad((p * 6).cast("string"), 2, "0"), F.lit("X"))).alias("ld_cd"),
            F.when(p == 3, " ").otherwise(_text("RP", F.lit(6) - p)).alias("new_plan_cd"),
            F.when(p == 2, "V1,V2,").when(p == 4, "V9").otherwise(" ").alias("add_vas"), F.when(p == 5, "V2").otherwise(" ").alias("end_vas"),
            F.date_add("o_orderdate", 5).alias("eff_date"),
        )

    return make


def bill_servs(t: Tables) -> DataFrame:
    return orders(t).where("substring(o_orderpriority, 1, 1) = '3'").select(
        *_line(), F.lit("V1").alias("bill_serv_cd"), F.date_add("o_orderdate", 4).alias("bill_start_date"), F.lit(OPEN_DATE).alias("bill_end_date")
    )


def bill_servs_pend(t: Tables) -> DataFrame:
    return orders(t).where("substring(o_orderpriority, 1, 1) = '2'").select(
        *_line(), F.lit("V2").alias("bill_serv_cd"), F.date_add("o_orderdate", 4).alias("bill_start_date"), F.add_months("o_orderdate", 2).alias("bill_end_date")
    )


# Small reference tables: rows and column types. SQL below repeats them as VALUES.
CONST: dict[str, tuple[str, list[tuple]]] = {
    "mkt_ref_vw": ("mkt_cd string, ld_revenue string, ld_bill_cd string", [("M1", "P", " "), ("M2", "V", "V1"), ("M3", "P", " "), ("M4", "O", " "), ("M5", "V", " "), ("CSTPN", "P", " ")]),
    "bill_serv_ref": ("bill_serv_cd string, bill_rate int, eff_start_date string, eff_end_date string", [(f"RP{n}", n * 100, "1990-01-01", "2999-12-31") for n in range(1, 6)] + [("V1", 30, "1990-01-01", "2999-12-31"), ("V2", 12, "1990-01-01", "2999-12-31"), ("ADM", 18, "1990-01-01", "2999-12-31")]),
    "non_rev_type_ref": ("trx_category string, trx_type_cd string", [("PAY", "PAY3%"), ("OTH", "%")]),
    "retent_salesman": ("salesman_cd string, comm_mth string, sale_team string", [(f"SM{n}", "2002-01-01", "T" + str(n % 3)) for n in range(9)]),
    "comm_mkt_ref": ("mkt_cd string, comm_mth string, bm_cat string, eff_s_date string, eff_e_date string, override_flg string, overr_rebate_amt int, overr_bill_rate int", [
        ("M1", "2002-01-01", "Main", "1995-01-01", "1998-12-31", "N", 0, 0), ("M2", "2002-01-01", "Addon", "1995-01-01", "2001-12-31", "N", 0, 0),
        ("M3", "2002-01-01", "Others", "1995-01-01", "2001-12-31", "Y", -5, 50),
    ]),
    "srvcb": ("mkt_cd string, credit_back_cd string, credit_back_amt int, start_date string, end_date string", [("M1", "CR1", 15, "1990-01-01", "2999-12-31"), ("M2", "CR2", 20, "1990-01-01", "2999-12-31"), ("M1", "CR3", 7, "1990-01-01", "2999-12-31")]),
    "fes_hs_bonus_hist": ("mkt_cd string, prod_cd string, credit_back_cd string, credit_back_amt int, start_date string, end_date string", [("M1", "P5", "HB", 2, "1990-01-01", "2999-12-31")]),
    "stores": ("store_cd string, daily_sales_sms string", [(f"ST{n}", "Y" if n % 2 else "N") for n in range(8)]),
    "fes_usr_info": ("usr_name string, staff_id string, full_name string, pos_shop_cd string, grp_name string, call_centre_team string, salesman_flg string, create_ts int", [
        (f"SM{n}", f"E{n // 2}", f"NAME {n}", f"ST{n}", "GRP", "TS" if n == 3 else " ", "Y" if n % 3 else "N", n) for n in range(11)
    ] + [("FA1", "E9", "STREET ONE", "ST1", "GRP", " ", "Y", 90), ("SMX", "E0", "Test user", "ST1", "GRP", " ", "Y", 91)]),
    "pos_prod_ref": ("pos_prod_cd string, item_cat string", [("P0", "ACC"), ("P1", "FIXED"), ("P2", "OTHER"), ("P3", "PC3"), ("P4", "HS"), ("P5", "HS"), ("P6", "SIM"), ("P7", "SIM"), ("P8", "OTHER"), ("CRPP", "ACC"), ("LDFD", "OTHER")]),
    "entitle_ref": ("bill_serv_cd string, free_data_entitle string", [("V1", "PACK"), ("V2", "PACK")]),
    "rate_plan_ref": ("rate_plan_cd string, rate_plan_grp string, free_data_entitle string, high_tier string", [("RP1", "G1", "E1", "Y"), ("RP2", "G2", "E2", "N"), ("RP3", "G3", "E3", "Y"), ("RP4", "G4", "E4", "N"), ("RP5", "G5", "E5", "N")]),
    "plan_grp_ref": ("free_data_entitle string, shk_plan_grp string", [("E1", "Premium plans"), ("E2", "Other"), ("E4", "Premium plans")]),
    "suppl_serv_map": ("rate_plan_cd string, suppl_serv_cd string", [("RP1", "ADM"), ("RP3", "ADM"), ("RP4", "XYZ")]),
    "crbk_offer_ref": ("mkt_cd string, cr_cd string, ctr_type string, pattern string, period_cnt int", [("M1", "K1", "PERIODIC", "YNYy", 9), ("M2", "K2", "FIXED", " ", 3)]),
    "crbk_check_ref": ("cr_cd string, cb_amt int, vas_cd string", [("K1", 5, "RP1,RP4"), ("K2", 4, "V1")]),
    "mkt_rebate_ref": ("mkt_cd string, rebate_amt int", [("M1", 11)]),
    "channel_rate": ("channel string, discount_rate double", [("RBD", 0.9), ("Online", 0.5), ("Street fighter", 0.7), ("Others", 0.4), ("Cold call", 0.6)]),
    "margin": ("grp_name string, margin double", [("01. Unlimited", 0.6), ("02. High", 0.5), ("03. Mid", 0.4), ("12. Other plans", 0.3), ("Handset", 0.1), ("Accessory", 0.25), ("Prepaid", 0.2), ("Others", 0.15)]),
    "cost_codes": ("acct_code_start string, acct_code_end string, expenses_nature string", [("A00", "A19", "Commission"), ("A20", "A49", "Manpower costs"), ("A50", "A69", "Rental & utilities"), ("A70", "A99", "MIS expenses"), ("B00", "B99", "Headcount")]),
    "cost_centres": ("cost_center_code string, store_code string", [(f"CC{n}", f"ST{n}") for n in range(8)]),
    "sim_cost": ("trx_mth string, sim_cost double", [("1995-01-01", 12.5)]),
    "locations": ("location string, store_cd string, trx_mth string", [(f"LOC{n}", f"ST{n % 6}", "1995-01-01") for n in range(9)]),
    "premium_cost": ("product_code string, unit_cost double, trx_month string", [("P4", 1.25, "1995-01-01"), ("P7", 0.5, "1995-01-01")]),
    "shared_codes": ("acct_code_start string, acct_code_end string, expenses_nature string, trx_mth string", [("A00", "A49", "Administration expenses", "1995-01-01"), ("A50", "A69", "Marketing expense", "1995-01-01"), ("A70", "A99", "Marketing expense2", "1995-01-01")]),
}
_DATES = {"eff_start_date", "eff_end_date", "comm_mth", "eff_s_date", "eff_e_date", "start_date", "end_date", "trx_mth", "trx_month"}
_DECIMALS = {"bill_rate", "overr_rebate_amt", "overr_bill_rate", "credit_back_amt", "cb_amt", "rebate_amt", "discount_rate", "margin", "sim_cost", "unit_cost"}

MADE: dict[str, Callable[[Tables], DataFrame]] = {
    "pos_inv_header": pos_inv_header, "pos_inv_detail": pos_inv_detail, "pos_return_header": pos_return_header, "subr_info_hist": subr_info_hist,
    "subr_ld_hist": subr_ld_hist, "inv_header": inv_header, "sal_led": sal_led, "sal_led_history": sal_led_history, "hs_subsidy": hs_subsidy,
    "pos_crbk_detail": pos_crbk_detail, "comm_overr_hist": comm_overr_hist, "om_pending": changes("P", "om"), "om_complete": changes("F", "om"),
    "fl_om_pending": changes("O", "fl_om"), "fl_om_complete": changes("F", "fl_om"), "bill_servs": bill_servs, "bill_servs_pend": bill_servs_pend,
}


def _prepd(t: Tables) -> DataFrame:
    return t.customer.where("c_mktsegment = 'BUILDING'").select(_text("C", "c_custkey").alias("cust_num"), _text("S", "c_custkey").alias("subr_num"), F.lit("L").alias("line_cat"))


def _recpt_detail(t: Tables) -> DataFrame:
    return orders(t).where("o_totalprice > 250000").select(_text("R", "o_orderkey").alias("recpt_num"), _inv("o_orderkey").alias("inv_num"), F.col("o_orderdate").alias("recpt_date"))


def _recpt_payment(t: Tables) -> DataFrame:
    two = F.explode(F.array(F.lit("COUPON"), F.lit("CASH"))).alias("payment_cd")
    return orders(t).where("o_totalprice > 250000").select(_text("R", "o_orderkey").alias("recpt_num"), F.col("o_orderdate").alias("recpt_date"), two, F.lit(25).cast(AMT).alias("amt"))


def _entitle_hist(t: Tables) -> DataFrame:
    h = _history(t).where("plan <> '3-MEDIUM'")
    return h.select(*_line(), F.concat(F.lit("E"), F.substring("plan", 1, 1)).alias("free_data_entitle"), "start_date", "end_date")


def _ledger(t: Tables) -> DataFrame:
    s = F.col("l_suppkey")
    return t.lineitem.select(
        _text("CC", F.pmod(s, F.lit(10))).alias("cost_center"), F.concat(F.lit("A"), F.lpad(F.pmod("l_partkey", F.lit(100)).cast("string"), 2, "0")).alias("account_cd"),
        F.lit(FIRST).alias("period"), money("l_extendedprice").alias("net_trx_amt"),
        F.when(s % 10 == 9, "Y").otherwise("N").alias("is_general"), F.when(F.col("l_linenumber") == 1, "Y").otherwise("N").alias("is_project"),
    )


def _headcount(t: Tables) -> DataFrame:
    return t.customer.select(F.concat(F.lit("10.CC"), F.pmod("c_custkey", F.lit(7)).cast("string"), F.lit(".5")).alias("acct_flexfield"), F.lit(FIRST).alias("trx_mth"), F.lit(1).alias("headcount"))


def _store_orders(t: Tables) -> DataFrame:
    p = _p()
    return orders(t).select(
        _text("ST", F.pmod("o_custkey", F.lit(9))).alias("store_cd"), F.when(p <= 3, "Mobile").otherwise("Fixed").alias("mobile_type"),
        F.when(F.col("o_orderstatus") == "F", "New Activation").otherwise("Renewal").alias("connection_type"), F.date_add(F.lit(FIRST), F.pmod("o_orderkey", F.lit(40)).cast("int")).alias("report_date"),
    )


def _depreciation(t: Tables) -> DataFrame:
    return t.lineitem.select(
        _text("LOC", F.pmod("l_suppkey", F.lit(10))).alias("location_code"), F.concat(F.when(F.pmod("l_partkey", F.lit(3)) == 0, "A").otherwise("B"), F.lpad(F.pmod("l_partkey", F.lit(100)).cast("string"), 2, "0")).alias("account_cd"),
        money(F.col("l_tax") * 100).alias("deprn_amt"), F.lit(FIRST).alias("trx_mth"),
    )


def _staff_commission(t: Tables) -> DataFrame:
    return t.customer.select(
        _text("ST", F.pmod("c_custkey", F.lit(9))).alias("shop_cd"), _text("E", F.pmod("c_custkey", F.lit(6))).alias("staff_code"), money("c_acctbal").alias("commission_payable"), F.lit(FIRST).alias("trx_month"),
    )


def _staff_list(t: Tables) -> DataFrame:
    """All suppliers as staff: one package for each member and cost centre."""
    one = t.supplier.select(_text("E", F.pmod("s_suppkey", F.lit(6))).alias("staff_no"), _text("CC", F.pmod("s_suppkey", F.lit(8))).alias("dept_code"), (F.pmod("s_suppkey", F.lit(5)) * 100).cast(AMT).alias("package"))
    return one.groupBy("staff_no", "dept_code").agg(F.sum("package").cast("decimal(18,2)").alias("total_package")).withColumn("trx_month", F.lit(FIRST))


MADE.update(
    store_orders=_store_orders, depreciation=_depreciation, staff_commission=_staff_commission, staff_list=_staff_list,
    prepd_postpaid_subr=_prepd, pos_recpt_detail=_recpt_detail, pos_recpt_payment=_recpt_payment, data_entitle_hist=_entitle_hist, channel_cost=_ledger,
    shared_ledger=_ledger, headcount=_headcount,
)


SHUFFLED = {"hs_subsidy"}


class Warehouse:
    """The derived tables, each built when asked for; those that take a join or a window to derive are written once."""

    def __init__(self, t: Tables):
        self.t = t
        self.stored: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name in CONST:
            schema, rows = CONST[name]
            df = constant_rows(self.t.spark, rows, schema)
            fixed = {c: F.to_date(c) for c in df.columns if c in _DATES}
            fixed |= {c: F.col(c).cast(AMT) for c in df.columns if c in _DECIMALS}
            return df.withColumns(fixed) if fixed else df
        if name in SHUFFLED:
            if name not in self.stored:
                self.stored[name] = settle(MADE[name](self.t), name)
            return self.stored[name]
        return MADE[name](self.t)


# --- the same tables as SQL ---------------------------------------------------------------

def _const_sql(name: str) -> str:
    schema, rows = CONST[name]
    cols = [c.split()[0] for c in schema.split(", ")]
    cells = ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)
    picks = ", ".join(f"CAST({c} AS DATE) AS {c}" if c in _DATES else f"CAST({c} AS DECIMAL(12,2)) AS {c}" if c in _DECIMALS else c for c in cols)
    return f"w_{name} AS (SELECT {picks} FROM (VALUES {cells}) v({', '.join(cols)}))"


_P = "CAST(substr(o_orderpriority, 1, 1) AS INTEGER)"
_D = "CAST(o_orderdate AS DATE)"
_L = "'C' || o_custkey AS cust_num, 'S' || o_custkey AS subr_num"


def _inv_sql(k: str) -> str:
    return f"CASE WHEN {k} % 5 = 0 THEN 'F' ELSE 'I' END || {k}"


def _changes_sql(name: str, state: str, prefix: str) -> str:
    return f"""w_{name} AS (SELECT {_L}, '{prefix}' || o_orderkey AS case_id, {_D} + 3 AS create_date, lpad(CAST(o_orderkey % 240000 AS VARCHAR), 6, '0') AS create_time,
      'SM' || (o_orderkey % 7) AS create_by, 'M' || {_P} AS mkt_cd, CASE WHEN {_P} = 1 THEN ' ' ELSE 'LDC' || lpad(CAST({_P} * 6 AS VARCHAR), 2, '0') || 'X' END AS ld_cd,
      CASE WHEN {_P} = 3 THEN ' ' ELSE 'RP' || (6 - {_P}) END AS new_plan_cd, CASE WHEN {_P} = 2 THEN 'V1,V2,' WHEN {_P} = 4 THEN 'V9' ELSE ' ' END AS add_vas,
      CASE WHEN {_P} = 5 THEN 'V2' ELSE ' ' END AS end_vas, {_D} + 5 AS eff_date FROM orders WHERE o_orderstatus = '{state}')"""


_HIST = f"""w_hist AS (SELECT o_custkey, plan, d AS start_date, coalesce(lead(d) OVER (PARTITION BY o_custkey ORDER BY d) - 1, DATE '2999-12-31') AS end_date
  FROM (SELECT o_custkey, {_D} AS d, max(o_orderpriority) AS plan FROM orders GROUP BY 1, 2))"""

SQL: dict[str, str] = {name: _const_sql(name) for name in CONST} | {
    "hist": _HIST,
    "pos_inv_header": f"""w_pos_inv_header AS (SELECT {_inv_sql('o_orderkey')} AS inv_num, {_D} AS inv_date, {_L},
      CASE WHEN o_orderstatus = 'P' AND {_P} = 5 THEN 'CSTPN' ELSE 'M' || {_P} END AS mkt_cd,
      CASE WHEN o_orderstatus = 'F' AND {_P} = 4 THEN ' ' ELSE 'LDC' || lpad(CAST({_P} * 6 AS VARCHAR), 2, '0') || 'X' END AS ld_cd,
      CAST({_D} + {_P} * 6 * INTERVAL 1 MONTH AS DATE) AS ld_expiry_date, 'RP' || {_P} AS rate_plan_cd, 'ST' || (o_custkey % 9) AS pos_shop_cd,
      CASE WHEN o_orderkey % 13 = 0 THEN 'FA1' WHEN o_orderkey % 17 = 0 THEN 'CA1' ELSE 'SM' || (o_orderkey % 11) END AS salesman_cd, 'SM' || (o_orderkey % 7) AS usr_id,
      CASE WHEN o_totalprice > 400000 THEN 'Y' ELSE 'N' END AS online_inv_flg FROM orders)""",
    "pos_inv_detail": f"""w_pos_inv_detail AS (SELECT {_inv_sql('l_orderkey')} AS inv_num, CASE WHEN l_partkey % 40 = 0 THEN 'CRPP' WHEN l_partkey % 41 = 0 THEN 'LDFD' ELSE 'P' || (l_partkey % 10) END AS pos_prod_cd,
      CASE l_returnflag WHEN 'A' THEN 'AH' WHEN 'N' THEN 'AA' ELSE 'AP' END AS warehouse, CAST(l_extendedprice AS DECIMAL(18,2)) AS net_amt, CAST(l_tax * 100 AS DECIMAL(18,2)) AS trade_in_amt, CAST(l_quantity AS BIGINT) AS qty,
      CASE WHEN l_partkey % 23 = 0 THEN 'HANDSET CASH REBATE' ELSE 'ITEM' END AS common_desc FROM lineitem)""",
    "pos_return_header": f"w_pos_return_header AS (SELECT {_inv_sql('l_orderkey')} AS inv_num, CAST(l_shipdate AS DATE) AS trx_date FROM lineitem WHERE l_returnflag = 'R' AND l_quantity = 50)",
    "subr_info_hist": f"w_subr_info_hist AS (SELECT {_L}, CASE WHEN substr(plan, 1, 1) = '5' THEN 'PE' ELSE 'OK' END AS subr_stat_cd, 'RP' || substr(plan, 1, 1) AS rate_plan_cd, start_date, end_date FROM w_hist)",
    "subr_ld_hist": "w_subr_ld_hist AS (SELECT inv_num, cust_num, subr_num, ld_cd, mkt_cd, inv_date AS ld_start_date, ld_expiry_date AS ld_expired_date, inv_date AS start_date, DATE '2999-12-31' AS end_date FROM w_pos_inv_header WHERE ld_cd <> ' ' AND inv_num LIKE 'I%')",
    "inv_header": f"w_inv_header AS (SELECT 'B' || o_orderkey AS inv_num, {_L}, {_D} + 20 AS inv_date FROM orders)",
    "sal_led": f"w_sal_led AS (SELECT {_L}, {_D} + 25 AS trx_date, 'PAY' || {_P} || '-X' AS kind, CAST(-10 * {_P} AS DECIMAL(12,2)) AS amt FROM orders WHERE o_orderstatus = 'F')",
    "sal_led_history": f"w_sal_led_history AS (SELECT {_L}, CAST(date_trunc('month', {_D} + 20) AS DATE) AS mth, 'PAYH-' || {_P} AS kind, CAST(-{_P} AS DECIMAL(12,2)) AS amt FROM orders WHERE o_orderstatus = 'O')",
    "hs_subsidy": f"w_hs_subsidy AS (SELECT {_inv_sql('l_orderkey')} AS inv_num, CAST(sum(CAST(l_discount AS DECIMAL(4,2))) * 100 AS DECIMAL(12,2)) AS net_subsidy_amt FROM lineitem WHERE l_returnflag = 'A' GROUP BY l_orderkey)",
    "pos_crbk_detail": f"w_pos_crbk_detail AS (SELECT {_L}, {_D} + CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END AS crbk_date, 'CR' || {_P} AS credit_cd, CASE WHEN {_P} = 2 THEN {_inv_sql('o_orderkey')} ELSE ' ' END AS inv_num FROM orders WHERE o_orderstatus <> 'O')",
    "comm_overr_hist": f"w_comm_overr_hist AS (SELECT {_inv_sql('o_orderkey')} AS inv_num, 'M1' AS overr_mkt_cd, 'SM1' AS salesman_cd FROM orders WHERE o_totalprice > 450000 AND {_P} = 4)",
    "om_pending": _changes_sql("om_pending", "P", "ORDER"), "om_complete": _changes_sql("om_complete", "F", "ORDER"),
    "fl_om_pending": _changes_sql("fl_om_pending", "O", "FL"), "fl_om_complete": _changes_sql("fl_om_complete", "F", "FL"),
    "bill_servs": f"w_bill_servs AS (SELECT {_L}, 'V1' AS bill_serv_cd, {_D} + 4 AS bill_start_date, DATE '2999-12-31' AS bill_end_date FROM orders WHERE {_P} = 3)",
    "bill_servs_pend": f"w_bill_servs_pend AS (SELECT {_L}, 'V2' AS bill_serv_cd, {_D} + 4 AS bill_start_date, CAST({_D} + INTERVAL 2 MONTH AS DATE) AS bill_end_date FROM orders WHERE {_P} = 2)",
    "prepd_postpaid_subr": "w_prepd_postpaid_subr AS (SELECT 'C' || c_custkey AS cust_num, 'S' || c_custkey AS subr_num FROM customer WHERE c_mktsegment = 'BUILDING')",
    "coupons": f"w_coupons AS (SELECT {_inv_sql('o_orderkey')} AS inv_num, CAST(25 AS DECIMAL(12,2)) AS coupon_amt FROM orders WHERE o_totalprice > 250000)",
    "data_entitle_hist": f"w_data_entitle_hist AS (SELECT {_L}, 'E' || substr(plan, 1, 1) AS free_data_entitle, start_date, end_date FROM w_hist WHERE plan <> '3-MEDIUM')",
    "channel_cost": "w_channel_cost AS (SELECT 'CC' || (l_suppkey % 10) AS cost_center, 'A' || lpad(CAST(l_partkey % 100 AS VARCHAR), 2, '0') AS account_cd, CAST(l_extendedprice AS DECIMAL(18,2)) AS net_trx_amt, l_suppkey % 10 = 9 AS is_general, l_linenumber = 1 AS is_project FROM lineitem)",
    "store_orders": f"w_store_orders AS (SELECT 'ST' || (o_custkey % 9) AS store_cd, CASE WHEN {_P} <= 3 THEN 'Mobile' ELSE 'Fixed' END AS mobile_type, CASE WHEN o_orderstatus = 'F' THEN 'New Activation' ELSE 'Renewal' END AS connection_type, DATE '1995-01-01' + CAST(o_orderkey % 40 AS INTEGER) AS report_date FROM orders)",
    "depreciation": "w_depreciation AS (SELECT 'LOC' || (l_suppkey % 10) AS location_code, CASE WHEN l_partkey % 3 = 0 THEN 'A' ELSE 'B' END || lpad(CAST(l_partkey % 100 AS VARCHAR), 2, '0') AS account_cd, CAST(l_tax * 100 AS DECIMAL(18,2)) AS deprn_amt FROM lineitem)",
    "staff_commission": "w_staff_commission AS (SELECT 'ST' || (c_custkey % 9) AS shop_cd, 'E' || (c_custkey % 6) AS staff_code, CAST(c_acctbal AS DECIMAL(18,2)) AS commission_payable FROM customer)",
    "staff_list": "w_staff_list AS (SELECT 'E' || (s_suppkey % 6) AS staff_no, 'CC' || (s_suppkey % 8) AS dept_code, CAST(sum(s_suppkey % 5 * 100) AS DECIMAL(18,2)) AS total_package FROM supplier GROUP BY 1, 2)",
    "headcount": "w_headcount AS (SELECT '10.CC' || (c_custkey % 7) || '.5' AS acct_flexfield FROM customer)",
}


def with_tables(*names: str) -> str:
    """The start of a WITH clause that defines the named tables."""
    return "WITH " + ",\n".join(SQL[n] for n in names)
