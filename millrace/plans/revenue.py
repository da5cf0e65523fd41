"""Service revenue, add-on fees, product sales, and the store and staff summary."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import blank, contract_months, month_gap, month_start, no_code, no_date
from millrace.operators import apply_rules, drop_in, join_asof, join_eq, keep_in, split_rows, stack, waterfall, with_subtotals
from millrace.params import NO_TEXT, OPEN_DATE, Window
from millrace.plans.base import LINE, Frames, not_returned, pick, within
from millrace.plans.channel import PLAN_CHANGE, staff_names
from millrace.storage import settle

ADMIN_FEES = ["ADM", "ADM2"]
AMOUNT = "decimal(18,2)"
KEY = [*LINE, "order_num", "store_cd"]
FEW_CODES = 32  # parts of a key of few values, when rows meet a reference table that is too large to be sent to them


def market_rebates(t: Frames) -> DataFrame:
    """Rebate per market code and add-on: credit per period times the periods, plus the market's own."""
    periods = F.when(
        (F.col("ctr_type") == "PERIODIC") & ~blank("pattern"), F.regexp_count(F.upper("pattern"), F.lit("Y"))
    ).otherwise(F.col("period_cnt"))
    offers = t["crbk_offer_ref"].select("mkt_cd", "cr_cd", periods.alias("periods"))
    checks = split_rows(t["crbk_check_ref"].select("cr_cd", "cb_amt", "vas_cd"), "vas_cd", name="vas").select("cr_cd", "cb_amt", "vas")
    per = offers.join(checks, "cr_cd", "left").groupBy("mkt_cd", F.coalesce("vas", F.lit(NO_TEXT)).alias("vas_cd")).agg(
        F.sum(F.col("periods") * F.coalesce("cb_amt", F.lit(0))).cast(AMOUNT).alias("cb_amt")
    )
    own = t["mkt_rebate_ref"].select("mkt_cd", "rebate_amt").distinct()
    out = per.join(own, "mkt_cd", "left")
    return out.select("mkt_cd", "vas_cd", (F.col("cb_amt") + F.coalesce("rebate_amt", F.lit(0))).cast(AMOUNT).alias("rebate_amt"))


def months_left(orig_end: Column, orig_code: Column, day: Column) -> Column:
    """Calendar months from the day to the end of the old contract; 0 when it is over or unknown."""
    gap = month_gap(orig_end, day)
    return F.when(~no_date(orig_end) & ~no_code(orig_code) & (gap > 0), gap).otherwise(F.lit(0))


def _tariffs(t: Frames, key: str, name: str) -> DataFrame:
    open_ = t["bill_serv_ref"].where(F.col("eff_end_date") == F.lit(OPEN_DATE))
    return pick(open_, **{key: "bill_serv_cd", name: "bill_rate"})


def _admin(t: Frames, key: str, name: str) -> DataFrame:
    fees = t["suppl_serv_map"].where(F.col("suppl_serv_cd").isin(ADMIN_FEES)).join(_tariffs(t, "suppl_serv_cd", name), "suppl_serv_cd")
    return fees.groupBy(F.col("rate_plan_cd").alias(key)).agg(F.max(name).alias(name))


def service_revenue(t: Frames, rows: DataFrame, premium_group: str) -> DataFrame:
    """Contract revenue of each transaction, by the ordered rules of the report.

    Plans of `premium_group` are shown apart from the others.
    """
    rebate = market_rebates(t)
    subsidy = t["hs_subsidy"].groupBy(F.col("inv_num").alias("order_num")).agg(F.sum("net_subsidy_amt").alias("subsidy_amt"))
    premium = keep_in(t["rate_plan_ref"], t["plan_grp_ref"].where(F.col("shk_plan_grp") == premium_group), "free_data_entitle")
    super_care = premium.select("free_data_entitle").distinct().withColumn("is_super", F.lit(True))
    out = rows.join(_tariffs(t, "new_rate_plan_cd", "new_rate"), "new_rate_plan_cd", "left")
    out = out.join(_tariffs(t, "orig_rate_plan_cd", "orig_rate"), "orig_rate_plan_cd", "left")
    out = out.join(_admin(t, "new_rate_plan_cd", "new_admin"), "new_rate_plan_cd", "left")
    out = out.join(_admin(t, "orig_rate_plan_cd", "orig_admin"), "orig_rate_plan_cd", "left")
    out = out.join(pick(rebate, "mkt_cd", rate_plan_cd="vas_cd", rebate_amt="rebate_amt"), ["mkt_cd", "rate_plan_cd"], "left")
    out = out.join(subsidy, "order_num", "left").join(super_care, "free_data_entitle", "left")
    zero = F.lit(0).cast(AMOUNT)
    plan_only = F.col("ref") == PLAN_CHANGE
    out = out.withColumns(
        {
            **{c: F.coalesce(F.col(c).cast(AMOUNT), zero) for c in ("new_rate", "orig_rate", "new_admin", "orig_admin", "rebate_amt", "subsidy_amt")},
            "is_super": F.coalesce("is_super", F.lit(False)),
            "old_ld_period": F.when(~no_code("orig_ld_cd"), F.coalesce(contract_months("orig_ld_cd"), F.lit(0))).otherwise(0),
            "new_ld_period": F.when(~no_code("new_ld_cd") & ~plan_only, F.coalesce(contract_months("new_ld_cd"), F.lit(1))).otherwise(1),
            "months_left": months_left(F.col("orig_ld_exp_date"), F.col("orig_ld_cd"), F.col("inv_date")),
            **{c: zero for c in ("new_revenue", "orig_admin_fee", "orig_charge", "super_care_plan", "other_service_plan")},
        }
    )
    priced = "new_rate > 0 and "
    normal = "new_revenue - rebate_amt - orig_charge - subsidy_amt"
    switch = "(new_rate - orig_rate + new_admin - orig_admin) * abs(old_ld_period - new_ld_period)"

    def to(value: str) -> Column:
        return F.expr(f"cast({value} as {AMOUNT})")

    out = apply_rules(
        out,
        [
            ("replace_old_ld = 'N'", {"months_left": "0"}),
            ("replace_old_ld = 'Y' and trunc(orig_ld_start_date, 'MM') > trunc(inv_date, 'MM')", {"months_left": "0"}),
            ("new_ld_revenue = 'V'", {"new_admin": to("0"), "orig_admin": to("0")}),
            ("true", {"new_revenue": to("new_ld_period * (new_rate + new_admin)")}),
            ("months_left > 0", {"orig_admin_fee": to("months_left * orig_admin")}),
            ("months_left > 0", {"orig_charge": to("orig_admin_fee + months_left * orig_rate")}),
            (priced + f"is_super and ref <> '{PLAN_CHANGE}'", {"super_care_plan": to(normal)}),
            (priced + f"not is_super and ref <> '{PLAN_CHANGE}'", {"other_service_plan": to(normal)}),
            (priced + f"is_super and ref = '{PLAN_CHANGE}'", {"super_care_plan": to(switch)}),
            (priced + f"not is_super and ref = '{PLAN_CHANGE}'", {"other_service_plan": to(switch)}),
            ("new_ld_revenue = 'V'", {"super_care_plan": to("0"), "other_service_plan": to("0"), "new_revenue": to("0")}),
        ],
    )
    return out.withColumn("total_service_revenue", (F.col("super_care_plan") + F.col("other_service_plan")).cast(AMOUNT))


def fee_period(start: Column, end: Column, code: Column) -> Column:
    """Months of an add-on contract, from its dates, else from its code, else one."""
    by_date = F.abs(F.months_between(month_start(start), month_start(F.date_add(end, 1))))
    by_code = F.coalesce(contract_months(code), F.lit(1))
    return F.when(~no_date(start) & ~no_date(end), by_date).when(no_code(code), F.lit(1)).otherwise(by_code).cast("int")


def addon_fees(t: Frames, rows: DataFrame, w: Window) -> DataFrame:
    """Fee lines per line: those with an add-on market code first, then plan codes, then the rest."""
    held = pick(
        t["subr_ld_hist"], *LINE, "start_date", "end_date", ld_mkt="mkt_cd", fee_ld_cd="ld_cd", fee_end="ld_expired_date", fee_inv="inv_num"
    )
    recent = pick(t["pos_inv_header"].where(F.col("inv_date") >= F.lit(w.start)), fee_inv="inv_num")
    held = keep_in(held, recent, "fee_inv")
    services = stack(
        *[t[n].where(within("bill_start_date", w) & (F.col("bill_end_date") == F.lit(OPEN_DATE))).select(*LINE, "bill_serv_cd", "bill_start_date") for n in ("bill_servs", "bill_servs_pend")],
        distinct=True,
    )
    asked = rows.select(*KEY, "inv_date", "mkt_cd", "new_ld_revenue", "create_by", "eff_date").distinct()
    mkt = pick(t["mkt_ref_vw"], "ld_revenue", "ld_bill_cd", fee_mkt="mkt_cd")
    later = pick(services, "bill_serv_cd", "bill_start_date", of_cust="cust_num", of_subr="subr_num")
    cond = (F.col("cust_num") == F.col("of_cust")) & (F.col("subr_num") == F.col("of_subr")) & (F.col("inv_date") <= F.col("bill_start_date"))
    lines = asked.join(later, cond, "left").drop("of_cust", "of_subr")
    lines = lines.withColumn("fee_start", F.coalesce("bill_start_date", "eff_date"))
    lines = join_asof(lines, held, LINE, "fee_start", how="inner", years=w.years).withColumn("fee_mkt", F.coalesce("ld_mkt", "mkt_cd")).join(mkt, "fee_mkt")
    lines = lines.withColumn("vas_cd", F.when(~blank("bill_serv_cd"), F.col("bill_serv_cd")).otherwise(F.col("ld_bill_cd")))
    rate = _tariffs(t, "vas_cd", "vas_rate")
    lines = drop_in(lines, pick(t["rate_plan_ref"], vas_cd="rate_plan_cd"), "vas_cd").where(~F.col("vas_cd").isin(ADMIN_FEES))
    lines = lines.join(rate, "vas_cd").where("vas_rate <> 0")
    lines = lines.where(month_start("fee_end") > month_start("inv_date"))
    cols = [*KEY, "fee_inv", "fee_mkt", "fee_ld_cd", "vas_cd", "vas_rate", "fee_start", "fee_end", "create_by", "inv_date", "ld_revenue", "ld_bill_cd", "new_ld_revenue"]
    lines = lines.withColumn("ld_period", fee_period(F.col("fee_start"), F.col("fee_end"), F.col("fee_ld_cd")))
    # Not made distinct before the waterfall has taken most rows away: this would hold, or move, all of them whole.
    rebate = pick(market_rebates(t), "vas_cd", fee_mkt="mkt_cd", fee_rebate="rebate_amt").distinct()
    lines = join_eq(lines.select(*cols, "ld_period"), rebate, ["vas_cd", "fee_mkt"], "left", small=True, salt=FEW_CODES)
    lines = settle(lines.withColumn("fee_rebate", F.coalesce("fee_rebate", F.lit(0).cast(AMOUNT))), "fee_lines")
    fits = (F.col("ld_bill_cd") == F.col("vas_cd")) | (blank("ld_bill_cd") & (F.col("ld_revenue") == "V"))
    found = waterfall(
        [
            ("ADDON", lines.where((F.col("new_ld_revenue") == "V") & (F.col("ld_revenue") != "P") & fits)),
            ("PLAN", lines.where("new_ld_revenue = 'P' and ld_revenue = 'P'")),
            ("OTHER", lines.where((F.col("ld_revenue") != "P") & fits)),
        ],
        LINE,
        "fee_source",
    ).distinct()
    return found.withColumn("vas_fee", (F.col("vas_rate") * F.col("ld_period") - F.col("fee_rebate")).cast(AMOUNT))


def with_fees(rows: DataFrame, fees: DataFrame) -> DataFrame:
    """Fees summed per transaction; a plan line gives its fee up where the line has other lines too."""
    sums = fees.groupBy(*KEY).agg(F.sum("vas_fee").alias("vas_fee"))
    out = rows.join(sums, KEY, "left").withColumn("vas_fee", F.coalesce("vas_fee", F.lit(0).cast(AMOUNT)))
    other = pick(rows.where("new_ld_revenue <> 'P'"), *LINE, has_other=F.lit(True)).distinct()
    out = out.join(other, LINE, "left")
    yields = (F.col("new_ld_revenue") == "P") & F.coalesce("has_other", F.lit(False))
    return out.withColumn("vas_fee", F.when(yields, F.lit(0)).otherwise(F.col("vas_fee")).cast(AMOUNT)).drop("has_other")


# --- product sales ------------------------------------------------------------------------

@dataclass(frozen=True)
class ProductClass:
    """Which invoice lines belong to a product class."""

    name: str
    warehouses: Sequence[str] = ()
    categories: Sequence[str] = ()
    not_categories: Sequence[str] = ()
    not_codes: Sequence[str] = ()
    also: dict[str, str] = field(default_factory=dict)
    coupons: bool = False
    subsidy: bool = False
    rebate: bool = False

    def test(self) -> Column:
        ok = ~F.col("pos_prod_cd").isin(list(self.not_codes)) if self.not_codes else F.lit(True)
        if self.warehouses or self.also:
            place = F.col("warehouse").isin(list(self.warehouses)) if self.warehouses else F.lit(False)
            for warehouse, code in self.also.items():
                place = place | ((F.col("warehouse") == warehouse) & (F.col("pos_prod_cd") == code))
            ok = ok & place
        if self.categories:
            ok = ok & F.col("item_cat").isin(list(self.categories))
        if self.not_categories:
            ok = ok & ~F.col("item_cat").isin(list(self.not_categories))
        return F.coalesce(ok, F.lit(False))


# Warehouse, item and product codes that make up each class.
_NEVER = ["CRRT", "JDC", "CRDP", "CRCP", "SIMTEENTRANSITH3", "MONTHLYPLANREBATE", "LDFD"]
CLASSES = [
    ProductClass("HANDSET", warehouses=["AH"], also={"AA": "CRPP"}, not_codes=_NEVER, coupons=True, subsidy=True, rebate=True),
    ProductClass("SIM", warehouses=["AP", "PP"], not_categories=["OTHER", "ACC", "FIXED", "PC3"], not_codes=["CRPP", *_NEVER]),
    ProductClass("ACCESSORY", warehouses=["AA"], categories=["ACC", "FIXED"], not_codes=["CRPP", *_NEVER], coupons=True),
    ProductClass("VOUCHER", categories=["PC3"], not_codes=["CRPP", "CRDP", "AALGGD330COUPON", "AASSE1100COUPON", "MONTHLYPLANREBATE", "LDFD"]),
    ProductClass("OTHER", categories=["OTHER"], not_codes=["CRPP", "CRDP", "MONTHLYPLANREBATE", "LDFD"]),
]


def coupons(t: Frames, w: Window) -> DataFrame:
    """Coupon amounts of the invoices on each receipt."""
    paid = t["pos_recpt_payment"].where(F.col("payment_cd").like("%COUP%") & within("recpt_date", w))
    sums = paid.groupBy("recpt_num").agg(F.sum("amt").alias("amt"))
    return t["pos_recpt_detail"].where(within("recpt_date", w)).join(sums, "recpt_num").select("inv_num", "recpt_num", "amt")


def product_sales(t: Frames, w: Window, classes: Sequence[ProductClass] = tuple(CLASSES)) -> DataFrame:
    """Amount, quantity and product lists per invoice and product class, without returned invoices.

    All classes come from one pass over the invoice lines. Invoices are written first and the amounts beside the lines
    come from one aggregate: a task holds the sorted rows of every join by invoice in its stage at once.
    """
    inv = t["pos_inv_header"].where(within("inv_date", w) & F.col("inv_num").startswith("I") & ~F.col("salesman_cd").startswith("CA"))
    inv = keep_in(inv, pick(t["stores"], pos_shop_cd="store_cd"), "pos_shop_cd")
    inv = not_returned(inv, t, since=w.start)
    inv = inv.join(pick(t["fes_usr_info"], "salesman_flg", salesman_cd="usr_name"), "salesman_cd", "left")
    seller = F.when(F.col("salesman_flg") == "Y", F.col("salesman_cd")).otherwise(F.col("usr_id"))
    inv = inv.select("inv_num", *LINE, "inv_date", "mkt_cd", "online_inv_flg", F.col("pos_shop_cd").alias("store_cd"), F.coalesce(seller, F.lit(NO_TEXT)).alias("salesman"),
                     (F.col("salesman_cd").startswith("FA") | F.col("usr_id").startswith("FA")).alias("fa"))
    inv = settle(inv, "product_invoices")
    cats = t["pos_prod_ref"].select("pos_prod_cd", "item_cat")
    rows = t["pos_inv_detail"].select("inv_num", "pos_prod_cd", "warehouse", "net_amt", "trade_in_amt", "qty").join(cats, "pos_prod_cd", "left")
    which = F.array_compact(F.array(*[F.when(c.test(), F.lit(c.name)) for c in classes]))
    counted = F.when((F.col("cls") == "HANDSET") & (F.col("pos_prod_cd") == "CRPP"), 0).otherwise(F.col("qty"))
    item = ["pos_prod_cd", "warehouse", "item_cat"]
    by = ["inv_num", "cls"]
    # Per invoice, class and product first; the lists then come from the same rows as the sums.
    each = keep_in(rows.withColumn("cls", F.explode(which)), inv, "inv_num").groupBy(*by, *item).agg(
        F.sum("net_amt").alias("net_amt"), F.sum("trade_in_amt").alias("trade_in_amt"), F.sum(counted).alias("qty"), F.count(F.lit(1)).alias("n")
    )
    sums = each.groupBy(*by).agg(
        F.coalesce(F.sum("net_amt"), F.lit(0)).alias("pos_amt"), F.coalesce(F.sum("trade_in_amt"), F.lit(0)).alias("trade_in_amt"), F.sum("qty").alias("qty"),
        F.array_sort(F.collect_list(F.struct(*item, "n"))).alias("items"),
    )

    def listed(c: str) -> Column:
        return F.array_join(F.flatten(F.transform("items", lambda x: F.array_repeat(x[c], x["n"].cast("int")))), ", ")

    lists = pick(sums, *by, "pos_amt", "trade_in_amt", "qty", products=listed("pos_prod_cd"), warehouses=listed("warehouse"), item_cats=listed("item_cat"))
    out = inv.join(lists, "inv_num")
    # All amounts of an invoice by one aggregate.
    rebates = t["pos_inv_detail"].where(F.col("common_desc").like("%HANDSET%REBATE%"))
    amounts = {"coupon_amt": (coupons(t, w), "amt"), "subsidy": (t["hs_subsidy"], "net_subsidy_amt"), "rebate": (rebates, "net_amt")}
    found = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [pick(df, "inv_num", **{n: c}) for n, (df, c) in amounts.items()])
    out = out.join(found.groupBy("inv_num").agg(*[F.sum(n).alias(n) for n in amounts]), "inv_num", "left")
    with_coupon = F.col("cls").isin([c.name for c in classes if c.coupons])
    with_subsidy = F.col("cls").isin([c.name for c in classes if c.subsidy])
    names = pick(staff_names(t), salesman="usr_name", staff_name="full_name")
    zero = F.lit(0).cast(AMOUNT)
    rebate = F.when(F.col("cls").isin([c.name for c in classes if c.rebate]), F.coalesce("rebate", zero)).otherwise(zero)
    coupon = F.when(with_coupon, F.coalesce("coupon_amt", zero)).otherwise(zero)
    taken = F.when(with_subsidy, F.coalesce("subsidy", zero) + coupon).otherwise(zero)
    return out.join(names, "salesman", "left").select(
        "cls", "store_cd", *LINE, "inv_num", "inv_date", "mkt_cd", "online_inv_flg", "salesman", F.coalesce("staff_name", F.lit(NO_TEXT)).alias("staff_name"),
        (F.col("pos_amt") - taken).cast(AMOUNT).alias("pos_amt"), F.col("trade_in_amt").cast(AMOUNT).alias("trade_in_amt"), coupon.cast(AMOUNT).alias("coupon_amt"),
        rebate.cast(AMOUNT).alias("rebate_amt"), "qty", "products", "warehouses", "item_cats", F.when(F.col("fa"), "Y").otherwise("N").alias("fa_inv_flg"),
    ).distinct()


# --- summary ------------------------------------------------------------------------------

ITEMS = ["super_care_plan", "other_service_plan", "non_service_plan", "handset", "accessories", "prepaid_sim", "other", "prepaid_voucher"]
_CLASS_ITEM = {"HANDSET": "handset", "SIM": "prepaid_sim", "ACCESSORY": "accessories", "VOUCHER": "prepaid_voucher", "OTHER": "other"}


def store_staff_summary(t: Frames, services: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue by day, store and staff with store and overall totals and averages."""
    zero = F.lit(0).cast(AMOUNT)

    by = ["inv_date", "store_cd", "staff_name"]

    def summed(df: DataFrame, doc: Column, values: dict[str, Column]) -> DataFrame:
        return df.groupBy(*by).agg(*[F.sum(values.get(i, zero)).cast(AMOUNT).alias(i) for i in ITEMS], F.count_distinct(doc).alias("inv_cnt"))

    amount = F.col("pos_amt") + F.when(F.col("cls") == "HANDSET", F.col("trade_in_amt")).when(F.col("cls") == "ACCESSORY", F.col("coupon_amt")).otherwise(zero)
    parts = [
        summed(services, F.col("order_num"), {"super_care_plan": F.col("super_care_plan"), "other_service_plan": F.col("other_service_plan"), "non_service_plan": F.col("vas_fee")}),
        summed(products, F.struct("cls", "inv_num"), {item: F.when(F.col("cls") == cls, amount).otherwise(zero) for cls, item in _CLASS_ITEM.items()}),
    ]
    rows = keep_in(stack(*parts), t["stores"].where("daily_sales_sms = 'Y'"), "store_cd")
    rows = rows.withColumn("total", sum((F.col(i) for i in ITEMS[1:]), F.col(ITEMS[0])).cast("decimal(24,2)"))
    return with_subtotals(rows, "store_cd", "staff_name", [*ITEMS, "total", "inv_cnt"], "All RBD", ["inv_date"])
