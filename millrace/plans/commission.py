"""Retention commission: cases, their contract and the one replaced, rebates, and contract value.

Each step is a function of frames; `run` chains them into one plan per result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import blank, composite_id, concat_text, contract_value, month_start, no_date, override
from millrace.operators import (
    drop_in, drop_like, first_events, join_asof, join_within, keep_first, keep_in, list_agg, pick_rank, ranked, snapshot, stack,
    update_from_agg, waterfall,
)
from millrace.params import NO_DATE, NO_TEXT, OPEN_DATE, CommissionWindow
from millrace.plans.base import LINE, Frames, not_returned, pick, within
from millrace.storage import settle

CUSTOM = "CSTPN"
CASE = ["case_id", *LINE, "pos_inv_num", "pos_mkt_cd", "pos_ld_cd", "pos_inv_date", "pos_inv_tag", "json_rmk"]
CONTRACT = ["ld_inv_num", "ld_cd", "ld_mkt_cd", "ld_start_date", "ld_expired_date"]


def _invoices(t: Frames, w: CommissionWindow) -> DataFrame:
    """Invoices of the window by commissioned staff, without those returned in it."""
    rows = t["pos_inv_header"].where(within("inv_date", w))
    rows = keep_in(rows, t["retent_salesman"].where(F.col("comm_mth") == F.lit(w.comm_month)), "salesman_cd")
    return not_returned(rows, t, w.start, w.end)


def cases(t: Frames, w: CommissionWindow) -> DataFrame:
    """One row per commission case, by the four ways in which an invoice becomes one."""
    rows = _invoices(t, w).where(~blank("ld_cd"))
    base = pick(
        rows, *LINE, case_id=composite_id("inv_num", "subr_num"), pos_inv_num="inv_num", pos_mkt_cd="mkt_cd",
        pos_ld_cd="ld_cd", pos_inv_date="inv_date", pos_inv_tag=F.lit(NO_TEXT), json_rmk=F.lit(NO_TEXT),
    ).select(*CASE)
    base = settle(base, "commission_invoices")
    custom = F.col("pos_mkt_cd") == CUSTOM
    mkt = pick(t["mkt_ref_vw"], "ld_revenue", pos_mkt_cd="mkt_cd")
    listed = pick(t["comm_mkt_ref"].where(F.col("comm_mth") == F.lit(w.comm_month)), pos_mkt_cd="mkt_cd")

    own = base.where(custom & ~blank("pos_ld_cd")).withColumn("pos_inv_tag", F.lit("CSTPN_LD"))
    same_day = [*LINE, "pos_inv_date"]
    mass_of = keep_in(base.where(~custom), mkt.where("ld_revenue = 'P'"), "pos_mkt_cd")
    mass = (
        pick(base.where(custom & blank("pos_ld_cd")), "case_id", *same_day, custom_inv="pos_inv_num", rmk="json_rmk")
        .join(mass_of.drop("case_id", "json_rmk"), same_day)
        .withColumn("pos_inv_tag", F.lit("CSTPN_MASS"))
        .withColumn("json_rmk", concat_text("rmk", F.lit(',"CSTPN_INV"="'), "custom_inv", F.lit('"')))
        .select(*CASE)
    )
    first = stack(own, mass)
    normal = keep_in(keep_in(base.where(~custom), mkt, "pos_mkt_cd"), listed, "pos_mkt_cd")
    normal = drop_in(normal, first, "pos_inv_num").withColumn("pos_inv_tag", F.lit("NORMAL_MASS"))
    changed = t["comm_overr_hist"].where(F.col("comm_mth") == F.lit(w.comm_month))
    overridden = base.join(pick(changed, "overr_mkt_cd", "overr_ld_cd", pos_inv_num="inv_num"), "pos_inv_num").withColumns(
        {
            "pos_mkt_cd": override("overr_mkt_cd", "pos_mkt_cd"),
            "pos_ld_cd": override("overr_ld_cd", "pos_ld_cd"),
            "pos_inv_tag": F.lit("NORMAL_MASS"),
        }
    )
    return stack(first.select(*CASE), normal.select(*CASE), overridden.select(*CASE))


def matched(t: Frames, w: CommissionWindow, rows: DataFrame) -> DataFrame:
    """Contract of each case: of the same invoice, else the earliest of the same code, else assumed."""
    valid = snapshot(t["subr_ld_hist"], F.lit(w.eve))
    by_inv = pick(
        valid, "ld_cd", "ld_start_date", "ld_expired_date", pos_inv_num="inv_num", ld_inv_num="inv_num", ld_mkt_cd="mkt_cd"
    )
    own = settle(rows.join(by_inv, "pos_inv_num", "left").select(*CASE, *CONTRACT), "commission_own")
    exact = own.where("ld_inv_num is not null")
    # Only cases that no invoice has taken look for another contract.
    taken = exact.select(F.col("case_id").alias("taken"))
    left = own.where("ld_inv_num is null").select(*CASE)
    left = settle(left.join(taken, F.col("case_id").eqNullSafe(F.col("taken")), "left_anti"), "commission_left")
    by_code = pick(
        valid, *LINE, "ld_cd", "ld_start_date", "ld_expired_date", pos_ld_cd="ld_cd", ld_inv_num="inv_num", ld_mkt_cd="mkt_cd"
    )
    later = first_events(left, by_code, [*LINE, "pos_ld_cd"], "pos_inv_date", "ld_start_date", 1).where(F.col("ld_start_date") <= F.lit(w.eve))
    early = keep_first(later.withColumn("_at", F.col("ld_start_date")), CASE, "_at", CONTRACT)
    early = early.withColumn("json_rmk", concat_text("json_rmk", F.lit(',"TAG1A04"="MAP_LATEST_LD"')))
    assumed = left.withColumns(
        {
            "ld_inv_num": F.lit(NO_TEXT), "ld_cd": F.col("pos_ld_cd"), "ld_mkt_cd": F.col("pos_mkt_cd"),
            "ld_start_date": F.col("pos_inv_date"), "ld_expired_date": F.lit(OPEN_DATE),
            "json_rmk": concat_text("json_rmk", F.lit(',"TAG1A04"="UNMAP_LD"')),
        }
    )
    rest = waterfall([("EARLIEST", early), ("NONE", assumed)], ["case_id"], "ld_match", stage=lambda df: settle(df, "commission_matches"))
    return stack(exact.withColumn("ld_match", F.lit("INVOICE")), rest)


def profiled(t: Frames, w: CommissionWindow, rows: DataFrame) -> DataFrame:
    """Contract end as first agreed, and the line's profile when the contract began."""
    first = pick(
        t["subr_ld_hist"], "start_date", "end_date", ld_inv_num="inv_num", sl_cust="cust_num", sl_subr="subr_num",
        sl_start="ld_start_date", sl_end="ld_expired_date",
    )
    info = pick(
        t["subr_info_hist"], "bill_cycle", "subr_sw_on_date", "subr_stat_cd", "rate_plan_cd", "start_date", "end_date",
        sl_cust="cust_num", sl_subr="subr_num",
    )
    out = join_asof(rows, first, "ld_inv_num", "ld_start_date", unit=None).drop("start_date", "end_date")
    out = join_asof(out, info, ["sl_cust", "sl_subr"], "sl_start", years=w.years).drop("start_date", "end_date")
    out = out.withColumns(
        {
            "ld_expired_date": F.coalesce("sl_end", "ld_expired_date"),
            "bill_cycle": F.coalesce("bill_cycle", F.lit(0)),
            "subr_sw_on_date": F.coalesce("subr_sw_on_date", F.lit(OPEN_DATE)),
            "subr_stat_cd": F.coalesce("subr_stat_cd", F.lit(NO_TEXT)),
            "rate_plan_cd": F.coalesce("rate_plan_cd", F.lit(NO_TEXT)),
        }
    ).drop("sl_cust", "sl_subr", "sl_start", "sl_end")
    moved_from = pick(
        t["subr_info_hist"].where("subr_stat_cd = 'TX'"), "subr_num", sw_on="subr_sw_on_date", other_cust="cust_num",
        subr_sw_on_date="subr_sw_off_date",
    )
    moved = (
        out.where(within("subr_sw_on_date", w)).select("case_id", *LINE, "subr_sw_on_date")
        .join(moved_from, ["subr_num", "subr_sw_on_date"])
        .where("other_cust <> cust_num")
    )
    return update_from_agg(out, moved, ["case_id"], {"subr_sw_on_date": F.min("sw_on")})


def old_contracts(t: Frames, w: CommissionWindow, rows: DataFrame) -> DataFrame:
    """The plan contract that ran on the eve of the window and ends last, per case."""
    eve = F.date_sub(F.lit(w.start), 1)
    hist = keep_in(t["subr_ld_hist"], t["mkt_ref_vw"].where("ld_revenue = 'P'"), "mkt_cd")
    ran = hist.where(eve.between(F.col("ld_start_date"), F.col("ld_expired_date")))
    old = pick(
        ran, *LINE, "ld_expired_date", old_ld_inv_num="inv_num", old_ld_cd="ld_cd", old_ld_mkt_cd="mkt_cd",
        old_ld_start_date="ld_start_date", old_end="end_date", old_cust="cust_num", old_subr="subr_num",
    )
    others = t["comm_mkt_ref"].where((F.col("comm_mth") == F.lit(w.comm_month)) & (F.upper("bm_cat") == "OTHERS"))
    asked = drop_in(rows.select("case_id", *LINE, "ld_mkt_cd"), pick(others, ld_mkt_cd="mkt_cd"), "ld_mkt_cd")
    held = ["old_ld_inv_num", "old_ld_cd", "old_ld_mkt_cd", "old_ld_start_date", "old_end", "old_cust", "old_subr"]
    # All cases of a line see the same contracts, so the one is chosen per line.
    best = keep_first(old, LINE, "ld_expired_date", held, desc=True)
    last = asked.select("case_id", *LINE).distinct().join(best, LINE).drop(*LINE)
    info = pick(t["subr_info_hist"], "start_date", "end_date", old_cust="cust_num", old_subr="subr_num", old_rate_plan_cd="rate_plan_cd")
    out = join_asof(last, info, ["old_cust", "old_subr"], "old_end", years=w.years).drop("start_date", "end_date")
    first = pick(t["subr_ld_hist"], "start_date", "end_date", old_ld_inv_num="inv_num", old_ld_expired_date="ld_expired_date")
    out = join_asof(out, first, "old_ld_inv_num", "old_ld_start_date", unit=None)
    return out.select(
        "case_id", *held[:4], F.coalesce("old_ld_expired_date", F.lit(NO_DATE)).alias("old_ld_expired_date"),
        F.coalesce("old_rate_plan_cd", F.lit(NO_TEXT)).alias("old_rate_plan_cd"),
    )


def base(t: Frames, w: CommissionWindow, rows: DataFrame) -> DataFrame:
    """Cases with both contracts and their tariffs; lines switched on in the window drop out."""
    tariffs = snapshot(t["bill_serv_ref"], F.lit(w.end), "eff_start_date", "eff_end_date")
    out = rows.join(old_contracts(t, w, rows), "case_id", "left")
    out = out.join(pick(tariffs, rate_plan_cd="bill_serv_cd", bill_rate="bill_rate"), "rate_plan_cd", "left")
    out = out.join(pick(tariffs, old_rate_plan_cd="bill_serv_cd", old_bill_rate="bill_rate"), "old_rate_plan_cd", "left")
    out = out.join(pick(t["mkt_ref_vw"], "ld_revenue", pos_mkt_cd="mkt_cd"), "pos_mkt_cd", "left")
    other_kind = (~F.col("ld_revenue").isin("V", "O")) & (F.col("pos_mkt_cd") != CUSTOM)
    out = out.withColumns(
        {
            "pos_mkt_type": F.when(other_kind, "NON_PLAN_MKT").otherwise("PLAN_MKT"),
            "bill_rate": F.coalesce("bill_rate", F.lit(0).cast("decimal(12,2)")),
            "old_bill_rate": F.coalesce("old_bill_rate", F.lit(0).cast("decimal(12,2)")),
            **{c: F.coalesce(c, F.lit(NO_TEXT)) for c in ("old_ld_inv_num", "old_ld_cd", "old_ld_mkt_cd", "old_rate_plan_cd")},
            **{c: F.coalesce(c, F.lit(NO_DATE)) for c in ("old_ld_start_date", "old_ld_expired_date")},
        }
    ).drop("ld_revenue")
    new_line = (month_start("subr_sw_on_date") == month_start("ld_start_date")) | within("subr_sw_on_date", w)
    return out.where(~new_line)


def first_bills(t: Frames, w: CommissionWindow, asked: DataFrame) -> DataFrame:
    """The first four bills under the contract of each (label, case_id, term_inv), with their rank, written as a stage."""
    terms = pick(
        t["subr_ld_hist"].where(F.col("start_date") <= F.lit(w.comm_month)), "start_date", "end_date",
        term_inv="inv_num", b_subr="subr_num", b_cust="cust_num", term_start="ld_start_date", term_end="ld_expired_date",
    )
    last = F.date_sub(F.add_months(F.lit(w.comm_month), 1), 1)
    bills = pick(t["inv_header"].where(F.col("inv_date") <= last), b_subr="subr_num", b_cust="cust_num", bill_inv="inv_num", bill_date="inv_date")
    spans = asked.join(terms, "term_inv").where("start_date is not null and end_date is not null and term_start is not null and term_end is not null")
    spans = spans.withColumns({"since": F.greatest("start_date", "term_start"), "until": F.least("end_date", "term_end")})
    spans = settle(spans.select("label", "case_id", "b_subr", "b_cust", "since", "until"), "commission_terms")
    billed = first_events(spans, bills, ["b_subr", "b_cust"], "since", "bill_date", 4, "until")
    return settle(ranked(billed.drop("rnk", "since", "until"), ["label", "case_id"], ["bill_date"], 4), "commission_bills")


def bill_rebates(
    t: Frames, w: CommissionWindow, rows: DataFrame, inv: str, label: str, ranks: list[int], windowed: bool, first: DataFrame | None = None
) -> DataFrame:
    """Rebates in the ledger for the month of the fourth bill under a contract. `first` may hold the `first_bills` of several labels."""
    if first is None:
        first = first_bills(t, w, pick(rows, "case_id", label=F.lit(label), term_inv=inv))
    first = first.where(F.col("label") == label).drop("label")
    at = pick_rank(first, "case_id", "rnk", ranks, ["bill_inv", "bill_date", "b_subr", "b_cust"])
    shown = F.concat(F.lit("["), "bill_inv", F.lit("]-"), F.date_format("bill_date", "yyyyMMdd"))
    lists = list_agg(first.withColumn("bill", shown), "case_id", "bill", ["rnk", "bill_inv"], ";", name="bill_inv_list", repeats=False)

    past = pick(t["sal_led_history"], b_subr="subr_num", b_cust="cust_num", mth="trx_hist_month", kind="transaction_type", amt="transaction_amount", day="trx_hist_month")
    now = pick(t["sal_led"], b_subr="subr_num", b_cust="cust_num", mth=month_start("trx_date"), kind="sal_trx_type_cd", amt="sal_led_amt", day="trx_date")
    ledger = stack(past, now).where(F.col("kind").like("PAY%"))
    if windowed:
        ledger = ledger.where(F.col("day").between(F.lit(w.start), F.add_months(F.lit(w.start), 5)))
    patterns = pick(t["non_rev_type_ref"].where("trx_category = 'PAY'"), pattern="trx_type_cd")
    ledger = drop_like(ledger, "kind", patterns)
    paid = at.where("bill_date is not null").withColumn("mth", month_start("bill_date")).join(ledger, ["b_subr", "b_cust", "mth"])
    part = F.concat(F.substring_index("kind", "-", 1), F.lit("="), F.col("amt").cast("string"))
    text = list_agg(paid.withColumn("part", part), "case_id", "part", ["kind", "amt"], ";", name="parts")
    sums = paid.groupBy("case_id").agg(F.sum("amt").alias("inv_cb_amt")).join(text, "case_id")
    note = concat_text(F.lit(f',"{label}":"'), "parts", F.lit('"'))
    out = at.join(lists, "case_id").join(sums, "case_id", "left")
    return out.select("case_id", "bill_inv_list", "inv_cb_amt", F.when(F.col("parts").isNotNull(), note).alias("inv_note"))


def market_rebates(t: Frames, w: CommissionWindow, rows: DataFrame, inv: str, mkt: str, day: str, label: str) -> DataFrame:
    """Credits that come with a market code: those posted within a day of the invoice, and bonuses."""
    asked = pick(rows, "case_id", *LINE, inv_num=inv, mkt_cd=mkt, inv_day=day)
    offers = pick(snapshot(t["srvcb"], F.lit(w.end)), "mkt_cd", "credit_back_amt", credit_cd="credit_back_cd")
    posted = pick(keep_in(t["pos_crbk_detail"], offers, "credit_cd"), *LINE, "credit_cd", crbk_date="crbk_date", crbk_inv="inv_num")
    hit = join_within(
        asked.join(offers, "mkt_cd"), posted, [*LINE, "credit_cd"], "inv_day", "crbk_date", 1,
        {"hits": ("count", "crbk_date")}, residual=("inv_num", "crbk_inv"),
    )
    credit = hit.groupBy("case_id", "credit_cd").agg(F.max("credit_back_amt").alias("amt"))
    bonus_ref = pick(snapshot(t["fes_hs_bonus_hist"], F.lit(w.end)), "mkt_cd", "credit_back_amt", pos_prod_cd="prod_cd", credit_cd="credit_back_cd")
    # Only lines of products with a bonus, and cases of codes with one, need to meet; their quantities are summed at the end.
    sold = keep_in(t["pos_inv_detail"], bonus_ref, "pos_prod_cd").select("inv_num", "pos_prod_cd", "qty")
    bonus = asked.select("case_id", "inv_num", "mkt_cd").join(bonus_ref, "mkt_cd").join(sold, ["inv_num", "pos_prod_cd"])
    bonus = bonus.groupBy("case_id", "credit_cd").agg(F.sum(F.col("credit_back_amt") * F.col("qty")).alias("amt"))
    both = stack(credit.withColumn("amt", F.col("amt").cast("decimal(18,2)")), bonus.withColumn("amt", F.col("amt").cast("decimal(18,2)")))
    part = F.concat("credit_cd", F.lit("="), F.col("amt").cast("string"))
    text = list_agg(both.withColumn("part", part), "case_id", "part", ["credit_cd", "amt"], ";", name="parts")
    sums = both.groupBy("case_id").agg((-F.sum("amt")).alias("mkt_cb_amt")).join(text, "case_id")
    return sums.select("case_id", "mkt_cb_amt", concat_text(F.lit(f',"{label}":"'), "parts", F.lit('"')).alias("mkt_note"))


def _rebate(rows: DataFrame, bills: DataFrame, market: DataFrame, prefix: str) -> DataFrame:
    """A market rebate takes the place of a bill rebate; other kinds of offer take market rebates only."""
    zero = F.lit(0).cast("decimal(18,2)")
    both = rows.select("case_id", "pos_mkt_type").join(bills, "case_id", "left").join(market, "case_id", "left")
    by_market = (F.col("pos_mkt_type") == "NON_PLAN_MKT") | F.col("mkt_cb_amt").isNotNull()
    found = F.col("mkt_cb_amt").isNotNull()
    return both.select(
        "case_id",
        F.when(found, F.lit(NO_TEXT)).otherwise(F.coalesce("bill_inv_list", F.lit(NO_TEXT))).alias(prefix + "bill_inv_list"),
        F.when(by_market, F.coalesce("mkt_cb_amt", zero)).otherwise(F.coalesce("inv_cb_amt", zero)).alias(prefix + "rebate_amt"),
        F.when(by_market, "MKT_REBATE").otherwise("INV_REBATE").alias(prefix + "rebate_flg"),
        F.coalesce(F.when(by_market, F.col("mkt_note")).otherwise(F.col("inv_note")), F.lit("")).alias(prefix + "note"),
    )


def result(t: Frames, w: CommissionWindow, rows: DataFrame) -> DataFrame:
    """All figures per case and the contract value."""
    zero = F.lit(0).cast("decimal(18,2)")
    comm = F.lit(w.comm_month)
    replaced = rows.where(~blank("old_ld_inv_num"))
    first = first_bills(
        t, w, stack(
            pick(rows, "case_id", label=F.lit("INV_REBTE"), term_inv="ld_inv_num"),
            pick(replaced, "case_id", label=F.lit("OLD_INV_REBTE"), term_inv="old_ld_inv_num"),
        ),
    )
    new = _rebate(
        rows, bill_rebates(t, w, rows, "ld_inv_num", "INV_REBTE", [4, 3], True, first),
        market_rebates(t, w, rows, "pos_inv_num", "pos_mkt_cd", "pos_inv_date", "MKT_REBTE"), "",
    )
    with_old = replaced.join(pick(t["pos_inv_header"], old_ld_inv_num="inv_num", old_inv_date="inv_date"), "old_ld_inv_num")
    old = _rebate(
        rows, bill_rebates(t, w, replaced, "old_ld_inv_num", "OLD_INV_REBTE", [4], False, first),
        market_rebates(t, w, with_old, "old_ld_inv_num", "old_ld_mkt_cd", "old_inv_date", "OLD_MKT_REBTE"), "old_",
    )
    subsidy = t["hs_subsidy"].groupBy("inv_num").agg(F.sum("net_subsidy_amt").alias("amt"))
    staff = pick(t["pos_inv_header"], ld_inv_num="inv_num", own_salesman="salesman_cd")
    moved = pick(t["comm_overr_hist"].where(F.col("comm_mth") == comm), ld_inv_num="inv_num", new_salesman="salesman_cd")
    team = pick(t["retent_salesman"].where(F.col("comm_mth") == comm), "salesman_cd", sales_team="sale_team")
    ref = t["comm_mkt_ref"].where(F.col("comm_mth") == comm)
    dated = pick(ref, ld_mkt_cd="mkt_cd", cat_by_date="bm_cat", cat_from="eff_s_date", cat_to="eff_e_date")
    of_inv = rows.select("case_id", "ld_inv_num", "ld_mkt_cd").join(pick(t["pos_inv_header"], ld_inv_num="inv_num", at="inv_date"), "ld_inv_num")
    cat = of_inv.join(dated, "ld_mkt_cd").where("at between cat_from and cat_to").groupBy("case_id").agg(F.max("cat_by_date").alias("cat_by_date"))
    by_code = pick(ref, pos_mkt_cd="mkt_cd", cat_by_code="bm_cat").groupBy("pos_mkt_cd").agg(F.max("cat_by_code").alias("cat_by_code"))

    # Joins of one key follow each other, so that the rows move once for each key.
    out = rows.join(new, "case_id", "left").join(old, "case_id", "left")
    out = out.join(pick(subsidy, old_ld_inv_num="inv_num", old_hs_subsidy_amt="amt"), "old_ld_inv_num", "left")
    out = out.join(pick(subsidy, ld_inv_num="inv_num", hs_subsidy_amt="amt"), "ld_inv_num", "left")
    out = out.join(staff, "ld_inv_num", "left").join(moved, "ld_inv_num", "left")
    out = out.withColumn("salesman_cd", F.coalesce("new_salesman", "own_salesman")).drop("new_salesman", "own_salesman")
    out = out.join(team, "salesman_cd", "left").join(cat, "case_id", "left").join(by_code, "pos_mkt_cd", "left")
    out = out.where(~blank("salesman_cd")).withColumns(
        {
            "hs_subsidy_amt": F.coalesce("hs_subsidy_amt", zero),
            "old_hs_subsidy_amt": F.coalesce("old_hs_subsidy_amt", zero),
            "sales_team": F.coalesce("sales_team", F.lit(NO_TEXT)),
            "bm_cat": F.coalesce("cat_by_date", "cat_by_code", F.lit(NO_TEXT)),
            "json_rmk": concat_text("json_rmk", F.lit(',"POS_MKT_TYPE"="'), "pos_mkt_type", F.lit('"'), "note", "old_note"),
        }
    ).drop("cat_by_date", "cat_by_code", "note", "old_note")
    forced = pick(ref.where("override_flg = 'Y'"), "overr_rebate_amt", "overr_bill_rate", ld_mkt_cd="mkt_cd")
    out = out.join(forced, "ld_mkt_cd", "left")
    hit = F.col("overr_rebate_amt").isNotNull()
    out = out.withColumns(
        {
            **{c: F.when(hit, F.col("overr_rebate_amt")).otherwise(F.col(c)) for c in ("rebate_amt", "old_rebate_amt")},
            **{c: F.when(hit, F.col("overr_bill_rate")).otherwise(F.col(c)) for c in ("bill_rate", "old_bill_rate")},
            **{c: F.when(hit, F.lit("INV_REBATE")).otherwise(F.col(c)) for c in ("rebate_flg", "old_rebate_flg")},
            "old_ld_inv_num": F.when(hit, F.lit("OVERRIDE_OLD")).otherwise(F.col("old_ld_inv_num")),
        }
    ).drop("overr_rebate_amt", "overr_bill_rate")
    value = contract_value(
        start="ld_start_date", end="ld_expired_date", old_start="old_ld_start_date", old_end="old_ld_expired_date",
        old_invoice="old_ld_inv_num", bill_rate="bill_rate", rebate="rebate_amt", rebate_flag="rebate_flg",
        subsidy="hs_subsidy_amt", old_bill_rate="old_bill_rate", old_rebate="old_rebate_amt",
        old_rebate_flag="old_rebate_flg", old_subsidy="old_hs_subsidy_amt",
    )
    return out.withColumns({**value, "rpt_mth": F.lit(w.start), "comm_mth": comm})


def exceptions(t: Frames, w: CommissionWindow, done: DataFrame) -> DataFrame:
    """Invoices of commissioned staff that led to no case, for a person to look at."""
    rows = drop_in(_invoices(t, w), pick(done, inv_num="pos_inv_num"), "inv_num")
    return pick(rows, "inv_num", "inv_date", *LINE, "mkt_cd", "ld_cd", "salesman_cd", has_contract=~blank("ld_cd") & ~no_date("ld_expiry_date"))


def prepared(t: Frames, w: CommissionWindow) -> DataFrame:
    """The base rows, each step written as a stage because the next ones read it several times."""
    found = settle(cases(t, w), "commission_cases")
    held = settle(matched(t, w, found), "commission_matched")
    return settle(base(t, w, settle(profiled(t, w, held), "commission_profile")), "commission_base")


def run(t: Frames, w: CommissionWindow) -> dict[str, DataFrame]:
    rows = prepared(t, w)
    done = settle(result(t, w, rows), "commission_result")
    return {"base": rows, "result": done, "exceptions": exceptions(t, w, done)}
