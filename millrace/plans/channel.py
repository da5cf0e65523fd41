"""Channel transactions: which invoice or order a line's change came from, what it replaced, who earned it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions import (
    blank, first_match, month_start, no_code, no_date, nvl_blank, override, pick_latest, plan_group,
    repair_end, repair_start,
)
from millrace.operators import (
    apply_match, apply_rules, best_open, drop_in, drop_where, join_asof, keep_in, nth_row, ranked, snapshot, split_rows, stack, waterfall,
)
from millrace.operators.joins import CALENDAR
from millrace.params import NO_DATE, NO_TEXT, OPEN_DATE, Window
from millrace.plans.base import LINE, Frames, not_returned, pick, within
from millrace.storage import settle

LIVE = ["OK", "PE"]
ORDER = [*LINE, "store_cd", "rate_plan_cd", "order_num", "inv_date", "mkt_cd", "ref", "online_inv", "ld_revenue", "subr_stat_cd", "ld_cd", "add_vas", "eff_date"]
PLAN_CHANGE = "Chg plan only"


def _latest(c: str) -> Column:
    return F.col(c).desc_nulls_last()


def _all_known(key: Sequence[str]) -> Column:
    """Whether a row can be matched by `key`: a null in it equals no other."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])


def new_lines(t: Frames, w: Window) -> DataFrame:
    """Lines whose very first history row begins in the window and which are still live after it."""
    first = nth_row(t["subr_info_hist"], LINE, ["start_date", "subr_sw_on_date", "subr_sw_off_date"])
    plan = F.col("rate_plan_cd")
    fresh = first.where(
        F.col("subr_stat_cd").isin(LIVE) & ~plan.startswith("ADON") & ~plan.startswith("AON") & within("start_date", w)
        & (within("subr_sw_on_date", w) | (F.col("subr_sw_on_date") == F.lit(OPEN_DATE)))
    )
    now = snapshot(t["subr_info_hist"], F.lit(w.txdate)).where(F.col("subr_stat_cd").isin(LIVE))
    return keep_in(fresh, now, LINE).select(*LINE, "start_date")


def _invoiced(t: Frames, w: Window) -> DataFrame:
    """Invoices of the window in reporting stores, with the line's profile on the day."""
    inv = keep_in(t["pos_inv_header"].where(within("inv_date", w)), pick(t["stores"], pos_shop_cd="store_cd"), "pos_shop_cd")
    inv = not_returned(inv, t, since=w.start).select(
        *LINE, "inv_num", "inv_date", "mkt_cd", "ld_cd", "online_inv_flg", "pos_shop_cd"
    )
    info = t["subr_info_hist"].where(F.col("subr_stat_cd").isin(LIVE)).select(*LINE, "rate_plan_cd", "subr_stat_cd", "start_date", "end_date")
    both = join_asof(inv, info, LINE, "inv_date", how="inner", years=w.years).join(t["mkt_ref_vw"].select("mkt_cd", "ld_revenue"), "mkt_cd")
    return pick(
        both, *LINE, "rate_plan_cd", "inv_date", "mkt_cd", "ld_revenue", "subr_stat_cd", "ld_cd", store_cd="pos_shop_cd", order_num="inv_num",
        online_inv="online_inv_flg", ref=F.lit("Invoice"), add_vas=F.lit(NO_TEXT), eff_date="inv_date",
    ).select(*ORDER)


CHANGE = [*LINE, "case_id", "create_date", "create_time", "create_by", "mkt_cd", "ld_cd", "new_plan_cd", "add_vas", "eff_date"]


def _changes(t: Frames, kind: str, w: Window, taken: DataFrame) -> DataFrame:
    """Orders of the window, pending and completed alike, of lines that are not taken; equal rows count once."""
    parts = [t[f"{kind}_{state}"].select(*CHANGE) for state in ("pending", "complete")]
    return stack(drop_in(stack(*parts).where(within("create_date", w)), taken, LINE), distinct=True)


def settled_orders(rows: DataFrame) -> DataFrame:
    """Orders whose plan and add-ons come from the newest order of the same line and day.

    The newest order is found by an aggregate per line and day; orders are not paired.
    """
    day = [*LINE, "create_date"]
    newest = F.max_by(F.struct("new_plan_cd", "add_vas", "create_time"), F.struct("create_time", "case_id")).alias("n")
    per_day = rows.groupBy(*day).agg(newest, F.max("eff_date").alias("last_eff"))
    both = rows.join(per_day, day)
    values = {
        c: pick_latest(F.col(c), F.col("n")[c], ["create_time"], [F.col("n")["create_time"]]) for c in ("new_plan_cd", "add_vas")
    }
    return both.withColumns({**values, "eff_date": F.greatest("eff_date", "last_eff")}).drop("n", "last_eff")


def _ordered(t: Frames, rows: DataFrame, w: Window) -> DataFrame:
    """Orders with store by creator and the line's profile on their `day`; one look-up serves all kinds of orders."""
    users = keep_in(t["fes_usr_info"], pick(t["stores"], pos_shop_cd="store_cd"), "pos_shop_cd")
    made = rows.join(pick(users, create_by="usr_name", store_cd="pos_shop_cd"), "create_by")
    info = pick(t["subr_info_hist"].where(F.col("subr_stat_cd").isin(LIVE)), *LINE, "subr_stat_cd", "start_date", "end_date", own_plan="rate_plan_cd")
    return join_asof(made, info, LINE, "day", how="inner", years=w.years)


def _as_order(df: DataFrame, plan: Column, revenue: Column) -> DataFrame:
    return pick(
        df, *LINE, "store_cd", "mkt_cd", "ref", "subr_stat_cd", "ld_cd", "add_vas", "eff_date", rate_plan_cd=plan, order_num="case_id",
        inv_date="create_date", online_inv=F.lit("N"), ld_revenue=revenue,
    ).select(*ORDER)


def transactions(t: Frames, w: Window) -> DataFrame:
    """Each line's transactions from the first source that knows the line."""
    inv = settle(_invoiced(t, w), "channel_invoices")
    fresh = settle(new_lines(t, w), "channel_new_lines")
    planned = F.col("ld_revenue").isin("P", "V")
    main = inv.where(planned & F.col("order_num").startswith("I"))
    first = keep_in(inv.where(planned & F.col("order_num").startswith("F")), fresh, LINE)
    prepaid = keep_in(inv.where(~planned), t["prepd_postpaid_subr"].where("line_cat = 'L'"), LINE)

    stopped = snapshot(t["subr_info_hist"], F.lit(w.txdate)).where(F.col("subr_stat_cd").isin("SU", "TX"))
    mkt = t["mkt_ref_vw"].where(planned).select("mkt_cd", "ld_revenue")
    # The waterfall gives nothing after the invoices to the lines that have some, so their orders need no look-up.
    taken = main.select(*LINE).distinct()
    om = settle(settled_orders(_changes(t, "om", w, taken)), "channel_orders")
    kinds = {
        "Add ld - OM Order": (nth_row(om.where(~blank("ld_cd")), [*LINE, "case_id"], [_latest("ld_cd"), _latest("create_time")]), F.col("create_date")),
        "Add ld - FL Order": (_changes(t, "fl_om", w, taken), F.col("create_date")),
        PLAN_CHANGE: (nth_row(om.where(~blank("new_plan_cd")), [*LINE, "case_id"], [_latest("create_time"), "new_plan_cd"]), F.date_sub("create_date", 1)),
    }
    asked = stack(*[pick(rows, *CHANGE, ref=F.lit(ref), day=day) for ref, (rows, day) in kinds.items()])
    made = settle(_ordered(t, asked, w), "channel_ordered")
    om_ld, fl, plan_only = [made.where(F.col("ref") == ref) for ref in kinds]
    om_ld, fl = om_ld.join(mkt, "mkt_cd"), fl.join(mkt, "mkt_cd")
    plan_only = drop_in(plan_only.where("new_plan_cd <> own_plan and subr_stat_cd = 'OK'"), fresh, LINE)
    found = waterfall(
        [
            ("INVOICE", main),
            ("NEW_LINE", first),
            ("PREPAID", prepaid),
            ("OM_ORDER", drop_in(_as_order(om_ld, override("new_plan_cd", "own_plan"), F.col("ld_revenue")), stopped, LINE)),
            ("FL_ORDER", drop_in(_as_order(fl, F.col("own_plan"), F.col("ld_revenue")), stopped, LINE)),
            ("PLAN_CHANGE", drop_in(_as_order(plan_only, F.col("new_plan_cd"), F.lit(NO_TEXT)), stopped, LINE)),
        ],
        LINE,
        stage=lambda df: settle(df, "channel_sources"),
    )
    return found.distinct()


def detail(t: Frames, rows: DataFrame, w: Window) -> DataFrame:
    """Plan and contract of the day before each transaction, and the new contract of invoices."""
    info = pick(t["subr_info_hist"].where(F.col("subr_stat_cd").isin(LIVE)), *LINE, "start_date", "end_date", orig_rate_plan_cd="rate_plan_cd")
    out = join_asof(rows, info, LINE, "inv_date", offset_days=-1, years=w.years).drop("start_date", "end_date")
    valid = not_returned(t["subr_ld_hist"].where("void_flg <> 'Y' and waived_flg <> 'Y'"), t)
    terms = valid.join(t["mkt_ref_vw"].where("ld_revenue in ('P', 'V')").select("mkt_cd", "ld_revenue"), "mkt_cd")
    terms = pick(terms, *LINE, "start_date", "end_date", orig_ld_cd="ld_cd", orig_ld_exp_date="ld_expired_date", orig_ld_revenue="ld_revenue")
    asked = rows.select(*LINE, "order_num", "inv_date")
    held = best_open(asked, terms, LINE, F.date_sub("inv_date", 1), "start_date", "end_date", ["orig_ld_exp_date", "orig_ld_cd"], ["orig_ld_exp_date", "orig_ld_cd", "orig_ld_revenue"])
    last = nth_row(held.where("orig_ld_revenue is not null"), [*LINE, "order_num"], [_latest("orig_ld_exp_date"), _latest("orig_ld_cd")])
    last = last.select(*LINE, "order_num", "orig_ld_cd", "orig_ld_exp_date", F.col("orig_ld_revenue").alias("held_revenue"))
    # There is one of these a transaction, so it counts or not by its revenue after a join that others by transaction share.
    out = out.join(last, [*LINE, "order_num"], "left").withColumn("had", F.col("held_revenue") == F.col("ld_revenue"))
    own = pick(t["pos_inv_header"], *LINE, order_num="inv_num", new_exp="ld_expiry_date", inv_ld_cd="ld_cd", inv_plan="rate_plan_cd", usr_id="usr_id", salesman_cd="salesman_cd")
    out = out.join(own, [*LINE, "order_num"], "left")
    return out.withColumns(
        {
            "orig_ld_cd": F.coalesce(F.when(F.col("had"), F.col("orig_ld_cd")), F.lit("NA")),
            "new_ld_cd": F.when(~blank("ld_cd"), F.col("ld_cd")).otherwise(F.coalesce("inv_ld_cd", F.lit("NA"))),
            "orig_ld_exp_date": F.coalesce(F.when(F.col("had"), F.col("orig_ld_exp_date")), F.lit(OPEN_DATE)),
            "new_ld_exp_date": F.coalesce("new_exp", F.lit(NO_DATE)),
            "orig_rate_plan_cd": F.coalesce("orig_rate_plan_cd", F.lit("NA")),
            "new_rate_plan_cd": override("inv_plan", "rate_plan_cd"),
            "orig_ld_revenue": F.when(F.col("had"), F.col("ld_revenue")).otherwise(F.lit(NO_TEXT)),
            "new_ld_revenue": nvl_blank("ld_revenue"),
        }
    ).drop("had", "held_revenue", "new_exp", "inv_ld_cd", "inv_plan", "ld_revenue")


def addon_lists(t: Frames, rows: DataFrame, w: Window) -> DataFrame:
    """Add-ons ordered and ended with a transaction and those active, as lists, and the add-on flag.

    The transactions pass by the orders of their day and the services of their line and take their items along; they lie by
    line and order number in the end.
    """
    key, kinds = [*LINE, "store_cd", "order_num"], ("add", "end", "act")
    known = pick(t["entitle_ref"], item="bill_serv_cd").distinct()
    orders = stack(*[t[f"om_{s}"].select(*LINE, F.col("create_date").alias("inv_date"), "add_vas", "end_vas") for s in ("pending", "complete")])
    # Both lists of an order are rows, and the orders of a line and day are one set, before they meet transactions.
    texts = F.explode(F.array(*[F.struct(F.lit(n).alias("kind"), F.col(f"{n}_vas").alias("list")) for n in ("add", "end")]))
    texts = orders.where(within("inv_date", w)).select(*LINE, "inv_date", texts.alias("text")).select(*LINE, "inv_date", "text.*")
    items = keep_in(split_rows(texts, "list").where("item is not null"), known, "item")
    daily = items.groupBy(*LINE, "inv_date").agg(F.collect_set(F.struct("kind", "item")).alias("ordered"))
    live = stack(*[t[n].select(*LINE, "bill_end_date", F.col("bill_serv_cd").alias("item")) for n in ("bill_servs", "bill_servs_pend")])
    live = keep_in(live, known, "item").groupBy(*LINE, "item").agg(F.max("bill_end_date").alias("bill_end_date"))
    live = live.groupBy(*LINE).agg(F.collect_list(F.struct("item", "bill_end_date")).alias("live"))
    asked = rows.select(*key, "inv_date", "rate_plan_cd").join(daily, [*LINE, "inv_date"], "left").join(live, LINE, "left")
    active = F.transform(F.filter("live", lambda x: F.col("inv_date") < x["bill_end_date"]), lambda x: F.struct(F.lit("act").alias("kind"), x["item"].alias("item")))
    none = F.array().cast("array<struct<kind:string,item:string>>")
    found = F.when(_all_known(key), F.concat(F.coalesce("ordered", none), F.coalesce(active, none)))
    asked = asked.select(*key, F.struct("inv_date", "rate_plan_cd").alias("row"), found.alias("found"))
    # Sets drop the repeats, so the three lists and the rows they are for take one shuffle, by transaction.
    spread = asked.repartition(*LINE, "order_num").select(*key, "row", F.explode_outer("found").alias("_i"))
    sets = {n: F.collect_set(F.when(F.col("_i.kind") == n, F.col("_i.item"))) for n in kinds}
    out = spread.groupBy(*key).agg(F.collect_set("row").alias("rows"), *[c.alias(n) for n, c in sets.items()])
    lists = {n: F.when(F.size(n) > 0, F.array_join(F.array_sort(n), ",")) for n in kinds}
    out = out.withColumns({**lists, "row": F.explode("rows")}).select(*key, *kinds, "row.*")
    count = {n: F.when(F.col(n).isNull(), 0).otherwise(F.size(F.split(F.col(n), ","))) for n in kinds}
    high = pick(t["rate_plan_ref"].where("high_tier = 'Y'"), "rate_plan_cd", is_high=F.lit(True))
    out = out.join(high.distinct(), "rate_plan_cd", "left")
    more = count["add"] + count["act"] > count["end"]
    flag = F.when(more & F.coalesce("is_high", F.lit(False)), "Y").otherwise("N")
    lists = [nvl_blank(n).alias(c) for n, c in (("add", "add_vas_list"), ("end", "end_vas_list"), ("act", "active_vas_list"))]
    return out.select(*key, *lists, flag.alias("bolt_on_flg"))


def with_lists(rows: DataFrame, lists: DataFrame) -> DataFrame:
    """Transactions with their add-on lists.

    Both lie by line and order number. Equal stores are asked for as a range, as the join would move both sides again for
    one more key; an order number has few stores.
    """
    on = [*LINE, "order_num"]
    store = F.col("store_cd").between(F.col("_store"), F.col("_store"))
    other = lists.select(*[F.col(c).alias(f"_{c}") for c in on], F.col("store_cd").alias("_store"), *[c for c in lists.columns if c not in (*on, "store_cd")])
    return rows.join(other, [*[F.col(c) == F.col(f"_{c}") for c in on], store], "left").drop("_store", *[f"_{c}" for c in on])


def transaction_type(ref: Column, orig_code: Column, orig_end: Column, day: Column) -> Column:
    """Retention up to three months before the old contract's end, an upgrade when earlier."""
    left = F.months_between(month_start(orig_end), month_start(day))
    return first_match([(ref == PLAN_CHANGE, "UPGRADE"), (no_code(orig_code) | no_date(orig_end), "RETENTION"), (left > 3, "UPGRADE")], "RETENTION")


def typed(
    t: Frames, rows: DataFrame, groups: Mapping[str, str], starts_only: bool = False, use_history: bool = True,
    years: tuple[int, int] = CALENDAR,
) -> DataFrame:
    """Type, plan group and creator of each transaction.

    The entitlement comes from the line's history on the effective date (or only from an interval
    that starts on it), else from the plan; a line with an add-on pack takes the add-on's. `years`
    are those that most effective dates lie in; others are matched too.
    """
    # The packs of a list are looked up beside its row, one row for each, and the row goes on from its first one.
    pack = t["entitle_ref"].groupBy(F.col("bill_serv_cd").alias("item")).agg(F.max("free_data_entitle").alias("pack_entitle"))
    out = split_rows(rows, "active_vas_list").join(pack, "item", "left")
    key = [*LINE, "order_num"]
    out = out.withColumn("pack_entitle", F.max(F.when(_all_known(key), F.col("pack_entitle"))).over(W.partitionBy(*key)))
    out = out.where("coalesce(pos, 1) = 1").drop("item", "pos")
    if use_history:
        hist = pick(t["data_entitle_hist"], *LINE, "start_date", "end_date", hist_entitle="free_data_entitle")
        out = join_asof(out, hist, LINE, "eff_date", starts_only=starts_only, years=years)
        out = out.drop("start_date", "end_date")
    else:
        out = out.withColumn("hist_entitle", F.lit(None).cast("string"))
    ref = pick(t["rate_plan_ref"], "rate_plan_cd", "rate_plan_grp", plan_entitle="free_data_entitle")
    out = out.join(ref, "rate_plan_cd", "left")
    by_pack = F.when(F.col("bolt_on_flg") == "Y", F.col("pack_entitle"))
    entitle = F.coalesce(by_pack, F.col("hist_entitle"), F.col("plan_entitle"), F.lit(NO_TEXT))
    staff = pick(t["fes_usr_info"], "salesman_flg", salesman_cd="usr_name")
    out = out.join(staff, "salesman_cd", "left").withColumn("free_data_entitle", entitle)
    creator = F.when(F.col("salesman_flg") == "Y", F.col("salesman_cd")).otherwise(F.col("usr_id"))
    return out.withColumns(
        {
            "trx_type": transaction_type(F.col("ref"), F.col("orig_ld_cd"), F.col("orig_ld_exp_date"), F.col("inv_date")),
            "rate_plan_grp": F.coalesce(plan_group("free_data_entitle", groups, ""), F.lit("")),
            "create_by": nvl_blank(creator),
            "fa_invoice_flg": F.when(creator.startswith("FA"), "Y").otherwise("N"),
        }
    ).withColumn("rate_plan_grp", F.when(F.col("rate_plan_grp") == "", F.lit("12. Other plans")).otherwise(F.col("rate_plan_grp")))


def staff_names(t: Frames) -> DataFrame:
    """User names with the first full name of their staff number; test accounts are left out."""
    name = F.upper("full_name")
    real = t["fes_usr_info"].where(~name.isin("DEMO", "NULL", "BMDM") & ~name.like("%TEST%"))
    first = nth_row(real.select("staff_id", "full_name", "pos_shop_cd", "create_ts"), "staff_id", ["pos_shop_cd", "create_ts", "full_name"])
    return real.drop("full_name").join(first.select("staff_id", "full_name"), "staff_id", "left")


# Call-centre teams and the channel each belongs to.
TEAM_CHANNEL = {
    "TS": "Cold call", "PR": "Call centre", "CS Fixed": "Call centre", "CS Mobile GZ": "Call centre",
    "CS Mobile HK": "Call centre", "CS Live Chat": "Call centre",
}


def channel(user: Column, team: Column, online: Column, store_is_own: Column, team_counts: Column) -> Column:
    """Channel that earned a transaction, from the user's team, code and store."""
    by_team = plan_group(team, TEAM_CHANNEL, "")
    return first_match(
        [
            (team_counts & team.isNotNull() & (by_team != ""), by_team),
            (user.startswith("CA"), "BM"),
            (F.upper(user).like("%ONLINE%") | online.isin("Y", "B"), "Online"),
            (user.startswith("FA"), "Street fighter"),
            (store_is_own, "RBD"),
        ],
        "Others",
    )


def attributed(t: Frames, rows: DataFrame, w: Window) -> DataFrame:
    """Channel and contract dates of each transaction, with missing dates derived from the other end."""
    admin = F.upper("comm_by").like("%ADMIN%") | blank("comm_by")
    calls = t["pr_status"].where(F.col("program_id").rlike("^(PRR|HP|FB|PR00)") & F.lit(w.end).between(F.col("start_date"), F.col("end_date")))
    calls = pick(calls, *LINE, "program_id", "comm_by", "pr_status", "lst_mod_date", "create_date", prog_start="start_date", prog_end="end_date")
    fresh = settle(pick(new_lines(t, w), *LINE, is_new=F.lit("Y")).distinct(), "channel_new_lines")
    # All transactions of a line see the same calls, so the call is chosen per line.
    call = nth_row(drop_in(calls, fresh, LINE).withColumn("_p", F.when(admin, 0).otherwise(1)), LINE, [_latest("lst_mod_date"), _latest("_p"), "program_id"])
    call = call.select(*LINE, "program_id", "comm_by", "pr_status", "lst_mod_date", "prog_start", "prog_end")
    redeem = t["redemption"].groupBy(*LINE).agg(F.max("redem_end_date").alias("redem_end_date"))
    names = staff_names(t)
    own = pick(t["stores"].where("daily_sales_sms = 'Y'"), "store_cd", own_store=F.lit(True)).distinct()
    terms = t["subr_ld_hist"].where((F.col("end_date") == F.lit(OPEN_DATE)) & (F.col("void_flg") != "Y") & (F.col("waived_flg") != "Y"))
    terms = terms.join(t["mkt_ref_vw"].where("ld_revenue in ('P', 'V')").select("mkt_cd", "ld_revenue"), "mkt_cd")
    sold = pick(t["pos_inv_header"], "inv_num", *LINE, "inv_date", ld_expired_date="ld_expiry_date")
    terms = terms.select("inv_num", *LINE, "ld_cd", "ld_start_date", "ld_expired_date", "ld_revenue").join(sold, ["inv_num", *LINE, "ld_expired_date"], "left")
    newest = ranked(terms, LINE, [F.col("inv_date").desc_nulls_first(), _latest("ld_expired_date"), "inv_num"], 2, ties=False)
    start = repair_start("ld_start_date", "ld_expired_date", "ld_cd").alias("start")
    sides = {"orig": 2, "new": 1}
    newest = newest.groupBy(*LINE).agg(*[F.max(F.when(F.col("rnk") == n, F.struct("ld_revenue", start))).alias(f"_{side}") for side, n in sides.items()])
    # What is known by line is joined first, and all of it by line alone: the transactions move once.
    out = rows.join(call, LINE, "left").join(redeem, LINE, "left").join(newest, LINE, "left")
    for side in sides:
        of_kind = F.col(f"_{side}.ld_revenue") == F.col(f"{side}_ld_revenue")
        out = out.withColumn(f"{side}_ld_start_date", F.when(of_kind, F.col(f"_{side}.start"))).drop(f"_{side}")
    out = apply_match(out.withColumn("new_activation_flg", F.lit("N")), fresh, LINE, {"new_activation_flg": "m_is_new"})
    out = out.join(own, "store_cd", "left")
    out = out.join(pick(names, create_by="usr_name", create_team="call_centre_team", create_grp="grp_name"), "create_by", "left")
    out = out.join(pick(names, comm_by="usr_name", comm_team="call_centre_team", comm_grp="grp_name"), "comm_by", "left")
    online, mine = F.coalesce("online_inv", F.lit("N")), F.coalesce("own_store", F.lit(False))
    no_call = F.col("comm_by").isNull() | F.upper("comm_by").like("%ADMIN%") | blank("comm_by")
    by_creator = no_call | F.coalesce(F.col("inv_date") > F.col("redem_end_date"), F.lit(False))
    agreed = F.col("pr_status").isin("AO", "Accept Offer") | (~blank("pr_status") & ~blank("comm_by"))
    effort = F.when(by_creator, channel(F.col("create_by"), F.col("create_team"), online, mine, F.lit(True))).otherwise(
        channel(F.col("comm_by"), F.col("comm_team"), online, mine, F.coalesce(agreed, F.lit(False)))
    )
    out = out.withColumn("channel_effort", effort).drop("own_store")
    real_order = F.col("order_num").startswith("ORDER") & (F.col("ref") != PLAN_CHANGE)
    out = out.withColumns(
        {
            "orig_ld_start_date": F.coalesce("orig_ld_start_date", F.lit(NO_DATE)),
            "new_ld_start_date": F.when(real_order & no_date("new_ld_start_date"), F.col("eff_date")).otherwise(F.coalesce("new_ld_start_date", F.lit(NO_DATE))),
        }
    )
    for side in ("new", "orig"):
        out = out.withColumn(f"{side}_ld_start_date", repair_start(f"{side}_ld_start_date", f"{side}_ld_exp_date", f"{side}_ld_cd"))
    for side in ("new", "orig"):
        out = out.withColumn(f"{side}_ld_exp_date", repair_end(f"{side}_ld_start_date", f"{side}_ld_exp_date", f"{side}_ld_cd"))
    out = apply_rules(out, [("new_activation_flg = 'Y'", {"trx_type": F.lit("NEW ACTIVATION"), "ref": F.lit("NEW ACTIVATION")})])
    out = out.withColumn("replace_old_ld", replaces(*[F.col(c) for c in ("orig_ld_start_date", "orig_ld_exp_date", "new_ld_start_date", "new_ld_exp_date")]))
    out = drop_where(out, F.col("create_by").startswith("CA"))
    portal = pick(
        t["portal_trans"].where(within(month_start("submission_date"), Window(w.start, w.start))), *LINE, rate_plan_cd="renewed_plan_cd",
        inv_date="submission_date", to_store="store_cd", to_staff="salesman_cd",
    ).groupBy(*LINE, "rate_plan_cd", "inv_date").agg(F.max_by("to_store", "to_staff").alias("to_store"), F.max("to_staff").alias("to_staff"))
    # A line's renewals of the month are one list, so that this match is by line too.
    portal = portal.groupBy(*LINE).agg(F.collect_list(F.struct("rate_plan_cd", "inv_date", "to_store", "to_staff")).alias("renewed"))
    own = F.filter("m_renewed", lambda x: (x["rate_plan_cd"] == F.col("rate_plan_cd")) & (x["inv_date"] == F.col("inv_date")))
    return apply_match(
        out, portal, LINE,
        {"channel_effort": F.lit("RBD"), "store_cd": F.get(own, F.lit(0))["to_store"], "create_by": F.get(own, F.lit(0))["to_staff"], "comm_by": F.lit(NO_TEXT)},
        guard=(F.col("channel_effort") == "Online") & (F.size(own) > 0),
    )


def replaces(orig_start: Column, orig_end: Column, new_start: Column, new_end: Column) -> Column:
    """Whether the new contract takes the place of one that has not run out."""
    same = (month_start(new_start) == month_start(orig_start)) & (month_start(new_end) == month_start(orig_end))
    return first_match(
        [(no_date(new_start) | no_date(orig_end), "N"), (same, "N"), (month_start(new_start) <= month_start(orig_end), "Y")], "N"
    )


def run(t: Frames, w: Window, groups: Mapping[str, str]) -> dict[str, DataFrame]:
    rows = settle(transactions(t, w), "channel_rows")
    full = with_lists(detail(t, rows, w), addon_lists(t, rows, w))
    done = settle(typed(t, full, groups, years=w.years), "channel_typed")
    return {"transactions": rows, "detail": settle(attributed(t, done, w), "channel_done")}


__all__ = [
    "addon_lists", "attributed", "detail", "new_lines", "replaces", "run", "settled_orders", "staff_names",
    "transaction_type", "transactions", "typed", "with_lists",
]
