"""Campaign results: what a contacted line held before, what it took after, and how that counts.

Then the KPI matrix and the plan-mix matrix that are drawn from the classified lines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import blank, decode, first_match, month_start, pct_text, ratio
from millrace.operators import constant_rows, grid, keep_first, keep_in, label_order, list_agg, pivot_blocks, pivot_report, split_rows, stack, with_position
from millrace.params import NO_TEXT, OPEN_DATE
from millrace.plans.base import LINE, Frames, pick
from millrace.storage import settle

# Final states of a call that count as reached.
REACHED = ["ACCEPT OFFER", "CONSIDER", "WAIT FULFILL", "REJECT", "NOT AVAILABLE"]
BONUS_COLS = ["hs_mkt_cd", "fup_mkt_cd", "vas_mkt_cd", "vas2_mkt_cd", "vas3_mkt_cd"]


def dictionary(t: Frames, group: str, day: Column | None = None) -> DataFrame:
    """Values of a dictionary group, if wanted only those in force on a day."""
    rows = t["dict_ref"].where(F.col("dict_grp").startswith(group))
    if day is not None:
        rows = rows.where(day.between(F.col("eff_start_date"), F.col("eff_end_date")))
    return rows.select("dict_grp", "dict_val").distinct()


# The averages and the monthly figures that they are of (last month, the one before, the one before that).
AVERAGES = {
    "avg_net_rev": "net_rev", "avg_net_accs_rev": "net_accs_rev", "avg_net_thereafter_rev": "net_thereafter_rev", "avg_net_idd_rev": "net_idd_rev",
    "avg_net_outbd_roam_rev": "net_outbd_roam_rev", "avg_net_vdrs_rev": "net_vdrs_rev", "avg_other_rev": "other_rev", "avg_hs_amort_amt": "hs_amort_amt",
    "avg_mou": "mou", "avg_usage_gb": "vol_kb",
}


def before(t: Frames) -> DataFrame:
    """Averages of the last three months before the contact, from the monthly summary: those whose figures it has."""
    asked = t["campaign"].select("trx_id", *LINE, F.add_months(month_start("contact_start_date"), -1).alias("trx_month"))
    by = ["trx_id", *LINE, "ld_exp_date", "rate_plan_cd", "plan_tariff", "subr_sw_on_date", "nomination_flg"]
    summary = t["master_summ"]
    three = lambda c: (F.col(f"{c}_1") + F.col(f"{c}_2") + F.col(f"{c}_3")) / 3
    scaled = {"vol_kb": lambda c: c / 1024 / 1024}
    sums = [F.sum(scaled.get(c, lambda x: x)(three(c))).alias(n) for n, c in AVERAGES.items() if f"{c}_1" in summary.columns]
    return asked.join(summary, [*LINE, "trx_month"]).groupBy(*by).agg(*sums)


def last_call(t: Frames, day: Column) -> DataFrame:
    """The state, handler and programme of the last call after the contact."""
    asked = t["campaign"].select("trx_id", *LINE, "contact_start_date")
    listed = pick(dictionary(t, "PRG_ID:", day), program_id="dict_val", known=F.lit(True)).distinct()
    calls = t["pr_status"].join(listed, "program_id", "left").where("known or program_id like 'PRS%'").drop("known")
    seen = asked.join(calls, LINE).where("lst_mod_date >= contact_start_date")
    cols = ["lst_mod_date", "pr_status", "comm_by", "program_id"]
    return keep_first(seen.withColumn("_at", F.col("lst_mod_date")), "trx_id", "_at", cols, desc=True)


def addons_before(t: Frames) -> DataFrame:
    """Add-ons held before the contact: tariff codes by pattern, and contracts by market code."""
    asked = t["campaign"].select("trx_id", *LINE, "contact_start_date")
    tariffs = asked.join(t["bill_servs"], LINE).where(
        F.col("bill_serv_cd").rlike("^FUP[0-9]{2}") & (F.col("bill_start_date") < F.col("contact_start_date"))
    )
    cols = ["bill_serv_cd", "bill_rate"]
    code = keep_first(tariffs, "trx_id", "bill_start_date", cols, desc=True)
    held = keep_in(t["ld_post_paygo"], pick(dictionary(t, "MKT_CD:BF-FUP"), mkt_cd="dict_val"), "mkt_cd")
    terms = asked.join(held, LINE).where("inv_date < contact_start_date")
    term = keep_first(terms.withColumn("_at", F.col("ld_expired_date")), "trx_id", "_at", ["mkt_cd", "inv_num"], desc=True)
    rows = stack(
        code.select(
            "trx_id", F.lit("BILL_CD:BF-FUP").alias("src"), F.col("bill_serv_cd").alias("cd"),
            F.col("bill_rate").cast("decimal(12,2)").alias("tariff"), F.lit("NA").alias("ref"),
        ),
        term.select(
            "trx_id", F.lit("MKT_CD:BF-FUP").alias("src"), F.col("mkt_cd").alias("cd"),
            F.lit(0).cast("decimal(12,2)").alias("tariff"), F.col("inv_num").alias("ref"),
        ),
    )
    note = F.concat(F.lit('"'), "src", F.lit('":"'), F.concat_ws(";", "cd", F.col("tariff").cast("string"), "ref"), F.lit('"'))
    notes = list_agg(rows.withColumn("note", note), "trx_id", "note", ["src", "note"], name="bf_json_rmk")
    names = list_agg(rows, "trx_id", "cd", ["src", "cd"], name="bf_other_lst")
    return rows.groupBy("trx_id").agg(F.sum("tariff").alias("bf_other_amt")).join(names, "trx_id").join(notes, "trx_id")


def after(t: Frames) -> tuple[DataFrame, DataFrame]:
    """The last renewal after the contact, and the add-on market codes ordered after it."""
    asked = t["campaign"].select("trx_id", *LINE, "contact_start_date")
    done = t["activity"].where(F.col("trx_type").isin("RETENTION", "UPGRADE"))
    tariff = pick(t["bill_serv_ref"].where(F.col("eff_end_date") == F.lit(OPEN_DATE)), new_rate_plan_cd="bill_serv_cd", new_tariff="bill_rate")
    took = asked.join(done, LINE).where("inv_date >= contact_start_date").join(tariff, "new_rate_plan_cd", "left")
    cols = ["channel_effort", "online_inv", "store_cd", "mkt_cd", "new_rate_plan_cd", "new_ld_cd", "new_tariff"]
    renewal = keep_first(took, "trx_id", "inv_date", cols, desc=True)
    wanted = pick(dictionary(t, "MKT_CD:AF-"), mkt_cd="dict_val", src="dict_grp")
    orders = asked.join(t["om_chg_plan"], LINE).where("create_date >= contact_start_date").join(wanted, "mkt_cd")
    note = F.concat(F.lit('"'), "src", F.lit('":"'), "mkt_cd", F.lit("=0;"), "case_id", F.lit('"'))
    every = orders.withColumn("note", note)
    lists = list_agg(every, "trx_id", "mkt_cd", name="af_mkt_cd_lst")
    lists = lists.join(list_agg(every, "trx_id", "case_id", ["mkt_cd", "case_id"], name="af_map_key_id_lst"), "trx_id")
    lists = lists.join(list_agg(every, "trx_id", "note", ["mkt_cd", "note"], name="af_json_rmk"), "trx_id")
    lists = lists.join(list_agg(every, "trx_id", "mkt_cd", distinct=True, name="af_addon_map_mkt_lst"), "trx_id")
    return renewal, lists


def rules(t: Frames) -> DataFrame:
    """Offer rules with the sorted list of the add-on codes they ask for."""
    codes = F.concat_ws(",", *[F.when(~blank(c), F.col(c)) for c in BONUS_COLS])
    items = split_rows(t["rule_ref"].select("rule_id", codes.alias("codes")), "codes", name="mkt_cd").where("mkt_cd is not null")
    lists = list_agg(items, "rule_id", "mkt_cd", distinct=True, name="addon_list")
    out = t["rule_ref"].join(lists, "rule_id", "left")
    return out.withColumn("addon_list", F.coalesce("addon_list", F.lit(NO_TEXT)))


def classify(t: Frames, day: Column) -> DataFrame:
    """One classified row per campaign line."""
    call = pick(last_call(t, day), "trx_id", pr_final_status="pr_status", pr_comm_by="comm_by", pr_call_pgm_id="program_id")
    bf = pick(before(t), "trx_id", bf_ld_exp_date="ld_exp_date", bf_rate_plan_cd="rate_plan_cd", bf_plan_tariff="plan_tariff", bf_avg_net_rev="avg_net_rev")
    renewal, lists = after(t)
    af = pick(renewal, "trx_id", af_channel_effort="channel_effort", af_rate_plan_cd="new_rate_plan_cd", af_plan_mkt_cd="mkt_cd", af_ld_cd="new_ld_cd", af_plan_tariff="new_tariff")
    out = t["campaign"]
    for part in (call, bf, addons_before(t), af, lists):
        out = out.join(part, "trx_id", "left")
    texts = [
        "pr_final_status", "pr_comm_by", "pr_call_pgm_id", "bf_rate_plan_cd", "bf_other_lst", "bf_json_rmk", "af_channel_effort",
        "af_rate_plan_cd", "af_plan_mkt_cd", "af_ld_cd", "af_mkt_cd_lst", "af_map_key_id_lst", "af_json_rmk", "af_addon_map_mkt_lst",
    ]
    sums = ["bf_plan_tariff", "bf_avg_net_rev", "bf_other_amt", "af_plan_tariff"]
    zero = F.lit(0).cast("decimal(18,2)")
    out = out.withColumns(
        {
            **{c: F.coalesce(c, F.lit(NO_TEXT)) for c in texts},
            **{c: F.coalesce(F.col(c).cast("decimal(18,2)"), zero) for c in sums},
            "bf_ld_exp_date": F.coalesce("bf_ld_exp_date", F.lit(OPEN_DATE)),
        }
    )
    rule = rules(t).withColumn("len", F.length("addon_list"))
    asked = out.select("trx_id", F.col("af_rate_plan_cd").alias("plan_cd"), F.col("af_plan_mkt_cd").alias("plan_mkt_cd"), F.col("af_addon_map_mkt_lst").alias("addon_list"))
    fits = asked.join(rule, ["plan_cd", "plan_mkt_cd", "addon_list"])
    best = keep_first(fits, "trx_id", "len", ["rule_id", "net_price", "plan_mix_nature", "plan_mix_sub_nature"], desc=True)
    best = pick(best, "trx_id", ru_rule_id="rule_id", ru_net_price="net_price", ru_plan_mix_nature="plan_mix_nature", ru_plan_mix_sub_nature="plan_mix_sub_nature")
    out = out.join(best, "trx_id", "left")
    out = out.withColumns(
        {
            **{c: F.coalesce(c, F.lit(NO_TEXT)) for c in ("ru_rule_id", "ru_plan_mix_nature", "ru_plan_mix_sub_nature")},
            "ru_net_price": F.coalesce(F.col("ru_net_price").cast("decimal(18,2)"), zero),
        }
    )
    out = out.withColumn("af_net_price", F.when(F.col("ru_rule_id") != NO_TEXT, F.col("ru_net_price")).otherwise(F.col("af_plan_tariff")))
    return labels(out)


def labels(rows: DataFrame) -> DataFrame:
    """Sale type, reach, hit and exception of a campaign line."""
    ruled = F.col("ru_rule_id") != NO_TEXT
    was, now = F.col("bf_avg_net_rev"), F.col("af_net_price")
    status, channel = F.upper("pr_final_status"), F.col("af_channel_effort")
    accepted = status == "ACCEPT OFFER"
    return rows.withColumns(
        {
            "cl_sale_type": first_match([(ruled & (was > now), "DOWN_SELL"), (ruled & (was == now), "FLAT_SELL"), (ruled & (was < now), "UP_SELL")], NO_TEXT),
            "cl_reach": F.when(status.isin(*REACHED), "REACH").otherwise("NON_REACH"),
            "cl_hit": first_match(
                [
                    (accepted & (channel == "Outbound"), "HIT:OUTBOUND"),
                    (accepted & (channel == "Inbound"), "HIT:INBOUND"),
                    (ruled, F.concat(F.lit("HIT:"), F.upper(channel))),
                ],
                NO_TEXT,
            ),
            "cl_except": F.when(~ruled & (channel != NO_TEXT), "EXCEPT_RULE_UNMAP").otherwise(NO_TEXT),
        }
    )


# --- KPI matrix ---------------------------------------------------------------------------

# Lines of the KPI matrix that carry a label only, and the two targets.
HEADINGS = {
    2: "Recontract Plan Rate", 3: "Target(Plan)", 13: "Recontract Revenue Rate", 14: "Target(Revenue)",
    19: "Avg Net Service Revenue Per User", 22: "Sales status (%)", 26: "Total(%)", 27: "Sales status (count)", 32: "Magnitude",
}
TARGETS = {3: "50%", 14: "50%"}
TARGET_RATE = 0.5


def kpi_base(h: DataFrame, by: str = "shk_tier") -> DataFrame:
    """Sums per tier from which every KPI line follows."""
    hit = F.col("cl_hit").startswith("HIT")
    potential = F.col("shk_sale_tag") == "5G_POTENTIAL"
    sold = F.col("cl_sale_type").endswith("SELL")

    def amount(cond: Column, c: str) -> Column:
        return F.sum(F.when(cond, F.col(c)).otherwise(0)).cast("decimal(28,2)")

    return h.groupBy(by).agg(
        F.count(F.lit(1)).alias("size"), F.count_if(potential).alias("size_pot"), F.count_if(F.col("cl_reach") == "REACH").alias("reached"),
        F.count_if(hit).alias("hit"), F.count_if(hit & potential).alias("hit_pot"),
        amount(hit, "bf_avg_net_rev").alias("bf_rev"), amount(hit, "af_net_price").alias("af_rev"),
        F.count_if(F.col("cl_sale_type") == "UP_SELL").alias("up"), F.count_if(F.col("cl_sale_type") == "FLAT_SELL").alias("flat"),
        F.count_if(F.col("cl_sale_type") == "DOWN_SELL").alias("down"), F.count_if(sold).alias("sold"),
        amount(F.col("cl_sale_type") == "UP_SELL", "bf_plan_tariff").alias("bf_up"),
        amount(F.col("cl_sale_type") == "DOWN_SELL", "bf_plan_tariff").alias("bf_down"),
        amount(sold, "bf_plan_tariff").alias("bf_sold"), amount(sold, "af_plan_tariff").alias("af_sold"),
    )


def kpi_cells(base: DataFrame, by: str = "shk_tier") -> DataFrame:
    """Long cells: line number, label, tier, text."""
    num = {c: F.col(c).cast("decimal(28,6)") for c in base.columns if c != by}

    def part(n: str, d: str) -> Column:
        return ratio(num[n], num[d]).cast("decimal(28,10)")

    def count(c: str) -> Column:
        return F.col(c).cast("string")

    def amount(c: Column) -> Column:
        return F.round(c, 2).cast("decimal(28,2)").cast("string")

    was, now = part("bf_rev", "hit"), part("af_rev", "hit")
    total_was, total_now = (num["size"] * was).cast("decimal(28,6)"), (num["hit"] * now).cast("decimal(28,6)")
    plan_rate, revenue_rate = part("hit", "size"), ratio(total_was, total_now).cast("decimal(28,10)")
    lines = [
        (1, "KPI", F.col(by)), (4, "Gap(Plan)", pct_text(plan_rate - TARGET_RATE)), (5, "PTD(Plan)", pct_text(plan_rate)),
        (6, "Size", count("size")), (7, "Size (5G potential customer)", count("size_pot")), (8, "Reached", count("reached")),
        (9, "Reach %", pct_text(part("reached", "size"))), (10, "Hit", count("hit")), (11, "Hit/Reach%", pct_text(part("hit", "reached"))),
        (12, "Hit (from 5G potential customer)", count("hit_pot")), (15, "Gap(Revenue)", pct_text(revenue_rate - TARGET_RATE)),
        (16, "PTD(Revenue)", pct_text(revenue_rate)), (17, "Net service revenue1 (before)", amount(total_was)),
        (18, "Net service revenue (after)", amount(total_now)), (20, "Before", amount(was)), (21, "After (accept order)", amount(now)),
        (23, "Upsell(%)", pct_text(part("up", "sold"))), (24, "Flatsell(%)", pct_text(part("flat", "sold"))),
        (25, "Downsell(%)", pct_text(part("down", "sold"))), (28, "Upsell(count)", count("up")), (29, "Flatsell(count)", count("flat")),
        (30, "Downsell(count)", count("down")), (31, "Total(count)", count("sold")),
        (33, "Upsell magnitude", pct_text(part("bf_up", "af_sold"))), (34, "Downsell magnitude", pct_text(-part("bf_down", "af_sold"))),
        (35, "Overall magnitude", pct_text(part("bf_sold", "af_sold"))),
    ]
    lines += [(n, label, F.lit(TARGETS.get(n, NO_TEXT))) for n, label in HEADINGS.items()]
    cells = [F.struct(F.lit(n).alias("row_num"), F.lit(label).alias("label"), v.cast("string").alias("disp_val")) for n, label, v in lines]
    return base.select(F.col(by).alias("col_key"), F.explode(F.array(*cells)).alias("c")).select("col_key", "c.*")


FIRST_COLUMN = 3  # after the line's number and label


def column_numbers(h: DataFrame, by: str, whole: str) -> DataFrame:
    """(col_key, col_num): the whole is column 3, the tiers follow it in order."""
    tiers = with_position(h.where(F.col(by).isNotNull()).select(F.col(by).alias("col_key")).distinct(), "col_key", "col_num")
    first = constant_rows(h.sparkSession, [(whole, FIRST_COLUMN)], "col_key string, col_num bigint")
    return stack(first, tiers.withColumn("col_num", F.col("col_num") + FIRST_COLUMN + 1))


def kpi_long(h: DataFrame, by: str = "shk_tier") -> DataFrame:
    """Cells of the 35 lines by tier with Total, with their column's number; Total comes from the detail, not from the tier cells."""
    tiers = kpi_base(h, by)
    sums = [c for c in tiers.columns if c != by]
    whole = tiers.agg(*[F.sum(c).cast(tiers.schema[c].dataType).alias(c) for c in sums]).withColumn(by, F.lit("Total"))
    cells = kpi_cells(stack(whole.select(*tiers.columns), tiers), by)
    return cells.join(column_numbers(h, by, "Total"), "col_key")


def kpi_matrix(h: DataFrame, tiers: Sequence[str], by: str = "shk_tier") -> DataFrame:
    """The cells as a table with Total and the given tiers as columns."""
    return pivot_report(kpi_long(h, by), ["row_num", "label"], "col_key", "disp_val", ["Total", *tiers])


def kpi_blocks(h: DataFrame, by: str = "shk_tier", width: int = 50) -> DataFrame:
    """The cells as tables of `width` columns, for tiers of any number."""
    return pivot_blocks(kpi_long(h, by), ["row_num", "label"], "col_num", "disp_val", FIRST_COLUMN, width)


# --- plan mix -----------------------------------------------------------------------------

def plan_mix_cells(h: DataFrame) -> DataFrame:
    """Share of each plan nature among the hits of a batch and tier, and of the batch as TOTAL."""
    unmap = {c: decode(c, (NO_TEXT, "UNMAP"), default=F.col(c)) for c in ("ru_plan_mix_nature", "ru_plan_mix_sub_nature")}
    nature, sub = "ru_plan_mix_nature", "ru_plan_mix_sub_nature"
    hits = h.where(F.col("cl_hit").startswith("HIT")).withColumns(unmap)
    counted = hits.groupBy("batch_id", "shk_tier", nature, sub).agg(F.count("subr_num").alias("cnt"))
    whole = counted.groupBy("batch_id", nature, sub).agg(F.sum("cnt").alias("cnt")).withColumn("shk_tier", F.lit("TOTAL"))
    every = stack(counted, whole)
    sums = every.groupBy("batch_id", "shk_tier").agg(F.sum("cnt").alias("all_cnt"))
    shares = every.join(sums, ["batch_id", "shk_tier"]).withColumn("ptg", ratio(F.col("cnt").cast("decimal(20,0)"), F.col("all_cnt")).cast("decimal(28,12)"))
    tiers = stack(h.select("shk_tier").distinct(), constant_rows(h.sparkSession, [("TOTAL",)], "shk_tier string"))
    names = counted.select("batch_id", nature, sub).distinct()
    names = label_order(label_order(names, ["batch_id"], nature, "rnk_nature"), ["batch_id", nature], sub, "rnk_sub_nature")
    detail = grid(names, tiers).join(shares.drop("cnt", "all_cnt"), ["batch_id", "shk_tier", nature, sub], "left")
    detail = detail.withColumns({"display_nature": F.col(sub), "ptg": pct_text(F.coalesce("ptg", F.lit(0).cast("decimal(28,12)")))})
    heads = grid(names.select("batch_id", nature, "rnk_nature").distinct(), tiers).withColumns(
        {sub: F.lit(NO_TEXT), "rnk_sub_nature": F.lit(0), "display_nature": F.col(nature), "ptg": F.lit(NO_TEXT)}
    )
    return stack(heads.select(*detail.columns), detail)


PLAN_MIX_ROW = ["batch_id", "rnk_nature", "rnk_sub_nature", "display_nature"]


def plan_mix_matrix(h: DataFrame, tiers: Sequence[str]) -> DataFrame:
    """Shares with TOTAL and the given tiers as columns."""
    return pivot_report(plan_mix_cells(h), PLAN_MIX_ROW, "shk_tier", "ptg", ["TOTAL", *tiers])


def plan_mix_blocks(h: DataFrame, width: int = 50) -> DataFrame:
    """Shares as tables of `width` columns, for tiers of any number."""
    cells = plan_mix_cells(h).join(column_numbers(h, "shk_tier", "TOTAL").withColumnRenamed("col_key", "shk_tier"), "shk_tier")
    return pivot_blocks(cells, PLAN_MIX_ROW, "col_num", "ptg", FIRST_COLUMN, width)


def run(t: Frames, day: Column) -> dict[str, DataFrame]:
    h = settle(classify(t, day), "campaign_lines")
    return {"lines": h, "kpi": kpi_blocks(h), "plan_mix": plan_mix_blocks(h)}


__all__ = ["before", "classify", "kpi_blocks", "kpi_long", "kpi_matrix", "labels", "plan_mix_blocks", "plan_mix_cells", "plan_mix_matrix", "run"]
