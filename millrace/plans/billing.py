"""Bills: adjustments that cancel out, contracts at a month end, and cost sheet cleaning."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import clean_number, contract_months, strip_money, tier_string
from millrace.operators import drop_in, join_list_member, keep_first, keep_in, offset_pairs, snapshot
from millrace.params import shift_months
from millrace.plans.base import LINE, Frames, pick


GROUP = ["customer_reference", "actual_bill_date"]


def adjustments(t: Frames, bills: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The given bills with their group (customer and date), and the adjustment transactions of all bills of those groups.

    Every bill of a group sees the same transactions, so these are found once a group, not once a bill.
    """
    kinds = pick(t["payment_method"].where(F.substring("payment_method_name", 7, 3) == "ADJ"), payment_method_name=F.substring("payment_method_name", 1, 5))
    main = keep_in(t["bill"], bills, "bill_reference").select("bill_reference", *GROUP)
    every = keep_in(t["bill"].select("bill_reference", *GROUP), main.select(*GROUP).distinct(), GROUP)
    return main, keep_in(t["bill_trans"].join(every, "bill_reference"), kinds, "payment_method_name")


def offsets(t: Frames, bills: DataFrame) -> DataFrame:
    """Sum of the absolute amounts that cancel out in exactly two adjustments of a bill's group, per bill."""
    main, rows = adjustments(t, bills)
    sums = offset_pairs(rows, GROUP, "transaction_amount").groupBy(*GROUP).agg(F.sum("abs_transaction_amount").alias("offset_amt"))
    return main.join(sums, GROUP).select("bill_reference", "offset_amt")


def standing(t: Frames, bills: DataFrame) -> DataFrame:
    """Own adjustments of each bill that nothing in its group cancels."""
    main, rows = adjustments(t, bills)
    pairs = offset_pairs(rows, GROUP, "transaction_amount")
    own = keep_in(rows, main, "bill_reference").withColumn("abs_transaction_amount", F.abs("transaction_amount"))
    return drop_in(own, pairs, [*GROUP, "abs_transaction_amount"]).select("bill_reference", "transaction_amount")


def latest_contracts(t: Frames, month_end: date, months_back: int = 5) -> DataFrame:
    """The plan contract of each line that runs at a month end and ends last, with its months."""
    since = shift_months(month_end.replace(day=1), -months_back)
    at = F.lit(month_end)
    rows = snapshot(t["subr_ld_hist"], at).where(
        at.between(F.col("ld_start_date"), F.col("ld_expired_date")) & (F.col("ld_start_date") >= F.lit(since))
        & (F.col("void_flg") != "Y") & (F.col("waived_flg") != "Y") & (F.col("billed_flg") != "Y")
    )
    rows = keep_in(rows, t["mkt_ref_vw"].where("ld_revenue = 'P'"), "mkt_cd").withColumn("months", contract_months("ld_cd"))
    return keep_first(rows, LINE, "ld_expired_date", ["inv_num", "ld_cd", "months"], desc=True)


def extra_costs(t: Frames) -> DataFrame:
    """Extra cost per line: new orders only, lists of lines spread out, other text counting as 0."""
    new = t["extra_cost"].where("order_type = 'New'").withColumn("cost", clean_number(F.translate("extra_cost", "$,", "")))
    new = new.withColumn("subr_list", F.translate("subr_num", " ", "")).drop("subr_num")
    found = join_list_member(new, "subr_list", t["lines"].select("subr_num"), "subr_num")
    return found.groupBy("subr_num").agg(F.sum("cost").alias("extra_cost"))


# The month ranges of a tier text.
RANGES = ["0-12", "13-24", "25-36"]


def cost_sheet(df: DataFrame, suppliers: Sequence[str], first_year_only: str) -> DataFrame:
    """Money text cleaned, and costs per supplier put together as tier texts.

    Each supplier has the columns `<s>_mthly_12/24/36` and `<s>_oneoff`; the one-off cost of
    `first_year_only` is `<s>_oneoff_12` and holds for the first year.
    """
    out = {c: strip_money(c) for c in ("oneoff_cost", "add_oneoff_cost", "monthly_cost")}
    for s in suppliers:
        out[f"{s}_mthly"] = tier_string(*[(r, f"{s}_mthly_{n}") for r, n in zip(RANGES, (12, 24, 36))])
        if s == first_year_only:
            out[f"{s}_oneoff"] = F.concat(F.lit("0-12:"), strip_money(f"{s}_oneoff_12"), F.lit("|13-36:0"))
        else:
            out[f"{s}_oneoff"] = F.concat(F.lit("0-36:"), strip_money(f"{s}_oneoff"))
    return df.select("bill_cd", *[c.alias(n) for n, c in out.items()])
