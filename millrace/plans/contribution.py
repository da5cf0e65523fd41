"""Contribution by store and by staff: revenue at channel rates, less costs and a share of the overhead."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import nth_segment, plan_tier
from millrace.operators import allocate, drop_in, fill_grid, grid, join_range, keep_in, signed_total, stack
from millrace.params import Window
from millrace.plans.base import Frames, pick, within

AMOUNT = "decimal(24,6)"
# Report line of each cost nature, and the tiers of each kind of plan.
COST_LINES = {
    "COMMISSION": "3", "MARKETING COST": "3.1", "MANPOWER COSTS": "5", "RENTAL & UTILITIES": "6", "MIS EXPENSES": "7",
    "ADMINISTRATION EXPENSES": "8",
}
MARKETING_ACCOUNTS = ["09179010", "09179030"]
MINUS = ["3", "3.1", "3.2", "4", "5", "6", "7", "8", "8.1", "8.2", "8.3"]
KINDS = ["postpaid", "handset", "accessory", "prepaid", "hp", "fbb", "others"]


def plan_kind(label: Column) -> Column:
    tier = plan_tier(label)
    return F.when(tier <= 12, "postpaid").when(tier.between(13, 16), "fbb").when(tier > 16, "hp")


def product_channel(own_stores: Column) -> Column:
    """Channel of a product sale, for its rate."""
    return (
        F.when(F.col("salesman").startswith("FA"), "STREET FIGHTER")
        .when(F.col("online_inv_flg").isin("Y", "B"), "ONLINE")
        .when(own_stores, "RBD")
        .otherwise("OTHERS")
    )


def sales(t: Frames, services: DataFrame, products: DataFrame, w: Window, by: list[str]) -> DataFrame:
    """Revenue per `by` and kind at channel rates; services without a rate count in full.

    Amounts are summed per channel before the rates are joined.
    """
    own = t["stores"].where("daily_sales_sms = 'Y'").select("store_cd", F.lit(True).alias("own")).distinct()
    rates = t["channel_rate"].select(F.upper("channel").alias("chan"), "discount_rate")
    served = services.where(within("inv_date", w)).select(
        *by, plan_kind(F.col("rate_plan_grp")).alias("kind"), F.upper("channel_effort").alias("chan"),
        (F.col("total_service_revenue") + F.col("vas_fee")).alias("amt"), F.lit(1).alias("base"),
    )
    item = F.when(F.col("cls") == "HANDSET", "handset").when(F.col("cls") == "ACCESSORY", "accessory").when(F.col("cls").isin("SIM", "VOUCHER"), "prepaid").otherwise("others")
    value = F.col("pos_amt") + F.when(F.col("cls") == "HANDSET", F.col("trade_in_amt") + F.col("rebate_amt")).when(F.col("cls") == "ACCESSORY", F.col("coupon_amt")).otherwise(0)
    sold = products.where(within("inv_date", w)).join(own, "store_cd", "left")
    sold = sold.select(*by, item.alias("kind"), product_channel(F.coalesce("own", F.lit(False))).alias("chan"), value.alias("amt"), F.lit(None).cast("int").alias("base"))
    sold = sold.withColumn("base", F.when(F.col("kind") == "others", 1))
    summed = stack(served.where("kind is not null"), sold).groupBy(*by, "kind", "chan", "base").agg(F.sum("amt").alias("amt"))
    rated = summed.join(rates, "chan", "left")
    rate = F.when(F.col("kind") == "others", F.lit(1)).otherwise(F.coalesce("discount_rate", "base"))
    return rated.groupBy(*by, "kind").agg(F.sum(F.col("amt") * rate).cast(AMOUNT).alias("revenue"))


def costs_of_sales(t: Frames, revenue: DataFrame, services: DataFrame, w: Window, by: list[str], goods_kinds: Sequence[str] = ("handset", "accessory", "prepaid")) -> DataFrame:
    """Revenue times margin: services by plan tier, products by kind."""
    margin = t["margin"].select("grp_name", "margin")
    tiers = margin.select(plan_tier("grp_name").alias("tier"), "margin").where("tier is not null")
    served = services.where(within("inv_date", w)).select(
        *by, plan_kind(F.col("rate_plan_grp")).alias("kind"), plan_tier("rate_plan_grp").alias("tier"), (F.col("total_service_revenue") + F.col("vas_fee")).alias("amt")
    )
    per_tier = served.where("kind is not null").groupBy(*by, "kind", "tier").agg(F.sum("amt").alias("amt")).join(tiers, "tier")
    plans = per_tier.groupBy(*by, "kind").agg(F.sum(F.col("amt") * F.col("margin")).cast(AMOUNT).alias("cost"))
    kinds = margin.select(F.lower("grp_name").alias("kind"), "margin").where(F.col("kind").isin(*goods_kinds))
    goods = revenue.join(kinds, "kind").select(*by, "kind", (F.col("revenue") * F.col("margin")).cast(AMOUNT).alias("cost"))
    return stack(plans, goods)


def cost_lines(t: Frames, w: Window) -> DataFrame:
    """Ledger costs per store and report line, every store having every line.

    The ledger is summed per centre and account before the accounts are matched to code ranges.
    """
    centres = pick(t["cost_centres"], "store_code", cost_center="cost_center_code").distinct()
    ledger = t["channel_cost"].where(F.col("period") == F.lit(w.start)).groupBy("cost_center", "account_cd").agg(F.sum("net_trx_amt").alias("amt"))
    ranges = t["cost_codes"].select("acct_code_start", "acct_code_end", F.upper("expenses_nature").alias("nature")).where("nature <> 'HEADCOUNT'")
    own = ledger.join(centres, "cost_center")
    hit = join_range(own, ranges, "account_cd", "acct_code_start", "acct_code_end").groupBy("store_code", "nature").agg(F.sum("amt").cast(AMOUNT).alias("amt"))
    cells = grid(centres.select("store_code").distinct(), ranges.select("nature").distinct())
    full = fill_grid(cells, hit, ["store_code", "nature"], {"amt": 0})
    line = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in COST_LINES.items() for x in kv]), "nature"), F.lit("-1"))
    marketing = own.where(F.col("account_cd").isin(MARKETING_ACCOUNTS)).groupBy("store_code").agg(F.sum("amt").cast(AMOUNT).alias("amt"))
    extra = centres.select("store_code").distinct().join(marketing, "store_code", "left")
    return stack(
        full.select(F.col("store_code").alias("store_cd"), line.alias("line"), F.col("amt").cast(AMOUNT).alias("amt")),
        extra.select(F.col("store_code").alias("store_cd"), F.lit("3.2").alias("line"), F.coalesce("amt", F.lit(0)).cast(AMOUNT).alias("amt")),
    )


def activation_costs(t: Frames, w: Window) -> DataFrame:
    """Line 8.1: cards of new mobile lines at the month's price, for every store of a cost centre."""
    sold = t["store_orders"].where((F.col("mobile_type") == "Mobile") & (F.col("connection_type") == "New Activation") & (F.trunc("report_date", "month") == F.lit(w.start)))
    price = t["sim_cost"].where(F.col("trx_mth") == F.lit(w.start)).select(F.lit(1).alias("one"), "sim_cost")
    counts = sold.groupBy("store_cd").agg(F.count(F.lit(1)).alias("cards")).withColumn("one", F.lit(1)).join(price, "one", "left")
    cost = counts.select("store_cd", (F.col("cards") * F.coalesce("sim_cost", F.lit(0))).alias("amt"))
    stores = pick(t["cost_centres"], store_cd="store_code").distinct()
    return stores.join(cost, "store_cd", "left").select("store_cd", F.lit("8.1").alias("line"), F.coalesce("amt", F.lit(0)).cast(AMOUNT).alias("amt"))


def depreciation_costs(t: Frames, w: Window) -> DataFrame:
    """Line 8.3: depreciation booked on headcount accounts, per store of the location."""
    booked = t["depreciation"].where(F.col("trx_mth") == F.lit(w.start)).groupBy("location_code", "account_cd").agg(F.sum("deprn_amt").alias("amt"))
    ranges = t["cost_codes"].where("expenses_nature = 'Headcount'").select("acct_code_start", "acct_code_end")
    hit = join_range(booked, ranges, "account_cd", "acct_code_start", "acct_code_end").groupBy("location_code").agg(F.sum("amt").alias("amt"))
    places = t["locations"].where(F.col("trx_mth") == F.lit(w.start)).select(F.col("location").alias("location_code"), "store_cd")
    return hit.join(places, "location_code").groupBy("store_cd").agg(F.sum("amt").cast(AMOUNT).alias("amt")).select("store_cd", F.lit("8.3").alias("line"), "amt")


def headcount(t: Frames, w: Window) -> DataFrame:
    """Heads per store; the cost centre is the second part of the account key."""
    heads = t["headcount"].where(F.col("trx_mth") == F.lit(w.start)).groupBy(nth_segment("acct_flexfield", ".", 2).alias("cost_center_code")).agg(F.sum("headcount").alias("heads"))
    out = t["cost_centres"].join(heads, "cost_center_code", "left").groupBy(F.col("store_code").alias("store_cd")).agg(F.sum("heads").alias("heads"))
    return out.withColumn("heads", F.coalesce("heads", F.lit(0)))


def shared_pool(t: Frames, w: Window) -> DataFrame:
    """Costs that belong to no store: general overhead, project marketing, and other marketing."""
    ledger = t["shared_ledger"].where(F.col("period") == F.lit(w.start))
    ranges = t["shared_codes"].where(F.col("trx_mth") == F.lit(w.start)).select("acct_code_start", "acct_code_end", F.upper("expenses_nature").alias("nature"))
    hit = join_range(ledger, ranges, "account_cd", "acct_code_start", "acct_code_end")
    outside = drop_in(hit, pick(t["cost_centres"], cost_center="cost_center_code"), "cost_center")
    general = hit.where("nature in ('ADMINISTRATION EXPENSES', 'MIS EXPENSES') and is_general = 'Y'")
    project = outside.where("nature = 'MARKETING EXPENSE' and is_project = 'Y'")
    other = outside.where("nature = 'MARKETING EXPENSE2'")
    return stack(*[p.agg(F.coalesce(F.sum("net_trx_amt"), F.lit(0)).cast(AMOUNT).alias("amt")) for p in (general, project, other)])


def by_store(t: Frames, services: DataFrame, products: DataFrame, w: Window) -> dict[str, DataFrame]:
    """Revenue, margin and cost lines per store, and what is left of them."""
    by = ["store_cd"]
    revenue = sales(t, services, products, w, by)
    others = keep_in(revenue.where("kind = 'others'"), pick(t["cost_centres"], store_cd="store_code"), "store_cd")
    margin = costs_of_sales(t, stack(revenue.where("kind <> 'others'"), others), services, w, by, ("handset", "accessory", "prepaid", "others"))
    shares = allocate(headcount(t, w), "heads", shared_pool(t, w), "amt").select("store_cd", F.lit("8.2").alias("line"), F.col("allocated").cast(AMOUNT).alias("amt"))
    lines = stack(
        revenue.groupBy(*by).agg(F.sum("revenue").cast(AMOUNT).alias("amt")).select("store_cd", F.lit("1").alias("line"), "amt"),
        margin.groupBy(*by).agg(F.sum("cost").cast(AMOUNT).alias("amt")).select("store_cd", F.lit("2").alias("line"), "amt"),
        cost_lines(t, w),
        activation_costs(t, w),
        shares,
        depreciation_costs(t, w),
    )
    net = signed_total(lines, by, "line", "amt", ["2"], MINUS)
    wide = revenue.groupBy(*by).pivot("kind", KINDS).agg(F.sum("revenue"))
    return {"lines": lines, "contribution": net, "revenue": wide}


def staff_costs(t: Frames, members: DataFrame, served: DataFrame, sold: DataFrame, w: Window) -> DataFrame:
    """Lines 3, 4 and 5 per store and staff member: commission, premium goods at channel rates, manpower."""
    by = ["store_cd", "staff_id"]
    paid = t["staff_commission"].where(F.col("trx_month") == F.lit(w.start)).groupBy(F.col("shop_cd").alias("store_cd"), F.col("staff_code").alias("staff_id")).agg(F.sum("commission_payable").alias("amt"))
    packages = t["staff_list"].where(F.col("trx_month") == F.lit(w.start)).join(pick(t["cost_centres"], dept_code="cost_center_code", store_cd="store_code"), "dept_code")
    packages = packages.select("store_cd", F.col("staff_no").alias("staff_id"), F.col("total_package").alias("amt")).distinct()

    own = t["stores"].where("daily_sales_sms = 'Y'").select("store_cd", F.lit(True).alias("own")).distinct()
    rates = t["channel_rate"].select(F.upper("channel").alias("chan"), "discount_rate")
    deals = stack(
        served.where(within("inv_date", w)).select(*by, F.col("user"), F.col("order_num").alias("inv_num"), F.upper("channel_effort").alias("chan")),
        sold.where(within("inv_date", w)).join(own, "store_cd", "left").select(*by, F.col("salesman").alias("user"), "inv_num", F.when(F.col("fa_inv_flg") == "Y", "STREET FIGHTER").otherwise(product_channel(F.coalesce("own", F.lit(False)))).alias("chan")),
    )
    deals = deals.join(rates, "chan", "left").select(*by, "user", "inv_num", "discount_rate").distinct()
    premium = t["premium_cost"].where(F.trunc("trx_month", "month") == F.lit(w.start)).select(F.col("product_code").alias("pos_prod_cd"), "unit_cost")
    goods = t["pos_inv_detail"].select("inv_num", "pos_prod_cd").join(premium, "pos_prod_cd").groupBy("inv_num").agg(F.sum("unit_cost").alias("unit_cost"))
    given = deals.join(goods, "inv_num").groupBy(*by).agg(F.sum(F.col("unit_cost") * F.col("discount_rate")).alias("amt"))
    return stack(*[
        members.join(part, by, "left").select(*by, F.lit(line).alias("line"), F.coalesce("amt", F.lit(0)).cast(AMOUNT).alias("amt"))
        for line, part in (("3", paid), ("4", given), ("5", packages))
    ])


def by_staff(t: Frames, services: DataFrame, products: DataFrame, names: DataFrame, w: Window) -> dict[str, DataFrame]:
    """Revenue, margin and cost lines per store and staff member, and what is left of them."""
    own = t["stores"].where("daily_sales_sms = 'Y'").select("store_cd", F.lit(True).alias("own")).distinct()
    ids = pick(names, "staff_id", user="usr_name").distinct()
    handled = F.col("create_by").startswith("FA") & ~F.col("usr_id").startswith("FA") & F.coalesce("own", F.lit(False))
    served = services.join(own, "store_cd", "left").withColumn("user", F.when(handled, F.col("usr_id")).otherwise(F.col("create_by"))).drop("own")
    served = served.join(ids, "user", "left").withColumn("staff_id", F.coalesce("staff_id", F.lit(" ")))
    sold = products.withColumnRenamed("salesman", "user").join(ids, "user", "left").withColumn("staff_id", F.coalesce("staff_id", F.lit(" "))).withColumnRenamed("user", "salesman")
    by = ["store_cd", "staff_id"]
    revenue = sales(t, served, sold, w, by)
    cost = costs_of_sales(t, revenue, served, w, by)
    sums = revenue.groupBy(*by).agg(F.sum("revenue").cast(AMOUNT).alias("amt"))
    lines = stack(
        sums.select(*by, F.lit("1").alias("line"), "amt"),
        cost.groupBy(*by).agg(F.sum("cost").cast(AMOUNT).alias("amt")).select(*by, F.lit("2").alias("line"), "amt"),
        staff_costs(t, sums.select(*by), served, sold, w),
    )
    return {"lines": lines, "contribution": signed_total(lines, by, "line", "amt", ["2"], MINUS)}
