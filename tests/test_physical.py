"""The plans that matter at scale: what is limited, pruned or pushed before a shuffle."""

import re

import pytest
from pyspark.sql import functions as F

from millrace.operators import best_open, join_asof, keep_first, nth_row, ranked, share, waterfall
from millrace.plans import channel, revenue
from millrace.reports import channel_jobs, warehouse
from millrace.reports.registry import callables
from millrace.sources.tables import Tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def orders(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/orders.parquet")


def test_row_choice_is_limited_before_the_shuffle(orders):
    for df in (nth_row(orders, "o_custkey", ["o_orderkey"], 2), ranked(orders, "o_custkey", ["o_orderdate"], 4)):
        text = plan(df)
        assert "WindowGroupLimit" in text and "Partial" in text
        assert text.index("Final") < text.index("Exchange") < text.rindex("Partial")


def test_keep_first_is_one_shuffle_with_partial_results(orders):
    text = plan(keep_first(orders, "o_custkey", "o_orderdate", ["o_totalprice", "o_orderstatus"]))
    assert text.count("Exchange") == 1 and "partial_max" in text


def test_whole_set_share_needs_no_single_partition_window(orders):
    text = plan(share(orders.select("o_orderkey", "o_totalprice"), "o_totalprice"))
    assert "Window" not in text and "Subquery" in text


def test_waterfall_is_a_semi_join_on_its_keys(orders):
    text = plan(waterfall([("a", orders.where("o_orderstatus = 'F'")), ("b", orders)], ["o_custkey"]))
    assert "LeftSemi" in text and "NestedLoop" not in text and "Cartesian" not in text


@pytest.mark.parametrize("name", ["usage_by_category", "asof_history", "tolerance_join", "interval_overlap", "price_range_join", "waterfall_sources", "self_join_same_day"])
def test_no_pairwise_join_and_no_python(spark, sf_dir, name):
    text = plan(callables()[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text and "Python" not in text


def test_copies_for_bins_and_cells_are_not_broadcast(spark):
    """The optimizer sees the few rows before the copies are made, so it would send the copies through the driver."""
    hist = spark.sql("select 1L as k, 'p' as plan, date'1995-01-01' as start_date, date'2999-12-31' as end_date")
    days = spark.sql("select 1L as k, date'1996-05-05' as at")
    assert "BroadcastHashJoin" not in plan(join_asof(days, hist, "k", "at"))
    assert "_cell" not in "".join(x for x in plan(best_open(days, hist, ["k"], "at", "start_date", "end_date", ["plan"], ["plan"])).splitlines() if "BroadcastHashJoin" in x)


def test_joins_at_two_offsets_share_a_shuffle(spark, orders):
    hist = orders.select("o_custkey", "o_orderpriority", F.to_date("o_orderdate").alias("start_date"), F.to_date("o_orderdate").alias("end_date"))
    left = orders.select("o_custkey", F.to_date("o_orderdate").alias("at"))
    at = join_asof(left, hist.withColumnRenamed("o_orderpriority", "now"), "o_custkey", "at").drop("start_date", "end_date")
    both = join_asof(at, hist.withColumnRenamed("o_orderpriority", "before"), "o_custkey", "at", offset_days=-1)
    assert plan(both).count("Exchange hashpartitioning") == 3


def test_scan_reads_needed_columns_only(spark, sf_dir):
    text = plan(callables()["usage_by_category"](spark, sf_dir))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in text


def test_filters_reach_the_scan(spark, sf_dir):
    spark.conf.set("spark.sql.maxMetadataStringLength", 4000)
    text = plan(callables()["predicates"](spark, sf_dir))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(p_size,5)" in text and "In(p_type" in text


def test_reports_do_not_use_row_udfs(orders):
    assert "BatchEvalPython" not in plan(orders.select(F.upper("o_orderstatus")))


def test_fee_rows_are_not_gathered_by_a_few_codes(spark, sf_dir, monkeypatch):
    """Market codes and add-ons are few: rows that lie by them are the work of a few tasks, however many rows there are."""
    seen = {}
    monkeypatch.setattr(revenue, "settle", lambda df, name: seen.setdefault(name, df))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    callables()["addon_fees"](spark, sf_dir)
    text = plan(seen["fee_lines"])
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not re.search(r"hashpartitioning\(vas_cd#\d+, fee_mkt#\d+, \d+\)", text)


def test_products_are_joined_by_invoice_three_times(spark, sf_dir):
    """Every join by invoice lies in one stage, and a task holds the sorted rows of all of them."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    text = plan(callables()["product_class_sales"](spark, sf_dir))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(re.findall(r"SortMergeJoin \[inv_num#\d+\]", text)) == 3


def test_customer_history_is_written_once(spark, sf_dir, monkeypatch):
    """The history takes five shuffles to make; all tables made of it, in all warehouses of a query, read one copy."""
    written = []
    monkeypatch.setattr(warehouse, "settle", lambda df, name: written.append(name) or df)
    t = Tables(spark, sf_dir)
    for name in ("subr_info_hist", "data_entitle_hist", "subr_info_hist"):
        warehouse.Warehouse(t)[name]
    assert len(written) == 1


def test_orders_of_lines_with_invoices_are_not_looked_up(spark, sf_dir, monkeypatch):
    """The waterfall gives such lines to their invoices; their orders stay out of the sorts and look-ups."""
    seen, write = {}, channel.settle
    monkeypatch.setattr(channel, "settle", lambda df, name: seen.setdefault(name, write(df, name)))
    callables()["channel_transactions"](spark, sf_dir)
    main = seen["channel_invoices"].where("ld_revenue in ('P', 'V') and order_num like 'I%'")
    assert main.count() and seen["channel_orders"].count()
    assert not seen["channel_orders"].join(main, ["cust_num", "subr_num"], "left_semi").count()


def test_transactions_move_by_line_once(spark, sf_dir, monkeypatch):
    """Calls, redemptions, contracts, new lines and renewals are joined by line alone, and typing moves no row by one more key than the order number."""
    seen, write = {}, channel_jobs.settle
    monkeypatch.setattr(channel_jobs, "settle", lambda df, name: seen.setdefault(name, (plan(df), write(df, name)))[1])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    text = plan(callables()["channel_attribution"](spark, sf_dir))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by = lambda text, *keys: len(re.findall(r"Exchange hashpartitioning\(" + ", ".join(rf"{k}#\d+" for k in keys) + r", \d", text))
    assert not by(text, "cust_num", "subr_num", "orig_ld_revenue")
    assert not by(seen["channel_typed"][0], "cust_num", "subr_num", "store_cd", "order_num")
