"""Report plans and storage on small invented rows."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from millrace.operators.sizing import estimated_bytes, hint_small, small_values
from millrace.params import OPEN_DATE, Window
from millrace.plans import billing, campaign, channel, contribution, records, revenue, usage
from millrace.sources import readers as R
from millrace.sources import writers as W
from millrace.storage import children, scratch_dir, settle
from millrace.streaming.ingest import ingest_incremental

D = date


def cells(df, *cols):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=str)


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


# --- records ------------------------------------------------------------------------------

def test_fixed_width_short_and_header_lines(spark):
    def line(kind, day):
        held = {"record_type": kind, "imsi": " 42 ", "call_start_date": day}
        return "".join(held.get(n, "").ljust(w)[:w] for n, w in R.FORWARD_WIDTHS)

    lines = spark.createDataFrame([(line("10", ""),), (line("20", "200229"),), (line("11", "200101"),), (line("90", ""),), ("20",), ("",)], "value string")
    good, bad = records.forward_records(lines)
    assert cells(good, "record_type", "imsi", "part_key") == [("11", "42", "20200101"), ("20", "42", "20200229")]
    assert bad.count() == 2
    legacy, _ = records.forward_records(lines, legacy=True)
    assert cells(legacy, "record_type") == [("20",)]


def test_firewall_rejects_and_both_feeds(spark):
    raw = ['"1"|10|20|2021-03-02 01:02:03|web|192.0.2.17|1.2.3.4', "2|1|2|bad|web|10.0.0.1|x", "3|1"]
    good, bad = records.firewall_keyed(spark.createDataFrame([(x,) for x in raw], "value string"))
    assert cells(good, "row_key", "send_volume") == [("192.000.002.017_20210302010203_1.2.3.4", "10")]
    assert bad.count() == 2
    wide = records.firewall_columns(good).first()
    assert (wide.trx_date, wide.pkey, wide.srcip_num, wide.srv) == ("20210302", 2, 192000002017, "web")
    old = spark.createDataFrame([("k", "2021-03-02 01:02:03", "192.0.2.17", "1.2.3.4", "5-6-dns")], R._strings(R.FIREWALL_LOADER))
    assert cells(records.firewall_columns(old), "send_vol", "recv_vol", "srv", "pkey") == [("5", "6", "dns", 2)]


def test_address_lookup_prunes_and_pushes(spark, folder):
    rows = spark.createDataFrame([("20200101", str(p), 10000000000 + p * 1000 + h) for p in range(4) for h in range(5)], "trx_date string, pkey string, srcip_num bigint")
    W.write_partitioned(rows, folder + "/t", ["trx_date", "pkey"], sort=["srcip_num"])
    found = records.lookup_ip(R.read_partitioned(spark, folder + "/t"), "10.0.2.3")
    assert found.count() == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(srcip_num,10000002003)" in plan and "pkey" in plan.split("PartitionFilters")[1].split("]")[0]


def test_trace_names(spark, folder):
    os.makedirs(folder + "/in")
    for name in ("A20200101_x_e1.csv", "A20200102_x_e2.csv"):
        with open(f"{folder}/in/{name}", "w") as f:
            f.write("a,b\n1,2\n")
    out = records.trace_records(spark, folder + "/in")
    assert cells(out, "a", "trx_date", "event_id") == [("1", "20200101", "e1"), ("1", "20200102", "e2")]


# --- storage ------------------------------------------------------------------------------

def test_refresh_is_idempotent_and_empties_a_month(spark, folder):
    rows = spark.createDataFrame([(1, "01"), (2, "02"), (3, "03")], "v int, m string")
    rows.write.partitionBy("m").parquet(folder + "/t")
    for _ in range(2):
        W.refresh_window(spark, rows.where("m = '02'").withColumn("v", F.lit(9)), folder + "/t", "m", ["02", "03"])
        assert cells(R.read_partitioned(spark, folder + "/t"), "v", "m") == [(1, "01"), (9, "02")]


def test_files_roll_and_stage_reloads(spark, folder):
    W.write_partitioned(spark.range(100).withColumn("p", F.lit(1)), folder + "/t", ["p"], max_rows_per_file=30)
    assert len([n for n in children(spark, folder + "/t/p=1") if n.startswith("part")]) == 4
    W.stage(spark.range(5), folder + "/s")
    assert W.stage(spark.range(3), folder + "/s").count() == 3
    assert settle(spark.range(7), "x").count() == 7
    assert scratch_dir(spark, "a") != scratch_dir(spark, "a")


def test_each_file_is_ingested_once(spark, folder):
    src, sink, state = folder + "/in", folder + "/out", folder + "/state"
    for turn in range(3):
        if turn < 2:
            spark.range(turn * 10, turn * 10 + 10).repartition(3).write.mode("append").csv(src)
        ingest_incremental(spark, src, sink, "id bigint", state, max_files=1)
    assert cells(spark.read.parquet(sink)) == sorted([(i,) for i in range(20)], key=str)


def test_partition_types_setting_is_restored(spark, folder):
    spark.range(2).withColumn("p", F.lit("007")).write.partitionBy("p").parquet(folder + "/t")
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(key)
    assert R.read_partitioned(spark, folder + "/t").first().p == "007"
    assert spark.conf.get(key) == before


def test_wide_columns_default_to_zero(spark):
    df = spark.createDataFrame([("k", {"src": "a", "json_value": '{"send_volume":"12.5"}'}), ("l", {})], "row_key string, cf map<string,string>")
    got = cells(R.wide_column_view([df, df]).distinct(), "row_key", "src", F.col("send_volume").cast("double"), F.col("receive_volume").cast("double"))
    assert got == [("k", "a", 12.5, 0.0), ("l", None, 0.0, 0.0)]


def test_size_checks(spark, folder):
    spark.range(1000).write.parquet(folder + "/t")
    df = spark.read.parquet(folder + "/t")
    assert estimated_bytes(df) > 0
    assert "ResolvedHint" in hint_small(df)._jdf.queryExecution().analyzed().toString()
    assert hint_small(df, max_bytes=10) is df
    assert small_values(df, ["id"], 5) is None
    assert small_values(df.limit(3).selectExpr("id % 2 as k"), ["k"], 5) == [(0,), (1,)]


# --- plans --------------------------------------------------------------------------------

def test_usage_and_text_times(spark):
    log = spark.createDataFrame([("s", "d", "x", 2000000000, 2000000000), ("s", "d", "y", 1, 1), ("s", "d", None, 5, 5)], "subr_num string, accs_date string, domain string, uload_size int, dnld_size int")
    ref = spark.createDataFrame([("x", "web", 1), ("y", "web", 1)], R.DOMAIN_REF.rsplit(",", 1)[0])
    assert cells(usage.by_category(log, ref), "media_category_name", "sum_vol", "cnt") == [("web", 4000000002, 2), (None, 10, 1)]
    seen = spark.createDataFrame([("i", "9.5", "a"), ("i", "10.25", "a"), ("i", "100", "b")], "imsi string, time string, eci string")
    assert cells(usage.cell_dwell(seen), "eci", "dwell_time") == [("a", 0.75), ("b", 0.0)]
    assert cells(usage.cell_movement(seen), "eci", "eciout") == [("a", "b"), ("b", "")]


def test_transaction_type_and_replacement(spark):
    rows = [("Invoice", "NA", D(2020, 9, 1)), ("Invoice", "LDC12X", D(2020, 4, 30)), ("Invoice", "LDC12X", D(2020, 5, 1)), ("Chg plan only", "NA", D(2020, 1, 1)), ("Invoice", "LDC12X", OPEN_DATE)]
    df = spark.createDataFrame(rows, "ref string, code string, e date").withColumn("d", F.lit(D(2020, 1, 15)))
    got = [r[0] for r in df.select(channel.transaction_type(F.col("ref"), F.col("code"), F.col("e"), F.col("d"))).collect()]
    assert got == ["RETENTION", "RETENTION", "UPGRADE", "UPGRADE", "RETENTION"]
    dates = [F.lit(D(2020, 1, 1)), F.lit(D(2020, 12, 31)), F.lit(D(2020, 12, 1)), F.lit(D(2021, 12, 1))]
    assert spark.range(1).select(channel.replaces(*dates), channel.replaces(*dates[:2], F.lit(D(2021, 1, 1)), dates[3]), channel.replaces(*dates[:2], F.lit(OPEN_DATE), dates[3])).first()[:] == ("Y", "N", "N")


def test_months_left_and_fee_period(spark):
    day, end = F.lit(D(2020, 1, 31)), F.lit(D(2020, 3, 1))
    got = spark.range(1).select(
        revenue.months_left(end, F.lit("LDC12X"), day), revenue.months_left(end, F.lit("NA"), day), revenue.months_left(day, F.lit("LDC12X"), end),
        revenue.fee_period(F.lit(D(2020, 1, 10)), F.lit(D(2020, 12, 31)), F.lit("NA")), revenue.fee_period(F.lit(None).cast("date"), end, F.lit("LDC24X")), revenue.fee_period(F.lit(OPEN_DATE), end, F.lit(" ")),
    ).first()[:]
    assert got == (2, 0, 0, 12, 24, 1)


def test_product_classes_do_not_mix(spark):
    lines = spark.createDataFrame([("AH", "P1", "HS"), ("AA", "CRPP", "ACC"), ("AA", "P2", "ACC"), ("AP", "P3", "SIM"), ("AP", "P3", "PC3"), ("ZZ", "P4", None), ("AH", "CRRT", "HS")], "warehouse string, pos_prod_cd string, item_cat string")
    got = [[c.name for c, hit in zip(revenue.CLASSES, r) if hit] for r in lines.select(*[c.test() for c in revenue.CLASSES]).collect()]
    assert got == [["HANDSET"], ["HANDSET"], ["ACCESSORY"], ["SIM"], ["VOUCHER"], [], []]


def test_campaign_labels_cover_every_case(spark):
    rows = [("accept offer", "Outbound", " ", 5, 5), ("Busy", "Store", "R", 9, 5), ("Consider", " ", "R", 5, 5), (" ", "Store", " ", 1, 5)]
    df = spark.createDataFrame(rows, "pr_final_status string, af_channel_effort string, ru_rule_id string, bf_avg_net_rev int, af_net_price int")
    got = [(r.cl_sale_type, r.cl_reach, r.cl_hit, r.cl_except) for r in campaign.labels(df).collect()]
    assert got == [(" ", "REACH", "HIT:OUTBOUND", "EXCEPT_RULE_UNMAP"), ("DOWN_SELL", "NON_REACH", "HIT:STORE", " "), ("FLAT_SELL", "REACH", "HIT: ", " "), (" ", "NON_REACH", " ", "EXCEPT_RULE_UNMAP")]


def test_kpi_matrix_with_nothing_hit(spark):
    cols = "shk_tier string, shk_sale_tag string, cl_reach string, cl_hit string, cl_sale_type string, bf_avg_net_rev int, af_net_price int, bf_plan_tariff int, af_plan_tariff int"
    h = spark.createDataFrame([("T1", " ", "NON_REACH", " ", " ", 1, 2, 3, 4)], cols)
    out = {r.row_num: (r.T1, r.Total) for r in campaign.kpi_matrix(h, ["T1"]).collect()}
    assert len(out) == 35 and out[4] == ("-50.00%", "-50.00%") and out[16] == ("0.00%", "0.00%") and out[3] == ("50%", "50%")


def test_bill_offsets_span_sibling_bills(spark):
    t = {
        "bill": spark.createDataFrame([(1, "c", D(2020, 1, 1)), (2, "c", D(2020, 1, 1)), (3, "c", D(2020, 2, 1))], "bill_reference int, customer_reference string, actual_bill_date date"),
        "bill_trans": spark.createDataFrame([(1, "AAAAA", 5), (2, "AAAAA", -5), (1, "AAAAA", 7), (3, "AAAAA", -7), (1, "BBBBB", 9), (2, "BBBBB", -9)], "bill_reference int, payment_method_name string, transaction_amount int"),
        "payment_method": spark.createDataFrame([("AAAAA-ADJ",), ("BBBBB-PAY",)], "payment_method_name string"),
    }
    main = t["bill"].where("bill_reference = 1")
    assert cells(billing.offsets(t, main)) == [(1, 5)]
    assert cells(billing.standing(t, main)) == [(1, 7)]


def test_costs_fill_every_store_line(spark):
    t = {
        "cost_centres": spark.createDataFrame([("C1", "S1"), ("C2", "S2")], "cost_center_code string, store_code string"),
        "channel_cost": spark.createDataFrame([("C1", "A05", D(2020, 1, 1), 10.0), ("C1", contribution.MARKETING_ACCOUNTS[0], D(2020, 1, 1), 4.0), ("C1", "A05", D(2019, 1, 1), 99.0), ("C9", "A05", D(2020, 1, 1), 7.0)], "cost_center string, account_cd string, period date, net_trx_amt double"),
        "cost_codes": spark.createDataFrame([("A00", "A09", "Commission"), ("A10", "A19", "Manpower costs"), ("A00", "A99", "Headcount")], "acct_code_start string, acct_code_end string, expenses_nature string"),
    }
    got = {(r[0], r[1]): float(r[2]) for r in contribution.cost_lines(t, Window(D(2020, 1, 1), D(2020, 1, 31))).collect()}
    assert got == {("S1", "3"): 10, ("S1", "5"): 0, ("S2", "3"): 0, ("S2", "5"): 0, ("S1", "3.2"): 4, ("S2", "3.2"): 0}


def test_addon_lists_take_one_shuffle_by_transaction(spark, sf_dir):
    """The three lists come from one aggregate; no shuffle is by transaction and kind of list."""
    from millrace.reports.channel_jobs import channel_addons
    from millrace.sources.tables import Tables

    text = channel_addons(Tables(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in text.splitlines() if "Exchange hashpartitioning" in x and "kind#" in x.split("hashpartitioning", 1)[1].split(")")[0]]


def test_a_blank_order_number_has_no_lists(spark):
    """A null matches nothing, as in a join; equal order numbers of one line share their lists, store by store."""
    t = {
        "entitle_ref": spark.createDataFrame([("V1", "PACK"), ("V2", "PACK")], "bill_serv_cd string, free_data_entitle string"),
        "rate_plan_ref": spark.createDataFrame([("RP1", "Y")], "rate_plan_cd string, high_tier string"),
        "om_pending": spark.createDataFrame([("C", "S", D(2020, 1, 2), "V2,V9,", " "), ("C", "S", D(2020, 1, 2), "V2", "V1")], "cust_num string, subr_num string, create_date date, add_vas string, end_vas string"),
        "bill_servs": spark.createDataFrame([("C", "S", OPEN_DATE, "V1"), ("C", "S", D(2020, 1, 2), "V2"), ("C", "S", OPEN_DATE, "V9")], "cust_num string, subr_num string, bill_end_date date, bill_serv_cd string"),
    }
    t |= {"om_complete": t["om_pending"].limit(0), "bill_servs_pend": t["bill_servs"].limit(1)}
    rows = [("C", "S", "A", "I1", D(2020, 1, 1), "RP1"), ("C", "S", "A", "I1", D(2020, 1, 2), "RP2"), ("C", "S", "B", "I1", D(2020, 1, 9), "RP1"), ("C", "S", "A", None, D(2020, 1, 1), "RP1"), ("X", "S", "A", "I1", D(2020, 1, 1), "RP1")]
    rows = spark.createDataFrame(rows, "cust_num string, subr_num string, store_cd string, order_num string, inv_date date, rate_plan_cd string")
    lists = channel.addon_lists(t, rows, Window(D(2020, 1, 1), D(2020, 1, 31)))
    assert cells(lists) == sorted(
        [
            ("C", "S", "A", "I1", "V2", "V1", "V1,V2", "Y"), ("C", "S", "A", "I1", "V2", "V1", "V1,V2", "N"), ("C", "S", "B", "I1", " ", " ", "V1", "Y"),
            ("C", "S", "A", None, " ", " ", " ", "N"), ("X", "S", "A", "I1", " ", " ", " ", "N"),
        ], key=str,
    )
    full = channel.with_lists(rows.where("order_num = 'I1' and inv_date <> '2020-01-02'"), lists.where("bolt_on_flg = 'Y'"))
    assert cells(full, "cust_num", "store_cd", "add_vas_list", "active_vas_list") == [("C", "A", "V2", "V1,V2"), ("C", "B", " ", "V1"), ("X", "A", None, None)]
