"""Edge cases of the operators on small rows."""

from datetime import date, datetime, timedelta
from decimal import Decimal
from itertools import groupby

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import (
    add_months_sticky, blank, clean_int, clean_number, contract_value, decode, greatest_strict, ip_from_key, ip_key, ip_long,
    is_date_text, month_gap, no_date, nth_token, override, pct_text, pick_latest, ratio, repair_end, repair_start, row_key, strip_money,
    tier_string, token_count, year2_date,
)
from millrace.operators import (
    allocate, apply_rules, drop_in, drop_like, drop_repeats, drop_where, dwell, grid, join_asof, join_eq, join_list_member,
    join_overlap, join_range, join_within, keep_first, list_agg, match_fallback, movement, next_row, nth_row, offset_pairs,
    pick_rank, pivot_report, previous_row, ranked, reconcile, share, snapshot, split_rows, waterfall, with_subtotals,
)
from millrace.params import NO_DATE, OPEN_DATE, CommissionWindow, Window, shift_months


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols or df.columns).collect()), key=str)


def one(spark, *exprs):
    return tuple(spark.range(1).select(*exprs).first())


D = date


# --- functions ----------------------------------------------------------------------------

def test_blank_and_sentinels(spark):
    df = spark.createDataFrame([(" ", NO_DATE), (None, OPEN_DATE), ("x", D(2020, 1, 1)), ("", None)], "c string, d date")
    assert [tuple(r) for r in df.select(blank("c"), no_date("d")).collect()] == [(True, True), (True, True), (False, False), (True, True)]


def test_decode_matches_null(spark):
    df = spark.createDataFrame([(None,), ("a",), ("b",)], "c string")
    out = df.select(decode("c", (None, "none"), ("a", "first"), default="rest"))
    assert [r[0] for r in out.collect()] == ["none", "first", "rest"]


def test_numbers_from_text(spark):
    got = one(
        spark, clean_number(F.lit("12.5")), clean_number(F.lit("1.2.3")), clean_number(F.lit("n/a")), clean_number(F.lit(None).cast("string")),
        clean_int(F.lit("007")), clean_int(F.lit("-7")), strip_money(F.lit("$1,234")), strip_money(F.lit(" ")),
    )
    assert got == (Decimal("12.50"), 0, 0, 0, 7, 0, "1234", "0")


def test_tier_and_percent_text(spark):
    got = one(spark, tier_string(("0-12", F.lit("$1,000")), ("13-24", F.lit(" "))), pct_text(F.lit(0.125)), pct_text(F.lit(-0.005)), ratio(F.lit(1), F.lit(0)))
    assert got == ("0-12:1000|13-24:0", "12.50%", "-0.50%", 0)


def test_month_end_stays_month_end(spark):
    feb = F.to_date(F.lit("2020-02-29"))
    jan = F.to_date(F.lit("2020-01-31"))
    assert one(spark, add_months_sticky(feb, 1), add_months_sticky(jan, 1), month_gap(jan, feb)) == (D(2020, 3, 31), D(2020, 2, 29), -1)
    assert shift_months(D(2020, 2, 29), 1) == D(2020, 3, 31)


def test_contract_dates_repaired_both_ways(spark):
    df = spark.createDataFrame(
        [(NO_DATE, D(2021, 12, 31), "LDC12X"), (D(2021, 1, 1), OPEN_DATE, "LDC12X"), (None, None, "LDC12X"), (NO_DATE, D(2021, 12, 31), "NA")],
        "s date, e date, c string",
    )
    got = [tuple(r) for r in df.select(repair_start("s", "e", "c"), repair_end("s", "e", "c")).collect()]
    assert got == [(D(2021, 1, 1), D(2021, 12, 31)), (D(2021, 1, 1), D(2021, 12, 31)), (None, None), (NO_DATE, D(2021, 12, 31))]


def test_addresses_and_keys(spark):
    ip = F.lit("10.1.20.3")
    got = one(spark, ip_key(ip), ip_long(ip), ip_from_key(F.lit("010001020003")), row_key(ip, F.lit("2021-03-02 01:02:03"), F.lit("1.1.1.1")))
    assert got == ("010.001.020.003", 10001020003, "10.1.20.3", "010.001.020.003_20210302010203_1.1.1.1")


def test_tokens_and_date_text(spark):
    got = one(
        spark, nth_token(F.lit(",a,,b"), 2), nth_token(F.lit("a"), 2), token_count(F.lit("a,b,c")), token_count(F.lit(" ")),
        is_date_text(F.lit("2020-02-31")), is_date_text(F.lit("1999-01-01")), is_date_text(F.lit(None).cast("string")), year2_date(F.lit("200229")), year2_date(F.lit("2002")),
    )
    assert got == ("b", None, 3, 0, True, False, False, D(2020, 2, 29), None)


def test_newer_source_and_override(spark):
    got = one(
        spark, pick_latest(F.lit("a"), F.lit("b"), [F.lit(1), F.lit(5)], [F.lit(1), F.lit(4)]), pick_latest(F.lit(" "), F.lit("b"), [F.lit(9)], [F.lit(1)]),
        override(F.lit(" "), F.lit("c")), greatest_strict(F.lit(1), F.lit(None).cast("int")),
    )
    assert got == ("a", "b", "c", None)


def test_contract_value_with_and_without_old(spark):
    base = {"bill_rate": F.lit(100), "rebate": F.lit(-10), "rebate_flag": F.lit("INV_REBATE"), "subsidy": F.lit(120), "old_bill_rate": F.lit(50), "old_rebate": F.lit(-24), "old_rebate_flag": F.lit("MKT_REBATE"), "old_subsidy": F.lit(0)}
    start, end = F.to_date(F.lit("2021-01-01")), F.to_date(F.lit("2021-12-31"))
    old = {"old_start": F.to_date(F.lit("2020-07-01")), "old_end": F.to_date(F.lit("2021-06-30"))}
    with_old = contract_value(start=start, end=end, **old, old_invoice=F.lit("I1"), **base)
    without = contract_value(start=start, end=end, **old, old_invoice=F.lit(" "), **base)
    m, om, chg, left, tcv = one(spark, *with_old.values())
    assert (m, om, chg, left) == (Decimal("12.0"), Decimal("12.0"), "Y", Decimal("6.0"))
    assert tcv == Decimal("672.00")
    assert one(spark, *without.values())[4] == Decimal("960.00")


# --- joins --------------------------------------------------------------------------------

HIST = [("a", "p1", D(2020, 1, 1), D(2020, 1, 31)), ("a", "p2", D(2020, 2, 1), OPEN_DATE), ("b", "p9", D(1980, 1, 1), D(1985, 1, 1))]


@pytest.mark.parametrize("unit", ["YEAR", "MM", None])
def test_asof_includes_both_ends(spark, unit):
    hist = spark.createDataFrame(HIST, "k string, plan string, start_date date, end_date date")
    left = spark.createDataFrame(
        [("a", D(2019, 12, 31)), ("a", D(2020, 1, 31)), ("a", D(2020, 2, 1)), ("a", D(2999, 12, 31)), ("b", D(1982, 5, 5)), ("c", D(2020, 1, 1)), ("a", None)], "k string, at date"
    )
    got = rows(join_asof(left, hist, "k", "at", unit=unit), "k", "at", "plan")
    assert got == sorted(
        [("a", D(2019, 12, 31), None), ("a", D(2020, 1, 31), "p1"), ("a", D(2020, 2, 1), "p2"), ("a", D(2999, 12, 31), "p2"), ("b", D(1982, 5, 5), "p9"), ("c", D(2020, 1, 1), None), ("a", None, None)],
        key=str,
    )
    before = rows(join_asof(left.where("at = date'2020-02-01'"), hist, "k", "at", offset_days=-1, unit=unit), "plan")
    assert before == [("p1",)]


def test_asof_overlapping_and_starts_only(spark):
    hist = spark.createDataFrame([("a", 1, D(2020, 1, 1), D(2020, 12, 31)), ("a", 2, D(2020, 6, 1), D(2021, 5, 31))], "k string, n int, start_date date, end_date date")
    left = spark.createDataFrame([("a", D(2020, 7, 1)), ("a", D(2020, 6, 1))], "k string, at date")
    assert rows(join_asof(left, hist, "k", "at"), "at", "n") == [(D(2020, 6, 1), 1), (D(2020, 6, 1), 2), (D(2020, 7, 1), 1), (D(2020, 7, 1), 2)]
    assert rows(join_asof(left, hist, "k", "at", starts_only=True), "at", "n") == [(D(2020, 6, 1), 2), (D(2020, 7, 1), None)]
    assert snapshot(hist, D(2021, 1, 1)).count() == 1


def test_overlap_pairs_come_once(spark):
    a = spark.createDataFrame([("k", D(2020, 1, 15), D(2020, 4, 15)), ("k", D(2020, 6, 1), D(2020, 6, 1))], "k string, s1 date, e1 date")
    b = spark.createDataFrame([("k", D(2020, 3, 1), D(2020, 6, 1)), ("k", D(2019, 1, 1), D(2020, 1, 14))], "k string, s2 date, e2 date")
    assert rows(join_overlap(a, b, "k", "s1", "e1", "s2", "e2"), "s1", "s2") == [(D(2020, 1, 15), D(2020, 3, 1)), (D(2020, 6, 1), D(2020, 3, 1))]


def test_range_join_by_bins_and_by_codes(spark):
    ranges = spark.createDataFrame([(0.0, 9.5, "a"), (9.5, 30.0, "b")], "lo double, hi double, n string")
    left = spark.createDataFrame([(9.5,), (0.0,), (31.0,)], "v double")
    want = sorted([(9.5, "a"), (9.5, "b"), (0.0, "a"), (31.0, None)], key=str)
    assert rows(join_range(left, ranges, "v", "lo", "hi", width=4, how="left"), "v", "n") == want
    assert rows(join_range(left, ranges, "v", "lo", "hi", how="left"), "v", "n") == want


def test_within_counts_each_side_once(spark):
    left = spark.createDataFrame([(1, "k", D(2020, 1, 10), "A"), (2, "k", D(2020, 1, 10), " "), (3, "k", D(2020, 3, 1), "A")], "id int, k string, d date, rid string")
    right = spark.createDataFrame(
        [("k", D(2020, 1, 9), "A", 5), ("k", D(2020, 1, 11), " ", 7), ("k", D(2020, 1, 12), "A", 9), ("k", D(2020, 1, 10), "B", 11), ("k", D(2020, 1, 10), None, 1)], "k string, d2 date, own string, v int"
    )
    got = join_within(left, right, "k", "d", "d2", 1, {"n": ("count", "v"), "s": ("sum", "v"), "lo": ("min", "v"), "hi": ("max", "v")}, residual=("rid", "own"))
    assert rows(got, "id", "n", "s", "lo", "hi") == [(1, 3, 13, 1, 7), (2, 2, 8, 1, 7)]


def test_salted_join_equals_plain(spark):
    left = spark.range(200).select((F.col("id") % 2).alias("k"), "id")
    right = spark.createDataFrame([(0, "x"), (1, "y"), (1, "z")], "k bigint, v string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        assert rows(join_eq(left, right, "k", how)) == rows(join_eq(left, right, "k", how, salt=5))


def test_like_patterns(spark):
    df = spark.createDataFrame([("PAY-1",), ("PAX",), (None,), ("FEE",)], "c string")
    pats = spark.createDataFrame([("PAY%",), ("F_E",)], "pattern string")
    want = rows(drop_like(df, "c", pats))
    assert want == [("PAX",), (None,)]


def test_like_patterns_none_left(spark):
    df = spark.createDataFrame([("a",), (None,)], "c string")
    assert rows(drop_like(df, "c", spark.createDataFrame([(None,)], "pattern string"))) == [("a",), (None,)]


def test_grid(spark):
    a, b = spark.createDataFrame([(1,), (2,)], "a int"), spark.createDataFrame([("x",), ("y",), ("x",)], "b string")
    want = rows(grid(a, b))
    assert want == [(1, "x"), (1, "y"), (2, "x"), (2, "y")]
    none = grid(a, b.limit(0))
    assert none.columns == ["a", "b"] and none.count() == 0
    assert grid(a, spark.range(1500)).count() == 3000


def test_list_member_ignores_spaces_and_repeats(spark):
    df = spark.createDataFrame([(1, "a, b,a"), (2, " "), (3, None)], "id int, l string")
    other = spark.createDataFrame([("a",), ("c",)], "k string")
    assert rows(join_list_member(df, "l", other, "k"), "id", "k") == [(1, "a")]


def test_waterfall_keys_are_disjoint(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (None, "n")], "k int, v string")
    b = spark.createDataFrame([(1, "z"), (2, "w"), (None, "m")], "k int, v string")
    assert rows(waterfall([("A", a), ("B", b)], ["k"])) == sorted([(1, "x", "A"), (1, "y", "A"), (None, "n", "A"), (2, "w", "B")], key=str)


def test_fallback_default(spark):
    base = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    m1, m2 = spark.createDataFrame([(1, "exact")], "k int, v string"), spark.createDataFrame([(1, "late"), (2, "late")], "k int, v string")
    assert rows(match_fallback(base, "k", [("E", m1), ("L", m2)], {"v": "-"}), "k", "match", "v") == [(1, "E", "exact"), (2, "L", "late"), (3, "NONE", "-")]


def test_anti_join_keeps_null_key(spark):
    df = spark.createDataFrame([(1,), (None,)], "k int")
    assert rows(drop_in(df, spark.createDataFrame([(1,)], "k int"), "k")) == [(None,)]


# --- rules, aggregates --------------------------------------------------------------------

def test_rules_see_earlier_rules_and_nulls_stay(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "id int, v int")
    out = apply_rules(df, [("v is null", {"v": F.lit(0)}), ("v = 0", {"v": F.lit(9)})])
    assert rows(out) == [(1, 9), (2, 5)]
    assert rows(drop_where(df, "v > 3"), "id") == [(1,)]


@pytest.mark.parametrize("kind", ["int", "date", "string", "decimal(10,2)", "double"])
def test_keep_first_null_order_and_ties(spark, kind):
    raw = [("g", "3", 1, "b"), ("g", "3", 7, "a"), ("g", "1", 5, "c"), ("g", None, 9, "d"), ("h", None, 2, "z")]
    df = spark.createDataFrame(raw, "g string, o string, x int, y string")
    typed = F.date_add(F.lit(D(2020, 1, 1)), F.col("o").cast("int")) if kind == "date" else F.col("o").cast(kind)
    df = df.withColumn("o", typed)
    assert rows(keep_first(df, "g", "o", ["x", "y"])) == [("g", 5, "c"), ("h", 2, "z")]
    assert rows(keep_first(df, "g", "o", ["x", "y"], desc=True)) == [("g", 9, "d"), ("h", 2, "z")]
    assert rows(keep_first(df.where("o is not null"), "g", "o", ["x", "y"], desc=True)) == [("g", 7, "b")]


def test_lists_skip_nulls_and_keep_repeats(spark):
    df = spark.createDataFrame([("g", 2, "b"), ("g", 1, "a"), ("g", 1, "a"), ("g", 3, None)], "g string, o int, v string")
    assert rows(list_agg(df, "g", "v", ["o"])) == [("g", "a,a,b")]
    assert rows(list_agg(df, "g", "v", distinct=True)) == [("g", "a,b")]


def test_offset_pairs_need_exactly_two(spark):
    df = spark.createDataFrame([("a", 5), ("a", -5), ("a", 3), ("a", 3), ("b", 2), ("b", -2), ("b", 2)], "k string, v int")
    assert rows(offset_pairs(df, "k", "v")) == [("a", 5)]


def test_subtotals(spark):
    df = spark.createDataFrame([("s1", "x", 10), ("s1", "y", 5), ("s1", "x", 1), ("s2", "z", 4)], "st string, m string, v int")
    got = {(r[0], r[1]): float(r[2]) for r in with_subtotals(df, "st", "m", ["v"]).collect()}
    assert got == {("s1", "x"): 11, ("s1", "y"): 5, ("s2", "z"): 4, ("s1", "s1 Total"): 16, ("s1", "s1 Average"): 8, ("s2", "s2 Total"): 4, ("s2", "s2 Average"): 4, ("All", "All Total"): 20, ("All", "All Average"): 10}


def test_pivot_of_many_columns(spark):
    df = spark.range(250).select(F.lit("r").alias("r"), F.format_string("%03d", "id").alias("c"), F.lit("v").alias("v"))
    assert pivot_report(df, ["r"], "c", "v").columns == ["r", *(f"{i:03d}" for i in range(250))]


def test_separators_are_taken_literally(spark):
    for sep in ("^", "]", "\\", "||", "-", "\\E"):
        assert one(spark, nth_token(F.lit(f"a{sep}b"), 2, sep), token_count(F.lit(f"a{sep}b{sep}c"), sep)) == ("b", 3)


def test_rank_four_else_three(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("a", 4), ("b", 1), ("b", 2), ("b", 2), ("b", 4), ("c", 1), ("c", 2), ("c", 3)], "k string, v int")
    r = ranked(df, "k", ["v"], 4)
    assert rows(pick_rank(r, "k", "rnk", [4, 3], ["v"])) == [("a", 4), ("b", 4), ("c", 3)]
    assert rows(r.where("k = 'b'"), "v", "rnk") == [(1, 1), (2, 2), (2, 2), (4, 4)]


def test_shares_sum_to_one_and_zero_total(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("z", 0.0)], "k string, v double")
    assert rows(share(df, "v", "k"), "v", "share") == [(0.0, None), (1.0, 0.25), (3.0, 0.75)]
    assert sum(r[0] for r in share(df, "v").select("share").collect()) == 1.0
    split = allocate(df, "v", spark.createDataFrame([(8.0,), (4.0,)], "p double"), "p")
    assert sorted(float(r[0]) for r in split.select("allocated").collect()) == [0, 3, 9]


def test_reconcile(spark):
    a = spark.range(3)
    assert rows(reconcile({"x": a, "y": a}, spark.range(6))) == [(6, 6, "Y")]
    assert rows(reconcile({"x": a}, spark.range(6))) == [(3, 6, "N")]


def test_split_rows_of_empty_list(spark):
    df = spark.createDataFrame([(1, "a,,b"), (2, ""), (3, None)], "id int, l string")
    assert rows(split_rows(df, "l"), "id", "item") == sorted([(1, "a"), (1, "b"), (2, None), (3, None)], key=str)


def test_nth_row_null_order(spark):
    df = spark.createDataFrame([("a", None), ("a", 2), ("a", 1)], "k string, v int")
    order = [F.col("v").desc_nulls_last()]
    assert [rows(nth_row(df, "k", order, n), "v") for n in (1, 2, 3, 4)] == [[(2,)], [(1,)], [(None,)], []]


# --- row to row: against plain Python -----------------------------------------------------

EVENTS = st.lists(st.tuples(st.sampled_from("uv"), st.integers(0, 96), st.sampled_from("abc")), min_size=1, max_size=40)
FEW = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _frame(spark, events):
    start = datetime(2024, 1, 1)
    return spark.createDataFrame([(u, start + timedelta(hours=h), s) for u, h, s in events], "u string, ts timestamp_ntz, s string")


def _runs(events):
    out = []
    for user, items in groupby(sorted(set(events)), key=lambda e: e[0]):
        runs = [list(g) for _, g in groupby(sorted((h, s) for _, h, s in items), key=lambda x: x[1])]
        for i, run in enumerate(runs):
            nxt = runs[i + 1][0] if i + 1 < len(runs) else (None, None)
            out.append((user, run[0][0], run[0][1], run[-1][0], nxt[0], nxt[1]))
    return out


@FEW
@given(EVENTS)
def test_runs_match_plain_python(spark, events):
    df, start = _frame(spark, events), datetime(2024, 1, 1)

    def hour(t):
        return None if t is None else int((t - start).total_seconds() // 3600)

    for bin_ in (None, F.date_trunc("hour", "_ts"), F.lit(1)):
        d = [(r.u, hour(r.ts), r.s, hour(r.timeout), r.dwell_time) for r in dwell(df, "u", "ts", "s", bin_).collect()]
        assert sorted(d) == sorted((u, a, s, b, (b - a) * 3600.0) for u, a, s, b, _, _ in _runs(events))
        m = [(r.u, hour(r.ts), r.s, hour(r.timeout), r.s_out) for r in movement(df, "u", "ts", "s", bin_).collect()]
        assert sorted(m, key=str) == sorted(((u, a, s, n, x) for u, a, s, _, n, x in _runs(events)), key=str)


@FEW
@given(EVENTS)
def test_neighbours_match_plain_python(spark, events):
    unique = sorted({(u, h): s for u, h, s in events}.items())
    df = _frame(spark, [(u, h, s) for (u, h), s in unique])
    before, after, kept = {}, {}, []
    for _, items in groupby(unique, key=lambda e: e[0][0]):
        items = list(items)
        for i, (k, s) in enumerate(items):
            before[k] = items[i - 1][1] if i else None
            after[k] = items[i + 1][1] if i + 1 < len(items) else None
            if before[k] != s:
                kept.append(k)
    start = datetime(2024, 1, 1)

    def key(r):
        return r.u, int((r.ts - start).total_seconds() // 3600)

    assert {key(r): r.prev_s for r in previous_row(df, "u", ["ts"], ["s"]).collect()} == before
    assert {key(r): r.next_s for r in next_row(df, "u", ["ts"], ["s"]).collect()} == after
    assert sorted(key(r) for r in drop_repeats(df, "u", ["ts"], "s").collect()) == sorted(kept)


def test_single_sighting_has_no_dwell(spark):
    got = dwell(_frame(spark, [("u", 3, "a")]), "u", "ts", "s").first()
    assert got.dwell_time == 0.0 and got.ts == got.timeout


def test_windows():
    w = Window.month_to_date(D(2020, 3, 1))
    assert (w.start, w.end, w.txdate) == (D(2020, 2, 1), D(2020, 2, 29), D(2020, 3, 1))
    c = CommissionWindow.of_month(D(2020, 5, 1))
    assert (c.start, c.end, c.eve) == (D(2020, 2, 1), D(2020, 2, 29), D(2020, 4, 30))


def test_modulo_parts_are_cut_by_rows(spark):
    """A part of many rows is several tasks, in order; none is missing and no key is in two."""
    from millrace.operators import modulo_parts

    df = spark.range(6000).selectExpr("id % 500 as k")
    placed = modulo_parts(df, "k", 3, part_rows=200).withColumns({"pid": F.spark_partition_id(), "seq": F.monotonically_increasing_id()})
    got = [tuple(r) for r in placed.select(F.col("k") % 3, "k", "pid").orderBy("seq").collect()]
    assert got == sorted(got) and len(got) == 6000
    assert len({(k, pid) for _, k, pid in got}) == 500
    assert max(sum(1 for x in got if x[2] == pid) for pid in {x[2] for x in got}) < 1200
