"""Joins by dyadic cells, time lines, global positions and pattern indexes, against brute force."""

import random
import re
from datetime import date, timedelta

import pytest

from pyspark.sql import functions as F

from millrace.operators import best_open, drop_like, events_before, first_events, join_overlap, join_range, with_position
from millrace.operators.intervals import CALENDAR_LEVELS, cells, cells_of_place, day_place, halves
from millrace.params import OPEN_DATE

D0 = date(2015, 1, 1)


def day(rnd, span=900):
    return D0 + timedelta(rnd.randrange(span))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols or df.columns).collect()), key=str)


def test_cells_make_up_the_interval(spark):
    pairs = [(lo, hi) for lo in range(0, 33) for hi in range(lo - 1, 33)]
    df = spark.createDataFrame(pairs, "lo long, hi long").select("lo", "hi", cells(F.col("lo"), F.col("hi"), 6).alias("c"))
    for lo, hi, found in df.collect():
        places = [p for level, cell in found for p in range(cell << level, (cell + 1) << level)]
        assert sorted(places) == list(range(lo, hi + 1)) and len(found) <= 12
    (r,) = spark.range(1).select(cells_of_place(F.lit(37).cast("long"), 6).alias("c")).collect()
    assert [tuple(x) for x in r.c] == [(k, 37 >> k) for k in range(7)]


def overlaps(spark, a, b):
    left = spark.createDataFrame(a, "k string, s1 date, e1 date, a int")
    right = spark.createDataFrame(b, "k string, s2 date, e2 date, b int")
    return join_overlap(left, right, "k", "s1", "e1", "s2", "e2")


def test_overlap_equals_brute_force(spark):
    rnd = random.Random(1)

    def side(n):
        out = []
        for i in range(n):
            s = rnd.choice([date(1, 1, 1), date(1930, 5, 5), D0, day(rnd), day(rnd), date(2090, 1, 1), None])
            e = rnd.choice([OPEN_DATE, date(2095, 1, 1), s, day(rnd), day(rnd), None])
            out.append((rnd.choice(["x", "x", "y", None]), s, e, i))
        return out

    a, b = side(90), side(90)
    whole = lambda r: None not in r[:3] and r[1] <= r[2]
    want = sorted((x[3], y[3]) for x in a for y in b if whole(x) and whole(y) and x[0] == y[0] and x[1] <= y[2] and y[1] <= x[2])
    assert sorted(tuple(r) for r in overlaps(spark, a, b).select("a", "b").collect()) == want


def test_open_intervals_are_few_cells(spark):
    """All intervals open: rows made by the decomposition are bounded by the levels, whatever the calendar."""
    df = spark.range(500).select(F.date_add(F.lit(D0), (F.col("id") * 7).cast("int")).alias("s"), F.lit(OPEN_DATE).alias("e"))
    place = lambda c: day_place(F.col(c), date(1960, 1, 1), CALENDAR_LEVELS)
    made = df.select(F.size(cells(place("s"), place("e"), CALENDAR_LEVELS)).alias("n")).agg(F.max("n"), F.avg("n")).first()
    assert made[0] <= CALENDAR_LEVELS + 1 and made[1] < 12


def test_range_join_of_codes_equals_brute_force(spark):
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice("ABé1") for _ in range(rnd.randint(0, 4)))
    left = [(rnd.choice([None, word(), word()]), i) for i in range(150)]
    ranges = [(word(), word(), f"r{i}") for i in range(60)] + [(None, "B", "n1"), ("A", None, "n2"), ("", "éééé", "all"), ("", "éééé", "all")]
    key = lambda s: s.encode()
    held = lambda v, lo, hi: None not in (v, lo, hi) and key(lo) <= key(v) <= key(hi)
    want = sorted(((i, n) for v, i in left for lo, hi, n in ranges if held(v, lo, hi)), key=str)
    df = spark.createDataFrame(left, "v string, i int")
    got = join_range(df, spark.createDataFrame(ranges, "lo string, hi string, n string"), "v", "lo", "hi")
    assert rows(got, "i", "n") == want
    outer = join_range(df, spark.createDataFrame(ranges, "lo string, hi string, n string"), "v", "lo", "hi", how="left")
    assert outer.where("n is null").count() == sum(not any(held(v, lo, hi) for lo, hi, _ in ranges) for v, _ in left)
    assert join_range(df, spark.createDataFrame([], "lo string, hi string, n string"), "v", "lo", "hi").count() == 0


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_nested_loops(spark, no_broadcast):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "v string, i int")
    ranges = spark.createDataFrame([("a", "b", "n")], "lo string, hi string, n string")
    patterns = spark.createDataFrame([("a%",)], "pattern string")
    for made in (join_range(df, ranges, "v", "lo", "hi"), drop_like(df, "v", patterns)):
        made.collect()
        assert "NestedLoop" not in plan_of(made) and "Cartesian" not in plan_of(made)


def test_positions_of_rows(spark):
    rnd = random.Random(3)
    values = [(rnd.choice([None, rnd.randrange(50)]), i) for i in range(2000)]
    got = {r.i: r.position for r in with_position(spark.createDataFrame(values, "v int, i int").repartition(7), ["v", "i"]).collect()}
    order = sorted(values, key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    assert got == {i: n for n, (_, i) in enumerate(order)}
    assert with_position(spark.range(0), "id").count() == 0


def slow_first(probes, events, n):
    out = []
    for p, k, since, until in probes:
        seen = sorted((e for e in events if k is not None and since is not None and e[0] == k and e[1] is not None and e[1] >= since), key=lambda e: e[1])
        for e in seen:
            rank = 1 + sum(x[1] < e[1] for x in seen)
            if rank <= n and e[1] <= until:
                out.append((p, e[2], rank))
    return sorted(out)


@pytest.mark.parametrize("n", [1, 4])
def test_first_events_with_a_hot_key(spark, n):
    """One key holds a third of the rows on both sides."""
    rnd = random.Random(n)
    key = lambda: rnd.choice(["hot", f"k{rnd.randrange(40)}", f"k{rnd.randrange(40)}", None] if rnd.random() < 0.5 else ["hot", "k1", "k2"])
    events = [(key(), rnd.choice([day(rnd), day(rnd), None]), i) for i in range(600)]
    probes = [(i, key(), rnd.choice([day(rnd), date(1950, 1, 1), OPEN_DATE, None, day(rnd)]), day(rnd, 1500)) for i in range(300)]
    df = spark.createDataFrame(probes, "p int, k string, since date, until date")
    got = first_events(df, spark.createDataFrame(events, "k string, at date, e int"), "k", "since", "at", n, "until")
    assert sorted(tuple(r) for r in got.select("p", "e", "rnk").collect()) == slow_first(probes, events, n)


def test_first_events_make_no_pairs(spark, no_broadcast):
    """A key with all rows: the rows that joins put out stay in proportion to rows in, not to their product."""
    n = 3000
    events = spark.range(n).select(F.lit("hot").alias("k"), F.date_add(F.lit(D0), (F.col("id") % 1500).cast("int")).alias("at"), F.col("id").alias("e"))
    probes = spark.range(n).select(F.lit("hot").alias("k"), F.date_add(F.lit(D0), (F.col("id") % 1500).cast("int")).alias("since"), F.col("id").alias("p"))
    got = first_events(probes, events, "k", "since", "at", 2)
    got.collect()
    node, most = [got._jdf.queryExecution().executedPlan()], 0
    while node:
        x = node.pop()
        text = x.nodeName()
        if "Adaptive" in text:
            node.append(x.executedPlan())
            continue
        if "QueryStage" in text:
            node.append(x.plan())
            continue
        if "Join" in text:
            most = max(most, x.metrics().apply("numOutputRows").value())
        node += [x.children().apply(i) for i in range(x.children().size())]
    assert 0 < most <= 3 * n  # n * n / 2 as pairs


def test_events_before_counts_days_once(spark):
    events = spark.createDataFrame([("k", D0), ("k", D0), ("k", D0 + timedelta(40)), (None, D0), ("k", None)], "k string, day date")
    days = spark.createDataFrame([("k", D0), ("k", D0 + timedelta(39)), ("k", D0 + timedelta(41)), ("z", D0)], "k string, day date")
    got = {(r.k, r.day): r.before for r in events_before(events, days, ["k"]).where("k is not null").collect()}
    assert got == {("k", D0): 0, ("k", D0 + timedelta(39)): 2, ("k", D0 + timedelta(40)): 2, ("k", D0 + timedelta(41)): 3, ("z", D0): 0}


def test_best_open_equals_brute_force(spark):
    rnd = random.Random(6)
    spans = []
    for i in range(400):
        s = day(rnd)
        e = rnd.choice([OPEN_DATE, s + timedelta(rnd.randrange(-3, 300)), None])
        spans.append((rnd.choice(["hot", "hot", "x", "y", None]), s, e, rnd.choice([None, rnd.randrange(6)]), f"c{rnd.randrange(9)}"))
    asked = [(rnd.choice(["hot", "x", "z", None]), rnd.choice([day(rnd, 1300), None, OPEN_DATE]), i) for i in range(200)]
    got = best_open(
        spark.createDataFrame(asked, "k string, at date, i int"), spark.createDataFrame(spans, "k string, s date, e date, v int, c string"), "k", "at", "s", "e", ["v"], ["v", "c"]
    )
    want = {}
    for k, at, i in asked:
        live = [((v is not None, v or 0), c, v) for x, s, e, v, c in spans if k is not None and x == k and None not in (at, e) and s <= at <= e]
        best = max(live, key=lambda x: x[:2]) if live else None
        want[i] = (best[2], best[1]) if best else (None, None)
    assert {r.i: (r.v, r.c) for r in got.collect()} == want


def test_halves_make_up_the_interval(spark):
    """An interval is two entries at most, and a place of it lies in exactly one of them."""
    pairs = [(lo, hi) for lo in range(0, 33) for hi in range(lo, 33)]
    df = spark.createDataFrame(pairs, "lo long, hi long").select("lo", "hi", halves(F.col("lo"), F.col("hi")).alias("h"))
    for lo, hi, found in df.collect():
        places = [p for level, cell, edge in found for p in range(cell << level, (cell + 1) << level) if (p <= edge if cell % 2 else p >= edge)]
        assert sorted(places) == list(range(lo, hi + 1)) and len(found) <= 2


def test_best_open_sends_a_day_once(spark):
    """Days are copied to their cells where they lie by key, not before: no shuffle or join is by cell alone."""
    asked = spark.createDataFrame([("a", D0, 1)], "k string, at date, i int")
    spans = spark.createDataFrame([("a", D0, OPEN_DATE, 1)], "k string, s date, e date, v int")
    text = plan_of(best_open(asked, spans, "k", "at", "s", "e", ["v"], ["v"]))
    assert "_cell" in text and not re.search(r"hashpartitioning\(k#\d+, _level#\d+, _cell#\d+, \d", text)


PATTERNS = ["red %", "% ring", "%old%", "h_t b%", "a\\%b", "100\\%", "%\\_%", "_", "___", "%____", "", "\\\\x", "%aa%aa%", "a%", "%b", "%é_", "exact", "%a\nb%"]


def like(text, pattern):
    import re

    out, i = "", 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            i += 1
            out += re.escape(pattern[i])
        else:
            out += {"%": "[\\s\\S]*", "_": "[\\s\\S]"}.get(c, re.escape(c))
        i += 1
    return re.fullmatch(out, text) is not None


@pytest.mark.parametrize("take", [1, 5, len(PATTERNS)])
def test_like_patterns_of_any_number(spark, take):
    rnd = random.Random(take)
    texts = ["red ball", "a%b", "aXb", "100%", "1000", "x_y", "a", "abc", "abcd", "", "\\x", "aab aa", "aaa", "exact", "hot bun", "old", "key ring", "éx", "xa\nby"]
    texts += ["".join(rnd.choice("ab%_\\é") for _ in range(rnd.randint(0, 6))) for _ in range(150)] + [None]
    chosen = rnd.sample(PATTERNS, take)
    patterns = spark.createDataFrame([(p,) for p in [*chosen, None, chosen[0]]], "pattern string")
    got = drop_like(spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "c string, i int"), "c", patterns)
    assert sorted(r.i for r in got.collect()) == [i for i, t in enumerate(texts) if t is None or not any(like(t, p) for p in chosen)]


def test_thousands_of_patterns(spark):
    patterns = spark.range(3000).select(F.concat(F.lit("%-"), F.col("id").cast("string"), F.lit("-%")).alias("pattern"))
    texts = spark.range(0, 6000, 2).select(F.concat(F.lit("x-"), F.col("id").cast("string"), F.lit("-y")).alias("c"))
    assert drop_like(texts, "c", patterns).count() == 1500
