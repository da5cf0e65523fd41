"""Commission steps ask for no more than they need: what moves is bounded by the open cases, and events are placed once."""

from pyspark.sql import functions as F

from millrace.operators import first_events
from millrace.plans import commission
from millrace.reports.jobs import COMM
from millrace.reports.warehouse import Warehouse
from millrace.sources.tables import Tables


def test_events_are_placed_once_for_both_contracts_and_only_open_cases_look_for_one(spark, monkeypatch):
    asked = []

    def recorded(probes, *args):
        asked.append(probes)
        return first_events(probes, *args)

    monkeypatch.setattr(commission, "first_events", recorded)
    w = Warehouse(Tables(spark, "/root/testdata/sf0.001"))
    rows = commission.prepared(w, COMM)
    assert len(asked) == 1
    owned = rows.where("ld_match = 'INVOICE'").select("case_id")
    assert owned.count() > 0 and asked[0].join(owned, "case_id").count() == 0
    commission.result(w, COMM, rows)
    assert len(asked) == 2 and {r.label for r in asked[1].select("label").distinct().collect()} == {"INV_REBTE", "OLD_INV_REBTE"}


def test_probes_move_as_two_parts_at_most(spark):
    """A probe that asks for 50 events is not copied 50 times, whatever place it begins at."""
    events = spark.range(200).select(F.lit("k").alias("k"), F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("at"), "id")
    probes = events.select("k", F.col("at").alias("since"), F.col("id").alias("p"))
    got = first_events(probes, events, "k", "since", "at", 50)
    rows = {(r.p, r.id, r.rnk) for r in got.select("p", "id", "rnk").collect()}
    assert rows == {(p, e, e - p + 1) for p in range(200) for e in range(p, min(p + 50, 200))}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(floor" in plan.lower() and "sequence(1, 50" not in plan
