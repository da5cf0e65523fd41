"""Pieces that several reports share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators import build_history, keep_first
from millrace.sources import readers as R
from millrace.sources.tables import Tables


# Calendar years of the driver's orders and shipments.
YEARS = (1994, 2003)


def day(c: str) -> Column:
    return F.to_date(F.col(c))


def cents(c: Column | str) -> Column:
    """Money held as double, as whole cents: sums of them are exact and stay in plain longs."""
    return F.rint((F.col(c) if isinstance(c, str) else c) * 100).cast("bigint")


def total(c: Column | str) -> Column:
    """Exact sum of money, given back as double."""
    return from_cents(F.sum(cents(c)))


def from_cents(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double") / 100


def revenue() -> Column:
    """Price less discount, exact to four decimals."""
    return (cents("l_extendedprice") * (100 - cents("l_discount"))).cast("decimal(18,0)")


def from_revenue(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double") / 10000


def orders(t: Tables) -> DataFrame:
    return t.orders.withColumn("o_orderdate", day("o_orderdate"))


def lines(t: Tables) -> DataFrame:
    return t.lineitem.withColumn("l_shipdate", day("l_shipdate"))


def priority_history(t: Tables) -> DataFrame:
    """Validity intervals of a customer's order priority; the highest one of a day counts."""
    daily = orders(t).groupBy("o_custkey", "o_orderdate").agg(F.max("o_orderpriority").alias("plan"))
    return build_history(daily, "o_custkey", "o_orderdate", ["plan"])


HISTORY_SQL = """
hist AS (
  SELECT o_custkey, plan, d AS start_date,
         coalesce(lead(d) OVER (PARTITION BY o_custkey ORDER BY d) - 1, DATE '2999-12-31') AS end_date
  FROM (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, max(o_orderpriority) AS plan FROM orders GROUP BY 1, 2))
"""

__all__ = ["HISTORY_SQL", "YEARS", "cents", "day", "from_cents", "from_revenue", "keep_first", "lines", "orders", "priority_history", "revenue", "total"]


def _pad(c, n: int):
    return F.rpad(F.coalesce(c.cast("string"), F.lit("")), n, " ")


def fixed_lines(t: Tables, day: str = "dd") -> DataFrame:
    """Orders as fixed-width call-forward lines: those of one status are header lines, those of another have a short date.

    `day` is the form of the day in the date; a quoted number puts all calls of a month on that day.
    """
    status = F.col("o_orderstatus")
    kind = F.when(status == "F", "20").when(status == "O", "30").otherwise("10")
    date = F.when(status == "O", F.date_format("o_orderdate", "yyMM")).otherwise(F.date_format("o_orderdate", "yyMM" + day))
    held = {"record_type": kind, "imsi": F.col("o_custkey"), "dial_digit": F.col("o_orderpriority"), "call_start_date": date, "caller_no": F.col("o_orderkey")}
    line = F.concat(*[_pad(held.get(n, F.lit("")), w) for n, w in R.FORWARD_WIDTHS])
    return t.orders.select(line.alias("value"))
