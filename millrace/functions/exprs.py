"""Column helpers. Each takes Columns (or names) and returns a Column; none leaves the JVM."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.params import NO_DATE, NO_TEXT, OPEN_DATE, UNKNOWN_CODE


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- values that stand for "none" ---------------------------------------------------------

def blank(c: Column | str) -> Column:
    """Null, empty or spaces."""
    c = as_col(c)
    return c.isNull() | (F.trim(c) == "")


def no_code(c: Column | str) -> Column:
    """Blank, or the text for an unknown contract code."""
    return blank(c) | (as_col(c) == UNKNOWN_CODE)


def no_date(c: Column | str) -> Column:
    """Null, or one of the two dates that stand for "none" and "open"."""
    c = as_col(c)
    return c.isNull() | c.isin(NO_DATE, OPEN_DATE)


def nvl_blank(c: Column | str) -> Column:
    return F.coalesce(as_col(c), F.lit(NO_TEXT))


def override(o: Column | str, c: Column | str) -> Column:
    """`o` when it holds something, else `c`."""
    return F.when(~blank(o), as_col(o)).otherwise(as_col(c))


def concat_text(*cs: Column | str) -> Column:
    """Concatenate, a null counting as empty text."""
    return F.concat_ws("", *[as_col(c) for c in cs])


def decode(c: Column | str, *pairs: tuple, default=None) -> Column:
    """First value whose key equals `c`; a null key matches a null."""
    c = as_col(c)
    out = None
    for key, value in pairs:
        hit = c.eqNullSafe(F.lit(key))
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def first_match(branches: Sequence[tuple[Column, object]], default) -> Column:
    """Ordered CASE."""
    out = None
    for cond, value in branches:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def plan_group(c: Column | str, mapping: dict[str, str], default: str) -> Column:
    """Label by exact text, through one map lookup instead of a long CASE."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), as_col(c)), F.lit(default))


def plan_tier(label: Column | str) -> Column:
    """Number held in the two leading characters of a group label."""
    return F.substring(as_col(label), 1, 2).try_cast("int")


def pick_latest(a: Column | str, b: Column | str, a_keys: Sequence, b_keys: Sequence) -> Column:
    """The value of the newer source (keys compared in turn); a blank gives way to the other."""
    a, b = as_col(a), as_col(b)
    newer = F.struct(*[as_col(k).alias(f"k{i}") for i, k in enumerate(a_keys)]) >= F.struct(
        *[as_col(k).alias(f"k{i}") for i, k in enumerate(b_keys)]
    )
    return F.when(blank(b), a).when(blank(a), b).when(newer, a).otherwise(b)


# --- numbers ------------------------------------------------------------------------------

def clean_number(c: Column | str, type_: str = "decimal(18,2)") -> Column:
    """The number in the text; 0 if any other character is in it."""
    c = as_col(c)
    return F.coalesce(F.when(c.rlike(r"^[0-9.]+$"), c.try_cast(type_)), F.lit(0).cast(type_))


def clean_int(c: Column | str) -> Column:
    """Digits only, else 0."""
    c = as_col(c)
    return F.coalesce(F.when(c.rlike(r"^[0-9]+$"), c.try_cast("bigint")), F.lit(0).cast("bigint"))


def strip_money(c: Column | str) -> Column:
    """`$1,234` to `1234`, blank to `0`."""
    bare = F.translate(as_col(c), "$,", "")
    return F.when(blank(bare), F.lit("0")).otherwise(bare)


def tier_string(*pairs: tuple[str, Column | str]) -> Column:
    """`0-12:x|13-24:y` from money text per month range."""
    return F.concat_ws("|", *[F.concat(F.lit(label + ":"), strip_money(c)) for label, c in pairs])


def ratio(n: Column | str, d: Column | str) -> Column:
    """n / d, 0 when d is 0 or null."""
    n, d = as_col(n), as_col(d)
    return F.when(d.isNull() | (d == 0), F.lit(0)).otherwise(n / d)


def pct_text(c: Column | str, digits: int = 2) -> Column:
    """Fraction as text such as `12.50%`."""
    scaled = F.round(as_col(c).cast("decimal(28,12)") * 100, digits)
    return F.concat(scaled.cast(f"decimal(28,{digits})").cast("string"), F.lit("%"))


def money(c: Column | str, scale: int = 2) -> Column:
    """Money held as double, as a decimal: sums then do not depend on row order."""
    return as_col(c).cast(f"decimal(18,{scale})")


def to_gb(c: Column | str) -> Column:
    return as_col(c) / F.lit(1024.0 * 1024.0 * 1024.0)


# --- dates --------------------------------------------------------------------------------

def month_start(c: Column | str) -> Column:
    return F.trunc(as_col(c), "MM")


def add_months_sticky(c: Column | str, n: Column | int) -> Column:
    """add_months under which a month end stays a month end."""
    c = as_col(c)
    moved = F.add_months(c, n)
    return F.when(c == F.last_day(c), F.last_day(moved)).otherwise(moved)


def month_gap(a: Column | str, b: Column | str) -> Column:
    """Whole calendar months from b to a."""
    a, b = as_col(a), as_col(b)
    return (F.year(a) - F.year(b)) * 12 + F.month(a) - F.month(b)


def greatest_strict(*cs: Column | str) -> Column:
    """Greatest, null if any input is null."""
    cs = [as_col(c) for c in cs]
    missing = reduce(lambda x, y: x | y, [c.isNull() for c in cs])
    return F.when(~missing, F.greatest(*cs))


def year2_date(c: Column | str) -> Column:
    """`YYMMDD` of this century to a date; null if it is none."""
    c = as_col(c)
    return F.when(F.length(c) == 6, F.try_to_timestamp(F.concat(F.lit("20"), c), F.lit("yyyyMMdd")).cast("date"))


def is_date_text(c: Column | str) -> Column:
    """Text of the shape 20YY-MM-DD with a month and a day in range."""
    return F.coalesce(as_col(c).rlike(r"^20[0-9]{2}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])$"), F.lit(False))


def contract_months(code: Column | str) -> Column:
    """Length of a contract, held in characters 4 and 5 of its code."""
    return F.substring(as_col(code), 4, 2).try_cast("int")


def repair_start(start: Column | str, end: Column | str, code: Column | str) -> Column:
    """Missing contract start from its end and length."""
    start, end = as_col(start), as_col(end)
    derived = F.date_add(add_months_sticky(end, -contract_months(code)), 1)
    return F.when(no_date(start) & ~no_date(end) & ~no_code(code), derived).otherwise(start)


def repair_end(start: Column | str, end: Column | str, code: Column | str) -> Column:
    """Missing contract end from its start and length."""
    start, end = as_col(start), as_col(end)
    derived = F.date_sub(add_months_sticky(start, contract_months(code)), 1)
    return F.when(no_date(end) & ~no_date(start) & ~no_code(code), derived).otherwise(end)


# --- record keys --------------------------------------------------------------------------

def octet(c: Column | str, n: int) -> Column:
    """n-th part of a dotted address, as text."""
    return F.split_part(as_col(c), F.lit("."), F.lit(n))


def ip_key(c: Column | str) -> Column:
    """Dotted address with each part padded to three digits, so text order is address order."""
    return F.concat_ws(".", *[F.lpad(octet(c, n), 3, "0") for n in range(1, 5)])


def ip_long(c: Column | str) -> Column:
    """The twelve padded digits of an address as a number."""
    return F.concat(*[F.lpad(octet(c, n), 3, "0") for n in range(1, 5)]).try_cast("bigint")


def ip_from_key(c: Column | str) -> Column:
    """Twelve digits back to a dotted address without padding."""
    c = as_col(c)
    return F.concat_ws(".", *[F.substring(c, 1 + 3 * i, 3).cast("int").cast("string") for i in range(4)])


def compact_time(c: Column | str) -> Column:
    """`YYYY-MM-DD HH:MM:SS` to fourteen digits."""
    return F.translate(as_col(c), "- :", "")


def row_key(ip: Column | str, ts: Column | str, dst: Column | str) -> Column:
    return F.concat_ws("_", ip_key(ip), compact_time(ts), as_col(dst))


def octet_bucket(c: Column | str, n: int = 3, width: int = 1) -> Column:
    """Partition bucket of an address: its n-th part, or ranges of it."""
    return F.floor(octet(c, n).try_cast("int") / width).cast("int")


# --- text ---------------------------------------------------------------------------------

def literal(sep: str) -> str:
    """A pattern that matches a separator as it stands, of any characters."""
    return "\\Q" + sep.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def nth_segment(c: Column | str, sep: str, n: int) -> Column:
    """n-th piece of separated text; empty text beyond the last one."""
    return F.split_part(as_col(c), F.lit(sep), F.lit(n))


def nth_token(c: Column | str, n: int, sep: str = ",") -> Column:
    """n-th non-empty token; null beyond the last one."""
    pieces = F.filter(F.split(as_col(c), literal(sep)), lambda x: x != "")
    return F.try_element_at(pieces, F.lit(n))


def token_count(c: Column | str, sep: str = ",") -> Column:
    """Number of separators plus one; 0 for a blank."""
    c = as_col(c)
    return F.when(blank(c), F.lit(0)).otherwise(F.regexp_count(c, F.lit(literal(sep))) + 1)


def composite_id(*cs: Column | str) -> Column:
    return F.concat_ws("-", *[as_col(c).cast("string") for c in cs])


def json_number(c: Column | str, field: str, type_: str = "decimal(18,3)") -> Column:
    """Numeric field of JSON text, 0 when absent or not a number."""
    text = F.get_json_object(as_col(c), "$." + field)
    return F.coalesce(text.try_cast(type_), F.lit(0).cast(type_))


# --- contract value -----------------------------------------------------------------------

def term_months(start: Column | str, end: Column | str) -> Column:
    """Length in months of a year of 365 days, one decimal."""
    days = F.datediff(as_col(end), as_col(start)) + 1
    return F.round((days.cast("decimal(12,0)") * 12) / F.lit(365), 1).cast("decimal(6,1)")


def contract_value(
    *, start, end, old_start, old_end, old_invoice, bill_rate, rebate, rebate_flag, subsidy,
    old_bill_rate, old_rebate, old_rebate_flag, old_subsidy,
) -> dict[str, Column]:
    """Contract length, length of the replaced contract, its months left, and total value.

    Rebates are negative amounts. An invoice rebate recurs each month, a market rebate is paid once.
    """
    amt = "decimal(12,2)"
    term = term_months(start, end)
    months = F.when(term == 0, F.lit(1).cast("decimal(6,1)")).otherwise(term)
    has_old = ~blank(old_invoice)
    old_term = term_months(old_start, old_end)
    old_months = F.when(has_old & (as_col(old_end) != as_col(old_start)), old_term).otherwise(
        F.lit(1).cast("decimal(6,1)")
    )
    changed = F.coalesce(as_col(old_end) > as_col(start), F.lit(False))
    remain = F.when(changed & has_old, term_months(start, old_end)).otherwise(F.lit(0).cast("decimal(6,1)"))

    def monthly(amount, flag):
        return F.when(as_col(flag).isin("INV_REBATE", "OVR_REBATE"), as_col(amount).cast(amt)).otherwise(F.lit(0).cast(amt))

    def once(amount, flag, also=F.lit(True)):
        return F.when((as_col(flag) == "MKT_REBATE") & also, as_col(amount).cast(amt)).otherwise(F.lit(0).cast(amt))

    # A cost spread over the term and taken for the whole term is the cost itself, so only the
    # part of the old contract that is left needs a division.
    new_part = (
        (as_col(bill_rate).cast(amt) + monthly(rebate, rebate_flag)) * months
        - as_col(subsidy).cast(amt)
        + once(rebate, rebate_flag)
    )
    old_once = once(old_rebate, old_rebate_flag, remain > 0) - as_col(old_subsidy).cast(amt)
    old_part = F.when(
        has_old,
        (as_col(old_bill_rate).cast(amt) + monthly(old_rebate, old_rebate_flag)) * remain
        + F.try_divide(old_once * remain, old_months),
    ).otherwise(F.lit(0))
    return {
        "contract_mth": months,
        "old_contract_mth": old_months,
        "chg_plan_flg": F.when(changed, "Y").otherwise("N"),
        "remain_contract_mth": remain,
        "tcv": F.round(new_part - old_part, 2).cast("decimal(18,2)"),
    }
