"""Personal data by candidate spans and gradient-boosted trees, in DataFrame functions only.

Four exact kinds (email, ip, card, phone) are found by pattern and checked. Generators with high recall propose
further spans. Trees over format and context of a span learn to tell spans that the strict rules confirm from
those they refuse, over all documents: spans are counted by their (binned) features, and the trees are boosted
on those counts, which are as many at most as there are feature combinations, whatever the input. A score
is a sum of CASE expressions. Each generator has its own threshold, set for the wanted precision.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import and_

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

# The patterns of the exact kinds, in a form that never backtracks over a long run: a run is entered at its start
# or where the last match ended, and repetitions are possessive where what follows cannot be part of them.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
OCTET = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2}|(?<=0))"

GENERATORS = {
    "secret": r"(?i)\b(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth)[\"']?\s{0,3}[=:]\s{0,3}[\"']?[^\s\"',;]{4,}+",
    "token": r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{16,}+",
    "number": r"(?<![0-9+().-])[(]?[0-9](?:[\x20().-]{0,2}[0-9]){8,18}+(?![0-9])",
    "spelled": r"(?i)(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{1,64}+\s?[\[(]at[\])]\s?[A-Za-z0-9-]{1,64}+(?:\s?(?:\.|[\[(]dot[\])])\s?[A-Za-z0-9-]{1,64}+){1,4}+",
}
HOLDS = {"token": ("[0-9]", "[A-Za-z]")}  # what a value must hold besides
NUMBERS = {name: i for i, name in enumerate(GENERATORS)}
CONTEXT = r"(?i)(?:mail|phone|tel|call|mobile|fax|card|visa|credit|account|iban|ip|host|server|password|passwd|pwd|secret|token|key|login|user)\W{0,3}\s*$"
FEATURES = ("generator", "length", "digits", "upper", "marks", "context", "before")
PRECISION = 0.9


def located(text: Column, pattern: str) -> Column:
    """The matches of a pattern as (start, end, value) in code points, in order.

    The pieces between the matches and the matches themselves give the places.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    paired = F.arrays_zip(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)).alias("gap"), found.alias("value"))
    empty = F.expr("cast(array() as array<struct<start: int, end: int, value: string>>)")

    def add(acc: Column, step: Column) -> Column:
        start = acc["at"] + F.char_length(step["gap"])
        end = start + F.char_length(step["value"])
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(F.struct(start.alias("start"), end.alias("end"), step["value"].alias("value")))).alias("spans"))

    return F.aggregate(paired, F.struct(F.lit(0).alias("at"), empty.alias("spans")), add, lambda acc: acc["spans"])


def luhn(digits: Column) -> Column:
    """Luhn's check over the digits of a string, from the right."""

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, F.char_length(digits) - i + 1, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(i % 2 == 1, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), add) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return F.when(F.char_length(digits).between(12, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.char_length(digits).between(9, 15)
    return F.lit(True)


def exact(kind: str, text: Column) -> Column:
    """Checked spans of one exact kind."""
    none = F.expr("cast(array() as array<struct<start: int, end: int, value: string>>)")
    here = F.instr(text, NEEDS[kind]) > 0 if NEEDS[kind] else text.rlike("[0-9]")
    return F.when(here, F.filter(located(text, PATTERNS[kind]), lambda s: valid(kind, s["value"]))).otherwise(none)


def binned(value: Column, *edges: float) -> Column:
    """The number of edges that the value reaches."""
    return sum((F.when(value >= e, F.lit(1)).otherwise(F.lit(0)) for e in edges), F.lit(0))


def described(name: str, text: Column, span: Column) -> Column:
    """Features of a span, all small whole numbers; the value itself and what stands before it are looked at."""
    value, n = span["value"], F.char_length(span["value"])
    before = F.substring(text, F.greatest(span["start"] - 23, F.lit(1)), F.least(span["start"], F.lit(24)))
    last = F.substring(before, -1, 1)
    share = lambda pattern: F.char_length(F.regexp_replace(value, pattern, "")) / n
    return F.struct(
        span["start"].alias("start"),
        span["end"].alias("end"),
        F.lit(name).alias("name"),
        F.lit(NUMBERS[name]).alias("generator"),
        binned(n, 10, 13, 17, 21, 33).alias("length"),
        binned(share("[^0-9]"), 0.2, 0.5, 0.8, 0.999).alias("digits"),
        binned(share("[^A-Z]"), 0.001, 0.3).alias("upper"),
        binned(F.char_length(F.regexp_replace(value, "[A-Za-z0-9]", "")), 1, 2, 4).alias("marks"),
        F.when(before.rlike(CONTEXT), F.lit(1)).otherwise(F.lit(0)).alias("context"),
        F.when(last == "", F.lit(0)).when(last.rlike(r"\s"), F.lit(1)).when(last.rlike("[A-Za-z0-9]"), F.lit(2)).otherwise(F.lit(3)).alias("before"),
    )


def strict(name: str, value: Column) -> Column:
    """The label of a span: what a strict rule says of it without a look at its features' bins."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    if name == "secret":
        return F.regexp_extract(value, r"[=:]\s*[\"']?(.*)$", 1).rlike(r"^(?=.*[0-9])(?=.*[A-Za-z]).{8,}$")
    if name == "token":
        return value.rlike(r"^(?:(?=[0-9a-f]*[a-f])(?=[0-9a-f]*[0-9])[0-9a-f]{16,}|(?:sk|pk|ghp|AKIA|xox)[A-Za-z0-9_-]{16,})$")
    if name == "number":
        return F.when(F.char_length(digits).between(12, 19), luhn(digits)).otherwise(F.lit(False)) | value.rlike(r"^\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}$")
    return value.rlike(r"(?i)(?:\.|dot[\])])\s?[a-z]{2,}$")


def candidates(text: Column, taken: Column) -> Column:
    """Spans of all generators that do not touch an exact one, with features and label; they may overlap."""

    def proposed(name: str) -> Column:
        holds = lambda s: [s["value"].rlike(p) for p in HOLDS.get(name, ())]
        spans = F.filter(located(text, GENERATORS[name]), lambda s: reduce(and_, holds(s), ~F.exists(taken, lambda t: (t["start"] < s["end"]) & (s["start"] < t["end"]))))
        return F.transform(spans, lambda s: F.struct(described(name, text, s).alias("f"), strict(name, s["value"]).alias("label")))

    parts = [proposed(name) for name in GENERATORS]
    looks = text.rlike(r"[0-9]|[\[(][aA][tT][\])]|[=:]")
    return F.when(looks, F.concat(*parts))


@dataclass
class Trees:
    """Boosted trees of two levels: (feature, edge, feature below, edge, feature above, edge, four leaves)."""

    base: float = -20.0
    trees: list[tuple] = field(default_factory=list)
    thresholds: dict[int, float] = field(default_factory=dict)

    def value(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for f, e, fl, el, fr, er, leaves in self.trees:
            out += np.where(x[:, f] >= e, np.where(x[:, fr] >= er, leaves[3], leaves[2]), np.where(x[:, fl] >= el, leaves[1], leaves[0]))
        return out

    def score(self, span: Column) -> Column:
        at = lambda f, e: span[FEATURES[f]] >= F.lit(int(e))
        total = F.lit(float(self.base))
        for f, e, fl, el, fr, er, leaves in self.trees:
            v = [F.lit(float(x)) for x in leaves]
            total = total + F.when(at(f, e), F.when(at(fr, er), v[3]).otherwise(v[2])).otherwise(F.when(at(fl, el), v[1]).otherwise(v[0]))
        return total

    def chosen(self, span: Column) -> Column:
        limit = F.lit(float("inf"))
        for generator, value in self.thresholds.items():
            limit = F.when(span["generator"] == generator, F.lit(float(value))).otherwise(limit)
        return self.score(span) >= limit


def boost(x: np.ndarray, positive: np.ndarray, total: np.ndarray, rounds: int = 24, rate: float = 0.4, precision: float = PRECISION) -> Trees:
    """Second-order boosting of the logistic loss on rows of features with their counts."""
    model = Trees()
    if not len(x) or positive.sum() <= 0:
        return model
    share = np.clip(positive.sum() / total.sum(), 1e-6, 1 - 1e-6)
    model.base = float(np.log(share / (1 - share)))
    tests = [(f, e) for f in range(x.shape[1]) for e in np.unique(x[:, f])[1:]]
    now = np.full(len(x), model.base)
    leaf = lambda g, h: -rate * g / (h + 1.0)
    gain = lambda g, h: g * g / (h + 1.0)

    def best(rows: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[float, int, int]:
        found = (0.0, 0, 1 << 30)
        for f, e in tests:
            up = rows & (x[:, f] >= e)
            down = rows & ~up
            value = gain(g[up].sum(), h[up].sum()) + gain(g[down].sum(), h[down].sum()) - gain(g[rows].sum(), h[rows].sum())
            if value > found[0] + 1e-9:
                found = (float(value), f, int(e))
        return found

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-now))
        g, h = total * p - positive, np.maximum(total * p * (1 - p), 1e-9)
        everything = np.ones(len(x), bool)
        value, f, e = best(everything, g, h)
        if value <= 1e-6:
            break
        up = x[:, f] >= e
        _, fl, el = best(~up, g, h)
        _, fr, er = best(up, g, h)
        leaves = []
        for side, (ff, ee) in ((~up, (fl, el)), (up, (fr, er))):
            for part in (side & (x[:, ff] < ee), side & (x[:, ff] >= ee)):
                leaves.append(float(leaf(g[part].sum(), h[part].sum())))
        model.trees.append((f, e, fl, el, fr, er, leaves))
        now = model.base + (model.value(x) - model.base)
    for generator in np.unique(x[:, 0]):
        rows = np.flatnonzero(x[:, 0] == generator)
        order = rows[np.argsort(-now[rows], kind="stable")]
        hit, all_ = np.cumsum(positive[order]), np.cumsum(total[order])
        last = np.append(now[order][1:] < now[order][:-1], True)
        good = np.flatnonzero(last & (hit / all_ >= precision))
        if len(good):
            model.thresholds[int(generator)] = float(now[order[good[-1]]]) - 1e-6
    return model


def fit(docs: DataFrame, precision: float = PRECISION) -> Trees:
    """Trees for the candidate spans of all documents, from their counts by feature combination."""
    spans = scanned(docs.select("text")).select(F.explode("candidates").alias("c"))
    names = [F.col(f"c.f.{f}").alias(f) for f in FEATURES]
    counts = spans.groupBy(*names).agg(F.sum(F.when(F.col("c.label"), 1).otherwise(0)).alias("positive"), F.count("*").alias("total")).collect()
    rows = sorted(tuple(r) for r in counts)
    x = np.array([r[: len(FEATURES)] for r in rows], np.int64).reshape(-1, len(FEATURES))
    return boost(x, np.array([r[-2] for r in rows], float), np.array([r[-1] for r in rows], float), precision=precision)


def scanned(docs: DataFrame) -> DataFrame:
    """docs with _text (null: empty), _base (exact spans with kind) and candidates."""
    out = docs.withColumn("_text", F.coalesce(F.col("text"), F.lit("")))
    typed = lambda k: F.transform(exact(k, F.col("_text")), lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(k)).alias("order"), s["end"].alias("end"), F.lit(k).alias("kind")))
    out = out.withColumns({f"_{k}": typed(k) for k in KINDS})
    out = out.withColumn("_base", F.array_sort(F.concat(*[F.col(f"_{k}") for k in KINDS])))
    return out.withColumn("candidates", candidates(F.col("_text"), F.col("_base")))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def detect(docs: DataFrame, trees: Trees) -> DataFrame:
    """docs with _base (exact spans) and _spans (those and the chosen candidates): (start, order, end, kind) in order.

    Of candidates that overlap, the one with the higher score stays, then the earlier one.
    """
    picked = F.filter(F.coalesce("candidates", F.expr("cast(array() as array<struct<f: struct<start: int, end: int, name: string, generator: int, length: int, digits: int, upper: int, marks: int, context: int, before: int>, label: boolean>>)")), lambda c: trees.chosen(c["f"]))
    ranked = F.array_sort(F.transform(picked, lambda c: F.struct((-trees.score(c["f"])).alias("rank"), c["f"]["start"].alias("start"), c["f"]["end"].alias("end"), c["f"]["name"].alias("kind"), c["f"]["generator"].alias("generator"))))
    none = F.expr("cast(array() as array<struct<start: int, order: int, end: int, kind: string>>)")

    def add(acc: Column, s: Column) -> Column:
        span = F.struct(s["start"].alias("start"), (s["generator"] + len(KINDS)).alias("order"), s["end"].alias("end"), s["kind"].alias("kind"))
        return F.when(F.exists(acc, lambda t: (t["start"] < s["end"]) & (s["start"] < t["end"])), acc).otherwise(F.concat(acc, F.array(span)))

    out = scanned(docs).withColumn("_more", F.aggregate(ranked, none, add))
    return out.withColumn("_spans", F.array_sort(F.concat("_base", "_more")))


def report(docs: DataFrame, trees: Trees) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) for every row; null text is empty."""
    found = detect(docs.select("doc_id", "text"), trees)
    return found.select(
        "doc_id",
        *[F.size(f"_{k}").cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.sha2(joined(F.col("_base")), 256).alias("base_sha256"),
        joined(F.col("_spans")).alias("spans"),
        F.size("_more").cast("bigint").alias("n_added"),
    )


def redacted(docs: DataFrame, trees: Trees) -> DataFrame:
    """docs with each span replaced by its kind in brackets; overlapping spans become one. Null text stays null.

    n_chars, if there is such a column, becomes the new length. Other columns stay.
    """

    def add(acc: Column, s: Column) -> Column:
        clear = s["start"] >= acc["at"]
        out = F.when(clear, F.concat(acc["out"], F.substring(F.col("_text"), acc["at"] + 1, s["start"] - acc["at"]), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = lambda acc: F.concat(acc["out"], F.substring(F.col("_text"), acc["at"] + 1, F.char_length("_text")))
    clean = F.when(F.size("_spans") > 0, F.aggregate("_spans", start, add, rest)).otherwise(F.col("text"))
    clashing = [c for c in docs.columns if c in {"_text", "_base", "_more", "_spans", "candidates", *(f"_{k}" for k in KINDS)}]
    if clashing:
        renamed = {c: f"kept{i}_{c}" for i, c in enumerate(clashing)}
        back = redacted(docs.withColumnsRenamed(renamed), trees).withColumnsRenamed({v: k for k, v in renamed.items()})
        return back.select(*[F.col(f"`{c}`") for c in docs.columns])
    found = detect(docs, trees).withColumn("_clean", clean)
    new = {"text": F.col("_clean"), "n_chars": F.char_length("_clean").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None}
    return found.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])
