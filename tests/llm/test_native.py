"""Decontamination and personal data: plain DataFrame plans, against plain Python."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import decontaminate as d
from millrace.llm import private_data as p


@pytest.fixture(scope="module")
def items(spark, words):
    rows = [(i, " ".join(words(20 + i, 50 + i))) for i in range(12)] + [(90, "too short"), (91, None), (92, "")]
    return spark.createDataFrame(rows, "item_id long, text string"), rows


def best_score(doc, item):
    best = 0
    for shift in range(-len(item), len(doc)):
        now = 0
        for j, w in enumerate(item):
            if 0 <= shift + j < len(doc):
                now = max(0, now + (1 if doc[shift + j] == w else -1))
                best = max(best, now)
    return best


def test_leaks_are_found_with_substitutions(frame, items, words):
    table, rows = items
    docs = []
    for i in range(12):
        w = rows[i][1].split()
        for every in (0, 5, 7):
            leak = [f"other{j}" if every and j % every == 2 else x for j, x in enumerate(w)]
            docs.append((len(docs), " ".join(words(30, 700 + len(docs)) + leak + words(25, 800 + len(docs))), "en", "s", 0))
    docs += [(500 + i, " ".join(words(90, 4000 + i)), "en", "s", 0) for i in range(60)]
    got = {(r.doc_id, r.item_id): r.score for r in d.contaminated(frame(docs), table).collect()}
    want = {}
    for i, t, *_ in docs:
        for k, x in rows[:12]:
            score = best_score(t.lower().split(), x.lower().split())
            if score >= min(10, -(-len(x.split()) // 2)):
                want[i, k] = score
    assert got == want and {i for i, _ in got} == set(range(36))
    kept = d.decontaminated(frame(docs), table)
    assert {r.doc_id for r in kept.collect()} == set(range(500, 560)) and kept.columns == frame(docs).columns


def test_decontamination_takes_anything(oddities, nothing, items):
    table, _ = items
    assert d.contaminated(oddities, table).count() == 0
    assert d.decontaminated(oddities, table).count() == oddities.count()
    assert d.decontaminated(nothing, table).count() == 0
    assert d.decontaminated(oddities, table.limit(0)).count() == oddities.count()


def test_plans_run_no_python(oddities, items):
    for frame in (d.matches(oddities, items[0]), p.report(oddities, p.Trees()), p.redacted(oddities, p.Trees())):
        text = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in text and "Arrow" not in text and "Pandas" not in text and "Cartesian" not in text


EXACT = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def by_hand(text):
    out = []
    for k, (kind, pattern) in enumerate(EXACT.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m.group().split(".")), "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), k, m.end(), kind))
    return [(kind, s, e) for s, _, e, kind in sorted(out)]


TEXTS = [
    "write to a.b@c.d.e_f@x.y or @z.w, a@b, a@b. c@d.e-f..g",
    "1.2.3.4.5.6.7.8 and 256.1.1.1 0001.02.3.000255 9.9.9 1.2.3.4567 00.0.0.0 999999999999.1.1.1",
    "4539 1488 0343 6467, 4539148803436467x 4539-1488-0343-6467-1 1 2 3 4 5 6 7 8 9 0 1 2  3 4 79927398713 4539  1488",
    "+1 (724) 555-7058 +12345678 ++1 234 567 890 +1.2.3.4.5.6.7.8.9.0.1.2.3.4.5 +49-30-1234567-",
    "é\U0001f600日本 ünï@example.com 10.0.0.1\U0001f600+44 20 7946 0958 4539148803436467",
    "1" * 3000 + " " + "1 " * 2000 + "a" * 5000 + "@" + "." * 100 + "a@b.cc" * 50,
    "password=b7db7aa4a5fcc78305 token: 'deadbeef00112233445566' api_key = ABCD1234efgh",
    "",
]


def test_exact_kinds_equal_the_patterns(frame):
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(TEXTS)] + [(99, None, "en", "s", None)]
    for r in p.report(frame(rows), p.Trees()).collect():
        found = by_hand(TEXTS[r.doc_id] if r.doc_id != 99 else "")
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in found)
        assert r.spans == joined, r.doc_id
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in found) for kind in EXACT]


def secrets(n):
    out = []
    for i in range(n):
        h = hashlib.sha1(str(i).encode()).hexdigest()
        out.append((i, f"some words before token = \"{h}\" and after", "en", "s", 60))
        out.append((n + i, f"plain prose number {i} of this kind, key: {'word' * (i % 3 + 1)} and so on", "en", "s", 60))
    return out


def test_added_spans_and_redaction(frame):
    rows = secrets(60) + [(500, "mail bob@example.com or call +1 (724) 555-7058.", "en", "s", 0), (501, None, "en", "s", 0)]
    trees = p.fit(frame(rows))
    assert trees.trees and trees.thresholds
    report = {r.doc_id: r for r in p.report(frame(rows), trees).collect()}
    assert all(report[i].n_added == 1 for i in range(60)) and all(report[i].n_added == 0 for i in range(60, 120))
    done = {r.doc_id: r for r in p.redacted(frame(rows), trees).collect()}
    assert done[500].text == "mail [EMAIL] or call [PHONE]." and done[500].n_chars == len(done[500].text)
    assert done[0].text == "some words before [SECRET]\" and after" and done[61].text == rows[3][1] and done[501].text is None


def test_long_secrets_and_tokens_go_whole(frame):
    long = "".join(hashlib.sha1(str(i).encode()).hexdigest() for i in range(8))[:300]
    rows = secrets(60) + [(1000 + i, f"see {hashlib.sha256(str(i).encode()).hexdigest()} there", "en", "s", 0) for i in range(60)]
    rows += [(500, f"here token = {long} and on", "en", "s", 0), (501, f"see {long} there", "en", "s", 0), (502, "see " + "-" * 300 + " there", "en", "s", 0)]
    done = {r.doc_id: r.text for r in p.redacted(frame(rows), p.fit(frame(rows))).collect()}
    assert done[500] == "here [SECRET] and on" and done[501] == "see [TOKEN] there" and done[502] == rows[-1][1]


def test_score_column_equals_the_trees(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 4, size=(200, len(p.FEATURES)))
    total = rng.integers(1, 20, size=200).astype(float)
    trees = p.boost(x, total * (x[:, 1] + x[:, 2] > 3), total)
    table = spark.createDataFrame([(i, *map(int, r)) for i, r in enumerate(x)], ", ".join(["i int", *(f"{f} int" for f in p.FEATURES)]))
    got = table.select("i", trees.score(F.struct(*p.FEATURES)).alias("s")).orderBy("i").collect()
    assert [r.s for r in got] == pytest.approx(trees.value(x).tolist())


def test_personal_data_takes_anything(oddities, nothing):
    trees = p.fit(oddities)
    assert p.report(oddities, trees).count() == oddities.count()
    out = p.redacted(oddities, trees)
    assert out.columns == oddities.columns and out.count() == oddities.count()
    assert p.fit(nothing).trees == [] and p.redacted(nothing, p.fit(nothing)).count() == 0
