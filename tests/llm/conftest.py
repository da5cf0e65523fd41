import random

import pytest


@pytest.fixture(scope="module")
def words():
    rnd = random.Random(7)
    parts = ["an", "re", "ti", "on", "st", "ed", "li", "mo", "ka", "su", "be", "fo"]
    vocabulary = ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 4))) for _ in range(900)]

    def make(n, seed):
        r = random.Random(seed)
        return [r.choice(vocabulary) for _ in range(n)]

    return make


@pytest.fixture(scope="session")
def frame(spark):
    def make(rows, schema="doc_id long, text string, lang string, source string, n_chars long"):
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture(scope="session")
def oddities(frame):
    """Null and empty texts, null ids, repeated rows, odd white space, long words, columns whose names the operators use."""
    texts = [None, "", " \n\t ", "a", "word " * 3, "x" * 5000, "é 日本   　 \U0001f600", "1 2 3 " * 400, "same text here for all of us", "same text here for all of us", "Line one.\nLine two!\n" * 30]
    rows = [(i, t, "en" if i % 2 else None, None, None, "kept", 1, 2.0, "f", "t") for i, t in enumerate(texts)]
    rows += [(None, "no id at all, but some words to read", None, None, None, "kept", 1, 2.0, "f", "t")] * 2 + [rows[8]] * 3
    return frame(rows, "doc_id long, text string, lang string, source string, n_chars long, key string, seed int, words double, _text string, ids string")


@pytest.fixture(scope="session")
def nothing(frame):
    return frame([])
