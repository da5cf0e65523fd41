"""Run reports in Spark and their SQL in DuckDB and compare rows.

Usage: python -m tests.compare <sf_dir> [name ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(v):
    if isinstance(v, Decimal):
        return ("n", float(v))
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, float):
        return ("nan",) if math.isnan(v) else ("n", v + 0.0)
    if isinstance(v, int):
        return ("n", float(v)) if abs(v) < 2**53 else ("i", v)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return (type(v).__name__, str(v)) if v is not None else ("null",)


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def differences(spark, con, sf_dir: str, name: str, fn, sql: str | None) -> list[str]:
    out = fn(spark, sf_dir)
    got_types = {c: t for c, t in out.dtypes}
    names = sorted(got_types)
    got = [tuple(plain(r[c]) for c in names) for r in out.collect()]
    if sql is None:
        return [] if got else ["no rows"]
    want_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    if sorted(want_types) != names:
        return [f"columns {names} against {sorted(want_types)}"]
    cur = con.execute(sql)
    pos = {d[0]: i for i, d in enumerate(cur.description)}
    want = [tuple(plain(r[pos[c]]) for c in names) for r in cur.fetchall()]
    faults = [
        f"type of {c}: {got_types[c]} against {want_types[c]}"
        for c in names
        if KINDS.get(got_types[c]) != want_types[c]
    ]
    a, b = Counter(got), Counter(want)
    if a != b:
        faults.append(f"rows {len(got)} against {len(want)}; only Spark {list((a - b).items())[:2]}; only SQL {list((b - a).items())[:2]}")
    if not got:
        faults.append("no rows")
    return faults


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from millrace.session import session

    sf_dir, *only = sys.argv[1:]
    spark, con = session("compare"), connect(sf_dir)
    sqls, bad = oracle_sql(), 0
    for name, fn in queries().items():
        if only and name not in only:
            continue
        began = time.time()
        try:
            faults = differences(spark, con, sf_dir, name, fn, sqls.get(name))
        except Exception as e:  # noqa: BLE001
            faults = [f"{type(e).__name__}: {str(e)[:1500]}"]
        bad += bool(faults)
        print(f"{'FAIL' if faults else 'ok  '} {name} {time.time() - began:.2f}s {'' if name in sqls else '(rows only)'}", *faults, sep="\n      " if faults else " ", flush=True)
    print(f"{bad} failing")
    spark.stop()


if __name__ == "__main__":
    main()
