"""Compare registered queries with their SQL: python -m tabloom.check SF_DIR [name part ...]"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

from tabloom.queries import REGISTRY, Tables

NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v) + 0.0:.9g}"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(_cell, v)) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{_cell(k)}:{_cell(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def canonical(rows, names) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for n in NAMES:
        con.execute(f"create view {n} as select * from read_parquet('{sf_dir}/{n}.parquet')")
    return con


def kinds_differ(df, cursor_types: list[str]) -> list[str]:
    """Column kinds that a strict schema comparison could object to."""
    simple = {
        "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean",
        "TIMESTAMP": "timestamp_ntz", "DATE": "date", "HUGEINT": "hugeint",
    }
    return [f"{n}: {k} / {d}" for (n, k), d in zip(df.dtypes, cursor_types) if simple.get(d, d) != k]


def compare(spark, con, sf_dir: str, name: str) -> tuple[str, float]:
    q = REGISTRY[name]
    start = time.time()
    df = q.run(Tables(spark, sf_dir))
    rows = df.collect()
    took = time.time() - start
    if q.sql is None:
        return f"rows {len(rows)}", took
    res = con.execute(q.sql)
    names = [d[0] for d in res.description]
    types = {d[0]: str(d[1]) for d in res.description}
    want = canonical(res.fetchall(), names)
    if sorted(names) != sorted(df.columns):
        return f"FAIL columns {sorted(df.columns)} / {sorted(names)}", took
    got = canonical(rows, df.columns)
    if got != want:
        a, b = set(got), set(want)
        return f"FAIL rows {len(got)} / {len(want)}; ours {sorted(a - b)[:3]}; theirs {sorted(b - a)[:3]}", took
    odd = kinds_differ(df, [types[c] for c in df.columns])
    return f"ok {len(got)}" + (f" (kinds {odd})" if odd else ""), took


def main(argv: list[str]) -> int:
    from tabloom.session import local_session

    sf_dir, parts = argv[0], argv[1:]
    spark = local_session(8, "tabloom-check")
    con = duck(sf_dir)
    bad = 0
    for name in REGISTRY:
        if parts and not any(name.startswith(p) for p in parts):
            continue
        try:
            verdict, took = compare(spark, con, sf_dir, name)
        except Exception as e:  # report and go on with the next query
            verdict, took = f"FAIL {type(e).__name__}: {str(e)[:600]}", 0.0
        bad += verdict.startswith("FAIL")
        print(f"{name:45s} {took:6.2f}s {verdict}", flush=True)
    print("failed:", bad)
    spark.stop()
    return int(bad > 0)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
