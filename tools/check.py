"""Run every query against its SQL check and report what differs.

    python tools/check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

from tidewatch import oracles, registry  # noqa: E402
from tidewatch.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _value(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 6)
    return x


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_value(row[i]) for i in order) for row in rows]
    return sorted(names), sorted(plain, key=lambda r: [(v is None, str(v)) for v in r])


def compare(spark, con, sf_dir: str, query, sql: str):
    """``(message, rows, seconds in Spark)``; the message is empty if both agree."""
    start = time.time()
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - start
    result = con.execute(sql)
    want = rows_of([d[0] for d in result.description], result.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}", len(got[1]), took
    if got[1] != want[1]:
        extra = [r for r in got[1] if r not in set(want[1])][:2]
        lost = [r for r in want[1] if r not in set(got[1])][:2]
        return f"{len(got[1])} rows != {len(want[1])}; only Spark {extra}; only SQL {lost}", len(got[1]), took
    types = [type(a) for r in got[1][:1] for a in r], [type(a) for r in want[1][:1] for a in r]
    return ("" if types[0] == types[1] else f"types {types}"), len(got[1]), took


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    wanted = sys.argv[2:]
    spark, con = local_session(8), connect(sf_dir)
    sqls, bad = oracles.oracle_sql(), 0
    for name, query in registry.queries().items():
        if wanted and name not in wanted:
            continue
        if name not in sqls:
            print(f"{name}: no SQL", flush=True)
            continue
        try:
            message, n, took = compare(spark, con, sf_dir, query, sqls[name])
        except Exception as error:  # report and go on with the next query
            message, n, took = f"{type(error).__name__}: {str(error)[:600]}", 0, 0.0
        bad += bool(message)
        print(f"{name}: {'ok' if not message else 'DIFFERS ' + message} ({n} rows, {took:.1f} s)", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main())
