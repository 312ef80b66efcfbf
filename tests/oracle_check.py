"""Run registered queries beside their DuckDB form and compare columns, types and rows.

    python tests/oracle_check.py [sf folder] [query name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET threads TO 4")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if v is None:
        return ("null",)
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, (int, decimal.Decimal)):
        return ("num", format(decimal.Decimal(v).normalize(), "f"))
    if isinstance(v, float):
        return ("nan",) if math.isnan(v) else ("float", repr(v + 0.0))
    if isinstance(v, (dt.datetime, dt.date)):
        return ("date", v.isoformat())
    if isinstance(v, (list, tuple)):
        return ("list", *[plain(x) for x in v])
    return ("text", str(v))


SAME = {
    "int": "INTEGER", "bigint": "BIGINT", "smallint": "SMALLINT", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def type_name(spark_type: str) -> str:
    return SAME.get(spark_type, spark_type.upper())


def compare(spark, con, query, sql: str, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    df = query(spark, sf_dir)
    cur = con.execute(sql)
    types = {d[0]: str(d[1]) for d in cur.description}
    theirs_rows = cur.fetchall()
    names = sorted(df.columns)
    if names != sorted(types):
        return f"columns {names} vs {sorted(types)}"
    got = {n: type_name(t) for n, t in df.dtypes}
    bad_types = {n: (got[n], types[n]) for n in names if got[n] != types[n]}
    order = list(types)
    mine = sorted([tuple(plain(r[n]) for n in names) for r in df.collect()], key=repr)
    theirs = sorted([tuple(plain(r[order.index(n)]) for n in names) for r in theirs_rows], key=repr)
    if len(mine) != len(theirs):
        return f"rows {len(mine)} vs {len(theirs)}"
    for a, b in zip(mine, theirs, strict=True):
        if a != b:
            diff = [(n, x, y) for n, x, y in zip(names, a, b, strict=True) if x != y]
            return f"values: {diff[:3]}"
    return f"types {bad_types}" if bad_types else None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from quayside.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session("oracle-check")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    queries, sql = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            if name in sql:
                problem = compare(spark, con, queries[name], sql[name], sf)
            else:
                problem = None if queries[name](spark, sf).count() else "no rows"
        except Exception as e:  # report and go on
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{failed} failed; without SQL: {sorted(set(queries) - set(sql))}; SQL without query: {sorted(set(sql) - set(queries))}")
    sys.exit(1 if failed else 0)
