"""Run catalogue queries on Spark and their oracle SQL on DuckDB and compare
(row count, column names, order-insensitive values)."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from ..sources.tables import TEST_TABLES
from . import catalog


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TEST_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, sf_dir: str, name: str, con=None) -> tuple[bool, str]:
    q = catalog.REGISTRY[name]
    t0 = time.time()
    sdf = catalog.run(name, spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    s_cols = sdf.columns
    t1 = time.time()
    if q.sql is None:
        return True, f"rows={len(s_rows)} (no oracle) spark={t1 - t0:.1f}s"
    con = con or duck(sf_dir)
    res = con.execute(q.sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}"
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duck={len(d_rows)}"
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return False, f"{len(bad)} rows differ, e.g.\n  spark={bad[0][0]}\n  duck ={bad[0][1]}"
    return True, f"rows={len(s_rows)} spark={t1 - t0:.1f}s"


def main(argv: list[str]) -> int:
    from ..session import get_spark
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(catalog.REGISTRY)
    spark = get_spark()
    con = duck(sf_dir)
    failed = 0
    for n in names:
        try:
            ok, msg = compare(spark, sf_dir, n, con)
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:400]}"
        failed += not ok
        print(f"{'OK ' if ok else 'BAD'} {n}: {msg}", flush=True)
    print(f"{len(names) - failed}/{len(names)} match")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
