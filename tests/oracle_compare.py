"""Run a registered query on Spark and its oracle SQL on DuckDB; compare the results.

Usable as a script: ``python tests/oracle_compare.py [sf_dir] [key ...]``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time

import duckdb

STAR_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in STAR_TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _key(row):
    return tuple((v is None, str(type(v).__name__) if v is not None else "", v if v is not None else 0)
                 for v in row)


def normalise(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return cols, sorted(out, key=_key)


def spark_rows(spark, fn, sf_dir: str):
    df = fn(spark, sf_dir)
    return df.columns, [tuple(r) for r in df.collect()]


def duck_rows(con, sql: str):
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    return cols, [tuple(r) for r in res.fetchall()]


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> tuple[bool, str]:
    s_cols, s_rows = normalise(*spark_rows(spark, fn, sf_dir))
    d_cols, d_rows = normalise(*duck_rows(con, sql))
    if s_cols != d_cols:
        return False, f"columns differ: spark {s_cols} duckdb {d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"row count differs: spark {len(s_rows)} duckdb {len(d_rows)}"
    if s_rows != d_rows:
        diff = [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:3]
        return False, f"values differ, e.g. {diff}"
    return True, f"{len(s_rows)} rows"


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from roadlens.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    keys = argv[1:] or sorted(entry.queries())
    spark = build_session("local[4]", shuffle_partitions=4)
    con = duck_connection(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in keys:
        t0 = time.time()
        if name not in oracles:
            print(f"{name:28s} NO ORACLE")
            continue
        try:
            ok, msg = compare(spark, con, name, queries[name], oracles[name], sf_dir)
        except Exception as exc:  # noqa: BLE001
            ok, msg = False, f"error {type(exc).__name__}: {str(exc)[:300]}"
        bad += not ok
        print(f"{name:28s} {'OK ' if ok else 'BAD'} {time.time() - t0:6.2f}s {msg}", flush=True)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
