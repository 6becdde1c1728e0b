"""Run registered queries beside their SQL and compare row for row.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from datetime import datetime

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6f}".replace("-0.000000", "0.000000")
    if isinstance(value, datetime):
        return value.isoformat()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canonical(r[i]) for i in order) for r in rows), sorted(columns)


def compare(spark_rows, sql_rows) -> str:
    (got, got_columns), (want, want_columns) = spark_rows, sql_rows
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    if got != want:
        bad = [(g, w) for g, w in zip(got, want) if g != w]
        g, w = bad[0]
        return f"{len(bad)} rows differ, e.g. {str(g)[:300]} != {str(w)[:300]}"
    return "ok"


def check(spark, con, sf_dir, name, query, sql) -> tuple[str, int]:
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return "no sql", len(got[0])
    cursor = con.execute(sql)
    want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    return compare(got, want), len(got[0])


if __name__ == "__main__":
    import __spark_entry__ as entry
    from topictide.session import get_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g", spark__ui__enabled="false"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle, failed = duck(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            result, n = check(spark, con, sf_dir, name, query, oracle.get(name))
        except Exception as error:  # noqa: BLE001
            result, n = f"{type(error).__name__}: {str(error)[:600]}", -1
        failed += result not in ("ok", "no sql")
        print(f"{name:36s} {n:8d} {time.time() - start:6.1f}s {result}", flush=True)
    print("failed:", failed)
