"""Run every registered query beside its SQL in DuckDB and compare the rows.

usage: check_oracles.py [folder] [name-part ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def comparable(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, float(value))
    if isinstance(value, (int, float)) or hasattr(value, "as_tuple"):
        number = float(value)
        return (2, "nan") if math.isnan(number) else (1, round(number, 6))
    return (3, str(value))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(comparable(row[i]) for i in order) for row in rows)


def open_tables(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def compare(spark, con, folder, run, sql) -> tuple[str, float, int]:
    started = time.time()
    df = run(spark, folder)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - started
    if sql is None:
        return "rows only", took, len(got)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"COLUMNS {sorted(df.columns)} against {sorted(names)}", took, len(got)
    mine, other = rows_of(df.columns, got), rows_of(names, result.fetchall())
    if mine == other:
        return "ok" if mine else "EMPTY", took, len(got)
    only_mine = [r for r in mine if r not in set(other)][:2]
    only_other = [r for r in other if r not in set(mine)][:2]
    return f"DIFFERENT {len(mine)} against {len(other)}\n   spark {only_mine}\n   sql   {only_other}", took, len(got)


def main() -> int:
    from leadmill import catalog
    from leadmill.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = local_session("check", 8)
    con = open_tables(folder)
    bad = 0
    for name, q in catalog.QUERIES.items():
        if wanted and not any(w in name for w in wanted):
            continue
        try:
            said, took, rows = compare(spark, con, folder, q.run, q.sql)
        except Exception as error:  # noqa: BLE001 - reported, counted, and the next query runs
            said, took, rows = f"ERROR {type(error).__name__} {str(error)[:600]}", 0.0, 0
        bad += said not in ("ok", "rows only")
        print(f"{name:32} {rows:8} rows {took:6.2f}s  {said}", flush=True)
    print(f"{bad} not matching")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
