"""Run registered queries and their SQL on the same tables and compare the results.

Usage: python tests/oracle.py [sf] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """DuckDB with every test table as a view."""
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if value is None:
        return ("null",)
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, float):
        if math.isnan(value):
            return ("nan",)
        return ("float", value + 0.0)
    if isinstance(value, (list, tuple)):
        return ("list", tuple(_cell(v) for v in value))
    if isinstance(value, int):
        return ("int", value)
    return (type(value).__name__, str(value))


def rows_of(columns: list[str], rows) -> list[tuple]:
    """Rows as sorted tuples in column-name order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(con, sql: str, df) -> str | None:
    """None if both results agree, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = rows_of(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns: sql only {sorted(set(names) - set(df.columns))}, spark only {sorted(set(df.columns) - set(names))}"
    got = rows_of(df.columns, df.collect())
    if len(got) != len(want):
        return f"rows: spark {len(got)}, sql {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        cells = [(n, a, b) for n, a, b in zip(sorted(names), *bad[0]) if a != b]
        return f"{len(bad)} of {len(got)} rows differ, first: {cells[:6]}"
    return None


def main() -> int:
    from ledgerloom.plans.registry import QUERIES, SQL
    from ledgerloom.session import build_session

    args = sys.argv[1:]
    sf = args[0] if args else "0.01"
    names = args[1:] or list(QUERIES)
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session("oracle", "local[8]", 8, {"spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = []
    for name in names:
        started = time.perf_counter()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in SQL:
                problem = compare(con, SQL[name], df)
                note = "ok" if problem is None else f"MISMATCH {problem}"
            else:
                problem, note = None, f"rows {df.count()}"
        except Exception as error:  # noqa: BLE001
            problem = note = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        if problem:
            failed.append(name)
        print(f"{time.perf_counter() - started:6.2f}s {name}: {note}", flush=True)
    print(f"{len(names)} queries, {len(failed)} failed: {failed}")
    return bool(failed)


if __name__ == "__main__":
    raise SystemExit(main())
