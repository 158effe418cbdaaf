"""Run catalogue queries against their SQL twins and compare rows as multisets.

Usage: python tests/compare.py [folder] [query ...]
"""

from __future__ import annotations

import sys
import time
import traceback
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if value != value else round(value, 6) + 0.0
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(df, con, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    expected = rows_of(names, result.fetchall())
    found = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if expected == found:
        return None
    extra, missing = found - expected, expected - found
    return (
        f"rows {sum(found.values())} vs {sum(expected.values())}; "
        f"only spark {[str(r)[:300] for r in list(extra)[:2]]}; only sql {[str(r)[:300] for r in list(missing)[:2]]}"
    )


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from roleweave.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    chosen = sys.argv[2:]
    spark = build_session(
        "compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = oracle_connection(folder), oracle_sql(), 0
    for name, query in queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            problem = difference(df, con, sql[name]) if name in sql else f"rows-only {df.count()}"
        except Exception as exc:
            problem = f"EXCEPTION {str(exc)[:1500]}"
            if chosen:
                traceback.print_exc()
        ok = problem is None or problem.startswith("rows-only")
        failed += not ok
        print(f"{'ok  ' if ok else 'DIFF'} {name:26} {time.time() - start:6.2f}s {problem or ''}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
