"""Run queries on Spark and their SQL on DuckDB and compare values, not only counts."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def oracle_connection(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    return repr(value)


def _table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(df, connection, sql: str) -> str | None:
    """None when equal, else a description of the first difference."""
    got_names = df.columns
    result = connection.execute(sql)
    want_names = [d[0] for d in result.description]
    if sorted(got_names) != sorted(want_names):
        return f"columns {sorted(got_names)} != {sorted(want_names)}"
    want = _table(want_names, result.fetchall())
    got = _table(got_names, [tuple(r) for r in df.collect()])
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    differing = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(differing)} rows differ, first {differing[0]}" if differing else None


def main(folder: str, names: list[str]) -> int:
    import __spark_entry__ as contract
    from trackloom.session import local_session

    spark = local_session()
    connection = oracle_connection(folder)
    queries, oracles = contract.queries(), contract.oracle_sql()
    failed = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            problem = compare(df, connection, oracles[name]) if name in oracles else f"rows only: {df.count()}"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(problem) and not problem.startswith("rows only")
        print(f"{name:20s} {time.time() - start:6.2f}s {problem or 'equal'}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
