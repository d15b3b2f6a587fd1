"""Runs named queries on Spark and their SQL on DuckDB and compares the rows.

    python -m tests.oracle_check [--sf DIR] [query ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    return value


def _rows(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(
        tuple(_plain(row[i]) for i in order) for row in rows
    )


def compare(spark, con, sf_dir: str, query, sql: str) -> tuple[int, str | None]:
    """Number of rows and a description of the first difference, if any."""
    df = query(spark, sf_dir)
    got_columns, got = _rows(df.columns, df.collect())
    result = con.execute(sql)
    want_columns, want = _rows([d[0] for d in result.description], result.fetchall())
    n = sum(got.values())
    if got_columns != want_columns:
        return n, f"columns {got_columns} != {want_columns}"
    if got != want:
        extra, missing = got - want, want - got
        return n, (
            f"{n} rows against {sum(want.values())}; {sum(extra.values())} unexpected, e.g."
            f" {next(iter(extra), None)}; {sum(missing.values())} missing, e.g."
            f" {next(iter(missing), None)}"
        )
    return n, None


def main() -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry
    from tests.session import local_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()

    spark, con = local_session(8), connect(args.sf)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in args.names or queries:
        start = time.time()
        if name not in oracles:
            n, problem = queries[name](spark, args.sf).count(), "no SQL"
        else:
            n, problem = compare(spark, con, args.sf, queries[name], oracles[name])
            failed += problem is not None
        print(f"{name:24} {n:8} rows {time.time() - start:6.2f}s  {problem or 'equal'}", flush=True)
    spark.stop()
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
