"""Runs queries on Spark and their SQL on DuckDB and compares schema and values.

    python -m tests.compare [--dir FOLDER] [name ...]
"""

from __future__ import annotations

import argparse
import sys
import time
from collections import Counter

import duckdb
import pyarrow as pa

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _kind(t: pa.DataType) -> str:
    if pa.types.is_large_string(t) or pa.types.is_string(t) or pa.types.is_null(t):
        return "string"
    return str(t)


def _rows(table: pa.Table) -> Counter:
    names = sorted(table.column_names)
    columns = [
        [repr(v) if isinstance(v, float) else v for v in table.column(n).to_pylist()] for n in names
    ]
    return Counter(zip(*columns)) if columns else Counter()


def compare(got: pa.Table, want: pa.Table) -> str | None:
    """None when equal, else what differs first."""
    mine = {f.name: _kind(f.type) for f in got.schema}
    theirs = {f.name: _kind(f.type) for f in want.schema}
    if mine != theirs:
        return f"schema {sorted(set(mine.items()) ^ set(theirs.items()))}"
    a, b = _rows(got), _rows(want)
    if a != b:
        left, right = list((a - b).elements()), list((b - a).elements())
        key = lambda r: tuple(str(v) for v in r)
        left.sort(key=key), right.sort(key=key)
        return (
            f"{got.num_rows} vs {want.num_rows} rows, {len(left)}/{len(right)} differ: "
            f"{sorted(mine)}\n   spark {left[:2]}\n   duck  {right[:2]}"
        )
    return None


def main() -> int:
    from larder.session import build_session

    import __spark_entry__ as entry

    parser = argparse.ArgumentParser()
    parser.add_argument("--dir", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = build_session(
        "compare", "local[8]", **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g",
                                  "spark.sql.shuffle.partitions": "8"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, checks, bad = duck(args.dir), entry.queries(), entry.oracle_sql(), 0
    for name in args.names or queries:
        start = time.time()
        try:
            got = queries[name](spark, args.dir).toArrow()
            took = time.time() - start
            if name not in checks:
                print(f"rows {name}: {got.num_rows} {got.slice(0, 2).to_pylist()} {took:.1f}s", flush=True)
                continue
            start = time.time()
            want = con.sql(checks[name]).to_arrow_table()
            duck_took = time.time() - start
            problem = compare(got, want)
        except Exception as error:  # report and go on with the next query
            problem, took, duck_took = f"{type(error).__name__}: {str(error)[:1500]}", 0.0, 0.0
            got = None
        if problem:
            bad += 1
            print(f"BAD  {name}: {problem}", flush=True)
        else:
            print(f"ok   {name}: {got.num_rows} rows {took:.1f}s duck {duck_took:.1f}s", flush=True)
    print(f"{bad} differ")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
