"""Run a registered query and its SQL on the same tables and compare rows and types.

As a script: ``python tests/compare.py [folder] [query ...]``.
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

FOLDER = "/root/testdata/sf0.01"
_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "boolean": "BOOLEAN", "smallint": "SMALLINT",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, folder: str, fn, sql: str | None) -> str:
    """Empty when equal, else what differs."""
    df = fn(spark, folder)
    got = df.collect()
    if sql is None:
        return "" if got else "no rows"
    result = connect(folder).execute(sql)
    names = [d[0] for d in result.description]
    want = result.fetchall()
    problems = []
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    types = dict(zip(names, (str(d[1]) for d in result.description)))
    for name, kind in df.dtypes:
        if _TYPES.get(kind, kind) != types[name]:
            problems.append(f"type of {name}: {kind} vs {types[name]}")
    if len(got) != len(want):
        problems.append(f"rows {len(got)} vs {len(want)}")
    a, b = _rows(df.columns, got), _rows(names, want)
    if a != b:
        different = [(x, y) for x, y in zip(a, b) if x != y][:3]
        problems.append(f"values differ ({sum(x != y for x, y in zip(a, b))}): {different}")
    return "; ".join(problems)


def main() -> None:
    import __spark_entry__ as entry
    from fleet.session import build_session

    args = sys.argv[1:]
    folder = args.pop(0) if args and os.path.isdir(args[0]) else FOLDER
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    sql = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if args and name not in args:
            continue
        start = time.time()
        try:
            problem = compare(spark, folder, fn, sql.get(name))
        except Exception as failure:
            problem = f"{type(failure).__name__}: {str(failure)[:1500]}"
        bad += bool(problem)
        kind = "sql " if name in sql else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {time.time() - start:6.2f}s {name} {problem}", flush=True)
    print("failures", bad)


if __name__ == "__main__":
    main()
