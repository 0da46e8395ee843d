"""Run registered queries and their oracles side by side.

usage: python tools/check.py [--dir DIR] [name ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from textloom.queries import ORACLES, QUERIES  # noqa: E402
from textloom.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def join_without_key(df):
    """The name of a join operator that pairs rows without a key, if the executed plan has one."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return next((op for op in ("CartesianProduct", "BroadcastNestedLoopJoin") if op in plan), None)


def compare(spark, con, name, sf_dir):
    """None when the plan is sound and the rows are equal, else the first problem found."""
    df = QUERIES[name](spark, sf_dir)
    ours = rows_of(df.columns, df.collect())
    if join_without_key(df):
        return f"plan has {join_without_key(df)}"
    if name not in ORACLES:
        return None if ours else "no rows"
    result = con.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    theirs = rows_of(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} / {sorted(columns)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            cells = [(x[:300], y[:300]) for x, y in zip(a, b) if x != y]
            bad = sum(x != y for x, y in zip(ours, theirs))
            return f"{bad} of {len(ours)} rows differ, first {a[0][:40]}: {cells}"
    return None


def main():
    parser = argparse.ArgumentParser()
    parser.add_argument("--dir", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark, con = local_session(), oracle_connection(args.dir)
    failed = []
    for name in args.names or QUERIES:
        start = time.time()
        try:
            problem = compare(spark, con, name, args.dir)
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        kind = "sql" if name in ORACLES else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
        if problem:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
