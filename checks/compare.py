"""Compare queries with their SQL: python -m checks.compare [folder] [query ...]."""

from __future__ import annotations

import sys
import time
import traceback

import duckdb

from checks.scenarios import ORACLE, QUERIES
from duebook.sources.sample import SAMPLE_TABLES


def normal(rows, names: list[str]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i].lower())
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def differences(spark, folder: str, key: str) -> tuple[str, int]:
    """What differs, or nothing, and the number of rows."""
    df = QUERIES[key](spark, folder)
    ours = df.collect()
    con = duckdb.connect()
    for table in SAMPLE_TABLES:
        con.sql(f"create view {table} as select * from read_parquet('{folder}/{table}.parquet')")
    result = con.sql(ORACLE[key])
    names, theirs = result.columns, result.fetchall()
    if sorted(n.lower() for n in names) != sorted(n.lower() for n in df.columns):
        return f"columns differ: {sorted(set(names) ^ set(df.columns))}", len(ours)
    a, b = normal(ours, df.columns), normal(theirs, names)
    if a == b:
        return "", len(ours)
    in_a, in_b = set(a), set(b)
    only_a, only_b = [r for r in a if r not in in_b][:2], [r for r in b if r not in in_a][:2]
    return f"rows {len(a)} and {len(b)}\n  ours  {only_a}\n  SQL   {only_b}\n  names {sorted(names, key=str.lower)}", len(ours)


def main(arguments: list[str]) -> int:
    from bench import session

    folder = arguments[0] if arguments else "/root/testdata/sf0.01"
    spark = session()
    bad = 0
    for key in arguments[1:] or QUERIES:
        start = time.time()
        try:
            text, rows = differences(spark, folder, key)
        except Exception:
            text, rows = traceback.format_exc(limit=3)[-1500:], 0
        bad += bool(text)
        print(f"{'DIFFERS' if text else 'same':8}{key:36}{rows:8} rows {time.time() - start:6.1f} s", flush=True)
        if text:
            print(text[:3000], flush=True)
    print(f"{bad} differ")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
