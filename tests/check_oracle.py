"""Run every query against its SQL twin: python tests/check_oracle.py [sf_dir] [name …]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(_plain(row[i])) for i in order) for row in rows)


def _plain(value):
    return float(value) if isinstance(value, float) else value


def oracle(sf: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def compare(spark, con, sf: str, name: str):
    """None when the rows agree, else what differs."""
    df = entry.queries()[name](spark, sf)
    rows = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None if rows else "no rows"
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {df.columns} != {names}"
    got, want = canonical(rows, df.columns), canonical(expected, names)
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"{a} != {b}"
    return None if rows else "no rows on either side"


def main():
    from tests.conftest import make_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark, con = make_session(), oracle(sf)
    failed = []
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, sf, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - start:6.1f}s {name} {problem or ''}", flush=True)
        if problem:
            failed.append(name)
    print(f"{len(names) - len(failed)}/{len(names)} ok; failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
