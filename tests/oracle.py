"""Side-by-side comparison of the registered queries with DuckDB.

Run as a script: ``python tests/oracle.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def compare(spark, db, query, sql, sf_dir):
    """Difference as text, or None when names, types of values and rows agree."""
    frame = query(spark, sf_dir)
    got_names, got = _sorted(frame.columns, [tuple(r) for r in frame.collect()])
    if sql is None:
        return None if got else "no rows"
    result = db.execute(sql)
    names, want = _sorted([d[0] for d in result.description], result.fetchall())
    if got_names != names:
        return f"columns {got_names} != {names}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for a, b in zip(got, want):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} != {b}"
    return None if got else "no rows"


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from dossierlake.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = build_session(
        master="local[8]",
        conf={"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
              "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, sql, bad = connect(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if chosen and not any(name.startswith(c) for c in chosen):
            continue
        started = time.time()
        try:
            problem = compare(spark, db, query, sql.get(name), sf_dir)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        took = time.time() - started
        print(f"{'ok ' if problem is None else 'BAD'} {took:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{bad} problems")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
