"""Compare registered queries with their SQL on DuckDB.

Usage: python tests/oracle_check.py FOLDER [QUERY ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return duck


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(repr(row[i]) for i in order) for row in rows))


def differences(spark, duck, query, sql: str, folder: str) -> list[str]:
    """What differs, empty if nothing does."""
    frame = query(spark, folder)
    ours = _rows(frame.columns, frame.collect())
    cursor = duck.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = _rows(names, cursor.fetchall())
    found = []
    if sorted(frame.columns) != sorted(names):
        found.append(f"columns {sorted(frame.columns)} against {sorted(names)}")
    if len(ours) != len(theirs):
        found.append(f"{len(ours)} rows against {len(theirs)}")
    if ours != theirs:
        found += [f"only here: {row}" for row in sorted(set(ours) - set(theirs))[:2]]
        found += [f"only there: {row}" for row in sorted(set(theirs) - set(ours))[:2]]
        found = found or ["number of copies differs"]
    return found


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from fleetpulse.session import local_session

    folder, *wanted = sys.argv[1:]
    spark, duck = local_session(8), connect(folder)
    failed = 0
    sql = oracle_sql()
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        began = time.time()
        try:
            if name in sql:
                found = differences(spark, duck, query, sql[name], folder)
            else:
                found = [] if query(spark, folder).count() else ["no rows"]
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(found)
        print(f"{'DIFF' if found else 'ok  '} {name} {time.time() - began:.1f}s", *found, sep="\n     ", flush=True)
    print(f"{failed} differ")
    return failed


if __name__ == "__main__":
    sys.exit(main())
