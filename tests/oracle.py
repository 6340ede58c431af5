"""Side-by-side check of a query and its SQL: python -m tests.oracle [folder] [name ...]"""

from __future__ import annotations

import os
import sys
import time
from datetime import datetime
from decimal import Decimal

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, bool) or value is None:
        return repr(value)
    if isinstance(value, Decimal):
        return f"dec:{value.normalize():f}"
    if isinstance(value, float):
        return f"float:{value:.9g}"
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def problem(spark_df, connection, sql: str) -> str | None:
    """None when both sides agree."""
    result = connection.execute(sql)
    names = [c[0] for c in result.description]
    wide = [c[0] for c in result.description if "HUGEINT" in str(c[1]).upper()]
    if wide:
        return f"SQL gives HUGEINT for {wide}"
    want_names, want = rows_of(names, result.fetchall())
    have_names, have = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if want_names != have_names:
        return f"columns: spark {have_names} sql {want_names}"
    if len(want) != len(have):
        return f"rows: spark {len(have)} sql {len(want)}"
    for a, b in zip(have, want, strict=True):
        if a != b:
            return f"first difference: spark {str(a)[:300]} sql {str(b)[:300]}"
    return None


def main() -> None:
    import __spark_entry__ as entry
    from noticeflow.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    wanted = sys.argv[2:]
    spark = local_session(8)
    connection = duck(folder)
    sql, bad = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in sql:
                trouble = problem(query(spark, folder), connection, sql[name])
            else:
                trouble = None if query(spark, folder).collect() else "no rows"
        except Exception as error:  # report and go on with the next query
            trouble = f"{type(error).__name__}: {str(error)[:600]}"
        bad += trouble is not None
        print(f"{'ok  ' if trouble is None else 'FAIL'} {name} {time.time() - start:.1f}s {trouble or ''}", flush=True)
    print(f"{bad} problems")
    spark.stop()


if __name__ == "__main__":
    os.environ.setdefault("PYTHONPATH", os.getcwd())
    main()
