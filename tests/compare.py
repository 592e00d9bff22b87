"""Compare every registered query with its SQL, the way the driver does."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def differences(query, sql, spark, sf_dir, connection) -> str | None:
    """None if both agree, else what differs."""
    frame = query(spark, sf_dir)
    names, mine = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = connection.execute(sql)
    theirs_names, theirs = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if names != theirs_names:
        return f"columns {set(names) ^ set(theirs_names)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} and {len(theirs)}"
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if wrong:
        a, b = wrong[0]
        cells = [(n, x[:200], y[:200]) for n, x, y in zip(names, a, b) if x != y]
        return f"{len(wrong)} of {len(mine)} rows, first: {cells}"
    return None


if __name__ == "__main__":
    from postlume.session import build_session
    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = build_session("compare", "local[8]", spark__ui__enabled="false",
                          spark__sql__shuffle__partitions="8")
    spark.sparkContext.setLogLevel("ERROR")
    connection, sqls = duck(folder), entry.oracle_sql()
    for name, query in entry.queries().items():
        if name not in sqls or (only and name not in only):
            continue
        start = time.time()
        try:
            outcome = differences(query, sqls[name], spark, folder, connection) or "same"
        except Exception as error:
            outcome = f"{type(error).__name__}: {str(error)[:700]}"
        print(f"@@ {name} {time.time() - start:.1f}s {outcome}", flush=True)
