"""Compare registered queries with their check SQL, values and types."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _kind(value) -> str:
    if isinstance(value, bool):
        return "bool"
    return type(value).__name__


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return "null" if value is None else str(value)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def kinds(columns, rows):
    found = {c: set() for c in columns}
    for row in rows:
        for c, v in zip(columns, row):
            if v is not None:
                found[c].add(_kind(v))
    return found


def check(spark, con, run, sql, sf_dir):
    df = run(spark, sf_dir)
    ours = [tuple(r) for r in df.collect()]
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    assert sorted(df.columns) == sorted(names), (df.columns, names)
    a, b = normal(df.columns, ours)[1], normal(names, theirs)[1]
    assert len(a) == len(b), f"{len(a)} rows, expected {len(b)}"
    different = [(x, y) for x, y in zip(a, b) if x != y]
    assert not different, f"{len(different)} rows differ in {sorted(names)}, first {different[:2]}"
    ka, kb = kinds(df.columns, ours), kinds(names, theirs)
    assert ka == kb, {c: (ka[c], kb[c]) for c in ka if ka[c] != kb[c]}
    return len(ours)


if __name__ == "__main__":
    import __spark_entry__ as E
    from wardwatch.session import build_session

    sf = sys.argv[1]
    only = sys.argv[2:]
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    failed = 0
    for name, run in E.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            sql = E.oracle_sql().get(name)
            n = check(spark, con, run, sql, sf) if sql else f"{len(run(spark, sf).collect())} (no SQL)"
            print(f"ok   {name} rows={n} {time.time() - start:.2f}s", flush=True)
        except Exception as error:
            failed += 1
            print(f"FAIL {name} {type(error).__name__}: {str(error)[:700]}", flush=True)
    print("failed", failed)
