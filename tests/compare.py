"""Run registered queries next to their check SQL: ``python tests/compare.py [folder] [name part ...]``."""

from __future__ import annotations

import datetime as dt
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def open_tables(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day).isoformat()
    if isinstance(value, float):
        return "nan" if value != value else repr(value + 0.0)
    return repr(value)


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = tuple(columns[i] for i in order)
    return names, sorted(tuple(plain(r[i]) for i in order) for r in records)


def compare(spark, con, query, sql, folder):
    """Empty string if both sides agree, else what differs."""
    df = query(spark, folder)
    left = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    right = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"{len(left[1])} rows, expected {len(right[1])}"
    bad = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
    if bad:
        return f"{len(bad)} of {len(left[1])} rows differ, e.g.\n   {bad[0][0]}\n   {bad[0][1]}"
    if not left[1]:
        print("   (no rows)")
    return ""


def main():
    from __spark_entry__ import oracle_sql, queries
    from encore.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = open_tables(folder)
    oracles, failed = oracle_sql(), []
    chosen = {k: v for k, v in queries().items() if not parts or any(p in k for p in parts)}
    for name, query in chosen.items():
        start = time.time()
        try:
            if name in oracles:
                message = compare(spark, con, query, oracles[name], folder)
            else:
                message, n = "", len(query(spark, folder).collect())
                print(f"-- {name}: {n} rows, no SQL ({time.time() - start:.1f}s)", flush=True)
                continue
        except Exception as error:
            message = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok' if not message else 'BAD'} {name} ({time.time() - start:.1f}s) {message}", flush=True)
        if message:
            failed.append(name)
    print(f"{len(chosen) - len(failed)} of {len(chosen)} agree; failed: {failed}")
    spark.stop()


if __name__ == "__main__":
    main()
