"""Run registered queries and their SQL side by side.

``python tests/compare.py [sf_dir] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def cell(value: object) -> str:
    if value is None:
        return "∅"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return repr(value)


def table(columns: list[str], rows: list) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    from __spark_entry__ import oracle_sql, queries
    start = time.time()
    df = queries()[name](spark, sf_dir)
    rows = df.collect()
    took = time.time() - start
    sql = oracle_sql().get(name)
    if sql is None:
        return True, f"{len(rows)} rows, no SQL, {took:.1f}s"
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    expected = table(columns, cursor.fetchall())
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(columns)}"
    got = table(df.columns, rows)
    if got != expected:
        diff = [(g, e) for g, e in zip(got, expected) if g != e][:3]
        return False, f"{len(got)} rows against {len(expected)}; first differences {diff}"
    return True, f"{len(got)} rows equal, {took:.1f}s"


if __name__ == "__main__":
    from rotorlens.session import build_session
    from __spark_entry__ import queries
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = build_session("local[8]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for query in sys.argv[2:] or list(queries()):
        try:
            ok, text = compare(session, con, query, sf)
        except Exception as error:
            ok, text = False, f"{type(error).__name__}: {str(error)[:600]}"
        bad += not ok
        print("ok  " if ok else "FAIL", query, text, flush=True)
    print("failed:", bad)
