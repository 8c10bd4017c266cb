"""Run a registered query and its SQL on the same tables and compare them strictly."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {name} as select * from '{path}'")
    return con


def cell(value):
    if value is None:
        return ""
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def compare(df, con, text, show: int = 4):
    """(problem or None, number of rows)."""
    spark_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(text)
    names = [c[0] for c in cur.description]
    duck_rows = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(spark_rows)
    a, b = rows_of(df.columns, spark_rows), rows_of(names, duck_rows)
    if len(a) != len(b):
        sa, sb = set(a), set(b)
        return f"rows {len(a)} != {len(b)}; only spark {sorted(sa - sb)[:show]} only sql {sorted(sb - sa)[:show]}", len(a)
    if a != b:
        sa, sb = set(a), set(b)
        return f"{len(sa - sb)} of {len(a)} rows differ ({sorted(names)}); spark {sorted(sa - sb)[:show]} sql {sorted(sb - sa)[:show]}", len(a)
    return None, len(a)
