"""Side-by-side check of a Spark result against a DuckDB oracle query.

Rows are compared as an order-insensitive multiset of exact values
(floats bit for bit, -0.0 distinct from 0.0; lists and structs as tuples,
ints as floats); columns are matched by name.
"""

from __future__ import annotations

import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sql: str, sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return names, cur.fetchall()


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, int):
        return repr(float(v))
    if isinstance(v, dict):
        return tuple(norm(x) for x in v.values())
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark_df, sql: str, sf_dir: str):
    s_names = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    d_names, d_rows = duck(sql, sf_dir)
    problems = []
    if sorted(s_names) != sorted(d_names):
        problems.append(f"columns differ: spark={sorted(s_names)} duck={sorted(d_names)}")
        return problems, len(s_rows), len(d_rows)
    a, b = rows_of(s_names, s_rows), rows_of(d_names, d_rows)
    if len(a) != len(b):
        problems.append(f"row count spark={len(a)} duck={len(b)}")
    if a != b:
        sa, sb = set(a), set(b)
        only_s = [r for r in a if r not in sb][:3]
        only_d = [r for r in b if r not in sa][:3]
        problems.append(f"values differ; spark-only={only_s} duck-only={only_d}")
    return problems, len(a), len(b)
