"""Local stand-in for the driver's correctness gate: run a registered Spark query and
its oracle SQL in DuckDB over the same parquet tables, then compare row count,
column names and the order-insensitive multiset of rows (exact values)."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return float(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "float": "FLOAT", "array<double>": "DOUBLE[]",
                 "array<float>": "FLOAT[]"}


def compare(spark, name: str, sf_dir: str, con=None):
    from rankloom.queries import QUERIES
    from rankloom.oracle_sql import SQL
    df = QUERIES[name](spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    con = con or duck(sf_dir)
    rel = con.sql(SQL[name])
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    res = con.execute(SQL[name])
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    problems = []
    s_types = {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes}
    if s_types != d_types:
        problems.append(f"column types differ: spark={s_types} duckdb={d_types}")
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns differ: spark={s_cols} duckdb={d_cols}")
    if len(s_rows) != len(d_rows):
        problems.append(f"row count spark={len(s_rows)} duckdb={len(d_rows)}")
    if not problems:
        a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            problems.append(f"values differ, e.g. {diff}")
        else:
            # type classes must agree too (int vs float vs str)
            ta = [tuple(type(v).__name__ for v in r) for r in a[:50]]
            tb = [tuple(type(v).__name__ for v in r) for r in b[:50]]
            if ta != tb:
                problems.append(f"value types differ: {ta[:1]} vs {tb[:1]}")
    return len(s_rows), problems
