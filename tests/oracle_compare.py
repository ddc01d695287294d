"""Compare a Spark query with its DuckDB oracle the way the driver does:
row count, column names (sorted) and an order-insensitive hash of values."""

from __future__ import annotations

import hashlib
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(round(v, 6))
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def digest(columns: list[str], rows: list[tuple]) -> tuple[int, list[str], str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return len(rows), [columns[i] for i in order], h


def spark_digest(df):
    rows = [tuple(r) for r in df.collect()]
    return digest(df.columns, rows)


def oracle_digest(con, sql: str):
    rel = con.sql(sql)
    cols = rel.columns
    return digest(cols, rel.fetchall())


def compare(spark, con, sf_dir, fn, sql):
    s = spark_digest(fn(spark, sf_dir))
    o = oracle_digest(con, sql)
    return s, o
