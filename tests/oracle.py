"""Side-by-side comparison of a Spark query with its DuckDB oracle, in the
driver's manner: row count, column names and an order-insensitive value hash."""

from __future__ import annotations

import hashlib
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v:.9g}"
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if type(v).__name__ == "date" else v.isoformat()
    return repr(v) if v is not None else "NULL"


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


# DuckDB type names as Spark's
TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
    "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz",
}


def compare(spark_df, con, sql):
    s_cols = spark_df.columns
    s_types = dict(spark_df.dtypes)
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_types = {c: TYPES.get(str(t).split("(")[0], str(t)) for c, t in zip(rel.columns, rel.types)}
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    return {
        "types_match": s_types == d_types,
        "types": (s_types, d_types),
        "rows": (len(s_rows), len(d_rows)),
        "columns_match": sorted(s_cols) == sorted(d_cols),
        "columns": (s_cols, d_cols),
        "values_match": digest(s_cols, s_rows) == digest(d_cols, d_rows),
        "spark_rows": s_rows,
        "duck_rows": d_rows,
    }
