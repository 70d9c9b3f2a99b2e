"""Side-by-side check of the registered queries against DuckDB."""
from __future__ import annotations

import math

import duckdb

from cohortqc.workload.views import TABLES


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if hasattr(value, "as_integer_ratio") and not isinstance(value, (int, bool)):
        return round(float(value), 6)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def spark_rows(df):
    return df.columns, [tuple(r) for r in df.collect()]


def duck_rows(con, sql):
    cursor = con.execute(sql)
    return [d[0] for d in cursor.description], cursor.fetchall()
