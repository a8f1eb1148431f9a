"""Spark-vs-DuckDB comparison in the spirit of the driver's correctness gate."""

from __future__ import annotations

import math

import duckdb

from roomrate.sources.fixture_sql import DRIVER_TABLES

ALL_DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

SPARK_TO_DUCK = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "boolean": "BOOLEAN", "float": "FLOAT",
    "smallint": "SMALLINT", "tinyint": "TINYINT",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in ALL_DRIVER_TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if math.isinf(v):
            return "inf" if v > 0 else "-inf"
        return round(v, 6)
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, int):
        return round(float(v), 6)
    return str(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark_df, con, sql: str):
    """Return a dict with the comparison outcome."""
    s_cols = spark_df.columns
    s_types = [f.dataType.simpleString() for f in spark_df.schema.fields]
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = [str(t) for t in rel.types]
    d_rows = rel.fetchall()
    res = {
        "spark_rows": len(s_rows),
        "duck_rows": len(d_rows),
        "columns_match": sorted(s_cols) == sorted(d_cols),
    }
    s_map = dict(zip(s_cols, s_types))
    d_map = dict(zip(d_cols, d_types))
    res["type_mismatch"] = {
        c: (s_map[c], d_map.get(c)) for c in s_cols if c in d_map and SPARK_TO_DUCK.get(s_map[c], s_map[c]) != d_map[c]
    }
    if res["columns_match"]:
        a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
        res["values_match"] = a == b
        if a != b:
            sa, sb = set(a), set(b)
            res["only_spark"] = list(sa - sb)[:3]
            res["only_duck"] = list(sb - sa)[:3]
    else:
        res["values_match"] = False
        res["spark_cols"], res["duck_cols"] = s_cols, d_cols
    res["ok"] = res["values_match"] and res["spark_rows"] == res["duck_rows"] and not res["type_mismatch"]
    return res
