"""Compare registered queries with their SQL on DuckDB: schema, row count and values."""

from __future__ import annotations

import math
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, list):
        return tuple(_value(x) for x in v)
    if isinstance(v, dict):
        return tuple((k, _value(v[k])) for k in sorted(v))
    return v


def _rows(table):
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    rows = [tuple(_value(v) for v in row) for row in zip(*columns)]
    return names, sorted(rows, key=repr)


def _types(table):
    plain = {"large_string": "string", "string_view": "string"}
    return {f.name: plain.get(str(f.type), str(f.type)) for f in table.schema}


def compare(spark, con, name, query, folder) -> tuple[str, float, float]:
    start = time.time()
    got = query(spark, folder).toArrow()
    took = time.time() - start
    if query.sql is None:
        return f"rows-only {got.num_rows}", took, 0.0
    start = time.time()
    want = con.execute(query.sql).to_arrow_table()
    sql_took = time.time() - start
    if _types(got) != _types(want):
        return f"SCHEMA {_types(got)} != {_types(want)}", took, sql_took
    names, a = _rows(got)
    _, b = _rows(want)
    if len(a) != len(b):
        return f"ROWS {len(a)} != {len(b)}", took, sql_took
    if a != b:
        pairs = [(x, y) for x, y in zip(a, b) if x != y]
        return f"VALUES {len(pairs)} {names} {str(pairs[0])[:600]}", took, sql_took
    return f"ok {len(a)}", took, sql_took
