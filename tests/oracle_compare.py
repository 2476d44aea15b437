"""Runs a Spark query and its SQL twin in DuckDB and compares all rows."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).rsplit(".", 1)[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def cell(value):
    if value is None:
        return "∅"
    if isinstance(value, bool):
        return f"b{value}"
    if isinstance(value, float):
        return "∅" if math.isnan(value) else f"f{value:.9g}"
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(cell(v) for v in value) + "]"
    if isinstance(value, int):
        return f"i{value}"
    return f"s{value}"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


_KIND = {"tinyint": "int", "smallint": "int", "int": "int", "integer": "int", "bigint": "bigint", "hugeint": "hugeint",
         "double": "double", "float": "float", "string": "string", "varchar": "string", "date": "date",
         "boolean": "boolean"}


def kind(name: str) -> str:
    name = name.lower()
    return _KIND.get(name, name)


def compare(spark, con, sf_dir, query, sql):
    """None when equal, else what differs."""
    df = query(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    rel = con.sql(sql)
    want = rel.fetchall()
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} != {sorted(rel.columns)}"
    types_got = {n: kind(t) for n, t in df.dtypes}
    types_want = {n: kind(str(t)) for n, t in zip(rel.columns, rel.types)}
    odd = {n: (types_got[n], types_want[n]) for n in types_got if types_got[n] != types_want[n]}
    a, b = rows_of(df.columns, got), rows_of(rel.columns, want)
    if a != b:
        only_a = [r for r in a if r not in set(b)][:3]
        only_b = [r for r in b if r not in set(a)][:3]
        return f"rows {len(a)} vs {len(b)}; cols {sorted(df.columns)}; spark only {only_a}; sql only {only_b}"
    if odd:
        return f"types differ: {odd}"
    if not a:
        return "no rows"
    return None
