"""Side-by-side comparison of a registered query and its SQL on the same files."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from dayledger.sources.tables import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return format(value.normalize(), "f") if value else "0"
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, int):
        return str(value)
    return str(value)


def kind(type_name: str) -> str:
    t = type_name.lower()
    for prefix, k in (("decimal", "decimal"), ("timestamp", "timestamp"), ("varchar", "string")):
        if t.startswith(prefix):
            return k
    return {"bigint": "long", "integer": "int", "int": "int", "hugeint": "hugeint"}.get(t, t)


def compare(spark, con, fn, sql: str, sf_dir: str) -> list[str]:
    """Differences between both results; empty when they agree in rows, names, types and values."""
    df = fn(spark, sf_dir)
    rel = con.sql(sql)
    problems = []
    left_types = {c: kind(t.simpleString()) for c, t in ((f.name, f.dataType) for f in df.schema)}
    left_types = {c: {"bigint": "long"}.get(t, t) for c, t in left_types.items()}
    right_types = {c: kind(str(t)) for c, t in zip(rel.columns, rel.types)}
    if set(left_types) != set(right_types):
        return [f"columns {sorted(left_types)} != {sorted(right_types)}"]
    for c in left_types:
        if left_types[c] != right_types[c]:
            problems.append(f"type of {c}: {left_types[c]} != {right_types[c]}")
    names = sorted(left_types)
    left = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)
    pos = [rel.columns.index(c) for c in names]
    right = sorted((tuple(plain(r[p]) for p in pos) for r in rel.fetchall()), key=repr)
    if len(left) != len(right):
        problems.append(f"rows {len(left)} != {len(right)}")
    if left != right:
        only_l = [r for r in left if r not in set(right)][:3]
        only_r = [r for r in right if r not in set(left)][:3]
        problems.append(f"values ({names}): spark only {only_l}; sql only {only_r}")
    return problems
