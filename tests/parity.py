"""Compares the queries with their SQL on one scale factor: rows, columns and values."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _cell(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    names = sorted(df.columns)
    ours = Counter(tuple(_cell(r[c]) for c in names) for r in df.collect())
    rel = con.sql(sql)
    theirs_names = sorted(rel.columns)
    if names != theirs_names:
        return f"columns {names} != {theirs_names}"
    kinds = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    for field in df.schema:
        spark_kind = field.dataType.simpleString()
        expected = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "int": "INTEGER", "boolean": "BOOLEAN"}.get(spark_kind)
        if kinds[field.name] != expected:
            return f"type of {field.name}: {spark_kind} != {kinds[field.name]}"
    position = {c: i for i, c in enumerate(rel.columns)}
    theirs = Counter(tuple(_cell(r[position[c]]) for c in names) for r in rel.fetchall())
    if ours != theirs:
        left, right = list((ours - theirs).items()), list((theirs - ours).items())
        return f"{sum(ours.values())} vs {sum(theirs.values())} rows; only ours {len(left)} {sorted(left, key=str)[:2]}; only SQL {len(right)} {sorted(right, key=str)[:2]}"
    return None
