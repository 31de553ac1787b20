"""Run a registered query and its SQL on the same tables and compare every value."""

from __future__ import annotations

import datetime
import decimal
import os

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return repr(value + 0.0)
    if isinstance(value, int):
        return str(value)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return str(value)


def _kind(value) -> str:
    return "none" if value is None else type(value).__name__


def spark_rows(df: DataFrame) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, [tuple(r[n] for n in names) for r in df.collect()]


def sql_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], [tuple(r[i] for i in order) for r in cursor.fetchall()]


def differences(left, right, limit: int = 3) -> list[str]:
    (left_names, left_rows), (right_names, right_rows) = left, right
    if left_names != right_names:
        return [f"columns {left_names} != {right_names}"]
    found = []
    if len(left_rows) != len(right_rows):
        found.append(f"rows {len(left_rows)} != {len(right_rows)}")
    a = sorted(tuple(map(_plain, r)) for r in left_rows)
    b = sorted(tuple(map(_plain, r)) for r in right_rows)
    only_a = sorted(set(a) - set(b))
    only_b = sorted(set(b) - set(a))
    if a != b:
        found.append(f"values differ: {len(only_a)} / {len(only_b)}")
        for x, y in list(zip(only_a, only_b))[:limit]:
            found.append("; ".join(f"{n}: {p} | {q}" for n, p, q in zip(left_names, x, y) if p != q))
        if not (only_a and only_b):
            found += [str(x) for x in (only_a + only_b)[:limit]]
    for i, name in enumerate(left_names):
        kinds = {_kind(r[i]) for r in left_rows} - {"none"}
        others = {_kind(r[i]) for r in right_rows} - {"none"}
        if kinds and others and kinds != others:
            found.append(f"type of {name}: {kinds} != {others}")
    return found
