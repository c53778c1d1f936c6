"""Run a query and its oracle on the same files and compare them row by row."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents"
    " embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float) and value == 0:
        return 0.0
    return value.item() if hasattr(value, "item") else value


def rows(names: list[str], records) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(record[i]) for i in order) for record in records)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Differences between a DataFrame and the oracle's result; empty if equal."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns differ: {sorted(df.columns)} / {sorted(names)}"]
    expected = rows(names, cursor.fetchall())
    found = rows(df.columns, (tuple(r) for r in df.collect()))
    missing, extra = expected - found, found - expected
    if not missing and not extra:
        return [] if expected else ["both sides are empty"]
    sample = lambda c: sorted(c, key=str)[:2]
    return [
        f"rows {sum(found.values())} / {sum(expected.values())}, "
        f"extra {sum(extra.values())}, missing {sum(missing.values())}",
        f"extra {sample(extra)}",
        f"missing {sample(missing)}",
    ]
