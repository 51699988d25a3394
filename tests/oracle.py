"""Compares a query with its SQL: names, kinds of types and rows."""

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
KINDS = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "DATE": "date"}


def connection(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    return str(v)


def difference(spark, con, sf_dir, query, sql):
    """None if they agree, else what differs."""
    df = query(spark, sf_dir)
    names = sorted(df.columns)
    kinds = [(c, str(t)) for c, t, *_ in con.execute(f"DESCRIBE {sql}").fetchall()]
    want = {c: KINDS.get(t, t) for c, t in kinds}
    have = dict(df.dtypes)
    if have != {c: want.get(c) for c in have} or len(have) != len(want):
        return f"types: {have} and {want}"
    a = sorted(tuple(plain(r[c]) for c in names) for r in df.collect())
    order = [names.index(c) for c, _ in kinds]
    b = []
    for r in con.execute(sql).fetchall():
        row = [None] * len(names)
        for i, v in zip(order, r, strict=True):
            row[i] = plain(v)
        b.append(tuple(row))
    b.sort()
    if a == b:
        return None
    only = next(((x, y) for x, y in zip(a, b, strict=False) if x != y), ("", ""))
    return f"{len(a)} and {len(b)} rows; first: {str(only)[:1500]}"
