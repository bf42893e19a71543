"""Comparison of a query with its SQL twin."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def kind(name: str) -> str:
    """Type names both engines use differently, brought together."""
    name = name.lower()
    same = {"varchar": "string", "integer": "int", "long": "bigint", "hugeint": "hugeint"}
    return same.get(name, name)


def difference(spark_df, con, sql: str) -> str | None:
    """What differs, or None."""
    result = con.execute(sql)
    theirs = {d[0]: kind(str(d[1])) for d in result.description}
    ours = {f.name: kind(f.dataType.simpleString()) for f in spark_df.schema.fields}
    if ours != theirs:
        return f"schema {sorted(ours.items())} != {sorted(theirs.items())}"
    names = sorted(ours)
    order = list(theirs)
    key = lambda row: tuple((v is None, str(type(v)), v) for v in row)
    want = sorted((tuple(plain(r[order.index(n)]) for n in names) for r in result.fetchall()), key=key)
    got = sorted((tuple(plain(r[n]) for n in names) for r in spark_df.collect()), key=key)
    if len(want) != len(got):
        return f"{len(got)} rows instead of {len(want)}"
    if not want:
        return "no rows on either side"
    for a, b in zip(got, want):
        if a != b:
            return f"{dict(zip(names, a))} != {dict(zip(names, b))}"
    return None
