"""Run a registered query and its SQL on the same files and compare the rows."""

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, decimal.Decimal):
        return value.normalize()
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark, con, sf_dir, query, sql):
    """Number of rows, after checking that names and rows agree."""
    found = query(spark, sf_dir)
    got = bag(found.columns, [tuple(r) for r in found.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = bag(names, cursor.fetchall())
    assert sorted(found.columns) == sorted(names)
    assert got == want, f"only Spark: {list((got - want).items())[:3]} only SQL: {list((want - got).items())[:3]}"
    return sum(got.values())
