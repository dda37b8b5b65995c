"""Compare a query with its SQL in DuckDB."""

import os
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def _plain(x):
    return tuple(_plain(y) for y in x) if isinstance(x, (list, tuple)) else round(x, 9) if isinstance(x, float) else x


def differences(frame, con, sql):
    """What only one side has, as (columns, rows only in Spark, rows only in SQL)."""
    names = sorted(frame.columns)
    want = con.sql(sql)
    if names != sorted(want.columns):
        return names, sorted(want.columns), None
    spark = Counter(_plain(tuple(r)) for r in frame.select(*names).collect())
    other = Counter(_plain(r) for r in want.select(*[f'"{n}"' for n in names]).fetchall())
    return names, list((spark - other).items())[:3], list((other - spark).items())[:3]
