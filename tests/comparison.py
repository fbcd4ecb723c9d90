"""Compare a Spark result with the SQL oracle: columns, row count and values, order aside."""

from __future__ import annotations

import datetime
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, datetime.datetime) and v.tzinfo is not None:
        v = v.replace(tzinfo=None)
    if isinstance(v, float) and v == 0:
        return 0.0
    return v


def difference(df, sql: str, con) -> str | None:
    """None when equal, else what differs."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    expected = cur.fetchall()
    actual = df.collect()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    order = sorted(names)
    pos = [names.index(n) for n in order]
    want = Counter(tuple((type(r[i]).__name__, _plain(r[i])) for i in pos) for r in expected)
    have = Counter(tuple((type(r[n]).__name__, _plain(r[n])) for n in order) for r in actual)
    if want == have:
        return None
    missing, extra = list((want - have).items())[:3], list((have - want).items())[:3]
    return f"rows {len(actual)} vs {len(expected)}\n columns {order}\n missing {missing}\n extra {extra}"
