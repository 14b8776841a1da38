"""Compare a registered query with its SQL counterpart."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.12g}")
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    return v


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([plain(r[i]) for i in order] for r in rows), key=lambda r: [(x is None, str(x)) for x in r])


def difference(df, sql: str, con) -> str | None:
    """None when both give the same columns and rows."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = result.fetchall()
    got = [tuple(r) for r in df.collect()]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    a, b = _sorted(df.columns, got), _sorted(names, want)
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None
