"""Compare a Spark result with a DuckDB result over the same parquet tables.

Columns are matched by name; floats are rounded; rows are compared as a
multiset. Used by the oracle tests and by hand while iterating.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

from tessera.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits=6):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if v == 0 or math.isinf(v):
            return 0.0 if v == 0 else v
        # 9 significant digits: engines sum in different orders
        r = float(f"{v:.9g}")
        return 0.0 if r == 0 else r
    if isinstance(v, decimal.Decimal):
        return _norm(float(v), digits)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, digits)) for k, x in v.items()))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, bool):
        return int(v)
    if hasattr(v, "asDict"):
        return _norm(v.asDict(), digits)
    return v


def compare(spark_df, con, sql, digits=6):
    """Return (ok, message)."""
    s_cols = spark_df.columns
    rel = con.sql(sql)
    d_cols = rel.columns
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}"
    order = sorted(s_cols)
    s_rows = [tuple(_norm(r[c], digits) for c in order) for r in spark_df.collect()]
    d_raw = rel.fetchall()
    idx = [d_cols.index(c) for c in order]
    d_rows = [tuple(_norm(r[i], digits) for i in idx) for r in d_raw]
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duck={len(d_rows)}"
    cs, cd = Counter(s_rows), Counter(d_rows)
    if cs != cd:
        only_s = list((cs - cd).elements())[:3]
        only_d = list((cd - cs).elements())[:3]
        return False, f"values differ ({len(list((cs-cd).elements()))} rows); spark-only={only_s!r:.600} duck-only={only_d!r:.600}"
    return True, f"{len(s_rows)} rows match"
