"""Row-set comparison of a Spark result with a DuckDB result (order-insensitive,
columns matched by name, doubles rounded to 6 digits)."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

from quillspark.plans.registry import ORACLES, QUERIES


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "tolist"):
        return norm(v.tolist())
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def row_bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


def duck_connect(sf_dir: str, tables):
    import duckdb

    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    con.execute("SET TimeZone='UTC'")
    return con


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    df = QUERIES[name](spark, sf_dir)
    scols = df.columns
    srows = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        return True, f"{len(srows)} rows (no oracle)"
    res = con.execute(ORACLES[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    if sorted(scols) != sorted(dcols):
        return False, f"columns spark={scols} duck={dcols}"
    a, b = row_bag(scols, srows), row_bag(dcols, drows)
    if a == b:
        return True, f"{len(srows)} rows"
    return False, (f"spark {len(srows)} rows, duck {len(drows)} rows; spark-only {list((a - b).items())[:2]}; "
                   f"duck-only {list((b - a).items())[:2]}")
