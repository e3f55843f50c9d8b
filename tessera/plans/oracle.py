"""Compare a registered query with its DuckDB oracle (row count, column
names, order-insensitive value digest)."""
from __future__ import annotations

import hashlib
import math

from .registry import REGISTRY, TABLES, wrap_sql


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def digest(rows):
    keys = sorted("|".join(_norm(x) for x in r) for r in rows)
    return hashlib.sha1("\n".join(keys).encode()).hexdigest(), keys


def compare(spark, key: str, sf_dir: str, con) -> tuple[bool, str]:
    q = REGISTRY[key]
    sdf = q.build(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    if not q.sql:
        return True, f"{len(srows)} rows (no oracle)"
    cur = con.execute(wrap_sql(q.sql, q.cols))
    drows = cur.fetchall()
    dcols = [d[0] for d in cur.description]
    hs, ks = digest(srows)
    hd, kd = digest(drows)
    if sdf.columns != dcols:
        return False, f"columns {sdf.columns} vs {dcols}"
    if len(srows) != len(drows):
        return False, f"rows {len(srows)} vs {len(drows)}"
    if hs != hd:
        sk, dk = set(ks), set(kd)
        return False, f"values differ: spark-only {[x for x in ks if x not in dk][:2]} duck-only {[x for x in kd if x not in sk][:2]}"
    return True, f"{len(srows)} rows"
