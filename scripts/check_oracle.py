"""Run registered queries in Spark and their oracle SQL in DuckDB and compare
(row count, column names, order-insensitive value digest).

usage: python scripts/check_oracle.py [sf_dir] [key-substring ...]
"""
from __future__ import annotations

import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tessera.plans import REGISTRY  # noqa: E402
from tessera.plans.oracle import compare, duck  # noqa: E402
from tessera.session import get_spark  # noqa: E402


def main():
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    pats = [a for a in args if not a.startswith("/")]
    spark = get_spark(master="local[8]", shuffle_partitions=8)
    con = duck(sf)
    bad = 0
    for k in REGISTRY:
        if pats and not any(p in k for p in pats):
            continue
        t0 = time.time()
        try:
            ok, msg = compare(spark, k, sf, con)
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"error {type(e).__name__}: {str(e)[:300]}"
        bad += not ok
        tag = ("ok  " if REGISTRY[k].sql else "rows") if ok else "FAIL"
        print(f"{tag} {k}: {msg} {time.time() - t0:.1f}s", flush=True)
    print("bad", bad)


if __name__ == "__main__":
    main()
