"""Scan the physical plans of all registered queries for cross products,
single-partition exchanges (global windows / sorts in one task) and
Python operators.

usage: python scripts/plan_audit.py [sf_dir]
"""
import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tessera.plans import REGISTRY  # noqa: E402
from tessera.session import get_spark  # noqa: E402

FLAGS = ["CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition", "ArrowEvalPython",
         "BatchEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "SortAggregate"]


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark(master="local[8]", shuffle_partitions=8)
    for k, q in REGISTRY.items():
        if not q.sql:
            continue
        try:
            df = q.build(spark, sf)
            buf = io.StringIO()
            with contextlib.redirect_stdout(buf):
                df.explain("formatted")
            plan = buf.getvalue()
        except Exception as e:  # noqa: BLE001
            print(f"{k}: ERROR {e}")
            continue
        hits = [f for f in FLAGS if f in plan]
        scans = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
        print(f"{k}: {hits} scans={len(scans)}")


if __name__ == "__main__":
    main()
