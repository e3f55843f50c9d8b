"""Summarise the executed (final adaptive) physical plans of selected
queries: scans with pushed filters / read schema, exchanges, joins,
aggregates and windows.  usage: python scripts/plan_summary.py [sf_dir] key...
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

KEEP = re.compile(r"(Exchange|ReusedExchange|Join|Aggregate|Window |FileScan|TakeOrdered|BroadcastExchange|InMemory|"
                  r"Generate|FlatMapGroupsInPandas)")


def summarise(df) -> list[str]:
    df.collect()                       # act on this DataFrame so explain() shows the final adaptive plan
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    final = buf.getvalue().split("== Initial Plan ==")[0]
    out = []
    for line in final.splitlines():
        if KEEP.search(line):
            ln = re.sub(r"#\d+L?", "", line.rstrip())
            ln = re.sub(r"\[plan_id=\d+\]", "", ln)
            ln = re.sub(r"Location: InMemoryFileIndex\([^)]*\)\[[^\]]*\], ", "", ln)
            out.append(ln[:200])
    return out


def main():
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    keys = [a for a in args if not a.startswith("/")]
    spark = get_spark(master="local[8]", shuffle_partitions=16)
    for k in keys:
        print(f"### {k}\n```")
        print("\n".join(summarise(REGISTRY[k].build(spark, sf))))
        print("```\n")


if __name__ == "__main__":
    main()
