"""Micro-batch adapter: a batch operator over a file stream equals the
batch result."""
import os
import tempfile

from tessera.operators import aggregates as A
from tessera.sources.schemas import schema
from tessera.streaming.microbatch import file_stream, run_batches

SF_SMALL = "/root/testdata/sf0.001"


def test_stream_value_counts_equal_batch(spark):
    work = tempfile.mkdtemp(prefix="tessera-stream-")
    src = os.path.join(work, "in")
    spark.read.parquet(f"{SF_SMALL}/events.parquet").repartition(3).write.parquet(src)
    out = os.path.join(work, "out")
    st = file_stream(spark, src, schema("events"), max_files_per_trigger=1)
    run_batches(st, lambda b: b.groupBy("event_type").count(), out, os.path.join(work, "ckpt"))
    got = {r[0]: r[1] for r in spark.read.parquet(out).groupBy("event_type").sum("count").collect()}
    exp = {r[0]: r[1] for r in spark.read.parquet(src).groupBy("event_type").count().collect()}
    assert got == exp
