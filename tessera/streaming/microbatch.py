"""Run a batch operator over a file stream, one micro-batch at a time."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def file_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan of a folder that receives new files (schema declared,
    as streaming sources require)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def run_batches(stream: DataFrame, fn: Callable[[DataFrame], DataFrame], out_path: str, checkpoint: str,
                fmt: str = "parquet", available_now: bool = True):
    """Apply ``fn`` (any ``DataFrame -> DataFrame`` operator of the
    library) to every micro-batch and append the result to ``out_path``.

    Progress and the batch ids live in ``checkpoint`` (a shared folder), so
    a restarted query resumes where it stopped and each batch is written
    once.  ``available_now`` processes what is there and stops.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        fn(batch).write.mode("append").format(fmt).save(out_path)

    w = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q
