"""Session construction and shared-folder resolution.

Cluster settings are read from the session; defaults are set only where a
setting is absent (tests, local runs).
"""
from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings applied only when the key is not already set on the builder/cluster.
_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

#: Spark's setting: a query's shuffle files go when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_spark(app: str = "tessera", master: str | None = None,
              shuffle_partitions: int | None = None,
              driver_memory: str | None = None) -> SparkSession:
    """Return (or create) a session with AQE, skew-join handling and no UI."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        b = b.config("spark.driver.memory", driver_memory)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``.  Where a local session has
    none (tests), a scratch folder is made; on a cluster, whose machines do not
    share local folders, that is an error."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="tessera-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # core conf may be read-only at runtime
            pass
    sc.setCheckpointDir(d)
    return d


def cut_lineage(df):
    """Reliable checkpoint into the shared checkpoint folder (never local)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage_rows(df, name: str):
    """``df`` written once as Parquet below the shared checkpoint folder and
    read back: for rows that many passes read, with what led to them run once
    and each pass reading only its columns.  Small row groups keep the scan
    divisible.  The shuffle files of the write go when it ends."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/tessera-scratch/{name}-{uuid.uuid4().hex[:12]}"
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, "false")
    conf.set(SHUFFLE_CLEANUP, "true")                 # the table is whole: its shuffle files are not read again
    try:
        df.write.option("parquet.block.size", 16 << 20).option("compression", "zstd").parquet(path)
    finally:
        conf.set(SHUFFLE_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_rows(df) -> None:
    """Remove the files of a table of ``stage_rows`` that nothing reads any more."""
    folder = df.inputFiles()[:1]
    if folder:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder[0]).getParent()
        assert path.getParent().getName() == "tessera-scratch", path
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
