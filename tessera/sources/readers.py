"""Readers and writers.

Declared schemas are preferred (no inference pass over 100 TB).  Paths may
be local, HDFS or object-store URIs (``s3a://...``): the same calls cover
S4 / S13.  Scratch output goes under the cluster's shared checkpoint folder
(``spark.checkpoint.dir``), never a machine-local temporary folder.
"""
from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for stage output."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tessera-scratch/{name}-{uuid.uuid4().hex[:12]}"


# ---------------------------------------------------------------- S1-S3, S6, S10 CSV
def read_csv(spark: SparkSession, paths, schema: T.StructType | str | None = None, header: bool = True,
             columns: Sequence[str] | None = None, infer: bool = False, sep: str = ",") -> DataFrame:
    """CSV scan with a declared schema (S1), inferred types (S2), a column
    subset (S3: pruned by Catalyst), several shards at once (S6), or a
    numeric matrix with a header line to skip (S10)."""
    r = spark.read.option("header", header).option("sep", sep)
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    df = r.csv(list(paths) if isinstance(paths, (list, tuple)) else paths)
    return df.select(*columns) if columns else df


def read_parquet(spark: SparkSession, paths, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan (S5, S11 in place of feather) with optional pruning."""
    df = spark.read.parquet(*(paths if isinstance(paths, (list, tuple)) else [paths]))
    return df.select(*columns) if columns else df


def read_with_source(spark: SparkSession, pattern: str, schema, value_regex: str, fmt: str = "csv",
                     header: bool = True) -> DataFrame:
    """Many files into one table with the file name kept and a value parsed
    from it (S7), e.g. the CV score in ``sub_0.5432.csv``."""
    r = spark.read.schema(schema)
    df = r.option("header", header).csv(pattern) if fmt == "csv" else r.parquet(pattern)
    path = F.col("_metadata.file_path")
    return df.withColumn("source_file", path) \
             .withColumn("source_value", F.regexp_extract(path, value_regex, 1).cast("double"))


def read_geojson_points(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """GeoJSON features to (feature index, point index, lon/lat) rows (S8,
    F43): ``features[].geometry.coordinates`` exploded.  ``multiline=True``
    reads one FeatureCollection document; otherwise one Feature per line
    (the splittable layout for large inputs)."""
    geom = T.StructType([T.StructField("type", T.StringType()),
                         T.StructField("coordinates", T.ArrayType(T.DoubleType()))])
    feat = T.StructType([T.StructField("type", T.StringType()),
                         T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
                         T.StructField("geometry", geom)])
    if multiline:
        coll = T.StructType([T.StructField("type", T.StringType()), T.StructField("features", T.ArrayType(feat))])
        df = spark.read.schema(coll).option("multiLine", True).json(path)
        df = df.select(F.posexplode("features").alias("fid", "f")).select("fid", "f.*")
    else:
        df = spark.read.schema(feat).json(path).withColumn("fid", F.monotonically_increasing_id())
    c = F.col("geometry.coordinates")
    return df.select("fid", "properties", c[0].alias("x"), c[1].alias("y"))


def read_fixed_width(spark: SparkSession, path: str, fields: Sequence[tuple[str, int, int, str]],
                     record: tuple[int, int, str] | None = None) -> DataFrame:
    """Fixed-width text records to typed columns (S9, e.g. PDB ATOM lines):
    ``fields`` = (name, start, end (1-based, inclusive), type); ``record``
    = (start, end, value) keeps only lines of one record type."""
    t = spark.read.text(path)
    if record:
        s, e, v = record
        t = t.where(F.trim(F.substring("value", s, e - s + 1)) == v)
    return t.select(*[F.trim(F.substring("value", s, e - s + 1)).cast(tp).alias(n) for n, s, e, tp in fields])


def write_fixed_width(df: DataFrame, path: str, fields: Sequence[tuple[str, int, int, str]], texts: dict[str, Column],
                      left: Sequence[str] = ()) -> list[tuple[str, int, int, str]]:
    """Fixed-width text sink (S9): ``texts`` gives the fields' texts, set to
    the right of their columns, or to the left for those in ``left``.  Returns
    the layout written: ``fields``, but a field whose longest text does not
    fit has more columns and those after it stand further on, so no value is
    cut or read from a neighbour's columns."""
    need = df.agg(*[F.max(F.length(c)).alias(n) for n, c in texts.items()]).first()
    layout, parts, at, moved = [], [], 1, 0
    for n, s, e, tp in fields:
        wide = max(e - s + 1, need[n] or 0)
        text = F.coalesce(texts[n], F.lit(""))
        parts += [F.lit(" " * (s + moved - at)), (F.rpad if n in left else F.lpad)(text, wide, " ")]
        layout.append((n, s + moved, s + moved + wide - 1, tp))
        at, moved = s + moved + wide, moved + wide - (e - s + 1)
    df.select(F.concat(*parts).alias("value")).write.mode("overwrite").text(path)
    return layout


# ---------------------------------------------------------------- writers
def write_csv(df: DataFrame, path: str, header: bool = True, single_file: bool = False) -> str:
    """CSV sink (S12); ``single_file`` coalesces to one partition and is
    only meant for small outputs such as a submission."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", header).csv(path)
    return path


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Parquet stage table (S11, S13, S14), optionally partitioned so later
    reads prune by partition value."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def fill_template(template: DataFrame, preds: DataFrame, key: str, col: str, default=None) -> DataFrame:
    """Fill a submission template (S15): left join predictions on the id,
    template order of columns kept, missing predictions get ``default``."""
    j = template.drop(col).join(preds.select(key, col), key, "left")
    if default is not None:
        j = j.withColumn(col, F.coalesce(F.col(col), F.lit(default)))
    return j.select(*template.columns)
