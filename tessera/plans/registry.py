"""Query registry: every registered query is a Spark plan over the driver
tables plus (where SQL can express it) an equivalent DuckDB oracle.

Output columns are declared once as ``name:kind`` (kind i=bigint, f=double
rounded to 6 places, s=string, d=date, b=boolean); the same declaration
shapes the Spark result and wraps the oracle SQL, so names and types line
up for the hash comparison.
"""
from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
# Fact tables whose scans are worth spreading over the cores; dimensions are
# small and usually broadcast as they are.
FACTS = {"orders", "lineitem", "events", "documents", "pages", "conversations"}


@dataclass(frozen=True)
class Query:
    key: str
    covers: tuple
    cols: tuple
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
    note: str = ""
    fn: Callable | None = None


REGISTRY: dict[str, Query] = {}


def _parse_cols(spec) -> tuple:
    """``"a:i b:f"`` or a list of ``"name:kind"`` (for names with spaces)."""
    out = []
    for tok in (spec.split() if isinstance(spec, str) else spec):
        name, kind = tok.rsplit(":", 1)
        assert kind in "ifsdb", tok
        out.append((name, kind))
    return tuple(out)


def register(key: str, covers: str, cols: str, sql: str | None = None, note: str = ""):
    """Decorator registering ``fn(t: Tables) -> DataFrame`` as query ``key``."""
    def deco(fn):
        assert key not in REGISTRY, key
        REGISTRY[key] = Query(key, tuple(covers.split()), _parse_cols(cols),
                              lambda spark, sf_dir: conform(fn(Tables(spark, sf_dir)), _parse_cols(cols)),
                              sql, note, fn)
        return fn
    return deco


class Tables:
    """Lazy parquet handles for the driver tables under ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            self._cache[name] = spread(df) if name in FACTS else df
        return self._cache[name]


def spread(df: DataFrame) -> DataFrame:
    """Round-robin the scan over the cluster's cores when the source has
    fewer splits than cores (a small file with one row group is read by one
    task).  On large inputs the scan already has more splits than cores and
    this is a no-op; filters and column pruning still reach the scan."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def round6(c: Column) -> Column:
    """Round half up at 6 places with arithmetic both engines share bit-for-bit."""
    return F.when(F.abs(c) < F.lit(1e12), F.floor(c * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6)).otherwise(c)


_SPARK_CAST = {"i": "bigint", "s": "string", "d": "date", "b": "boolean"}


def conform(df: DataFrame, cols: tuple) -> DataFrame:
    exprs = []
    for name, kind in cols:
        c = F.col(f"`{name}`")
        if kind == "f":
            exprs.append(round6(c.cast("double")).alias(name))
        else:
            exprs.append(c.cast(_SPARK_CAST[kind]).alias(name))
    return df.select(*exprs)


_SQL_CAST = {"i": "BIGINT", "s": "VARCHAR", "d": "DATE", "b": "BOOLEAN"}


def ESUM(x: str) -> str:
    """SQL twin of ``prefix.exact_sum``: an order-independent sum."""
    return f"CAST(sum(CAST({x} AS DECIMAL(38,6))) AS DOUBLE)"


def wrap_sql(sql: str, cols: tuple) -> str:
    exprs = []
    for name, kind in cols:
        q = f'"{name}"'
        if kind == "f":
            x = f"CAST({q} AS DOUBLE)"
            exprs.append(f"CASE WHEN abs({x}) < 1e12 THEN floor({x} * 1e6 + 0.5) / 1e6 ELSE {x} END AS {q}")
        else:
            exprs.append(f"CAST({q} AS {_SQL_CAST[kind]}) AS {q}")
    return f"SELECT {', '.join(exprs)}\nFROM (\n{sql.strip()}\n) AS _q"
