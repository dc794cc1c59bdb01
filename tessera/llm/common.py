"""Shared helpers: shared-folder files, Arrow row streaming, skew-safe lookups."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.common import cut, scratch_folder

__all__ = ["cut", "fs_of", "hot_lookup", "map_batches", "new_folder", "read_table", "with_slices"]

# A key is hot when it holds more than this share of the rows; at most
# 1 / HOT_SHARE keys can be, so the table of hot keys is bounded.
HOT_SHARE = 1 / 1024


def read_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared ``spark.checkpoint.dir``, owned by the
    ``scratch_tables`` block around the call. It is made through Hadoop's file
    system; tasks open files in it by :func:`fs_of`."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(scratch_folder(spark, name))
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(p)
    return str(fs.makeQualified(p).toString())


# Schemes of shared stores that tasks can open, and the name pyarrow has for each.
SCHEMES = {"hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "abfs": "abfs",
           "abfss": "abfss"}


def arrow_uri(uri: str) -> str:
    """The URI by which pyarrow knows a folder that Hadoop names ``uri``."""
    scheme, _, rest = uri.partition("://")
    if scheme not in SCHEMES:
        raise ValueError(f"files can be written to {', '.join(['file', *SCHEMES])}, not to {scheme}")
    return f"{SCHEMES[scheme]}://{rest}"


def fs_of(uri: str):
    """(file system, path) of a folder in shared storage, for use in tasks:
    local and NFS paths, and the stores of ``SCHEMES``."""
    from pyarrow import fs
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), os.path.abspath(uri)
    return fs.FileSystem.from_uri(arrow_uri(uri))


def map_batches(df: DataFrame, run) -> DataFrame:
    """``mapInArrow`` that keeps the schema, for any column names: Spark can't
    address a column whose name holds a dot there, so columns are numbered."""
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.mapInArrow(run, plain.schema).toDF(*df.columns)


def with_slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the Python objects of one slice stay small."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def hot_lookup(big: DataFrame, dim: DataFrame, key: str, weight: str, total: int, spread: Column) -> DataFrame:
    """Left join of ``big`` with ``dim`` (one row per ``key``; ``weight``: how
    many rows of ``big`` have it) that no key can overload. Keys above
    ``HOT_SHARE`` of ``total`` rows, at most ``1 / HOT_SHARE`` of them, are
    broadcast; their rows go into the shuffled join for the others under a key
    of their own (from ``spread``), so they scatter over all tasks."""
    cols = [c for c in dim.columns if c not in (key, weight)]
    hot = dim.filter(F.col(weight) > F.lit(max(1.0, total * HOT_SHARE)))
    cold = dim.filter(F.col(weight) <= F.lit(max(1.0, total * HOT_SHARE)))
    hot = hot.select(F.col(key).alias("_hk"), *[F.col(c).alias(f"_h_{c}") for c in cols])
    cold = cold.select(F.col(key).cast("string").alias("_ck"), *[F.col(c).alias(f"_c_{c}") for c in cols])
    out = big.join(F.broadcast(hot), F.col(key) == F.col("_hk"), "left")
    out = out.withColumn("_k", F.when(F.col("_hk").isNotNull() | F.col(key).isNull(),
                                      F.concat(F.lit("\u0000"), spread.cast("string")))
                         .otherwise(F.col(key).cast("string")))
    out = out.join(cold, F.col("_k") == F.col("_ck"), "left")
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.col(f"_h_{c}"), F.col(f"_c_{c}")))
    return out.select(*big.columns, *cols)
