"""Writers: parquet, CSV, JSON, replaced elements, idempotent appends and chunk merges."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parquet(df: DataFrame, path: str, by: Sequence[str] = (), codec: str = "snappy", mode: str = "errorifexists") -> None:
    writer = df.write.mode(mode).option("compression", codec)
    (writer.partitionBy(*by) if by else writer).parquet(path)


def csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).csv(path, header=True)


def json_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).json(path)


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where, jvm.org.apache.hadoop.fs.Path


def replace(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """Write to a fresh path, then swap: ``df`` may read what it replaces.

    The old element is moved aside and only deleted when the new one is in place, so a
    failure at any point leaves one of them whole; if the second move fails, the first is undone.
    """
    spark, fresh = df.sparkSession, f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    parquet(df, fresh, by)
    fs, where, at = _file_system(spark, path)
    old = at(f"{fresh}-old")
    had = fs.exists(where)
    if had and not fs.rename(where, old):
        raise OSError(f"cannot move {path} aside; the new rows are in {fresh}")
    if not fs.rename(at(fresh), where):
        if had:
            fs.rename(old, where)
        raise OSError(f"cannot move {fresh} to {path}")
    if had:
        fs.delete(old, True)


def exists(spark: SparkSession, path: str) -> bool:
    fs, where, _ = _file_system(spark, path)
    return fs.exists(where)


def append_new(df: DataFrame, path: str, key: Sequence[str]) -> None:
    """Append the rows whose key is not there yet, one of each key; running it again adds nothing."""
    rows = df.dropDuplicates(list(key))
    if exists(df.sparkSession, path):
        rows = rows.join(df.sparkSession.read.parquet(path).select(*key), list(key), "left_anti")
    rows.write.mode("append").parquet(path)


def merge_chunks(spark: SparkSession, path: str, pattern: str = r"_(\d+)\.parquet") -> DataFrame:
    """Rows of numbered chunks with the chunk's number; chunks without one come last (null)."""
    number = F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)
    return spark.read.option("recursiveFileLookup", "true").parquet(path).withColumn("chunk", F.when(number != "", number.cast("int")))


def chunk_order(chunks: DataFrame, *then: str) -> DataFrame:
    return chunks.orderBy(F.asc_nulls_last("chunk"), *then)
