"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: With it on, Spark deletes the shuffle files of a write when the write is done.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where none is set a temporary one in local mode, and an error on a cluster."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not found:
        if not context.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="celltrove-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors, frees its shuffle files."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/celltrove-{label}-{uuid.uuid4().hex}"
    with _freed(spark):
        df.write.option("compression", "zstd").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._celltrove_path = path
    return back


def bucketed(df: DataFrame, label: str, key: str, buckets: int) -> DataFrame:
    """As ``written``, in buckets of ``key``: joins and groups by it read the table without an exchange.

    A bucket is one file if ``df`` has its rows in one partition.
    """
    spark = df.sparkSession
    name = f"celltrove_{label}_{uuid.uuid4().hex}"
    path = f"{scratch_dir(spark)}/{name.replace('_', '-')}"
    with _freed(spark):
        df.write.format("parquet").option("compression", "zstd").option("path", path).bucketBy(buckets, key).saveAsTable(name)
    back = spark.table(name)
    back._celltrove_path, back._celltrove_table, back._celltrove_buckets = path, name, buckets
    return back


@contextmanager
def _freed(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before) if before is not None else spark.conf.unset(_CLEANUP)


@contextmanager
def without_broadcast(spark: SparkSession) -> Iterator[None]:
    """For loops over written tables: no round collects one of them on the driver.  The settings of before come back."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k in names:
            spark.conf.set(k, "-1")
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def drop(*tables: DataFrame) -> None:
    """Delete tables that ``written`` or ``bucketed`` made, once nothing reads them."""
    for df in tables:
        if name := getattr(df, "_celltrove_table", None):
            df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
        path = getattr(df, "_celltrove_path", None)
        if path:
            context = df.sparkSession.sparkContext
            where = context._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)
