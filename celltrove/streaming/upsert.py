"""Idempotent ingest of newly arrived files: each micro-batch is appended by key, old rows win."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..sources import writers


def ingest_new(spark: SparkSession, source: str, schema: str, target: str, key: Sequence[str], checkpoint: str) -> None:
    """Append the rows of files in ``source`` that are new since the last call, skipping keys already in ``target``."""

    def batch(df: DataFrame, _: int) -> None:
        writers.append_new(df, target, key)

    stream = spark.readStream.schema(schema).parquet(source)
    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
