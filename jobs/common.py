"""What the jobs share: their configuration, and columns by expression."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def configuration(spark: SparkSession, path: str) -> dict:
    """A small JSON file, read by Spark, so that it may be in any store."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def selected(df: DataFrame, expressions: dict[str, str], names: Iterable[str]) -> DataFrame:
    """The named columns by the configured SQL expressions; a missing one is an error."""
    names = list(names)
    if lost := [n for n in names if n not in expressions]:
        raise ValueError(f"the configuration has no expression for {lost}")
    return df.select(*[F.expr(expressions[n]).alias(n) for n in names])
