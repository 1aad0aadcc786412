"""Vector columns: filters, means over patches, merges of partial sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_nan_vectors(df: DataFrame, vec: str) -> DataFrame:
    """Rows whose vector is there and holds no NaN or null."""
    return df.filter(F.col(vec).isNotNull() & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x)))


def partial_sums(df: DataFrame, key: Sequence[str], vec: str, patch: str) -> DataFrame:
    """(key, sums, n, patches): vector sums and the sorted list of patches; mergeable."""
    each = df.select(*key, F.posexplode(F.col(vec).cast("array<double>")).alias("_i", "_x")).groupBy(*key, "_i").agg(F.sum("_x").alias("_x"))
    sums = each.groupBy(*key).agg(F.transform(F.sort_array(F.collect_list(F.struct("_i", "_x"))), lambda s: s["_x"]).alias("sums"))
    lists = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(patch)).alias("patches"))
    return sums.join(lists, list(key))


def merge_partials(a: DataFrame, b: DataFrame, key: Sequence[str]) -> DataFrame:
    """Sums added, counts added, patch lists joined; keys of one side stay as they are."""
    both = a.unionByName(b)
    each = both.select(*key, F.posexplode("sums").alias("_i", "_x")).groupBy(*key, "_i").agg(F.sum("_x").alias("_x"))
    sums = each.groupBy(*key).agg(F.transform(F.sort_array(F.collect_list(F.struct("_i", "_x"))), lambda s: s["_x"]).alias("sums"))
    rest = both.groupBy(*key).agg(F.sum("n").alias("n"), F.sort_array(F.flatten(F.collect_list("patches"))).alias("patches"))
    return sums.join(rest, list(key))


def means(partials: DataFrame, key: Sequence[str]) -> DataFrame:
    return partials.select(*key, F.transform("sums", lambda x: x / F.col("n")).alias("mean"), "n", "patches")


def vector_mean(df: DataFrame, key: Sequence[str], vec: str) -> DataFrame:
    """(key, position, mean) of each component."""
    return df.select(*key, F.posexplode(F.col(vec).cast("array<double>")).alias("position", "_x")).groupBy(*key, "position").agg(F.avg("_x").alias("mean"))
