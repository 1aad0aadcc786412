"""Counts, shares, pivots, histograms and merges of partial results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def group_size(df: DataFrame, by: Sequence[str], out: str = "cell_count") -> DataFrame:
    """Rows of each group; groups with a null key are dropped."""
    return df.dropna(subset=list(by)).groupBy(*by).agg(F.count(F.lit(1)).alias(out))


def value_counts(df: DataFrame, column: str, dropna: bool = True, out: str = "n") -> DataFrame:
    """Counts of each value, most frequent first, ties by value; null counts only with dropna=False."""
    rows = df.filter(F.col(column).isNotNull()) if dropna else df
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias(out)).orderBy(F.desc(out), F.asc_nulls_last(column))


def top_shares(df: DataFrame, group: str, column: str, k: int = 2) -> DataFrame:
    """(group, rank, value, percent): the k most frequent values of each group; null values do not count."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(group, column).agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(group)
    ranked = counts.withColumn("_t", F.sum("_c").over(w)).withColumn("rank", F.row_number().over(w.orderBy(F.desc("_c"), F.asc(column))))
    return ranked.filter(F.col("rank") <= k).select(group, "rank", F.col(column).alias("value"), (F.col("_c") * 100.0 / F.col("_t")).alias("percent"))


def disagreement(df: DataFrame, group: str, a: str, b: str, unknown: Sequence[str] = ("Unknown", "Less10")) -> DataFrame:
    """Percent of a group's rows where a differs from b, also without rows whose b is unknown; all rows are the denominator."""
    differ = ~F.col(a).eqNullSafe(F.col(b))
    known = F.coalesce(~F.col(b).isin(list(unknown)), F.lit(True))
    share = lambda c: F.avg(F.when(c, 100.0).otherwise(0.0))
    return df.groupBy(group).agg(share(differ & known).alias("diff_known"), share(differ).alias("diff_all"), F.count(F.lit(1)).alias("n"))


def pivot_sum(df: DataFrame, index: Sequence[str], column: str, value: str, values: Sequence[str]) -> DataFrame:
    """Sum of ``value`` for each index and listed column value, 0 where there is none; null index rows are dropped."""
    rows = df.dropna(subset=[*index, column])
    return rows.groupBy(*index).agg(*[F.coalesce(F.sum(F.when(F.col(column) == v, F.col(value))), F.lit(0)).alias(v) for v in values])


def crosstab(df: DataFrame, index: str, column: str, values: Sequence[str]) -> DataFrame:
    """Group sizes, unstacked."""
    return pivot_sum(df.withColumn("_one", F.lit(1).cast("bigint")), [index], column, "_one", values)


def row_percent(df: DataFrame, columns: Sequence[str], digits: int | None = None) -> DataFrame:
    """Each column as percent of their sum in its row; null where the sum is 0."""
    total = sum((F.col(c) for c in columns[1:]), F.col(columns[0]))
    one = lambda c: F.try_divide(F.col(c) * 100.0, total)
    return df.select(*[c for c in df.columns if c not in columns], *[(F.round(one(c), digits) if digits is not None else one(c)).alias(c) for c in columns])


def share_in(df: DataFrame, outer: str, inner: str) -> DataFrame:
    """(outer, inner, count, percent): group sizes and their share in the outer group."""
    counts = group_size(df, [outer, inner], "count")
    return counts.withColumn("percent", F.col("count") * 100.0 / F.sum("count").over(Window.partitionBy(outer)))


def totals(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    return df.filter(F.col(group).isNotNull()).groupBy(group).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in columns])


def group_columns(df: DataFrame, grouping: dict[str, Sequence[str]]) -> DataFrame:
    """Each new column is the sum of its sources, which go; a missing source is an error."""
    for new, sources in grouping.items():
        if lost := [c for c in sources if c not in df.columns]:
            raise ValueError(f"columns {lost} are missing for '{new}'")
        total = sum((F.coalesce(F.col(c), F.lit(0)) for c in sources[1:]), F.coalesce(F.col(sources[0]), F.lit(0)))
        df = df.withColumn("_new", total).drop(*sources).withColumnRenamed("_new", new)
    return df


def list_of(df: DataFrame, group: Sequence[str], column: str, out: str) -> DataFrame:
    """Sorted list of a column for each group."""
    return df.groupBy(*group).agg(F.sort_array(F.collect_list(column)).alias(out))


def distinct_nonzero(df: DataFrame, group: Sequence[str], column: str, out: str = "ids") -> DataFrame:
    return df.filter(F.col(column) != 0).groupBy(*group).agg(F.sort_array(F.collect_set(column)).alias(out))


def histogram(df: DataFrame, value: str, low: float, high: float, bins: int = 100, weight: str | None = None) -> DataFrame:
    """(bin from 0, n, weight): equal bins over [low, high], the last closed; rows outside are left out."""
    at = F.least(F.floor((F.col(value) - low) * bins / (high - low)), F.lit(bins - 1)).cast("int")
    rows = df.filter(F.col(value).between(low, high))
    return rows.groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(weight) if weight else F.lit(1)).alias("weight"))


def removed(df: DataFrame, keep: Column) -> DataFrame:
    """(before, after, removed) in one pass."""
    return df.agg(F.count(F.lit(1)).alias("before"), F.count_if(keep).alias("after"), (F.count(F.lit(1)) - F.count_if(keep)).alias("removed"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def merge_votes(a: DataFrame, b: DataFrame, key: str, counts: str) -> DataFrame:
    """Counts of each class added by key; lists of different length are filled with 0."""
    both = a.select(key, counts).unionByName(b.select(key, counts))
    each = both.select(key, F.posexplode(counts).alias("_i", "_n")).groupBy(key, "_i").agg(F.sum("_n").alias("_n"))
    return each.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("_i", "_n"))), lambda s: s["_n"]).alias(counts))


def metrics_to_lists(splits: DataFrame, key: Sequence[str], metric: str, value: str, order: str) -> DataFrame:
    """(key, metric, values): the values of all splits in order; what is not a number is null."""
    number = F.when(F.isnan(F.col(value).try_cast("double")), None).otherwise(F.col(value).try_cast("double"))
    rows = splits.select(*key, metric, F.struct(F.col(order).alias("o"), number.alias("v")).alias("s"))
    return rows.groupBy(*key, metric).agg(F.transform(F.sort_array(F.collect_list("s")), lambda s: s["v"]).alias("values"))


def unique_across(parts: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows; reading them fails if a key is in more than one part."""
    from .relational import unique_or_error

    return unique_or_error(parts, key, "parts")
