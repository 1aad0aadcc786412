"""Filters, joins, set operations and merges with the null, tie and duplicate rules of the label tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars
from .numbering import row_numbers

#: Dictionary sides up to this many rows are broadcast; larger ones are left to the optimizer.
BROADCAST_ROWS = 1_000_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it is counted at no more than ``rows``."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


# Filters


def min_count(df: DataFrame, column: str = "transcript_counts", least: int = 10) -> DataFrame:
    """Rows strictly above ``least``; null is not."""
    return df.filter(F.col(column) > least)


def mark_low(df: DataFrame, column: str, label: str, least: int = 10, low: str = "less10") -> DataFrame:
    """``label`` is ``low`` where the count is at most ``least``."""
    return df.withColumn(label, F.when(F.col(column) <= least, F.lit(low)).otherwise(F.col(label)))


def threshold_census(df: DataFrame, column: str, thresholds: Sequence[int] = (20, 15, 10)) -> DataFrame:
    """One row for each threshold: rows below it, and their percentage rounded to 2."""
    one = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(column) < t).alias(f"t{t}") for t in thresholds])
    rows = F.array(*[F.struct(F.lit(t).cast("bigint").alias("threshold"), F.col(f"t{t}").alias("n_below"), F.round(F.try_divide(F.col(f"t{t}") * 100.0, F.col("n")), 2).alias("percent")) for t in thresholds])
    return one.select(F.explode(rows).alias("r")).select("r.*")


def metric_range(df: DataFrame, metric: str = "jaccard", low: float = 0.0, high: float = 1.0) -> DataFrame:
    """Closed interval; the sentinel -1 drops out of the default one."""
    return df.filter(F.col(metric).between(low, high))


def keep_ids(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.filter(F.col(column).isin(list(values)))


def drop_ids(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """NOT IN a list; rows with a null id stay."""
    return df.filter(~F.coalesce(F.col(column).isin(list(values)), F.lit(False)))


def drop_null_keys(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull())


def veto(df: DataFrame, group: Sequence[str], bad: Column) -> DataFrame:
    """Rows of the groups in which no row is ``bad``."""
    return df.join(df.filter(bad).select(*group).distinct(), list(group), "left_anti")


def valid_rings(df: DataFrame, ring: str = "ring") -> DataFrame:
    """Polygons of at least three points and a box with an area."""
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    spread = (F.array_max(xs) > F.array_min(xs)) & (F.array_max(ys) > F.array_min(ys))
    return df.filter(F.col(ring).isNotNull() & (F.size(ring) >= 3)).filter(spread)


def sample_rows(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """n rows of smallest md5 of key and seed; all rows if there are no more.  Deterministic."""
    return df.orderBy(F.md5(F.concat_ws("_", F.col(key).cast("string"), F.lit(str(seed)))), key).limit(n)


def resume(df: DataFrame, done: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.join(done.select(*key).distinct(), list(key), "left_anti")


# Joins


def last_wins(dictionary: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """One row (key, value) of each key, that of the greatest ``order``."""
    return dictionary.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(value, order).alias(value))


def lookup(df: DataFrame, column: str, dictionary: DataFrame, key: str, value: str, order: str, out: str, default: str | None = None) -> DataFrame:
    """Left join of at most one match; the last duplicate wins; unmatched or null values get ``default``."""
    side = small(last_wins(dictionary, key, value, order).select(F.col(key).alias("_key"), F.col(value).alias("_value")))
    found = df.join(side, df[column] == side["_key"], "left")
    filled = F.coalesce("_value", F.lit(default)) if default is not None else F.col("_value")
    return found.withColumn(out, filled).drop("_key", "_value")


def map_literal(column: Column, values: dict[str, str], default: str | None = None) -> Column:
    """Constant map; null without a default."""
    found = F.try_element_at(scalars.map_of(values), column)
    return F.coalesce(found, F.lit(default)) if default is not None else found


def map_chain(column: Column, *maps: dict[str, str]) -> Column:
    return reduce(map_literal, maps, column)


def compare_outer(tables: dict[str, DataFrame], key: Sequence[str]) -> DataFrame:
    """Full outer join of tables with unique keys, columns suffixed by table name.

    The tables are padded, united and grouped by key: one exchange instead of two for each
    join.  A key that repeats in a table is an error, as is the case for a validated merge.
    """
    value = {n: [c for c in t.columns if c not in key] for n, t in tables.items()}
    padded = []
    for name, t in tables.items():
        own = [F.col(c).alias(f"{c}_{name}") for c in value[name]]
        padded.append(t.select(*key, *own, F.lit(1).alias(f"_n_{name}")))
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), padded)
    columns = [f"{c}_{n}" for n in tables for c in value[n]]
    one = united.groupBy(*key).agg(*[F.max(c).alias(c) for c in columns], *[F.coalesce(F.sum(f"_n_{n}"), F.lit(0)).alias(f"_n_{n}") for n in tables])
    most = F.greatest(*[F.col(f"_n_{n}") for n in tables]) if len(tables) > 1 else F.col(f"_n_{next(iter(tables))}")
    checked = one.withColumn("_ok", F.when(most > 1, F.raise_error(F.lit("key repeats in a table"))).otherwise(F.lit(True)))
    return checked.filter("_ok").select(*key, *columns)


def compare_outer_join(tables: dict[str, DataFrame], key: Sequence[str]) -> DataFrame:
    """The same as chained full outer joins, for tables whose keys repeat."""
    named = [t.select(*key, *[F.col(c).alias(f"{c}_{n}") for c in t.columns if c not in key]) for n, t in tables.items()]
    return reduce(lambda a, b: a.join(b, list(key), "full_outer"), named)


def inner_renamed(left: DataFrame, right: DataFrame, left_on: str, right_on: str) -> DataFrame:
    """Inner join on keys of different names; the left one is dropped."""
    return left.join(right, left[left_on] == right[right_on]).drop(left[left_on])


def left_fill(left: DataFrame, right: DataFrame, key: Sequence[str], fill: float = -1.0) -> DataFrame:
    """Left join; missing numbers of the right side become ``fill``."""
    names = [c for c in right.columns if c not in key]
    return left.join(right, list(key), "left").fillna(fill, subset=names)


def unique_or_error(df: DataFrame, key: Sequence[str], what: str) -> DataFrame:
    """``df`` itself; reading it fails if a key repeats."""
    w = Window.partitionBy(*key)
    checked = df.withColumn("_n", F.count(F.lit(1)).over(w))
    ok = F.when(F.col("_n") > 1, F.raise_error(F.lit(f"{what}: key repeats"))).otherwise(F.lit(True))
    return checked.withColumn("_ok", ok).filter("_ok").drop("_n", "_ok")


def merge_one_to_one(master: DataFrame, predictions: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """Left join of the first prediction of each key by ``order``; a key that repeats in ``master`` is an error."""
    columns = [c for c in predictions.columns if c not in key and c != order]
    first = predictions.groupBy(*key).agg(F.min_by(F.struct(*columns), order).alias("_first")).select(*key, "_first.*")
    return unique_or_error(master, key, "master").join(first, list(key), "left")


def geometry_key(ring: Column, digits: int = 6) -> Column:
    """Canonical digest of a ring: its rounded points in order."""
    return F.sha2(F.array_join(F.transform(ring, lambda p: F.concat_ws(" ", F.format_number(p["x"], digits), F.format_number(p["y"], digits))), ","), 256)


def geometry_join(left: DataFrame, right: DataFrame, ring: str = "ring", id_column: str = "cell_id") -> DataFrame:
    """(left_id, right_id): full outer join on the geometry."""
    a = left.select(geometry_key(F.col(ring)).alias("_g"), F.col(id_column).alias("left_id"))
    b = right.select(geometry_key(F.col(ring)).alias("_g"), F.col(id_column).alias("right_id"))
    return a.join(b, "_g", "full_outer").drop("_g")


def complete(part: DataFrame, whole: DataFrame, key: Sequence[str]) -> DataFrame:
    """``part`` and the rows of ``whole`` whose key it lacks; columns of either side, null where missing."""
    return part.unionByName(whole.join(part.select(*key).distinct(), list(key), "left_anti"), allowMissingColumns=True)


def _paired(a: DataFrame, b: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key, _a, _b): full outer join of the other columns as structs, cut down to the common values of every key column.

    Common values of each column are those of the whole tables, not of what another column
    has left.  All uses of the join share its exchanges, so each table is scanned once.
    """
    packed = lambda df, name: df.select(*key, F.struct(*[c for c in df.columns if c not in key], F.lit(True).alias("_in")).alias(name))
    both = packed(a, "_a").join(packed(b, "_b"), list(key), "full_outer")
    kept = both
    for k in key:
        seen = both.filter(F.col(k).isNotNull()).groupBy(k).agg(F.max(F.col("_a").isNotNull()).alias("_x"), F.max(F.col("_b").isNotNull()).alias("_y"))
        kept = kept.join(seen.filter("_x AND _y").select(k), k, "left_semi")
    return kept


def common_keys(a: DataFrame, b: DataFrame, *keys: str) -> tuple[DataFrame, DataFrame]:
    """Both tables cut down to the values each of ``keys`` has in common, each taken from the whole tables; keys are unique in each table."""
    both = _paired(a, b, keys)
    side = lambda df, name: both.filter(F.col(name).isNotNull()).select(*[c if c in keys else F.col(name)[c].alias(c) for c in df.columns])
    return side(a, "_a"), side(b, "_b")


def reindex(df: DataFrame, key: str, ids: DataFrame, id_column: str, position: str) -> DataFrame:
    """A row for each listed id with its position; columns of ``df`` are null where it has no such key."""
    listed = ids.select(F.col(id_column).alias(key), F.col(position))
    return listed.join(df, key, "left")


def weighted_sum(a: DataFrame, b: DataFrame, key: Sequence[str], value: str, weight: float = 1.0) -> DataFrame:
    """a + weight * b over the common values of every key column; absent entries are 0."""
    x, y = (F.coalesce(F.col(s)[value], F.lit(0.0)) for s in ("_a", "_b"))
    return _paired(a, b, key).select(*key, (x + F.lit(weight) * y).alias(value))


def weighted_log_sum(a: DataFrame, b: DataFrame, cell: str, gene: str, value: str, weight: float = 1.0, target: float = 1e4) -> DataFrame:
    """(cell, gene, value): both tables cut down to common cells and genes, normalised to ``target`` for each cell, log1p, and a + weight * b.

    A cell's totals are those of its common genes; a cell without counts stays 0.
    """
    key = [cell, gene]
    both = _paired(a, b, key).select(*key, *[F.coalesce(F.col(s)[value], F.lit(0.0)).cast("double").alias(s) for s in ("_a", "_b")])
    totals = both.groupBy(cell).agg(F.sum("_a").alias("_ta"), F.sum("_b").alias("_tb"))
    scaled = lambda x, t: F.log1p(F.when(F.col(t) > 0, F.col(x) * F.lit(target) / F.col(t)).otherwise(F.lit(0.0)))
    return both.join(totals, cell).select(*key, (scaled("_a", "_ta") + F.lit(weight) * scaled("_b", "_tb")).alias(value))


def difference_clipped(a: DataFrame, b: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    """max(a - b, 0) over the common values of every key column; zero entries are left out."""
    rows = _paired(a, b, key).filter("_a IS NOT NULL")
    return rows.select(*key, F.greatest(F.col("_a")[value] - F.coalesce(F.col("_b")[value], F.lit(0.0)), F.lit(0.0)).alias(value)).filter(F.col(value) > 0)


def missing_references(rows: DataFrame, parents: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key no parent has."""
    return rows.join(parents.select(*key).distinct(), list(key), "left_anti")


# Sets and merges


def union_all(*tables: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), tables)


def union_outer(*tables: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def difference_both(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of one side only, with ``side`` 'left' or 'right'."""
    tagged = a.distinct().withColumn("_s", F.lit(1)).unionByName(b.distinct().withColumn("_s", F.lit(2)))
    one = tagged.groupBy(*a.columns).agg(F.sum("_s").alias("_s")).filter("_s < 3")
    return one.withColumn("side", F.when(F.col("_s") == 1, "left").otherwise("right")).drop("_s")


def intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def merge_distinct(*tables: DataFrame) -> DataFrame:
    return union_all(*tables).distinct()


def upsert_keep_old(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Old rows, and new rows of other keys; of several old or new rows of a key the least stays."""
    columns = [c for c in old.columns if c not in key]
    tagged = old.withColumn("_age", F.lit(0)).unionByName(new.select(*old.columns).withColumn("_age", F.lit(1)))
    first = tagged.groupBy(*key).agg(F.min(F.struct("_age", *columns)).alias("_r"))
    return first.select(*key, *[F.col("_r")[c].alias(c) for c in columns])


def dedup_first(df: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """The row of least ``order`` of each key."""
    columns = [c for c in df.columns if c not in key]
    first = df.groupBy(*key).agg(F.min_by(F.struct(*columns), order).alias("_r"))
    return first.select(*key, *[F.col("_r")[c].alias(c) for c in columns])


def unique_names(df: DataFrame, column: str, order: str) -> DataFrame:
    """Repeated names get '-1', '-2', ... from the second on; a name of any frequency is numbered in parts."""
    return row_numbers(df, [column], [order], "_n").withColumn(column, F.when(F.col("_n") > 0, F.concat_ws("-", column, "_n")).otherwise(F.col(column).cast("string"))).drop("_n")
