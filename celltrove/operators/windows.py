"""Votes, bins, ranks, cluster consensus and instance maps."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .numbering import row_numbers

from .aggregates import disagreement, top_shares
from .relational import map_literal

#: Most distinct values that are gathered to finish a bracket of ``order_statistics``.
COLLECT = 500_000


def vote(df: DataFrame, counts: Column, names: Sequence[str], background: str = "Background") -> DataFrame:
    """Add label and proba: the most voted class, lowest index first among equals.

    If that is the background and the second has votes, the second is taken; rows without
    votes are dropped.  Higher-order functions on the row's own array: no shuffle.
    """
    total = F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, x: a + x)
    ranked = F.sort_array(F.transform(counts, lambda x, i: F.struct((-x).alias("n"), i.alias("i"))))
    first, second = ranked[0], F.get(ranked, F.lit(1))
    taken = F.when((F.lit(list(names))[first["i"]] == background) & (second["n"] < 0), second).otherwise(first)
    rows = df.withColumn("_t", total).filter("_t > 0").withColumn("_w", taken)
    return rows.withColumn("label", F.lit(list(names))[F.col("_w.i")]).withColumn("proba", -F.col("_w.n") / F.col("_t")).drop("_t", "_w")


def order_statistics(df: DataFrame, column: str, ranks: Sequence[int], collect: int = COLLECT) -> dict[int, float]:
    """Exact values at the given ranks (from 0) of the non-null values, by narrowing brackets (actions).

    A round takes two passes for all open brackets together: approximate quantiles of each,
    and the exact numbers between those cuts, both combined map-side.  Each rank keeps the
    bracket that holds it; brackets of at most ``collect`` rows in all are finished by
    counting their values.
    """
    rows = df.select(F.col(column).cast("double").alias("x")).filter("x IS NOT NULL")
    low, high, n = rows.agg(F.min("x"), F.max("x"), F.count(F.lit(1))).first()
    found: dict[int, float] = {}
    # (lo, hi): values below lo, values in it, ranks wanted.
    open_ = {(low, high): (0, n, sorted(set(ranks)))}

    def bracket():
        return F.coalesce(*[F.when(F.col("x").between(lo, hi), F.lit(i)) for i, (lo, hi) in enumerate(open_)])

    while open_:
        inside = rows.withColumn("b", bracket()).filter("b IS NOT NULL")
        if sum(size for _, size, _ in open_.values()) <= collect:
            values = sorted(map(tuple, inside.groupBy("b", "x").agg(F.count(F.lit(1))).collect()))
            for i, (below, _, wanted) in enumerate(open_.values()):
                upto = below
                for _, value, k in (v for v in values if v[0] == i):
                    found |= {r: value for r in wanted if upto <= r < upto + k}
                    upto += k
            break
        shares = F.lit([i / 64 for i in range(65)])
        cuts = {i: sorted({lo, hi}) for i, (lo, hi) in enumerate(open_)}
        for b, some in inside.groupBy("b").agg(F.percentile_approx("x", shares, F.lit(2000))).collect():
            cuts[b] = sorted({*cuts[b], *some})
        at = F.coalesce(*[F.when(F.col("b") == i, F.array_size(F.filter(F.lit(c), lambda e: e < F.col("x")))) for i, c in cuts.items()])
        parts = {(b, k): own for b, k, *own in map(tuple, inside.groupBy("b", at.alias("k")).agg(F.count(F.lit(1)), F.min("x"), F.max("x")).collect())}
        narrower = {}
        for i, (below, _, wanted) in enumerate(open_.values()):
            upto = below
            for k in range(len(cuts[i])):  # part k holds the values above cut k - 1, up to cut k
                m, least, most = parts.get((i, k), (0, 0.0, 0.0))
                if here := [r for r in wanted if upto <= r < upto + m]:
                    # The least value of a bracket is a cut, so brackets get narrower in every round.
                    if least == most:
                        found |= dict.fromkeys(here, least)
                    else:
                        narrower[least, most] = (upto, m, here)
                upto += m
        open_ = narrower
    return found


def quantile_edges(df: DataFrame, column: str, q: int, digits: int | None = None) -> list[float]:
    """q + 1 exact, linearly interpolated edges (actions); equal edges are an error."""
    n = df.filter(F.col(column).isNotNull()).count()
    if not n:
        return []
    places = [(n - 1) * i / q for i in range(q + 1)]
    at = order_statistics(df, column, [k for p in places for k in (math.floor(p), math.ceil(p))])
    edges = [at[math.floor(p)] + (at[math.ceil(p)] - at[math.floor(p)]) * (p - math.floor(p)) for p in places]
    edges = [round(e, digits) if digits is not None else e for e in edges]
    if len(set(edges)) <= q:
        raise ValueError("bin edges are not unique")
    return edges


def quantile_bins(df: DataFrame, column: str, q: int = 7, out: str = "bin", digits: int | None = None) -> DataFrame:
    """Bin from 0, right-closed, the least value in the first; null stays null."""
    inner = quantile_edges(df, column, q, digits)[1:-1]
    bins = sum((F.when(F.col(column) > e, 1).otherwise(0) for e in inner), F.lit(0))
    return df.withColumn(out, F.when(F.col(column).isNotNull(), bins))


def top_rows(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, out: str = "rank") -> DataFrame:
    """The first k rows of each group by a total order."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(F.col(out) <= k)


def category_codes(df: DataFrame, column: str, out: str = "code") -> DataFrame:
    """Dense code from 0 of the sorted values, -1 for null.

    The distinct values are numbered by ranges, however many they are, and joined back.
    """
    values = df.select(F.col(column).alias("_v")).filter("_v IS NOT NULL").distinct()
    coded = row_numbers(values, [], ["_v"], "_c").withColumn("_c", F.col("_c").cast("int"))
    return df.join(coded, df[column] == coded["_v"], "left").withColumn(out, F.coalesce("_c", F.lit(-1))).drop("_v", "_c")


def remap_ids(df: DataFrame, group: Sequence[str], column: str, out: str) -> DataFrame:
    """1..n by ascending id within each group; 0 stays 0."""
    dense = F.dense_rank().over(Window.partitionBy(*group, F.col(column) != 0).orderBy(column))
    return df.withColumn(out, F.when(F.col(column) == 0, 0).otherwise(dense).cast("bigint"))


def consensus(df: DataFrame, cluster: str, label: str, overrides: dict[str, str] | None = None) -> DataFrame:
    """(cluster, final): the most frequent label of a cluster, or its override."""
    top = top_shares(df, cluster, label, 1).select(cluster, F.col("value").alias("final"))
    if overrides:
        top = top.withColumn("final", F.coalesce(map_literal(F.col(cluster).cast("string"), overrides), F.col("final")))
    return top


def cluster_flags(df: DataFrame, cluster: str, cells: str, nuclei: str, unknown: Sequence[str] = ("Unknown", "Less10"), limit: float = 40.0) -> DataFrame:
    """(cluster, top_cells, top_nuclei, unknown_top, different_top, high_diff) of every cluster.

    The second nuclei label stands in for an unknown first one, if there is a second.
    """

    def pair(column: str, name: str) -> DataFrame:
        top = top_shares(df, cluster, column, 2).groupBy(cluster)
        return top.agg(*[F.max(F.when(F.col("rank") == r, F.col("value"))).alias(f"{name}{r}") for r in (1, 2)])

    both = pair(cells, "_c").join(pair(nuclei, "_n"), cluster, "full_outer").join(disagreement(df, cluster, cells, nuclei, unknown), cluster)
    nucleus = F.when(F.col("_n1").isin(list(unknown)), F.coalesce("_n2", "_n1")).otherwise(F.col("_n1"))
    return both.select(
        cluster, F.col("_c1").alias("top_cells"), nucleus.alias("top_nuclei"), F.coalesce(F.col("_c1").isin(list(unknown)), F.lit(False)).alias("unknown_top"),
        (~F.col("_c1").eqNullSafe(nucleus)).alias("different_top"), (F.col("diff_known") > limit).alias("high_diff"),
    )


def instance_map(pixels: DataFrame, patch: Sequence[str], row: str, col: str, channel: str, value: str) -> DataFrame:
    """(patch, row, col, instance, type): one instance per pixel, a later class over an earlier one.

    Ids are renumbered 1..n within a class, offset by the classes before, and renumbered
    again over the pixels that remain; type is the class plus 1.
    """
    shown = pixels.filter(F.col(value) != 0)
    kept = shown.groupBy(*patch, row, col).agg(F.max(F.struct(channel, value)).alias("_m")).select(*patch, row, col, F.col("_m")[channel].alias("_c"), F.col("_m")[value].alias("_v"))
    # Renumbering keeps the order of (class, id), so one dense rank over what remains is the whole rule.
    number = F.dense_rank().over(Window.partitionBy(*patch).orderBy("_c", "_v"))
    return kept.select(*patch, row, col, number.cast("bigint").alias("instance"), (F.col("_c") + 1).cast("int").alias("type"))


def cumulative_share(df: DataFrame, order: str, variance: str, out: str = "cumulative") -> DataFrame:
    """Running share of variance over components; a few rows, so one window."""
    w = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum(variance).over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return df.withColumn(out, F.sum(variance).over(w) / total)


def components_for(df: DataFrame, order: str, variance: str, share: float = 0.95) -> DataFrame:
    """(n): the least number of components reaching the share."""
    return cumulative_share(df, order, variance).filter(F.col("cumulative") >= share).agg(F.min(order).alias("n"))
