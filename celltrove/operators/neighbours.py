"""Approximate neighbour graph without all pairs, and the fuzzy weights of its edges.

A forest of random projections gives the first lists: each tree halves its nodes at the median
of a random direction, level by level, until leaves hold about ``leaf`` rows; all pairs of a leaf are
compared in one matrix product.  Rounds of descent then compare the neighbours that each row has
with each other.  A tree and a round each cost rows x a constant; levels grow with the logarithm of the rows.

Rows with a null id or vector, or with null or non-finite components, take no part; vectors
of different length never meet.  Ids may repeat: rows are told apart by a number of their own, and a
row leaves out itself alone.  Equal distances go to the smaller id.  A row has fewer than k neighbours
only if fewer rows of its length were met.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import drop, written
from ..workers import ship

TREES, LEAF, ROUNDS, SEED = 8, 128, 2, 42
#: Rounds of descent end when fewer than this share of the list entries changed.
LEAST_CHANGE = 0.001
#: Neighbours of a node whose bandwidth is fitted.
MOST_NEIGHBOURS = 10_000

_FOUND = "row long, id long, other long, neighbour long, d2 double"


def usable(df: DataFrame, key: str, vec: str) -> DataFrame:
    """(row, id, v): the rows that take part, numbered; written, so that all readers see the same numbers."""
    v = F.col(vec).cast("array<double>")
    whole = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = df.filter(whole & F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("id"), v.alias("v"))
    return written(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Vectors of one length as a matrix."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


def _projected(rows: DataFrame, trees: int, levels: int, seed: int) -> DataFrame:
    """(row, d, tree, p): the places of a row on the directions of each tree's levels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions: dict[int, np.ndarray] = {}
        for batch in batches:
            sizes = np.array([len(v) for v in batch.column(1)])
            for d in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == d)
                if d not in directions:
                    directions[d] = np.random.default_rng([seed, d]).standard_normal((d, trees * levels))
                places = _matrix(batch.column(1).take(pa.array(at))) @ directions[d] if d else np.zeros((len(at), trees * levels))
                numbers = np.repeat(batch.column(0).to_numpy()[at], trees)
                offsets = np.arange(len(numbers) + 1, dtype=np.int32) * levels
                p = pa.ListArray.from_arrays(pa.array(offsets), pa.array(places.astype(np.float32).ravel()))
                yield pa.record_batch({"row": pa.array(numbers), "d": pa.array(np.full(len(numbers), d, np.int32)), "tree": pa.array(np.tile(np.arange(trees, dtype=np.int32), len(at))), "p": p})

    return rows.select("row", "v").mapInArrow(run, "row long, d int, tree int, p array<float>")


def _leaves(rows: DataFrame, trees: int, leaf: int, seed: int) -> DataFrame:
    """(row, d, tree, node) after halving every node at its median, until none has more than 2 * ``leaf`` rows; written."""
    levels = max(0, math.ceil(math.log2(max(1, rows.count()) / leaf)))
    now = written(_projected(rows, trees, levels, seed).withColumn("node", F.lit(1).cast("long")), "places")
    level = 0
    # Medians among equal places halve unevenly, so some nodes need more than the planned levels.
    while level < levels or (levels and now.groupBy("d", "tree", "node").count().agg(F.max("count")).first()[0] > 2 * leaf):
        place = F.get("p", F.lit(level % levels))
        middle = now.groupBy("d", "tree", "node").agg(F.percentile_approx(place, F.lit(0.5), F.lit(1000)).alias("m"), F.count(F.lit(1)).alias("n"))
        # Equal places, those of copies among them, go to either side by a hash, so no leaf grows with them.
        coin = F.pmod(F.xxhash64("row", "tree", F.lit(level)), F.lit(2)) == 1
        upper = (place > F.col("m")) | ((place == F.col("m")) & coin)
        # A node that is small already (of a rarer length, say) is a leaf.
        node = F.when(F.col("n") <= leaf, F.col("node") * 2).otherwise(F.col("node") * 2 + upper.cast("int"))
        new = written(now.join(middle, ["d", "tree", "node"]).select("row", "d", "tree", "p", node.alias("node")), "places")
        drop(now)
        now, level = new, level + 1
    return now


def _nearest(numbers: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int, bars: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows in one matrix: row places, other places and squared distances of each row's k nearest (below its bar)."""
    norms = np.einsum("ij,ij->i", x, x)
    near = norms[:, None] + norms[None, :] - 2 * (x @ x.T)
    near[numbers[:, None] == numbers[None, :]] = np.inf
    if bars is not None:
        # The product's rounding must not hide an equal distance: the exact one is tested below.
        near[near > bars[:, None] + 1e-9 * (norms[:, None] + norms[None, :])] = np.inf
    rows, others = [], []
    for i, s in enumerate(near):
        best = np.flatnonzero(s <= np.partition(s, k)[k] * (1 + 1e-12) + 1e-12) if len(s) > k + 1 else np.arange(len(s))
        best = best[np.isfinite(s[best])]
        rows.append(np.full(len(best), i))
        others.append(best)
    at, to = np.concatenate(rows), np.concatenate(others)
    exact = np.square(x[at] - x[to]).sum(axis=1)
    keep = np.lexsort((ids[to], exact, at))
    at, to, exact = at[keep], to[keep], exact[keep]
    place = np.arange(len(at)) - np.searchsorted(at, at)
    first = place < k
    if bars is not None:
        first &= exact <= bars[at]
    return at[first], to[first], exact[first]


def _within_leaves(leaves: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    def run(group: pa.Table) -> pa.Table:
        numbers, ids = (group.column(c).to_numpy() for c in ("row", "id"))
        at, to, d2 = _nearest(numbers, ids, _matrix(group.column("v")), k)
        return pa.table({"row": numbers[at], "id": ids[at], "other": numbers[to], "neighbour": ids[to], "d2": d2})

    met = leaves.select("row", "d", "tree", "node").join(rows, "row")
    return met.select("d", "tree", "node", "row", "id", "v").groupBy("d", "tree", "node").applyInArrow(run, _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k nearest different rows of each row; lists are bounded by what trees or rounds give a row."""
    once = found.groupBy("row", "id", "other", "neighbour").agg(F.min("d2").alias("d2"))
    order = Window.partitionBy("row").orderBy("d2", "neighbour", "other")
    return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _descent(graph: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """Pairs of rows on one list (and its owner) that are nearer than what the row has on its own list."""
    bars = graph.groupBy("row").agg(F.count(F.lit(1)).alias("n"), F.max("d2").alias("far")).select("row", F.when(F.col("n") >= k, F.col("far")).otherwise(F.lit(float("inf"))).alias("bar"))
    members = graph.select(F.col("row").alias("owner"), F.col("other").alias("row")).unionByName(graph.select(F.col("row").alias("owner"), "row").distinct())
    # A list has k + 1 members, so what is gathered for an owner is bounded.
    lists = members.join(rows.join(bars, "row"), "row").groupBy("owner").agg(F.collect_list(F.struct("row", "id", "bar", "v")).alias("m"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[np.ndarray]] = []
            for entry in batch.column(0):
                one = entry.values
                numbers, ids, bar = (one.field(c).to_numpy(zero_copy_only=False) for c in ("row", "id", "bar"))
                at, to, d2 = _nearest(numbers, ids, _matrix(one.field("v")), k, bar)
                out.append([numbers[at], ids[at], numbers[to], ids[to], d2])
            yield pa.record_batch(dict(zip(("row", "id", "other", "neighbour", "d2"), (pa.array(np.concatenate(c)) for c in zip(*out, strict=True)), strict=True)))

    return lists.select("m").mapInArrow(run, _FOUND)


def neighbour_graph(df: DataFrame, k: int, key: str, vec: str, trees: int = TREES, leaf: int = LEAF, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """(key, rank, neighbour, distance): about the k nearest rows of each row by Euclidean distance."""
    ship(df.sparkSession)
    leaf = max(leaf, 2 * k)
    rows = usable(df, key, vec)
    leaves = _leaves(rows, trees, leaf, seed)
    graph = written(_best(_within_leaves(leaves, rows, k), k), "graph")
    drop(leaves)
    size = graph.count()
    for _ in range(rounds):
        found = graph.select("row", "id", "other", "neighbour", "d2").unionByName(_descent(graph, rows, k))
        new = written(_best(found, k), "graph")
        changed = new.join(graph.select("row", "other"), ["row", "other"], "left_anti").count()
        drop(graph)
        graph = new
        if changed <= LEAST_CHANGE * size:
            break
    drop(rows)
    return graph.select(F.col("id").alias(key), "rank", "neighbour", F.sqrt("d2").alias("distance"))


def bandwidth(distances: Column, steps: int = 64) -> Column:
    """struct(rho, sigma): the least distance above 0, and the width at which the memberships exp(-(d - rho) / sigma) add up to log2 of their number.

    By bisection within the row, ``steps`` times; not below a thousandth of the mean distance.
    """
    # Spark works out a lambda's argument once, but an expression at each place it is named: as often as there are steps and distances.
    bound = lambda value, body: F.get(F.transform(F.array(value), body), F.lit(0))
    above = lambda ds: F.filter(ds, lambda d: d > 0)
    middle = lambda lo, hi: F.when(hi.isNull(), lo * 2).otherwise((lo + hi) / 2)
    start = F.struct(F.lit(0.0).alias("lo"), F.lit(None).cast("double").alias("hi"), F.lit(1.0).alias("s"))

    def fit(one: Column) -> Column:
        ds, rho, want = one["ds"], one["rho"], F.log2(F.size(one["ds"]).cast("double"))
        total = lambda s: F.aggregate(ds, F.lit(0.0), lambda a, d: a + F.when(d <= rho, 1.0).otherwise(F.exp(-(d - rho) / s)))

        def step(state: Column, _: Column) -> Column:
            def half(over: Column) -> Column:
                lo, hi = F.when(over, state["lo"]).otherwise(state["s"]), F.when(over, state["s"]).otherwise(state["hi"])
                return F.struct(lo.alias("lo"), hi.alias("hi"), middle(lo, hi).alias("s"))

            return bound(total(state["s"]) > want, half)

        found = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step, lambda s: s["s"])
        mean = F.aggregate(ds, F.lit(0.0), lambda a, d: a + d) / F.size(ds)
        return F.struct(rho.alias("rho"), F.greatest(found, mean * 1e-3).alias("sigma"))

    return bound(F.struct(distances.alias("ds"), F.coalesce(F.array_min(above(distances)), F.lit(0.0)).alias("rho")), fit)


def fuzzy_union(edges: DataFrame, a: str, b: str, membership: str) -> DataFrame:
    """(a, b, weight), a < b: p + q - p q of the memberships of both directions, an absent one is 0; of a repeated edge the greatest counts."""
    low, high = F.least(F.col(a), F.col(b)), F.greatest(F.col(a), F.col(b))
    sided = edges.filter(F.col(a) != F.col(b)).select(low.alias("_a"), high.alias("_b"), F.when(F.col(a) < F.col(b), F.col(membership)).alias("_p"), F.when(F.col(a) > F.col(b), F.col(membership)).alias("_q"))
    both = sided.groupBy("_a", "_b").agg(F.coalesce(F.max("_p"), F.lit(0.0)).alias("p"), F.coalesce(F.max("_q"), F.lit(0.0)).alias("q"))
    return both.select(F.col("_a").alias(a), F.col("_b").alias(b), (F.col("p") + F.col("q") - F.col("p") * F.col("q")).alias("weight"))


def fuzzy_weights(graph: DataFrame, key: str, neighbour: str = "neighbour", distance: str = "distance") -> DataFrame:
    """(key, neighbour, weight), key < neighbour: the fuzzy union of each node's memberships.

    Ids are the nodes: rows that repeat one are one node with all their neighbours, each at its least
    distance.  More than MOST_NEIGHBOURS of a node are an error, since its list is held as one value.
    """
    once = graph.filter(F.col(key).isNotNull() & F.col(neighbour).isNotNull()).groupBy(key, neighbour).agg(F.min(distance).alias("_d"))
    if once.groupBy(key).count().filter(F.col("count") > MOST_NEIGHBOURS).limit(1).count():
        raise ValueError(f"a node has more than {MOST_NEIGHBOURS} neighbours: ids repeat, or this is no neighbour graph")
    lists = once.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_d", neighbour))).alias("_l"))
    fitted = lists.withColumn("_w", bandwidth(F.transform("_l", lambda e: e["_d"])))
    flat = fitted.select(key, "_w", F.explode("_l").alias("_e")).select(key, F.col(f"_e.{neighbour}").alias(neighbour), "_w", "_e._d")
    member = F.when(F.col("_d") <= F.col("_w.rho"), 1.0).otherwise(F.exp(-(F.col("_d") - F.col("_w.rho")) / F.col("_w.sigma")))
    return fuzzy_union(flat.select(key, neighbour, member.alias("_m")), key, neighbour, "_m")
