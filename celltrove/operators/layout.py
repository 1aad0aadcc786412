"""Plane layout of a weighted graph: spectral start, then rounds of attraction along edges and repulsion from sampled nodes.

Positions are a table that each round writes anew.  In a round every edge pulls its ends by its
weight, and every node is pushed by ``NEGATIVES`` nodes that a hash of node and round picks; all
forces are computed from the positions of the round before and added up by node.  So a round is two
joins of the edges, one of the samples, and one aggregation, and gives the same positions on any
partitions.  Steps shrink to nothing over the rounds.

Nodes are those with an edge; edges with null ends or a weight that isn't positive are left out.
A node's attraction is the weighted mean over its edges, so hubs move no faster than others.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import drop, without_broadcast, written
from ..workers import ship
from .communities import undirected
from .numbering import row_numbers
from .sparse_pca import _orthonormal, _times, triangle

NEGATIVES, CLIP, EPOCHS, TURNS, SEED = 5, 4.0, 40, 12, 42


def curve(min_dist: float = 0.6, spread: float = 1.0) -> tuple[float, float]:
    """(a, b) of 1 / (1 + a d^(2b)) nearest to 1 up to ``min_dist`` and exp(-(d - min_dist) / spread) beyond, by damped least squares."""
    d = np.linspace(0, 3 * spread, 300)[1:]
    want = np.where(d <= min_dist, 1.0, np.exp(-(d - min_dist) / spread))
    at, damp = np.array([1.0, 1.0]), 1e-2
    miss = lambda p: 1 / (1 + p[0] * d ** (2 * p[1])) - want
    for _ in range(200):
        r, h = miss(at), 1e-6
        jac = np.column_stack([(miss(at + h * e) - r) / h for e in np.eye(2)])
        step = np.linalg.solve(jac.T @ jac + damp * np.eye(2), -jac.T @ r)
        if (at + step > 1e-3).all() and np.square(miss(at + step)).sum() < np.square(r).sum():
            at, damp = at + step, damp / 3
        else:
            damp *= 3
    return float(at[0]), float(at[1])


def spectral(graph: DataFrame, nodes: DataFrame, dims: int = 2, turns: int = TURNS, seed: int = SEED) -> DataFrame:
    """(u, c0..): the leading non-trivial directions of the normalised graph, by subspace iteration; written.

    ``graph`` is (u, v, w) in both directions, ``nodes`` (u, k) with their strengths.
    """
    ship(graph.sparkSession)
    width = dims + 1
    names = [f"c{i}" for i in range(width)]
    # Of (I + normalised graph) / 2, whose values are all at least 0; its leading direction is trivial.
    scaled = graph.join(nodes.withColumnRenamed("k", "ku"), "u").join(nodes.select(F.col("u").alias("v"), F.col("k").alias("kv")), "v")
    scaled = written(scaled.select("u", "v", (F.col("w") / F.sqrt(F.col("ku") * F.col("kv"))).alias("s")), "normalised")
    noise = [(F.pmod(F.xxhash64(F.lit(seed), "u", F.lit(i)), F.lit(1 << 30)) / float(1 << 29) - 1).alias(n) for i, n in enumerate(names) if i]
    now = written(nodes.select("u", F.sqrt("k").alias("c0"), *noise), "directions")
    for _ in range(turns):
        q = _orthonormal(now, "u", width)
        met = scaled.join(q.withColumnRenamed("u", "v"), "v").groupBy("u").agg(*[F.sum(F.col("s") * F.col(n)).alias(f"_{n}") for n in names])
        new = written(q.join(met, "u", "left").select("u", *[((F.col(n) + F.coalesce(f"_{n}", F.lit(0.0))) / 2).alias(n) for n in names]), "directions")
        drop(now, q)
        now = new
    # Directions by falling value; the first goes.
    _, _, vt = np.linalg.svd(triangle(now, width))
    q = written(_times(now, "u", vt.T), "directions")
    drop(now, scaled)
    shown = [F.col(f"c{i + 1}").alias(f"c{i}") for i in range(dims)]
    return q.select("u", *shown)


def _clipped(x: Column) -> Column:
    return F.greatest(F.least(x, F.lit(CLIP)), F.lit(-CLIP))


def layout(edges: DataFrame, a: str, b: str, weight: str, epochs: int = EPOCHS, min_dist: float = 0.6, seed: int = SEED) -> DataFrame:
    """(node, x, y) of every node with an edge; what the driver gets does not grow with nodes or edges."""
    with without_broadcast(edges.sparkSession):
        return _layout(edges, a, b, weight, epochs, min_dist, seed)


def _layout(edges: DataFrame, a: str, b: str, weight: str, epochs: int, min_dist: float, seed: int) -> DataFrame:
    alpha, beta = curve(min_dist)
    graph = written(undirected(edges, a, b, weight).filter("u <> v"), "layout-graph")
    strengths = graph.groupBy("u").agg(F.sum("w").alias("k"))
    start = spectral(graph, strengths, 2, seed=seed)
    reach = start.agg(*[F.max(F.abs(F.col(c))) for c in ("c0", "c1")]).first()
    if reach[0] is None:
        return graph.select(F.col("u").alias("node"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    jitter = lambda i: (F.pmod(F.xxhash64(F.lit(seed), "u", F.lit(i)), F.lit(1 << 30)) / float(1 << 30) - 0.5) * 1e-2
    placed = start.select("u", *[(F.col(c) * (10.0 / (r or 1.0)) + jitter(i)).alias(n) for i, (c, n, r) in enumerate(zip(("c0", "c1"), "xy", reach, strict=True))])
    now = written(row_numbers(placed, [], ["u"], "n"), "positions")
    count = now.count()
    for epoch in range(epochs):
        there = now.select(F.col("u").alias("v"), F.col("x").alias("vx"), F.col("y").alias("vy"))
        dx, dy = F.col("x") - F.col("vx"), F.col("y") - F.col("vy")
        d2 = dx * dx + dy * dy
        power = F.pow(d2, F.lit(beta))
        pull = F.when(d2 > 0, -2 * alpha * beta * power / d2 / (1 + alpha * power)).otherwise(F.lit(0.0))
        push = 2 * beta / ((0.001 + d2) * (1 + alpha * power))
        met = graph.join(now.select("u", "x", "y"), "u").join(there, "v")
        forces = [met.select("u", "w", (F.col("w") * _clipped(pull * dx)).alias("fx"), (F.col("w") * _clipped(pull * dy)).alias("fy"), F.lit(0.0).alias("rx"), F.lit(0.0).alias("ry"))]
        picked = F.pmod(F.xxhash64("u", F.lit(epoch), F.col("t"), F.lit(seed)), F.lit(count))
        asked = now.select("u", "x", "y", F.explode(F.sequence(F.lit(1), F.lit(NEGATIVES))).alias("t")).withColumn("m", picked)
        far = asked.join(now.select(F.col("n").alias("m"), F.col("u").alias("v"), F.col("x").alias("vx"), F.col("y").alias("vy")), "m").filter("u <> v")
        forces.append(far.select("u", F.lit(0.0).alias("w"), F.lit(0.0).alias("fx"), F.lit(0.0).alias("fy"), _clipped(push * dx).alias("rx"), _clipped(push * dy).alias("ry")))
        total = forces[0].unionByName(forces[1]).groupBy("u").agg(*[F.sum(c).alias(c) for c in ("w", "fx", "fy", "rx", "ry")])
        step = 1.0 - epoch / epochs
        move = lambda p: F.col(p) + step * (F.try_divide(F.col(f"f{p}"), F.col("w")) + F.col(f"r{p}"))  # noqa: B023, E731
        new = written(now.join(total, "u").select("u", move("x").alias("x"), move("y").alias("y"), "n"), "positions")
        drop(now)
        now = new
    drop(graph)
    return now.select(F.col("u").alias("node"), "x", "y")
