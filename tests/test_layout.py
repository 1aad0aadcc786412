"""The layout by invariants: its curve, its spectral start against a dense one, and what stays together."""

import random

import numpy as np

from pyspark.sql import functions as F

from celltrove.operators import communities as C
from celltrove.operators import layout as L


def grouped(rng, groups=3, size=16):
    n = groups * size
    edges = [(a, b, 1.0) for a in range(n) for b in range(a) if a // size == b // size and rng.random() < 0.5]
    return edges + [(a * size, (a - 1) * size, 0.2) for a in range(1, groups)]


def test_curve():
    for min_dist in (0.1, 0.6):
        a, b = L.curve(min_dist)
        d = np.linspace(0.01, 3, 200)
        want = np.where(d <= min_dist, 1.0, np.exp(-(d - min_dist)))
        assert np.abs(1 / (1 + a * d ** (2 * b)) - want).max() < 0.12


def test_spectral_directions(spark):
    edges = grouped(random.Random(1))
    graph = C.undirected(spark.createDataFrame(edges, "a long, b long, w double"), "a", "b", "w")
    got = {r.u: (r.c0, r.c1) for r in L.spectral(graph, graph.groupBy("u").agg(F.sum("w").alias("k")), 2, turns=30).collect()}
    w = np.zeros((48, 48))
    for a, b, x in edges:
        w[a, b] += x
        w[b, a] += x
    k = np.sqrt(w.sum(axis=1))
    _, vectors = np.linalg.eigh((np.eye(48) + w / k[:, None] / k[None, :]) / 2)
    x = np.array([got[u] for u in range(48)])
    want = vectors[:, [-2, -3]]
    # The same plane: what is left of either outside of the other.
    x = x / np.linalg.norm(x, axis=0)
    assert np.linalg.norm(want - x @ (x.T @ want)) < 1e-2


def test_groups_stay_together(spark):
    edges = grouped(random.Random(2))
    df = spark.createDataFrame(edges, "a long, b long, w double")
    got = {r.node: (r.x, r.y) for r in L.layout(df, "a", "b", "w", epochs=20).collect()}
    assert set(got) == set(range(48))
    x = np.array([got[u] for u in range(48)])
    assert np.isfinite(x).all()
    d = np.linalg.norm(x[:, None] - x[None, :], axis=2)
    same = np.arange(48)[:, None] // 16 == np.arange(48)[None, :] // 16
    assert d[same].mean() * 2 < d[~same].mean()
    np.fill_diagonal(d, np.inf)
    assert (d.argmin(axis=1) // 16 == np.arange(48) // 16).mean() >= 0.9
    assert d.min() > 0  # pushed apart


def test_rounds_broadcast_nothing(spark, monkeypatch):
    plans, write = [], L.written
    monkeypatch.setattr(L, "written", lambda df, label: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df, label))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    df = spark.createDataFrame(grouped(random.Random(2), 2, 6), "a long, b long, w double")
    assert L.layout(df, "a", "b", "w", epochs=2).count() == 12
    assert any("Join" in p for p in plans) and not any("Broadcast" in p for p in plans)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == before


def test_graph_without_edges(spark):
    df = spark.createDataFrame([(1, None, 1.0), (2, 2, 1.0)], "a long, b long, w double")
    assert L.layout(df, "a", "b", "w").count() == 0
